"""Runs, promotion and aliases as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def search_runs(runs: DataFrame, where: str | Column, order_by: list[Column] | None = None) -> DataFrame:
    """Runs by any condition on their metrics, parameters and tags."""
    found = runs.filter(where)
    return found.orderBy(*order_by) if order_by else found


def top_runs(runs: DataFrame, metric: str, tie: str, n: int = 1) -> DataFrame:
    """The n best runs by a metric; ``tie`` decides between equal ones."""
    return runs.filter(F.col(metric).isNotNull()).orderBy(F.col(metric).desc(), tie).limit(n)


def with_gaps(runs: DataFrame, metrics: list[str]) -> DataFrame:
    """Training minus validation value of each metric."""
    return runs.withColumns({f"gap_{m}": F.col(f"train_{m}") - F.col(f"val_{m}") for m in metrics})


def promotion_decision(challengers: DataFrame, champions: DataFrame, key: str, metric: str) -> DataFrame:
    """One decision per challenger. It must be strictly better than the champion; a tie keeps
    the champion, and so does a metric that is NULL on either side; without a champion (no row
    of its key) the challenger is promoted."""
    a = challengers.select(key, F.col(metric).alias("challenger_score"))
    b = champions.select(key, F.col(metric).alias("champion_score"), F.lit(True).alias("_there"))
    ours, theirs, absent = F.col("challenger_score"), F.col("champion_score"), F.col("_there").isNull()
    why = (
        F.when(absent, "no champion")
        .when(ours > theirs, "challenger better")
        .when(ours == theirs, "tie keeps champion")
        .when(ours < theirs, "champion better")
        .otherwise("not comparable")
    )
    return (
        a.join(b, key, "left")
        .withColumns({"promoted": absent | F.coalesce(ours > theirs, F.lit(False)), "reason": why, "delta": ours - theirs})
        .select(key, "challenger_score", "champion_score", "delta", "promoted", "reason")
    )


#: The life cycle of a version: what it may become from each alias, None being a version without one.
TRANSITIONS: dict[str | None, tuple[str, ...]] = {
    None: ("candidate",),
    "candidate": ("challenger", "rejected"),
    "challenger": ("champion", "rejected", "retired"),
    "champion": ("retired",),
    "rejected": (),
    "retired": (),
}
_CODES = {alias: code for code, alias in enumerate(TRANSITIONS)}
#: Steps of the longest way through the life cycle.
_LONGEST = 4
EVENTS = "version int, alias string, tags map<string,string>, at timestamp"


def may_become(now: str | None, alias: str) -> bool:
    return alias in TRANSITIONS.get(now, ())


def registration_changes(version: int, tags: dict[str, str]) -> list[tuple[int, str, dict[str, str]]]:
    """A trained version enters the life cycle: a candidate, and as its test is due a challenger."""
    return [(version, "candidate", tags), (version, "challenger", {})]


def decision_changes(
    wins: bool, challenger: int, final: int | None, champion: int | None, tags: dict[str, str]
) -> list[tuple[int, str, dict[str, str]]]:
    """Alias changes that follow from a decision. Challenger wins: the old champion is retired, the final version becomes champion.
    Otherwise the challenger is rejected."""
    if not wins:
        return [(challenger, "rejected", {"why": "not better than the champion", **tags})]
    retired = [(champion, "retired", {"why": "a better challenger"})] if champion else []
    return [*retired, (final, "champion", tags)]


def promotion_events(
    df: DataFrame,
    wins: bool,
    challenger: int,
    final: int | None,
    champion: int | None,
    tags: dict[str, str],
) -> DataFrame:
    """:func:`decision_changes` as rows ``version, alias, tags, at``."""
    rows = decision_changes(wins, challenger, final, champion, tags)
    events = df.sparkSession.createDataFrame(rows, "version int, alias string, tags map<string,string>")
    return events.withColumn("at", F.current_timestamp())


def alias_state(history: DataFrame, version: str, order: list[str]) -> DataFrame:
    """The alias each version has now: the event that last changed it. ``order`` is a time and a whole number from 0 on that decides
    between equal times; of events that are equal in both one counts.

    Events are folded through :data:`TRANSITIONS`: one that a version's alias does not allow changes nothing. A version passes few
    aliases, so the fold is a few steps, each the first allowed event after the last: an aggregate that tasks combine before the
    shuffle, however long the history of a version is.
    """
    at, tie = order
    wide = "decimal(38,0)"
    code = F.lit(0)
    for alias, number in _CODES.items():
        code = F.when(F.col("alias") == alias, number).otherwise(code) if alias else code
    moment = F.unix_micros(F.col(at).cast("timestamp")).cast(wide)
    place = moment * F.lit(1 << 60).cast(wide) + F.col(tie).cast(wide)
    events = history.withColumn("_code", code).withColumn("_place", (place * F.lit(8).cast(wide) + F.col("_code").cast(wide)).cast(wide)).filter("_code > 0")
    moves = [(_CODES[now], _CODES[to]) for now, after in TRANSITIONS.items() for to in after]
    steps = events.select(F.col(version).alias("_v"), F.col("_code").alias("_to"), F.col("_place").alias("_next"))

    def allowed(now: Column) -> Column:
        allow = F.lit(False)
        for a, b in moves:
            allow = allow | ((now == a) & (F.col("_to") == b))
        return allow

    state = steps.filter(allowed(F.lit(0))).groupBy("_v").agg(F.min("_next").alias("_at"))
    for _ in range(_LONGEST - 1):
        later = steps.withColumnRenamed("_v", "_w")
        now = F.pmod(F.col("_at"), F.lit(8).cast(wide)).cast("int")
        same = F.col("_v").eqNullSafe(F.col("_w")) & (F.col("_next") > F.col("_at")) & allowed(now)
        state = state.join(later, same, "left").groupBy("_v").agg(F.coalesce(F.min("_next"), F.max("_at")).alias("_at"))
    last = Window.partitionBy(version).orderBy("alias")  # only equal events are left
    kept = events.join(state, F.col(version).eqNullSafe(F.col("_v")) & (F.col("_place") == F.col("_at")), "left_semi")
    return kept.withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n", "_code", "_place")
