"""Time windows, rolling features, interval and point-in-time joins, training set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators.joins import (
    FeatureLookup,
    WindowFeatures,
    asof_join,
    attach_windows,
    first_in_range,
    interval_left_join,
    training_set,
)
from ..operators.windows import degradation_signal, rolling, sliding, tumbling, window_family
from .registry import EVENT_LABEL, LINE_LABEL, labelled_events, labelled_lines, query, table

SIZES = {"1h": "1 hour", "24h": "24 hours", "7d": "7 days", "30d": "30 days"}

_CENTS = "cast(round(value * 100) AS BIGINT)"


def _window_sql(size: str, extra: str = "") -> str:
    start = f"time_bucket(INTERVAL '{size}', ts, TIMESTAMP '1970-01-01')"
    return f"""SELECT user_id, {start} AS window_start, {start} + INTERVAL '{size}' AS window_end,
      sum({_CENTS})::BIGINT::DOUBLE / 100.0::DOUBLE / count(value) AS avg_value,
      sum({EVENT_LABEL})::BIGINT::DOUBLE / nullif(count({EVENT_LABEL}), 0) * 100 AS defect_rate_labelled_pct,
      count(*) AS inspection_count {extra} FROM events GROUP BY 1, 2, 3"""


def user_windows(spark, folder, size):
    return tumbling(labelled_events(spark, folder), ["user_id"], "ts", size, ["value"], "label", digits=2)


def _register_window(tag, size):
    @query(f"window_{tag}", _window_sql(size))
    def _(spark, folder):
        return user_windows(spark, folder, size)


for _tag, _size in SIZES.items():
    _register_window(_tag, _size)


@query("window_family", " UNION ALL ".join(_window_sql(size, f", '{tag}' AS size") for tag, size in SIZES.items()))
def _(spark, folder):
    events = labelled_events(spark, folder)
    family = window_family(events, ["user_id"], "ts", list(SIZES.values()), ["value"], "label", digits=2)
    tagged = [family[size].withColumn("size", F.lit(tag)) for tag, size in SIZES.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


_LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_MONTH = "time_bucket(INTERVAL '30 days', l_shipdate, TIMESTAMP '1970-01-01')"


@query(
    "window_lines_30d",
    f"""SELECT l_suppkey, {_MONTH} AS window_start, {_MONTH} + INTERVAL '30 days' AS window_end, {", ".join(
        f"sum(cast(round({m} * 100) AS BIGINT))::BIGINT::DOUBLE / 100.0::DOUBLE / count({m}) AS avg_{m}"
        for m in _LINE_MEASURES)},
      sum({LINE_LABEL})::BIGINT::DOUBLE / nullif(count({LINE_LABEL}), 0) * 100 AS defect_rate_labelled_pct,
      count(*) AS inspection_count FROM lineitem GROUP BY 1, 2, 3""",
)
def _(spark, folder):
    lines = labelled_lines(spark, folder)
    return tumbling(lines, ["l_suppkey"], "l_shipdate", "30 days", _LINE_MEASURES, "label", digits=2)


@query(
    "window_known_labels",
    f"""WITH r AS (SELECT l_suppkey, o_orderdate, l_shipdate, {LINE_LABEL} AS y,
        time_bucket(INTERVAL '30 days', o_orderdate, TIMESTAMP '1970-01-01') AS s
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    k AS (SELECT *, CASE WHEN l_shipdate <= s + INTERVAL '30 days' THEN y END AS known FROM r)
    SELECT l_suppkey, s AS window_start, s + INTERVAL '30 days' AS window_end,
      sum(known)::BIGINT::DOUBLE / nullif(count(known), 0) * 100 AS defect_rate_labelled_pct,
      count(*) AS inspection_count FROM k GROUP BY 1, 2, 3""",
)
def _(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = labelled_lines(spark, folder).select("l_orderkey", "l_suppkey", "l_shipdate", "label")
    joined = lines.join(orders, "l_orderkey")
    return tumbling(joined, ["l_suppkey"], "o_orderdate", "30 days", [], "label", label_known="l_shipdate")


@query(
    "window_sliding",
    f"""WITH w AS (SELECT user_id, value, {EVENT_LABEL} AS y,
        time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01') - k * INTERVAL '6 hours' AS s
      FROM events, range(4) t(k))
    SELECT user_id, s AS window_start, s + INTERVAL '24 hours' AS window_end,
      sum({_CENTS})::BIGINT::DOUBLE / 100.0::DOUBLE / count(value) AS avg_value,
      sum(y)::BIGINT::DOUBLE / nullif(count(y), 0) * 100 AS defect_rate_labelled_pct,
      count(*) AS inspection_count FROM w GROUP BY 1, 2, 3""",
)
def _(spark, folder):
    events = labelled_events(spark, folder)
    return sliding(events, ["user_id"], "ts", "24 hours", "6 hours", ["value"], "label", digits=2)


@query(
    "rolling_features",
    f"""SELECT event_id, user_id, ts, count(value) OVER w AS rolling_count,
      sum({_CENTS}) OVER w::BIGINT::DOUBLE / 100.0::DOUBLE / nullif(count(value) OVER w, 0) AS rolling_avg_value
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts)
      RANGE BETWEEN 86400000000 PRECEDING AND 1 PRECEDING)""",
)
def _(spark, folder):
    events = table(spark, folder, "events")
    return rolling(events, ["user_id"], "ts", "24 hours", "value", 2, keep=["event_id", "user_id", "ts"])


_H, _W = _window_sql("1 hour"), _window_sql("7 days")


@query(
    "degradation_signal",
    f"""SELECT h.user_id, h.window_end, h.defect_rate_labelled_pct AS short_rate_pct,
      w.defect_rate_labelled_pct AS long_rate_pct,
      h.defect_rate_labelled_pct - w.defect_rate_labelled_pct AS rate_change_pct,
      h.defect_rate_labelled_pct / nullif(w.defect_rate_labelled_pct, 0) AS rate_ratio
    FROM ({_H}) h ASOF LEFT JOIN ({_W}) w ON h.user_id = w.user_id AND w.window_end <= h.window_end""",
)
def _(spark, folder):
    short, long = user_windows(spark, folder, "1 hour"), user_windows(spark, folder, "7 days")
    return degradation_signal(short, long, ["user_id"], "1 hour", "7 days")


@query(
    "interval_join",
    """SELECT a.l_orderkey, a.l_linenumber AS line, a.l_shipdate AS shipped, b.l_linenumber AS later_line, b.l_shipdate AS later_shipped
    FROM (SELECT * FROM lineitem WHERE l_returnflag <> 'N') a
    LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'N') b
      ON a.l_orderkey = b.l_orderkey AND b.l_shipdate >= a.l_shipdate AND b.l_shipdate <= a.l_shipdate + INTERVAL '30 days'""",
)
def _(spark, folder):
    """On the order, a selective key: its few lines make few pairs."""
    lines = table(spark, folder, "lineitem")

    def side(there, line, time):
        return lines.filter(there).select("l_orderkey", F.col("l_linenumber").alias(line), F.col("l_shipdate").alias(time))

    known = F.col("l_returnflag") != "N"
    return interval_left_join(
        side(known, "line", "shipped"), side(~known, "later_line", "later_shipped"), "l_orderkey", "shipped", "later_shipped", "30 days", slices=2
    )


@query(
    "interval_join_first",
    """SELECT c.event_id AS click_id, c.user_id, c.ts AS click_ts,
      CASE WHEN p.ts <= c.ts + INTERVAL '24 hours' THEN p.purchase_id END AS purchase_id,
      CASE WHEN p.ts <= c.ts + INTERVAL '24 hours' THEN p.ts END AS purchase_ts
    FROM (SELECT * FROM events WHERE event_type = 'click') c
    ASOF LEFT JOIN (SELECT user_id, ts, min(event_id) AS purchase_id FROM events WHERE event_type = 'purchase'
      GROUP BY 1, 2) p ON c.user_id = p.user_id AND p.ts >= c.ts""",
)
def _(spark, folder):
    events = table(spark, folder, "events")
    clicks = events.filter("event_type = 'click'").select(
        F.col("event_id").alias("click_id"), "user_id", F.col("ts").alias("click_ts")
    )
    purchases = events.filter("event_type = 'purchase'")
    purchases = purchases.groupBy("user_id", F.col("ts").alias("purchase_ts")).agg(
        F.min("event_id").alias("purchase_id")
    )
    return first_in_range(clicks, purchases, "user_id", "click_ts", "purchase_ts", "24 hours")


UNIT_LABELS_SQL = f"""SELECT o_orderkey AS unit_id, o_orderdate AS event_time, o_totalprice, l_shipdate AS label_time,
      {LINE_LABEL} AS is_defective FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
      AND l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL '30 days'"""


@query("interval_join_units", UNIT_LABELS_SQL)
def _(spark, folder):
    units = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("unit_id"), F.col("o_orderdate").alias("event_time"), "o_totalprice"
    )
    labels = labelled_lines(spark, folder).select(
        F.col("l_orderkey").alias("unit_id"),
        F.col("l_shipdate").alias("label_time"),
        F.col("label").alias("is_defective"),
    )
    return interval_left_join(units, labels, "unit_id", "event_time", "label_time", "30 days")


def _event_spine(spark, folder):
    return table(spark, folder, "events").select("event_id", "user_id", "ts", "value")


_SPINE = "(SELECT event_id, user_id, ts, value FROM events) s"


@query(
    "asof_features",
    f"""SELECT s.*, f.window_end, f.avg_value, f.defect_rate_labelled_pct, f.inspection_count
    FROM {_SPINE} ASOF LEFT JOIN ({_window_sql("24 hours")}) f
      ON s.user_id = f.user_id AND f.window_end <= s.ts""",
)
def _(spark, folder):
    features = user_windows(spark, folder, "24 hours").drop("window_start")
    return asof_join(_event_spine(spark, folder), features, ["user_id"], "ts", "window_end")


@query(
    "asof_events",
    f"""SELECT s.*, f.err_ts, f.err_value FROM {_SPINE}
    ASOF LEFT JOIN (SELECT user_id, ts AS err_ts, max(value) AS err_value FROM events
      WHERE event_type = 'error' GROUP BY 1, 2) f ON s.user_id = f.user_id AND f.err_ts <= s.ts""",
)
def _(spark, folder):
    errors = table(spark, folder, "events").filter("event_type = 'error'")
    errors = errors.groupBy("user_id", F.col("ts").alias("err_ts")).agg(F.max("value").alias("err_value"))
    return asof_join(_event_spine(spark, folder), errors, ["user_id"], "ts", "err_ts", slice_size="6 hours", salts=2)


_FEATURES = ["avg_value", "defect_rate_labelled_pct", "inspection_count"]


def _asof_sql(tags):
    names = ", ".join(f"f{t}.{c} AS w{t}_{c}" for t in tags for c in _FEATURES)
    joins = " ".join(
        f"ASOF LEFT JOIN ({_window_sql(SIZES[t])}) f{t} ON s.user_id = f{t}.user_id AND f{t}.window_end <= s.ts"
        for t in tags
    )
    return names, joins


@query("asof_windows", "SELECT s.*, {} FROM {} {}".format(_asof_sql(SIZES)[0], _SPINE, _asof_sql(SIZES)[1]))
def _(spark, folder):
    family = window_family(labelled_events(spark, folder), ["user_id"], "ts", list(SIZES.values()), ["value"], "label", digits=2)
    features = [WindowFeatures(family[size], size, f"w{tag}_") for tag, size in SIZES.items()]
    return attach_windows(_event_spine(spark, folder), features, ["user_id"], "ts")


_TRAIN_TAGS = ["1h", "24h", "7d", "30d"]


@query(
    "training_set",
    f"""SELECT s.user_id, s.ts, s.value, c.c_nationkey, c.c_mktsegment, c.c_acctbal, {_asof_sql(_TRAIN_TAGS)[0]},
      s.label FROM (SELECT event_id, user_id, ts, value, {EVENT_LABEL} AS label FROM events) s
    LEFT JOIN customer c ON s.user_id = c.c_custkey {_asof_sql(_TRAIN_TAGS)[1]}""",
)
def training_set_query(spark, folder):
    events = labelled_events(spark, folder)
    spine = events.select("event_id", "user_id", "ts", "value", "label")
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_nationkey", "c_mktsegment", "c_acctbal"
    )
    sizes = [SIZES[tag] for tag in _TRAIN_TAGS]
    family = window_family(events, ["user_id"], "ts", sizes, ["value"], "label", digits=2)
    lookups = [FeatureLookup(customer, ("user_id",))] + [
        FeatureLookup(family[SIZES[tag]], ("user_id",), f"w{tag}_", window=SIZES[tag]) for tag in _TRAIN_TAGS
    ]
    return training_set(spine, lookups, "ts", "label", exclude=("event_id",))
