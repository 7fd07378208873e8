"""Interval join, key lookups and point-in-time lookups."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import epoch_us, seconds_of, slice_start
from .slices import before_slices

_US = 1_000_000


def interval_left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    within: str,
    slices: int | None = None,
) -> DataFrame:
    """Every left row with each right row of its key that lies 0 to ``within`` after it; left
    rows without one are kept. ``key`` has one name on both sides, other names must differ.

    With a selective key (one unit, few labels) the plain form is right: hash on the key,
    range as a residual. For a coarse key give ``slices``: time is cut into ``within / slices``
    and becomes part of the join key. Each left row lies in one slice and each right row is
    copied to the ``slices + 1`` that can see it, so a hot key spreads over time and a row meets
    only rows near it: at most ``1 + 1 / slices`` times the range.
    """
    reach = F.expr(f"INTERVAL {seconds_of(within)} SECONDS")
    b = right.withColumnRenamed(key, "_rkey")
    in_range = (F.col(right_time) >= F.col(left_time)) & (F.col(right_time) <= F.col(left_time) + reach)
    if slices is None:
        return left.join(b, (F.col(key) == F.col("_rkey")) & in_range, "left").drop("_rkey")
    if seconds_of(within) % slices:
        raise ValueError("slices must be whole seconds")
    width = seconds_of(within) // slices
    step = F.lit(width * _US).cast("long")
    a = left.withColumn("_ls", slice_start(left_time, width))
    at = slice_start(right_time, width)
    b = b.withColumn("_rs", F.explode(F.sequence(at - slices * step, at, step)))
    same = (F.col(key) == F.col("_rkey")) & (F.col("_ls") == F.col("_rs"))
    return a.join(b, same & in_range, "left").drop("_ls", "_rs", "_rkey")


def first_label(joined: DataFrame, unit: str, time: str, label_time: str, label: str) -> DataFrame:
    """One label per inspection: the earliest, of those the smaller value. Inspections that
    are equal in every column stay as they are many. Expects the output of the interval join."""
    rank = F.rank().over(Window.partitionBy(unit, time).orderBy(F.col(label_time), F.col(label)))
    return joined.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def inspection_labels(inspections: DataFrame, labels: DataFrame, only_first: bool = False) -> DataFrame:
    """Inspections beside the labels that arrive within 30 days; several labels give several
    rows unless ``only_first``."""
    if only_first:
        labels = labels.dropDuplicates(["unit_id", "label_available_date", "is_defective"])
    joined = interval_left_join(inspections, labels, "unit_id", "timestamp", "label_available_date", "30 days")
    if only_first:
        joined = first_label(joined, "unit_id", "timestamp", "label_available_date", "is_defective")
    return joined.withColumn("join_timestamp", F.current_timestamp())


def duplicate_keys(features: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; a lookup table must have none."""
    return features.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def lookup(
    spine: DataFrame, features: DataFrame, keys: list[str], prefix: str = "", check: bool = False
) -> DataFrame:
    """Feature columns by key. No hint: Spark broadcasts the table when its size allows it,
    else it shuffles and adaptive execution splits hot keys. With ``check`` a table that holds
    a key twice is refused, as it would repeat spine rows."""
    if check and (twice := duplicate_keys(features, keys).first()):
        raise ValueError(f"lookup table holds a key more than once: {twice}")
    named = features.select(*keys, *[F.col(c).alias(prefix + c) for c in features.columns if c not in keys])
    return spine.join(named, keys, "left")


@dataclass(frozen=True)
class WindowFeatures:
    """A window table with one row per key and ``window_end``, a multiple of ``size``."""

    table: DataFrame
    size: str
    prefix: str

    def columns(self, keys: list[str]) -> list[str]:
        return [c for c in self.table.columns if c not in (*keys, "window_start", "window_end")]


def attach_windows(spine: DataFrame, features: list[WindowFeatures], keys: list[str], time: str) -> DataFrame:
    """For each row the newest window of every table that closed at or before its time.

    Window ends lie on a common grid, so the answer depends only on the key and the grid cell
    of the row. The state of all tables is worked out once per occupied (key, cell), from
    frames with at most one row per cell; the rows themselves take part in a single equi-join
    on (key, cell), whatever the number of tables. They are never sorted by time, and a hot key
    is spread over its cells (a hot cell is split by adaptive execution).
    """
    grid = reduce(math.gcd, [seconds_of(f.size) for f in features])
    rows = spine.withColumn("_cell", slice_start(time, grid))
    asked = rows.select(*keys, "_cell").distinct().withColumn("_asked", F.lit(True))
    parts = []
    for i, f in enumerate(features):
        packed = F.struct(*[F.col(c).alias(f.prefix + c) for c in f.columns(keys)]).alias(f"_f{i}")
        parts.append(f.table.select(*keys, slice_start("window_end", grid).alias("_cell"), packed))
    events = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts, asked)
    past = Window.partitionBy(*keys).orderBy("_cell").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    newest = {f"_f{i}": F.last(f"_f{i}", ignorenulls=True).over(past) for i in range(len(features))}
    state = events.withColumns(newest).filter("_asked").drop("_asked")
    joined = rows.join(state, [*keys, "_cell"], "left")
    unpacked = [
        F.col(f"_f{i}.{f.prefix}{c}").alias(f.prefix + c) for i, f in enumerate(features) for c in f.columns(keys)
    ]
    return joined.select(*spine.columns, *unpacked)


def asof_join(
    spine: DataFrame,
    features: DataFrame,
    keys: list[str],
    spine_time: str,
    feature_time: str,
    prefix: str = "",
    slice_size: str = "1 hour",
    salts: int = 1,
    forward: bool = False,
    within: str | None = None,
) -> DataFrame:
    """For each spine row the newest feature row of its key with time at or before its own;
    feature rows are unique per (key, time) and may lie anywhere in time. ``forward`` looks for
    the first one at or after the row instead, ``within`` limits the distance.

    Time is cut into slices. The value at the start of a slice comes from the newest feature rows of the
    slices, which :func:`~linewright.operators.slices.before_slices` merges without a group per key; inside a slice
    spine and feature rows are merged in time order. Groups are thus one key in one slice, and with ``salts`` the spine
    rows of such a group are dealt by content hash over that many groups, each with its own copy of the slice's
    feature rows. A key with millions of rows an hour wants a shorter ``slice_size``.
    """
    width = F.lit(seconds_of(slice_size) * _US).cast("long")

    def clock(column: str) -> Column:
        return -epoch_us(column) if forward else epoch_us(column)

    def slice_of(column: Column) -> Column:
        return column - F.pmod(column, width)

    payload = [c for c in features.columns if c not in (*keys, feature_time)]
    packed = F.struct(F.col(feature_time), *payload)
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in [*keys, feature_time]])
    f = features.filter(present).select(*keys, clock(feature_time).alias("_t"), packed.alias("_p"))
    f = f.withColumn("_slice", slice_of(F.col("_t")))
    own = [c for c in spine.columns if c not in keys]
    s = spine.select(
        *keys,
        clock(spine_time).alias("_t"),
        slice_of(clock(spine_time)).alias("_slice"),
        F.pmod(F.xxhash64(*spine.columns), F.lit(salts)).cast("int").alias("_salt"),
        F.lit(2).alias("_kind"),
        F.struct(*own).alias("_row"),
    )

    ends = f.groupBy(*keys, "_slice").agg(F.max_by("_p", "_t").alias("_p"), F.max("_t").alias("_t"))
    newest = {"_p": lambda: F.max_by("_p", "_t"), "_t": lambda: F.max("_t")}
    asked = s.select(*keys, "_slice").distinct()
    starts = before_slices(ends, asked, keys, seconds_of(slice_size) * _US, newest)
    starts = starts.select(*keys, "_slice", F.col("_slice").alias("_t"), F.lit(0).alias("_kind"), "_p")
    inside = f.select(*keys, "_slice", "_t", F.lit(1).alias("_kind"), "_p")
    copies = starts.unionByName(inside).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    order = (
        Window.partitionBy(*keys, "_slice", "_salt")
        .orderBy("_t", "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = F.last("_p", ignorenulls=True).over(order)
    merged = s.unionByName(copies, allowMissingColumns=True).withColumn("_p", found).filter("_kind = 2")
    if within:
        apart = F.col("_t") - clock(f"_p.{feature_time}")
        merged = merged.withColumn("_p", F.when(apart <= seconds_of(within) * _US, F.col("_p")))
    return merged.select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in spine.columns],
        *[F.col(f"_p.{c}").alias(prefix + c) for c in [feature_time, *payload]],
    )


def first_in_range(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, within: str
) -> DataFrame:
    """Every left row with the first right row of its key that lies 0 to ``within`` after it, or
    none. One row out per row in, without forming the pairs in range; right rows are unique
    per (key, time)."""
    return asof_join(left, right, [key], left_time, right_time, forward=True, within=within)


@dataclass(frozen=True)
class FeatureLookup:
    """Where one set of features comes from: a static table by key, a window table on its
    closing time, or any timed table on ``time``."""

    table: DataFrame
    keys: tuple[str, ...]
    prefix: str = ""
    window: str | None = None
    time: str | None = None


def training_set(
    spine: DataFrame,
    lookups: list[FeatureLookup],
    time: str,
    label: str,
    exclude: tuple[str, ...] = (),
) -> DataFrame:
    """The spine with all looked-up features; the label is last, excluded columns are dropped,
    unlabelled rows stay. Window tables on the same key share one join."""
    out = spine
    by_key: dict[tuple[str, ...], list[WindowFeatures]] = {}
    for item in lookups:
        if item.window:
            by_key.setdefault(item.keys, []).append(WindowFeatures(item.table, item.window, item.prefix))
        elif item.time:
            out = asof_join(out, item.table, list(item.keys), time, item.time, item.prefix)
        else:
            out = lookup(out, item.table, list(item.keys), item.prefix)
    for keys, features in by_key.items():
        out = attach_windows(out, features, list(keys), time)
    dropped = {*exclude, label}
    return out.select(*[c for c in out.columns if c not in dropped], label)
