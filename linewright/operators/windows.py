"""Time-window features per key.

``digits`` switches means to fixed-point totals: whole numbers add up to the same total in
any order, so a recomputed feature table has the same bits and a snapshot diff shows
real changes only. Without it means are ordinary double averages.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..functions import as_fixed, epoch_us, fixed_mean, from_epoch_us, percent, seconds_of, slice_start
from .slices import before_slices


def _label_values(
    df: DataFrame, time: str, label: str | None, label_known: str | None, sizes: list[str]
) -> dict[str, Column]:
    """The label as counted by windows of each size. With ``label_known`` it counts only if it
    was available when the row's window of that size closed: the rate holds no later knowledge."""
    if not label:
        return {}
    value = F.col(label).cast("long")
    if not label_known:
        return {"label": value}
    out = {}
    for size in sizes:
        closes = slice_start(time, seconds_of(size)) + F.lit(seconds_of(size) * 1_000_000)
        out[f"label_{seconds_of(size)}"] = F.when(epoch_us(label_known) <= closes, value)
    return out


def _totals(measures: list[str], labels: dict[str, Column], digits: int | None) -> list[Column]:
    """Additive parts from which every window measure follows."""
    parts = [F.count(F.lit(1)).alias("_n")]
    for name in measures:
        reading = as_fixed(name, digits) if digits is not None else F.col(name).cast("double")
        parts += [F.sum(reading).alias(f"_t_{name}"), F.count(name).alias(f"_c_{name}")]
    for name, value in labels.items():
        parts += [F.sum(value).alias(f"_t_{name}"), F.count(value).alias(f"_c_{name}")]
    return parts


def _merge(totals: DataFrame) -> list[Column]:
    names = [c for c in totals.columns if c == "_n" or c.startswith(("_t_", "_c_"))]
    return [F.sum(name).alias(name) for name in names]


def _measures(measures: list[str], label: str | None, digits: int | None) -> list[Column]:
    out = []
    for name in measures:
        total, count = F.col(f"_t_{name}"), F.col(f"_c_{name}")
        mean = fixed_mean(total, count, digits) if digits is not None else F.try_divide(total, count)
        out.append(mean.alias(f"avg_{name}"))
    if label:
        out.append(percent(F.col(f"_t_{label}"), F.col(f"_c_{label}")).alias("defect_rate_labelled_pct"))
    return out + [F.col("_n").alias("inspection_count")]


def _shown(df: DataFrame, keys: list[str], measures: list[str], label: str | None, digits: int | None) -> DataFrame:
    return df.select(
        *keys,
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *_measures(measures, label, digits),
    )


def _window_of(start: Column, seconds: int, kind: DataType) -> Column:
    """The window struct that starts at a number of microseconds."""
    end = start + F.lit(seconds * 1_000_000)
    return F.struct(from_epoch_us(start, kind).alias("start"), from_epoch_us(end, kind).alias("end"))


def window_totals(
    df: DataFrame,
    keys: list[str],
    time: str,
    size: str,
    measures: list[str],
    labels: dict[str, Column],
    digits: int | None = None,
    slide: str | None = None,
) -> DataFrame:
    """Additive totals per key and window ``w``."""
    window = F.window(time, size, slide) if slide else F.window(time, size)
    return df.groupBy(window.alias("w"), *keys).agg(*_totals(measures, labels, digits))


def tumbling(
    df: DataFrame,
    keys: list[str],
    time: str,
    size: str,
    measures: list[str],
    label: str | None = None,
    label_known: str | None = None,
    digits: int | None = None,
    slide: str | None = None,
) -> DataFrame:
    """Means, labelled defect rate and row count per key and window, aligned to 1970 in UTC.
    One shuffle of per-task partial totals; also runs on a stream with a watermark. With
    ``slide`` every row is copied into its windows; on bounded input use :func:`sliding`."""
    if slide and label_known:
        raise ValueError("a row of sliding windows has no single closing time")
    labels = _label_values(df, time, label, label_known, [size])
    totals = window_totals(df, keys, time, size, measures, labels, digits, slide)
    return _shown(totals, keys, measures, next(iter(labels), None), digits)


def sliding(
    df: DataFrame,
    keys: list[str],
    time: str,
    size: str,
    slide: str,
    measures: list[str],
    label: str | None = None,
    digits: int | None = None,
) -> DataFrame:
    """Overlapping windows. Rows are first totalled into panes as wide as the common step of
    size and slide, and only the panes are copied into the windows that hold them.

    Bounded input only; on a stream use :func:`tumbling` with ``slide``.
    """
    labels = _label_values(df, time, label, None, [size])
    length, step = seconds_of(size), seconds_of(slide)
    if step > length:
        raise ValueError("slide must not exceed size")
    pane = math.gcd(length, step)
    kind = df.schema[time].dataType
    panes = window_totals(df, keys, time, f"{pane} seconds", measures, labels, digits)
    at = epoch_us("w.start")
    us = 1_000_000
    last = slice_start("w.start", step)
    first_after = at + F.lit((pane - length) * us)
    earliest = last - F.lit((length // step) * step * us)
    starts = F.filter(F.sequence(earliest, last, F.lit(step * us).cast("long")), lambda s: s >= first_after)
    spread = panes.withColumn("_s", F.explode(starts)).drop("w")
    merged = spread.groupBy("_s", *keys).agg(*_merge(spread))
    window = _window_of(F.col("_s"), length, kind)
    return _shown(merged.withColumn("w", window), keys, measures, next(iter(labels), None), digits)


def window_family(
    df: DataFrame,
    keys: list[str],
    time: str,
    sizes: list[str],
    measures: list[str],
    label: str | None = None,
    label_known: str | None = None,
    digits: int | None = None,
    keep=None,
) -> dict[str, DataFrame]:
    """Tables of several widths from a single pass over the rows: each width is rolled up
    from the widest smaller one that divides it. ``keep(frame, name)`` stores the totals of
    a width that others build on, so that they are computed once."""
    ordered = sorted(sizes, key=seconds_of)
    labels = _label_values(df, time, label, label_known, sizes)
    kind = df.schema[time].dataType
    timed = df.filter(F.col(time).isNotNull())
    totals: dict[str, DataFrame] = {}
    out = {}
    for i, size in enumerate(ordered):
        width = seconds_of(size)
        base = [s for s in ordered[:i] if width % seconds_of(s) == 0]
        if base:
            narrow = totals[base[-1]]
            wider = F.col("_s") - F.pmod(F.col("_s"), F.lit(width * 1_000_000).cast("long"))
            frame = narrow.groupBy(wider.alias("_s"), *keys).agg(*_merge(narrow))
        else:
            cells = _totals(measures, labels, digits)
            frame = timed.groupBy(slice_start(time, width).alias("_s"), *keys).agg(*cells)
        builds_on = any(seconds_of(s) % seconds_of(size) == 0 for s in ordered[i + 1 :])
        if keep and builds_on:
            frame = keep(frame, f"totals_{width}s")
        totals[size] = frame
        counted = f"label_{width}" if label_known else "label" if label else None
        window = _window_of(F.col("_s"), width, kind)
        out[size] = _shown(frame.withColumn("w", window), keys, measures, counted, digits)
    return out


def rolling(
    df: DataFrame,
    keys: list[str],
    time: str,
    size: str,
    measure: str,
    digits: int,
    keep: list[str],
    step: str = "1 hour",
) -> DataFrame:
    """For every row, count and mean of the earlier rows of its key within ``size`` before it
    (the row itself and rows at the same instant excluded).

    A row adds its value at its own time and takes it back ``size`` later; a row's answer is the
    running total just before its time. Time is cut into slices of ``step``; a slice starts with
    what came before it less what had left the window by then, both from
    :func:`~linewright.operators.slices.before_slices`, so slices of one key run as separate groups and a hot key
    spreads over many tasks. A group holds the rows that one key adds and takes back in one ``step``: give a shorter one
    for keys with millions of rows an hour. Totals are whole numbers: nothing is lost by the subtraction.
    """
    length, width = seconds_of(size) * 1_000_000, seconds_of(step) * 1_000_000
    if length % width:
        raise ValueError("size must be a multiple of step")
    group = [f"_k{i}" for i in range(len(keys))]
    base = df.select(
        F.struct(*keep).alias("_row"),
        *[F.col(k).alias(g) for k, g in zip(keys, group)],
        epoch_us(time).alias("_t"),
        slice_start(time, seconds_of(step)).alias("_slice"),
        as_fixed(measure, digits).alias("_v"),
    )
    # whole histories are added up here, so in more digits than a window needs
    total = F.sum(F.col("_v").cast("decimal(38,0)"))
    per_slice = base.groupBy(*group, "_slice").agg(F.count("_v").alias("_n"), total.alias("_s"))
    edges = per_slice.select(*group, F.explode(F.array("_slice", F.col("_slice") - length)).alias("_slice")).distinct()
    sums = {"_n": lambda: F.sum("_n"), "_s": lambda: F.sum("_s")}
    prefix = before_slices(per_slice, edges, group, width, sums)
    # what came before a slice, and what came before the slice one window earlier
    ends = prefix.select(*group, "_slice", "_n", "_s").unionByName(
        prefix.select(*group, (F.col("_slice") + length).alias("_slice"), (-F.col("_n")).alias("_n"), (-F.col("_s")).alias("_s"))
    )
    carried = ends.groupBy(*group, "_slice").agg(F.sum("_n").alias("_n"), F.sum("_s").cast("long").alias("_s"))
    carried = carried.select(*group, "_slice", (F.col("_slice") - 1).alias("_t"), "_n", "_s")

    def move(later: int, sign: int, row: Column) -> Column:
        count, amount = F.col("_v").isNotNull().cast("long"), F.coalesce("_v", F.lit(0))
        return F.struct(
            (F.col("_slice") + later).alias("_slice"),
            (F.col("_t") + later).alias("_t"),
            (count * sign).alias("_n"),
            (amount * sign).alias("_s"),
            row.alias("_row"),
        )

    nothing = F.lit(None).cast(base.schema["_row"].dataType)
    moves = base.select(*group, F.inline(F.array(move(0, 1, F.col("_row")), move(length, -1, nothing))))
    until = Window.partitionBy(*group, "_slice").orderBy("_t").rangeBetween(Window.unboundedPreceding, -1)
    return (
        moves.unionByName(carried, allowMissingColumns=True)
        .withColumns({"_n": F.sum("_n").over(until), "_s": F.sum("_s").over(until)})
        .filter(F.col("_row").isNotNull())
        .select(
            *[F.col(f"_row.{c}").alias(c) for c in keep],
            F.coalesce("_n", F.lit(0)).alias("rolling_count"),
            fixed_mean(F.col("_s"), F.col("_n"), digits).alias(f"rolling_avg_{measure}"),
        )
    )


def degradation_signal(short: DataFrame, long: DataFrame, keys: list[str], short_size: str, long_size: str) -> DataFrame:
    """Each closed short window beside the last long window closed by then: both defect
    rates, their difference and ratio."""
    from .joins import WindowFeatures, attach_windows

    rate = "defect_rate_labelled_pct"
    base = short.select(*keys, "window_end", F.col(rate).alias("short_rate_pct"))
    feature = WindowFeatures(long.select(*keys, "window_end", rate), long_size, prefix="long_")
    joined = attach_windows(base, [feature], keys, "window_end")
    return joined.select(
        *keys,
        "window_end",
        "short_rate_pct",
        F.col(f"long_{rate}").alias("long_rate_pct"),
        (F.col("short_rate_pct") - F.col(f"long_{rate}")).alias("rate_change_pct"),
        F.try_divide(F.col("short_rate_pct"), F.col(f"long_{rate}")).alias("rate_ratio"),
    )
