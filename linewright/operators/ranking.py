"""Cumulative sums, exact quantiles and ranks over a whole table without a one-task sort."""

from __future__ import annotations

import math
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Values of a range, and ranges whose totals are added up in one group.
RANGE_ROWS, FAN = 1_000_000, 1024


def cumulate(
    points: DataFrame, order: str, sums: list[str], descending: bool = False, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Add ``cum_<name>`` for each of ``sums``: its total over all rows up to and including this
    one in ``order``. ``points`` is a stored frame with one row per value of ``order``.

    A prefix sum on two levels. The rows are sorted over the cluster into ranges of about ``range_rows``, as many
    as that takes, and stored in this order. Each range is summed on its own. The totals of the ranges are summed in blocks
    of ``FAN`` ranges, and the totals of the blocks (one row for ``FAN * range_rows`` values) in one group. What
    precedes a range is joined back on its number.
    """
    ranges = max(1, math.ceil(points.count() / range_rows))
    along = F.col(order).desc() if descending else F.col(order).asc()
    placed = points.repartitionByRange(ranges, along).sortWithinPartitions(along)
    placed = materialize(placed.withColumn("_place", F.monotonically_increasing_id()), "ranges")
    placed = placed.withColumn("_range", F.shiftright("_place", 33))
    totals = placed.groupBy("_range").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    totals = totals.withColumn("_block", F.expr(f"_range div {FAN}"))

    def before(names: dict[str, str], window) -> dict[str, Column]:
        earlier = window.rowsBetween(Window.unboundedPreceding, -1)
        return {new: F.coalesce(F.sum(old).over(earlier), F.lit(0)) for new, old in names.items()}

    blocks = totals.groupBy("_block").agg(*[F.sum(f"_t_{c}").alias(f"_b_{c}") for c in sums])
    blocks = blocks.select("_block", *[v.alias(k) for k, v in before({f"_ob_{c}": f"_b_{c}" for c in sums}, Window.orderBy("_block")).items()])
    in_block = before({f"_or_{c}": f"_t_{c}" for c in sums}, Window.partitionBy("_block").orderBy("_range"))
    offsets = totals.withColumns(in_block).join(blocks, "_block")
    offsets = offsets.select("_range", *[(F.col(f"_ob_{c}") + F.col(f"_or_{c}")).alias(f"_o_{c}") for c in sums])
    within = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = placed.withColumns({f"cum_{c}": F.sum(c).over(within) for c in sums})
    joined = inner.join(offsets, "_range")
    return joined.select(*points.columns, *[(F.col(f"cum_{c}") + F.col(f"_o_{c}")).alias(f"cum_{c}") for c in sums])


# a gap of at most this many rows is a group that one task can count value by value; the result is the same at any number
FEW = 100_000


def exact_quantiles(df: DataFrame, wanted: dict[str, list[float]]) -> dict[str, list[float | None]]:
    """For each column and each ``p`` the smallest value with at least ``p * n`` values at or
    below it.

    Each quantile is held between two values and the gap is narrowed by sketches: one scan
    counts the rows beside and inside every gap, the next one sketches the inside. A scan
    shrinks a gap some thousandfold, so a few of them reach a gap whose values can be counted.
    Nothing is shuffled but sketches and those last counts.
    """
    value = {c: F.col(c).cast("double") for c in wanted}
    sizes = df.agg(*[F.count(c).alias(c) for c in wanted]).first()
    gaps = [
        _Gap(c, i, max(1, math.ceil(Fraction(str(p)) * sizes[c])))
        for c, ps in wanted.items()
        for i, p in enumerate(ps)
        if sizes[c]
    ]
    inside_rows = {id(g): sizes[g.column] for g in gaps}
    below = {id(g): 0 for g in gaps}
    while open_gaps := [g for g in gaps if g.answer is None]:
        wide = [g for g in open_gaps if inside_rows[id(g)] > FEW]
        if not wide:
            _count_out(df, value, open_gaps, below)
            break
        cells = []
        for k, g in enumerate(wide):
            share = (g.rank - below[id(g)]) / inside_rows[id(g)]
            ends = [max(share - 4 / _ACCURACY, 0.0), min(share + 4 / _ACCURACY, 1.0)]
            cells.append(F.percentile_approx(F.when(g.inside(value), value[g.column]), ends, _ACCURACY).alias(f"s{k}"))
        row = df.agg(*cells).first()
        for k, g in enumerate(wide):
            g.low, g.high = row[f"s{k}"]
        cells = []
        for k, g in enumerate(wide):
            v = value[g.column]
            for name, test in {"lt": v < g.low, "le": v <= g.low, "lh": v < g.high, "eh": v <= g.high}.items():
                cells.append(F.count_if(test).alias(f"{name}{k}"))
        row = df.agg(*cells).first()
        for k, g in enumerate(wide):
            lt, le, lh, eh = (row[f"{n}{k}"] for n in ("lt", "le", "lh", "eh"))
            if not lt < g.rank <= eh:
                raise RuntimeError(f"quantile of {g.column} left its gap")
            if g.rank <= le:
                g.answer = g.low
            elif g.rank > lh:
                g.answer = g.high
            below[id(g)], inside_rows[id(g)] = le, lh - le
    out: dict[str, list[float | None]] = {c: [None] * len(ps) for c, ps in wanted.items()}
    for g in gaps:
        out[g.column][g.index] = g.answer
    return out


_ACCURACY = 10_000


@dataclass
class _Gap:
    """The open interval that holds one quantile."""

    column: str
    index: int
    rank: int
    low: float | None = None
    high: float | None = None
    answer: float | None = None

    def inside(self, value: dict[str, Column]) -> Column:
        v = value[self.column]
        if self.low is None:
            return v.isNotNull()
        return (v > self.low) & (v < self.high)


def _count_out(df: DataFrame, value: dict[str, Column], gaps: list[_Gap], below: dict[int, int]) -> None:
    """Answer gaps of at most ``FEW`` rows: their values are counted and summed up on the cluster, each gap a
    group, and one row for each gap comes back."""
    cells = [
        F.struct(
            F.lit(k).alias("k"),
            F.lit(g.rank - below[id(g)]).cast("long").alias("rank"),
            F.when(g.inside(value), value[g.column]).alias("v"),
        )
        for k, g in enumerate(gaps)
    ]
    each = df.select(F.explode(F.filter(F.array(*cells), lambda c: c["v"].isNotNull())).alias("c"))
    counts = each.groupBy("c.k", "c.rank", "c.v").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("k").orderBy("v"))
    answers = counts.withColumn("seen", upto).filter("seen >= rank").groupBy("k").agg(F.min("v").alias("v"))
    for row in answers.collect():
        gaps[row["k"]].answer = row["v"]
