"""Drift of features and scores against a baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sketches import merged_sketches, quantile_sketches, sketch_quantiles


def fit_edges(baseline: DataFrame, columns: list[str], bins: int = 10, by: list[str] | None = None) -> dict[str, list[float]]:
    """Inner bin limits at the baseline's quantiles, from one mergeable sketch per column (and value of ``by``, if given), right to
    a fraction of a percent of the rows; for all columns in one job."""
    sketches = merged_sketches(quantile_sketches(baseline, columns, by), columns)
    found = sketch_quantiles(sketches, {c: [i / bins for i in range(1, bins)] for c in columns})
    return {c: sorted(set(values)) for c, values in found.items()}


def binned_shares(tagged: DataFrame, current: str, edges: dict[str, list[float]]) -> DataFrame:
    """Baseline and current share per feature and bin, each count raised by one so that no
    share is zero. ``current`` is a boolean column; bins are [low, high), NULL values are not
    counted. One aggregate counts the rows at or above each limit, so a task sends one row whatever it reads; a bin's
    count is the difference of two of these."""
    cells, bins = [], []
    now = F.col(current)
    for i, (name, inner) in enumerate(edges.items()):
        value = F.col(name).cast("double")
        for j, test in enumerate([value.isNotNull(), *[value >= e for e in inner]]):
            cells += [F.count_if(test & ~now).alias(f"b{i}_{j}"), F.count_if(test & now).alias(f"c{i}_{j}")]
        for j in range(len(inner) + 1):
            less = [F.col(f"{s}{i}_{j + 1}") if j < len(inner) else F.lit(0) for s in "bc"]
            base, cur = (F.col(f"{s}{i}_{j}") - n for s, n in zip("bc", less))
            bins.append(F.struct(F.lit(name).alias("feature"), F.lit(j).alias("bin"), base.alias("base"), cur.alias("cur")))
    dense = tagged.agg(*cells).select(F.inline(F.array(*bins)))
    one = Window.partitionBy("feature")
    share = lambda c: (F.col(c) + 1) / F.sum(F.col(c) + 1).over(one)
    return dense.select("feature", "bin", share("base").alias("base_share"), share("cur").alias("cur_share"))


def drift(tagged: DataFrame, current: str, edges: dict[str, list[float]]) -> DataFrame:
    """Population stability index and binned Kolmogorov-Smirnov distance per feature."""
    shares = binned_shares(tagged, current, edges)
    upto = Window.partitionBy("feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base, cur = F.col("base_share"), F.col("cur_share")
    gap = F.abs(F.sum(cur - base).over(upto))
    return (
        shares.withColumn("gap", gap)
        .groupBy("feature")
        .agg(F.sum((cur - base) * F.log(cur / base)).alias("psi"), F.max("gap").alias("ks"))
    )
