"""Feature preparation in columnar form: fit on one frame, apply to any.

Fitted numbers are one per column, so fitting returns plain Python values and applying them adds no
shuffle. Categories may be many; they are a table and are joined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .ranking import exact_quantiles

# Bucket limits for transaction amounts, and the variance limit.
AMOUNT_SPLITS = [0.0, 50.0, 200.0, 1000.0, float("inf")]
VARIANCE_THRESHOLD = 0.01


def fit_imputer(
    df: DataFrame, columns: list[str], strategy: str = "median", accuracy: int = 10_000, exact: bool = False
) -> dict[str, float]:
    """Median or mean of each column, all in one job (exact medians take a few).
    A column without values gets no entry and stays as it is."""
    if strategy == "median" and exact:
        values = {c: found[0] for c, found in exact_quantiles(df, {c: [0.5] for c in columns}).items()}
    else:
        measure = (lambda c: F.percentile_approx(c, 0.5, accuracy)) if strategy == "median" else F.avg
        values = df.agg(*[measure(F.col(c).cast("double")).alias(c) for c in columns]).first().asDict()
    return {c: v for c, v in values.items() if v is not None}


def impute(df: DataFrame, values: dict[str, float], columns: list[str]) -> DataFrame:
    """Fill the columns and rename each to ``<name>_imp``; other columns are unchanged."""
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(values.get(c))) for c in columns}
    return df.select(*[filled[c].alias(f"{c}_imp") if c in filled else F.col(c) for c in df.columns])


@dataclass(frozen=True)
class Categories:
    """Known values of columns: a table (column_name, category, idx) over written counts, and how many each column has."""

    table: DataFrame
    sizes: dict[str, int]


def fit_categories(df: DataFrame, columns: list[str], order: str = "frequency") -> Categories:
    """Known values of each column, numbered by falling frequency (ties alphabetical) or alphabetically.

    All columns are counted in one job, whatever the number of values. The counts are sorted over the
    cluster and written once; a value's number is its place in its part plus the sizes of the parts
    before. The driver gets one number for each column.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]))
    counts = df.select(pairs.alias("p")).select("p.c", "p.v").filter("v IS NOT NULL").groupBy("c", "v").count()
    by = [F.col("c"), *([F.col("count").desc()] if order == "frequency" else []), F.col("v")]
    ordered = counts.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    ordered = materialize(ordered.select("c", "v", F.shiftright("at", 33).alias("part"), F.expr("at & 8589934591").alias("at")), "counts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skipped"))
    placed = ordered.join(parts, "part").select("c", "v", (F.col("skipped") + F.col("at")).alias("place"))
    first = placed.groupBy("c").agg(F.min("place").alias("first"))
    idx = (F.col("place") - F.col("first")).cast("double")
    found = placed.join(first, "c").select(F.col("c").alias("column_name"), F.col("v").alias("category"), idx.alias("idx"))
    sizes = {r["c"]: r["count"] for r in ordered.groupBy("c").count().collect()}
    return Categories(found, {c: sizes.get(c, 0) for c in columns})


def index_categories(df: DataFrame, categories: Categories) -> DataFrame:
    """Add ``<name>_idx``; values not seen at fit time and NULL get the next free index. No hint: Spark
    broadcasts the categories when the size of their table allows it."""
    for name, size in categories.sizes.items():
        known = categories.table.filter(F.col("column_name") == name).select(F.col("category").alias("_v"), F.col("idx").alias("_idx"))
        joined = df.join(known, F.col(name).cast("string") == F.col("_v"), "left")
        df = joined.withColumn(f"{name}_idx", F.coalesce("_idx", F.lit(float(size)))).drop("_v", "_idx")
    return df


def one_hot(df: DataFrame, categories: Categories, drop_last: bool = True) -> DataFrame:
    """Add ``<name>_ohe`` for every indexed column, as a sparse row: its number of slots, the slot that is 1.0 and its value. A row
    of the last category (when dropped) or of an unseen value has no slot. One expression per column, however many
    categories it has; the form is that of a sparse vector."""
    columns: dict[str, Column] = {}
    for name, size in categories.sizes.items():
        slots = size - (1 if drop_last and size else 0)
        slot = F.col(f"{name}_idx").cast("int")
        set_ = F.coalesce(slot < slots, F.lit(False))
        columns[f"{name}_ohe"] = F.struct(
            F.lit(slots).alias("size"),
            F.when(set_, F.array(slot)).otherwise(F.array().cast("array<int>")).alias("indices"),
            F.when(set_, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"),
        )
    return df.withColumns(columns)


def bucketize(df: DataFrame, column: str, out: str, splits: list[float]) -> DataFrame:
    """Index of the half-open bucket [low, high); NULL and NaN go to one bucket after the last.
    A value outside all buckets fails the job."""
    valued = df.withColumn("_v", F.coalesce(F.col(column).cast("double"), F.lit(float("nan"))))
    return Bucketizer(splits=splits, inputCol="_v", outputCol=out, handleInvalid="keep").transform(valued).drop("_v")


def fit_quantile_splits(
    df: DataFrame, column: str, buckets: int = 4, relative_error: float = 0.01, exact: bool = False
) -> list[float]:
    """Bucket limits at the quantiles of a column, open at both ends; equal limits merge."""
    probabilities = [i / buckets for i in range(1, buckets)]
    if exact:
        inner = exact_quantiles(df, {column: probabilities})[column]
    else:
        value = F.col(column).cast("double")
        inner = df.agg(F.percentile_approx(value, probabilities, int(1 / relative_error)).alias("q")).first()["q"]
    return [float("-inf"), *sorted({q for q in inner or [] if q is not None}), float("inf")]


def binarize(df: DataFrame, column: str, out: str, threshold: float) -> DataFrame:
    return df.withColumn(out, (F.col(column) > threshold).cast("double"))


def column_moments(df: DataFrame, columns: list[str]) -> dict[str, dict[str, float]]:
    """Sample deviation, mean, minimum and maximum of each column, in one job."""
    measures = {"std": F.stddev_samp, "mean": F.avg, "min": F.min, "max": F.max}
    cells = [f(F.col(c).cast("double")).alias(f"{m}_{i}") for i, c in enumerate(columns) for m, f in measures.items()]
    row = df.agg(*cells).first()
    return {c: {m: row[f"{m}_{i}"] for m in measures} for i, c in enumerate(columns)}


def standard_scale(df: DataFrame, moments: dict[str, dict[str, float]], with_mean: bool = False) -> DataFrame:
    """Divide by the sample deviation (0 where there is none), optionally centred; ``<name>_std``."""
    scaled = {}
    for c, m in moments.items():
        value = F.col(c) - m["mean"] if with_mean else F.col(c)
        scaled[f"{c}_std"] = value / F.lit(m["std"]) if m["std"] else F.when(value.isNotNull(), 0.0)
    return df.withColumns(scaled)


def minmax_scale(df: DataFrame, moments: dict[str, dict[str, float]], low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Map the fitted range onto [low, high], a constant column onto the middle; ``<name>_mm``."""
    scaled = {}
    for c, m in moments.items():
        spread = (m["max"] or 0.0) - (m["min"] or 0.0)
        if spread:
            scaled[f"{c}_mm"] = (F.col(c) - m["min"]) / F.lit(spread) * (high - low) + low
        else:
            scaled[f"{c}_mm"] = F.when(F.col(c).isNotNull(), (low + high) / 2)
    return df.withColumns(scaled)


def normalize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Scale each row to unit length over the columns; a zero row stays zero; ``<name>_l2``."""
    length = F.sqrt(sum((F.col(c) * F.col(c) for c in columns), F.lit(0.0)))
    scaled = {f"{c}_l2": F.when(F.col("_len") > 0, F.col(c) / F.col("_len")).otherwise(F.col(c)) for c in columns}
    return df.withColumn("_len", length).withColumns(scaled).drop("_len")


def variance_profile(df: DataFrame, columns: list[str], threshold: float = VARIANCE_THRESHOLD) -> DataFrame:
    """Sample variance of each column and whether it exceeds the threshold, in one pass."""
    cells = [F.var_samp(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(columns)]
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"v{i}").alias("variance"),
            F.coalesce(F.col(f"v{i}") > threshold, F.lit(False)).alias("kept"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*cells).select(F.inline(F.array(*rows)))


def assemble(df: DataFrame, columns: list[str], out: str) -> DataFrame:
    """The columns as one array, NULL as 0."""
    return df.withColumn(out, F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns]))
