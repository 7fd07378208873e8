"""Splits by time, class weights, sampling, column routing and quality reports."""

from __future__ import annotations

import calendar
from collections.abc import Collection
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType, StructField, StructType

# Split shares and window lengths.
TRAIN_SHARE = 0.70
VALIDATION_SHARE = 0.15
TRAINING_WINDOW_MONTHS = 24
VALIDATION_WINDOW_MONTHS = 6


def minus_months(moment: datetime, months: int) -> datetime:
    """The same day ``months`` earlier, or that month's last day."""
    index = moment.year * 12 + moment.month - 1 - months
    year, month = divmod(index, 12)
    day = min(moment.day, calendar.monthrange(year, month + 1)[1])
    return moment.replace(year=year, month=month + 1, day=day)


def time_bounds(df: DataFrame, time: str) -> DataFrame:
    return df.agg(F.min(time).alias("min_time"), F.max(time).alias("max_time"))


@dataclass(frozen=True)
class SplitPlan:
    """Train is [train_start, train_end], validation (train_end, validation_end], test the rest:
    no instant falls between two parts."""

    train_start: datetime
    train_end: datetime
    validation_end: datetime


def share_split(df: DataFrame, time: str, months: int = TRAINING_WINDOW_MONTHS) -> SplitPlan:
    """First-version split: shares of the date range in whole days, training capped to the
    last ``months`` before its end."""
    low, high = time_bounds(df, time).first()
    days = (high - low).days
    train_end = low + timedelta(days=int(TRAIN_SHARE * days))
    validation_end = train_end + timedelta(days=int(VALIDATION_SHARE * days))
    return SplitPlan(minus_months(train_end, months), train_end, validation_end)


def rolling_split(
    previous_max: datetime,
    validation_months: int = VALIDATION_WINDOW_MONTHS,
    training_months: int = TRAINING_WINDOW_MONTHS,
) -> SplitPlan:
    """Later-version split: validation ends where the earlier data ended, test is newer."""
    train_end = minus_months(previous_max, validation_months)
    return SplitPlan(minus_months(train_end, training_months), train_end, previous_max)


def split_column(df: DataFrame, time: str, plan: SplitPlan) -> Column:
    kind = df.schema[time].dataType
    at = lambda moment: F.lit(moment.isoformat(sep=" ")).cast(kind)
    t = F.col(time)
    return (
        F.when(t < at(plan.train_start), "before_window")
        .when(t <= at(plan.train_end), "train")
        .when(t <= at(plan.validation_end), "validation")
        .when(t.isNotNull(), "test")
    )


def tag_split(df: DataFrame, time: str, plan: SplitPlan) -> DataFrame:
    return df.withColumn("split", split_column(df, time, plan))


def calendar_split(df: DataFrame, time: str, last_train_year: int, last_validation_year: int) -> DataFrame:
    year = F.year(time)
    tag = F.when(year <= last_train_year, "train").when(year <= last_validation_year, "validation")
    return df.withColumn("split", tag.when(year.isNotNull(), "test"))


TRAIN_MODES = {
    "train": ["train"],
    "train_val": ["train", "validation"],
    "train_val_test": ["train", "validation", "test"],
}


def training_rows(tagged: DataFrame, mode: str) -> DataFrame:
    """The parts that a training mode uses, by one filter on the tag."""
    return tagged.filter(F.col("split").isin(TRAIN_MODES[mode]))


def rows_by_mode(tagged: DataFrame) -> DataFrame:
    """Every training mode's rows under a ``mode`` column, from one scan."""
    used = {part: [m for m, parts in TRAIN_MODES.items() if part in parts] for part in ("train", "validation", "test")}
    modes = F.array().cast("array<string>")
    for part, names in used.items():
        modes = F.when(F.col("split") == part, F.array(*[F.lit(n) for n in names])).otherwise(modes)
    return tagged.withColumn("mode", F.explode(modes))


def split_report(tagged: DataFrame, time: str, label: str) -> DataFrame:
    """Bounds, rows and defect rate of each part, in one pass."""
    return tagged.groupBy("split").agg(
        F.min(time).alias("min_time"),
        F.max(time).alias("max_time"),
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.col(label).cast("double")).alias("label_rate"),
    )


def with_class_weights(df: DataFrame, label: str, weight: str = "class_weight") -> DataFrame:
    """Labelled rows with weight ``n / (2 n_class)``, 1 for a class without rows."""
    labelled = df.filter(F.col(label).isNotNull())
    n, bad = labelled.agg(F.count(F.lit(1)), F.count_if(F.col(label) == 1)).first()
    weigh = lambda size: n / (2.0 * size) if size else 1.0
    return labelled.withColumn(
        weight, F.when(F.col(label) == 1, F.lit(weigh(bad))).otherwise(F.lit(weigh(n - bad)))
    )


def weight_report(weighted: DataFrame, label: str, weight: str = "class_weight") -> DataFrame:
    return (
        weighted.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(weight).alias("mean_weight")).orderBy(label)
    )


def stratified_sample(df: DataFrame, label: str, target: int, key: list[str], seed: int = 42) -> DataFrame:
    """About ``target`` of the rows with a label (0 or 1), drawn by a digest of their key at one rate,
    so each class keeps its share. Fewer labelled rows than ``target`` are all taken."""
    classes = df.agg(F.count_if(F.col(label).isin(0, 1)).alias("labelled")).first()
    return keyed_sample(df, label, key, min(1.0, target / max(1, classes["labelled"])), seed)


def keyed_sample(df: DataFrame, label: str, key: list[str], fraction: float, seed: int = 42) -> DataFrame:
    """A share of the labelled rows chosen by a digest of their key: the same rows in any
    partitioning and on every retry."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])
    place = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return df.filter(F.col(label).isin(0, 1) & (place < int(fraction * 2**32)))


def oversample(df: DataFrame, label: str, minority: int, times: int) -> DataFrame:
    """Each minority row ``times`` times, others once, in one scan."""
    copies = F.when(F.col(label) == minority, times).otherwise(1)
    repeated = F.explode(F.sequence(F.lit(1), copies)).alias("copy")
    return df.select("*", repeated)


# Columns that are never features.
NEVER_FEATURES = [
    "is_defective",
    "unit_id",
    "machine_id",
    "line_id",
    "supplier_id",
    "material_batch_id",
    "timestamp",
    "ingestion_timestamp",
]


@dataclass(frozen=True)
class Routes:
    numeric: list[str]
    boolean: list[str]
    categorical: list[str]


def _route(field: StructField, flags: Collection[str]) -> str | None:
    """The route of a column by its place in Spark's type hierarchy; None for types that are no features."""
    if field.name in flags:
        return "boolean"
    bases = {BooleanType: "boolean", NumericType: "numeric", StringType: "categorical"}
    return next((route for base, route in bases.items() if isinstance(field.dataType, base)), None)


def route_columns(schema: StructType, exclude=tuple(NEVER_FEATURES), flags=()) -> Routes:
    """Sort the feature columns by type: numbers of any width, booleans, strings. ``flags`` are 0/1
    numbers to treat as booleans."""
    by_name = {f.name: _route(f, flags) for f in schema.fields if f.name not in exclude}
    return Routes(**{kind: [n for n, route in by_name.items() if route == kind] for kind in ("numeric", "boolean", "categorical")})


# Name prefixes of aggregates that start at zero and of those that may be absent.
ZERO_PREFIXES = ("count_", "sum_", "num_fraud_", "spend_", "distinct_")
NULL_PREFIXES = ("avg_", "max_amount", "min_amount")


def group_by_prefix(columns: list[str]) -> dict[str, list[str]]:
    """Zero-filled aggregates need no imputation; absent ones and plain columns do."""
    groups: dict[str, list[str]] = {"zero": [], "absent": [], "plain": []}
    for name in columns:
        kind = "zero" if name.startswith(ZERO_PREFIXES) else "absent" if name.startswith(NULL_PREFIXES) else "plain"
        groups[kind].append(name)
    return groups


def null_profile(df: DataFrame) -> DataFrame:
    """NULLs and rows per column, counted in one pass."""
    counts = [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    rows = [
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_rows"), F.col("total").alias("total_rows")
        )
        for i, c in enumerate(df.columns)
    ]
    return df.agg(F.count(F.lit(1)).alias("total"), *counts).select(F.inline(F.array(*rows)))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))


def summary(df: DataFrame, unit: str, label: str, score: str) -> DataFrame:
    """Rows, distinct units, defect rate and score bounds of a table."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct(unit).alias("unique_units"),
        F.round(F.avg(F.col(label).cast("double")), 4).alias("defect_rate"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
    )


def checks(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Named aggregate conditions as rows ``check, passed``, evaluated in one pass."""
    cells = [c.alias(f"c{i}") for i, c in enumerate(conditions.values())]
    rows = [
        F.struct(F.lit(name).alias("check_name"), F.coalesce(F.col(f"c{i}"), F.lit(False)).alias("passed"))
        for i, name in enumerate(conditions)
    ]
    return df.agg(*cells).select(F.inline(F.array(*rows)))
