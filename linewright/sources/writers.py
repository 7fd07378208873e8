"""Sinks, table properties, and the change feed between two snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None, gather: bool = False) -> None:
    """Replace a table; its columns may differ from the earlier version. ``gather`` brings the
    rows of a partition value together first (large values stay split), for frames whose
    tasks each hold rows of every partition: fewer files for one more shuffle."""
    if gather and partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def overwrite_table(
    df: DataFrame,
    name: str,
    comment: str = "",
    properties: dict[str, object] | None = None,
    buckets: int = 0,
    bucket_by: list[str] | None = None,
) -> None:
    """Replace a catalogue table and describe it. Tables with the same ``buckets`` on the same
    columns join on them without a shuffle, as inspections and labels do on the unit."""
    writer = df.write.mode("overwrite")
    if buckets and bucket_by:
        df = df.repartition(buckets, *bucket_by)
        writer = df.write.mode("overwrite").bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)
    if comment:
        comment_table(df.sparkSession, name, comment)
    if properties:
        set_properties(df.sparkSession, name, properties)


def with_month_partitions(df: DataFrame, time: str) -> DataFrame:
    """Year and month columns for Hive-style directories, so that time filters prune files."""
    return df.withColumns({"year": F.year(time), "month": F.month(time)})


def stream_to_table(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: list[str] | None = None,
    every: str | None = None,
):
    """Append a stream to a table. Without ``every`` all files present are taken and the
    query ends; with it the query keeps running on that interval."""
    writer = df.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(path)


def changed_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows inserted (I), updated (U) or deleted (D) between two snapshots with unique keys.

    Values come from the newer snapshot, for deletions from the older one. Unchanged rows
    are left out. Comparison is null-safe and on the values themselves.
    """
    values = [c for c in new.columns if c not in keys]
    before = old.select(*keys, F.struct(*values).alias("_old"))
    after = new.select(*keys, F.struct(*values).alias("_new"))
    joined = before.join(after, keys, "full").withColumn(
        "op",
        F.when(F.col("_old").isNull(), "I")
        .when(F.col("_new").isNull(), "D")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "U"),
    )
    kept = F.coalesce("_new", "_old")
    return joined.filter(F.col("op").isNotNull()).select(
        *keys, "op", *[kept.getField(c).alias(c) for c in values]
    )


def apply_changes(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """The target snapshot after the changes of :func:`changed_rows`: untouched rows, plus the new
    values of inserted and updated ones. One shuffle of each side on the unique keys."""
    columns = target.columns
    values = [c for c in columns if c not in keys]
    old = target.select(*keys, F.struct(*values).alias("_old"))
    new = changes.select(*keys, "op", F.struct(*values).alias("_new"))
    now = F.when(F.col("op").isNull(), F.col("_old")).when(F.col("op") != "D", F.col("_new"))
    joined = old.join(new, keys, "full").withColumn("_now", now).filter(F.col("_now").isNotNull())
    return joined.select(*[c if c in keys else F.col(f"_now.{c}").alias(c) for c in columns])


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row per key; of rows that are equal in ``order`` one.

    The newest value of the first order column is a hash aggregate, combined before the shuffle, and joined back: one value per
    key, which Spark broadcasts when its size allows it. Only rows with that value are ranked by the other order columns, of which
    a task again sends one row per key.
    """
    first, *rest = order
    names = {k: f"_k{i}" for i, k in enumerate(keys)}
    tops = df.groupBy(*[F.col(k).alias(n) for k, n in names.items()]).agg(F.max(first).alias("_top"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()], F.col(first).eqNullSafe(F.col("_top")))
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in rest or [first]])
    ranked = df.join(tops, same, "left_semi").withColumn("_n", F.row_number().over(newest))
    return ranked.filter("_n = 1").drop("_n")


def export_examples(df: DataFrame, path: str, n: int) -> None:
    """A few example rows for a model signature."""
    df.limit(n).write.mode("overwrite").parquet(path)


def export_coefficients(df: DataFrame, path: str) -> None:
    """Coefficients by size as one CSV file (one row per feature)."""
    ordered = df.orderBy(F.abs("coefficient").desc(), "feature").coalesce(1)
    ordered.write.mode("overwrite").option("header", True).csv(path)


def _quoted(text: object) -> str:
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def set_properties(spark: SparkSession, table: str, properties: dict[str, object]) -> None:
    listed = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")


def get_properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def comment_table(spark: SparkSession, table: str, comment: str) -> None:
    spark.sql(f"COMMENT ON TABLE {table} IS {_quoted(comment)}")
