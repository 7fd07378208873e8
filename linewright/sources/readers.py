"""Batch and streaming readers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import RESCUED, catalog_schema, event_schema


def with_audit(df: DataFrame) -> DataFrame:
    """Arrival time and source file of every record."""
    return df.withColumns(
        {"ingestion_timestamp": F.current_timestamp(), "source_file": F.col("_metadata.file_path")}
    )


def _headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files of a folder by their first line. One line per file reaches the driver; the files are small and few."""
    text = F.decode(F.col("content"), "UTF-8")
    first = F.regexp_replace(F.substring_index(text, "\n", 1), "[\uFEFF\r]", "")
    files = spark.read.format("binaryFile").load(path)
    found: dict[str, list[str]] = {}
    for row in files.filter("length > 0").select("path", first.alias("header")).collect():
        found.setdefault(row["header"], []).append(row["path"])
    return found


def read_catalog(spark: SparkSession, name: str, path: str) -> DataFrame:
    """One of the small CSV catalogues, read whole on every run. In each file columns are found by its own header,
    in any order; one that is missing is an error, a value that does not fit its type is NULL."""
    schema = catalog_schema(name)
    typed = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    # Spark takes the header of one file for all, so files with different headers are read apart
    alike = list(_headers(spark, path).values()) or [[path]]
    parts = [with_audit(spark.read.option("header", True).csv(files)).select(*typed, "ingestion_timestamp", "source_file") for files in alike]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _json_options(reader, schema: StructType):
    reader = reader.schema(schema).option("recursiveFileLookup", "true")
    if RESCUED in schema.fieldNames():
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RESCUED)
    return reader


def read_events(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Event files as a bounded frame. A record that does not fit keeps its good fields
    and its raw text in ``_rescued_data``."""
    return with_audit(_json_options(spark.read, event_schema(name)).json(path))


def stream_events(
    spark: SparkSession,
    name: str,
    path: str,
    schema: StructType | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Event files as a stream; the query's checkpoint makes each file count once."""
    reader = _json_options(spark.readStream, schema or event_schema(name))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_audit(reader.json(path))


def append_flows(*flows: DataFrame) -> DataFrame:
    """Several sources feeding one table. A file sink belongs to one query, so the
    flows are united ahead of it."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), flows)


def infer_schema(spark: SparkSession, sample_path: str, schema_path: str) -> StructType:
    """Infer the column types of JSON files once and keep them for later runs."""
    schema = spark.read.option("recursiveFileLookup", "true").json(sample_path).schema
    spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").text(schema_path)
    return schema


def load_schema(spark: SparkSession, schema_path: str) -> StructType:
    import json

    return StructType.fromJson(json.loads(spark.read.text(schema_path, wholetext=True).first()[0]))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def stream_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A table written earlier, as a stream of its new files."""
    return spark.readStream.schema(schema or spark.read.parquet(path).schema).parquet(path)
