"""A small file that names the current version of something, replaced in one step."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return files, files.makeQualified(place)


def point(spark: SparkSession, path: str, target: str) -> None:
    """Make ``path`` name ``target``. Written beside it and renamed over it, so a reader finds the old name or the new one."""
    files, place = _place(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}-{uuid.uuid4().hex}")
    out = files.create(draft, True)
    out.write(bytearray(target.encode()))
    out.close()
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(draft, place, over)


def pointed(spark: SparkSession, path: str) -> str | None:
    """What ``path`` names, or None if it was never set."""
    files, place = _place(spark, path)
    if not files.exists(place):
        return None
    source = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    files, place = _place(spark, path)
    files.delete(place, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it is not there."""
    files, place = _place(spark, path)
    return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []
