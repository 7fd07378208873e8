"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import os
import sys
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linewright.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Rows of an Arrow batch of texts, and the setting that bounds it.
BATCH_ROWS = 2000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: The folder that holds the package.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and the SQL that has to give its rows."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            reach(spark)
            return function(spark, folder)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


def reach(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package; a cluster has it installed or shipped."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, ROOT) if x)


def small_batches(spark: SparkSession) -> None:
    """From now on Spark and its Python workers exchange BATCH_ROWS rows at a time at most in this session (Spark's own limit is 10,000).

    For jobs on whole texts: Spark and the worker hold each batch several times, and keep the buffers.
    """
    now = int(spark.conf.get(BATCH_SETTING))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text, where null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def free_name(taken: Iterable[str], name: str) -> str:
    """`name`, or with as many underscores before it as it takes to clash with no other column."""
    taken = {x.lower() for x in taken}
    while name.lower() in taken:
        name = "_" + name
    return name


def bucket_of(key: str, modulus: int) -> Column:
    """crc32 of a key written as text, modulo: which fold a row is in. A null key counts as empty."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def materialize(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write a frame below the shared folder and read it back; within `dropping`, the table goes at its end unless kept."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    if not keep and (tables := _written.get()) is not None:
        tables.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def dropping(spark: SparkSession) -> Iterator[None]:
    """Tables that are written inside are deleted at the end."""
    token = _written.set([])
    try:
        yield
    finally:
        for path in _written.get():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        _written.reset(token)


def give_back() -> None:
    """At a task's end: memory that this Python worker's allocators hold free goes back, as the worker waits for other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def make_room(own: str = "") -> None:
    """At a task's start: tables that tasks of modules other than `own` have left in this Python worker go."""
    left = [m for name in ("tokens", "bpe") if name != own and (m := sys.modules.get(f"{__package__}.{name}")) and m.holds()]
    for module in left:
        module.forget()
    if left:
        give_back()
