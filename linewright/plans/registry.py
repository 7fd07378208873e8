"""Registered queries, each with the SQL that has to give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# lineitem stands for inspections: a returned line is a defect, N is not labelled yet
def line_label() -> Column:
    flag = F.col("l_returnflag")
    return F.when(flag == "R", 1).when(flag == "A", 0)


LINE_LABEL = "CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END"


# events stand for sensor readings of a user's machine; views and signups are not labelled
def event_label() -> Column:
    kind = F.col("event_type")
    return F.when(kind == "error", 1).when(kind.isin("purchase", "click"), 0)


EVENT_LABEL = "CASE WHEN event_type = 'error' THEN 1 WHEN event_type IN ('purchase', 'click') THEN 0 END"


def labelled_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").withColumn("label", line_label())


def labelled_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").withColumn("label", event_label())
