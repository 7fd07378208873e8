"""Run registered queries beside their SQL: python tests/oracle_check.py <folder> [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def sql_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    return None if value is None else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) or "" for i in order) for r in rows)


def compare(spark, con, folder, name, function, sql) -> str | None:
    """None when equal, else what differs."""
    ours = function(spark, folder)
    got = [tuple(r) for r in ours.collect()]
    if not sql:
        return None if got else "no rows"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(ours.columns):
        return f"columns {sorted(ours.columns)} and {sorted(names)}"
    a, b = _rows(ours.columns, got), _rows(names, want)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        return f"rows {len(a)} and {len(b)}; {len(only_a)} only here {only_a[:3]}; only there {only_b[:3]}"
    kinds = {d[0]: str(d[1]) for d in result.description}
    for field in ours.schema.fields:
        spark_kind, sql_kind = field.dataType.simpleString(), kinds[field.name]
        pairs = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
        if pairs.get(spark_kind, sql_kind) != sql_kind:
            return f"type of {field.name}: {spark_kind} and {sql_kind}"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", os.environ.get("SHUFFLE", "8"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = sql_connection(folder), oracle_sql()
    bad = 0
    for name, function in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, folder, name, function, sql.get(name))
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        mark = "ok" if problem is None else "BAD"
        print(f"{mark:4}{name:24}{time.time() - start:6.2f}s {'' if name in sql else '(rows only) '}{problem or ''}")
    print("bad:", bad)


if __name__ == "__main__":
    main()
