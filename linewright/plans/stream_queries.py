"""Streaming queries: each takes the table as a stream, runs to its end, and reads its sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.rules import flag_quarantine
from ..session import scratch_path
from ..streaming import labelled_stream, run_to_end, windowed_stream
from .registry import LINE_LABEL, event_label, line_label, query, table
from .table_queries import LINE_RULES
from .window_queries import _window_sql


def _stream(spark, folder, name):
    schema = table(spark, folder, name).schema
    # a stream needs a folder or a pattern; this one matches the table alone, be it one file or a folder of files
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]")


def _finished(df, name, partition_by=None):
    path = scratch_path(df.sparkSession, name)
    run_to_end(df, f"{path}/rows", f"{path}/checkpoint", partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")


def _zone_free(df, *names):
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


@query(
    "stream_window_24h",
    f"""SELECT * FROM ({_window_sql("24 hours")})
    WHERE window_end <= (SELECT max(ts) - INTERVAL '2 hours' FROM events)""",
)
def _(spark, folder):
    events = _stream(spark, folder, "events").withColumn("label", event_label())
    windows = windowed_stream(events, ["user_id"], "ts", "24 hours", ["value"], "label", digits=2)
    return _zone_free(_finished(windows, "windows"), "window_start", "window_end")


_SIX = "time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01') - k * INTERVAL '6 hours'"


@query(
    "stream_window_sliding",
    f"""WITH w AS (SELECT user_id, value, {_SIX} AS s FROM events, range(4) t(k))
    SELECT user_id, s AS window_start, s + INTERVAL '24 hours' AS window_end,
      sum(cast(round(value * 100) AS BIGINT))::BIGINT::DOUBLE / 100.0::DOUBLE / count(value) AS avg_value,
      count(*) AS inspection_count FROM w GROUP BY 1, 2, 3
    HAVING s + INTERVAL '24 hours' <= (SELECT max(ts) - INTERVAL '2 hours' FROM events)""",
)
def _(spark, folder):
    events = _stream(spark, folder, "events")
    windows = windowed_stream(events, ["user_id"], "ts", "24 hours", ["value"], digits=2, slide="6 hours")
    return _zone_free(_finished(windows, "sliding"), "window_start", "window_end")


@query(
    "stream_quarantine",
    f"""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE NOT coalesce({" AND ".join(f"({r.constraint})" for r in LINE_RULES)}, false)""",
)
def _(spark, folder):
    flagged = flag_quarantine(_stream(spark, folder, "lineitem"), LINE_RULES)
    kept = flagged.select("l_orderkey", "l_linenumber", "l_quantity", "is_quarantined")
    split = _finished(kept, "quarantine", ["is_quarantined"])
    return split.filter(F.col("is_quarantined")).drop("is_quarantined")


@query(
    "stream_interval_join",
    f"""WITH j AS (SELECT o_orderkey AS unit_id, o_orderdate AS timestamp, l_shipdate AS label_available_date,
        {LINE_LABEL} AS is_defective, l_orderkey IS NOT NULL AS matched
      FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
        AND l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL '30 days'),
    w AS (SELECT least((SELECT max(o_orderdate) FROM orders), (SELECT max(l_shipdate) FROM lineitem))
      - INTERVAL '30 days' AS mark)
    SELECT unit_id, timestamp, label_available_date, is_defective FROM j, w
    WHERE matched OR timestamp + INTERVAL '30 days' < mark""",
)
def _(spark, folder):
    units = _stream(spark, folder, "orders").select(
        F.col("o_orderkey").alias("unit_id"), F.col("o_orderdate").alias("timestamp")
    )
    labels = _stream(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("unit_id"),
        line_label().alias("is_defective"),
        F.col("l_shipdate").alias("label_available_date"),
    )
    joined = _finished(labelled_stream(units, labels), "labelled").drop("join_timestamp")
    return _zone_free(joined, "timestamp", "label_available_date")
