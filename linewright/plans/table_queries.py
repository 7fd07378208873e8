"""Scans, change feed, projections, rules and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import as_fixed, as_flag, parse_timestamp
from ..operators.joins import lookup
from ..operators.profiles import profile
from ..operators.rules import Rule, flag_quarantine, rule_violations
from ..session import scratch_path
from ..sources import append_flows, apply_changes, changed_rows, fingerprint, latest_per_key, overwrite_snapshot, snapshot_changes
from .registry import LINE_LABEL, labelled_lines, query, table


@query(
    "scan_filter_project",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
    WHERE l_quantity >= 25 AND l_discount BETWEEN 0.02 AND 0.08""",
)
def _(spark, folder):
    kept = (F.col("l_quantity") >= 25) & F.col("l_discount").between(0.02, 0.08)
    return (
        table(spark, folder, "lineitem").filter(kept).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    )


@query(
    "append_flows",
    """SELECT event_id, ts, value, props FROM events WHERE ts < TIMESTAMP '2024-01-16'
    UNION ALL SELECT event_id, ts, value, NULL FROM events WHERE ts >= TIMESTAMP '2024-01-16'""",
)
def _(spark, folder):
    events = table(spark, folder, "events")
    history = events.filter("ts < TIMESTAMP_NTZ '2024-01-16'").select("event_id", "ts", "value", "props")
    buffer = events.filter("ts >= TIMESTAMP_NTZ '2024-01-16'").select("event_id", "ts", "value")
    return append_flows(history, buffer)


def _user_totals(events):
    return events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"), F.sum(as_fixed("value", 2)).alias("total_cents"))


_OLD = "2024-01-15"


def _snapshots(spark, folder):
    """Totals per user of the events before a day, and of all."""
    events = table(spark, folder, "events")
    return _user_totals(events.filter(F.col("ts") < F.lit(_OLD).cast("timestamp_ntz"))), _user_totals(events)


_TOTALS = """SELECT user_id, count(*) AS n_events, sum(cast(round(value * 100) AS BIGINT))::BIGINT AS total_cents
      FROM events {} GROUP BY 1"""


@query(
    "changed_rows",
    f"""WITH a AS ({_TOTALS.format(f"WHERE ts < TIMESTAMP '{_OLD}'")}), b AS ({_TOTALS.format("")})
    SELECT coalesce(a.user_id, b.user_id) AS user_id,
      CASE WHEN a.user_id IS NULL THEN 'I' WHEN b.user_id IS NULL THEN 'D' ELSE 'U' END AS op,
      coalesce(b.n_events, a.n_events) AS n_events, coalesce(b.total_cents, a.total_cents) AS total_cents
    FROM a FULL JOIN b ON a.user_id = b.user_id
    WHERE a.user_id IS NULL OR b.user_id IS NULL OR a.n_events <> b.n_events OR a.total_cents <> b.total_cents""",
)
def _(spark, folder):
    return changed_rows(*_snapshots(spark, folder), ["user_id"])


@query("apply_changes", _TOTALS.format(""))
def _(spark, folder):
    old, new = _snapshots(spark, folder)
    return apply_changes(old, changed_rows(old, new, ["user_id"]), ["user_id"])


_SPOILT = "event_id % 40 = 0 AND day(ts) % 9 = 0"


@query(
    "snapshot_changes",
    f"""SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-25' THEN 'I' ELSE 'U' END AS op, user_id, event_type,
      cast(round(value * 100) AS BIGINT) AS cents, day(ts)::INTEGER AS day FROM events
    WHERE ts >= TIMESTAMP '2024-01-25' OR ({_SPOILT})""",
)
def _(spark, folder):
    """An older snapshot lacks the last days and has other values on some days; only days whose digests differ are read."""
    events = table(spark, folder, "events")
    rows = events.select("event_id", "user_id", "event_type", as_fixed("value", 2).alias("cents"), F.dayofmonth("ts").alias("day"), "ts")
    cents = F.when(F.expr(_SPOILT), F.col("cents") + 1).otherwise(F.col("cents"))
    before = rows.filter("ts < TIMESTAMP_NTZ '2024-01-25'").withColumn("cents", cents)
    paths = []
    for name, snapshot in (("old", before), ("new", rows)):
        paths.append(scratch_path(spark, f"events-{name}"))
        overwrite_snapshot(snapshot.drop("ts"), paths[-1], ["day"])
    return snapshot_changes(spark, *paths, ["event_id"], ["day"])


@query(
    "latest_per_key",
    """SELECT user_id, event_id, ts, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def _(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return latest_per_key(events, ["user_id"], ["ts", "event_id"])


_EXACT = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus", "l_shipdate"]
_MEASURED = _EXACT[4:8]  # stored as doubles of two digits
_TEXT = " || ".join(
    f"coalesce(length({v}) || ':' || {v}, '-')"
    for v in (f"CAST({f'cast(round({c} * 100) AS BIGINT)' if c in _MEASURED else c} AS VARCHAR)" for c in _EXACT)
)


@query(
    "table_fingerprint",
    f"""WITH w AS (SELECT l_returnflag, md5({_TEXT}) AS d FROM lineitem),
    n AS (SELECT l_returnflag, ('0x' || substr(d, 1, 16))::UBIGINT::HUGEINT AS h, ('0x' || substr(d, 17, 16))::UBIGINT::HUGEINT AS l FROM w)
    SELECT l_returnflag, count(*) AS row_count,
      (sum(h) % 18446744073709551616)::VARCHAR || ':' || (sum(l) % 18446744073709551616)::VARCHAR AS digest FROM n GROUP BY 1""",
)
def _(spark, folder):
    lines = table(spark, folder, "lineitem").withColumns({c: as_fixed(c, 2) for c in _MEASURED})
    return fingerprint(lines, ["l_returnflag"], columns=_EXACT).drop("schema_json")


@query(
    "spine",
    f"""SELECT l_orderkey AS unit_id, l_shipdate AS event_time, {LINE_LABEL} AS is_defective,
      l_suppkey AS machine_id, l_partkey AS supplier_id, l_quantity, l_discount FROM lineitem""",
)
def _(spark, folder):
    return labelled_lines(spark, folder).select(
        F.col("l_orderkey").alias("unit_id"),
        F.col("l_shipdate").alias("event_time"),
        F.col("label").alias("is_defective"),
        F.col("l_suppkey").alias("machine_id"),
        F.col("l_partkey").alias("supplier_id"),
        "l_quantity",
        "l_discount",
    )


@query(
    "parse_timestamp",
    """SELECT event_id, try_cast(CASE WHEN event_type = 'error' THEN 'no time' ELSE ts::VARCHAR END AS TIMESTAMP)
      AS parsed FROM events""",
)
def _(spark, folder):
    events = table(spark, folder, "events")
    text = F.when(F.col("event_type") == "error", "no time").otherwise(F.col("ts").cast("string"))
    return events.select("event_id", parse_timestamp(text).cast("timestamp_ntz").alias("parsed"))


@query(
    "bool_cast",
    f"""SELECT l_orderkey, l_linenumber, coalesce(({LINE_LABEL})::DOUBLE, 0.0::DOUBLE) AS flag FROM lineitem""",
)
def _(spark, folder):
    return labelled_lines(spark, folder).select("l_orderkey", "l_linenumber", as_flag("label").alias("flag"))


@query(
    "labelled_only",
    f"""SELECT l_orderkey, l_linenumber, {LINE_LABEL} AS label FROM lineitem WHERE {LINE_LABEL} IS NOT NULL""",
)
def _(spark, folder):
    return labelled_lines(spark, folder).filter("label IS NOT NULL").select("l_orderkey", "l_linenumber", "label")


LINE_RULES = [
    Rule("lines", "quantity_valid", "l_quantity BETWEEN 5 AND 45"),
    Rule("lines", "discount_valid", "l_discount BETWEEN 0.01 AND 0.09"),
    Rule("lines", "status_valid", "l_linestatus IN ('F', 'O')"),
    Rule("lines", "flag_valid", "l_returnflag IN ('A', 'R')"),
    Rule("lines", "tax_not_null", "l_tax IS NOT NULL"),
]


def _gappy_lines(spark, folder):
    return table(spark, folder, "lineitem").withColumns(
        {"l_quantity": F.nullif("l_quantity", F.lit(25.0)), "l_tax": F.nullif("l_tax", F.lit(0.08))}
    )


_GAPPY = """(SELECT l_orderkey, l_linenumber, nullif(l_quantity, 25.0) AS l_quantity, nullif(l_tax, 0.08) AS l_tax,
    l_discount, l_linestatus, l_returnflag, l_shipdate, l_suppkey FROM lineitem)"""


@query(
    "rule_violations",
    " UNION ALL ".join(
        f"""SELECT '{r.name}' AS rule, count(*) FILTER (WHERE NOT ({r.constraint})) AS violations,
        count(*) FILTER (WHERE ({r.constraint}) IS NULL) AS unknowns FROM {_GAPPY}"""
        for r in LINE_RULES
    ),
)
def _(spark, folder):
    return rule_violations(_gappy_lines(spark, folder), LINE_RULES)


@query(
    "quarantine_split",
    f"""SELECT l_orderkey, l_linenumber, l_quantity,
      NOT coalesce({" AND ".join(f"({r.constraint})" for r in LINE_RULES)}, false) AS is_quarantined FROM {_GAPPY}""",
)
def _(spark, folder):
    flagged = flag_quarantine(_gappy_lines(spark, folder), LINE_RULES)
    return flagged.select("l_orderkey", "l_linenumber", "l_quantity", "is_quarantined")


_HISTORY = f"""SELECT KEY, count(*) AS total_rows, count(*) FILTER (WHERE {LINE_LABEL} = 1) AS defective_rows,
    count(*) FILTER (WHERE {LINE_LABEL} = 1) / count(*) * 100 AS defect_rate_all_pct,
    sum({LINE_LABEL})::BIGINT / nullif(count({LINE_LABEL}), 0) * 100 AS defect_rate_labelled_pct
    FROM lineitem GROUP BY 1"""


@query(
    "profile_machine",
    f"""SELECT s_suppkey, s_nationkey, n_name, total_rows, defective_rows, defect_rate_all_pct, defect_rate_labelled_pct
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
    LEFT JOIN ({_HISTORY.replace("KEY", "l_suppkey")}) h ON s_suppkey = l_suppkey""",
)
def _(spark, folder):
    nation = table(spark, folder, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    machines = lookup(table(spark, folder, "supplier"), nation, ["s_nationkey"])
    catalog = machines.select("s_suppkey", "s_nationkey", "n_name")
    facts = labelled_lines(spark, folder).withColumnRenamed("l_suppkey", "s_suppkey")
    return profile(catalog, facts, "s_suppkey", "label")


@query(
    "profile_supplier",
    f"""SELECT p_partkey, p_brand, p_type, total_rows, defective_rows, defect_rate_all_pct, defect_rate_labelled_pct
    FROM part LEFT JOIN ({_HISTORY.replace("KEY", "l_partkey")}) h ON p_partkey = l_partkey""",
)
def _(spark, folder):
    catalog = table(spark, folder, "part").select("p_partkey", "p_brand", "p_type")
    facts = labelled_lines(spark, folder).withColumnRenamed("l_partkey", "p_partkey")
    return profile(catalog, facts, "p_partkey", "label")


@query(
    "feature_lookup",
    """SELECT o_orderkey, o_custkey, c_nationkey, c_mktsegment, c_acctbal, n_name
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def _(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment", "c_acctbal"
    )
    nation = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    joined = lookup(lookup(orders, customer, ["o_custkey"]), nation, ["c_nationkey"])
    return joined.select("o_orderkey", "o_custkey", "c_nationkey", "c_mktsegment", "c_acctbal", "n_name")
