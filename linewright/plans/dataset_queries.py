"""Reports, splits, weights, sampling and columnar feature preparation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions import derived_card_features
from ..operators import dataset, prep, sketches
from .registry import LINE_LABEL, labelled_lines, query, rounded, table

_GAPPY = """(SELECT *, CASE WHEN l_quantity > 45 THEN NULL ELSE l_quantity END AS qty,
    CASE WHEN l_linestatus = 'F' THEN l_discount END AS disc FROM lineitem)"""


def _gappy(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_quantity") <= 45, F.col("l_quantity")).alias("qty"),
        F.when(F.col("l_linestatus") == "F", F.col("l_discount")).alias("disc"),
        "l_returnflag",
    )


@query("time_bounds", "SELECT min(l_shipdate) AS min_time, max(l_shipdate) AS max_time FROM lineitem")
def _(spark, folder):
    return dataset.time_bounds(table(spark, folder, "lineitem"), "l_shipdate")


_COLUMNS = ["l_orderkey", "l_linenumber", "qty", "disc", "l_returnflag"]


@query(
    "null_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS null_rows, count(*) AS total_rows
        FROM {_GAPPY}"""
        for c in _COLUMNS
    ),
)
def _(spark, folder):
    return dataset.null_profile(_gappy(spark, folder))


@query("class_balance", f"SELECT {LINE_LABEL} AS label, count(*) AS n_rows FROM lineitem GROUP BY 1")
def _(spark, folder):
    return dataset.class_balance(labelled_lines(spark, folder), "label")


@query(
    "validation_summary",
    f"""SELECT count(*) AS total_rows, count(DISTINCT l_orderkey) AS unique_units,
      round(avg({LINE_LABEL}), 4) AS defect_rate, min(l_discount) AS min_score, max(l_discount) AS max_score
    FROM lineitem""",
)
def _(spark, folder):
    return dataset.summary(labelled_lines(spark, folder), "l_orderkey", "label", "l_discount")


@query(
    "validation_checks",
    f"""SELECT 'has_rows' AS check_name, count(*) > 1000 AS passed FROM lineitem
    UNION ALL SELECT 'all_labelled', count(*) = count({LINE_LABEL}) FROM lineitem
    UNION ALL SELECT 'rate_in_range', avg({LINE_LABEL}) BETWEEN 0.01 AND 0.6 FROM lineitem
    UNION ALL SELECT 'score_in_unit', min(l_discount) >= 0 AND max(l_discount) <= 1 FROM lineitem""",
)
def _(spark, folder):
    rows = F.count(F.lit(1))
    return dataset.checks(
        labelled_lines(spark, folder),
        {
            "has_rows": rows > 1000,
            "all_labelled": rows == F.count("label"),
            "rate_in_range": F.avg("label").between(0.01, 0.6),
            "score_in_unit": (F.min("l_discount") >= 0) & (F.max("l_discount") <= 1),
        },
    )


def _split_sql(case: str) -> str:
    return f"""SELECT {case} AS split, min(l_shipdate) AS min_time, max(l_shipdate) AS max_time, count(*) AS n_rows,
      round(avg({LINE_LABEL}), 6) AS label_rate FROM lineitem, b GROUP BY 1"""


_TAG = """CASE WHEN l_shipdate < train_end - INTERVAL 24 MONTH THEN 'before_window'
    WHEN l_shipdate <= train_end THEN 'train' WHEN l_shipdate <= validation_end THEN 'validation' ELSE 'test' END"""

_SHARE_BOUNDS = """WITH m AS (SELECT min(l_shipdate) AS lo, date_sub('day', min(l_shipdate), max(l_shipdate)) AS days
      FROM lineitem),
    t AS (SELECT lo + to_days(cast(trunc(0.70 * days) AS INTEGER)) AS train_end, days FROM m),
    b AS (SELECT train_end, train_end + to_days(cast(trunc(0.15 * days) AS INTEGER)) AS validation_end FROM t)"""


@query("temporal_split", f"{_SHARE_BOUNDS} {_split_sql(_TAG)}")
def _(spark, folder):
    lines = labelled_lines(spark, folder)
    tagged = dataset.tag_split(lines, "l_shipdate", dataset.share_split(lines, "l_shipdate"))
    return rounded(dataset.split_report(tagged, "l_shipdate", "label"), "label_rate")


@query(
    "rolling_split",
    f"""WITH b AS (SELECT TIMESTAMP '2000-08-31' AS validation_end,
      TIMESTAMP '2000-08-31' - INTERVAL 6 MONTH AS train_end) {_split_sql(_TAG)}""",
)
def _(spark, folder):
    plan = dataset.rolling_split(datetime(2000, 8, 31))
    tagged = dataset.tag_split(labelled_lines(spark, folder), "l_shipdate", plan)
    return rounded(dataset.split_report(tagged, "l_shipdate", "label"), "label_rate")


_CALENDAR = """CASE WHEN year(l_shipdate) <= 1999 THEN 'train' WHEN year(l_shipdate) <= 2000 THEN 'validation'
    ELSE 'test' END"""


@query("calendar_split", f"WITH b AS (SELECT 1) {_split_sql(_CALENDAR)}")
def _(spark, folder):
    tagged = dataset.calendar_split(labelled_lines(spark, folder), "l_shipdate", 1999, 2000)
    return rounded(dataset.split_report(tagged, "l_shipdate", "label"), "label_rate")


@query(
    "train_modes",
    " UNION ALL ".join(
        f"""SELECT '{mode}' AS mode, l_orderkey, l_linenumber, l_shipdate FROM lineitem
        WHERE {_CALENDAR} IN ({", ".join(f"'{p}'" for p in parts)})"""
        for mode, parts in dataset.TRAIN_MODES.items()
    ),
)
def _(spark, folder):
    tagged = dataset.calendar_split(table(spark, folder, "lineitem"), "l_shipdate", 1999, 2000)
    return dataset.rows_by_mode(tagged).select("mode", "l_orderkey", "l_linenumber", "l_shipdate")


_WEIGHTS = f"""(SELECT {LINE_LABEL} AS label, l_orderkey, l_linenumber FROM lineitem WHERE {LINE_LABEL} IS NOT NULL)"""


@query(
    "class_weights",
    f"""SELECT label, count(*) AS n_rows,
      round((SELECT count(*) FROM {_WEIGHTS}) / (2.0::DOUBLE * count(*)), 6) AS mean_weight FROM {_WEIGHTS} GROUP BY 1""",
)
def _(spark, folder):
    weighted = dataset.with_class_weights(labelled_lines(spark, folder), "label")
    return rounded(dataset.weight_report(weighted, "label"), "mean_weight")


@query(
    "stratified_sample",
    f"""SELECT l_orderkey, l_linenumber, {LINE_LABEL} AS label FROM lineitem WHERE {LINE_LABEL} IN (0, 1)
    AND ('0x' || left(md5('42|' || l_orderkey || '|' || l_linenumber), 8))::BIGINT
      < floor(least(1.0::DOUBLE, 20000::DOUBLE / (SELECT count(*) FROM lineitem WHERE {LINE_LABEL} IN (0, 1)))
        * 4294967296::DOUBLE)""",
)
def _(spark, folder):
    lines = labelled_lines(spark, folder).select("l_orderkey", "l_linenumber", "label")
    return dataset.stratified_sample(lines, "label", 20_000, ["l_orderkey", "l_linenumber"])


@query(
    "keyed_sample",
    f"""SELECT l_orderkey, l_linenumber, {LINE_LABEL} AS label FROM lineitem WHERE {LINE_LABEL} IN (0, 1)
    AND ('0x' || left(md5('42|' || l_orderkey || '|' || l_linenumber), 8))::BIGINT
      < {int(0.3 * 2**32)}""",
)
def _(spark, folder):
    lines = labelled_lines(spark, folder).select("l_orderkey", "l_linenumber", "label")
    return dataset.keyed_sample(lines, "label", ["l_orderkey", "l_linenumber"], 0.3)


@query(
    "oversample",
    f"""SELECT l_orderkey, l_linenumber, label, (k + 1)::INTEGER AS copy FROM
      (SELECT l_orderkey, l_linenumber, {LINE_LABEL} AS label FROM lineitem), range(3) t(k)
    WHERE k = 0 OR label = 1""",
)
def _(spark, folder):
    lines = labelled_lines(spark, folder).select("l_orderkey", "l_linenumber", "label")
    return dataset.oversample(lines, "label", 1, 3)


@query(
    "topk_abs",
    """SELECT s_suppkey, s_acctbal, abs(s_acctbal) AS size FROM supplier
    ORDER BY abs(s_acctbal) DESC, s_suppkey LIMIT 10""",
)
def _(spark, folder):
    sized = table(spark, folder, "supplier").select("s_suppkey", "s_acctbal", F.abs("s_acctbal").alias("size"))
    return sized.orderBy(F.col("size").desc(), "s_suppkey").limit(10)


@query(
    "impute_values",
    f"""SELECT 'qty' AS column_name, quantile_disc(qty, 0.5) AS median, round(avg(qty), 6) AS mean FROM {_GAPPY}
    UNION ALL SELECT 'disc', quantile_disc(disc, 0.5), round(avg(disc), 6) FROM {_GAPPY}""",
)
def _(spark, folder):
    gappy = _gappy(spark, folder)
    medians = prep.fit_imputer(gappy, ["qty", "disc"], exact=True)
    means = prep.fit_imputer(gappy, ["qty", "disc"], strategy="mean")
    rows = [(c, medians[c], means[c]) for c in medians]
    return rounded(spark.createDataFrame(rows, "column_name string, median double, mean double"), "mean")


@query("impute_values_approx", "SELECT unnest(['qty', 'disc']) AS column_name, 1::INTEGER AS quantiles, true AS within")
def _(spark, folder):
    """Medians from sketches per return flag, merged; whether they are right to half a percent of the rows, by exact counts."""
    lines = _gappy(spark, folder)
    columns = ["qty", "disc"]
    parts = sketches.quantile_sketches(lines, columns, by=["l_returnflag"])
    medians = sketches.sketch_quantiles(sketches.merged_sketches(parts, columns), {c: [0.5] for c in columns})
    return sketches.rank_bounds(lines, {c: [(0.5, q) for q in medians[c]] for c in columns}, error=0.005)


@query(
    "impute_rename",
    f"""WITH m AS (SELECT quantile_disc(qty, 0.5) AS q, quantile_disc(disc, 0.5) AS d FROM {_GAPPY})
    SELECT l_orderkey, l_linenumber, coalesce(qty, q) AS qty_imp, coalesce(disc, d) AS disc_imp, l_returnflag
    FROM {_GAPPY}, m""",
)
def _(spark, folder):
    gappy = _gappy(spark, folder)
    return prep.impute(gappy, prep.fit_imputer(gappy, ["qty", "disc"], exact=True), ["qty", "disc"])


_TYPES = "(SELECT p_partkey, nullif(p_type, 'ECONOMY') AS p_type FROM part)"
_RANKED = f"""(SELECT p_type, (row_number() OVER (ORDER BY count(*) DESC, p_type) - 1)::DOUBLE AS idx
    FROM {_TYPES} WHERE p_type IS NOT NULL GROUP BY 1)"""


def _typed(spark, folder):
    kind = F.nullif("p_type", F.lit("ECONOMY"))
    return table(spark, folder, "part").select("p_partkey", kind.alias("p_type"))


@query(
    "category_index",
    f"""SELECT p_partkey, p.p_type, coalesce(idx, (SELECT count(*) FROM {_RANKED})::DOUBLE) AS p_type_idx
    FROM {_TYPES} p LEFT JOIN {_RANKED} r ON p.p_type = r.p_type""",
)
def _(spark, folder):
    typed = _typed(spark, folder)
    return prep.index_categories(typed, prep.fit_categories(typed, ["p_type"])).select(
        "p_partkey", "p_type", "p_type_idx"
    )


@query(
    "one_hot",
    f"""SELECT p_partkey, (SELECT count(*) - 1 FROM {_RANKED})::INTEGER AS slots,
      CASE WHEN idx < (SELECT count(*) - 1 FROM {_RANKED}) THEN idx::INTEGER END AS slot,
      CASE WHEN idx < (SELECT count(*) - 1 FROM {_RANKED}) THEN 1.0::DOUBLE END AS flag
    FROM {_TYPES} p LEFT JOIN {_RANKED} r ON p.p_type = r.p_type""",
)
def _(spark, folder):
    typed = _typed(spark, folder)
    categories = prep.fit_categories(typed, ["p_type"])
    encoded = prep.one_hot(prep.index_categories(typed, categories), categories)
    first = lambda part: F.try_element_at(f"p_type_ohe.{part}", F.lit(1))
    return encoded.select("p_partkey", F.col("p_type_ohe.size").alias("slots"), first("indices").alias("slot"), first("values").alias("flag"))


_VALUES = "(SELECT event_id, CASE WHEN event_type <> 'view' THEN value END AS amount FROM events)"


def _amounts(spark, folder):
    events = table(spark, folder, "events")
    return events.select("event_id", F.when(F.col("event_type") != "view", F.col("value")).alias("amount"))


@query(
    "bucketize",
    f"""SELECT event_id, amount, CASE WHEN amount IS NULL THEN 4 WHEN amount < 50 THEN 0 WHEN amount < 200 THEN 1
      WHEN amount < 1000 THEN 2 ELSE 3 END::DOUBLE AS amount_bucket FROM {_VALUES}""",
)
def _(spark, folder):
    return prep.bucketize(_amounts(spark, folder), "amount", "amount_bucket", prep.AMOUNT_SPLITS)


@query(
    "quantile_bucket",
    f"""WITH q AS (SELECT quantile_disc(amount, 0.25) AS a, quantile_disc(amount, 0.5) AS b,
      quantile_disc(amount, 0.75) AS c FROM {_VALUES})
    SELECT event_id, amount, CASE WHEN amount IS NULL THEN 4 WHEN amount < a THEN 0 WHEN amount < b THEN 1
      WHEN amount < c THEN 2 ELSE 3 END::DOUBLE AS bucket FROM {_VALUES}, q""",
)
def _(spark, folder):
    amounts = _amounts(spark, folder)
    return prep.bucketize(amounts, "amount", "bucket", prep.fit_quantile_splits(amounts, "amount", 4, exact=True))


@query("binarize", "SELECT event_id, value, (value > 50)::INTEGER::DOUBLE AS high FROM events")
def _(spark, folder):
    return prep.binarize(table(spark, folder, "events").select("event_id", "value"), "value", "high", 50.0)


@query(
    "derived_features",
    """SELECT event_id, (event_type = 'error' OR user_id % 7 = 0)::INTEGER AS is_high_risk_method,
      (event_type = 'view')::INTEGER AS is_foreign_ip, (event_type <> 'purchase')::INTEGER AS is_unrecognized_device,
      round(ln(value + 1), 6) AS amount_log, (event_type = 'click' AND value > 20)::INTEGER AS is_cross_border_online
    FROM events""",
)
def _(spark, folder):
    kind = F.col("event_type")
    cards = table(spark, folder, "events").select(
        "event_id",
        F.col("value").alias("amount"),
        (F.col("user_id") % 7 == 0).cast("int").alias("is_tor_or_vpn"),
        F.when(kind == "error", "FAILED").otherwise("OK").alias("three_ds_result"),
        (kind != "view").cast("int").alias("ip_country_match"),
        (kind == "purchase").cast("int").alias("device_fingerprint_known"),
        (kind == "click").cast("int").alias("cross_border"),
        F.when(F.col("value") > 20, "online").otherwise("store").alias("payment_method"),
    )
    features = derived_card_features()
    return rounded(cards.withColumns(features), "amount_log").select("event_id", *features)


_SCALED = ["l_quantity", "l_discount", "l_tax"]


@query(
    "standard_scale",
    f"""WITH s AS (SELECT {", ".join(f"stddev_samp({c}) AS s_{c}" for c in _SCALED)} FROM lineitem)
    SELECT l_orderkey, l_linenumber, {", ".join(f"round({c} / s_{c}, 6) AS {c}_std" for c in _SCALED)}
    FROM lineitem, s""",
)
def _(spark, folder):
    lines = table(spark, folder, "lineitem")
    scaled = prep.standard_scale(lines, prep.column_moments(lines, _SCALED))
    out = [f"{c}_std" for c in _SCALED]
    return rounded(scaled.select("l_orderkey", "l_linenumber", *out), *out)


@query(
    "minmax_scale",
    f"""WITH s AS (SELECT {", ".join(f"min({c}) AS a_{c}, max({c}) AS b_{c}" for c in _SCALED)} FROM lineitem)
    SELECT l_orderkey, l_linenumber,
      {", ".join(f"round(({c} - a_{c}) / (b_{c} - a_{c}), 6) AS {c}_mm" for c in _SCALED)} FROM lineitem, s""",
)
def _(spark, folder):
    lines = table(spark, folder, "lineitem")
    scaled = prep.minmax_scale(lines, prep.column_moments(lines, _SCALED))
    out = [f"{c}_mm" for c in _SCALED]
    return rounded(scaled.select("l_orderkey", "l_linenumber", *out), *out)


@query(
    "l2_normalize",
    f"""SELECT l_orderkey, l_linenumber, {", ".join(
        f"round({c} / sqrt({' + '.join(f'{d} * {d}' for d in _SCALED)}), 6) AS {c}_l2" for c in _SCALED)}
    FROM lineitem""",
)
def _(spark, folder):
    out = [f"{c}_l2" for c in _SCALED]
    lines = prep.normalize(table(spark, folder, "lineitem"), _SCALED)
    return rounded(lines.select("l_orderkey", "l_linenumber", *out), *out)


@query(
    "variance_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(var_samp({c}), 6) AS variance, var_samp({c}) > 0.01 AS kept FROM lineitem"
        for c in _SCALED
    ),
)
def _(spark, folder):
    return rounded(prep.variance_profile(table(spark, folder, "lineitem"), _SCALED), "variance")


@query(
    "distinct_units",
    """SELECT year(l_shipdate)::INTEGER AS year, count(*) AS total_rows, count(DISTINCT l_orderkey) AS unique_units, true AS within
    FROM lineitem GROUP BY 1 UNION ALL SELECT NULL, count(*), count(DISTINCT l_orderkey), true FROM lineitem""",
)
def _(spark, folder):
    """Distinct units per year and overall (no year), from sketches per month; whether these are as near as they promise."""
    lines = table(spark, folder, "lineitem").withColumns({"year": F.year("l_shipdate"), "month": F.month("l_shipdate")})
    months = sketches.unit_sketches(lines, "l_orderkey", ["year", "month"])
    none = F.lit(None).cast("int").alias("year")
    estimates = sketches.distinct_units(months, ["year"]).unionByName(sketches.distinct_units(months, []).select(none, "total_rows", "approx_units"))
    exact = F.countDistinct("l_orderkey").alias("unique_units")
    counted = lines.groupBy("year").agg(exact).unionByName(lines.agg(exact).select(none, "unique_units")).withColumnRenamed("year", "_year")
    joined = estimates.join(counted, F.col("year").eqNullSafe(F.col("_year")))
    return joined.select("year", "total_rows", "unique_units", sketches.units_within(F.col("approx_units"), F.col("unique_units")).alias("within"))
