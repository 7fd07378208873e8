"""Evaluation, run tables, promotion and monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import as_fixed, fixed_mean
from ..operators import drift as monitor
from ..operators import evaluate, lifecycle
from ..operators.sketches import merged_sketches, quantile_sketches, rank_bounds, sketch_quantiles
from .registry import LINE_LABEL, labelled_lines, query, rounded, table

_SCORED = """WITH d AS (SELECT l.quality AS y, d.n_chars FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
    s AS (SELECT y, n_chars / (SELECT max(n_chars) FROM d)::DOUBLE AS p FROM d)"""


def scored_documents(spark, folder):
    """Labelled documents with their length relative to the longest as the score."""
    joined = table(spark, folder, "labels").join(
        table(spark, folder, "documents").select("doc_id", "n_chars"), "doc_id"
    )
    longest = joined.agg(F.max("n_chars")).first()[0]
    return joined.select(F.col("quality").alias("y"), (F.col("n_chars") / F.lit(float(longest))).alias("p"))


_POINTS = f"""{_SCORED}, g AS (SELECT p, sum(y)::BIGINT AS pos, sum(1 - y)::BIGINT AS neg FROM s GROUP BY 1),
    c AS (SELECT *, sum(pos) OVER w::BIGINT AS cp, sum(neg) OVER w::BIGINT AS cn FROM g WINDOW w AS (ORDER BY p DESC)),
    t AS (SELECT sum(y)::BIGINT AS np, sum(1 - y)::BIGINT AS nn FROM s)"""


@query(
    "auc_exact",
    f"""{_POINTS}, z AS (SELECT *, cp / (cp + cn) AS pr,
        CASE WHEN cp + cn = pos + neg THEN cp / (cp + cn) ELSE (cp - pos) / (cp + cn - pos - neg) END AS pb FROM c, t)
    SELECT round(sum(pos * pr) / any_value(np), 6) AS avg_precision,
      round(sum(neg * (cp - pos / 2)) / (any_value(np) * any_value(nn)), 6) AS auc_roc,
      round(sum(pos * (pr + pb) / 2) / any_value(np), 6) AS auc_pr_trapezoid FROM z""",
)
def _(spark, folder):
    metrics = evaluate.ranking_metrics(scored_documents(spark, folder), "y", "p")
    return rounded(metrics, *metrics.columns)


@query(
    "pr_curve",
    f"""{_POINTS} SELECT p AS threshold, cp / (cp + cn) AS precision, cp / np AS recall FROM c, t
    UNION ALL SELECT NULL, 1.0, 0.0""",
)
def _(spark, folder):
    return evaluate.pr_curve(scored_documents(spark, folder), "y", "p")


@query(
    "roc_curve",
    f"""{_POINTS} SELECT p AS threshold, cn / nn AS fpr, cp / np AS tpr FROM c, t UNION ALL SELECT NULL, 0.0, 0.0""",
)
def _(spark, folder):
    return evaluate.roc_curve(scored_documents(spark, folder), "y", "p")


@query(
    "calibration",
    f"""{_SCORED} SELECT greatest(ceil(p * 10) - 1, 0)::INTEGER AS bin, round(avg(p), 6) AS mean_score,
      avg(y) AS positive_share, count(*) AS n_rows FROM s GROUP BY 1""",
)
def _(spark, folder):
    return rounded(evaluate.calibration(scored_documents(spark, folder), "y", "p"), "mean_score")


def _counts(predicted: str) -> str:
    return f"""SELECT count(*) FILTER (WHERE y = 1 AND {predicted}) AS tp,
      count(*) FILTER (WHERE y = 0 AND {predicted}) AS fp,
      count(*) FILTER (WHERE y = 1 AND NOT {predicted}) AS fn,
      count(*) FILTER (WHERE y = 0 AND NOT {predicted}) AS tn FROM s"""


_LOW = 0.05  # most documents are short beside the longest


@query(
    "threshold_metrics",
    f"""{_SCORED}, n AS ({_counts(f"p >= {_LOW}")}) SELECT *, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall,
      2 * tp / (2 * tp + fp + fn) AS f1, (tp + tn) / (tp + fp + fn + tn) AS accuracy FROM n""",
)
def _(spark, folder):
    return evaluate.threshold_metrics(scored_documents(spark, folder), "y", "p", _LOW)


@query(
    "confusion_matrix",
    f"""{_SCORED}, n AS ({_counts(f"p >= {_LOW}")})
    SELECT 0 AS label, 0 AS prediction, tn AS n_rows FROM n UNION ALL SELECT 0, 1, fp FROM n
    UNION ALL SELECT 1, 0, fn FROM n UNION ALL SELECT 1, 1, tp FROM n""",
)
def _(spark, folder):
    return evaluate.confusion_matrix(scored_documents(spark, folder), "y", "p", _LOW)


@query(
    "class_report",
    f"""{_SCORED}, n AS ({_counts(f"p >= {_LOW}")}),
    m AS (SELECT tn / (tn + fn) AS gp, tn / (tn + fp) AS gr, 2 * tn / (2 * tn + fn + fp) AS gf, tn + fp AS gs,
      tp / (tp + fp) AS bp, tp / (tp + fn) AS br, 2 * tp / (2 * tp + fp + fn) AS bf, tp + fn AS bs,
      (tp + tn) / (tp + fp + fn + tn) AS acc FROM n),
    r AS (SELECT 'good' AS class, gp AS precision, gr AS recall, gf AS f1, gs AS support FROM m
      UNION ALL SELECT 'defective', bp, br, bf, bs FROM m
      UNION ALL SELECT 'accuracy', acc, acc, acc, gs + bs FROM m
      UNION ALL SELECT 'macro avg', (gp + bp) / 2, (gr + br) / 2, (gf + bf) / 2, gs + bs FROM m
      UNION ALL SELECT 'weighted avg', (gp * gs + bp * bs) / (gs + bs), (gr * gs + br * bs) / (gs + bs),
        (gf * gs + bf * bs) / (gs + bs), gs + bs FROM m)
    SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM r""",
)
def _(spark, folder):
    return rounded(evaluate.class_report(scored_documents(spark, folder), "y", "p", _LOW), "precision", "recall", "f1")


_SWEEP = f"""{_SCORED}, g AS (SELECT i::INTEGER AS step, i * 0.01::DOUBLE AS threshold FROM range(101) r(i)),
    n AS (SELECT step, threshold, count(*) FILTER (WHERE y = 1 AND p >= threshold) AS tp,
      count(*) FILTER (WHERE y = 0 AND p >= threshold) AS fp, count(*) FILTER (WHERE y = 1 AND p < threshold) AS fn
      FROM g, s GROUP BY 1, 2)"""


@query(
    "threshold_sweep",
    f"""{_SWEEP} SELECT step, threshold, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 1.0 END AS precision,
      tp / (tp + fn) AS recall FROM n""",
)
def _(spark, folder):
    return evaluate.threshold_sweep(scored_documents(spark, folder), "y", "p")


@query(
    "best_threshold",
    f"""{_SWEEP} SELECT threshold AS best_threshold, 2 * tp / (2 * tp + fp + fn) AS best_f1 FROM n
    ORDER BY best_f1 DESC, threshold LIMIT 1""",
)
def _(spark, folder):
    return evaluate.best_threshold(scored_documents(spark, folder), "y", "p")


# one run per user: its scores before and after the middle of the month
_CUT = "2024-01-16"


def runs_table(spark, folder):
    events = table(spark, folder, "events")
    early = F.col("ts") < F.lit(_CUT).cast("timestamp_ntz")
    cents = as_fixed("value", 2)
    totals = events.groupBy(F.col("user_id").alias("run_id")).agg(
        F.sum(F.when(early, cents)).alias("a"),
        F.count_if(early).alias("na"),
        F.sum(F.when(~early, cents)).alias("b"),
        F.count_if(~early).alias("nb"),
    )
    kind = F.col("run_id") % 3
    return totals.select(
        "run_id",
        F.floor(F.col("run_id") / 10).cast("bigint").alias("parent_id"),
        F.when(kind == 0, "0.001").when(kind == 1, "0.01").otherwise("0.1").alias("reg_param"),
        (fixed_mean(F.col("a"), F.col("na"), 2) / 100.0).alias("train_auc_pr"),
        (fixed_mean(F.col("b"), F.col("nb"), 2) / 100.0).alias("val_auc_pr"),
    )


_RUNS = f"""(SELECT user_id AS run_id, user_id // 10 AS parent_id,
      CASE user_id % 3 WHEN 0 THEN '0.001' WHEN 1 THEN '0.01' ELSE '0.1' END AS reg_param,
      sum(cast(round(value * 100) AS BIGINT)) FILTER (WHERE ts < TIMESTAMP '{_CUT}')::BIGINT::DOUBLE / 100.0::DOUBLE
        / nullif(count(*) FILTER (WHERE ts < TIMESTAMP '{_CUT}'), 0) / 100.0::DOUBLE AS train_auc_pr,
      sum(cast(round(value * 100) AS BIGINT)) FILTER (WHERE ts >= TIMESTAMP '{_CUT}')::BIGINT::DOUBLE / 100.0::DOUBLE
        / nullif(count(*) FILTER (WHERE ts >= TIMESTAMP '{_CUT}'), 0) / 100.0::DOUBLE AS val_auc_pr
    FROM events GROUP BY user_id)"""


@query(
    "best_run",
    f"SELECT * FROM {_RUNS} WHERE val_auc_pr IS NOT NULL ORDER BY val_auc_pr DESC, run_id LIMIT 3",
)
def _(spark, folder):
    return lifecycle.top_runs(runs_table(spark, folder), "val_auc_pr", "run_id", 3)


@query("run_gap", f"SELECT *, train_auc_pr - val_auc_pr AS gap_auc_pr FROM {_RUNS}")
def _(spark, folder):
    return lifecycle.with_gaps(runs_table(spark, folder), ["auc_pr"])


@query(
    "run_search",
    f"""SELECT *, train_auc_pr - val_auc_pr AS gap_auc_pr FROM {_RUNS}
    WHERE val_auc_pr > 0.1 AND reg_param = '0.001' AND train_auc_pr - val_auc_pr > 0.05""",
)
def _(spark, folder):
    runs = lifecycle.with_gaps(runs_table(spark, folder), ["auc_pr"])
    where = "val_auc_pr > 0.1 AND reg_param = '0.001' AND gap_auc_pr > 0.05"
    return lifecycle.search_runs(runs, where, [F.col("val_auc_pr").desc()])


# champions: no row for the largest parameter, and no metric for runs of the smallest that had no gain
_CHAMPION = "reg_param <> '0.1'"
_CHAMPION_SCORE = "CASE WHEN reg_param = '0.01' OR train_auc_pr > val_auc_pr THEN train_auc_pr END"


@query(
    "promotion_decision",
    f"""SELECT a.run_id, a.val_auc_pr AS challenger_score, b.score AS champion_score,
      a.val_auc_pr - b.score AS delta, b.run_id IS NULL OR coalesce(a.val_auc_pr > b.score, false) AS promoted,
      CASE WHEN b.run_id IS NULL THEN 'no champion' WHEN a.val_auc_pr > b.score THEN 'challenger better'
        WHEN a.val_auc_pr = b.score THEN 'tie keeps champion' WHEN a.val_auc_pr < b.score THEN 'champion better'
        ELSE 'not comparable' END AS reason
    FROM {_RUNS} a LEFT JOIN (SELECT run_id, {_CHAMPION_SCORE} AS score FROM {_RUNS} WHERE {_CHAMPION}) b USING (run_id)""",
)
def _(spark, folder):
    runs = runs_table(spark, folder)
    challengers = runs.select("run_id", F.col("val_auc_pr").alias("score"))
    champions = runs.filter(_CHAMPION).select("run_id", F.expr(_CHAMPION_SCORE).alias("score"))
    return lifecycle.promotion_decision(challengers, champions, "run_id", "score")


_ALIAS = """CASE event_type WHEN 'signup' THEN 'candidate' WHEN 'view' THEN 'challenger' WHEN 'purchase' THEN 'champion'
    WHEN 'click' THEN 'retired' ELSE 'rejected' END"""


_STEPS = " OR ".join(
    f"(f.alias {'IS NULL' if now is None else f'= {now!r}'} AND e.alias IN ({', '.join(map(repr, after))}))"
    for now, after in lifecycle.TRANSITIONS.items()
    if after
)


@query(
    "alias_state",
    f"""WITH RECURSIVE e AS (SELECT user_id AS version, {_ALIAS} AS alias, ts AS at, event_id,
      row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
    f AS (SELECT DISTINCT version, 0::BIGINT AS i, NULL::VARCHAR AS alias, NULL::TIMESTAMP AS at, NULL::BIGINT AS event_id FROM e
      UNION ALL SELECT e.version, e.i, CASE WHEN {_STEPS} THEN e.alias ELSE f.alias END,
        CASE WHEN {_STEPS} THEN e.at ELSE f.at END, CASE WHEN {_STEPS} THEN e.event_id ELSE f.event_id END
      FROM f JOIN e ON e.version = f.version AND e.i = f.i + 1)
    SELECT version, alias, at, event_id FROM f WHERE alias IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY version ORDER BY i DESC) = 1""",
)
def _(spark, folder):
    names = {"signup": "candidate", "view": "challenger", "purchase": "champion", "click": "retired"}
    alias = F.lit("rejected")
    for kind, name in names.items():
        alias = F.when(F.col("event_type") == kind, name).otherwise(alias)
    history = table(spark, folder, "events").select(
        F.col("user_id").alias("version"), alias.alias("alias"), F.col("ts").alias("at"), "event_id"
    )
    return lifecycle.alias_state(history, "version", ["at", "event_id"])


_EDGES = [float(e) for e in range(50, 500, 50)]


@query(
    "drift_psi",
    f"""WITH v AS (SELECT ts >= TIMESTAMP '{_CUT}' AS now, least(floor(value / 50), 9)::INTEGER AS bin FROM events),
    c AS (SELECT g.bin, 1 + count(*) FILTER (WHERE NOT now) AS b, 1 + count(*) FILTER (WHERE now) AS c
      FROM range(10) g(bin) LEFT JOIN v ON v.bin = g.bin GROUP BY 1),
    s AS (SELECT bin, b / sum(b) OVER () AS bs, c / sum(c) OVER () AS cs FROM c),
    k AS (SELECT *, abs(sum(cs - bs) OVER (ORDER BY bin)) AS gap FROM s)
    SELECT 'value' AS feature, round(sum((cs - bs) * ln(cs / bs)), 6) AS psi, round(max(gap), 6) AS ks FROM k""",
)
def _(spark, folder):
    tagged = table(spark, folder, "events").select(
        "value", (F.col("ts") >= F.lit(_CUT).cast("timestamp_ntz")).alias("now")
    )
    return rounded(monitor.drift(tagged, "now", {"value": _EDGES}), "psi", "ks")


@query(
    "drift_quantile_bins",
    """SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS feature, true AS edges_within,
      true AS psi_positive, true AS ks_within""",
)
def _(spark, folder):
    """Drift over bins at the baseline's sketched quantiles; whether each limit is right to half a percent of the baseline, and
    whether the measures keep to their bounds."""
    lines = table(spark, folder, "lineitem").withColumn("now", F.year("l_shipdate") >= 2000)
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    baseline, ranks = lines.filter(~F.col("now")), [i / 10 for i in range(1, 10)]
    parts = quantile_sketches(baseline.withColumn("year", F.year("l_shipdate")), names, by=["year"])
    found = sketch_quantiles(merged_sketches(parts, names), {c: ranks for c in names})
    bounds = rank_bounds(baseline, {c: list(zip(ranks, found[c])) for c in names}, error=0.005)
    measured = monitor.drift(lines, "now", {c: sorted(set(found[c])) for c in names})
    psi, ks = F.col("psi"), F.col("ks")
    return measured.join(bounds.withColumnRenamed("column_name", "feature"), "feature").select(
        "feature", F.col("within").alias("edges_within"), (psi >= 0).alias("psi_positive"), ((ks >= 0) & (ks <= 1) & (ks * ks <= psi)).alias("ks_within")
    )


@query(
    "equalized_odds",
    f"""WITH s AS (SELECT l_linestatus, {LINE_LABEL} AS y, l_quantity > 25 AS q FROM lineitem),
    n AS (SELECT l_linestatus, count(*) FILTER (WHERE y = 1 AND q) AS tp, count(*) FILTER (WHERE y = 0 AND q) AS fp,
      count(*) FILTER (WHERE y = 1 AND NOT q) AS fn, count(*) FILTER (WHERE y = 0 AND NOT q) AS tn
      FROM s WHERE y IS NOT NULL GROUP BY 1)
    SELECT l_linestatus, tp / (tp + fn) AS tpr, fp / (fp + tn) AS fpr, tp + fp + fn + tn AS n_rows FROM n""",
)
def _(spark, folder):
    lines = labelled_lines(spark, folder).withColumn("q", (F.col("l_quantity") > 25).cast("int"))
    return evaluate.equalized_odds(lines, "l_linestatus", "label", "q")


@query(
    "error_cost",
    f"""WITH s AS (SELECT {LINE_LABEL} AS y, l_quantity > 25 AS q FROM lineitem WHERE {LINE_LABEL} IS NOT NULL),
    n AS (SELECT count(*) FILTER (WHERE y = 1 AND NOT q) AS missed_defects,
      count(*) FILTER (WHERE y = 0 AND q) AS scrapped_good FROM s)
    SELECT *, 200 * missed_defects + 10 * scrapped_good AS cost_eur FROM n""",
)
def _(spark, folder):
    lines = labelled_lines(spark, folder).withColumn("q", (F.col("l_quantity") > 25).cast("int"))
    return evaluate.error_cost(lines, "label", "q")
