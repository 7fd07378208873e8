"""Evaluation of scored rows as tables. NULL labels or scores are left out everywhere."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .ranking import cumulate

STEPS = 101  # thresholds 0.00, 0.01 ... 1.00


def _scored(df: DataFrame, label: str, score: str) -> DataFrame:
    """Rows with a label and a score; a NaN is no score."""
    picked = df.select(F.col(label).cast("int").alias("y"), F.col(score).cast("double").alias("p"))
    return picked.filter(F.col("y").isNotNull() & F.col("p").isNotNull() & ~F.isnan("p"))


def _or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


@dataclass(frozen=True)
class ScorePoints:
    """Per distinct score, from the highest down: positives and negatives at it (``pos``, ``neg``) and at or above it
    (``cum_pos``, ``cum_neg``); and the sizes of both classes."""

    table: DataFrame
    positives: int
    negatives: int


def score_points(df: DataFrame, label: str, score: str) -> ScorePoints:
    """One scan of the scored rows, whose counts per score are stored; all else reads these."""
    pos, neg = F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg")
    points = materialize(_scored(df, label, score).groupBy("p").agg(pos, neg), "points")
    sizes = points.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).first()
    return ScorePoints(cumulate(points, "p", ["pos", "neg"], descending=True), sizes["pos"] or 0, sizes["neg"] or 0)


def _with_anchor(points: DataFrame, **values: float) -> DataFrame:
    """Add the end point of a curve, which has no threshold."""
    names = list(values)
    anchor = points.sparkSession.createDataFrame(
        [(None, *values.values())], "threshold double, " + ", ".join(f"{n} double" for n in names)
    )
    return points.unionByName(anchor)


def pr_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """Precision and recall when everything scored at or above the threshold is called positive;
    one row per distinct score and the end point (1, 0)."""
    profile = score_points(df, label, score)
    points = profile.table.select(
        F.col("p").alias("threshold"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        _or_zero(F.col("cum_pos"), F.lit(profile.positives)).alias("recall"),
    )
    return _with_anchor(points, precision=1.0, recall=0.0)


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """False and true positive rate per distinct score and the end point (0, 0)."""
    profile = score_points(df, label, score)
    points = profile.table.select(
        F.col("p").alias("threshold"),
        _or_zero(F.col("cum_neg"), F.lit(profile.negatives)).alias("fpr"),
        _or_zero(F.col("cum_pos"), F.lit(profile.positives)).alias("tpr"),
    )
    return _with_anchor(points, fpr=0.0, tpr=0.0)


def ranking_metrics(df: DataFrame, label: str, score: str) -> DataFrame:
    """Average precision, area under the ROC curve and trapezoid area under the PR curve; tied
    scores count together. NULL when a class is absent that the measure needs."""
    profile = score_points(df, label, score)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    cum_pos, cum_neg = F.col("cum_pos").cast("double"), F.col("cum_neg").cast("double")
    above = cum_pos + cum_neg
    precision = cum_pos / above
    precision_before = F.coalesce(F.try_divide(cum_pos - pos, above - pos - neg), precision)
    p, n = F.lit(float(profile.positives) or None), F.lit(float(profile.negatives) or None)
    return profile.table.agg(
        (F.sum(pos * precision) / p).alias("avg_precision"),
        (F.sum(neg * (cum_pos - pos / 2)) / (p * n)).alias("auc_roc"),
        (F.sum(pos * (precision + precision_before) / 2) / p).alias("auc_pr_trapezoid"),
    )


def confusion_counts(label: Column, predicted: Column) -> list[Column]:
    hit, called = label == 1, predicted.cast("int") == 1
    return [
        F.count_if(hit & called).alias("tp"),
        F.count_if(~hit & called).alias("fp"),
        F.count_if(hit & ~called).alias("fn"),
        F.count_if(~hit & ~called).alias("tn"),
    ]


def _quality(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Positive-class measures, zero where undefined."""
    return {
        "precision": _or_zero(tp, tp + fp),
        "recall": _or_zero(tp, tp + fn),
        "f1": _or_zero(2 * tp, 2 * tp + fp + fn),
        "accuracy": _or_zero(tp + tn, tp + fp + fn + tn),
    }


def threshold_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    return measures_of(_scored(df, label, score).agg(*confusion_counts(F.col("y"), F.col("p") >= threshold)))


def measures_of(counts: DataFrame) -> DataFrame:
    """Measures from columns ``tp, fp, fn, tn``."""
    measures = _quality(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return counts.select("tp", "fp", "fn", "tn", *[m.alias(name) for name, m in measures.items()])


def confusion_matrix(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """All four cells, empty ones as zero."""
    counts = _scored(df, label, score).agg(*confusion_counts(F.col("y"), F.col("p") >= threshold))
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    rows = [
        F.struct(F.lit(y).alias("label"), F.lit(p).alias("prediction"), F.col(c).alias("n_rows"))
        for y, p, c in cells
    ]
    return counts.select(F.inline(F.array(*rows)))


def class_report(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support per class, their plain and support-weighted means, and
    accuracy (in every measure column of its row)."""
    counts = _scored(df, label, score).agg(*confusion_counts(F.col("y"), F.col("p") >= threshold))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    bad, good = _quality(tp, fp, fn, tn), _quality(tn, fn, fp, tp)
    n_bad, n_good = tp + fn, tn + fp
    names = ["precision", "recall", "f1"]

    def row(name: str, values: list[Column], support: Column) -> Column:
        fields = [v.alias(n) for v, n in zip(values, names)]
        return F.struct(F.lit(name).alias("class"), *fields, support.alias("support"))

    rows = [
        row("good", [good[m] for m in names], n_good),
        row("defective", [bad[m] for m in names], n_bad),
        row("accuracy", [bad["accuracy"]] * 3, n_good + n_bad),
        row("macro avg", [(good[m] + bad[m]) / 2 for m in names], n_good + n_bad),
        row(
            "weighted avg",
            [_or_zero(good[m] * n_good + bad[m] * n_bad, n_good + n_bad) for m in names],
            n_good + n_bad,
        ),
    ]
    return counts.select(F.inline(F.array(*rows)))


def weighted_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Support-weighted precision, recall and F1 of hard predictions, one row."""
    report = class_report(df.withColumn("_p", F.col(prediction).cast("double")), label, "_p", 0.5)
    weighted = report.filter(F.col("class") == "weighted avg")
    return weighted.select(
        F.col("precision").alias("weighted_precision"),
        F.col("recall").alias("weighted_recall"),
        F.col("f1").alias("weighted_f1"),
    )


def calibration(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """Mean score and share of positives per equal-width bin. A score on an inner edge belongs
    to the bin below it; empty bins are left out."""
    edges = [i * (1.0 / bins) for i in range(1, bins)]
    which = sum((F.col("p") > edge).cast("int") for edge in edges)
    return (
        _scored(df, label, score)
        .groupBy(which.alias("bin"))
        .agg(
            F.avg("p").alias("mean_score"),
            F.avg(F.col("y").cast("double")).alias("positive_share"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )


def _highest_step(p: Column) -> Column:
    """The last of the thresholds i * 0.01 that a score reaches, compared as doubles."""
    near = F.floor(p * 100).cast("int")
    up = F.when((near + 1) * F.lit(0.01) <= p, near + 1).otherwise(near)
    exact = F.when(up * F.lit(0.01) > p, up - 1).otherwise(up)
    return F.least(exact, F.lit(STEPS - 1))


def threshold_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """TP, FP, FN and TN at each of 101 thresholds. The rows are reduced to one count per step
    before the running totals, which therefore see 101 rows whatever the input."""
    rows = _scored(df, label, score)
    steps = rows.groupBy(_highest_step(F.col("p")).alias("step")).agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg")
    )
    below = steps.filter("step < 0").withColumn("step", F.lit(-1))
    grid = rows.sparkSession.range(-1, STEPS).select(F.col("id").cast("int").alias("step"))
    dense = grid.join(steps.filter("step >= 0").unionByName(below), "step", "left").fillna(0, ["pos", "neg"])
    above = Window.orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tp, fp = F.sum("pos").over(above), F.sum("neg").over(above)
    return (
        dense.select(
            "step",
            tp.alias("tp"),
            fp.alias("fp"),
            (F.sum("pos").over(everything) - tp).alias("fn"),
            (F.sum("neg").over(everything) - fp).alias("tn"),
        )
        .filter("step >= 0")
        .withColumn("threshold", F.col("step") * F.lit(0.01))
    )


def threshold_sweep(df: DataFrame, label: str, score: str) -> DataFrame:
    """Precision (1 when nothing is called positive) and recall at 0.00, 0.01 ... 1.00."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return threshold_counts(df, label, score).select(
        "step",
        "threshold",
        F.coalesce(F.try_divide(tp, tp + fp), F.lit(1.0)).alias("precision"),
        _or_zero(tp, tp + fn).alias("recall"),
    )


def best_threshold(df: DataFrame, label: str, score: str) -> DataFrame:
    """The lowest threshold with the highest F1; 0.5 when no threshold has a positive F1."""
    return threshold_summary(df, label, score).select("best_threshold", "best_f1")


def threshold_summary(df: DataFrame, label: str, score: str, step: int = 50) -> DataFrame:
    """Measures at one threshold (a step of 0.01) beside the best threshold, in one row."""
    counts = threshold_counts(df, label, score)
    at = [F.max(F.when(F.col("step") == step, F.col(c))).alias(c) for c in ("tp", "fp", "fn", "tn")]
    f1 = _quality(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))["f1"]
    row = counts.withColumn("f1", f1).agg(
        *at, F.max("f1").alias("best_f1"), F.max_by("threshold", F.struct("f1", -F.col("step"))).alias("t")
    )
    measures = _quality(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return row.select(
        *[m.alias(name) for name, m in measures.items()],
        F.when(F.col("best_f1") > 0, F.col("t")).otherwise(0.5).alias("best_threshold"),
        "best_f1",
    )


def equalized_odds(df: DataFrame, group: str, label: str, prediction: str) -> DataFrame:
    """True and false positive rate per group, over labelled rows."""
    labelled = df.filter(F.col(label).isNotNull())
    counts = labelled.groupBy(group).agg(*confusion_counts(F.col(label), F.col(prediction)))
    return counts.select(
        group,
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")).alias("tpr"),
        F.try_divide(F.col("fp"), F.col("fp") + F.col("tn")).alias("fpr"),
        (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n_rows"),
    )


# Cost in euros of a missed defect and of a good unit scrapped.
MISSED_DEFECT_COST = 200
SCRAPPED_GOOD_COST = 10


def error_cost(
    df: DataFrame, label: str, prediction: str, missed: int = MISSED_DEFECT_COST, scrapped: int = SCRAPPED_GOOD_COST
) -> DataFrame:
    labelled = df.filter(F.col(label).isNotNull())
    counts = labelled.agg(*confusion_counts(F.col(label), F.col(prediction)))
    return counts.select(
        F.col("fn").alias("missed_defects"),
        F.col("fp").alias("scrapped_good"),
        (F.col("fn") * missed + F.col("fp") * scrapped).alias("cost_eur"),
    )
