"""Fraud detection on card transactions: the complete flow on a second table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from ..functions import CARD_FEATURES
from ..ml import models, stages
from ..operators.dataset import Routes, calendar_split, group_by_prefix, route_columns
from ..operators.evaluate import ranking_metrics, weighted_metrics
from ..session import materialize

LABEL = "is_fraud"

# 0/1 columns that are flags, columns that are no features, and the split years.
FLAGS = (
    "cross_border",
    "is_tor_or_vpn",
    "ip_country_match",
    "device_fingerprint_known",
    "two_fa_enabled",
    "email_verified",
    "phone_verified",
)
NO_FEATURES = (LABEL, "customer_id", "transaction_id", "merchant_id", "mcc_code", "timestamp")
LAST_TRAIN_YEAR, LAST_VALIDATION_YEAR = 2022, 2023


def split(df: DataFrame) -> DataFrame:
    """Transactions tagged by calendar year."""
    return calendar_split(df, "timestamp", LAST_TRAIN_YEAR, LAST_VALIDATION_YEAR)


def routes(schema: StructType) -> Routes:
    return route_columns(schema, exclude=(*NO_FEATURES, "split"), flags=FLAGS)


def preparation(schema: StructType) -> list:
    """Aggregates that start at zero skip imputation; derived features use the transaction only,
    and a condition that cannot be decided counts as not met."""
    found = routes(schema)
    complete = tuple(group_by_prefix(found.numeric)["zero"])
    derived = {
        name: sql if name == "amount_log" else f"coalesce({sql}, 0)" for name, sql in CARD_FEATURES.items()
    }
    return stages.preparation(found, derived, complete)


def compare_models(tagged: DataFrame) -> DataFrame:
    """Logistic regression, random forest and boosted trees, trained on the training years and
    measured on the test years: one row per model, best area under the PR curve first."""
    train, test = tagged.filter("split = 'train'"), tagged.filter(f"split = 'test' AND {LABEL} IS NOT NULL")
    rows = []
    for name, classifier in {
        "logistic_regression": models.logistic(LABEL),
        "random_forest": models.forest(LABEL),
        "gradient_boosting": models.boosted(LABEL),
    }.items():
        model = models.fit(preparation(tagged.schema), classifier, train, LABEL)
        narrow = models.score(model, test).select(LABEL, "probability_defective", "prediction")
        scored = materialize(narrow, f"cards_{name}")
        ranking = ranking_metrics(scored, LABEL, "probability_defective").first()
        weighted = weighted_metrics(scored, LABEL, "prediction").first()
        rows.append((name, ranking["auc_pr_trapezoid"], ranking["auc_roc"], *weighted))
    schema = (
        "model string, auc_pr double, auc_roc double, weighted_precision double, weighted_recall double, "
        "weighted_f1 double"
    )
    return tagged.sparkSession.createDataFrame(rows, schema).orderBy("auc_pr", ascending=False)
