"""Feature pipelines and models over the line items. Iterative fits have no SQL twin."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..ml import models, stages
from ..operators import dataset, evaluate
from ..session import materialize
from .registry import labelled_lines, query

_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus", "is_first_line"]
_SKIPPED = ("l_orderkey", "l_linenumber", "l_shipdate", "label")


def _rows(spark, folder):
    lines = labelled_lines(spark, folder).withColumn("is_first_line", F.col("l_linenumber") == 1)
    kept = lines.select(*_SKIPPED, *_COLUMNS).withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    return dataset.tag_split(kept, "l_shipdate", dataset.rolling_split(datetime(2000, 12, 31)))


def _stages(df):
    routes = dataset.route_columns(df.schema, exclude=(*_SKIPPED, "split"))
    return stages.preparation(routes, derived={"price_log": "ln(l_extendedprice + 1)"}, complete=("l_quantity",))


def _train(df):
    return dataset.training_rows(df, "train")


@query("prepared_features")
def _(spark, folder):
    rows = _rows(spark, folder)
    model = Pipeline(stages=_stages(rows)).fit(_train(rows))
    return model.transform(rows).select("l_orderkey", "l_linenumber", vector_to_array(stages.FEATURES).alias("features"))


@query("selected_features")
def _(spark, folder):
    rows = _rows(spark, folder).filter("label IS NOT NULL")
    prepared = _stages(rows)
    assembled = Pipeline(stages=prepared[:-2]).fit(rows).transform(rows)
    names = stages.vector_names(assembled)
    discrete = VectorAssembler(inputCols=["l_quantity", "l_linenumber", "is_first_line"], outputCol="features")
    counted = discrete.transform(rows)
    chosen = {
        "variance": [names[i] for i in prepared[-2].fit(assembled).selectedFeatures],
        "anova": [names[i] for i in stages.anova_selector("label", 3).fit(assembled).selectedFeatures],
        "chi_square": [
            discrete.getInputCols()[i] for i in stages.chi_square_selector("label", 2).fit(counted).selectedFeatures
        ],
    }
    rows_out = [(kind, name) for kind, found in chosen.items() for name in found]
    return spark.createDataFrame(rows_out, "selector string, feature string")


@query("logistic_coefficients")
def _(spark, folder):
    rows = _rows(spark, folder)
    return models.coefficients(models.fit(_stages(rows), models.logistic("label"), _train(rows), "label"), rows)


@query("logistic_convergence")
def _(spark, folder):
    rows = _rows(spark, folder)
    return models.convergence(models.fit(_stages(rows), models.logistic("label"), _train(rows), "label"), rows)


@query("logistic_scores")
def _(spark, folder):
    rows = _rows(spark, folder)
    model = models.fit(_stages(rows), models.logistic("label"), _train(rows), "label")
    return models.scored_baseline(model, rows.filter("split = 'test'"), 1).drop("inference_timestamp")


@query("forest_importances")
def _(spark, folder):
    rows = _rows(spark, folder)
    return models.importances(models.fit(_stages(rows), models.forest("label"), _train(rows), "label"), rows)


@query("boosted_metrics")
def _(spark, folder):
    rows = _rows(spark, folder)
    model = models.fit(_stages(rows), models.boosted("label"), _train(rows), "label")
    scored = models.score(model, rows.filter("split = 'test'")).select("label", "probability_defective")
    return evaluate.ranking_metrics(scored, "label", "probability_defective")  # one pass over the model's scores


@query("weighted_metrics")
def _(spark, folder):
    rows = _rows(spark, folder)
    model = models.fit(_stages(rows), models.forest("label"), _train(rows), "label")
    return evaluate.weighted_metrics(models.score(model, rows.filter("split = 'test'")), "label", "prediction")


@query("grid_search")
def _(spark, folder):
    rows = _rows(spark, folder)
    runs, _, _ = models.grid_search(_stages(rows), _train(rows), rows.filter("split = 'validation'"), "label")
    return runs.drop("run_id", "parent_run_id")


@query(
    "model_checks",
    """SELECT unnest(['gradient', 'intercept', 'scores', 'loss', 'importances', 'boosted_ranks']) AS check_name, true AS passed""",
)
def _(spark, folder):
    """What has to hold for fitted models, whatever the way of the fit: the penalised loss is flat at the coefficients, scores are
    the logistic function of coefficients times features, the loss never rises, importances share out one, and boosted trees rank
    test rows better than chance."""
    rows = _rows(spark, folder)
    train = materialize(_train(rows).filter("label IS NOT NULL"), "train")
    reg = 0.01
    model = models.fit(_stages(rows), models.logistic("label", reg=reg), train, "label")
    last = model.stages[-1]
    weighted = dataset.with_class_weights(train, "label", models.WEIGHT)
    found = model.transform(weighted).select(
        vector_to_array(stages.FEATURES).alias("x"), vector_to_array("probability")[1].alias("p"), F.col("label").cast("double").alias("y"), models.WEIGHT
    )
    slopes = [float(b) for b in last.coefficients.toArray()]
    margin = sum((F.col("x")[i] * b for i, b in enumerate(slopes)), F.lit(float(last.intercept)))
    weight, miss = F.sum(models.WEIGHT), F.col(models.WEIGHT) * (F.col("p") - F.col("y"))
    steep = [F.abs(F.sum(miss * F.col("x")[i]) / weight + reg * b) for i, b in enumerate(slopes)]
    apart = F.max(F.abs(F.col("p") - 1 / (1 + F.exp(-margin))))
    history = last.summary.objectiveHistory
    forest = models.fit(_stages(rows), models.forest("label"), train, "label").stages[-1].featureImportances.toArray()
    boosted = models.fit(_stages(rows), models.boosted("label"), train, "label")
    ranks = evaluate.ranking_metrics(models.score(boosted, train).select("label", "probability_defective"), "label", "probability_defective").first()
    conditions = {
        "gradient": F.greatest(*steep, F.lit(0.0)) < 1e-3,
        "intercept": F.abs(F.sum(miss) / weight) < 1e-3,
        "scores": apart < 1e-9,
        "loss": F.lit(all(a >= b - 1e-12 for a, b in zip(history, history[1:]))),
        "importances": F.lit(bool((forest >= 0).all() and abs(forest.sum() - 1) < 1e-9)),
        "boosted_ranks": F.lit(ranks["auc_roc"] > 0.5),
    }
    return dataset.checks(found, conditions)
