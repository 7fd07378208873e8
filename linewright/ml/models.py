"""Classifiers, scoring, search over settings, and promotion."""

from __future__ import annotations

import itertools
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluate
from ..operators.dataset import with_class_weights
from ..session import materialize
from ..sources.digests import fingerprint
from .stages import FEATURES, selected_names

WEIGHT = "class_weight"

# The searched settings.
REG_PARAMS = [0.001, 0.01, 0.1]
ELASTIC_NET_PARAMS = [0.0, 0.5]
MAX_ITERS = [100]
RETRIES = 3


def logistic(label: str, reg: float = 0.01, elastic_net: float = 0.0, max_iter: int = 100) -> LogisticRegression:
    """Weighted logistic regression; features are already scaled."""
    return LogisticRegression(
        featuresCol=FEATURES,
        labelCol=label,
        weightCol=WEIGHT,
        family="binomial",
        regParam=reg,
        elasticNetParam=elastic_net,
        maxIter=max_iter,
        standardization=False,
    )


def forest(label: str, trees: int = 5, depth: int = 4, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=FEATURES,
        labelCol=label,
        weightCol=WEIGHT,
        numTrees=trees,
        maxDepth=depth,
        maxBins=32,
        featureSubsetStrategy="sqrt",
        seed=seed,
    )


def boosted(label: str, rounds: int = 5, step: float = 0.1, depth: int = 4, seed: int = 42) -> GBTClassifier:
    """Gradient-boosted trees, unweighted: imbalance is left to the decision threshold."""
    return GBTClassifier(
        featuresCol=FEATURES,
        labelCol=label,
        maxIter=rounds,
        stepSize=step,
        maxDepth=depth,
        subsamplingRate=0.8,
        seed=seed,
    )


def _trainable(df: DataFrame, label: str) -> DataFrame:
    return with_class_weights(df, label, WEIGHT).withColumn(label, F.col(label).cast("double"))


def fit(stages: list, classifier, df: DataFrame, label: str) -> PipelineModel:
    """Fit preparation and classifier on all labelled rows, as one model over raw columns.

    The raw rows are read once and stored; class sizes and each stage of the preparation are fitted on these, and the classifier
    on the stored vectors, so neither the stages nor its rounds read the lineage again."""
    stored = materialize(df.filter(F.col(label).isNotNull()), "training-rows")
    preparer, vectors = prepared(stages, _trainable(stored, label), label)
    return PipelineModel(stages=[*preparer.stages, classifier.fit(vectors)])


def prepared(stages: list, trainable: DataFrame, label: str) -> tuple[PipelineModel, DataFrame]:
    """The fitted preparation, and the vectors, labels and weights of the rows it was fitted on, stored."""
    preparer = Pipeline(stages=stages).fit(trainable)
    return preparer, materialize(preparer.transform(trainable).select(FEATURES, label, WEIGHT), "vectors")


def score(model, df: DataFrame) -> DataFrame:
    """The input columns with probability of a defect and hard prediction; vectors are dropped."""
    scored = model.transform(df)
    probability = vector_to_array("probability")[1]
    return scored.select(*df.columns, probability.alias("probability_defective"), "prediction")


def scored_baseline(model, df: DataFrame, version: int) -> DataFrame:
    """Scored rows with model version and time, the table that monitoring compares against."""
    return score(model, df).withColumns(
        {"model_version": F.lit(version), "inference_timestamp": F.current_timestamp()}
    )


def coefficients(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Coefficient per feature name, with its size."""
    values = [float(v) for v in model.stages[-1].coefficients.toArray()]
    rows = list(zip(selected_names(model, df), values))
    table = df.sparkSession.createDataFrame(rows, "feature string, coefficient double")
    return table.withColumn("size", F.abs("coefficient")).orderBy(F.col("size").desc(), "feature")


def importances(model: PipelineModel, df: DataFrame) -> DataFrame:
    values = [float(v) for v in model.stages[-1].featureImportances.toArray()]
    rows = list(zip(selected_names(model, df), values))
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    )


def convergence(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Loss per iteration with intercept and whether training stopped before its limit."""
    last = model.stages[-1]
    history = last.summary.objectiveHistory
    done = last.summary.totalIterations < last.getMaxIter()
    rows = [(i, float(loss), last.intercept, done) for i, loss in enumerate(history)]
    return df.sparkSession.createDataFrame(
        rows, "iteration int, loss double, intercept double, converged boolean"
    )


def measure(scored: DataFrame, label: str) -> dict[str, float | None]:
    """Ranking measures, measures at the threshold 0.5, and the best threshold, in three passes
    over label and score: hand in a stored frame, not a model's lineage."""
    p = "probability_defective"
    ranking = evaluate.ranking_metrics(scored, label, p).first().asDict()
    found = {**ranking, **evaluate.threshold_summary(scored, label, p).first().asDict()}
    return {k: float(v) if v is not None else None for k, v in found.items()}


MEASURES = ["avg_precision", "auc_roc", "auc_pr_trapezoid", "precision", "recall", "f1", "accuracy"]


def _runs_schema(settings: Sequence[str]) -> str:
    parts = ["run_id string", "parent_run_id string", "run_type string", "status string", "error string"]
    parts += [f"{s} string" for s in settings]
    parts += [f"{side}_{m} double" for side in ("train", "val", "gap") for m in MEASURES]
    parts += ["best_threshold double", "best_f1 double", "iterations int", "converged boolean", "final_loss double"]
    parts += [f"{side}_{fact}" for side in ("train", "val") for fact in ("rows long", "digest string")]
    return ", ".join([*parts, "preparation string"])


@dataclass
class _Trial:
    """One setting of a search: its model and measures, or why there is none."""

    settings: dict
    model: object = None
    problem: str | None = None
    measures: dict[str, dict[str, float | None]] = field(default_factory=dict)
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)

    def row(self, parent: str) -> dict:
        """The trial as a row of the runs table."""
        status = "failed" if self.model is None else "finished"
        out = {"run_id": self.run_id, "parent_run_id": parent, "run_type": "training", "status": status, "error": self.problem}
        out |= {name: str(value) for name, value in self.settings.items()}
        out |= {f"{side}_{m}": found[m] for side, found in self.measures.items() for m in MEASURES}
        for m in MEASURES if self.measures else ():
            ours, theirs = out[f"train_{m}"], out[f"val_{m}"]
            out[f"gap_{m}"] = None if ours is None or theirs is None else ours - theirs
        return out | self._convergence() | {name: self.measures.get("val", {}).get(name) for name in ("best_threshold", "best_f1")}

    def _convergence(self) -> dict:
        """Iterations, whether they ended before their limit, and the last loss; nothing for models that don't iterate."""
        if self.model is None or not getattr(self.model, "hasSummary", False) or not hasattr(self.model.summary, "totalIterations"):
            return {}
        summary = self.model.summary
        done = summary.totalIterations < self.model.getMaxIter()
        return {"iterations": summary.totalIterations, "converged": done, "final_loss": float(summary.objectiveHistory[-1])}


def _train(build: Callable, settings: dict, vectors: DataFrame, attempts: int) -> _Trial:
    """Fit one setting. A job that Spark gave up (lost executors, for one) is run again, up to ``attempts`` times in all;
    a setting that the classifier refuses is not."""
    try:
        estimator = build()
        while True:
            try:
                return _Trial(settings, estimator.fit(vectors))
            except Py4JJavaError:
                attempts -= 1
                if attempts < 1:
                    raise
    except (ValueError, TypeError, PySparkException, Py4JJavaError) as refusal:
        return _Trial(settings, problem=next(iter(str(refusal).splitlines()), type(refusal).__name__))


def _described(stages: list) -> str:
    """The stages and the settings that were made, as JSON."""
    plain = lambda v: v if isinstance(v, (str, int, float, bool, list, type(None))) else str(v)
    listed = [{"stage": type(s).__name__, **{p.name: plain(v) for p, v in s.extractParamMap().items() if s.isSet(p)}} for s in stages]
    return json.dumps(listed, sort_keys=True)


def grid_search(
    stages: list,
    train: DataFrame,
    validation: DataFrame,
    label: str,
    classifier: Callable = logistic,
    grid: dict[str, list] | None = None,
    retries: int = RETRIES,
) -> tuple[DataFrame, PipelineModel, dict]:
    """Train one classifier per setting and measure it on training and validation rows.

    Preparation is fitted once on the training rows; both parts are prepared once and written,
    so each setting reads vectors only. A setting that can't be trained becomes a failed run and
    the rest goes on; if none can, the search fails. The models' scores are written side by side
    in one table, which the measures read. Returns the table of runs, the best model (by
    validation average precision) over raw columns, and its row. A run's row also holds the gaps between training and
    validation, how the training ended, the fingerprints of both parts and the stages of the preparation with their settings.
    """
    grid = grid or {"reg": REG_PARAMS, "elastic_net": ELASTIC_NET_PARAMS, "max_iter": MAX_ITERS}
    spark, parent = train.sparkSession, uuid.uuid4().hex
    train, validation = materialize(train, "train-rows"), materialize(validation, "val-rows")
    facts = {"preparation": _described(stages)}
    for side, rows in (("train", train), ("val", validation)):
        found = fingerprint(rows).first()
        facts |= {f"{side}_rows": found["row_count"], f"{side}_digest": found["digest"]}
    train, validation = _trainable(train, label), _trainable(validation, label)
    preparer = Pipeline(stages=stages).fit(train)

    def part(df: DataFrame, name: str) -> DataFrame:
        return preparer.transform(df).select(FEATURES, label, WEIGHT, F.lit(name).alias("part"))

    vectors = materialize(part(train, "train").unionByName(part(validation, "val")), "vectors")

    trained = vectors.filter("part = 'train'")
    trials = [
        _train(lambda s=settings: classifier(label, **s), settings, trained, retries)
        for settings in (dict(zip(grid, values)) for values in itertools.product(*grid.values()))
    ]
    able = [t for t in trials if t.model is not None]
    if not able:
        raise RuntimeError(f"no setting could be trained: {[t.problem for t in trials]}")

    # the scores of all settings side by side, written in one pass over the vectors
    wide = vectors.select("part", label, FEATURES)
    for i, trial in enumerate(able):
        probability = vector_to_array("probability")[1].alias(f"score_{i}")
        wide = trial.model.transform(wide).select(*wide.columns, probability)
    wide = materialize(wide.drop(FEATURES), "scores")
    for i, trial in enumerate(able):
        scored = wide.select("part", label, F.col(f"score_{i}").alias("probability_defective"))
        for side in ("train", "val"):
            trial.measures[side] = measure(scored.filter(F.col("part") == side), label)

    schema = _runs_schema(list(grid))
    columns = [part.split()[0] for part in schema.split(", ")]
    rows = [t.row(parent) | facts for t in trials]
    runs = spark.createDataFrame([tuple(map(r.get, columns)) for r in rows], schema)
    ranked = sorted(able, key=lambda t: t.measures["val"]["avg_precision"] or 0.0, reverse=True)
    return runs, PipelineModel(stages=[*preparer.stages, ranked[0].model]), ranked[0].row(parent) | facts
