"""Challenger against champion on the test rows, refit, aliases and the monitoring baseline."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..ml import models
from ..ml.store import ModelStore
from ..operators.dataset import training_rows
from ..operators.lifecycle import decision_changes, promotion_decision, promotion_events, registration_changes
from ..session import materialize
from ..sources.writers import overwrite, overwrite_table, set_properties

METRIC = "avg_precision"


def publish_baseline(scored: DataFrame, table: str, measures: dict, version: int, test_end: str) -> None:
    """The scored test rows as a catalogue table that carries what is needed to compare with
    it: rows, measures, model version and the day the test rows end."""
    overwrite_table(scored, table, "Scored test rows of the current champion")
    facts = {f"baseline.{k}": v for k, v in measures.items() if v is not None}
    rows = scored.sparkSession.table(table).count()
    set_properties(
        scored.sparkSession,
        table,
        {**facts, "baseline.rows": rows, "baseline.model_version": version, "baseline.test_end": test_end},
    )


@dataclass
class Promotion:
    promoted: bool
    decision: DataFrame
    events: DataFrame
    challenger_model: PipelineModel
    champion: PipelineModel | None


def promote(
    stages: list,
    tagged: DataFrame,
    label: str,
    settings: dict,
    challenger_version: int,
    champion: tuple[int, PipelineModel] | None,
    baseline_path: str,
    classifier=models.logistic,
    store: ModelStore | None = None,
    baseline_table: str | None = None,
    run_id: str | None = None,
    test_end: str = "",
) -> Promotion:
    """Retrain the chosen setting on training and validation rows and measure it, and the
    champion, on the labelled test rows. If it is strictly better, it is refitted on everything as
    the next version, becomes champion, and its scored test rows become the baseline.

    With a ``store`` the champion is the stored one unless another is handed in, a new champion is stored with its threshold, run,
    measures and time before the pointer moves, and every step is appended to the log of alias changes. With a ``baseline_table``
    the baseline is published there with the same facts.
    """
    spark = tagged.sparkSession
    test = tagged.filter("split = 'test'")
    if champion is None and store and (stored := store.champion()):
        champion = stored[:2]

    def fitted(mode: str) -> PipelineModel:
        return models.fit(stages, classifier(label, **settings), training_rows(tagged, mode), label)

    def measured(model: PipelineModel) -> dict:
        scored = models.score(model, test.filter(F.col(label).isNotNull()))
        return models.measure(materialize(scored.select(label, "probability_defective"), "scores"), label)

    challenger = fitted("train_val")
    ours = measured(challenger)
    theirs = measured(champion[1]) if champion else None
    one = lambda rows: spark.createDataFrame(rows, f"version int, {METRIC} double")
    decision = promotion_decision(
        one([(challenger_version, ours[METRIC])]),
        one([(challenger_version, theirs[METRIC])] if theirs else []),
        "version",
        METRIC,
    )
    wins = decision.first()["promoted"]
    tags = {"test_avg_precision": f"{ours[METRIC]:.4f}", **{k: str(v) for k, v in settings.items()}}
    final = challenger_version + 1 if wins else None
    outcome = (wins, challenger_version, final, champion[0] if champion else None, tags)
    events = promotion_events(tagged, *outcome)
    final_model = None
    facts = {"run_id": run_id, "threshold": ours["best_threshold"], "settings": settings, "measures": ours}
    facts["trained_at"] = datetime.now(timezone.utc).isoformat(timespec="seconds")
    if wins:
        final_model = fitted("train_val_test")
        scored = models.scored_baseline(final_model, test, final)
        overwrite(scored, baseline_path)
        if baseline_table:
            published = {**ours, "threshold": ours["best_threshold"], "run_id": run_id, "promoted_at": facts["trained_at"]}
            publish_baseline(spark.read.parquet(baseline_path), baseline_table, published, final, test_end)
    if store:
        changes = registration_changes(challenger_version, {**tags, "run_id": run_id or ""})
        if wins:
            store.save(final, final_model, facts)
            changes += registration_changes(final, {"refit_of": str(challenger_version)})
            changes.append((challenger_version, "retired", {"why": f"refitted as version {final}"}))
        store.append(changes + decision_changes(*outcome))
        if wins:
            store.crown(final)
    return Promotion(wins, decision, events, challenger, final_model)
