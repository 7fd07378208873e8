import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from linewright.ml import models, stages
from linewright.operators.dataset import route_columns

SCHEMA = "id int, a double, b double, c string, flag int, constant double, y int"


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        a = rng.gauss(0, 1)
        y = None if i % 20 == 0 else int(a + rng.gauss(0, 0.3) > 0.8)
        rows.append((i, None if i % 15 == 1 else a, rng.random(), rng.choice(["p", "q", None]), i % 2, 1.0, y))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def prepared(data):
    routes = route_columns(data.schema, exclude=("id", "y"), flags=("flag",))
    return stages.preparation(routes, derived={"b_log": "ln(b + 1)"})


@pytest.fixture(scope="module")
def model(data, prepared):
    return models.fit(prepared, models.logistic("y", reg=0.01), data, "y")


def test_constant_feature_is_dropped_and_names_follow(data, model):
    names = stages.selected_names(model, data)
    assert "constant_imp" not in names and "a_imp" in names and "flag_dbl" in names
    table = models.coefficients(model, data).collect()
    assert table[0].feature == "a_imp" and [r["size"] for r in table] == sorted((r["size"] for r in table), reverse=True)


def test_scores_keep_rows_and_columns(data, model):
    scored = models.scored_baseline(model, data, 4)
    assert scored.count() == 400
    assert scored.columns == [*data.columns, "probability_defective", "prediction", "model_version", "inference_timestamp"]
    assert scored.filter("probability_defective < 0 OR probability_defective > 1").count() == 0


def test_unseen_category_scores(data, model):
    new = data.limit(3).withColumn("c", F.lit("never seen"))
    assert models.score(model, new).count() == 3


def test_saved_model_starts_from_raw_columns(data, model, tmp_path):
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    ours = models.score(model, data).select("id", "probability_defective").collect()
    assert models.score(again, data).select("id", "probability_defective").collect() == ours


def test_convergence_table(data, model):
    rows = models.convergence(model, data).orderBy("iteration").collect()
    assert rows[0].loss >= rows[-1].loss and rows[0].converged


def test_forest_and_boosting(data, prepared):
    forest = models.fit(prepared, models.forest("y"), data, "y")
    assert models.importances(forest, data).first().feature == "a_imp"
    boosted = models.fit(prepared, models.boosted("y"), data, "y")
    assert models.measure(models.score(boosted, data), "y")["auc_roc"] > 0.9


def test_preparation_is_fitted_on_training_rows_only(data, prepared):
    train = data.filter("id < 200")
    fitted = Pipeline(stages=prepared).fit(train)
    want = train.agg(F.percentile_approx("a", 0.5)).first()[0]
    assert fitted.stages[0].surrogateDF.first()["a"] == pytest.approx(want)


def test_grid_goes_on_after_a_failing_setting(data, prepared):
    def classifier(label, reg):
        if reg < 0:
            raise ValueError("bad setting\nsecond line")
        return models.logistic(label, reg=reg, max_iter=10)

    train, validation = data.filter("id < 300"), data.filter("id >= 300")
    runs, best_model, best = models.grid_search(
        prepared, train, validation, "y", classifier, {"reg": [0.01, -1.0, 10.0]}, retries=2
    )
    rows = {r.reg: r for r in runs.collect()}
    assert rows["-1.0"].status == "failed" and rows["-1.0"].error == "bad setting"
    assert best["val_avg_precision"] == max(r.val_avg_precision for r in rows.values() if r.status == "finished")
    assert models.measure(models.score(best_model, validation), "y")["avg_precision"] == pytest.approx(
        best["val_avg_precision"]
    )
    with pytest.raises(RuntimeError):
        models.grid_search(prepared, train, validation, "y", classifier, {"reg": [-1.0]}, retries=1)


def test_promotion_flow(spark, data, prepared, tmp_path):
    from linewright.plans.promotion import promote, publish_baseline
    from linewright.sources import get_properties

    tagged = data.withColumn(
        "split", F.when(F.col("id") < 200, "train").when(F.col("id") < 300, "validation").otherwise("test")
    )
    first = promote(prepared, tagged, "y", {"reg": 0.01}, 1, None, str(tmp_path / "baseline"))
    assert first.promoted and first.champion is not None
    baseline = spark.read.parquet(str(tmp_path / "baseline"))
    assert baseline.count() == 100 and "probability_defective" in baseline.columns
    publish_baseline(baseline, "test_baseline", {"avg_precision": 0.5, "auc_roc": None}, 2, "2024-02-01")
    facts = get_properties(spark, "test_baseline")
    spark.sql("DROP TABLE test_baseline")
    assert (facts["baseline.rows"], facts["baseline.avg_precision"]) == ("100", "0.5")
    assert "baseline.auc_roc" not in facts
    aliases = {r.version: r.alias for r in first.events.collect()}
    assert aliases == {2: "champion"}
    again = promote(prepared, tagged, "y", {"reg": 0.01}, 3, (2, first.challenger_model), str(tmp_path / "b2"))
    assert not again.promoted  # the same model ties and the champion stays
    assert {r.version: r.alias for r in again.events.collect()} == {3: "rejected"}


def test_two_promotions_in_a_row(spark, data, prepared, tmp_path):
    """The second run takes its champion from the store; the log tells the whole story and takes no illegal step."""
    from linewright.ml.store import ModelStore
    from linewright.plans.promotion import promote
    from linewright.sources import get_properties

    tagged = data.withColumn(
        "split", F.when(F.col("id") < 200, "train").when(F.col("id") < 300, "validation").otherwise("test")
    )
    store = ModelStore(spark, str(tmp_path / "store"))
    assert store.champion() is None and store.events().count() == 0

    def go(version, settings):
        facts = dict(store=store, baseline_table="store_baseline", run_id=f"run{version}", test_end="2024-02-01")
        return promote(prepared, tagged, "y", settings, version, None, str(tmp_path / f"baseline{version}"), **facts)

    first = go(1, {"reg": 50.0, "max_iter": 1})
    assert first.promoted and store.champion()[0] == 2
    stored = store.champion()[2]
    assert stored["run_id"] == "run1" and 0 <= stored["threshold"] <= 1 and stored["settings"] == {"reg": 50.0, "max_iter": 1}
    again = models.score(store.champion()[1], tagged).select("id", "probability_defective").collect()
    assert {tuple(r) for r in again} == {tuple(r) for r in models.score(first.champion, tagged).select("id", "probability_defective").collect()}
    tie = go(3, {"reg": 50.0, "max_iter": 1})
    assert not tie.promoted or tie.decision.first().delta > 0  # measured against the stored champion
    state = {r.version: r.alias for r in store.aliases().collect()}
    assert state[1] == "retired" and state[3] in ("rejected", "retired")
    assert sum(alias == "champion" for alias in state.values()) == 1
    facts = get_properties(spark, "store_baseline")
    spark.sql("DROP TABLE store_baseline")
    assert facts["baseline.run_id"] in ("run1", "run3") and float(facts["baseline.threshold"]) == store.champion()[2]["threshold"]
    before = store.events().count()
    for version, alias in ((7, "champion"), (1, "champion"), (store.champion()[0], "candidate")):
        with pytest.raises(ValueError):
            store.append([(8, "candidate", {}), (version, alias, {})])
    assert store.events().count() == before
    with pytest.raises(ValueError):
        store.crown(42)


def test_a_fit_reads_its_rows_once(spark, data, prepared):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    watched = data.withColumn("b", counted("b"))
    model = models.fit(prepared, models.logistic("y"), watched, "y")
    assert 0 < seen.value <= data.count()
    plain = models.fit(prepared, models.logistic("y"), data, "y")
    assert model.stages[-1].coefficients.toArray().tolist() == pytest.approx(plain.stages[-1].coefficients.toArray().tolist())


def test_run_rows_are_complete(spark, data, prepared):
    train, validation = data.filter("id < 200"), data.filter("id >= 200")
    grid = {"reg": [0.01, 1.0], "max_iter": [1, 100]}
    runs, _, best = models.grid_search(prepared, train, validation, "y", grid=grid)
    for r in runs.collect():
        assert r.gap_auc_roc == pytest.approx(r.train_auc_roc - r.val_auc_roc)
        assert (r.train_rows, r.val_rows) == (200, data.count() - 200) and r.train_digest != r.val_digest
        assert r.iterations <= int(r.max_iter) and r.converged == (r.iterations < int(r.max_iter)) and r.final_loss > 0
        assert "Imputer" in r.preparation
    assert best["train_digest"] == runs.first().train_digest
