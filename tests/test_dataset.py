from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from linewright.operators import dataset
from linewright.schemas import event_schema


def test_month_arithmetic_clamps():
    assert dataset.minus_months(datetime(2024, 8, 31), 6) == datetime(2024, 2, 29)
    assert dataset.minus_months(datetime(2023, 8, 31), 6) == datetime(2023, 2, 28)
    assert dataset.minus_months(datetime(2024, 2, 29), 24) == datetime(2022, 2, 28)
    assert dataset.minus_months(datetime(2024, 1, 15), 1) == datetime(2023, 12, 15)


def timed(spark, times):
    return spark.createDataFrame([(t, i % 2) for i, t in enumerate(times)], "t timestamp, y int")


def test_no_row_is_lost_at_the_boundaries(spark):
    start = datetime(2020, 1, 1)
    days = timed(spark, [start + timedelta(hours=12 * i) for i in range(0, 2 * 1000)])
    plan = dataset.share_split(days, "t")
    assert plan.train_end == start + timedelta(days=int(0.7 * 999))
    edges = [plan.train_start, plan.train_end, plan.validation_end]
    probes = [e + timedelta(seconds=s) for e in edges for s in (-1, 0, 1, 86399)]
    tagged = dataset.tag_split(timed(spark, probes), "t", plan)
    assert [r.split for r in tagged.collect()] == (
        ["before_window", "train", "train", "train"]
        + ["train", "train", "validation", "validation"]
        + ["validation", "validation", "test", "test"]
    )


def test_rolling_split_plan():
    plan = dataset.rolling_split(datetime(2024, 8, 31))
    assert plan.train_end == datetime(2024, 2, 29) and plan.train_start == datetime(2022, 2, 28)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 3 * 365 * 86400), min_size=2, max_size=40))
def test_split_is_a_partition(spark, offsets):
    df = timed(spark, [datetime(2021, 1, 1) + timedelta(seconds=s) for s in offsets])
    tagged = dataset.tag_split(df, "t", dataset.share_split(df, "t"))
    assert tagged.filter("split IS NULL").count() == 0
    assert tagged.count() == len(offsets)


def test_training_modes(spark):
    df = dataset.calendar_split(
        timed(spark, [datetime(y, 6, 1) for y in (2021, 2022, 2023, 2024)]), "t", 2022, 2023
    )
    counts = {m: dataset.training_rows(df, m).count() for m in dataset.TRAIN_MODES}
    assert counts == {"train": 2, "train_val": 3, "train_val_test": 4}


def test_unlabelled_rows_do_not_weigh(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,), (None,), (None,)], "y int")
    weights = {r.y: r.class_weight for r in dataset.with_class_weights(df, "y").collect()}
    assert weights == {1: 2.0, 0: pytest.approx(4 / 6)}


def test_one_class_only_gets_weight(spark):
    df = spark.createDataFrame([(0,), (0,)], "y int")
    assert {r.class_weight for r in dataset.with_class_weights(df, "y").collect()} == {0.5}


def test_samples(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 4 == 0, 1).when(F.col("id") % 4 == 1, 0).alias("y"))
    drawn = dataset.stratified_sample(df, "y", 1000, ["id"])
    assert drawn.filter("y IS NULL").count() == 0
    assert 900 < drawn.count() < 1100
    assert dataset.stratified_sample(df, "y", 9000, ["id"]).count() == 2000
    a = dataset.keyed_sample(df, "y", ["id"], 0.25)
    b = dataset.keyed_sample(df.repartition(7), "y", ["id"], 0.25)
    ids = lambda d: sorted(r.id for r in d.collect())
    assert ids(a) == ids(b) and 350 < len(ids(a)) < 650


def test_oversample(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, None)], "id int, y int")
    assert sorted(r.id for r in dataset.oversample(df, "y", 1, 3).collect()) == [1, 1, 1, 2, 3]


def test_routes():
    routes = dataset.route_columns(event_schema("inspections", rescue=False), flags=("operator_experience_yrs",))
    assert routes.categorical == ["shift"]
    assert routes.boolean == ["operator_experience_yrs"]
    assert len(routes.numeric) == 14
    widths = StructType.fromDDL("a short, b tinyint, c int, d decimal(9,2), e float, f boolean, g string, h date")
    routes = dataset.route_columns(widths)
    assert (routes.numeric, routes.boolean, routes.categorical) == (["a", "b", "c", "d", "e"], ["f"], ["g"])


def test_prefix_groups():
    groups = dataset.group_by_prefix(["count_tx_30d", "avg_amount", "age", "distinct_mcc", "max_amount_7d"])
    assert groups == {"zero": ["count_tx_30d", "distinct_mcc"], "absent": ["avg_amount", "max_amount_7d"], "plain": ["age"]}


def test_reports(spark):
    df = spark.createDataFrame([("a", 1, 0.1), ("a", None, None), ("b", 0, 0.9)], "u string, y int, p double")
    nulls = {r.column_name: r.null_rows for r in dataset.null_profile(df).collect()}
    assert nulls == {"u": 0, "y": 1, "p": 1}
    row = dataset.summary(df, "u", "y", "p").first()
    assert (row.total_rows, row.unique_units, row.defect_rate, row.min_score) == (3, 2, 0.5, 0.1)
    passed = dataset.checks(df, {"some": F.count(F.lit(1)) > 2, "none": F.max("y") > 1, "unknown": F.max("y") > F.lit(None)})
    assert {r.check_name: r.passed for r in passed.collect()} == {"some": True, "none": False, "unknown": False}
