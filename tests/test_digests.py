import random
import re

from linewright import sources
from linewright.operators import sketches
from linewright.session import scratch_path
from pyspark.sql import functions as F


def snapshot(spark, rows, name):
    path = scratch_path(spark, name)
    df = spark.createDataFrame(rows, "id int, v string, x double, year int, month int")
    sources.overwrite_snapshot(df.repartition(3), path, ["year", "month"])
    return path


def rows(n=200):
    rng = random.Random(4)
    return [(k, rng.choice(["a", "b|", "", None]), rng.choice([None, 0.1, -0.0, 1e300]), 2023 + k % 2, 1 + k % 5) for k in range(n)]


def test_digests_of_parts_make_up_that_of_the_whole(spark):
    df = spark.createDataFrame(rows(), "id int, v string, x double, year int, month int")
    tree = sources.digest_tree(df, ["year", "month"])
    whole = sources.fingerprint(df).first()
    top = tree.filter("depth = 0").first()
    assert (top.row_count, top.digest) == (whole.row_count, whole.digest)
    years = {r.year: (r.row_count, r.digest) for r in tree.filter("depth = 1").collect()}
    assert years == {r.year: (r.row_count, r.digest) for r in sources.fingerprint(df, ["year"]).collect()}
    assert tree.filter("depth = 2").count() == 10
    assert sources.fingerprint(df.filter("id < 0")).first().digest == "0:0"


def test_values_do_not_run_into_each_other(spark):
    digest = lambda *row: sources.fingerprint(spark.createDataFrame([row], "a string, b string")).first().digest
    found = [digest(*r) for r in (("1", "23"), ("12", "3"), ("", "123"), (None, "123"), ("-", "123"), ("1:1", "23"))]
    assert len(set(found)) == len(found)


def test_only_changed_months_are_read(spark):
    old = rows()
    new = [r for r in old if r[0] != 7]  # deleted: year 2024, month 3
    new = [(k, "changed" if k == 20 else v, x, y, m) for k, v, x, y, m in new]  # year 2023, month 1
    new = [(k, v, x, y, 4 if k == 41 else m) for k, v, x, y, m in new]  # moved: 2024, month 2 to month 4
    new.append((999, "new", 1.0, 2025, 12))
    paths = snapshot(spark, old, "old"), snapshot(spark, new, "new")
    trees = [spark.read.parquet(f"{p}.digests") for p in paths]
    parts = sources.changed_partitions(*trees, ["year", "month"])
    assert sorted((p["year"], p["month"]) for p in parts) == [(2023, 1), (2024, 2), (2024, 3), (2024, 4), (2025, 12)]
    changes = sources.snapshot_changes(spark, *paths, ["id"], ["year", "month"])
    assert sorted((r.id, r.op) for r in changes.collect()) == [(7, "D"), (20, "U"), (41, "U"), (999, "I")]
    plan = changes._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[([^\]]*)", plan)
    assert filters and all("year" in f and "month" in f for f in filters)
    assert sources.snapshot_changes(spark, paths[0], paths[0], ["id"], ["year", "month"]).collect() == []


def test_equal_snapshots_and_null_partitions(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "id int, part int")
    tree = sources.digest_tree(df, ["part"])
    other = sources.digest_tree(df.withColumn("id", F.when(F.col("part").isNull(), 5).otherwise(F.col("id"))), ["part"])
    assert sources.changed_partitions(tree, tree, ["part"]) == []
    assert sources.changed_partitions(tree, other, ["part"]) == [{"part": None}]


def test_newest_row_is_hash_aggregated_and_ties_are_one(spark):
    data = [("a", 1, 1), ("a", 2, 1), ("a", 2, 2), ("b", None, 4), ("b", None, 5), (None, 7, 1), (None, 7, 0)]
    df = spark.createDataFrame(data, "k string, t int, e int")
    got = sources.latest_per_key(df, ["k"], ["t", "e"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("a", 2, 2), ("b", None, 5), (None, 7, 1)], key=str)
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    twice = df.unionByName(df)
    assert sources.latest_per_key(twice, ["k"], ["t", "e"]).count() == 3


def test_units_over_any_period(spark):
    df = spark.range(60_000).selectExpr("id % 9000 AS unit", "int(id % 12) AS month", "int(id % 3) AS year")
    parts = sketches.unit_sketches(df, "unit", ["year", "month"])
    whole = sketches.distinct_units(parts, []).first()
    assert whole.total_rows == 60_000 and abs(whole.approx_units - 9000) < 9000 * 4 * 1.04 / 64
    exact = {r.year: r.n for r in df.groupBy("year").agg(F.countDistinct("unit").alias("n")).collect()}
    for r in sketches.distinct_units(parts, ["year"]).collect():
        assert abs(r.approx_units - exact[r.year]) < exact[r.year] * 4 * 1.04 / 64


def test_merged_quantile_sketches(spark):
    df = spark.range(200_000).selectExpr("CASE WHEN id % 7 = 0 THEN NULL ELSE double(id * 7919 % 200000) END AS v", "id % 30 AS part", "double('nan') AS none")
    parts = sketches.quantile_sketches(df, ["v", "none"], ["part"])
    ps = [0.01, 0.25, 0.5, 0.9]
    found = sketches.sketch_quantiles(sketches.merged_sketches(parts, ["v", "none"]), {"v": ps, "none": ps})
    assert found["none"] == [] and all(abs(q / 200_000 - p) < 0.005 for p, q in zip(ps, found["v"]))
    within = lambda pairs, e: sketches.rank_bounds(df, {"v": pairs}, e).first().within
    assert within(list(zip(ps, found["v"])), 0.005)
    assert not within([(0.5, 140_000.0)], 0.005) and within([(0.5, 140_000.0)], 0.25)
