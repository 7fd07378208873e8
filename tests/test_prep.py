import itertools
import math

import pytest
from pyspark.ml.feature import MinMaxScaler, Normalizer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array

from linewright.functions import as_flag, parse_timestamp, percent, seconds_of
from linewright.operators import prep
from linewright.operators import ranking
from linewright.session import materialize
from pyspark.sql import functions as F


def test_durations():
    assert [seconds_of(d) for d in ("1 hour", "24 hours", "7 days", "90 seconds")] == [3600, 86400, 604800, 90]
    with pytest.raises(ValueError):
        seconds_of("2 months")


def test_bad_time_text_becomes_null(spark):
    df = spark.createDataFrame([("2024-02-30",), ("junk",), ("2024-02-29 10:00:00",), (None,)], "s string")
    assert [r[0] is None for r in df.select(parse_timestamp("s")).collect()] == [True, True, False, True]


def test_flags_and_percent(spark):
    df = spark.createDataFrame([(1, 0), (None, 4)], "a int, b int")
    assert [tuple(r) for r in df.select(as_flag("a"), percent(F.col("a"), F.col("b"))).collect()] == [
        (1.0, None),
        (0.0, None),
    ]


def test_imputation(spark):
    df = spark.createDataFrame([(1.0, None, "x"), (3.0, None, "y"), (None, None, "z")], "a double, b double, c string")
    values = prep.fit_imputer(df, ["a", "b"])
    assert values == {"a": 1.0}
    out = prep.impute(df, values, ["a", "b"])
    assert out.columns == ["a_imp", "b_imp", "c"]
    assert [r.a_imp for r in out.collect()] == [1.0, 3.0, 1.0]
    assert prep.fit_imputer(df, ["a"], strategy="mean") == {"a": 2.0}


@pytest.mark.parametrize("few", [3, 50, 100_000])
def test_exact_quantiles(spark, monkeypatch, few):
    import random

    monkeypatch.setattr(ranking, "FEW", few)
    rng = random.Random(4)
    # a third of the rows share one value
    values = [7.5] * 400 + [rng.uniform(-50, 50) for _ in range(800)] + [None] * 20
    rng.shuffle(values)
    df = spark.createDataFrame([(v, None if v is None else -v) for v in values], "a double, b double")
    ps = [0.0, 0.1, 0.25, 0.5, 0.6, 0.999, 1.0]
    got = ranking.exact_quantiles(df, {"a": ps, "b": [0.5]})
    for column, sign in (("a", 1), ("b", -1)):
        ordered = sorted(sign * v for v in values if v is not None)
        want = [ordered[max(1, math.ceil(p * len(ordered))) - 1] for p in (ps if column == "a" else [0.5])]
        assert got[column] == want
    empty = df.filter("a IS NULL")
    assert ranking.exact_quantiles(empty, {"a": [0.5]}) == {"a": [None]}


def test_cumulative_sums_with_few_and_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(ranking, "FAN", 7)
    points = materialize(spark.createDataFrame([(float(v), v % 3) for v in range(100)], "v double, n int"), "points")
    for range_rows in (1, 3, 40, 1000):
        for descending in (False, True):
            got = {r.v: r.cum_n for r in ranking.cumulate(points, "v", ["n"], descending, range_rows).collect()}
            seen, total = {}, 0
            for v in sorted(range(100), reverse=descending):
                total += v % 3
                seen[float(v)] = total
            assert got == seen
    assert ranking.cumulate(points.limit(0), "v", ["n"]).collect() == []


def test_three_thousand_ranges(spark):
    """More than one block of ranges; every value's sum is that of all before it."""
    points = materialize(spark.range(9000).selectExpr("double(id * 7919 % 9000) AS v", "id % 5 AS n", "1L AS one"), "points")
    got = ranking.cumulate(points, "v", ["n", "one"], range_rows=3)
    rows = got.orderBy("v").collect()
    assert [r.cum_one for r in rows] == list(range(1, 9001))
    assert [r.cum_n for r in rows] == list(itertools.accumulate(r.n for r in rows))


def test_categories_match_mllib(spark):
    rows = [("b",), ("b",), ("a",), ("c",), ("a",), (None,)]
    df = spark.createDataFrame(rows, "k string")
    def listed(categories):
        assert categories.sizes == {"k": categories.table.count()}
        return {"k": [r.category for r in categories.table.orderBy("idx").collect()]}

    fitted = prep.fit_categories(df, ["k"])
    assert listed(fitted) == {"k": ["a", "b", "c"]}  # a and b tie
    new = spark.createDataFrame([("a",), ("b",), ("c",), ("zzz",), (None,)], "k string")
    ours = {r.k: r.k_idx for r in prep.index_categories(new, fitted).collect()}
    model = StringIndexer(inputCol="k", outputCol="i", handleInvalid="keep").fit(df)
    assert ours == {r.k: r.i for r in model.transform(new).collect()}
    hot = prep.one_hot(prep.index_categories(new, fitted), fitted)
    assert [c for c in hot.columns if "ohe" in c] == ["k_ohe"]
    slots = {r.k: (r.k_ohe.size, r.k_ohe.indices, r.k_ohe["values"]) for r in hot.collect()}
    none = (2, [], [])
    assert slots == {"a": (2, [0], [1.0]), "b": (2, [1], [1.0]), "c": none, "zzz": none, None: none}
    kept = prep.one_hot(prep.index_categories(new, fitted), fitted, drop_last=False)
    assert {r.k: r.k_ohe.indices for r in kept.collect()} == {"a": [0], "b": [1], "c": [2], "zzz": [], None: []}
    assert listed(prep.fit_categories(df, ["k"], order="alphabet")) == {"k": ["a", "b", "c"]}


def test_any_number_of_categories(spark):
    many = F.concat(F.lit("v"), F.col("id").cast("string"))
    df = spark.range(50_000).select(many.alias("a"), (F.col("id") % 3).alias("b"), F.lit(None).cast("string").alias("c"))
    df = df.unionByName(df.filter("a IN ('v777', 'v41')"))
    fitted = prep.fit_categories(df, ["a", "b", "c"])
    assert fitted.sizes == {"a": 50_000, "b": 3, "c": 0}
    got = {r.category: r.idx for r in fitted.table.filter("column_name = 'a'").collect()}
    want = ["v41", "v777", *sorted({f"v{i}" for i in range(50_000)} - {"v41", "v777"})]
    assert got == {v: float(i) for i, v in enumerate(want)}
    indexed = prep.index_categories(df, fitted)
    assert indexed.count() == 50_002 and indexed.columns == ["a", "b", "c", "a_idx", "b_idx", "c_idx"]
    assert indexed.agg(F.max("c_idx")).first()[0] == 0.0
    hot = prep.one_hot(indexed, fitted)
    assert len(hot.columns) == 9  # one expression per column
    row = hot.filter("a = 'v5'").first()
    assert row.a_ohe.size == 49_999 and row.a_ohe.indices == [int(row.a_idx)] and row.c_ohe.indices == []


def test_many_columns_of_quantiles(spark):
    columns = {f"c{i}": (F.col("id") * (2 * i + 1) % 1009).cast("double") for i in range(50)}
    df = spark.range(1009).select(*[v.alias(c) for c, v in columns.items()])
    got = ranking.exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns})
    assert all(found == [252.0, 504.0, 756.0] for found in got.values())


def test_buckets(spark):
    df = spark.createDataFrame([(0.0,), (49.99,), (50.0,), (1e9,), (None,), (float("nan"),)], "a double")
    got = [r.b for r in prep.bucketize(df, "a", "b", prep.AMOUNT_SPLITS).collect()]
    assert got == [0, 0, 1, 3, 4, 4]
    bad = spark.createDataFrame([(-1.0,)], "a double")
    with pytest.raises(Exception):
        prep.bucketize(bad, "a", "b", prep.AMOUNT_SPLITS).collect()


def test_quantile_splits_merge_and_survive_empty_columns(spark):
    df = spark.createDataFrame([(1.0,)] * 9 + [(2.0,)], "a double")
    assert prep.fit_quantile_splits(df, "a", 4) == [float("-inf"), 1.0, float("inf")]
    assert prep.fit_quantile_splits(df.filter("a > 5"), "a", 4) == [float("-inf"), float("inf")]


def _vectors(spark, df, stage):
    assembled = VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(df)
    model = stage.fit(assembled) if hasattr(stage, "fit") else stage
    return [tuple(r[0]) for r in model.transform(assembled).select(vector_to_array("o")).collect()]


def test_scalers_match_mllib(spark):
    df = spark.createDataFrame([(1.0, 5.0), (4.0, 5.0), (-2.0, 5.0), (0.0, 5.0)], "a double, b double")
    moments = prep.column_moments(df, ["a", "b"])
    cases = [
        (prep.standard_scale(df, moments), "std", StandardScaler(inputCol="v", outputCol="o", withMean=False)),
        (prep.standard_scale(df, moments, True), "std", StandardScaler(inputCol="v", outputCol="o", withMean=True)),
        (prep.minmax_scale(df, moments), "mm", MinMaxScaler(inputCol="v", outputCol="o")),
        (prep.normalize(df, ["a", "b"]), "l2", Normalizer(inputCol="v", outputCol="o", p=2.0)),
    ]
    for ours, suffix, stage in cases:
        got = [(r[f"a_{suffix}"], r[f"b_{suffix}"]) for r in ours.collect()]
        for g, w in zip(got, _vectors(spark, df, stage)):
            assert g == pytest.approx(w)


def test_variance_and_assembly(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (2.0, 5.0, None)], "a double, b double, c double")
    kept = {r.column_name: r.kept for r in prep.variance_profile(df, ["a", "b", "c"]).collect()}
    assert kept == {"a": True, "b": False, "c": False}
    assert prep.assemble(df, ["a", "c"], "f").first().f == [1.0, 0.0]
    assert prep.binarize(df, "a", "x", 1.0).select("x").collect()[0][0] == 0.0
