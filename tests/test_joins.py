import random
from datetime import datetime, timedelta

import pytest

from linewright.operators.joins import (
    FeatureLookup,
    WindowFeatures,
    asof_join,
    attach_windows,
    duplicate_keys,
    first_in_range,
    inspection_labels,
    interval_left_join,
    lookup,
    training_set,
)

T0 = datetime(2024, 1, 1)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def days(n):
    return T0 + timedelta(days=n)


def test_label_boundaries(spark):
    inspections = spark.createDataFrame(
        [("same", T0), ("edge", T0), ("late", T0), ("early", T0), ("none", T0), ("twice", T0), (None, T0)],
        "unit_id string, timestamp timestamp",
    )
    labels = spark.createDataFrame(
        [
            ("same", 1, T0),
            ("edge", 1, days(30)),
            ("late", 1, days(30) + timedelta(seconds=1)),
            ("early", 1, T0 - timedelta(seconds=1)),
            ("twice", 0, days(2)),
            ("twice", 1, days(1)),
            ("twice", 1, days(1)),
            (None, 1, T0),
        ],
        "unit_id string, is_defective int, label_available_date timestamp",
    )
    found = [(r.unit_id, r.is_defective) for r in inspection_labels(inspections, labels).collect()]
    assert sorted(found, key=str) == sorted(
        [("same", 1), ("edge", 1), ("late", None), ("early", None), ("none", None)]
        + [("twice", 0), ("twice", 1), ("twice", 1), (None, None)],
        key=str,
    )
    first = inspection_labels(inspections, labels, only_first=True).collect()
    assert len(first) == 7
    assert {r.unit_id: r.is_defective for r in first}["twice"] == 1


def test_first_label_skips_labels_out_of_range_and_keeps_repeated_inspections(spark):
    inspections = spark.createDataFrame([("u", T0), ("u", T0)], "unit_id string, timestamp timestamp")
    labels = spark.createDataFrame(
        [("u", 0, T0 - timedelta(days=1)), ("u", 1, days(3))],
        "unit_id string, is_defective int, label_available_date timestamp",
    )
    rows = inspection_labels(inspections, labels, only_first=True).collect()
    assert [r.is_defective for r in rows] == [1, 1]


@pytest.mark.parametrize("slices", [None, 1, 4])
def test_interval_join_against_brute_force(spark, slices):
    rng = random.Random(1)
    # a third of the rows on one key
    key = lambda: 0 if rng.random() < 0.4 else rng.randrange(1, 5)
    left = [(i, key(), at(rng.randrange(0, 4000))) for i in range(150)]
    right = [(i, key(), at(rng.randrange(0, 4000))) for i in range(150)]
    a = spark.createDataFrame(left, "lid int, k int, lt timestamp")
    b = spark.createDataFrame(right, "rid int, k int, rt timestamp")
    got = interval_left_join(a, b, "k", "lt", "rt", "400 seconds", slices=slices).select("lid", "rid").collect()
    want = []
    for lid, k, lt in left:
        hits = [rid for rid, rk, rt in right if rk == k and lt <= rt <= lt + timedelta(seconds=400)]
        want += [(lid, rid) for rid in hits] or [(lid, None)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("salts,size", [(1, "1 day"), (3, "100 seconds"), (2, "1 second"), (1, "1 minute")])
def test_asof_against_brute_force(spark, salts, size):
    rng = random.Random(2)
    key = lambda: 0 if rng.random() < 0.4 else rng.randrange(1, 6)
    spine = [(i, key(), at(rng.randrange(0, 3000))) for i in range(200)]
    spine += [(900, None, T0), (901, 0, None), (902, 99, T0)]
    times = sorted({(key(), rng.randrange(0, 3000)) for _ in range(60)})
    features = [(k, at(s), float(s)) for k, s in times]
    a = spark.createDataFrame(spine, "id int, k int, t timestamp")
    b = spark.createDataFrame(features + [(None, T0, -1.0)], "k int, ft timestamp, v double")
    got = asof_join(a, b, ["k"], "t", "ft", slice_size=size, salts=salts).select("id", "v").collect()
    want = []
    for i, k, t in spine:
        seen = [v for fk, ft, v in features if t is not None and fk == k and ft <= t]
        want.append((i, max(seen) if seen else None))
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("salts,size", [(1, "1 day"), (3, "100 seconds")])
def test_first_in_range_against_brute_force(spark, salts, size):
    rng = random.Random(9)
    key = lambda: 0 if rng.random() < 0.4 else rng.randrange(1, 6)
    left = [(i, key(), at(rng.randrange(0, 3000))) for i in range(200)]
    right = [(k, at(s), float(s)) for k, s in sorted({(key(), rng.randrange(0, 3000)) for _ in range(60)})]
    a = spark.createDataFrame(left, "id int, k int, t timestamp")
    b = spark.createDataFrame(right, "k int, rt timestamp, v double")
    got = asof_join(
        a, b, ["k"], "t", "rt", slice_size=size, salts=salts, forward=True, within="150 seconds"
    ).select("id", "v")
    want = []
    for i, k, t in left:
        seen = [v for rk, rt, v in right if rk == k and t <= rt <= t + timedelta(seconds=150)]
        want.append((i, min(seen) if seen else None))
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert first_in_range(a, b, "k", "t", "rt", "150 seconds").count() == 200


def test_asof_rows_come_from_one_feature_row_even_with_null_values(spark):
    a = spark.createDataFrame([(1, 7, at(100))], "id int, k int, t timestamp")
    b = spark.createDataFrame([(7, at(10), 1.0, 2.0), (7, at(20), None, 3.0)], "k int, ft timestamp, v double, w double")
    row = asof_join(a, b, ["k"], "t", "ft", prefix="f_").first()
    assert (row.f_v, row.f_w, row.f_ft) == (None, 3.0, at(20))


def test_windows_attach_only_after_they_close(spark):
    hour = 3600
    rows = [(1, "m", at(hour - 1)), (2, "m", at(hour)), (3, "m", at(5 * hour)), (4, "x", at(hour)), (5, None, at(hour))]
    spine = spark.createDataFrame(rows, "id int, machine string, t timestamp")
    small = spark.createDataFrame(
        [("m", T0, at(hour), 1.0), ("m", at(hour), at(2 * hour), 2.0)],
        "machine string, window_start timestamp, window_end timestamp, v double",
    )
    big = spark.createDataFrame(
        [("m", T0, at(3 * hour), 30.0)],
        "machine string, window_start timestamp, window_end timestamp, v double",
    )
    got = attach_windows(
        spine, [WindowFeatures(small, "1 hour", "a_"), WindowFeatures(big, "3 hours", "b_")], ["machine"], "t"
    )
    assert {r.id: (r.a_v, r.b_v) for r in got.collect()} == {
        1: (None, None),
        2: (1.0, None),
        3: (2.0, 30.0),
        4: (None, None),
        5: (None, None),
    }


def test_training_set_keeps_unlabelled_rows_and_puts_the_label_last(spark):
    spine = spark.createDataFrame(
        [("u1", "m", at(7200), 1), ("u2", "n", at(7200), None)],
        "unit_id string, machine string, t timestamp, is_defective int",
    )
    static = spark.createDataFrame([("m", 5)], "machine string, age int")
    windows = spark.createDataFrame([("m", at(3600), 2.0)], "machine string, window_end timestamp, v double")
    timed = spark.createDataFrame([("m", at(100), 9.0)], "machine string, ft timestamp, z double")
    out = training_set(
        spine,
        [
            FeatureLookup(static, ("machine",)),
            FeatureLookup(windows, ("machine",), "w_", window="1 hour"),
            FeatureLookup(timed, ("machine",), "x_", time="ft"),
        ],
        "t",
        "is_defective",
        exclude=("unit_id",),
    )
    assert set(out.columns) == {"machine", "t", "x_ft", "x_z", "age", "w_v", "is_defective"}
    assert out.columns[-1] == "is_defective"
    rows = {r.machine: (r.age, r.w_v, r.x_z, r.is_defective) for r in out.collect()}
    assert rows == {"m": (5, 2.0, 9.0, 1), "n": (None, None, None, None)}


def test_checked_lookup_refuses_repeated_keys(spark):
    spine = spark.createDataFrame([(1,), (2,)], "k int")
    table = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    assert lookup(spine, table, ["k"]).count() == 3
    with pytest.raises(ValueError):
        lookup(spine, table, ["k"], check=True)


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [tuple(r) for r in duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
