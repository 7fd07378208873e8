import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from pyspark.sql import functions as F

from linewright.operators.slices import FAN, before_slices, climb, levels
from linewright.operators.windows import rolling, sliding, tumbling, window_family

T0 = datetime(2024, 1, 4)  # a Thursday: starts a week counted from 1970


def at(**kw):
    return T0 + timedelta(**kw)


def rows(n=400, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        machine = "hot" if rng.random() < 0.4 else f"m{rng.randrange(4)}"
        when = at(seconds=rng.randrange(0, 40 * 86400))
        reading = None if rng.random() < 0.1 else round(rng.uniform(0, 50), 2)
        out.append((i, machine, when, reading, rng.choice([0, 1, None])))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "id int, machine string, t timestamp, v double, y int")


def test_edges_rates_and_nulls(spark):
    data = [
        (1, "m", at(minutes=0), 1.0, 1),
        (2, "m", at(minutes=59, seconds=59), 3.0, None),
        (3, "m", at(hours=1), None, None),
    ]
    got = tumbling(frame(spark, data), ["machine"], "t", "1 hour", ["v"], "y").collect()
    found = {r.window_start: (r.avg_v, r.defect_rate_labelled_pct, r.inspection_count) for r in got}
    assert found == {at(): (2.0, 100.0, 2), at(hours=1): (None, None, 1)}


def test_weeks_start_on_thursday(spark):
    data = [(1, "m", at(days=6, hours=23), 1.0, 1), (2, "m", at(days=7), 1.0, 1)]
    got = tumbling(frame(spark, data), ["machine"], "t", "7 days", ["v"], "y").collect()
    assert {r.window_start for r in got} == {T0, at(days=7)}


@pytest.mark.parametrize("digits", [None, 2])
def test_family_equals_single_tables(spark, digits):
    df = frame(spark, rows())
    sizes = ["1 hour", "24 hours", "7 days", "30 days"]
    family = window_family(df, ["machine"], "t", sizes, ["v"], "y", digits=digits)
    for size in sizes:
        one = {(r.machine, r.window_start): r for r in tumbling(
            df, ["machine"], "t", size, ["v"], "y", digits=digits).collect()}
        many = {(r.machine, r.window_start): r for r in family[size].collect()}
        assert one.keys() == many.keys()
        for k in one:
            assert one[k].inspection_count == many[k].inspection_count
            assert one[k].defect_rate_labelled_pct == many[k].defect_rate_labelled_pct
            assert one[k].avg_v == (many[k].avg_v if digits else pytest.approx(many[k].avg_v))


def test_labels_count_only_when_known_at_the_close(spark):
    data = [(T0, 1, at(minutes=30)), (T0, 0, at(minutes=90)), (at(minutes=5), 1, at(days=3))]
    df = spark.createDataFrame(data, "t timestamp, y int, known timestamp").selectExpr("'m' AS machine", "*")
    sizes = ["1 hour", "24 hours", "7 days"]
    family = window_family(df, ["machine"], "t", sizes, [], "y", label_known="known")
    rates = {s: family[s].first().defect_rate_labelled_pct for s in sizes}
    assert rates == {"1 hour": 100.0, "24 hours": 50.0, "7 days": pytest.approx(200 / 3)}
    single = tumbling(df, ["machine"], "t", "24 hours", [], "y", label_known="known").first()
    assert single.defect_rate_labelled_pct == 50.0


@pytest.mark.parametrize("size,slide", [(24, 6), (24, 9), (5, 5)])
def test_sliding_equals_row_copies(spark, size, slide):
    df = frame(spark, rows())
    panes = sliding(df, ["machine"], "t", f"{size} hours", f"{slide} hours", ["v"], "y", digits=2)
    copies = tumbling(df, ["machine"], "t", f"{size} hours", ["v"], "y", digits=2, slide=f"{slide} hours")
    assert sorted(map(str, panes.collect())) == sorted(map(str, copies.collect()))


@pytest.mark.parametrize("step", ["1 hour", "24 hours", "6 hours", "1 minute"])
def test_rolling_against_brute_force(spark, step):
    rng = random.Random(5)
    data = rows(300)
    # same instants, the exact window edge, and slice edges
    data += [(1000, "hot", at(days=2), 1.0, None), (1001, "hot", at(days=2), 2.0, None)]
    data += [(1002, "hot", at(days=3), 4.0, None), (1003, "hot", at(days=3, microseconds=1), 8.0, None)]
    data += [(2000 + i, "hot", at(days=10, seconds=rng.randrange(0, 3600)), float(i), None) for i in range(50)]
    got = rolling(frame(spark, data), ["machine"], "t", "24 hours", "v", 2, ["id"], step)
    found = {r.id: (r.rolling_count, r.rolling_avg_v) for r in got.collect()}
    by_machine = defaultdict(list)
    for i, m, t, v, _ in data:
        by_machine[m].append((t, v))
    assert len(found) == len(data)
    for i, m, t, v, _ in data:
        seen = [w for s, w in by_machine[m] if t - timedelta(hours=24) <= s < t and w is not None]
        mean = pytest.approx(sum(seen) / len(seen)) if seen else None
        assert found[i] == (len(seen), mean), (i, m, t)


def test_rolling_refuses_uneven_slices(spark):
    with pytest.raises(ValueError):
        rolling(frame(spark, rows(5)), ["machine"], "t", "24 hours", "v", 2, ["id"], "7 hours")


def test_what_precedes_a_slice_against_brute_force(spark):
    rng = random.Random(8)
    width = 1_000_000
    keys = [("a", 1), ("a", None), (None, 2), ("b", 1)]
    near = [rng.randrange(-300, 5000) for _ in range(150)]
    far = [rng.randrange(-(10**11), 10**11) for _ in range(60)] + [-1, 0, 1, FAN, FAN - 1, FAN * FAN, -FAN, -FAN - 1]
    states = {(k, s * width): rng.randrange(1, 100) for k in keys for s in rng.sample(near + far, 120)}
    asked = {(k, s * width) for k in [*keys, ("c", 1)] for s in rng.sample(near + far, 80)}
    schema = "x string, y int, _slice long"
    frame = spark.createDataFrame([(*k, s, n, s) for (k, s), n in states.items()], f"{schema}, n long, t long")
    questions = spark.createDataFrame([(*k, s) for k, s in asked], schema)
    merge = {"n": lambda: F.sum("n"), "t": lambda: F.max("t")}
    got = {((r.x, r.y), r._slice): (r.n, r.t) for r in before_slices(frame, questions, ["x", "y"], width, merge).collect()}
    want = {}
    for k, s in asked:
        earlier = [(n, t) for (j, t), n in states.items() if j == k and t < s]
        if earlier:
            want[k, s] = (sum(n for n, _ in earlier), max(t for _, t in earlier))
    assert got == want


def test_no_level_has_a_large_group(spark):
    """One key with a slice for each of 300,000 seconds: its nodes below any wider slice are few, on every level."""
    second = 1_000_000
    slices = spark.range(300_000).select(F.lit("k").alias("key"), (F.col("id") * second + 1_700_000_000 * second).alias("_slice"))
    nodes = climb(slices, ["key"], second).select("_key", "_level", "_parent", "_node").distinct()
    groups = nodes.groupBy("_key", "_level", "_parent").count()
    sizes = groups.agg(F.max("count"), F.countDistinct("_level")).first()
    assert sizes[0] <= FAN and sizes[1] == len(levels(second))


@pytest.mark.parametrize("step", ["1 second", "1 minute"])
def test_rolling_of_a_key_with_many_slices(spark, step):
    """A row each second for three hours; a window of ten minutes holds the 600 before it."""
    df = spark.range(10_800).selectExpr("'m' AS machine", "id", "timestamp_seconds(1700000000 + id) AS t", "double(id) AS v")
    got = {r.id: (r.rolling_count, r.rolling_avg_v) for r in rolling(df, ["machine"], "t", "10 minutes", "v", 0, ["id"], step).collect()}
    assert len(got) == 10_800
    for k in (1, 5, 599, 600, 601, 7000, 10_799):
        low = max(0, k - 600)
        assert got[k] == (k - low, (low + k - 1) / 2)
    assert got[0] == (0, None)
