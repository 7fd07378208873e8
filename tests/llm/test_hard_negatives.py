import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linewright.llm import hard_negatives
from linewright.llm.hard_negatives import best, even, mine, strassen, window_of


@pytest.mark.parametrize("shape", [(1, 1, 1), (17, 17, 17), (33, 64, 100), (50, 7, 90), (129, 65, 131), (3, 0, 5), (40, 200, 40)])
def test_strassen_is_the_product(shape):
    m, k, n = shape
    rng = np.random.default_rng(m + k)
    a, b = rng.integers(-300, 300, (m, k)), rng.integers(-300, 300, (k, n))
    assert (strassen(a, b) == a @ b).all()


def test_sums_in_between_may_pass_64_bits():
    rng = np.random.default_rng(0)
    a = rng.integers(-(2**62), 2**62, (40, 40))
    b = np.eye(40, dtype="i8")
    assert (strassen(a, b) == a).all()
    assert even(a[:39]).shape == (40, 40) and not even(a[:39])[39].any()


def test_heap_and_window():
    scores = np.array([5, 9, 9, -3, 9, 7])
    ids, ranks = np.array([1, 8, 2, 0, 2, 3]), np.array([5, 4, 3, 2, 1, 0])
    assert list(best(scores, ids, ranks, np.arange(6), 4)) == [4, 2, 1, 5]
    assert list(best(scores, ids, ranks, np.arange(6), 1)) == [4]
    for score in (*range(-30, 60), 2**62, 10**17 + 1):
        a, b = window_of(score, 80, 100)
        for s in {a - 1, a, a + 1, b - 1, b, b + 1}:
            assert (a <= s <= b) == (80 * score <= 100 * s <= 100 * score)


def brute(rows, is_anchor, positives=5, negatives=5):
    used = [
        (k, i, label, [math.floor(256 * x) for x in v])
        for k, (i, v, label) in enumerate(rows)
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for k, i, label, v in used:
        if not is_anchor(i):
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=True)), j, o, other) for o, j, other, w in used if o != k and len(w) == len(v)]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for p in [s for s in scored if s[3] == label][:positives]:
            inside = [s for s in scored if s[3] != label and 80 * p[0] <= 100 * s[0] <= 100 * p[0]]
            out += [(i, p[1], r + 1, s[1], p[0], s[0]) for r, s in enumerate(inside[:negatives])]
    return sorted(out)


SCHEMA = "vec_id long, embedding array<float>, label int"


def run(spark, rows, is_anchor, schema=SCHEMA):
    docs = spark.createDataFrame(rows, schema).repartition(3)
    return sorted(tuple(r) for r in mine(docs, F.col("label"), is_anchor).collect())


def test_equals_brute_force_with_ties_repeated_ids_nulls_and_widths(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", 32)
    monkeypatch.setattr(hard_negatives, "BATCH_ROWS", 7)
    rng = random.Random(12)
    vector = lambda n: [float(np.float32(rng.choice((-0.5, 0.25, 0.5, 1.0, rng.random())))) for _ in range(n)]
    rows = [(rng.randrange(150), vector(6), rng.choice((1, 1, 1, 2, 3, 99))) for _ in range(260)]
    rows += [(k, vector(9), k % 3) for k in range(40)]
    rows += rows[:20]  # repeated
    rows += [(None, vector(6), 1), (500, None, 1), (505, vector(6), None), (510, [1.0, None], 1), (515, [math.nan] * 6, 2), (520, [math.inf] * 6, 2), (525, [], 1), (530, [], 2), (535, [], 1)]
    got = run(spark, rows, F.col("vec_id") % 5 == 0)
    assert got == brute(rows, lambda i: i % 5 == 0) and len(got) > 500


def test_a_label_of_nearly_all_rows_and_labels_of_one(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", 16)
    rng = random.Random(1)
    rows = [(k, [rng.random() for _ in range(4)], 0 if k % 10 else k) for k in range(300)]
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    assert run(spark, rows, F.col("vec_id") % 4 == 0) == brute(rows, lambda i: i % 4 == 0)


def test_empty_table_and_clashing_names(spark):
    assert run(spark, [], F.col("vec_id") % 5 == 0) == []
    rows = [(k, [1.0, k / 10], k % 2) for k in range(12)]
    names = {name: F.lit(1) for name in ("tree", "rank", "id", "first", "last", "tile", "place", "o1", "impacts", "batch", "anchor")}
    plain = spark.createDataFrame(rows, SCHEMA)
    want = sorted(mine(plain, F.col("label"), F.col("vec_id") == 0).collect())
    assert want and sorted(mine(plain.withColumns(names), F.col("label"), F.col("vec_id") == 0).collect()) == want
