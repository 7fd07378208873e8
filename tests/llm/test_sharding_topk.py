"""Shards and top-k against brute force."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from linewright.llm import sharding, topk


@pytest.mark.parametrize("n,g,t", [(5, 4, 12), (10, 3, 11), (7, 7, 14), (1, 1, 2), (0, 3, 5), (4, 0, 9), (9, 4, 9), (300, 200, 1000)])
def test_hypergeometric_draws(spark, n, g, t):
    whole = lambda x: F.lit(x).cast("long")
    draws = spark.range(4000).select(sharding.hypergeometric(whole(n), whole(g), whole(t), sharding.uniform("id", F.lit(7))).alias("x"))
    counts = {r["x"]: r["count"] for r in draws.groupBy("x").count().collect()}
    assert sum(counts.values()) == 4000
    for x in range(min(n, g) + 1):
        p = math.comb(g, x) * math.comb(t - g, n - x) / math.comb(t, n) if n - x <= t - g else 0.0
        assert abs(counts.get(x, 0) / 4000 - p) < 4 * math.sqrt(p * (1 - p) / 4000) + 1e-3


def test_matrix_has_exact_sums(spark):
    sizes = spark.createDataFrame([(i * 3, 5 + i * i % 17) for i in range(9)] + [(100, 0)], "src int, n long")
    rows = sharding.communication_matrix(sizes, 7, 1).collect()
    n = {r["src"]: r["n"] for r in sizes.collect()}
    assert {r["src"]: sum(r["counts"]) for r in rows} == n
    assert all(min(r["counts"]) >= 0 for r in rows)
    columns = [sum(r["counts"][j] for r in rows) for j in range(7)]
    assert sum(columns) == sum(n.values()) and max(columns) - min(columns) <= 1


@pytest.mark.parametrize("together", [3, 20_000])
def test_shards_are_exact_and_gapless(docs_of, odd_rows, monkeypatch, together):
    monkeypatch.setattr(sharding, "ROWS_TOGETHER", together)
    rows = odd_rows + [(10, "same")] * 50
    out = sharding.shuffle_into_shards(docs_of(rows, parts=5).withColumnRenamed("text", "src"), shards=8).collect()
    assert Counter((r["doc_id"], r["src"]) for r in out) == Counter(rows)
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[j]) for j in range(8)]
    assert max(sizes) - min(sizes) <= 1


def test_shuffle_is_uniform(spark):
    """Over seeds, each row is in each shard about as often, and neighbours stay together no more than by chance."""
    docs = spark.range(0, 90, 1, 3).withColumnRenamed("id", "doc_id")
    where, next_to, seeds = Counter(), 0, 6
    for seed in range(seeds):
        rows = sharding.shuffle_into_shards(docs, shards=3, seed=seed).collect()
        at = {r["doc_id"]: (r["shard"], r["slot"]) for r in rows}
        for doc, (shard, _) in at.items():
            where[doc // 30, shard] += 1
        next_to += sum(at[d][0] == at[d + 1][0] and at[d][1] + 1 == at[d + 1][1] for d in range(89))
    chi = sum((where[d, s] - seeds * 10) ** 2 / (seeds * 10) for d in range(3) for s in range(3))
    assert chi < 18.5  # four degrees of freedom
    assert next_to < 20  # six are expected


def test_shards_of_an_empty_table(docs_of):
    assert sharding.shuffle_into_shards(docs_of([])).count() == 0
    with pytest.raises(ValueError):
        sharding.shuffle_into_shards(docs_of([]).withColumn("Slot", F.lit(1)))


def brute_topk(rows, k, is_query):
    """Rows that share an id are different rows."""
    usable = [
        (n, i, [math.floor(64 * x) for x in v])
        for n, (i, v) in enumerate(rows)
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, i, q in usable:
        if is_query(i):
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for m, j, v in usable if m != n and len(v) == len(q))
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block_rows,scale", [(7, 0.3), (64, 0.3), (10_000, 0.3), (50, 1e6)])
def test_topk_is_exact(spark, block_rows, scale):
    rng = random.Random(block_rows)
    rows = [(i - 5, [float(np.float32(rng.gauss(0, scale))) for _ in range(6)]) for i in range(150)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)]  # ties
    rows += [(2000, None), (2001, [0.1, None, 0.2, 0.1, 0.0, 0.0]), (2002, [math.nan] * 6), (2003, [math.inf] + [0.0] * 5), (2004, []), (2020, [0.0] * 6)]
    rows += [(2005, [1.0, 2.0]), (2025, [2.0, -1.0]), (None, rows[3][1]), (rows[3][0], rows[3][1]), (rows[4][0], rows[5][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, k=9, block_rows=block_rows)
    assert sorted(map(tuple, got.collect())) == brute_topk(rows, 9, lambda i: i % 5 == 0)
    clash = {name: F.lit(1) for name in ("block", "id", "impacts", "row", "rows", "queries", "batch")}
    assert sorted(topk.top_k(df.withColumns(clash), F.col("vec_id") % 5 == 0, k=9, block_rows=block_rows).collect()) == sorted(got.collect())


def test_topk_stops_before_the_last_segment():
    """Where few can still be members, what is left is not added up, and the result is the same."""
    rng = np.random.default_rng(1)
    block = rng.integers(-3, 4, (200, 16))
    block[:25] += 200
    queries = np.full((1, 16), 50)
    segments = topk._segments(block)
    found = list(topk.search_block(np.arange(200), np.arange(200), segments, np.array([999]), queries, 20))
    order = sorted(range(200), key=lambda i: (-int(queries[0] @ block[i]), i))[:20]
    assert [x[2] for x in found] == order
    broken = segments[:1] + [s | {"level": 0} for s in segments[1:]]
    assert [x[2] for x in topk.search_block(np.arange(200), np.arange(200), broken, np.array([999]), queries, 20)] == order


def test_topk_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert topk.top_k(df, F.col("vec_id") % 20 == 0).count() == 0
