"""Exact and near duplicates against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest

from linewright.llm import exact_dedup, near_dedup

BLANKS = str.maketrans("", "", " \t\n\x0b\x0c\r")


def brute_exact(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[(text or "").translate(BLANKS)].append((doc, text or ""))
    out = Counter()
    for same in groups.values():
        same.sort(key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))
        for at, (doc, _) in enumerate(same):
            out[doc, same[0][0], len(same), at == 0] += 1
    return out


def check_exact(docs_of, rows):
    got = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.find_duplicates(docs_of(rows)).collect())
    assert got == brute_exact(rows)


def test_exact_odd_rows(docs_of, odd_rows):
    check_exact(docs_of, odd_rows)


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_exact_many_levels_and_hot_groups(docs_of, monkeypatch, block):
    monkeypatch.setattr(exact_dedup, "BLOCK", block)
    rng = random.Random(block)
    rows = []
    for i in range(120):
        text = "".join(rng.choice("ab") for _ in range(rng.randint(0, 9)))
        rows.append((i, " ".join(text) if rng.random() < 0.5 else text))
    rows += [(1000 + i, "hot text that a third of all rows share" + " " * (i % 4)) for i in range(60)]
    check_exact(docs_of, rows)


def test_exact_blocks_with_one_hash_are_told_apart(docs_of, monkeypatch):
    """Names come from the blocks themselves: where all hashes are equal, nothing changes."""
    monkeypatch.setattr(exact_dedup, "BLOCK", 2)
    from pyspark.sql import functions as F

    real = F.xxhash64
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: real(*c) * 0)
    rng = random.Random(9)
    check_exact(docs_of, [(i, "".join(rng.choice("abc") for _ in range(rng.randint(0, 6)))) for i in range(80)])


def test_exact_drop_keeps_columns_that_clash(spark):
    rows = [(1, "a b", "x", 1), (2, "ab", "y", 2), (3, None, None, None), (3, None, None, None), (None, "c", "z", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string, name long")
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert Counter(map(tuple, kept.collect())) == Counter([rows[0], rows[2], rows[4]])


def test_exact_empty_table(docs_of):
    assert exact_dedup.find_duplicates(docs_of([])).count() == 0
    assert exact_dedup.drop_duplicates(docs_of([])).count() == 0


def plain_shingles(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    if len(words) < 5:
        return Counter([tuple(words)])
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def plain_similarity(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def corpus(seed, size=150):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(size):
        text = [rng.choice(words) for _ in range(rng.randint(60, 200))]
        rows.append(text)
        for _ in range(rng.choice([0, 0, 1, 3])):
            copy = list(text)
            for _ in range(rng.choice([0, 1, 1, 2])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(copy)
    hot = [rng.choice(words) for _ in range(150)]
    for i in range(size):  # a large group of near copies, each with its own change
        copy = list(hot)
        copy[rng.randrange(len(copy))] = f"own{i}"
        rows.append(copy)
    passage = [rng.choice(words) for _ in range(30)]
    for i in range(size // 2):  # documents that share a passage only
        rows.append([rng.choice(words) for _ in range(60)] + passage + [rng.choice(words) for _ in range(40)])
    rng.shuffle(rows)
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


def test_near_classes_are_those_of_brute_force(docs_of):
    rows = corpus(1)
    shingles = [plain_shingles(t) for _, t in rows]
    holders = defaultdict(set)
    for i, s in enumerate(shingles):
        for g in s:
            holders[g].add(i)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [(i, j) for i, s in enumerate(shingles) for j in set().union(*(holders[g] for g in s)) if j > i and plain_similarity(s, shingles[j]) >= 0.8]
    for i, j in links:
        parent[max(root(i), root(j))] = min(root(i), root(j))
    found = {r["doc_id"]: r for r in near_dedup.near_duplicates(docs_of(rows, parts=4)).collect()}
    assert len(found) == len(rows)
    lost = [(i, j) for i, j in links if found[i]["class_id"] != found[j]["class_id"]]
    assert not lost
    wrong = [i for i in range(len(rows)) if found[i]["class_id"] != root(i)]
    assert not wrong
    sizes = Counter(r["class_id"] for r in found.values())
    for r in found.values():
        assert r["class_size"] == sizes[r["class_id"]]
        assert r["kept"] == (r["doc_id"] == r["class_id"])
        assert (r["links"] > 0) == (r["class_size"] > 1)


def test_near_star_whose_middle_is_no_end_of_a_bucket(docs_of):
    """Variants of one original are like it and not like each other: all are linked through the original."""
    rng = random.Random(5)
    original = [f"w{i}" for i in range(304)]
    rows = []
    for i in range(300):
        copy = list(original)
        for k in range(6):
            copy[4 + 50 * k + rng.randrange(42)] = f"own{i}x{k}"
        rows.append((i, " ".join(copy)))
    rows.insert(150, (1000, " ".join(original)))
    shingles = {i: plain_shingles(t) for i, t in rows}
    assert all(plain_similarity(shingles[i], shingles[1000]) >= 0.8 for i in range(300))
    assert sum(plain_similarity(shingles[i], shingles[i + 1]) >= 0.8 for i in range(299)) < 10
    found = {r["doc_id"]: r for r in near_dedup.near_duplicates(docs_of(rows, parts=4)).collect()}
    # the draws give a variant and the original no key in common with a chance of 0.0002 (weighted similarity 0.75)
    alone = sum(r["class_size"] == 1 for r in found.values())
    assert alone <= 1
    assert found[1000]["class_size"] == 301 - alone
    assert found[1000]["links"] >= 300 - alone
    assert sum(r["kept"] for r in found.values()) == 1 + alone


def test_draws_agree_as_often_as_texts_are_similar():
    """Consistent weighted sampling: the share of equal draws is the weighted Jaccard similarity."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(2)
    words = [f"w{i}" for i in range(100)]
    a = [rng.choice(words) for _ in range(3000)]
    b = a[:2400] + [rng.choice(words) for _ in range(600)]
    weights = near_dedup.Weights(np.zeros((near_dedup.DEPTH, near_dedup.WIDTH), "i8"), 100)
    equal, total = 0, 0
    for part in range(12):
        texts = pa.array([" ".join(x[part * 250 : part * 250 + 250]) for x in (a, b)])
        ((_, _, s),) = near_dedup.groups(texts)
        drawn = near_dedup.draws(s, s.count * weights.of(s.hash))
        equal += int((drawn[0] == drawn[1]).sum())
        total += drawn.shape[1]
    assert abs(equal / total - 0.8) < 0.06


def test_near_odd_rows(docs_of, odd_rows):
    rows = {(r["doc_id"], r["class_id"], r["class_size"]) for r in near_dedup.near_duplicates(docs_of(odd_rows)).collect()}
    assert (2, 2, 3) in rows and (3, 2, 3) in rows and (4, 2, 3) in rows  # texts without words are the same
    assert (None, None, 1) in rows and (6, 6, 1) in rows and (5, 5, 1) in rows
    assert (1, 1, 2) in rows and (1, 1, 1) in rows
    assert near_dedup.near_duplicates(docs_of([])).count() == 0


def test_near_drop_keeps_columns_that_clash(spark):
    text = " ".join(f"word{i}" for i in range(100))
    rows = [(1, text, "p", 5), (2, text.upper() + "!", None, 6), (3, text.replace("word50", "x"), "q", 7), (4, "short one", "r", 8), (4, "short one", "r", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, uid string, bands long")
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert Counter(map(tuple, kept.collect())) == Counter([rows[0], rows[3]])


def test_long_texts_in_parts_have_the_same_shingles(monkeypatch):
    import pyarrow as pa

    text = " ".join(f"wörd{i % 313}, of" for i in range(20_000))
    texts = pa.array(["", text, "a b c", text])
    ((_, _, whole),) = near_dedup.groups(texts)
    monkeypatch.setattr(near_dedup, "GROUP_BYTES", 1000)
    parts = [s for _, _, s in near_dedup.groups(texts)]
    assert [h for s in parts for h in s.hash.tolist()] == whole.hash.tolist()
    assert [n for s in parts for n in s.count.tolist()] == whole.count.tolist()


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(101, 100), (102, 100)], "uid long, leader long")
    found = dict(near_dedup.components(links).collect())
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def test_near_recall_on_the_table(spark):
    """Links of all pairs of the documents table, by brute force over its shingles: at least nine in ten join one class, and
    no class joins documents that links do not."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    shingles = [plain_shingles(t) for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(shingles):
        for g in s:
            holders[g].append(i)
    pairs = {(a, b) for members in holders.values() if len(members) <= 60 for n, a in enumerate(members) for b in members[n + 1 :]}
    links = [(i, j) for i, j in pairs if plain_similarity(shingles[i], shingles[j]) >= 0.8]
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert len(links) > 20
    kept = sum(found[rows[i][0]] == found[rows[j][0]] for i, j in links)
    assert kept >= 0.9 * len(links)


def test_unlike_members_of_one_bucket_make_few_pairs(docs_of, monkeypatch):
    """A passage that a thousand documents share fills buckets with members that are not alike: none of them is compared whole."""
    rng = random.Random(6)
    words = [f"w{k}" for k in range(5000)]
    passage = [rng.choice(words) for _ in range(60)]
    rows = [(i, " ".join([rng.choice(words) for _ in range(60)] + passage + [rng.choice(words) for _ in range(20)])) for i in range(1000)]
    seen = []
    verify = near_dedup.verify
    monkeypatch.setattr(near_dedup, "verify", lambda pairs, *rest: seen.append(pairs.count()) or verify(pairs, *rest))
    found = near_dedup.near_duplicates(docs_of(rows, parts=4)).collect()
    assert {r["class_size"] for r in found} == {1}
    assert len(seen) == 2 and sum(seen) < 2 * len(rows)


def test_rows_with_too_much_of_their_own_are_no_candidates(spark, docs_of):
    """Rows that share most draws, but of which others have too little for a link, get no keys or make no pair; a real link stays."""
    import numpy as np
    from pyspark.sql import functions as F

    shared = [f"w{k}" for k in range(200)]
    rows = [(i, " ".join(shared + [f"own{i}x{k}" for k in range(40)])) for i in range(20)]  # similarity 0.71, bound of each alone 0.83
    far = [(100 + i, " ".join(shared + [f"far{i}x{k}" for k in range(60)])) for i in range(20)]  # bound of each alone 0.77
    near = [(200 + i, " ".join([*shared, f"near{i}"])) for i in range(2)]
    weights = near_dedup.Weights(np.zeros((near_dedup.DEPTH, near_dedup.WIDTH), "i8"), 100)
    texts = docs_of([*rows, *far, *near]).withColumnRenamed("doc_id", "uid")
    own = near_dedup.own_shingles(texts, weights)
    assert {r["uid"]: r["own"] for r in own.collect()} == {i: 40 for i in range(20)} | {100 + i: 60 for i in range(20)} | {200: 1, 201: 1}
    split = near_dedup.split_keys(texts.join(own, "uid"), weights, 0.8).withColumn("root", F.col("uid"))
    split = near_dedup.materialize(split.select("*", F.posexplode("keys").alias("band", "key")).drop("keys"), "split")
    assert {r["uid"] for r in split.select("uid").distinct().collect()} == {*range(20), 200, 201}
    draws = near_dedup.SPLIT_SEEDS + near_dedup.BANDS * near_dedup.ROWS
    by_draws = near_dedup._across(split, ["band", "key"], draws, near_dedup.LEAST_EQUAL_SPLIT).collect()
    bound = near_dedup._across(split, ["band", "key"], draws, near_dedup.LEAST_EQUAL_SPLIT, 0.8).collect()
    assert sum(r["uid"] < 20 for r in by_draws) > 50 and not any(r["uid"] < 20 for r in bound)
    assert (201, 200) in {(r["uid"], r["leader"]) for r in bound}
