import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from linewright.llm import merkle
from linewright.llm.merkle import ARITY, Builder, build_manifest, height, leaf_of, log_of, lower_case, position, proofs

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def climb(nodes):
    """Levels of a tree, the leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(*last[k : k + ARITY]) for k in range(0, len(last), ARITY)])
    return levels


def siblings(levels, at):
    out = []
    for level in levels[:-1]:
        low = at // ARITY * ARITY
        run = level[low : low + ARITY]
        out.append((run[: at - low], run[at - low + 1 :]))
        at //= ARITY
    return out


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of all rows, as stated."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    for members in groups.values():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([leaf(r) for r in groups[s]]) for s in order}
    top = climb([trees[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for k, row in enumerate(groups[s]):
            path = siblings(trees[s], k) + siblings(top, at)
            node = leaf(row)
            if zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 5 == 0 and row[4] is not None:
                node = leaf((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])))
            for left, right in path:
                node = H(*left, node, *right)
            proof = H(*(x for left, right in path for x in [*left, *right]))
            out.append((row[0], leaf(row), trees[s][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


def ours(docs, levels=merkle.LEVELS):
    tampered = F.when(merkle.bucket_of("doc_id", 5) == 0, leaf_of(text=lower_case(F.col("text"))))
    return sorted((tuple(r) for r in proofs(build_manifest(docs, tampered, levels)).collect()), key=str)


@pytest.mark.parametrize("leaves", [1, 2, 15, 16, 17, 255, 256, 257, 4095, 4097, 5000])
def test_positions_are_those_of_the_appended_log(leaves):
    names = [f"{k:064x}" for k in range(leaves)]
    builder = Builder(height(leaves))
    for name in names:
        builder.append(name)
    log, levels = builder.finish(), climb(names)
    assert sorted(position(level, k, leaves) for level, row in enumerate(levels) for k in range(len(row))) == list(range(len(log)))
    assert all(log[position(level, k, leaves)] == node for level, row in enumerate(levels) for k, node in enumerate(row))


def test_complete_subtrees_keep_their_positions():
    for leaves in (40, 300, 5000):
        for level in range(3):
            for index in range(leaves // ARITY**level):
                assert position(level, index, leaves) == position(level, index, 10**6)


def rows_of(*sizes):
    names = [None, "", "b", "é", "z" * 40, "Web", "=", "-", "a,b"]
    rows = []
    for s, n in enumerate(sizes):
        name = names[s] if s < len(names) else f"source {s}"
        rows += [(1000 * s + 7 * k, name, "en" if k % 3 else None, k, f"Text {k} of É {s}" if k % 11 else None) for k in range(n)]
    return rows


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_equals_brute_force(spark, levels):
    """Small builders make several rounds of the same trees."""
    rows = rows_of(1, 2, 16, 17, 300, 33, 0, 5, 1, *[1] * 12)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = ours(docs, levels)
    assert got == brute(rows)
    assert {x[6] for x in got} == {True, False}


def test_whole_log_is_gapless(spark):
    rows = rows_of(3, 300, 17)
    log = {}
    for r in log_of(build_manifest(spark.createDataFrame(rows, SCHEMA), levels=1).groups).collect():
        log.setdefault(r["tree"], {})[r["position"]] = (r["level"], r["digest"])
    for tree, of in (("-", None), ("=", ""), ("=b", "b")):
        builder_rows = sorted((r for r in rows if r[1] == of), key=lambda r: r[0])
        builder = Builder(height(len(builder_rows)))
        for r in builder_rows:
            builder.append(leaf(r))
        assert [log[tree][k][1] for k in range(len(log[tree]))] == builder.finish()


def test_odd_rows(spark):
    rows = [(1, "a", "en", 3, "ABC"), (1, "a", "en", 3, "ABC"), (1, "a", "en", 3, "abd"), (None, None, None, None, None), (None, "a", None, None, ""), (2, "a", "x", 0, "L" * 200_000), (5, "", "-", -4, "-")]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert ours(docs) == want
    clash = {name: F.lit("x") for name in ("tree", "leaf", "node", "claimed", "uid", "rank", "place", "o1", "root")}
    assert ours(docs.withColumns(clash)) == want
    assert ours(spark.createDataFrame([], SCHEMA)) == []


def test_one_key_of_all_rows(spark):
    rows = [(7, "s", "en", 1, f"T{k % 3}") for k in range(500)]
    assert ours(spark.createDataFrame(rows, SCHEMA).repartition(6)) == brute(rows)


def test_a_changed_row_is_found(spark):
    rows = rows_of(20, 40)
    docs = spark.createDataFrame(rows, SCHEMA)
    forged = F.when(F.col("doc_id") == 7, leaf_of(n_chars=F.col("n_chars") + 1))
    bad = [r["doc_id"] for r in proofs(build_manifest(docs, forged)).collect() if not r["verified"]]
    assert bad == [7]
    assert proofs(build_manifest(docs)).filter("NOT verified").isEmpty()
