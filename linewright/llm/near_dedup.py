"""Near duplicates by consistent weighted sampling over TF-IDF shingles (op6).

A document is its shingles of five words, each with the weight count * idf. Improved consistent weighted sampling draws,
for each of BANDS * ROWS random seeds, one (shingle, level) so that two documents draw the same with a probability equal to
their weighted Jaccard similarity. ROWS draws make a band key. Documents that share a key are candidates, and the weighted
Jaccard similarity of the whole shingle sets decides.

Candidates are kept linear in the rows. Each bucket of a key has one leader, the member that shares most keys with others, so the
middle of a group; all members are compared with it, and what is like it is one class. Then only members of different classes are
left to compare: all of them in buckets of SMALL members or fewer. A larger bucket is split by further draws: its members get
SPLIT_KEYS longer keys of SPLIT_ROWS draws out of SPLIT_SEEDS, and meet where they share one. Before whole sets are compared, the
share of equal draws, four bits of each, has to leave the similarity possible, and in split buckets the shingles that no other
row has must leave it possible too: a row that differs from all others in too many gets no keys, and of two rows either has to have
enough of what is left. This bound loses no link.

idf falls with the share of documents that hold a shingle, from 1 at a share of COMMON or less to FLOOR where all
hold it: lines that stand everywhere count less, and a group of copies does not lose its weight. The share is counted over all
documents in a count-min sketch of fixed size. A counter is too high by (shingles per document / WIDTH) of all
documents at most on average, whatever the number of documents, so the sketch need not grow.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dropping, give_back, make_room, materialize, query, table, whole
from .exact_dedup import small

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 3
#: Share of documents from which on a shingle weighs less, and the least idf.
COMMON, FLOOR = 0.01, 0.5
#: Counters of each row of the sketch; rows; counters that are summed together; partial sketches that a task adds up.
WIDTH, DEPTH, SEGMENT, FAN_IN = 1 << 18, 2, 1 << 12, 64
#: Members of a bucket that are compared with each other; beyond, the bucket is split by keys of so many draws, so many keys, from
#: so many seeds. Rows with a similarity of 0.8 share one with a chance of 0.99, rows of 0.55 with one of 0.07.
SMALL = 16
SPLIT_ROWS, SPLIT_KEYS, SPLIT_SEEDS = 12, 96, 144
#: Least number of equal draws, of BANDS * ROWS and of these and SPLIT_SEEDS together. A weighted similarity of 0.73, which is that of a plain 0.8 in a
#: large group of copies, has fewer with a chance of 0.003; one of 0.8 with a chance of 0.0001.
LEAST_EQUAL, LEAST_EQUAL_SPLIT = 28, 126
#: Bytes of text that are worked on at a time.
GROUP_BYTES = 1 << 19

_rng = np.random.default_rng(20)
#: Random numbers of the hash functions.
_BYTE = _rng.integers(0, 1 << 63, 256, dtype="u8") * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(0, 1 << 63, 4096, dtype="u8") * np.uint64(2) + np.uint64(1)
_WORD = _rng.integers(0, 1 << 63, WORDS, dtype="u8") * np.uint64(2) + np.uint64(1)
_SEED = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype="u8") * np.uint64(2) + np.uint64(1)
_SPLIT_SEED = _rng.integers(0, 1 << 63, SPLIT_SEEDS, dtype="u8") * np.uint64(2) + np.uint64(1)
#: Which draws make each longer key.
_SPLIT = np.stack([_rng.permutation(SPLIT_SEEDS)[:SPLIT_ROWS] for _ in range(SPLIT_KEYS)], axis=1)
#: Word bytes: ASCII letters and digits, and all bytes of other characters.
_IN_WORD = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def _gamma_quantiles(count: int = 1 << 16) -> np.ndarray:
    """Quantiles of the gamma distribution with shape 2, by Newton's method."""
    p = (np.arange(count) + 0.5) / count
    x = np.maximum(np.sqrt(2 * p), -np.log1p(-p))
    for _ in range(60):
        x = np.maximum(1e-12, x - (1 - (1 + x) * np.exp(-x) - p) / np.maximum(x * np.exp(-x), 1e-300))
    return x


_GAMMA = _gamma_quantiles()
_LOG_GAMMA = np.log(_GAMMA)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of all words of texts that lie end to end."""
    inside = _IN_WORD[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.empty(0, "u8"), np.empty(0, "i8")
    number = np.cumsum(begins)
    at = np.flatnonzero(inside)
    place = (at - starts[number[at] - 1]) & 4095
    parts = _BYTE[data[at]] * _PLACE[place]
    first = np.searchsorted(at, starts)
    hashes = mixed(np.add.reduceat(parts, first))
    return hashes, np.searchsorted(offsets, starts, "right") - 1


def _words_of_group(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`_word_hashes`, a long text in parts that end between words."""
    if len(data) <= 2 * GROUP_BYTES:
        return _word_hashes(data, offsets)
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + GROUP_BYTES)
        while end < len(data) and _IN_WORD[data[end]]:  # a word is not cut
            end += 1
        local = np.clip(offsets, at, end) - at
        out.append(_word_hashes(data[at:end], local))
        at = end
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Shingles:
    """Distinct shingles of a group of documents: doc, hash and count, sorted by doc; and a fingerprint of each word sequence."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words, doc = _words_of_group(data, offsets)
        docs = len(offsets) - 1
        size = np.bincount(doc, minlength=docs)
        begin = np.concatenate([[0], np.cumsum(size)[:-1]])
        place = (np.arange(len(words)) - np.repeat(begin, size)).astype("u8")
        self.prints = [np.zeros(docs, "u8"), np.zeros(docs, "u8")]
        for k, salt in enumerate((np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03))):
            np.add.at(self.prints[k], doc, mixed(words * salt ^ mixed(place + salt)))
        n = max(0, len(words) - WORDS + 1)
        whole = np.arange(n)[doc[:n] == doc[WORDS - 1 :]] if n else np.empty(0, "i8")
        hashes = sum((words[whole + k] * _WORD[k] for k in range(WORDS)), np.zeros(len(whole), "u8"))
        short = np.flatnonzero(size < WORDS)  # fewer words: one shingle of what there is
        few = [sum((int(words[begin[d] + k]) * int(_WORD[k]) for k in range(size[d])), int(size[d]) + 1) & (2**64 - 1) for d in short]
        hashes = mixed(np.concatenate([hashes, np.array(few, "u8")]))
        doc = np.concatenate([doc[whole], short])
        order = np.lexsort((hashes, doc))
        hashes, doc = hashes[order], doc[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        self.doc, self.hash = doc[at], hashes[at]
        self.count = np.diff(np.append(at, len(hashes)))
        self.begin = np.searchsorted(self.doc, np.arange(docs))  # every document has a shingle

    def only(self, keep: np.ndarray) -> Shingles:
        """Those of the documents for which `keep` is true."""
        out, inside = copy.copy(self), keep[self.doc]
        out.doc, out.hash, out.count = (np.cumsum(keep) - 1)[self.doc[inside]], self.hash[inside], self.count[inside]
        out.begin = np.searchsorted(out.doc, np.arange(keep.sum()))
        out.prints = [p[keep] for p in self.prints]
        return out


def groups(texts: pa.Array) -> Iterator[tuple[int, int, Shingles]]:
    """(first row, end row, shingles) of groups of rows of about GROUP_BYTES. The texts hold no null."""
    texts = texts.cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], "i8")[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", "u1")
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + GROUP_BYTES, "right")) - 1)
        high = min(high, len(texts), low + 4096)
        yield low, high, Shingles(data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low])
        low = high


def slots(hashes: np.ndarray) -> list[np.ndarray]:
    """The counter of each sketch row for each shingle."""
    return [(hashes >> np.uint64(18 * k)).astype("i8") & (WIDTH - 1) for k in range(DEPTH)]


def count_documents(numbered: DataFrame) -> np.ndarray:
    """The sketch: how many documents hold the shingles of each counter. Partial sketches are added up in a tree."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        sketch = np.zeros((DEPTH, WIDTH), "i8")
        for batch in batches:
            for _, _, shingles in groups(batch.column(0)):
                for row, slot in enumerate(slots(shingles.hash)):
                    sketch[row] += np.bincount(slot, minlength=WIDTH)
        parts = sketch.reshape(-1, SEGMENT)
        used = [k for k in range(len(parts)) if parts[k].any()]
        columns = [pa.array(used, pa.int32()), pa.array([TaskContext.get().partitionId()] * len(used), pa.int64()), pa.array([parts[k].tobytes() for k in used], pa.binary())]
        yield pa.record_batch(columns, names=["segment", "part", "counts"])
        give_back()

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = reduce(np.add, (np.frombuffer(c, "i8") for c in rows["counts"]))
        return pd.DataFrame({"segment": [rows["segment"].iloc[0]], "part": [rows["part"].iloc[0] // FAN_IN], "counts": [total.tobytes()]})

    schema = "segment int, part long, counts binary"
    parts = numbered.select("text").mapInArrow(count, schema)
    parts = materialize(parts, "sketch")
    tasks = (parts.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        parts = parts.groupBy("segment", F.expr(f"part div {FAN_IN}")).applyInPandas(add, schema)
        tasks = -(-tasks // FAN_IN)
        if tasks == 1:
            break
    sketch = np.zeros((DEPTH * WIDTH // SEGMENT, SEGMENT), "i8")
    for row in parts.select("segment", "counts").collect():  # DEPTH * WIDTH counters, whatever the input
        sketch[row["segment"]] = np.frombuffer(row["counts"], "i8")
    return sketch.reshape(DEPTH, WIDTH)


class Weights:
    """idf from the sketch."""

    def __init__(self, sketch: np.ndarray, documents: int):
        share = np.maximum(sketch, 1) / max(1, documents)
        idf = np.log(1 / np.minimum(share, 1)) / math.log(1 / COMMON)
        self.idf = np.clip(idf, FLOOR, 1).astype("f4")

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """The least of the counters is nearest to the truth, so the highest idf."""
        return reduce(np.maximum, (self.idf[row][slot] for row, slot in enumerate(slots(hashes)))).astype("f8")


def draws(shingles: Shingles, weights: np.ndarray, seeds: np.ndarray = _SEED) -> np.ndarray:
    """One row for each document: the draws of the seeds, by improved consistent weighted sampling."""
    begin, doc = shingles.begin, shingles.doc
    log_weight = np.log(weights)
    out = np.empty((len(begin), len(seeds)), "u8")
    for j, seed in enumerate(seeds):
        x = (shingles.hash ^ seed) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x94D049BB133111EB)
        r = _GAMMA[(x >> np.uint64(48)).astype("i8")]
        c = _LOG_GAMMA[(x >> np.uint64(32)).astype("i8") & 0xFFFF]
        beta = ((x >> np.uint64(16)).astype("i8") & 0xFFFF) * (1 / 65536)
        level = np.floor(log_weight / r + beta)
        key = c - r * (level - beta) - r
        least = np.minimum.reduceat(key, begin)
        hit = np.flatnonzero(key == least[doc])
        hit = hit[np.searchsorted(doc[hit], np.arange(len(begin)))]  # the first of equal ones
        out[:, j] = mixed(shingles.hash[hit] * np.uint64(3) + level[hit].astype("i8").astype("u8"))
    return out


def _lists(values: np.ndarray) -> pa.Array:
    """Rows of 64-bit numbers as lists."""
    rows, width = values.shape
    return pa.ListArray.from_arrays(np.arange(0, rows * width + 1, width, dtype="i4"), pa.array(values.view("i8").ravel()))


def sketched(drawn: np.ndarray) -> np.ndarray:
    """Four bits of each draw, sixteen draws to a number."""
    bits = (drawn >> np.uint64(60)).reshape(len(drawn), -1, 16) << np.arange(0, 64, 4, dtype="u8")
    return np.bitwise_or.reduce(bits, axis=2)


def alike(a: str, b: str, draws_: int, least: int) -> Column:
    """Whether two sketches agree in `least` of their draws or more; other draws agree by chance one time in sixteen."""
    differing = F.lit(0)
    for k in range(draws_ // 16):
        x = F.col(a)[k].bitwiseXOR(F.col(b)[k])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        differing = differing + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return differing <= draws_ - least


def sign(numbered: DataFrame, weights: Weights) -> DataFrame:
    """(uid, id, p, q, bands, sketch): the word sequence's fingerprint, the band keys and bits of the draws of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        for batch in batches:
            for low, high, shingles in groups(batch.column(2)):
                drawn = draws(shingles, shingles.count * weights.of(shingles.hash))
                keys = np.zeros((high - low, BANDS), "u8")
                for row in range(ROWS):
                    keys = mixed(keys ^ drawn[:, row::ROWS] + np.arange(BANDS, dtype="u8"))
                some = batch.slice(low, high - low)
                columns = [some.column(0), some.column(1), *(pa.array(p.view("i8")) for p in shingles.prints), _lists(keys), _lists(sketched(drawn))]
                yield pa.record_batch(columns, names=["uid", "id", "p", "q", "bands", "sketch"])
        give_back()

    kind = numbered.schema["id"].dataType.simpleString()
    return numbered.select("uid", "id", "text").mapInArrow(run, f"uid long, id {kind}, p long, q long, bands array<long>, sketch array<long>")


def own_shingles(texts: DataFrame, weights: Weights) -> DataFrame:
    """(uid, own, own_weight): count and weight of each row's shingles that no other of these rows (uid, text) has. Written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, _, shingles in groups(batch.column(1)):
                columns = [batch.column(0).take(pa.array(shingles.doc + low)), pa.array(shingles.hash.view("i8")), pa.array(shingles.count)]
                columns.append(pa.array(shingles.count * weights.of(shingles.hash)))
                yield pa.record_batch(columns, names=["uid", "shingle", "n", "weight"])
        give_back()

    each = texts.select("uid", "text").mapInArrow(run, "uid long, shingle long, n long, weight double")
    alone = each.groupBy("shingle").agg(F.count("*").alias("rows"), *(F.min(c).alias(c) for c in ("uid", "n", "weight"))).filter("rows = 1")
    return materialize(alone.groupBy("uid").agg(F.sum("n").alias("own"), F.sum("weight").alias("own_weight")), "own-shingles")


def reaches(shared, total, threshold: float):
    """Whether a Jaccard similarity can reach the threshold, if at most `shared` is in common and both sides add up to `total`; for
    numbers, arrays and columns. Sums of floats may differ in their last bits."""
    return shared * (1 + threshold) >= total * (threshold - 1e-9)


def split_keys(texts: DataFrame, weights: Weights, threshold: float) -> DataFrame:
    """(uid, keys, sketch, total, shared, weight, shared_weight): SPLIT_KEYS longer keys from draws of their own, and bits of all draws; the
    row's total, and what other rows may have of it, by counts and by weights. From (uid, text, own, own_weight); rows of which others
    have too little for any link are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, shingles in groups(batch.column(1)):
                heavy = shingles.count * weights.of(shingles.hash)
                total, weight = (np.add.reduceat(x, shingles.begin) for x in (shingles.count, heavy))
                own, own_weight = (batch.column(k).slice(low, high - low).to_numpy(zero_copy_only=False) for k in (2, 3))
                shared, shared_weight = total - own, weight - own_weight
                keep = reaches(shared, total + shared, threshold) | reaches(shared_weight, weight + shared_weight, threshold)
                if not keep.any():
                    continue
                inside = keep[shingles.doc]
                some, heavy = shingles.only(keep), heavy[inside]
                drawn = draws(some, heavy, np.concatenate([_SPLIT_SEED, _SEED]))
                keys = np.zeros((len(drawn), SPLIT_KEYS), "u8")
                for chosen in _SPLIT:
                    keys = mixed(keys ^ drawn[:, chosen] + np.arange(SPLIT_KEYS, dtype="u8"))
                columns = [batch.column(0).slice(low, high - low).filter(pa.array(keep)), _lists(keys), _lists(sketched(drawn))]
                columns += [pa.array(x[keep]) for x in (total, shared, weight, shared_weight)]
                yield pa.record_batch(columns, names=["uid", "keys", "sketch", "total", "shared", "weight", "shared_weight"])
        give_back()

    schema = "uid long, keys array<long>, sketch array<long>, total long, shared long, weight double, shared_weight double"
    return texts.select("uid", "text", "own", "own_weight").mapInArrow(run, schema)


def vectors_of(numbered: DataFrame, weights: Weights) -> DataFrame:
    """(uid, vector): each document's shingles as 32-bit hashes, counts and idf, sorted by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, shingles in groups(batch.column(1)):
                idf = weights.of(shingles.hash)
                ends = np.append(shingles.begin[1:], len(shingles.hash))
                out = []
                for a, b in zip(shingles.begin, ends, strict=True):
                    packed = np.empty(b - a, [("h", "<u4"), ("n", "<u4"), ("w", "<f4")])
                    packed["h"], packed["n"], packed["w"] = shingles.hash[a:b] >> np.uint64(32), shingles.count[a:b], idf[a:b]
                    out.append(packed.tobytes())
                yield pa.record_batch([batch.column(0).slice(low, high - low), pa.array(out, pa.binary())], names=["uid", "vector"])
        give_back()

    return numbered.select("uid", "text").mapInArrow(run, "uid long, vector binary")


def similarity(a: bytes, b: bytes) -> tuple[float, float]:
    """Jaccard similarity with idf weights, and with counts alone. Hashes are sorted in both."""
    x, y = (np.frombuffer(v, [("h", "<u4"), ("n", "<u4"), ("w", "<f4")]) for v in (a, b))
    at = np.minimum(np.searchsorted(y["h"], x["h"]), len(y) - 1)
    same = y["h"][at] == x["h"]
    both = np.minimum(x["n"][same], y["n"][at[same]]).astype("f8")
    out = []
    for values in (lambda v: v["n"].astype("f8") * v["w"], lambda v: v["n"].astype("f8")):
        shared = both * x["w"][same] if not out else both
        total = values(x).sum() + values(y).sum() - shared.sum()
        out.append(float(shared.sum() / total) if total else 1.0)
    return out[0], out[1]


def verify(pairs: DataFrame, numbered: DataFrame, weights: Weights, threshold: float) -> DataFrame:
    """Pairs (uid, leader) whose weighted or plain Jaccard similarity reaches the threshold. Written; what it takes is deleted."""
    with dropping(pairs.sparkSession):
        return _verify(materialize(pairs, "pairs"), numbered, weights, threshold)


def _verify(pairs: DataFrame, numbered: DataFrame, weights: Weights, threshold: float) -> DataFrame:
    involved = materialize(pairs.select("uid").union(pairs.select("leader")).distinct(), "involved")
    texts = numbered.select("uid", "text").join(small(involved), "uid", "left_semi")
    vectors = materialize(vectors_of(texts, weights), "vectors")
    other = vectors.select(F.col("uid").alias("leader"), F.col("vector").alias("leader_vector"))
    joined = pairs.join(vectors, "uid").join(other, "leader")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            a, b = batch.column(2), batch.column(3)
            found = [max(similarity(a[k].as_buffer(), b[k].as_buffer())) >= threshold for k in range(batch.num_rows)]
            yield batch.select(["uid", "leader"]).filter(pa.array(found, pa.bool_()))
        give_back()

    found = joined.select("uid", "leader", "vector", "leader_vector").mapInArrow(run, "uid long, leader long")
    return materialize(found, "links", keep=True)


def components(links: DataFrame) -> DataFrame:
    """(uid, root) of all rows that links (uid, leader) join: the smallest uid that can be reached. Written.

    Each round takes the least label of the neighbours and then the label of the label, as written tables, until no label
    changes; the number of rounds follows the logarithm of the longest way.
    """
    with dropping(links.sparkSession):
        return materialize(_components(links), "components", keep=True)


def _components(links: DataFrame) -> DataFrame:
    both = links.select("uid", F.col("leader").alias("to")).unionByName(links.select(F.col("leader").alias("uid"), F.col("uid").alias("to")))
    both = materialize(both.distinct(), "edges")
    labels = materialize(both.groupBy("uid").agg(F.least(F.min("to"), F.col("uid")).alias("root")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("uid", "to"), "to").groupBy("uid").agg(F.min("root").alias("near"))
        better = materialize(labels.join(near, "uid").select("uid", F.col("root").alias("old"), F.least("root", "near").alias("root")), "labels")
        jump = better.select(F.col("uid").alias("root"), F.col("root").alias("further"))
        after = better.join(jump, "root").select("uid", "old", F.col("further").alias("root"))
        labels = materialize(after, "labels")
        if labels.filter("root <> old").isEmpty():
            return labels.select("uid", "root")
        labels = labels.select("uid", "root")


def link_counts(links: DataFrame) -> DataFrame:
    """(uid, links): how many links each row has."""
    return links.select(F.explode(F.array("uid", "leader")).alias("uid")).groupBy("uid").agg(F.count("*").alias("links"))


def _pair(a: str, b: str) -> list[Column]:
    return [F.greatest(a, b).alias("uid"), F.least(a, b).alias("leader")]


#: What `split_keys` tells of a row: pairs of totals and what other rows may have of them.
_BOUNDS = (("total", "shared"), ("weight", "shared_weight"))


def _across(members: DataFrame, by: list[str], draws_: int, least: int, threshold: float | None = None) -> DataFrame:
    """Pairs (uid, leader) of members of a bucket that are in different classes and whose draws leave them possible, and, with a
    threshold, whose bounds do: two rows have in common what other rows may have of either at most."""
    bounds = [c for pair in _BOUNDS for c in pair] if threshold is not None else []
    other = members.select(*by, *(F.col(c).alias(f"to_{c}") for c in ("uid", "root", "sketch", *bounds)))
    apart = reduce(lambda x, y: x & y, [members[c] == other[c] for c in by]) & (members["root"] < other["to_root"])
    possible = alike("sketch", "to_sketch", draws_, least)
    if bounds:
        reached = [reaches(F.least(s, f"to_{s}"), F.col(n) + F.col(f"to_{n}"), threshold) for n, s in _BOUNDS]
        possible = (reached[0] | reached[1]) & possible
    return members.join(other, apart & possible).select(*_pair("uid", "to_uid")).distinct()


def _open(members: DataFrame, by: list[str]) -> DataFrame:
    """Buckets that hold members of several classes, with their sizes."""
    sizes = members.groupBy(*by).agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"))
    return sizes.filter("low < high").select(*by, "n")


def classes(numbered: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """From a written (uid, id, text): uid and class of rows in classes of two or more, and links. Both written."""
    with dropping(numbered.sparkSession):
        return _classes(numbered, threshold)


def _classes(numbered: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    weights = Weights(count_documents(numbered), numbered.count())
    signed = materialize(sign(numbered, weights), "signatures")

    # rows of the same words: one stands for all
    same = materialize(signed.groupBy("p", "q").agg(F.min("uid").alias("leader"), F.count("*").alias("n")), "word-sequences")
    copies = signed.select("uid", "p", "q").join(same.filter("n > 1"), ["p", "q"]).filter("uid <> leader").select("uid", "leader")
    copies = materialize(copies, "copies", keep=True)
    distinct = signed.join(small(copies.select("uid")), "uid", "left_anti")
    keyed = distinct.select("uid", "sketch", F.posexplode("bands").alias("band", "key"))

    # buckets, and in each the member that shares most keys with others; of such ones any, but the same in all buckets
    sizes = keyed.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1")
    members = materialize(keyed.join(sizes, ["band", "key"]), "members")
    degrees = members.groupBy("uid").agg(F.sum(F.col("n") - 1).alias("shared"))
    place = F.shiftleft(F.least("shared", F.lit((1 << 30) - 1)), 32).bitwiseOR(F.xxhash64("uid").bitwiseAND(F.lit((1 << 32) - 1)))
    degrees = degrees.select("uid", place.alias("place"))
    leaders = members.select("band", "key", "uid").join(degrees, "uid").groupBy("band", "key").agg(F.max_by("uid", "place").alias("leader"))
    leaders = leaders.join(distinct.select(F.col("uid").alias("leader"), F.col("sketch").alias("leader_sketch")), "leader")
    near = members.join(leaders, ["band", "key"]).filter((F.col("uid") != F.col("leader")) & alike("sketch", "leader_sketch", BANDS * ROWS, LEAST_EQUAL))
    links = verify(near.select(*_pair("uid", "leader")).distinct(), numbered, weights, threshold).unionByName(copies)
    found = components(links)

    # what is left are members of different classes
    placed = members.join(found, "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    placed = materialize(placed.drop("n"), "placed")
    rest = materialize(placed.join(_open(placed, ["band", "key"]), ["band", "key"]), "open")
    few = _across(rest.filter(F.col("n") <= SMALL), ["band", "key"], BANDS * ROWS, LEAST_EQUAL)
    many = materialize(rest.filter(F.col("n") > SMALL).select("uid", "root").distinct(), "split")
    held = numbered.select("uid", "text").join(small(many.select("uid")), "uid", "left_semi")
    held = held.join(small(own_shingles(held, weights)), "uid", "left").fillna(0, ["own", "own_weight"])
    split = split_keys(held, weights, threshold).join(many, "uid").select("*", F.posexplode("keys").alias("band", "key")).drop("keys")
    split = materialize(split, "split-members")
    split = split.join(_open(split, ["band", "key"]), ["band", "key"])
    pairs = few.unionByName(_across(split, ["band", "key"], SPLIT_SEEDS + BANDS * ROWS, LEAST_EQUAL_SPLIT, threshold)).distinct()
    more = verify(pairs, numbered, weights, threshold)
    links = links.unionByName(more)
    return (components(links) if not more.isEmpty() else found), links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """One row per document: id, class_id (the smallest id of its class), class_size, links, kept.

    Two documents are linked if the Jaccard similarity of their shingles, with idf weights or with counts alone, is
    `threshold` or more; classes are what links join. Rows of the same words (letter case and other characters aside) are
    linked to one of them, others to members of their buckets. `links` counts a row's links that were made. The row with the
    smallest id stays (null last; of equal ids one). Texts of fewer than five words are one shingle; null counts as
    empty, and texts without words are the same. An empty table gives no rows. Other columns are not read.
    """
    text = F.lower(whole(text_col)).alias("text")
    numbered = materialize(docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), text), "texts")
    found, links = classes(numbered, threshold)
    rows = numbered.select("uid", "id")
    order = F.struct(F.col("id").isNull(), "id", "uid")
    members = materialize(found.join(rows, "uid"), "class-members")
    best = members.groupBy("root").agg(F.min(order).alias("best"), F.count("*").alias("class_size"))
    best = materialize(best.select("root", F.col("best.id").alias("class_id"), F.col("best.uid").alias("best_uid"), "class_size"), "classes")
    placed = members.select("uid", "root").join(best, "root")
    return (
        rows.join(placed, "uid", "left")
        .join(link_counts(links), "uid", "left")
        .select(
            F.col("id").alias(id_col),
            F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
            F.coalesce("class_size", F.lit(1)).alias("class_size"),
            F.coalesce("links", F.lit(0)).alias("links"),
            F.coalesce(F.col("uid") == F.col("best_uid"), F.lit(True)).alias("kept"),
        )
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """One row of each class, with all its columns: the row with the smallest id. All but the rows' table is deleted."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("uid"), row), "rows", keep=True)
    text = F.lower(whole(F.col("row")[text_col])).alias("text")
    numbered = rows.select("uid", F.col("row")[id_col].alias("id"), text)
    with dropping(docs.sparkSession):
        found, _ = classes(numbered, threshold)
        members = materialize(found.join(numbered.select("uid", "id"), "uid"), "class-members")
        best = members.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "uid")).alias("best"))
        best = materialize(best.select("root", F.col("best.uid").alias("best_uid")), "classes")
        gone = materialize(members.join(best, "root").filter("uid <> best_uid").select("uid"), "dropped", keep=True)
    return rows.join(small(gone), "uid", "left_anti").select("row.*")


@query("op6_icws_near_dedup")
def icws_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with their class of near duplicates."""
    return near_duplicates(table(spark, folder, "documents"))
