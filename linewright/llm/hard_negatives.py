"""Hard negatives by Strassen products of integer tiles and mergeable heaps (op12).

All rows are sorted by (width, label, id) over the cluster and cut into tiles; the anchors, in the same order, into batches. A batch
and a tile are multiplied by Strassen's recursion on zero-padded int64 matrices: seven products of halves in place of eight, with
additions that are exact, as int64 arithmetic is a ring modulo 2 ** 64 whatever the sums in between. Each product gives a heap of
the best few rows per anchor, and heaps are merged by Spark, first within a task, then per anchor.

First the positives: as tiles are sorted by label, a batch meets only the tiles of its labels. Then the windows: with the scores of
its positives each anchor meets all tiles, and a heap per (anchor, positive) holds the best rows of other labels in the window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linewright.session import materialize

from .common import query, table
from .merkle import ranked
from .topk import impacts, usable

#: Most rows of a tile and of a batch, and components of either at which they hold fewer rows.
TILE_ROWS, BATCH_ROWS, COMPONENTS = 4096, 512, 1 << 21
#: The recursion ends where a side of the product is this short.
SMALL = 16


def even(x: np.ndarray) -> np.ndarray:
    """With zeros up to an even number of rows and columns."""
    return np.pad(x, [(0, side % 2) for side in x.shape]) if any(side % 2 for side in x.shape) else x


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of int64 matrices, exact modulo 2 ** 64."""
    if min(*a.shape, b.shape[1]) <= SMALL:
        return a @ b
    rows, columns = a.shape[0], b.shape[1]
    a, b = even(a), even(b)
    i, j, k = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    m1 = strassen(a11 + a22, b11 + b22)
    m2 = strassen(a21 + a22, b11)
    m3 = strassen(a11, b12 - b22)
    m4 = strassen(a22, b21 - b11)
    m5 = strassen(a11 + a12, b22)
    m6 = strassen(a21 - a11, b11 + b12)
    m7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * i, 2 * k), "i8")
    out[:i, :k] = m1 + m4 - m5 + m7
    out[:i, k:] = m3 + m5
    out[i:, :k] = m2 + m4
    out[i:, k:] = m1 - m2 + m3 + m6
    return out[:rows, :columns]


def best(scores: np.ndarray, ids: np.ndarray, ranks: np.ndarray, some: np.ndarray, k: int) -> np.ndarray:
    """Of the rows `some`, the first k by descending score, then id, then rank."""
    if len(some) > 4 * k:  # all that reach the k-th score
        least = np.partition(scores[some], len(some) - k)[len(some) - k]
        some = some[scores[some] >= least]
    return some[np.lexsort((ranks[some], ids[some], ~scores[some]))[:k]]


def window_of(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and highest score s with low * score <= 100 * s <= high * score, in whole numbers."""
    return -(-low * score // 100), high * score // 100


PACKED = "tree string, part long, ranks binary, ids binary, classes binary, vectors binary"


def pack(rows: DataFrame, part: Column, more: str = "") -> DataFrame:
    """One row per (tree, part): ranks, ids, classes and vectors of its rows, in the order of their ranks. Written.

    `more` is a further column of arrays, with its type, that is kept as it is, or `first` and `last`, of which the bounds are.
    """
    name = more.split()[0] if more else None

    def join(group: pa.Table) -> pa.Table:
        group = group.sort_by("rank")
        packed = {"tree": group.column("tree").slice(0, 1), "part": group.column("part").slice(0, 1)}
        for short, column in (("ranks", "rank"), ("ids", "id"), ("classes", "first")):
            packed[short] = pa.array([group.column(column).to_numpy().astype("<i8").tobytes()], pa.binary())
        vectors = group.column("impacts").combine_chunks()
        packed["vectors"] = pa.array([vectors.flatten().to_numpy(zero_copy_only=False).astype("<i8").tobytes()], pa.binary())
        if name == "scores":
            lists = group.column("scores").combine_chunks()
            packed["scores"] = pa.ListArray.from_arrays(pa.array([0, len(lists)], pa.int32()), lists)
        else:
            packed["low"] = pa.array([min(group.column("first").to_pylist())], pa.int64())
            packed["high"] = pa.array([max(group.column("last").to_pylist())], pa.int64())
        return pa.table(packed)

    columns = ["tree", part.alias("part"), "rank", "id", "first", "last", "impacts", *([name] if name else [])]
    schema = f"{PACKED}, {f'scores array<{more.split()[1]}>' if name else 'low long, high long'}"
    return materialize(rows.select(*columns).groupBy("tree", "part").applyInArrow(join, schema), "packed")


def _matrix(data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, "<i8").reshape(rows, -1)


def searched(work: DataFrame, more: list[str], schema: str, search: Callable) -> DataFrame:
    """`search(row, scores, batch arrays, tile arrays)` of each (batch, tile): rows of `schema`, which has `tree` first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(at, 1).to_pylist()[0] for at in range(batch.num_rows)):
                mine = [np.frombuffer(row[x], "<i8") for x in ("ranks", "ids", "classes")]
                theirs = [np.frombuffer(row["tile_" + x], "<i8") for x in ("ranks", "ids", "classes")]
                scores = strassen(_matrix(row["vectors"], len(mine[0])), np.ascontiguousarray(_matrix(row["tile_vectors"], len(theirs[0])).T))
                out = list(search(row, scores, mine, theirs))
                columns = [[row["tree"]] * len(out), *(zip(*out, strict=True) if out else [[]] * (len(names) - 1))]
                yield pa.record_batch([pa.array(list(c), pa.string() if k == 0 else pa.int64()) for k, c in enumerate(columns)], names=names)

    names = [x.split()[0] for x in schema.split(", ")]
    fields = ("ranks", "ids", "classes", "vectors")
    return work.select("tree", *fields, *["tile_" + x for x in fields], *more).mapInArrow(run, schema)


def mine(
    rows: DataFrame,
    label: Column,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Components are floor(scale * x), a score is the integer inner product with the anchor; higher ones come first, ties by the smaller
    id. An anchor's positives are its first `positives` other rows of its label; for each of them, its negatives are the first
    `negatives` rows of other labels with low * positive <= 100 * negative <= high * positive. `label` and `is_anchor` are
    conditions on the columns of `rows`. All rows are compared; a batch of anchors meets each tile once for the positives and
    once for the negatives.

    Rows with a null id, label or vector, or with a null, NaN or infinite component take no part. Rows that share an id are
    different rows, as candidates and as anchors. Only vectors of the anchor's length are compared. Fewer positives or
    negatives give fewer rows, none give none; an empty table gives none. Other columns are not read. Scores, and `scale` times a
    component, must fit 64 bits.
    """
    used = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("string").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"), F.col(vector_col).alias("vector"))
    used = used.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    used = used.select("id", "label", "anchor", impacts(F.col("vector"), scale).alias("impacts"), F.monotonically_increasing_id().alias("o3"))
    used = materialize(used.withColumns({"tree": F.size("impacts").cast("string"), "o1": F.col("label"), "o2": F.col("id")}), "vectors")
    placed = materialize(ranked(used, "o1", "o2", "o3"), "placed")
    classes = placed.groupBy("tree", "label").agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
    placed = materialize(placed.join(classes, ["tree", "label"]).drop("label"), "placed")  # `first` is the label's number

    tile_rows = F.expr(f"greatest(1, least({TILE_ROWS}, {COMPONENTS} div greatest(1, int(tree))))")
    tiles = pack(placed.withColumn("size", tile_rows), F.expr("rank div size"))
    tiles = tiles.select("tree", F.col("part").alias("tile"), *[F.col(x).alias("tile_" + x) for x in ("ranks", "ids", "classes", "vectors")])
    size, last_tile = tile_rows.alias("size"), F.expr("(leaves - 1) div size").alias("last_tile")

    # anchors keep the order of their ranks, and so meet few labels
    anchors = placed.filter("anchor").withColumn("o1", F.col("rank")).withColumnsRenamed({"rank": "own", "leaves": "rows"})
    anchors = ranked(anchors, "o1").withColumn("batch", F.expr(f"rank div least({BATCH_ROWS}, greatest(1, {COMPONENTS} div greatest(1, int(tree))))"))
    anchors = materialize(anchors.drop("rank", "leaves", "anchor").withColumnsRenamed({"own": "rank", "rows": "leaves"}), "anchors")
    widths = placed.groupBy("tree").agg(F.max("leaves").alias("leaves")).select("tree", "leaves", size).select("tree", "size", last_tile)

    def best_positives(row: dict, scores: np.ndarray, own: list[np.ndarray], tile: list[np.ndarray]) -> Iterator[tuple]:
        for k, (rank, _, kind) in enumerate(zip(*own, strict=True)):
            same = np.flatnonzero((tile[2] == kind) & (tile[0] != rank))
            for at in best(scores[k], tile[1], tile[0], same, positives):
                yield rank, tile[0][at], tile[1][at], scores[k, at]

    batches = pack(anchors, F.col("batch")).join(widths, "tree")
    near = batches.withColumn("tile", F.explode(F.expr("sequence(low div size, high div size)"))).join(tiles, ["tree", "tile"])
    found = searched(near, [], "tree string, rank long, positive long, positive_id long, positive_score long", best_positives)
    order = Window.partitionBy("tree", "rank").orderBy(F.desc("positive_score"), "positive_id", "positive")
    found = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives)
    found = materialize(found, "positives")

    def best_negatives(row: dict, scores: np.ndarray, own: list[np.ndarray], tile: list[np.ndarray]) -> Iterator[tuple]:
        for k, (rank, _, kind) in enumerate(zip(*own, strict=True)):
            windows = [window_of(score, low, high) for score in row["scores"][k]]
            least, most = min(w[0] for w in windows), max(w[1] for w in windows)
            some = np.flatnonzero((tile[2] != kind) & (scores[k] >= least) & (scores[k] <= most))
            for place, (a, b) in enumerate(windows, 1):
                inside = some[(scores[k, some] >= a) & (scores[k, some] <= b)]
                for at in best(scores[k], tile[1], tile[0], inside, negatives):
                    yield rank, place, tile[0][at], tile[1][at], scores[k, at]

    scores = found.groupBy("tree", "rank").agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("p"))
    asked = anchors.join(scores.select("tree", "rank", F.col("p.positive_score").alias("scores")), ["tree", "rank"])
    batches = pack(asked, F.col("batch"), "scores array<long>").join(widths, "tree")
    every = batches.withColumn("tile", F.explode(F.expr("sequence(0L, last_tile)"))).join(tiles, ["tree", "tile"])
    hard = searched(every, ["scores"], "tree string, rank long, place long, negative long, negative_id long, negative_score long", best_negatives)
    order = Window.partitionBy("tree", "rank", "place").orderBy(F.desc("negative_score"), "negative_id", "negative")
    hard = hard.withColumn("number", F.row_number().over(order)).filter(F.col("number") <= negatives)
    ids = anchors.select("tree", "rank", F.col("id").alias("anchor_id"))
    whole = hard.join(found.withColumn("place", F.col("place").cast("long")), ["tree", "rank", "place"]).join(ids, ["tree", "rank"])
    return whole.select("anchor_id", "positive_id", F.col("number").alias("rank"), "negative_id", "positive_score", "negative_score")


@query(
    "op12_strassen_negatives",
    """
    WITH v AS (
        SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS kind,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
        SELECT a.uid AS anchor, a.vec_id AS anchor_id, b.uid AS other, b.vec_id AS other_id, a.kind = b.kind AS same,
               CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
        FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.uid <> b.uid),
    p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id, other) <= 5)
    SELECT p.anchor_id, p.other_id AS positive_id,
           CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other_id, n.other) AS INTEGER) AS rank,
           n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM p JOIN s n ON n.anchor = p.anchor AND NOT n.same
    WHERE 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
    QUALIFY rank <= 5
    """,
)
def strassen_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh row has the next label."""
    id_ = F.col("vec_id")
    label = F.when(id_ % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, folder, "embeddings"), label, id_ % 100 == 0)
