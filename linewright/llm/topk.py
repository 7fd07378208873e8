"""Exact top-k by inner product over an impact-ordered index (op9)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linewright.session import materialize

from .common import query, table

#: Vectors of an index block, and queries that are answered together.
BLOCK_ROWS = 8192
BATCH_QUERIES = 256
#: Possible members for each query at which the rest is scored exactly.
FEW = 4


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, odd), F.lit(True))


def impacts(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def _segments(block: np.ndarray) -> tuple[list[dict], bool]:
    """Postings of a block (vectors x dimensions), a segment for each power of two of |impact| and dimension, largest first."""
    size = np.abs(block)
    level = np.where(size > 0, np.frexp(size.astype("f8"))[1], 0)
    out = []
    for top in sorted(set(np.unique(level)) - {0}, reverse=True):
        rows, dims = np.nonzero(level == top)
        order = np.lexsort((rows, dims))
        rows, dims = rows[order], dims[order]
        rest = np.where(level < top, block, 0).astype("f8")
        out.append(
            {
                "level": int(top),
                "dims": np.bincount(dims, minlength=block.shape[1]).astype("<i4").tobytes(),
                "rows": rows.astype("<i4").tobytes(),
                "impacts": block[rows, dims].astype("<i8").tobytes(),
                "rest": np.sqrt((rest * rest).sum(1)).astype("<f8").tobytes(),
            }
        )
    return out


SEGMENT = "struct<level int, dims binary, rows binary, impacts binary, rest binary>"


def build_index(vectors: DataFrame, blocks: int) -> DataFrame:
    """One row per block of (row, id, impacts): row numbers, ids and posting segments by descending impact. All rows are indexed."""

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["id", "row"])
        block = np.array(part["impacts"].tolist(), "i8").reshape(len(part), -1)
        numbers = {name: part[column].to_numpy("<i8").tobytes() for name, column in (("rows", "row"), ("ids", "id"))}
        return pd.DataFrame([{"width": block.shape[1], "block": part["block"].iloc[0], **numbers, "segments": _segments(block)}])

    placed = vectors.select("row", "id", "impacts", F.size("impacts").alias("width"), F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"))
    return placed.groupBy("width", "block").applyInPandas(build, f"width int, block int, rows binary, ids binary, segments array<{SEGMENT}>")


def search_block(
    numbers: np.ndarray, ids: np.ndarray, segments: list[dict], query_rows: np.ndarray, queries: np.ndarray, k: int
) -> Iterator[tuple]:
    """(query's row, row, id, score) of each query's best k of a block, ties to smaller ids. A query's own row takes no part.

    Adds up segments by descending impact. What is left of a vector is at most |query| * |rest of the vector| (and a
    little for rounding), so a vector is possible while its sum plus that reaches the k-th best sum less that. Stops when
    few are possible or no segment is left, and scores the possible ones exactly.
    """
    width, count = queries.shape[1], len(ids)
    whole = np.zeros((width, count), "i8")
    levels = []
    for segment in segments:
        dims = np.repeat(np.arange(width), np.frombuffer(segment["dims"], "<i4"))
        rows, values = np.frombuffer(segment["rows"], "<i4"), np.frombuffer(segment["impacts"], "<i8")
        whole[dims, rows] = values
        levels.append((dims, rows, values, np.frombuffer(segment["rest"], "<f8")))
    # sums below 2**53 are whole numbers in doubles too
    exact = bool(whole.size) and float(np.abs(whole).max()) * float(np.abs(queries).max() if queries.size else 0) * width < 2.0**53
    own = query_rows[:, None] == numbers[None, :]
    norm = np.sqrt((queries.astype("f8") ** 2).sum(1))
    sums = np.zeros((len(queries), count))
    possible = ~own
    for dims, rows, values, rest in levels:
        part = np.zeros((width, count))
        part[dims, rows] = values
        sums += queries.astype("f8") @ part
        if count <= k:
            break
        slack = norm[:, None] * rest[None, :] * (1 + 1e-9) + (0 if exact else np.abs(sums) * 1e-6 + 1)
        least = np.where(own, -np.inf, sums - slack)
        kth = -np.partition(-least, k - 1, axis=1)[:, k - 1]
        possible = (sums + slack >= kth[:, None]) & ~own
        if possible.sum() <= FEW * k * len(queries):
            break
    for row, number in enumerate(query_rows):
        members = np.flatnonzero(possible[row])
        scores = (queries[row][None, :] @ whole[:, members])[0]
        best = np.lexsort((numbers[members], ids[members], -scores))[:k]
        for m in best:
            yield int(number), int(numbers[members[m]]), int(ids[members[m]]), int(scores[m])


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Each query's k highest integer inner products with all other rows: query_id, rank (from 1), id, score.

    Components are floor(scale * x). `is_query` is a condition on the id column. All rows go into blocks of about
    `block_rows`, each with its own impact-ordered index; batches of queries go to every block, a block answers with k rows
    for each query, and the answers are merged. Nothing is left out: a block stops only when no other row can be a member.

    Null vectors, those with a null, NaN or infinite component, and rows with a null id take no part. Rows that share an id are
    different rows, as candidates and as queries. Only vectors of the query's length are candidates. Fewer than k candidates give fewer
    rows; an empty table gives none. Other columns are not read. Sums must fit 64 bits. A block of very wide vectors takes
    `block_rows` times their width; give fewer rows then.
    """
    if block_rows < 1 or k < 1:
        raise ValueError("block_rows and k must be positive")
    usable_rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    usable_rows = usable_rows.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    whole = usable_rows.select(F.monotonically_increasing_id().alias("row"), "id", impacts(F.col("vector"), scale).alias("impacts"))
    whole = materialize(whole, "impacts")
    blocks = max(1, math.ceil(whole.count() / block_rows))
    asked = whole.withColumnRenamed("id", id_col).filter(is_query).withColumnRenamed(id_col, "id")
    batches = max(1, math.ceil(asked.count() / BATCH_QUERIES))
    index = materialize(build_index(whole, blocks), "impact-index")
    dealt = asked.select(F.size("impacts").alias("width"), F.pmod(F.xxhash64("row"), F.lit(batches)).cast("int").alias("batch"), F.struct("row", "impacts").alias("q"))
    groups = dealt.groupBy("width", "batch").agg(F.collect_list("q").alias("queries"))  # about BATCH_QUERIES each
    everywhere = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    work = index.join(everywhere, ["width", "block"])

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                asking = np.array([q["row"] for q in row.queries], "i8")
                queries = np.array([q["impacts"] for q in row.queries], "i8").reshape(len(asking), -1)
                found = search_block(np.frombuffer(row.rows, "<i8"), np.frombuffer(row.ids, "<i8"), list(row.segments), asking, queries, k)
                yield pd.DataFrame(list(found), columns=["query_row", "row", "id", "score"]).astype("int64")

    found = work.select("rows", "ids", "segments", "queries").mapInPandas(search, "query_row long, row long, id long, score long")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "id", "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    names = asked.select(F.col("row").alias("query_row"), F.col("id").alias("query_id"))
    return ranked.join(names, "query_row").select("query_id", "rank", F.col("id").alias(id_col), "score")


@query(
    "op9_impact_topk",
    """
    WITH v AS (
        SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
        SELECT a.n AS q, a.vec_id AS query_id, b.n, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
        FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.n <> b.n)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id, n) AS INTEGER) AS rank, vec_id, score
    FROM s QUALIFY rank <= 20
    """,
)
def impact_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest rows of every twentieth vector."""
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)
