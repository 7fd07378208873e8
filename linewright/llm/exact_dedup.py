"""Exact deduplication by deterministic block naming (op5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dropping, materialize, query, table, whole

#: Code points of normalised text in a block.
BLOCK = 4096
#: Rows of one or two numbers up to which a written side is broadcast (at most 32 MB); beyond, Spark joins by shuffle.
BROADCAST_ROWS = 1_000_000


def without_spaces(text: Column) -> Column:
    """The text without the characters [\\x20\\x09-\\x0D]."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), " \t\n\x0b\x0c\r", text)


def small(side: DataFrame) -> DataFrame:
    """A written side for a join: broadcast behind a check of its rows."""
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side


def _named(distinct: DataFrame, *keys: str) -> DataFrame:
    """Sort distinct keys over the cluster and number them: equal keys, and only they, share a name. Written, so names hold.

    Ranges are those of the first key, a number, so no text is sampled; keys that share it are in one range.
    """
    ordered = distinct.repartitionByRange(keys[0]).sortWithinPartitions(*keys)
    return materialize(ordered.withColumn("name", F.monotonically_increasing_id()), "names")


def blocks_of(numbered: DataFrame) -> DataFrame:
    """From (uid, id, text), a row for each block; the first of a document also has what is known of the document. Written once."""
    parts = F.regexp_extract_all("plain", F.lit("(?s).{1,%d}" % BLOCK), F.lit(0))
    each = numbered.select("uid", "id", F.length("text").alias("points"), without_spaces(F.col("text")).alias("plain"))
    each = each.select(
        "uid",
        "id",
        "points",
        F.sha2(F.col("plain").cast("binary"), 256).alias("sha"),
        F.when(F.col("plain") == "", F.array(F.lit(""))).otherwise(parts).alias("parts"),
    )
    first = lambda c: F.when(F.col("pos") == 0, F.col(c)).alias(c)
    exploded = each.select("*", F.size("parts").alias("n"), F.posexplode("parts").alias("pos", "block"))
    kept = exploded.select("uid", "pos", "n", F.xxhash64("block").alias("h"), "block", *map(first, ("id", "points", "sha")))
    return materialize(kept, "blocks")


def name_documents(blocks: DataFrame) -> DataFrame:
    """(uid, level, name) of documents that may have an equal: two have the same level and name only if they are equal.

    Level 0 sorts the distinct blocks and numbers them. A block whose 64-bit hash no other block has needs no name,
    as no other document can have it; its document is equal to no other. Each further level pairs the
    names of neighbours and numbers the distinct pairs the same way (an odd last one is paired with -1), until each
    document is one name. Counts are combined before each shuffle, and a written table of names is joined back, whose
    hot keys adaptive execution splits, so a block that a third of all rows share does not meet in one task.
    """
    again = materialize(blocks.groupBy("h").count().filter("count > 1").select("h"), "repeated")
    repeated = blocks.select("uid", "pos", "n", "h", "block").join(small(again), "h", "left_semi")
    distinct = repeated.groupBy("h", "block").count().filter("count > 1").select("h", "block")
    names = _named(distinct, "h", "block")
    level = repeated.join(names, ["h", "block"]).select("uid", "pos", "n", "name")
    finished = []
    at = 0
    while True:
        finished.append(level.filter("n = 1").select("uid", F.lit(at).alias("level"), "name"))
        more = level.filter("n > 1")
        half = F.expr("pos div 2").cast("int")
        side = lambda odd: F.max(F.when(F.col("pos") % 2 == odd, F.col("name")))
        pairs = more.groupBy("uid", half.alias("half")).agg(F.max("n").alias("n"), side(0).alias("l"), side(1).alias("r"))
        alone = F.col("half") * 2 + 1 == F.col("n")
        pairs = pairs.withColumn("r", F.when(alone, F.lit(-1)).otherwise(F.col("r")))
        # a half without a name occurs once: no other document has this pair
        pairs = pairs.filter("l IS NOT NULL AND r IS NOT NULL")
        pairs = materialize(pairs.select("uid", F.col("half").alias("pos"), F.expr("int((n + 1) div 2)").alias("n"), "l", "r"), "pairs")
        if pairs.isEmpty():
            break
        names = _named(pairs.groupBy("l", "r").count().filter("count > 1").select("l", "r"), "l", "r")
        level = pairs.join(names, ["l", "r"]).select("uid", "pos", "n", "name")
        at += 1
    return reduce(DataFrame.unionByName, finished)


def groups_of(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(uid, keep_uid, keep_id, group_size) of documents that have an equal; and all documents (uid, id, points, sha)."""
    docs = blocks.filter("pos = 0").select("uid", "id", "points", "sha")
    members = name_documents(blocks).join(docs.select("uid", "id", "points"), "uid")
    members = materialize(members, "members")
    order = F.struct(-F.col("points"), F.col("id").isNull(), "id", "uid")
    best = members.groupBy("level", "name").agg(F.min(order).alias("best"), F.count("*").alias("group_size"))
    best = best.select("level", "name", F.col("best.uid").alias("keep_uid"), F.col("best.id").alias("keep_id"), "group_size")
    best = materialize(best, "groups")
    return members.join(best, ["level", "name"]).select("uid", "keep_uid", "keep_id", "group_size"), docs


def find_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256 (of the text without spaces).

    Texts are equal if they are identical without the characters [\\x20\\x09-\\x0D]; null counts as empty, and texts that
    are empty then are equal. Of equal texts the row with the most code points, then the smallest id (null last) stays,
    and of wholly equal rows one. An empty table gives no rows. Other columns are not read.
    """
    numbered = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), whole(text_col).alias("text"))
    found, all_docs = groups_of(blocks_of(numbered))
    return all_docs.join(found, "uid", "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("keep_uid").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("uid") == F.col("keep_uid"), F.lit(True)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; rules as in `find_duplicates`. Tables of blocks and names are deleted."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("uid"), row), "rows", keep=True)
    with dropping(docs.sparkSession):
        found, _ = groups_of(blocks_of(rows.select("uid", F.col("row")[id_col].alias("id"), whole(F.col("row")[text_col]).alias("text"))))
        gone = materialize(found.filter("uid <> keep_uid").select("uid"), "dropped", keep=True)
    return rows.join(small(gone), "uid", "left_anti").select("row.*")


@query(
    "op5_exact_dedup",
    r"""
    WITH d AS (
        SELECT doc_id, length(coalesce(text, '')) AS points,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain
        FROM documents)
    SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY plain) AS group_size,
           row_number() OVER best = 1 AS kept, sha256(plain) AS text_sha256
    FROM d WINDOW best AS (PARTITION BY plain ORDER BY points DESC, doc_id)
    """,
)
def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with the row of their group that stays."""
    return find_duplicates(table(spark, folder, "documents"))
