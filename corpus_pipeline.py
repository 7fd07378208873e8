"""The corpus pipeline: toxic documents go, exact and near copies go, secrets are replaced, the rest is packed.

Each stage takes all that the one before kept, as a written table, and returns a frame. All but the last return the columns of
documents. Every stage handles nulls in any column, empty and very long texts, repeated rows, empty tables and
further columns as its operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewright.llm import exact_dedup, near_dedup, packing, secret_scan, toxicity
from linewright.llm.common import reach, small_batches, table
from linewright.session import materialize

#: Pieces that a packing worker remembers: a third of what it does by itself, as executors still hold what the stages before took.
ROOM = 200_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more for toxicity go (operator 8); the model learns from labelled rows of these documents."""
    reach(spark)
    small_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), toxicity.learn_fold())
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal without white space, one stays (operator 5)."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates, one stays (operator 6)."""
    reach(spark)
    small_batches(spark)
    return near_dedup.drop_near_duplicates(docs)


def replace_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced, and n_chars follows (operator 1)."""
    reach(spark)
    small_batches(spark)
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens (operator 2)."""
    import public_tokenizers

    reach(spark)
    small_batches(spark)
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), room=ROOM)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bin_class")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secrets", replace_secrets),
    ("packing", pack),
]

#: SQL can't fit the classifier, draw the samples or encode; the tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
