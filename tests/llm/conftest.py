import pytest

from linewright.llm.common import reach


@pytest.fixture(autouse=True)
def workers_reach_the_package(spark):
    reach(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from texts or (doc_id, text, ...) rows, in several partitions."""

    def make(rows, schema="doc_id long, text string", parts=3):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame(rows, schema).repartition(parts) if rows else spark.createDataFrame([], schema)

    return make


#: Nulls, empty and blank texts, repeated rows and ids, a very long text, no spaces, odd characters.
@pytest.fixture(scope="session")
def odd_rows():
    long = " ".join(f"word{i % 977} of" for i in range(60_000))
    return [
        (1, "the quick brown fox jumps over the lazy dog"),
        (1, "the quick brown fox jumps over the lazy dog"),
        (2, None),
        (3, ""),
        (4, " \t\r\n\x0b\x0c "),
        (None, "no id has this text, but it is a text"),
        (5, long),
        (6, "x" * 30_000),
        (7, "É日本 ﬁ​ \x85 \U0001f600 a\x00b <|endoftext|> İ"),
        (1, "another text with an id that is used already"),
    ]
