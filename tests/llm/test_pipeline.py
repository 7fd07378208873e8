"""The pipeline on a small corpus with planted cases, and on odd rows."""

import random

import corpus_pipeline
import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def write(spark, folder, rows, labels):
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t) if t is not None else None) for i, t in rows], COLUMNS)
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(7)
    folder = str(tmp_path_factory.mktemp("pipeline"))
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(2000)]
    rows, labels = [], []
    for i in range(300):
        text = [rng.choice(words) for _ in range(80)]
        if i % 5 == 0:
            text[10] = "villain"
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(i % 5 == 0)))
    clean = [i for i in range(300) if i % 5]
    rows += [(1000 + i, rows[i][1].replace(" ", "\n")) for i in clean[:20]]  # copies
    near = [(2000 + i, rows[i][1].rsplit(" ", 1)[0] + " changed") for i in clean[20:40]]
    secret = "token = " + "0123456789abcdef" * 3
    rows += near + [(3000, rows[clean[50]][1][::-1] + " " + secret), (4000, None), (4001, ""), (4000, None)]
    write(spark, folder, rows, labels)
    return folder, rows, clean


def stage(spark, folder, until):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, folder)
        if name == until:
            return docs
    return docs


def test_stages_do_what_they_say(spark, planted):
    folder, rows, clean = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, folder)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, t in rows if "villain" not in (t or "")}
    kept = corpus_pipeline.drop_copies(spark, kept, folder)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids) == sorted(set(clean) | {2000 + i for i in clean[20:40]} | {3000, 4000})
    kept = corpus_pipeline.drop_near_copies(spark, kept, folder)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted([*clean, 3000, 4000])
    before = {r["doc_id"]: r for r in kept.collect()}
    kept = corpus_pipeline.replace_secrets(spark, kept, folder)
    assert kept.columns == docs.columns
    after = {r["doc_id"]: r for r in kept.collect()}
    assert after.keys() == before.keys()
    assert {i for i in after if after[i] != before[i]} == {3000}
    assert "0123456789abcdef" not in after[3000]["text"] and after[3000]["n_chars"] == len(after[3000]["text"])
    pieces = corpus_pipeline.pack(spark, kept, folder).collect()
    assert {r["doc_id"] for r in pieces} == after.keys()
    totals = {r["doc_id"]: 0 for r in pieces}
    for r in pieces:
        totals[r["doc_id"]] += r["length"]
    assert all(totals[r["doc_id"]] == r["doc_tokens"] for r in pieces)


def test_run_applies_all_stages(spark, planted):
    folder, _, clean = planted
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()} == {*clean, 3000, 4000}


def test_an_empty_table_and_further_columns(spark, tmp_path):
    folder = str(tmp_path)
    write(spark, folder, [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0
    rows = [(None, None, None, "a", 1), (1, "some words here and there, five", "x", "b", 2), (1, "some words here and there, five", "x", "b", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, uid string, block string, score int")
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "uid", "block", "score"], name
    assert docs.count() == 2


def test_stages_of_texts_exchange_small_batches(spark, planted):
    import pyarrow as pa

    from linewright.llm.common import BATCH_ROWS, BATCH_SETTING, small_batches

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows])], names=["n"])

    folder, _, _ = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = spark.conf.get(BATCH_SETTING)
    try:
        for name, function in corpus_pipeline.STAGES:
            if name == "exact_dedup":  # no Python workers
                continue
            spark.conf.set(BATCH_SETTING, 10_000)
            function(spark, docs, folder)
            found = [r["n"] for r in spark.range(2 * BATCH_ROWS + 1).coalesce(1).mapInArrow(sizes, "n long").collect()]
            assert sum(found) == 2 * BATCH_ROWS + 1 and max(found) <= BATCH_ROWS, name
        spark.conf.set(BATCH_SETTING, 5)
        small_batches(spark)
        assert spark.conf.get(BATCH_SETTING) == "5"  # a smaller limit stays
    finally:
        spark.conf.set(BATCH_SETTING, before)
