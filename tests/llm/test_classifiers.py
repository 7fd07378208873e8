"""Toxicity and language: held-out accuracy, the regulariser's effect, and odd rows."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linewright.llm import language, toxicity

EVERY = "true"


def toxic_corpus(seed=1, size=900):
    rng = random.Random(seed)
    words = [f"wor{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows, labels = [], []
    for i in range(size):
        text = [rng.choice(words) for _ in range(40)]
        toxic = rng.random() < 0.3
        if toxic:
            text[3] = rng.choice(["grobianus", "grobianer", "grobiante", "nastyone"])
        if rng.random() < (0.5 if toxic else 0.1):  # the group is named more often in toxic texts
            text[7] = "muslims"
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = toxic_corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    return toxicity.fit(docs, marks, toxicity.learn_fold()), rows, labels


def test_held_out_texts_are_told_apart(fitted):
    model, rows, labels = fitted
    held = [i for i in range(len(rows)) if zlib.crc32(str(i).encode()) % 3 == 1]
    right = sum((model.score(rows[i][1]) >= 0.7) == bool(labels[i][1]) for i in held)
    assert right >= 0.97 * len(held)


def test_a_neutral_mention_does_not_count(spark, fitted, monkeypatch):
    rows, labels = toxic_corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "FAIRNESS", 0.0)
    without = toxicity.fit(docs, marks, toxicity.learn_fold())
    text = rows[next(i for i, t in labels if not t and "muslims" not in rows[i][1])][1]
    change = lambda m: abs(m.score(text + " muslims") - m.score(text + " hindus"))
    assert change(fitted[0]) < 0.25 * change(without)


def test_scores_of_odd_rows(docs_of, odd_rows, fitted):
    docs = docs_of(odd_rows).withColumn("found", F.lit(1))
    rows = toxicity.score(docs, fitted[0]).collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter(odd_rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if not (r["text"] or "").strip()}
    assert len(empty) == 1
    kept = toxicity.drop_toxic(docs.withColumnRenamed("found", "score"), fitted[0])
    assert kept.columns == ["doc_id", "text", "score"]
    with pytest.raises(ValueError):
        toxicity.score(docs.withColumnRenamed("found", "Score"), fitted[0])


def test_labels_with_nulls_repeats_and_none_at_all(spark, docs_of, odd_rows):
    docs = docs_of(odd_rows)
    marks = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0), (4, 5), (99, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, marks, EVERY)
    assert 0 <= model.score("any text") <= 1
    none = toxicity.fit(docs, marks.limit(0), EVERY)
    assert none.score("any text") == 0.0
    assert toxicity.score(docs_of([]), none).count() == 0


def test_swaps_change_only_the_term():
    words = {"muslim", "people", "live"}
    pairs = list(toxicity.swaps(words))
    assert len(pairs) == 5
    gone, come = pairs[0]
    assert "muslim" in gone and "christian" in come and not gone & toxicity.features({"people", "live"})
    assert list(toxicity.swaps({"nobody"})) == []


SYLLABLES = {"en": "the ing and tion her".split(), "de": "ung sch ein lich der".split(), "fr": "eau ment oi que le".split(), "es": "ado ción que los ez".split()}


def language_rows(seed=1, size=400):
    rng = random.Random(seed)
    rows = []
    for i in range(size):
        lang = rng.choice(sorted(SYLLABLES))
        text = " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(8, 80)))
        rows.append((i, text.upper() if i % 9 == 0 else text, lang if i % 11 else None))
    return rows


def test_languages_of_held_out_texts(spark):
    rows = language_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, language.learned_fold(), per_language=60)
    assert sorted(model.families) == ["germanic", "romance"] and len(model.machines) == 4
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[2]]
    assert sum(model.predict(t)[0] == lang for _, t, lang in held) >= 0.98 * len(held)


def test_languages_of_odd_rows(spark, docs_of, odd_rows):
    model = language.fit(spark.createDataFrame(language_rows(), "doc_id long, text string, lang string"), EVERY, per_language=30)
    docs = docs_of([*odd_rows, (8, "123 !!! 4")]).withColumn("found", F.lit(1))
    rows = language.predict(docs, model).collect()
    assert len(rows) == len(odd_rows) + 1
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
    assert language.predict(docs_of([]), model).count() == 0


def test_language_without_rows_or_with_one_language(spark, docs_of):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language.fit(empty, EVERY).predict("some text") == ("und", 0.0)
    one = spark.createDataFrame([(i, f"text {i}", "xx") for i in range(20)], "doc_id long, text string, lang string")
    assert language.fit(one, EVERY).predict("some text") == ("xx", 1.0)


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = "wörter und 12 ausdrücke -- in einem langen Text " * 50
    whole = language.counts_of(text)
    monkeypatch.setattr(language, "CHUNK", 97)
    assert np.array_equal(whole, language.counts_of(text))


def test_language_query_on_the_table(spark):
    from linewright.llm.common import QUERIES

    folder = "/root/testdata/sf0.01"
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in QUERIES["op10_language_id"](spark, folder).collect() if r["held_out"] and langs[r["doc_id"]]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in rows) >= 0.97 * len(rows)


def test_toxicity_query_on_the_table(spark):
    from linewright.llm.common import QUERIES

    folder = "/root/testdata/sf0.1"
    marks = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op8_counterfactual_toxicity"](spark, folder).collect() if r["held_out"] and r["doc_id"] in marks]
    found = Counter((marks[r["doc_id"]], r["predicted"]) for r in rows)
    assert found[1, 1] >= 0.85 * (found[1, 1] + found[1, 0])
    assert found[0, 1] <= 0.02 * (found[0, 0] + found[0, 1])


def test_scores_behind_a_table_of_words_are_the_same():
    """A scoring task remembers words in a table of its own, and none is left in the worker."""
    import functools

    from linewright.llm import toxicity

    model = toxicity.Model({"stupid": 2.0, "stup*": 1.5, "nice*": -1.0}, -0.5)
    active = functools.lru_cache(maxsize=2)(model.active)
    for text in ["You stupid, stupider one", "", "nicely said, nice", "nothing of it"]:
        assert model.score(text, active) == model.score(text)
    assert abs(model.score("stupid") - 1 / (1 + 2.718281828459045**-3.0)) < 1e-12
    assert not hasattr(toxicity.features_of, "cache_info")
