"""Toxicity by a classifier that counterfactual pairs regularise (op8).

A linear model over the words of a text and their beginnings (inflected words share these). Where a labelled text
names an identity group, the same text with another group of its kind in that place should score the same, so the
squared change of the score is a penalty beside the loss: a mention alone earns no weight.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewright.session import materialize

from .common import bucket_of, free_name, give_back, make_room, query, table, whole
from .exact_dedup import small

# Identity terms that may stand for each other.
IDENTITY = (
    "women men girls boys".split(),
    "woman man girl boy".split(),
    "muslim christian jewish hindu buddhist atheist".split(),
    "muslims christians jews hindus buddhists atheists".split(),
    "black white asian latino arab african".split(),
    "gay lesbian straight bisexual transgender".split(),
    "immigrants refugees foreigners natives".split(),
    "disabled blind deaf elderly".split(),
)

#: Labelled texts that the model is fitted on, about so many of each class; features of the model; penalties.
PER_CLASS = 6000
FEATURES = 4096
LEAST_TEXTS = 5
#: Likelihood ratio that a feature has to reach (chance alone does in one of 10,000).
LEAST_RATIO = 15.1
RIDGE, FAIRNESS = 2e-5, 1.0
THRESHOLD = 0.7

WORD = re.compile(r"[^\W\d_]+")


#: Words whose features in the model a scoring task remembers.
ROOM = 1 << 16


def features_of(word: str) -> tuple[str, ...]:
    """The word, and its beginnings of four to six letters."""
    return (word, *(f"{word[:n]}*" for n in (4, 5, 6) if len(word) >= n))


def features(words: set[str]) -> set[str]:
    return set().union(*map(features_of, words)) if words else set()


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def swaps(words: set[str]) -> Iterator[tuple[set[str], set[str]]]:
    """(features that go, features that come) when one identity term becomes another of its kind."""
    for group in IDENTITY:
        for term in words.intersection(group):
            rest = features(words - {term})
            for other in group:
                if other != term:
                    yield features({term}) - rest, features({other}) - features(words)


def _labelled(docs: DataFrame, labels: DataFrame, learn, per_class: int, id_col: str, text_col: str) -> DataFrame:
    """(text, label) of about `per_class` rows of each class, chosen by a hash of id and text."""
    by_id = labels.select(F.col(id_col).alias("id"), F.col("toxic").alias("label")).filter("label IN (0, 1) AND id IS NOT NULL")
    by_id = by_id.groupBy("id").agg(F.max("label").cast("int").alias("label"))
    rows = docs.filter(learn).select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    counts = dict(rows.select("id").join(by_id, "id").groupBy("label").count().collect())
    share = F.create_map(F.lit(0), F.lit(per_class / max(1, counts.get(0, 0))), F.lit(1), F.lit(per_class / max(1, counts.get(1, 0))))
    chosen = F.shiftrightunsigned(F.xxhash64("id", F.lit("sample")), 11) * F.lit(2.0**-53) < share[F.col("label")]
    picked = materialize(rows.select("id").distinct().join(by_id.filter(chosen), "id"), "toxicity-ids")
    return rows.join(small(picked), "id").select("text", "label")  # about 2 * per_class ids


def _count_features(sample: DataFrame) -> DataFrame:
    """(feature, toxic, other): texts of each class that have it."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make_room()
        counts = {0: Counter(), 1: Counter()}
        for frame in frames:
            for text, label in zip(frame["text"], frame["label"], strict=True):
                counts[label].update(features(words_of(text)))
        names = list(counts[0].keys() | counts[1].keys())
        for at in range(0, len(names), 50_000):
            part = names[at : at + 50_000]
            yield pd.DataFrame({"feature": part, "toxic": [counts[1][f] for f in part], "other": [counts[0][f] for f in part]})
        del counts, names
        give_back()

    parts = sample.mapInPandas(count, "feature string, toxic long, other long")
    return parts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def fit_weights(texts: list[list[int]], labels: np.ndarray, pairs: list[tuple[list[int], list[int]]], size: int, steps: int = 500) -> np.ndarray:
    """Weights and, last, the bias: logistic loss with classes of equal weight, ridge, and the mean squared score change of `pairs`."""

    def sparse(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.array([i for r in rows for i in r], "i8")

    row, col = sparse(texts)
    out_row, out_col = sparse([a for a, _ in pairs])
    in_row, in_col = sparse([b for _, b in pairs])
    y = np.asarray(labels, "f8")
    weight = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    w, first, second = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        score = np.bincount(row, w[col], len(y)) + w[-1]
        error = weight * (1 / (1 + np.exp(-np.clip(score, -40, 40))) - y)
        slope = np.append(np.bincount(col, error[row], size), error.sum())
        slope[:-1] += 2 * RIDGE * w[:-1]
        if pairs:
            change = np.bincount(out_row, w[out_col], len(pairs)) - np.bincount(in_row, w[in_col], len(pairs))
            change *= 2 * FAIRNESS / len(pairs)
            slope[:-1] += np.bincount(out_col, change[out_row], size) - np.bincount(in_col, change[in_row], size)
        first += 0.1 * (slope - first)
        second += 0.001 * (slope * slope - second)
        w -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w


class Model:
    """Weights by feature; scores whole texts."""

    def __init__(self, weights: dict[str, float], bias: float | None):
        self.weights, self.bias = weights, bias

    def active(self, word: str) -> tuple[str, ...]:
        """The word's features that have a weight."""
        return tuple(f for f in features_of(word) if f in self.weights)

    def score(self, text: str, active=None) -> float:
        """`active`, if given, is `self.active` behind a table of words."""
        if self.bias is None:
            return 0.0
        found = set().union(*map(active or self.active, words_of(text)))
        total = self.bias + math.fsum(sorted(map(self.weights.__getitem__, found)))
        return 1 / (1 + math.exp(-min(40.0, max(-40.0, total))))


def fit(
    docs: DataFrame, labels: DataFrame, learn, per_class: int = PER_CLASS, size: int = FEATURES, id_col: str = "doc_id", text_col: str = "text"
) -> Model:
    """A model from labelled rows for which `learn` holds.

    `labels` has the id and toxic (0 or 1; other values and null ids are left out; one label of 1 makes a text toxic). A sample of about
    `per_class` rows of each class is written and counted over the cluster; the `size` features that tell the classes apart
    best, by their likelihood ratio, make the model. The driver gets these and the sample's indices of them.
    Without rows of both classes the model scores 0 throughout.
    """
    sample = materialize(_labelled(docs, labels, learn, per_class, id_col, text_col), "toxicity-sample")
    totals = dict(sample.groupBy("label").count().collect())
    ones, zeros = totals.get(1, 0), totals.get(0, 0)
    if not ones or not zeros:
        return Model({}, None)
    # likelihood ratio of "the class matters" against "it does not"
    n = ones + zeros
    both = F.col("toxic") + F.col("other")
    cell = lambda seen, share: seen * F.log(F.greatest(seen, F.lit(1e-9)) / (share / n))
    ratio = 2 * (
        cell(F.col("toxic"), both * ones)
        + cell(F.col("other"), both * zeros)
        + cell(ones - F.col("toxic"), (n - both) * ones + 1e-9)
        + cell(zeros - F.col("other"), (n - both) * zeros + 1e-9)
    )
    counted = _count_features(sample).filter(both >= LEAST_TEXTS).select("feature", ratio.alias("ratio")).filter(F.col("ratio") >= LEAST_RATIO)
    best = [r["feature"] for r in counted.orderBy(F.desc("ratio"), "feature").limit(size).collect()]
    index = {f: i for i, f in enumerate(best)}

    def indices(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for text, label in zip(frame["text"], frame["label"], strict=True):
                words = words_of(text)
                in_model = lambda some: sorted(index[f] for f in some if f in index)
                pairs = [(in_model(x), in_model(y)) for x, y in swaps(words)]
                pairs = [(x, y) for x, y in pairs if x or y]
                rows.append((label, in_model(features(words)), [x for x, _ in pairs], [y for _, y in pairs]))
            yield pd.DataFrame(rows, columns=["label", "own", "gone", "come"])

    schema = "label int, own array<int>, gone array<array<int>>, come array<array<int>>"
    rows = sample.mapInPandas(indices, schema).collect()  # 2 * per_class rows of at most `size` numbers
    rows.sort(key=lambda r: (r["label"], r["own"]))
    pairs = [(x, y) for r in rows for x, y in zip(r["gone"], r["come"], strict=True)]
    weights = fit_weights([r["own"] for r in rows], np.array([r["label"] for r in rows]), pairs, len(best))
    return Model(dict(zip(best, weights[:-1].tolist(), strict=True)), float(weights[-1]))


def score(docs: DataFrame, model: Model, column: str = "score", text_col: str = "text") -> DataFrame:
    """All rows and columns, and `column`: the score of the whole text from 0 to 1; null counts as empty.

    Very long texts are read whole, repeated rows get the same score, an empty table gives no rows. A column that is named like
    `column` already is an error.
    """
    if free_name(docs.columns, column) != column:
        raise ValueError(f"there is a column {column} already")

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        make_room()
        active = functools.lru_cache(maxsize=ROOM)(model.active)  # goes with the task
        for texts in batches:
            yield pd.Series([model.score(t, active) for t in texts], dtype="float64")
        del active
        give_back()

    return docs.withColumn(column, run(whole(text_col)))


def learn_fold(id_col: str = "doc_id"):
    """Rows that labels are learned from: crc32 of the id as text, modulo 3, is not 1."""
    return bucket_of(id_col, 3) != 1


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows that score below the threshold, with their columns."""
    name = free_name(docs.columns, "score")
    return score(docs, model, name, text_col).filter(F.col(name) < threshold).drop(name)


@query("op8_counterfactual_toxicity")
def counterfactual_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's score, from the labels of two thirds of the rows."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, folder, "labels"), learn_fold())
    scored = score(docs, model)
    return scored.select("doc_id", (~learn_fold()).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
