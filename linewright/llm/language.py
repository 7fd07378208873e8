"""Language by hierarchical discrimination (op10).

The family first, by one linear support vector machine for each family; then, within it, one machine for each pair of its
languages, whose votes decide. All read the same hashed byte n-grams, and all are fitted by Spark tasks, one for each machine.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linewright.session import materialize

from .common import bucket_of, free_name, query, table

# Families of languages by their codes; a code that is not here is a family of its own.
FAMILIES = {
    "germanic": "en de nl af sv da no nb nn is fy lb".split(),
    "romance": "fr es it pt ro ca gl oc".split(),
    "slavic": "ru uk be pl cs sk bg mk sr hr bs sl".split(),
    "baltic": "lt lv".split(),
    "uralic": "fi et hu".split(),
    "celtic": "ga gd cy br".split(),
    "semitic": "ar he mt am".split(),
    "turkic": "tr az kk uz ky".split(),
    "indic": "hi ur bn pa mr gu ne".split(),
    "dravidian": "ta te kn ml".split(),
}

#: Labelled texts of each language that the machines are fitted on, about; hashed n-grams; n-gram lengths.
PER_LANGUAGE = 800
SIZE = 1 << 12
LONGEST = 3
#: Bytes of a text that are counted at a time.
CHUNK = 1 << 20
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
#: Bytes of a word stay, others become a space.
_KEPT = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], "u1")
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], "u4")


def family_of(language: str) -> str:
    return next((name for name, codes in FAMILIES.items() if language in codes), f"={language}")


def counts_of(text: str) -> np.ndarray:
    """Counts of the hashed byte n-grams of the whole lower-cased text, runs of other bytes as one space."""
    data = text.lower().encode()
    counts = np.zeros(SIZE)
    tail = np.array([32], "u1")
    for at in range(0, max(1, len(data)), CHUNK):
        part = _KEPT[np.frombuffer(data[at : at + CHUNK], "u1")]
        part = np.concatenate([tail, part, [32] if at + CHUNK >= len(data) else []]).astype("u1")
        part = part[np.append(True, (part[1:] != 32) | (part[:-1] != 32))]
        for n in range(1, LONGEST + 1):
            if len(part) >= n:
                code = np.full(len(part) - n + 1, n * 0x27D4EB2F & 0xFFFFFFFF, "u4")
                for k in range(n):
                    code = (code ^ part[k : len(part) - n + 1 + k]) * _FACTORS[k]
                    code ^= code >> np.uint32(15)
                # n-grams that lie in the kept tail were counted with the chunk before
                fresh = code if at == 0 else code[max(0, len(tail) - n + 1) :]
                counts += np.bincount(fresh >> np.uint32(20), minlength=SIZE)
        tail = part[-(LONGEST - 1) :]
    return counts


def vector_of(text: str) -> np.ndarray:
    """Square roots of the counts, of length one."""
    roots = np.sqrt(counts_of(text))
    return roots / max(1e-12, math.sqrt(float(roots @ roots)))


def fit_machine(x: np.ndarray, y: np.ndarray, cost: float = 10.0, steps: int = 200) -> np.ndarray:
    """Weights and, last, the bias of a linear support vector machine (squared hinge loss, classes of equal weight); y is 1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1))])
    share = cost * np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    step = 1 / (1e-2 + 2 * cost * float((x * x).sum(1).max()))
    w = ahead = np.zeros(x.shape[1])
    pace = 1.0
    for _ in range(steps):  # accelerated gradient
        slack = np.maximum(0, 1 - y * (x @ ahead))
        slope = 1e-2 * ahead - 2 * x.T @ (share * slack * y)
        new = ahead - step * slope
        faster = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        ahead, w, pace = new + (pace - 1) / faster * (new - w), new, faster
    return w


class Model:
    """Machines by family, and by pair of languages of a family."""

    def __init__(self, languages: list[str], machines: dict[str, np.ndarray]):
        self.languages, self.machines = sorted(languages), machines
        self.families: dict[str, list[str]] = {}
        for code in self.languages:
            self.families.setdefault(family_of(code), []).append(code)

    def tasks(self) -> dict[str, dict[str, int]]:
        """Each machine's classes: language -> 1 or -1."""
        out = {}
        if len(self.families) > 1:
            for name, codes in self.families.items():
                out[name] = {c: 1 if c in codes else -1 for c in self.languages}
        for codes in self.families.values():
            for a, b in combinations(codes, 2):
                out[f"{a}|{b}"] = {a: 1, b: -1}
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not _LETTER.search(text) or not self.languages:
            return UNKNOWN, 0.0
        x = np.append(vector_of(text), 1.0)
        margin = lambda name: float(self.machines[name] @ x)
        sure = lambda z: 1 / (1 + math.exp(-max(-40.0, min(40.0, 2 * z))))
        if len(self.families) > 1:
            margins = {name: margin(name) for name in self.families}
            family = max(margins, key=lambda n: (margins[n], n))
            score = sure(margins[family])
        else:
            family, score = next(iter(self.families)), 1.0
        codes = self.families[family]
        votes = dict.fromkeys(codes, 0)
        sums = dict.fromkeys(codes, 0.0)
        for a, b in combinations(codes, 2):
            m = margin(f"{a}|{b}")
            votes[a if m >= 0 else b] += 1
            sums[a] += m
            sums[b] -= m
        best = max(codes, key=lambda c: (votes[c], sums[c], c))
        return best, score * (sure(sums[best] / (len(codes) - 1)) if len(codes) > 1 else 1.0)


def fit(docs: DataFrame, learn, per_language: int = PER_LANGUAGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from rows with a language for which `learn` holds.

    About `per_language` rows of each language, chosen by a hash of the id, are written; each machine is a group of these rows, fitted
    in one task. The driver gets the languages with their counts, and the weights. Rows without text or letter teach nothing.
    """
    rows = docs.filter(learn).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull())
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return Model([], {})
    share = F.create_map(*[F.lit(v) for lang, n in sorted(counts.items()) for v in (lang, per_language / n)])
    chosen = F.shiftrightunsigned(F.xxhash64("id", F.lit("sample")), 11) * F.lit(2.0**-53) < share[F.col("lang")]
    sample = materialize(rows.filter(chosen & F.col("text").rlike(r"\p{L}")).select("id", "text", "lang"), "language-sample")
    languages = [r["lang"] for r in sample.select("lang").distinct().collect()]
    model = Model(languages, {})
    tasks = model.tasks()
    if not tasks:
        return model
    classes = [(name, lang, side) for name, sides in tasks.items() for lang, side in sides.items()]
    wanted = F.create_map(
        *[v for lang in languages for v in (F.lit(lang), F.array(*[F.struct(F.lit(n).alias("task"), F.lit(s).alias("side")) for n, x, s in classes if x == lang]))]
    )
    dealt = sample.select("id", "text", F.explode(wanted[F.col("lang")]).alias("to")).select("id", "text", "to.task", "to.side")

    def train(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["side", "id"])
        x = np.array([vector_of(t) for t in part["text"]], "f8")
        w = fit_machine(x, part["side"].to_numpy("f8"))
        return pd.DataFrame({"task": [part["task"].iloc[0]], "w": [w.astype("<f8").tobytes()]})

    fitted = dealt.groupBy("task").applyInPandas(train, "task string, w binary").collect()  # a row for each machine
    model.machines = {r["task"]: np.frombuffer(r["w"], "<f8") for r in fitted}
    return model


def predict(docs: DataFrame, model: Model, column: str = "lang_pred", score: str = "score", text_col: str = "text") -> DataFrame:
    """All rows and columns, the predicted language of the whole text and a score from 0 to 1.

    Texts that are null or have no letter are `und` with score 0, and so is everything if nothing could be learned. Very long
    texts are read whole. Of equal margins or votes the later name in the alphabet is taken, so repeated rows get the same language
    and score; an empty table gives no rows. A column that is named like `column` or `score` already is an error.
    """
    if free_name([*docs.columns, score], column) != column or free_name(docs.columns, score) != score:
        raise ValueError(f"there is a column {column} or {score} already")
    held = free_name(docs.columns, "found")

    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([model.predict(t) for t in texts], columns=["lang", "score"]).astype({"score": "float64"})

    found = docs.withColumn(held, run(F.col(text_col)))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(f"{held}.lang").alias(column), F.col(f"{held}.score").alias(score))


def learned_fold(id_col: str = "doc_id") -> Column:
    """Rows that are learned from: crc32 of the id as text, modulo 5, is not 0."""
    return bucket_of(id_col, 5) != 0


@query("op10_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's language, from four fifths of the rows."""
    docs = table(spark, folder, "documents")
    model = fit(docs, learned_fold())
    found = predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (~learned_fold()).alias("held_out"), "lang_pred", "score")
