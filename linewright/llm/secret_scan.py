"""Secrets in texts: fixed patterns, and strings that pass a battery of randomness tests (op1).

A candidate is a long run of token characters with letters and digits. Its encoding is the smallest alphabet that holds it.
Under the hypothesis that its symbols are drawn evenly from that alphabet, three tests give p-values: chi-squared
over the alphabet, the number of runs above and below the middle, and the correlation of neighbours. Fisher's method
combines them. Random strings have p-values spread evenly over 0 to 1, written words pile up near 0. So in each
stratum of encoding and length, the even part's height gives how many distinct candidates are random, and the threshold is
the lowest p-value above which at most `rate` of the distinct strings that are called secret are not random.
A stratum with too few strings for this has a fixed threshold, unless its own strings speak against it.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linewright.session import materialize

from .common import free_name, give_back, make_room, query, table, whole

# Fixed: the base patterns, in the order in which kinds are listed.
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")
REPLACEMENT = "[secret]"

#: Shortest candidate.
SHORTEST = 20
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}={0,2}" % SHORTEST)

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets, smaller before larger.
ALPHABETS = {
    "hex": _DIGITS + _LOWER[:6],
    "HEX": _DIGITS + _UPPER[:6],
    "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER,
    "BASE36": _DIGITS + _UPPER,
    "base62": _UPPER + _LOWER + _DIGITS,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
_VALUES = {name: {c: i for i, c in enumerate(letters)} for name, letters in ALPHABETS.items()}

#: Upper edges of the p-value bins that thresholds are taken from.
EDGES = [10.0**-k for k in range(8, 2, -1)] + [0.01] + [k / 64 for k in range(1, 65)]

#: With fewer distinct strings above one half, the even part's height is not estimated but bounded; the threshold is then this at least.
ENOUGH, LEAST_P = 30, 0.01


def encoding_of(symbols: str) -> str | None:
    """The smallest alphabet that holds all symbols; None if there is none, or no letter, or no digit."""
    if symbols.isalpha() or not (used := set(symbols)) & set(_DIGITS) or symbols.isdigit():
        return None
    return next((name for name, values in _VALUES.items() if used <= values.keys()), None)


def _both_tails(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(symbols: str, encoding: str) -> tuple[float, float, float]:
    """p-values of chi-squared, runs and serial correlation under even and independent symbols."""
    values = [_VALUES[encoding][c] for c in symbols]
    n, size = len(values), len(ALPHABETS[encoding])
    counts: dict[int, int] = defaultdict(int)
    for v in values:
        counts[v] += 1
    chi = sum(c * c for c in counts.values()) * size / n - n
    # the statistic's own mean and variance for few symbols, as a gamma variable by its cube root
    mean, variance = size - 1, 2 * (size - 1) * (1 - 1 / n)
    shape = mean * mean / variance
    z = ((max(chi, 0.0) / mean) ** (1 / 3) - (1 - 1 / (9 * shape))) * math.sqrt(9 * shape)
    uniform = math.erfc(z / math.sqrt(2)) / 2
    high = [v >= size // 2 for v in values]
    runs = 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
    run = _both_tails((runs - 1 - (n - 1) / 2) / math.sqrt((n - 1) / 4))
    middle, spread = (size - 1) / 2, (size * size - 1) / 12
    serial = sum((a - middle) * (b - middle) for a, b in zip(values, values[1:], strict=False)) / spread
    return uniform, run, _both_tails(serial / math.sqrt(n - 1))


def combined(pvalues: tuple[float, ...]) -> float:
    """Fisher's method: the chance of a product this small."""
    half = -sum(math.log(max(p, 1e-300)) for p in pvalues)
    return math.exp(-half) * sum(half**k / math.factorial(k) for k in range(len(pvalues)))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, leftmost and non-overlapping within a kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def hash_of(symbols: str) -> int:
    """64 bits that are the same in all workers."""
    return int.from_bytes(hashlib.blake2b(symbols.encode(), digest_size=8).digest(), "big", signed=True)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, str, float, bool, int]]:
    """(start, end, stratum, p-value, whether a base span holds it, hash) of strings that can be tested."""
    out = []
    for m in CANDIDATE.finditer(text):
        symbols = m[0].rstrip("=")
        if (encoding := encoding_of(symbols)) is not None:
            inside = any(s <= m.start() and m.end() <= e for s, _, e in base)
            stratum = f"{encoding}:{len(symbols).bit_length()}"
            out.append((m.start(), m.end(), stratum, combined(battery(symbols, encoding)), inside, hash_of(symbols)))
    return out


FOUND = (
    "base array<struct<start:int,rank:int,stop:int>>, "
    "tested array<struct<start:int,stop:int,stratum:string,p:double,inside:boolean,hash:long>>"
)


def _scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    named = lambda names, rows: [dict(zip(names, x, strict=True)) for x in rows]
    make_room()
    for texts in batches:
        base = [base_spans(t) for t in texts]
        tested = [candidates(t, b) for t, b in zip(texts, base, strict=True)]
        yield pd.DataFrame(
            {
                "base": [named(("start", "rank", "stop"), row) for row in base],
                "tested": [named(("start", "stop", "stratum", "p", "inside", "hash"), row) for row in tested],
            }
        )
    give_back()


def thresholds(counts: dict[str, dict[int, int]], rate: float) -> dict[str, float]:
    """Each stratum's lowest p-value edge above which at most `rate` of the strings are not random.

    Above one half nearly all are random, which gives their number; a stratum without any there has no threshold.
    """
    out = {}
    for stratum, bins in counts.items():
        random = 2 * sum(n for at, n in bins.items() if at > 0 and EDGES[at - 1] >= 0.5)
        claimed = 0
        for at in range(len(EDGES) - 1, -1, -1):
            claimed += bins.get(at, 0)
            low = EDGES[at - 1] if at else 0.0
            if random and claimed and claimed - random * (1 - low) <= rate * claimed:
                out[stratum] = low
    return out


def most_random(above: int) -> int:
    """The least number of random strings of which `above` or fewer are above one half with a chance of 1 in 20 at most."""
    n = above
    while sum(math.comb(n, k) for k in range(above + 1)) > 0.05 * 2**n:
        n += 1
    return n


def all_thresholds(counts: dict[str, dict[int, int]], rate: float) -> dict[str, float]:
    """A threshold for every stratum: that of `thresholds` where many strings are above one half.

    Elsewhere chance decides how many are above, none with a lone key half of the time. There the number of random strings is
    taken as high as chance allows, so LEAST_P is the threshold unless more strings pass than that.
    """
    above = {stratum: sum(n for at, n in bins.items() if at > 0 and EDGES[at - 1] >= 0.5) for stratum, bins in counts.items()}
    out = thresholds({stratum: bins for stratum, bins in counts.items() if above[stratum] >= ENOUGH}, rate)
    for stratum, bins in counts.items():
        if above[stratum] >= ENOUGH:
            continue
        random, claimed = most_random(above[stratum]), 0
        for at in range(len(EDGES) - 1, EDGES.index(LEAST_P), -1):
            claimed += bins.get(at, 0)
            if claimed - random * (1 - EDGES[at - 1]) <= rate * claimed:
                out[stratum] = EDGES[at - 1]
    return out


def find_secrets(
    docs: DataFrame, spans: str = "secrets", text_col: str = "text", keep: list[str] | None = None, rate: float = 0.05
) -> DataFrame:
    """Columns `keep` (all, if not given) and `spans`: array of (start, rank, kind, stop) by start, then kind.

    Kinds assign, access and hex are the base patterns; random are strings that the tests call random and no base
    span holds. Offsets are code points, stop exclusive. Each text is scanned whole and once; what was found is written,
    the p-values of all distinct candidates of the corpus are counted by stratum (a few thousand counts at most), and the
    thresholds select among all occurrences. Null and empty texts have no spans; a string counts once, however often it
    occurs; an empty table gives no rows. A column that is named like `spans` already is an error; other columns are kept as they are.
    """
    keep = docs.columns if keep is None else keep
    if free_name(keep, spans) != spans:
        raise ValueError(f"there is a column {spans} already")
    found = free_name(docs.columns, "found")
    scanned = docs.withColumn(found, F.pandas_udf(_scan, FOUND)(whole(text_col))).select(*[F.col(f"`{c}`") for c in keep], found)
    scanned = materialize(scanned, "scanned")
    each = scanned.select(F.explode(f"{found}.tested").alias("c")).select("c.stratum", "c.hash", "c.p").distinct()
    bin_of = F.size(F.filter(F.array(*map(F.lit, EDGES)), lambda e: e < F.col("p")))
    rows = each.groupBy("stratum", bin_of.alias("bin")).count().collect()  # at most 8 x 32 x 71 counts
    counts: dict[str, dict[int, int]] = defaultdict(dict)
    for r in rows:
        counts[r["stratum"]][min(r["bin"], len(EDGES) - 1)] = r["count"]
    limit = all_thresholds(counts, rate)
    table_of = F.create_map(*[F.lit(x) for pair in sorted(limit.items()) for x in pair]) if limit else None

    def span(start: Column, rank: Column, stop: Column) -> Column:
        kind = F.element_at(F.array(*map(F.lit, KINDS)), rank + 1)
        return F.struct(start.alias("start"), rank.alias("rank"), kind.alias("kind"), stop.alias("stop"))

    base = F.transform(f"{found}.base", lambda x: span(x["start"], x["rank"], x["stop"]))
    if table_of is not None:
        passed = F.filter(f"{found}.tested", lambda x: ~x["inside"] & (x["p"] > F.element_at(table_of, x["stratum"])))
        more = F.transform(passed, lambda x: span(x["start"], F.lit(3), x["stop"]))
        base = F.array_sort(F.concat(base, more))
    return scanned.withColumn(spans, base).drop(found)


def joined(spans: Column) -> Column:
    """kind:start:stop, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", rate: float = 0.05) -> DataFrame:
    """All rows and columns, each secret replaced by REPLACEMENT; `length_col`, if there, follows the changed texts.

    Spans that touch or overlap are replaced as one. Texts without secrets, null and empty ones stay as they are.
    """
    spans, merged = free_name(docs.columns, "secrets"), free_name(docs.columns, "merged")
    found = find_secrets(docs, spans, text_col, rate=rate)
    none = F.array().cast("array<struct<start:int,stop:int>>")

    def merge(a: Column, s: Column) -> Column:
        last = F.element_at(a, -1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop"))
        own = F.array(F.struct(s["start"].alias("start"), s["stop"].alias("stop")))
        return F.when((F.size(a) > 0) & (F.try_element_at(a, F.lit(-1))["stop"] >= s["start"]), F.concat(F.slice(a, 1, F.size(a) - 1), F.array(wider))).otherwise(F.concat(a, own))

    def cut(text: Column, s: Column) -> Column:
        return F.concat(F.substring(text, F.lit(1), s["start"]), F.lit(REPLACEMENT), F.substring(text, s["stop"] + 1, F.length(text)))

    some = F.size(spans) > 0
    found = found.withColumn(merged, F.when(some, F.reverse(F.aggregate(spans, none, merge))))
    text = F.when(some, F.aggregate(merged, F.col(text_col), cut)).otherwise(F.col(text_col))
    out = found.withColumn(text_col, text)
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.when(some, F.length(text_col).cast(kind)).otherwise(F.col(length_col)))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


@query("op1_secret_scan")
def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's secrets."""
    found = find_secrets(table(spark, folder, "documents").select("doc_id", "text"), keep=["doc_id"])
    base = F.filter("secrets", lambda s: s["rank"] < 3)
    number = lambda rank: F.size(F.filter("secrets", lambda s: s["rank"] == rank)).cast("long")
    return found.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )
