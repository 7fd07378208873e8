"""Personal data by fixed patterns, and identifiers that bootstrapped contexts find (op11).

The fixed patterns' finds are seeds. A candidate is a string that could be an identifier: words with a digit or an @, or
several such words in a row. Each occurrence of a candidate stands in up to three lexical patterns: the two words before it, the
word on either side, the two words after it. Patterns and candidates form a graph, an edge for each pair that occurs, however often.

The graph is scored in rounds, for each kind of seed: a pattern by the share of its candidates that are known, as the lower bound of
a confidence interval, so that few candidates prove little; a candidate by the chance that at least one of its good patterns is right.
Candidates of other kinds, and unknown ones, speak against a pattern. Candidates that become known raise the patterns they stand
in, which discover more. Unseen candidates that end with a high score are marked wherever they occur.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linewright.session import materialize

from .common import free_name, query, table, whole
from .secret_scan import joined

# Fixed: the base patterns, in the order in which kinds are listed. Emails are found by their @, from where the name is read backwards.
NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?+[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone", "context")
SEEDS = KINDS[:4]

#: Ends of words that may be (part of) an identifier, and the letters and digits that a candidate has at least.
WORD = re.compile(r"[0-9@]\S*")
LEAST = 6
#: Punctuation that does not belong to a candidate or a context word.
EDGES = ".,;:!?\"'()[]{}<>*#$%&|…»«"
#: Longest candidate that is kept as text; a longer one is known by its digest.
LONGEST = 64
#: Characters on either side of an occurrence that its context words are in; of a longer word the nearest characters count.
REACH = 160

#: A pattern counts from this confidence on, a candidate is known from this score on.
GOOD_PATTERN, KNOWN = 0.6, 0.7
#: Standard deviations of the confidence bound, and most rounds.
Z, ROUNDS = 1.28, 5


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if place % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > end and text[begin - 1] in NAME:
            begin -= 1
        domain = DOMAIN.match(text, at) if begin < at else None
        if domain:
            end = domain.end()
            yield begin, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, leftmost and non-overlapping within a kind."""
    found = [(start, 0, end) for start, end in _emails(text)]
    for m in IP.finditer(text):
        parts = [part.lstrip("0") or "0" for part in m[0].split(".")]
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def _short(word: str) -> str:
    return word if len(word) <= LONGEST else hashlib.sha256(word.encode()).hexdigest()


def _words(parts: list[str]) -> list[str]:
    """In lower case without punctuation at their edges; what is only punctuation is no word."""
    return [w for w in (x.strip(EDGES).lower() for x in parts) if w]


def _before(text: str, start: int) -> list[str]:
    """The two words before a place, `^` for each that is not there."""
    return (["^", "^"] + _words(text[max(0, start - REACH) : start].split()))[-2:]


def _after(text: str, end: int) -> list[str]:
    """The two words after a place, `$` for each that is not there."""
    return (_words(text[end : end + REACH].split()) + ["$", "$"])[:2]


def _runs(text: str) -> list[list[int]]:
    """[start, end] of words with a digit or an @; neighbours that one space parts are one."""
    runs: list[list[int]] = []
    for m in WORD.finditer(text):
        start, last = m.start(), runs[-1][1] if runs else 0
        while start > last and not text[start - 1].isspace():
            start -= 1
        if runs and text[last:start] == " ":
            runs[-1][1] = m.end()
        else:
            runs.append([start, m.end()])
    return runs


def occurrences(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, str, int, list[str]]]:
    """(start, end, candidate, kind number of a seed or -1, patterns) of the text's candidates, seeds included."""
    found = [(start, end, kind) for start, kind, end in base]
    taken: list[list[int]] = []
    for start, _, end in base:
        if taken and start < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([start, end])
    at = 0
    for start, end in _runs(text):
        while start < end and text[start] in EDGES:
            start += 1
        while start < end and text[end - 1] in EDGES:
            end -= 1
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        free = at == len(taken) or taken[at][0] >= end
        if free and sum(map(str.isalnum, text[start:end])) >= LEAST:
            found.append((start, end, -1))
    out = []
    for start, end, kind in found:
        before, after = _before(text, start), _after(text, end)
        patterns = [f"{before[0]} {before[1]} _", f"{before[1]} _ {after[0]}", f"_ {after[0]} {after[1]}"]
        out.append((start, end, _short(text[start:end].lower()), kind, patterns))
    return out


FOUND = (
    "base array<struct<start:int,rank:int,stop:int>>, "
    "seen array<struct<start:int,stop:int,candidate:string,kind:int,patterns:array<string>>>"
)


def _scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    named = lambda names, rows: [dict(zip(names, x, strict=True)) for x in rows]
    for texts in batches:
        base = [base_spans(t) for t in texts]
        seen = [occurrences(t, b) for t, b in zip(texts, base, strict=True)]
        yield pd.DataFrame(
            {
                "base": [named(("start", "rank", "stop"), row) for row in base],
                "seen": [named(("start", "stop", "candidate", "kind", "patterns"), row) for row in seen],
            }
        )


def confidence(known: Column, all_: Column) -> Column:
    """The lower bound of the share of known candidates (Wilson's interval)."""
    share, z2 = known / all_, F.lit(Z * Z)
    spread = F.lit(Z) * F.sqrt(share * (1 - share) / all_ + z2 / (4 * all_ * all_))
    return (share + z2 / (2 * all_) - spread) / (1 + z2 / all_)


def bootstrap(seen: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """From (candidate, kind, patterns) of all occurrences: good patterns (pattern, kind, confidence, known, candidates) and
    discovered candidates (candidate, kind, score). Both written.

    Each round is two joins with partial sums on either side of the graph, so a pattern or a candidate with very many edges is
    summed where its edges are. Rounds end when nothing new is known.
    """
    edges = materialize(seen.select("candidate", F.explode("patterns").alias("pattern")).distinct(), "edges")
    seeds = seen.filter("kind >= 0").groupBy("candidate", "kind").agg(F.lit(1.0).alias("score"))
    seeds = materialize(seeds, "seeds")
    # a pattern of one candidate cannot be good, whatever it is
    size = materialize(edges.groupBy("pattern").agg(F.count("*").alias("candidates")).filter("candidates > 1"), "pattern-sizes")
    known, count, good = seeds, None, None
    for number in range(rounds):
        hits = edges.join(known, "candidate").groupBy("pattern", "kind").agg(F.sum("score").alias("known"))
        scored = hits.join(size, "pattern").withColumn("confidence", confidence(F.col("known"), F.col("candidates")))
        good = materialize(scored.filter(F.col("confidence") >= GOOD_PATTERN), f"patterns-{number}")
        reached = edges.join(good.select("pattern", "kind", "confidence"), "pattern")
        doubt = F.sum(F.log(1 - F.least("confidence", F.lit(1 - 1e-9))))
        now = reached.groupBy("candidate", "kind").agg((1 - F.exp(doubt)).alias("score")).filter(F.col("score") >= KNOWN)
        # a seed has its kind; an unseen candidate takes the kind that speaks loudest for it
        now = now.join(seeds.select("candidate").distinct(), "candidate", "left_anti")
        now = now.groupBy("candidate").agg(F.max(F.struct("score", -F.col("kind"))).alias("m"))
        now = now.select("candidate", (-F.col("m.col2")).cast("int").alias("kind"), F.col("m.score").alias("score"))
        found = materialize(now, f"discovered-{number}")
        before, count = count, found.count()
        if count == (before or 0):
            break
        known = seeds.unionByName(found)
    return good, found


def find_personal(docs: DataFrame, spans: str = "personal", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` (all, if not given) and `spans`: array of (start, rank, kind, stop, like, score) by start, then kind.

    Kinds email, ip, card and phone are the fixed patterns; context are strings that contexts discovered, with the kind of seed that
    they are `like` and their score (1 for fixed patterns). No context span overlaps a fixed one. Offsets are code points, stop
    exclusive. Each text is scanned whole and once, then only occurrences are moved. Null and empty texts have no spans; repeated rows
    have the same spans, and an occurrence counts once in the graph however often it is repeated; an empty table gives no rows.
    Of kinds with the same score the one that is listed first is taken. A column that is named like `spans` already is an error.
    """
    keep = docs.columns if keep is None else keep
    if free_name(keep, spans) != spans:
        raise ValueError(f"there is a column {spans} already")
    found, uid = free_name(docs.columns, "found"), free_name([*docs.columns, spans], "uid")
    scanned = docs.withColumn(found, F.pandas_udf(_scan, FOUND)(whole(text_col)))
    scanned = scanned.select(*[F.col(f"`{c}`") for c in keep], found).withColumn(uid, F.monotonically_increasing_id())
    scanned = materialize(scanned, "scanned")
    seen = scanned.select(F.col(uid).alias("uid"), F.explode(f"{found}.seen").alias("o")).select("uid", "o.*")
    _, discovered = bootstrap(seen.select("candidate", "kind", "patterns"))

    def span(start: Column, rank: Column, stop: Column, like: Column, score: Column) -> Column:
        kind = F.element_at(F.array(*map(F.lit, KINDS)), rank + 1)
        return F.struct(start.alias("start"), rank.alias("rank"), kind.alias("kind"), stop.alias("stop"), like.alias("like"), score.alias("score"))

    name = lambda k: F.element_at(F.array(*map(F.lit, SEEDS)), k + 1)
    more = seen.filter("kind < 0").select("uid", "start", "stop", "candidate").join(discovered, "candidate")
    more = more.select("uid", span(F.col("start"), F.lit(4), F.col("stop"), name(F.col("kind")), F.col("score")).alias("s"))
    own = free_name([*docs.columns, spans, found, uid], "own")
    more = more.groupBy("uid").agg(F.collect_list("s").alias(own)).withColumnRenamed("uid", uid)
    base = F.transform(f"{found}.base", lambda x: span(x["start"], x["rank"], x["stop"], name(x["rank"]), F.lit(1.0)))
    all_spans = F.array_sort(F.when(F.col(own).isNull(), base).otherwise(F.concat(base, own)))
    return scanned.join(more, uid, "left").select(*[F.col(f"`{c}`") for c in keep], all_spans.alias(spans))


@query("op11_bootstrapped_pii")
def bootstrapped_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's personal data."""
    found = find_personal(table(spark, folder, "documents").select("doc_id", "text"), keep=["doc_id"])
    base = F.filter("personal", lambda s: s["rank"] < 4)
    number = lambda rank: F.size(F.filter("personal", lambda s: s["rank"] == rank)).cast("long")
    return found.select(
        "doc_id",
        number(0).alias("n_email"),
        number(1).alias("n_ip"),
        number(2).alias("n_card"),
        number(3).alias("n_phone"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("personal")).alias("spans"),
    )
