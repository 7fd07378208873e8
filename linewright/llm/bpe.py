"""Byte-level BPE as a streaming transducer, and its inverse (op3).

The last token of every prefix of a word follows from the last tokens of shorter prefixes: a token may follow
another if merging the two never crosses their border. So one pass over the bytes keeps, for each position, the
last token that ends there, and only positions within the longest token's reach matter for what comes. A token is
emitted once all those positions lead back to it. How far that lags behind is bounded by the merge list.
"""

from __future__ import annotations

import codecs
import functools
import json
from collections.abc import Iterable, Iterator
from itertools import islice

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, query, table, whole

#: Fixed: the byte-level word pattern of the vocabulary.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

#: Bytes of a word given to the transducer at a time.
BLOCK = 1024
#: Words that the table of known words holds before its older half is forgotten; the table of borders holds twice as many.
ROOM = 1 << 18


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Tokens as bytes, and the merge list, of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        model, byte_of = layout["model"], {c: b for b, c in enumerate(byte_letters())}
        if model["type"] != "BPE" or layout["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"{path} is no byte-level BPE")
        as_bytes = lambda s: bytes(byte_of[c] for c in s)
        self.id_of = {as_bytes(s): i for s, i in model["vocab"].items()}
        self.bytes_of = {i: b for b, i in self.id_of.items()}
        self.added = {x["content"]: x["id"] for x in layout["added_tokens"]}
        for content, i in self.added.items():
            own = all(c in byte_of for c in content)
            self.bytes_of[i] = as_bytes(content) if own else content.encode()
        #: rank of the merge of two tokens; and of each token the rank that made it and its halves
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = (self.id_of[as_bytes(x)] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.rank[left, right] = rank
            self.made.setdefault(self.id_of[self.bytes_of[left] + self.bytes_of[right]], (rank, left, right))
        # tokens that their own bytes give; the others never come out
        self.live = {b: i for b, i in self.id_of.items() if len(b) == 1 or i in self.made and not self.crosses(*self.made[i][1:], self.made[i][0])}
        self.longest = max(map(len, self.live))
        #: the token of every live token's bytes, and None for what only begins one
        self.begins = dict.fromkeys(b[:n] for b in self.live for n in range(1, len(b) + 1)) | self.live

    def crosses(self, left: int, right: int, before: int | None = None) -> bool:
        """Whether a merge, of a rank below `before` if given, goes over the border of two neighbouring tokens.

        Goes back in time: each step undoes the later of the two merges that made the tokens at the border.
        """
        until_left = until_right = len(self.rank) if before is None else before
        while True:
            rank = self.rank.get((left, right))
            # of equal ranks, the merge further left comes first
            if rank is not None and rank < until_left and (rank <= until_right if before is None else rank < until_right):
                return True
            a, b = self.made.get(left), self.made.get(right)
            if a is None and b is None:
                return False
            if b is None or (a is not None and a[0] > b[0]):
                until_left, left = a[0], a[2]
            else:
                until_right, right = b[0], b[1]

    @functools.cached_property
    def lookahead(self) -> int:
        """Bytes behind a border after which nothing that follows can change whether the border stays.

        Whether a merge happens depends on its right half, and on merges of lower rank that take a part of
        either half first. reach[r] is how far right of its border merge r depends; ranks fall along each chain of
        such merges, so one pass in order of rank finds the bound. It holds for each merge that begins or ends with
        one of the parts (`starts`, `stops`).
        """
        parts: dict[int, list[tuple[int, int, int]]] = {}

        def inside(token: int) -> list[tuple[int, int, int]]:
            """(part, its begin, its end) of all parts of a token."""
            if token not in parts:
                size = len(self.bytes_of[token])
                parts[token] = [(token, 0, size)]
                if token in self.made:
                    _, left, right = self.made[token]
                    shift = len(self.bytes_of[left])
                    parts[token] = [(token, 0, size), *inside(left), *((p, b + shift, e + shift) for p, b, e in inside(right))]
            return parts[token]

        starts: dict[int, int] = {}
        stops: dict[int, int] = {}
        most = 1
        for left, right in self.rank:
            size = len(self.bytes_of[left])
            reach = len(self.bytes_of[right])
            for token, shift in ((left, -size), (right, 0)):
                for part, begin, end in inside(token):
                    if part in starts:
                        reach = max(reach, shift + end + starts[part])
                    if part in stops:
                        reach = max(reach, shift + begin + stops[part])
            starts[left] = max(starts.get(left, 0), reach)
            stops[right] = max(stops.get(right, 0), reach)
            most = max(most, reach)
        return most


class Transducer:
    """Bytes of one word in, tokens out as soon as they are stable; memory follows the vocabulary's lookahead."""

    def __init__(self, vocabulary: Vocabulary, borders: dict[int | None, dict[int, bool]]):
        self.v, self.borders = vocabulary, borders
        self.text = b""  # from the last stable border on
        self.last: list[int | None] = [None]  # the last token of each prefix of it
        self.prior: int | None = None  # the token before it
        self.done = 0  # prefixes whose continuations are known
        self.lag = 0  # the longest that was held

    def _extend(self, final: bool) -> None:
        text, last, begins, borders, crosses = self.text, self.last, self.v.begins, self.borders, self.v.crosses
        size = len(text)
        last.extend([None] * (size + 1 - len(last)))
        stop = size if final else max(self.done, size - self.v.longest + 1)
        for start in range(self.done, stop):
            before = last[start] if start else self.prior
            row = borders.get(before)
            if row is None:
                row = borders[before] = {}
            for end in range(start + 1, size + 1):
                token = begins.get(text[start:end], -1)
                if token is None:
                    continue
                if token == -1:
                    break
                crossing = row.get(token)
                if crossing is None:
                    crossing = row[token] = before is not None and crosses(before, token)
                if not crossing:
                    last[end] = token
        self.done = stop

    def _back(self, position: int) -> int:
        return position - len(self.v.bytes_of[self.last[position]])

    def push(self, block: bytes) -> list[int]:
        """The tokens that are stable now."""
        self.text += block
        self.lag = max(self.lag, len(self.text))
        self._extend(False)
        alive = set(range(max(0, self.done), min(self.done + self.v.longest, len(self.last))))
        alive = {p for p in alive if p <= self.done or self.last[p] is not None}
        alive = {p for p in alive if p == 0 or self.last[p] is not None}
        if not alive:
            return []
        while len(alive) > 1:  # go back until all ways meet
            alive.add(self._back(furthest := max(alive)))
            alive.remove(furthest)
        return self._emit(alive.pop())

    def _emit(self, border: int) -> list[int]:
        out = []
        position = border
        while position:
            out.append(self.last[position])
            position = self._back(position)
        if out:
            self.prior = out[0]
            self.text, self.last, self.done = self.text[border:], self.last[border:], self.done - border
        return out[::-1]

    def end(self) -> list[int]:
        self._extend(True)
        return self._emit(len(self.text))


class Codec:
    """Encodes and decodes whole texts; tables of known words and borders are bounded by ROOM."""

    def __init__(self, path: str):
        self.v = Vocabulary(path)
        self.borders: dict[int | None, dict[int, bool]] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.added = regex.compile("|".join(map(regex.escape, sorted(self.v.added, key=len, reverse=True)))) if self.v.added else None
        self.as_bytes = {i: i.to_bytes(4, "little") for i in self.v.bytes_of}

    def word(self, word: str) -> bytes:
        data, machine = word.encode(), Transducer(self.v, self.borders)
        tokens: list[int] = []
        for at in range(0, len(data), BLOCK):
            if len(data) > BLOCK:
                tokens += machine.push(data[at : at + BLOCK])
            else:
                machine.text = data
        tokens += machine.end()
        return b"".join(map(self.as_bytes.__getitem__, tokens))

    def _plain(self, text: str, out: bytearray) -> None:
        words = WORDS.finditer(text) if len(text) > 1 << 20 else iter(WORDS.findall(text))
        while some := list(islice(words, 1 << 16)):
            some = some if isinstance(some[0], str) else [m[0] for m in some]
            new = set(some).difference(self.known)
            if new:
                self._learn(new, some)
            out += b"".join(map(self.known.__getitem__, some))
            if new:
                for word in [w for w in new if len(w) > 64]:
                    del self.known[word]

    def _learn(self, new: set[str], some: list[str]) -> None:
        if len(self.known) > ROOM:
            self.older, self.known = self.known, {}
            new |= set(some)
            if sum(map(len, self.borders.values())) > 2 * ROOM:
                self.borders.clear()
        known, older, live, as_bytes = self.known, self.older, self.v.live, self.as_bytes
        for word in new:
            ids = older.get(word)
            if ids is None:
                whole = live.get(word.encode())
                ids = self.word(word) if whole is None else as_bytes[whole]
            known[word] = ids

    def encode(self, text: str) -> bytes:
        """The ids, as little-endian unsigned 32-bit integers."""
        out, at = bytearray(), 0
        for found in self.added.finditer(text) if self.added else ():
            self._plain(text[at : found.start()], out)
            out += self.as_bytes[self.v.added[found[0]]]
            at = found.end()
        self._plain(text[at:] if at else text, out)
        return bytes(out)

    def decode(self, ids: bytes) -> str:
        """The text: an incremental UTF-8 machine over the tokens' bytes; what is no UTF-8 becomes U+FFFD."""
        machine, table = codecs.getincrementaldecoder("utf-8")("replace"), self.v.bytes_of.__getitem__
        parts, view = [], memoryview(ids).cast("I")  # little-endian machines only, as Arrow is
        for at in range(0, len(view), 1 << 16):
            parts.append(machine.decode(b"".join(map(table, view[at : at + (1 << 16)].tolist()))))
        parts.append(machine.decode(b"", True))
        return "".join(parts)


@functools.cache
def codec(path: str) -> Codec:
    """One for each Python worker and file."""
    return Codec(path)


def holds() -> bool:
    """Whether this worker has tables."""
    return codec.cache_info().currsize > 0


def forget() -> None:
    """Free this worker's tables."""
    codec.cache_clear()


def encode(docs: DataFrame, tokenizer: str, ids: str = "ids", text_col: str = "text") -> DataFrame:
    """All columns and `ids`, the token ids of the whole text (binary, little-endian 32 bits).

    Null and empty texts have no ids. A column that is named like `ids` already is an error; other columns are
    kept as they are. Words above 1024 bytes go in by blocks, so very long words take memory in proportion; a text and its
    ids are held whole. Repeated rows have the same ids, an empty table gives no rows.
    """
    if free_name(docs.columns, ids) != ids:
        raise ValueError(f"there is a column {ids} already")

    @F.pandas_udf(T.BinaryType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([codec(tokenizer).encode(t) for t in texts], dtype=object)

    return docs.withColumn(ids, run(whole(text_col)))


def decode(docs: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns and `text`, decoded from `ids`; null ids give an empty text.

    Ids are decoded in blocks, whatever their number; repeated rows have the same text, an empty table gives no rows.
    """
    if free_name(docs.columns, text) != text:
        raise ValueError(f"there is a column {text} already")

    @F.pandas_udf(T.StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in batches:
            yield pd.Series([codec(tokenizer).decode(i) for i in some], dtype=object)

    return docs.withColumn(text, run(F.coalesce(F.col(ids), F.lit(b""))))


def round_trip(docs: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded", text_col: str = "text") -> DataFrame:
    """All columns, `ids` and `text` as `encode` and then `decode` give them, by one Python worker for each task.

    Null, empty and very long texts, repeated rows and empty tables are as there. A column that is named like one of these
    already is an error.
    """
    if free_name([*docs.columns, text], ids) != ids or free_name(docs.columns, text) != text:
        raise ValueError(f"there is a column {ids} or {text} already")
    held = free_name(docs.columns, "both")

    @F.pandas_udf("ids binary, text string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = codec(tokenizer)
        for texts in batches:
            found = [machine.encode(t) for t in texts]
            yield pd.DataFrame({"ids": found, "text": [machine.decode(i) for i in found]}, dtype=object)

    both = docs.withColumn(held, run(whole(text_col)))
    return both.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(f"{held}.ids").alias(ids), F.col(f"{held}.text").alias(text))


def ids_as_integers(ids: bytes) -> Iterable[int]:
    return memoryview(ids).cast("I").tolist()


@query("op3_bpe_transducer")
def bpe_transducer(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded again."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    both = round_trip(docs, path)
    return both.select(
        "doc_id",
        F.floor(F.length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
