"""Token ids of whole texts by the tokenizers library, each distinct piece between spaces encoded once.

A text is cut at spaces where the tokenizer starts a new word anyway, so the ids of the pieces, joined, are the ids
of the text. Pieces recur, so a bounded table of them answers most; the library encodes the others, in byte-level
vocabularies word by word, as different pieces hold the same words: a word and the pieces it is in share one table.
"""

from __future__ import annotations

import codecs
import functools
import json
import os
import re
import string
from collections.abc import Iterable, Iterator
from itertools import pairwise

from .bpe import byte_letters

#: A space before one of these characters always begins a word. White space and format characters are left out.
_WORD_START = "[!-~¡-¬®-ᙿ、-퟿豈-﷿]"
_SPACE = re.compile(f" (?={_WORD_START})")
_STARTS = re.compile(_WORD_START).match

#: Marks of ASCII: a run of them behind a word of letters is a word of its own.
MARKS = string.punctuation
#: Letters below this character are letters in every version of the tables that libraries carry.
_SETTLED = "\u0530"
#: Letters below this one are composed, and each has its lower case by itself, but for the one that becomes two characters.
_LATIN, _DOTTED = "\u0250", "\u0130"

#: Characters of a text that are cut and encoded at a time, and of texts after which long pieces are forgotten.
GROUP_CHARS = 1 << 20
#: Pieces that an encoder remembers, unless told; a hundred thousand take about 17 MB.
ROOM = 600_000


class NoWordStart(Exception):
    """A cut piece does not begin as a word does, so the space before it is no border."""


class Pieces(dict):
    """Ids of pieces that stand behind `lead`, worked out when first asked for.

    It holds `room` pieces, and as many older ones. Pieces longer than `longest` are kept until `forget_long`. `words`, if given,
    composes what it can, of pieces in this table and, behind a line break, in `lines`; the library encodes the others.
    """

    def __init__(self, library, lead: str, room: int, longest: int = 48, words: LetterWords | None = None, lines: Pieces | None = None):
        super().__init__()
        self.library, self.lead, self.room, self.longest, self.words, self.lines = library, lead, room, longest, words, lines
        self.older: dict[str, bytes] = {}
        self.long: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        if len(piece) > self.longest:
            ids = self.long.get(piece)
            if ids is None:
                ids = self.long[piece] = self._new(piece)
            return ids
        ids = self.older.get(piece)
        if ids is None:
            ids = self._new(piece)
        if len(self) >= self.room:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids

    def _new(self, piece: str) -> bytes:
        if self.lead and not _STARTS(piece):
            raise NoWordStart
        if self.words is not None:
            if (ids := self.words.of(self, piece)) is not None:
                return ids
        elif len(piece) > 1 and piece[-1] in ",." and piece[-2].isalpha():  # no word goes over the border of a letter and a mark
            return self[piece[:-1]] + self.library(piece[-1])
        return self.library(self.lead + piece)

    def forget_long(self) -> None:
        self.long.clear()


class LetterWords:
    """Ids of byte-level pieces that are words of letters, each with marks behind it or not, on one or more lines.

    A piece of this form is composed of its words' ids: a line break and the marks are words of their own. A single word goes to
    the library's model. Other pieces give None. With `lower` the vocabulary is one of lower-case words without spaces; only
    Latin words are composed then.
    """

    def __init__(self, tokenizer, as_bytes: list[bytes], lower: bool = False):
        self.model, self.as_bytes, self.lower = tokenizer.model, as_bytes, lower
        self.letters = "".join(byte_letters())  # by byte
        self.marks: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        if word.isascii() and word[0] == " ":
            shown = self.letters[32] + word[1:]
        elif self.lower and word.isascii():
            shown = word
        else:
            shown, _ = codecs.charmap_decode(word.encode(), "strict", self.letters)
        return b"".join([self.as_bytes[x.id] for x in self.model.tokenize(shown)])

    def _marks(self, marks: str) -> bytes:
        ids = self.marks.get(marks)
        if ids is None:
            if len(self.marks) >= 4096:
                self.marks.clear()
            ids = self.marks[marks] = self._word(marks)
        return ids

    def of(self, table: Pieces, piece: str) -> bytes | None:
        if self.lower:
            return self._lower(table, piece)
        out = b""
        for line in piece.split("\n") if "\n" in piece else (piece,):
            word = line.rstrip(MARKS)
            if not word.isalpha() or not (word.isascii() or max(word) < _SETTLED):
                return None
            if out:
                out += self._marks("\n")
                table = table if table.lines is None else table.lines
            out += self._word(table.lead + word) if word == piece else table[word]
            if len(word) < len(line):
                out += self._marks(line[len(word) :])
        return out

    def _lower(self, table: Pieces, piece: str) -> bytes | None:
        word = piece.rstrip(MARKS)
        if not word.isalpha() or not (word.isascii() or (max(word) < _LATIN and _DOTTED not in word)):
            return None
        low = word.lower()
        ids = self._word(low) if low == piece else table[low]
        return ids + self._marks(piece[len(word) :]) if len(word) < len(piece) else ids


class PieceEncoder:
    """Encodes texts as little-endian unsigned 32-bit ids; `room` pieces behind spaces are remembered."""

    def __init__(self, path: str, room: int = ROOM):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.as_bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size() + 1)]
        # these parts alone: with its vocabulary and merges, the layout takes more memory than a full table
        parts = {name: getattr(self.tokenizer, name) for name in ("normalizer", "pre_tokenizer")}
        layout = {name: json.loads(part.__getstate__()) for name, part in parts.items() if part}
        self.lead = self._lead(layout)
        added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        # no added token is a part of such pieces if marks stand before letters or digits in each of them
        plain = all(any(a in MARKS and b.isalnum() for a, b in pairwise(x)) for x in added)
        self.words = LetterWords(self.tokenizer, self.as_bytes, lower=not self.lead) if plain and (self.lead or self._lower_words(layout)) else None
        library = functools.partial(_by_library, self.tokenizer, self.as_bytes)  # nothing here refers to itself, so `forget` frees all at once
        self.first = Pieces(library, "", max(1, room // 8), words=self.words) if self.lead else None
        self.inner = Pieces(library, self.lead or "", max(1, room // 2), words=self.words, lines=self.first)

    @staticmethod
    def _lead(layout: dict) -> str | None:
        """What a cut space becomes at the start of the next piece; None if texts can't be cut at spaces."""
        before, normal = layout.get("pre_tokenizer") or {}, layout.get("normalizer")
        if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not normal:
            return " "
        steps = before.get("pretokenizers") or [before]
        if steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and steps[0].get("invert"):
            kinds = {x["type"] for x in (normal or {}).get("normalizers", [])}
            # only what matches the pattern stays, and no word pattern of these files matches a space
            if " " not in steps[0]["pattern"].get("Regex", " ") and kinds <= {"NFC", "Replace", "Lowercase"}:
                return ""
        return None

    def _lower_words(self, layout: dict) -> bool:
        """Whether words are put into lower case and split into runs of letters, digits and other characters."""
        if self.lead is None:
            return False
        kinds = [x["type"] for x in (layout.get("normalizer") or {}).get("normalizers", [])]
        steps = (layout.get("pre_tokenizer") or {}).get("pretokenizers") or []
        pattern = steps[0]["pattern"].get("Regex", "") if steps else ""
        runs = pattern.endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        return kinds == ["NFC", "Replace", "Lowercase"] and runs and [x["type"] for x in steps[1:]] == ["ByteLevel"]

    def slices(self, text: str) -> Iterator[tuple[str, bool]]:
        """A long text in parts that can be encoded one by one, and whether a part stands behind a cut space."""
        start, behind = 0, False
        while self.lead is not None and len(text) - start > GROUP_CHARS:
            cut = _SPACE.search(text, start + GROUP_CHARS)
            if not cut:
                break
            yield text[start : cut.start()], behind
            start, behind = cut.end(), True
        yield text[start:], behind

    def _joined(self, pieces: list[str], behind: bool) -> bytes:
        if self.lead and not behind:
            return self.first[pieces.pop(0)] + b"".join(map(self.inner.__getitem__, pieces))
        return b"".join(map(self.inner.__getitem__, pieces))

    def _ids(self, text: str, behind: bool = False) -> bytes:
        if self.lead is None:
            return self._joined([text], behind)
        if not self.lead:
            return self._joined(text.replace("\n", " ").split(" "), behind)
        if "  " not in text:
            try:  # nearly always all spaces are borders
                return self._joined(text.split(" "), behind)
            except NoWordStart:
                pass
        return self._joined(_SPACE.split(text), behind)

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, in order; memory follows GROUP_CHARS and the longest text."""
        chars = 0
        for text in texts:
            if len(text) > GROUP_CHARS:
                yield b"".join(self._ids(part, behind) for part, behind in self.slices(text))
            else:
                yield self._ids(text)
            chars += len(text)
            if chars >= GROUP_CHARS:
                for table in (self.inner,) if self.first is None else (self.inner, self.first):
                    table.forget_long()
                chars = 0


def _by_library(tokenizer, as_bytes: list[bytes], text: str) -> bytes:
    (found,) = tokenizer.encode_batch_fast([text], add_special_tokens=False)
    return b"".join(map(as_bytes.__getitem__, found.ids))


@functools.cache
def encoder(path: str, room: int = ROOM) -> PieceEncoder:
    """One for each Python worker, file and room."""
    return PieceEncoder(path, room)


def holds() -> bool:
    """Whether this worker has tables."""
    return encoder.cache_info().currsize > 0


def forget() -> None:
    """Free this worker's tables."""
    encoder.cache_clear()
