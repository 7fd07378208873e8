"""Harmonic packing of token sequences (op2)."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, make_room, query, table, whole
from .tokens import ROOM, encoder

#: Sequence numbers of one worker: its partition number times this, and on.
PER_WORKER = 1 << 33


#: Classes up to this one hold lengths over capacity / (class + 1); the last one all shorter ones.
LAST_CLASS = 64


class Piece(NamedTuple):
    """Tokens of a document: where they start in it, how many, their ids, the document's tokens, and how often it was cut here."""

    doc: object
    start: int
    length: int
    ids: bytes
    tokens: int
    cuts: int = 0

    def cut(self, at: int) -> tuple[Piece, Piece]:
        more = self.cuts + 1
        head = self._replace(length=at, ids=self.ids[: 4 * at], cuts=more)
        return head, self._replace(start=self.start + at, length=self.length - at, ids=self.ids[4 * at :], cuts=more)


class Bin:
    def __init__(self, k: int, capacity: int):
        self.k, self.gap, self.pieces = k, capacity, []

    def add(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.gap -= piece.length


class Bins:
    """The bins of one worker: that of class k has its number of pieces with the k-th, and waits for one more that fills its gap.

    Each document fills at most one gap by being cut, which is as many as it can leave.
    """

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next, self.open = capacity, first, {}
        self.waiting: list[Bin] = []

    def put(self, piece: Piece) -> Iterator[tuple]:
        """Take a whole sequence, or a document's rest; yields the rows of bins that are full."""
        if piece.length == self.capacity:
            yield from self._rows(1, [piece])
            return
        while self.waiting:
            bin_ = self.waiting[-1]
            if piece.length > bin_.gap and piece.cuts:
                break
            whole_ = piece.length <= bin_.gap
            head, piece = (piece, None) if whole_ else piece.cut(bin_.gap)
            bin_.add(head)
            if not bin_.gap:
                yield from self._rows(bin_.k, self.waiting.pop().pieces)
            if whole_:
                return
        yield from self._class(piece)

    def _class(self, piece: Piece) -> Iterator[tuple]:
        k = min(self.capacity // piece.length, LAST_CLASS)
        bin_ = self.open.get(k) or self.open.setdefault(k, Bin(k, self.capacity))
        if piece.length > bin_.gap:  # of the last class, whose bins hold what fits
            self.waiting.append(bin_)
            bin_ = self.open[k] = Bin(k, self.capacity)
        bin_.add(piece)
        if not bin_.gap:
            yield from self._rows(k, self.open.pop(k).pieces)
        elif k < LAST_CLASS and len(bin_.pieces) == k:
            self.waiting.append(self.open.pop(k))

    def _rows(self, k: int, pieces: list[Piece]) -> Iterator[tuple]:
        offset = 0
        for p in pieces:
            yield p.doc, p.start, p.length, p.ids, p.tokens, self.next, offset, k
            offset += p.length
        self.next += 1

    def end(self) -> Iterator[tuple]:
        """What is in bins that are not full, one behind the other: whole sequences, then sequences whose lengths are powers of two.

        A piece is cut here once at most; where that does not do, the last sequence is one that has to be padded.
        """
        left = [p for _, bin_ in sorted(self.open.items()) for p in bin_.pieces] + [p for bin_ in self.waiting for p in bin_.pieces]
        most = {id(p): p.cuts + 1 for p in left}
        total = sum(p.length for p in left)
        rest = total % self.capacity
        sizes = [self.capacity] * (total // self.capacity) + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]
        held: list[Piece] = []
        room, left = sizes.pop(0) if sizes else 0, left[::-1]
        allowed = [most[id(p)] for p in left]
        while left:
            piece, may = left.pop(), allowed.pop()
            if piece.length > room:
                if piece.cuts >= may:  # only behind the whole sequences
                    yield from self._rows(LAST_CLASS, [*held, piece, *left[::-1]])
                    return
                head, tail = piece.cut(room)
                left.append(tail)
                allowed.append(may)
                piece = head
            held.append(piece)
            room -= piece.length
            if not room:
                yield from self._rows(LAST_CLASS, held)
                held, room = [], sizes.pop(0) if sizes else 0


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    room: int = ROOM,
) -> DataFrame:
    """Pack all documents' token ids into sequences of `capacity` (a power of two).

    A document is its ids and `end_id`; it gives whole sequences and a rest. A rest of more than capacity / (k + 1) and at most
    capacity / k tokens is of the harmonic class k, whose bins take k rests each, whole; the last class takes all short ones. A
    bin with its number of rests has a gap, which the next document fills: whole if it fits, else by being cut once, and what is left
    of it is of the class of its length. Each worker (partition) fills its own bins, without a shuffle; it holds fewer than k
    rests of each class k. At its end it joins what is left to whole sequences and ones whose lengths are powers of two. So a
    document shorter than a sequence is in three pieces at most, and at most one sequence of a worker has to be padded.

    A worker remembers the ids of `room` pieces of texts; fewer take less memory and more time, and give the same rows.

    Returns a row for each piece: id, start, length, ids (binary, little-endian 32 bits), doc_tokens, sequence_id
    (worker number * 2**33 + count), offset, bin_class (k). Null and empty texts are the end id alone, a null id stays
    null, repeated rows are packed as often as they occur, very long texts give one whole sequence after the other, an empty table
    gives no rows, other columns are not read.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity has to be a power of two")
    end = struct.pack("<I", end_id)
    id_type = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField(id_col, id_type),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
            T.StructField("bin_class", T.IntegerType()),
        ]
    )

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room(own="tokens")
        context = TaskContext.get()
        bins = Bins(capacity, (context.partitionId() if context else 0) * PER_WORKER)
        encode, rows, size, kind = encoder(tokenizer, room).encode, [], 0, None

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=schema.names)

        for batch in batches:
            kind = batch.schema.field(0).type
            texts = (x.as_py() for x in batch.column(1))
            for doc, ids in zip(batch.column(0).to_pylist(), encode(texts), strict=True):
                ids += end
                tokens = len(ids) // 4
                for start in range(0, tokens, capacity):
                    length = min(capacity, tokens - start)
                    rows.extend(bins.put(Piece(doc, start, length, ids[4 * start : 4 * (start + length)], tokens)))
                size += len(ids)
                if size >= 1 << 22 and rows:
                    yield out(rows)
                    rows, size = [], 0
        rows.extend(bins.end())
        if rows:
            yield out(rows)
        give_back()

    return docs.select(F.col(id_col), whole(text_col)).mapInArrow(worker, schema)


@query("op2_harmonic_packing")
def harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, packed into sequences of 4096 tokens."""
    import public_tokenizers

    pieces = pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bin_class")
