"""Token ids as Arrow files of fixed-size lists (op4)."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewright.session import materialize, scratch_path

from .common import query, table, whole
from .tokens import encoder

#: Pieces that a worker remembers: new words are what encoding costs, and nothing else of size is in a worker of this job.
ROOM = 1_200_000

#: Codes that `SequenceFile.sequence` gives.
PADDING, TOKEN, LAST_OF_DOCUMENT = 0, 1, 2


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class SequenceFile:
    """One part: sequences of equal length with their masks, read at random places without copies from a local file."""

    def __init__(self, uri: str):
        store, path = _store(uri)
        local = isinstance(store, fs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else store.open_input_file(path)
        self.reader = ipc.open_file(self.source)
        about = self.reader.schema.metadata
        self.length, self.per_batch = int(about[b"length"]), int(about[b"per_batch"])
        self._held: tuple[int, np.ndarray, pa.BooleanArray, pa.BooleanArray] | None = None

    def _batch(self, number: int) -> tuple[np.ndarray, pa.BooleanArray, pa.BooleanArray]:
        if self._held is None or self._held[0] != number:
            ids, mask, ends = (column.flatten() for column in self.reader.get_batch(number).columns)
            self._held = (number, ids.to_numpy(zero_copy_only=True), mask, ends)
        return self._held[1:]

    def views(self, number: int) -> tuple[np.ndarray, pa.BooleanArray, pa.BooleanArray]:
        """(ids, mask, ends) of one sequence, as views of the file: `mask` is false at padding, `ends` true at a document's last id."""
        at, row = divmod(number, self.per_batch)
        return tuple(x[row * self.length : (row + 1) * self.length] for x in self._batch(at))

    def sequence(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, codes) of one sequence: a view of the file, and mask and ends as one code for each id."""
        ids, *marks = self.views(number)
        mask, ends = (x.to_numpy(zero_copy_only=False).astype(np.uint8) for x in marks)
        return ids, mask * np.uint8(TOKEN) + ends * np.uint8(LAST_OF_DOCUMENT - TOKEN)

    def spans(self, start: int, count: int) -> Iterator[np.ndarray]:
        """The ids from a token on, as views, batch by batch."""
        size = self.length * self.per_batch
        while count > 0:
            at, skip = divmod(start, size)
            view = self._batch(at)[0][skip : skip + count]
            yield view
            start, count = start + len(view), count - len(view)

    def close(self) -> None:
        self._held = None
        self.source.close()


def write_sequences(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    length: int = 2048,
    per_batch: int = 256,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    room: int = ROOM,
) -> DataFrame:
    """Write the token ids of all documents, each with `end_id` after it, in ascending order of id; returns the parts.

    Rows are sorted by id over the cluster (ties by a hash of the text, then the text: a repeated id may spread over parts;
    null ids come first). Each task writes one part below `folder` (any place that pyarrow can open, shared by
    all): `<part>.sequences.arrow`, an Arrow file whose batches hold `per_batch` rows of three fixed-size lists, ids (unsigned,
    16 bits where the vocabulary fits, else 32) and, a bit each, mask (false at padding) and ends (true at the last token of a
    document), and `<part>.documents.arrow` with (id, start in the part, tokens). Only the last sequence of a part is padded. A task that runs again
    writes under a new name, and only files named in the returned table count, so lost executors do no harm.

    A worker remembers the ids of `room` pieces of texts; fewer take less memory and more time, and give the same files.

    Returns part, sequences_file, documents_file, tokens, documents, start (tokens of all parts before). Null and empty
    texts are the end id alone; an empty table gives no parts; other columns are not read.
    """
    source = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"), F.xxhash64(whole(text_col)).alias("tie"))
    ordered = source.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text").select("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        part = TaskContext.get().partitionId()
        file = f"part-{part:07d}-{uuid.uuid4().hex}"
        about = {"length": str(length), "per_batch": str(per_batch)}
        encode = encoder(tokenizer, room).encode
        small = encoder(tokenizer, room).tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16
        kind = np.dtype("<u2" if small else "<u4")
        kinds = {"ids": pa.from_numpy_dtype(kind), "mask": pa.bool_(), "ends": pa.bool_()}
        values = pa.schema([(name, pa.list_(k, length)) for name, k in kinds.items()], metadata=about)
        sequences = documents = None
        held: list[np.ndarray] = []
        ends: list[int] = []
        waiting = done = total = count = 0

        def flush(rows: int) -> None:
            """Write `rows` sequences of what is held."""
            nonlocal held, ends, waiting, done
            flat = np.concatenate(held) if held else np.empty(0, kind)
            take = rows * length
            ids = flat[:take]
            mask, last = np.arange(take) < len(ids), np.zeros(take, bool)
            if len(ids) < take:
                ids = np.concatenate([ids, np.zeros(take - len(ids), kind)])
            inside = [e - done for e in ends if e - done < take]
            last[inside] = True
            ends = ends[len(inside) :]
            sequences.write_batch(
                pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(x), length) for x in (ids, mask, last)], schema=values)
            )
            held = [flat[take:].copy()] if len(flat) > take else []
            waiting, done = max(0, len(flat) - take), done + take

        with store.open_output_stream(f"{base}/{file}.sequences.arrow") as a, store.open_output_stream(f"{base}/{file}.documents.arrow") as b:
            for batch in batches:
                if documents is None:
                    index = pa.schema([("id", batch.schema.field(0).type), ("start", pa.int64()), ("tokens", pa.int64())])
                    sequences, documents = ipc.new_file(a, values), ipc.new_file(b, index)
                starts, sizes = [], []
                for ids in encode(x.as_py() for x in batch.column(1)):
                    flat = np.append(np.frombuffer(ids, "<u4"), np.uint32(end_id)).astype(kind)
                    starts.append(total)
                    sizes.append(len(flat))
                    total += len(flat)
                    ends.append(total - 1)
                    held.append(flat)
                    waiting += len(flat)
                    while waiting >= per_batch * length:
                        flush(per_batch)
                count += len(starts)
                documents.write_batch(pa.record_batch([batch.column(0), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], schema=index))
            if documents is not None:
                if waiting:
                    flush(-(-waiting // length))
                sequences.close()
                documents.close()
        if documents is not None:
            row = [part, f"{file}.sequences.arrow", f"{file}.documents.arrow", total, count]
            yield pa.record_batch([pa.array([x]) for x in row], names=["part", "sequences_file", "documents_file", "tokens", "documents"])

    parts = ordered.mapInArrow(write, "part long, sequences_file string, documents_file string, tokens long, documents long")
    parts = materialize(parts, "sequence-parts")  # the files are written once, here
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    named = parts.withColumns({c: F.concat(F.lit(f"{folder}/"), c) for c in ("sequences_file", "documents_file")})
    return named.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_documents(parts: DataFrame, id_type: T.DataType = T.LongType(), id_name: str = "doc_id") -> DataFrame:
    """Each document's ids from the files of `write_sequences`: id, start (over all parts), n_tokens, ids (binary)."""
    schema = T.StructType(
        [T.StructField(id_name, id_type), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                file = SequenceFile(part["sequences_file"])
                store, path = _store(part["documents_file"])
                with store.open_input_file(path) as source:
                    index = ipc.open_file(source)
                    for at in range(index.num_record_batches):
                        docs = index.get_batch(at)
                        for low in range(0, docs.num_rows, 1000):
                            few = docs.slice(low, 1000)
                            starts, sizes = few.column(1).to_pylist(), few.column(2).to_pylist()
                            ids = [b"".join(x.astype("<u4") for x in file.spans(s, n)) for s, n in zip(starts, sizes, strict=True)]
                            columns = [few.column(0), pa.array([part["start"] + s for s in starts], pa.int64()), few.column(2), pa.array(ids, pa.binary())]
                            yield pa.record_batch(columns, names=schema.names)
                file.close()

    files = parts.select("part", "sequences_file", "documents_file", "start")
    return files.repartition(max(1, files.count())).mapInArrow(read, schema)


def crc_of(views: Iterator[np.ndarray]) -> int:
    """crc32 over views, without joining them."""
    value = 0
    for view in views:
        value = zlib.crc32(view, value)
    return value


@query("op4_sequence_files")
def sequence_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents written as Arrow files and read back."""
    import public_tokenizers

    docs = table(spark, folder, "documents")
    parts = write_sequences(docs, public_tokenizers.path("byte_bpe_50k.json"), scratch_path(spark, "sequences"))
    back = read_documents(parts, docs.schema["doc_id"].dataType)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
