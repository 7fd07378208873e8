"""Packing, sequence files and the transducer against the tokenizers library."""

import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from linewright.llm import bpe, packing, sequence_files
from linewright.llm.tokens import PieceEncoder
from linewright.session import scratch_path

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
LETTERS = "aaaabcdeé ñß日本\n\t  \x1c\x85᠎​﻿ 'sdmt.,,!0123²½ABCthe<|endoftext|>"


def library(path, texts):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch(list(texts), add_special_tokens=False)]


def odd_texts(count, seed=1):
    rng = random.Random(seed)
    for k in range(count):
        text = "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60)))
        yield text + "<|endoftext|>" + text[::-1] if k % 7 == 0 else text


@pytest.mark.parametrize("path", [WORD, BYTE])
@pytest.mark.parametrize("room", [50, 100_000])
def test_pieces_give_the_librarys_ids(path, room):
    texts = list(odd_texts(1500)) + ["a " * 5, " a", "  a  b   c\n\n d", ""]
    encoder = PieceEncoder(path, room=room)
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
    assert got == library(path, texts)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_long_texts_are_cut_without_a_trace(path, monkeypatch):
    monkeypatch.setattr("linewright.llm.tokens.GROUP_CHARS", 100)
    texts = [" ".join(odd_texts(40, seed)) for seed in range(20)] + ["x" * 500]
    got = [np.frombuffer(x, "<u4").tolist() for x in PieceEncoder(path).encode(texts)]
    assert got == library(path, texts)


def test_transducer_equals_the_library():
    codec = bpe.Codec(BYTE)
    texts = list(odd_texts(1500, 2))
    for text, ids in zip(texts, library(BYTE, texts), strict=True):
        found = codec.encode(text)
        assert bpe.ids_as_integers(found) == ids, text
        assert codec.decode(found) == Tokenizer.from_file(BYTE).decode(ids, skip_special_tokens=False) if len(text) < 8 else True


def test_transducer_emits_within_its_lookahead():
    vocabulary = bpe.Codec(BYTE).v
    rng = random.Random(3)
    words = ["a" * 5000, "ab" * 2000, "the" * 1500, "=" * 3000, "".join(rng.choice("aeht") for _ in range(4000))]
    words += ["".join(rng.choice("erstinoa") for _ in range(3000)) for _ in range(5)]
    for word, ids in zip(words, library(BYTE, words), strict=True):
        for step in (1, 64, 1000):
            machine, out = bpe.Transducer(vocabulary, {}), []
            for at in range(0, len(word), step):
                out += machine.push(word[at : at + step].encode())
                assert len(machine.text) <= vocabulary.lookahead + vocabulary.longest  # constant memory
            assert out + machine.end() == ids


def test_borders_agree_with_merging():
    """`crosses` against plain merging of the bytes of both tokens."""
    vocabulary = bpe.Vocabulary(BYTE)
    rank = vocabulary.rank

    def merge(data):
        tokens = [vocabulary.id_of[bytes([b])] for b in data]
        while True:
            best = min((rank.get(p, 1 << 30) for p in zip(tokens, tokens[1:], strict=False)), default=1 << 30)
            if best == 1 << 30:
                return tokens
            at = next(i for i, p in enumerate(zip(tokens, tokens[1:], strict=False)) if rank.get(p) == best)
            left = vocabulary.bytes_of[tokens[at]] + vocabulary.bytes_of[tokens[at + 1]]
            tokens[at : at + 2] = [vocabulary.id_of[left]]

    rng = random.Random(4)
    live = list(vocabulary.live.items())
    for _ in range(3000):
        (a, i), (b, j) = rng.choice(live), rng.choice(live)
        assert vocabulary.crosses(i, j) == (merge(a + b) != [i, j]), (a, b)


def test_decoding_any_ids():
    codec, library_file, rng = bpe.Codec(BYTE), Tokenizer.from_file(BYTE), random.Random(5)
    for _ in range(3000):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 6))]
        assert codec.decode(struct.pack(f"<{len(ids)}I", *ids)) == library_file.decode(ids, skip_special_tokens=False)


def test_codec_over_a_table(docs_of, odd_rows):
    docs = docs_of(odd_rows).withColumnRenamed("doc_id", "start")  # other names of columns do no harm
    rows = bpe.decode(bpe.encode(docs, BYTE), BYTE).collect()
    assert len(rows) == len(odd_rows)
    again = bpe.round_trip(docs, BYTE).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))
    for row in rows:
        assert bpe.ids_as_integers(row["ids"]) == library(BYTE, [row["text"] or ""])[0]
        assert row["decoded"] == (row["text"] or "")
    with pytest.raises(ValueError):
        bpe.encode(docs.withColumnRenamed("start", "ids"), BYTE)
    assert bpe.encode(docs_of([]), BYTE).count() == 0


def packed(df):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in df.collect():
        assert r["length"] * 4 == len(r["ids"]) and r["length"] > 0
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    return by_doc, by_sequence


def check_sequences(by_sequence, capacity):
    """Gapless; one sequence of a worker is padded at most."""
    padded = []
    for number, rows in by_sequence.items():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
        if at & (at - 1):
            padded.append(number // packing.PER_WORKER)
        assert len({r["bin_class"] for r in rows}) == 1
    assert len(padded) == len(set(padded))


def test_packing_holds_every_token_once(docs_of, odd_rows):
    rows = [r for r in odd_rows if r[0] != 1] + [(10 + i, f"text {i} " * (i * 7 % 300)) for i in range(200)]
    by_doc, by_sequence = packed(packing.pack(docs_of(rows), WORD, capacity=256))
    check_sequences(by_sequence, 256)
    assert by_doc.keys() == {r[0] for r in rows}
    for doc, text in rows:
        pieces = sorted(by_doc[doc], key=lambda r: r["start"])
        whole = b"".join(r["ids"] for r in pieces)
        assert [r["start"] for r in pieces] == list(np.cumsum([0] + [r["length"] for r in pieces[:-1]]))
        want = library(WORD, [text or ""])[0] + [2]
        assert np.frombuffer(whole, "<u4").tolist() == want
        assert {r["doc_tokens"] for r in pieces} == {len(want)}


def test_packing_reads_no_column_that_clashes(docs_of):
    docs = docs_of([(k, f"text {k} " * (5 * k)) for k in range(20)], parts=1)
    clash = docs.selectExpr("*", "1 AS tokens", "2 AS start", "3 AS ids", "4 AS sequence_id", "5 AS id")
    assert sorted(packing.pack(clash, WORD, capacity=64).collect()) == sorted(packing.pack(docs, WORD, capacity=64).collect())


def test_packing_repeated_rows_and_empty_tables(docs_of):
    by_doc, by_sequence = packed(packing.pack(docs_of([(1, "same text")] * 5, parts=2), WORD, capacity=8))
    check_sequences(by_sequence, 8)
    assert sum(r["length"] for r in by_doc[1]) == 5 * len(library(WORD, ["same text"])[0] + [2])
    assert packing.pack(docs_of([]), WORD).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs_of([]), WORD, capacity=100)


def test_packing_query_cuts_little_and_pads_little_on_the_table(spark):
    from linewright.llm.common import QUERIES

    rows = QUERIES["op2_harmonic_packing"](spark, "/root/testdata/sf0.01").toPandas()
    totals = rows.groupby("sequence_id").length.sum()
    padded = totals[(totals & (totals - 1)) != 0]
    assert totals.max() <= 4096 and (4096 - padded).sum() <= 0.01 * totals.sum()
    short = rows[rows.doc_tokens < 4096]
    assert short.groupby("doc_id").size().max() <= 3 and short.groupby("doc_id").size().mean() < 1.7
    assert len(rows) < 2 * rows.doc_id.nunique() + totals.eq(4096).sum()


@pytest.mark.parametrize("capacity", [1, 2, 16, 256])
def test_bins_hold_their_number_and_documents_are_cut_twice_at_most(capacity):
    import random

    for seed in range(40):
        rng = random.Random(seed)
        high = rng.choice((2, capacity // 3 + 2, capacity + 1, 3 * capacity))
        bins, rows, lengths = packing.Bins(capacity, 100), [], [rng.randrange(1, max(2, high)) for _ in range(rng.randrange(120))]
        for doc, tokens in enumerate(lengths):
            ids = struct.pack(f"<{tokens}I", *range(tokens))
            for start in range(0, tokens, capacity):
                length = min(capacity, tokens - start)
                rows.extend(bins.put(packing.Piece(doc, start, length, ids[4 * start : 4 * (start + length)], tokens)))
            assert len(bins.waiting) <= 1
        regular = len(rows)
        rows.extend(bins.end())
        pieces, sequences = {}, {}
        for doc, start, length, ids, tokens, sequence, offset, k in rows:
            assert struct.unpack(f"<{length}I", ids) == tuple(range(start, start + length)) and tokens == lengths[doc]
            pieces.setdefault(doc, []).append((start, length))
            sequences.setdefault(sequence, []).append((offset, length, k))
        for doc, tokens in enumerate(lengths):
            at = 0
            for start, length in sorted(pieces[doc]):
                assert start == at
                at += length
            assert at == tokens and (tokens >= capacity or len(pieces[doc]) <= 3)
        totals = []
        for found in sequences.values():
            at = 0
            for offset, length, _ in sorted(found):
                assert offset == at
                at += length
            totals.append(at)
        assert all(t <= capacity for t in totals) and sorted(sequences) == list(range(100, 100 + len(sequences)))
        assert sum(t & (t - 1) != 0 for t in totals) <= 1
        for _, _, length, _, _, sequence, _, k in rows[:regular]:
            assert sum(n for _, n, _ in sequences[sequence]) == capacity and length * k <= capacity or k == packing.LAST_CLASS or len(sequences[sequence]) >= k


def test_files_hold_documents_in_order(spark, docs_of, odd_rows):
    docs = docs_of(odd_rows).repartition(4)
    parts = sequence_files.write_sequences(docs, BYTE, scratch_path(spark, "test"), length=16, per_batch=4)
    rows = sequence_files.read_documents(parts).collect()
    rows.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 1, 1, 1, 2, 3, 4, 5, 6, 7]
    at = 0
    want = defaultdict(list)
    for doc, text in odd_rows:
        want[doc].append(library(BYTE, [text or ""])[0] + [0])
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        want[r["doc_id"]].remove(ids)
    assert not any(want.values())


def test_files_give_equal_sequences_and_masks_without_copies(spark, docs_of):
    docs = docs_of([f"document {i} has some words" for i in range(50)])
    parts = sequence_files.write_sequences(docs, BYTE, scratch_path(spark, "test"), length=8, per_batch=4).collect()
    assert sum(p["documents"] for p in parts) == 50
    for part in parts:
        file = sequence_files.SequenceFile(part["sequences_file"])
        count = -(-part["tokens"] // 8)
        order = list(range(count))
        random.Random(1).shuffle(order)
        seen, ends = 0, 0
        for number in order:
            ids, mask = file.sequence(number)
            assert len(ids) == len(mask) == 8 and not ids.flags.owndata
            seen += int((mask > 0).sum())
            ends += int((mask == sequence_files.LAST_OF_DOCUMENT).sum())
            assert all(ids[mask == sequence_files.LAST_OF_DOCUMENT] == 0)
            same, inside, last = file.views(number)
            assert same.base is not None and list(same) == list(ids)
            assert inside.to_pylist() == list(mask > 0) and last.to_pylist() == list(mask == sequence_files.LAST_OF_DOCUMENT)
            for bits in (inside, last):  # a bit each, in place
                assert bits.buffers()[1].size * 8 < 8 * 4 + 512
            if number < count - 1:
                assert (mask > 0).all()
        assert seen == part["tokens"] and ends == part["documents"]
        first = b"".join(file.spans(0, part["tokens"]))
        assert sequence_files.crc_of(file.spans(0, part["tokens"])) == zlib.crc32(first)


def test_files_of_an_empty_table(spark, docs_of):
    parts = sequence_files.write_sequences(docs_of([]), BYTE, scratch_path(spark, "test"))
    assert parts.count() == 0 and sequence_files.read_documents(parts).count() == 0


@pytest.mark.parametrize("room", [40, 1_200_000])
def test_words_of_letters_get_the_ids_of_whole_texts(room):
    rng = random.Random(7)
    letters = "abzAZéßøñƀɏɐaǃªº中あЖ'`3,. \n"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += [" ".join(rng.choice(["don't", "word", "Été", "naïve,", "x.", "ɐlpha", "ab", "", "9th"]) for _ in range(50)) for _ in range(40)]
    got = [np.frombuffer(x, "<u4").tolist() for x in PieceEncoder(BYTE, room).encode(texts)]
    assert got == library(BYTE, texts)


@pytest.mark.parametrize("room", [8, 400_000])
def test_pieces_composed_of_words_get_the_ids_of_whole_texts(room):
    """Letters, marks and lines in all orders, next to white space and to added tokens."""
    rng = random.Random(11)
    parts = ["word", "Été", "ß", "g", "naïve", "!!", ",", ".", "'", "'s", "_", "9", "²", "\n", "\n\n", "\r\n", "\t", " ", "  ", "中", "ɐ", "бг", "x́", "\x1f", "\xa0", "<|endoftext|>", "<|", "|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(1500)]
    texts += ["a\n" * 5000 + "b", "x" * 3000 + "!" * 300, "it's\ndon'\nt", "a.\n\nb", "a<|\nendoftext|>"]
    encoder = PieceEncoder(BYTE, room)
    assert encoder.words is not None
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
    assert got == library(BYTE, texts)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_forgotten_tables_are_free_at_once(path):
    """No table refers to itself, so nothing waits for the garbage collector."""
    import gc
    import weakref

    from linewright.llm import tokens

    gc.disable()
    try:
        held = weakref.ref(tokens.encoder(path))
        list(held().encode(["some words, and\nmore words ", " 12  ab"]))
        assert tokens.holds()
        tokens.forget()
        assert held() is None and not tokens.holds()
    finally:
        gc.enable()


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_a_word_and_its_pieces_share_a_table(path):
    encoder = PieceEncoder(path)
    texts = ["a word, word. Words\nword word\n\nword", "x  word \n word́ 日本 word", " word", "word ", "Ⱥb İx Ɓa,"]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == library(path, texts)
    assert "word" in encoder.inner and encoder.words is not None and not hasattr(encoder.words, "known")


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_an_encoder_keeps_the_room_it_is_given_and_reads_no_vocabulary_as_objects(path, monkeypatch):
    from linewright.llm import tokens

    read = []
    monkeypatch.setattr(tokens.json, "loads", lambda text, plain=tokens.json.loads: read.append(len(text)) or plain(text))
    try:
        few = tokens.encoder(path, 16)
        assert few.inner.room == 8 and tokens.encoder(path).inner.room == tokens.ROOM // 2
    finally:
        tokens.forget()
    assert max(read) < 10_000  # normalizer and pre-tokenizer alone
    texts = list(odd_texts(300, 3))
    assert [np.frombuffer(x, "<u4").tolist() for x in few.encode(texts)] == library(path, texts)


def test_less_room_gives_the_same_files_and_sequences(spark, docs_of, odd_rows):
    docs = docs_of(odd_rows, parts=1)
    files, packed = [], []
    for more in ({}, {"room": 16}):
        parts = sequence_files.write_sequences(docs, BYTE, scratch_path(spark, "room"), **more)
        files.append(sorted(map(repr, sequence_files.read_documents(parts).collect())))
        packed.append(sorted(map(repr, packing.pack(docs, WORD, **more).collect())))
    assert files[0] == files[1] and packed[0] == packed[1] and len(files[0]) == len(odd_rows)
