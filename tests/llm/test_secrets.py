"""Secrets against the base patterns as stated, and the test battery's behaviour."""

import hashlib
import random
import re
from collections import Counter

import pytest

from linewright.llm import secret_scan

STATED = {
    "assign": re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}


def stated_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(STATED.items()):
        for m in pattern.finditer(text):
            if {"assign": lambda m: len(m[2]) >= 6, "access": lambda m: len(m[0]) >= 20, "hex": lambda m: len(m[0]) >= 24}[kind](m):
                out.append((m.start(), rank, m.end()))
    return sorted(out)


def test_base_patterns_as_stated():
    rng = random.Random(1)
    parts = ["token", "SECRET", "api_key", "ApiKey", "passwd", "password", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGH12345678", "a1b2c3d4", "abcdef", "x", "é", "ſecret", "\n", ".", "-"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert secret_scan.base_spans(text) == stated_spans(text), text


def test_encodings():
    assert secret_scan.encoding_of("deadbeef01") == "hex"
    assert secret_scan.encoding_of("DEADBEEF01") == "HEX"
    assert secret_scan.encoding_of("ABCDXYZ234") == "base32"
    assert secret_scan.encoding_of("abcxyz0189") == "base36"
    assert secret_scan.encoding_of("abcXYZ0189") == "base62"
    assert secret_scan.encoding_of("abc+YZ0189") == "base64"
    assert secret_scan.encoding_of("abc-YZ_189") == "base64url"
    for none in ("onlyletters", "0123456789", "a+b-c_1", ""):
        assert secret_scan.encoding_of(none) is None


@pytest.mark.parametrize("encoding", sorted(secret_scan.ALPHABETS))
def test_random_strings_have_even_p_values(encoding):
    rng = random.Random(2)
    p = [secret_scan.combined(secret_scan.battery("".join(rng.choices(secret_scan.ALPHABETS[encoding], k=40)), encoding)) for _ in range(3000)]
    for edge in (0.1, 0.25, 0.5, 0.75):
        assert abs(sum(x <= edge for x in p) / len(p) - edge) < 0.06


def test_written_strings_have_small_p_values():
    texts = ["configuration-of-the-2nd-server-in-the-list", "abcabcabcabcabc123123123", "aaaaaaaaaaaaaaaaaaaaaaa1", "the_quick_brown_fox_number_7_jumps"]
    for text in texts:
        assert secret_scan.combined(secret_scan.battery(text, secret_scan.encoding_of(text))) < 1e-3


def test_thresholds_hold_the_false_share():
    rng = random.Random(3)
    bins = Counter()
    for _ in range(500):
        p = rng.random()
        bins[sum(e < p for e in secret_scan.EDGES)] += 1
    for _ in range(2000):  # written strings, near 0
        p = rng.random() ** 12 * 0.3
        bins[sum(e < p for e in secret_scan.EDGES)] += 1
    low = secret_scan.thresholds({"s": dict(bins)}, 0.05)["s"]
    assert 0.01 <= low <= 0.4
    assert secret_scan.thresholds({"s": {0: 50}}, 0.05) == {}


def random_text(rng, secrets):
    words = [rng.choice(["the", "word", "thinghertheaterandthere", "of", "long-hyphenated-word-number-2"]) for _ in range(30)]
    return " ".join(words[:15] + secrets + words[15:])


def test_scan_finds_random_strings_and_keeps_base_spans(docs_of, odd_rows):
    rng = random.Random(4)
    letters = secret_scan.ALPHABETS["base62"]
    rows = list(odd_rows)
    planted = {}
    for i in range(100, 300):
        secret = "".join(rng.choices(letters, k=38)) + "a1B"
        planted[i] = secret
        rows.append((i, random_text(rng, [secret])))
    rows += [(i, random_text(rng, [])) for i in range(300, 500)]
    rows += [(500, 'x token = "%s" y' % ("0123456789abcdef" * 3))]
    text_of = dict(rows)
    found = {r["doc_id"]: r["secrets"] for r in secret_scan.find_secrets(docs_of(rows), keep=["doc_id"]).collect() if r["doc_id"] not in (1, None)}
    hit = sum(any(text_of[i][s["start"] : s["stop"]] == planted[i] for s in found[i]) for i in planted)
    assert hit >= 0.9 * len(planted)
    assert sum(len(found[i]) for i in range(300, 500)) == 0
    assert not found[2] and not found[3] and not found[4]
    for i, text in text_of.items():
        if i in found:
            assert [(s["start"], s["rank"], s["stop"]) for s in found[i] if s["rank"] < 3] == stated_spans(text or "")
            assert found[i] == sorted(found[i], key=lambda s: (s["start"], s["rank"]))
    assert [s["kind"] for s in found[500]] == ["assign", "hex"]


def key_with(rng, encoding, length, low, high):
    """A random string of just this encoding with a p-value between these."""
    while True:
        key = "".join(rng.choices(secret_scan.ALPHABETS[encoding], k=length))
        if secret_scan.encoding_of(key) == encoding and low < secret_scan.combined(secret_scan.battery(key, encoding)) < high:
            return key


@pytest.mark.parametrize("place", [(0.4, 0.45), (0.9, 0.95)])
def test_a_hot_string_counts_once(docs_of, place):
    """Neither are keys lost nor written strings let pass because one key stands in many documents."""
    rng = random.Random(6)
    hot = key_with(rng, "base62", 40, *place)
    keys = [key_with(rng, "base62", 40, (i + 0.2) / 150, (i + 0.8) / 150) for i in range(150)]
    written = [key_with(rng, "base62", 40, 0, 0.02) for _ in range(150)]
    rows = list(enumerate(keys + written)) + [(1000 + i, f"a {hot} b") for i in range(2000)]
    found = {r["doc_id"] for r in secret_scan.find_secrets(docs_of(rows), keep=["doc_id"]).filter("size(secrets) > 0").select("doc_id").collect()}
    assert found >= set(range(1000, 3000))
    assert len(found & set(range(150))) >= 135
    assert len(found & set(range(150, 300))) <= 15


def test_a_lone_key_of_each_stratum_is_found(docs_of):
    """Keys with p-values below one half, each the only string of its encoding and length."""
    rng = random.Random(7)
    keys = {i: key_with(rng, encoding, length, 0.02, 0.5) for i, (encoding, length) in enumerate((e, n) for e in secret_scan.ALPHABETS for n in (28, 50, 100))}
    found = {r["doc_id"]: r["secrets"] for r in secret_scan.find_secrets(docs_of([(i, f"a {key} b") for i, key in keys.items()])).collect()}
    assert [i for i in keys if (2, 2 + len(keys[i])) not in {(s["start"], s["stop"]) for s in found[i]}] == []


def test_few_written_strings_have_a_threshold_that_stops_them():
    at = lambda p: sum(e < p for e in secret_scan.EDGES)
    assert secret_scan.all_thresholds({"s": {0: 50}}, 0.05)["s"] == secret_scan.LEAST_P
    assert secret_scan.all_thresholds({"s": {at(0.3): 1}}, 0.05)["s"] == secret_scan.LEAST_P
    assert secret_scan.all_thresholds({"s": {at(0.03): 200, at(0.3): 3}}, 0.05)["s"] >= 0.03


def test_query_digest_and_columns(spark):
    from linewright.llm.common import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op1_secret_scan"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = stated_spans(texts[r["doc_id"]])
        line = ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == n for _, k, _ in base) for n in range(3))
        assert not line or set(line.split(",")) <= set(r["spans"].split(","))


def test_redact(spark):
    secret = "0123456789abcdef" * 2
    rows = [
        (1, f"a token={secret} b AKIA{'ABCDEFGH' * 2} c", "keep", 7),
        (2, "clean text", None, 10),
        (3, None, "x", None),
        (4, "", "y", 0),
        (5, f"é😀 {secret}", "z", 1),
        (5, f"é😀 {secret}", "z", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, secrets string, n_chars long")
    out = secret_scan.redact(docs)
    assert out.columns == docs.columns
    first = "a [secret] b [secret] c"
    want = [(1, first, "keep", len(first)), rows[1], rows[2], rows[3], (5, "é😀 [secret]", "z", 11), (5, "é😀 [secret]", "z", 11)]
    assert Counter(map(tuple, out.collect())) == Counter(want)
    assert secret_scan.redact(docs.filter("doc_id > 9")).count() == 0


def test_a_column_that_clashes_is_an_error(docs_of):
    with pytest.raises(ValueError):
        secret_scan.find_secrets(docs_of(["a"]).withColumnRenamed("doc_id", "secrets"))
