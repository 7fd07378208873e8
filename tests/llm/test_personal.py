import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from linewright.llm import personal_data
from linewright.llm.personal_data import base_spans, bootstrapped_pii, find_personal, luhn, occurrences

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def stated(text):
    """The fixed patterns as they are stated."""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(found)


def test_luhn():
    assert luhn("4929348385146306") and luhn("79927398713") and not luhn("79927398710")


def test_fixed_patterns_equal_their_statement():
    rng = random.Random(11)
    for alphabet in ("a@.-_1 2+()%9é\n", "0123456789. -", "+1 (23) 45-6.", "ab@c.d"):
        for _ in range(4000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
            assert base_spans(text) == stated(text), text


@pytest.mark.parametrize("text", ["x" * 300_000, "1" * 100_000, "a@" * 100_000, "+1" * 100_000, "1." * 100_000, "1 " * 100_000, "+1" + " " * 300_000])
def test_long_texts_take_time_in_proportion(text):
    assert occurrences(text, base_spans(text)) is not None


@pytest.fixture(scope="module")
def planted(docs_of):
    """Emails, phones and handles after the same words; numbers elsewhere; a clean corpus around them."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeghilmnoprstu") for _ in range(rng.randrange(3, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    rows, hidden, plain = [], {}, []
    for k in range(60):
        rows.append(f"{text(20)} please write to {word()}.{k}@mail{k % 7}.example.com for more {text(20)}")
        rows.append(f"{text(15)} call us at +1 (2{k:02d}) 555-{1000 + 37 * k} any time {text(9)}")
    for k in range(5):
        handle = f"{word()}_at_{word()}{k}77"
        hidden[len(rows)] = handle
        rows.append(f"{text(12)} Please write to: {handle}, for more {text(12)}")
    for k in range(40):
        plain.append(len(rows))
        rows.append(f"{text(10)} order {100000 + 71 * k} was {word()} {text(10)} part {word()}{70000 + k} of {text(4)}")
    return docs_of(rows), hidden, plain


def test_contexts_discover_unseen_identifiers_and_leave_others_alone(planted):
    docs, hidden, plain = planted
    found = {r["doc_id"]: r["personal"] for r in find_personal(docs, keep=["doc_id", "text"]).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for k, handle in hidden.items():
        (span,) = found[k]
        assert texts[k][span["start"] : span["stop"]] == handle
        assert span["kind"] == "context" and span["like"] == "email" and span["score"] >= personal_data.KNOWN
    assert not any(found[k] for k in plain)
    assert all(found[k][0]["kind"] in ("email", "phone") and found[k][0]["score"] == 1 for k in range(120))


def test_known_candidates_raise_further_patterns(docs_of):
    """Handles that the first pattern finds are enough to prove a second, which stands beside no seed."""
    rows = [f"send it to name{k}@host.example.org by friday" for k in range(60)]
    rows += [f"send it to user_{k}xyz by friday" for k in range(9)]
    rows += [f"profile of user_{k}xyz is public" for k in range(9)]
    rows += ["profile of agent_77abc is public"]
    found = {r["doc_id"]: [s["kind"] for s in r["personal"]] for r in find_personal(docs_of(rows), keep=["doc_id"]).collect()}
    assert all(found[k] == ["context"] for k in range(60, 79))


def test_score_is_the_stated_graph_score(spark):
    """Two rounds beside a plain calculation."""
    rng = random.Random(3)
    rows = [(f"c{rng.randrange(40)}", f"p{rng.randrange(9)}") for _ in range(260)]
    kind_of = {c: (0 if int(c[1:]) < 33 else 1 if int(c[1:]) < 35 else -1) for c, _ in rows}
    seen = spark.createDataFrame([(c, kind_of[c], [p]) for c, p in rows], "candidate string, kind int, patterns array<string>")
    good, found = personal_data.bootstrap(seen, rounds=2)
    edges = set(rows)
    known = {(c, k): 1.0 for c, k in kind_of.items() if k >= 0}

    def wilson(x, n, z=personal_data.Z):
        s = x / n
        return (s + z * z / (2 * n) - z * (s * (1 - s) / n + z * z / (4 * n * n)) ** 0.5) / (1 + z * z / n)

    for _ in range(2):
        patterns = {}
        for p in {p for _, p in edges}:
            members = [c for c, q in edges if q == p]
            for k in (0, 1):
                value = wilson(sum(known.get((c, k), 0) for c in members), len(members))
                if len(members) > 1 and value >= personal_data.GOOD_PATTERN:
                    patterns[p, k] = value
        score = {}
        for c, k in kind_of.items():
            if k >= 0:
                continue
            options = []
            for kind in (0, 1):
                miss = 1.0
                for p in {q for d, q in edges if d == c}:
                    miss *= 1 - patterns.get((p, kind), 0)
                options.append((1 - miss, -kind))
            if max(options)[0] >= personal_data.KNOWN:
                score[c, -max(options)[1]] = max(options)[0]
        known = {(c, k): 1.0 for c, k in kind_of.items() if k >= 0} | score
    assert {(r["pattern"], r["kind"]): round(r["confidence"], 9) for r in good.collect()} == {k: round(v, 9) for k, v in patterns.items()}
    assert {(r["candidate"], r["kind"]): round(r["score"], 9) for r in found.collect()} == {k: round(v, 9) for k, v in score.items()}
    assert score


def test_odd_rows(docs_of, odd_rows):
    docs = docs_of([*odd_rows, (9, "+1 (234) 555-1234, 4929348385146306, a.b@c.de 10.0.0.255; 10.0.0.256")]).withColumn("own", F.lit(1)).withColumn("found", F.lit(2)).withColumn("uid", F.lit(3))
    out = find_personal(docs).collect()
    assert out[0].asDict().keys() == {"doc_id", "text", "own", "found", "uid", "personal"}
    assert len(out) == len(odd_rows) + 1 and {(r["own"], r["found"], r["uid"]) for r in out} == {(1, 2, 3)}
    assert [s["kind"] for r in out if r["doc_id"] == 9 for s in r["personal"]] == ["phone", "card", "email", "ip"]
    assert all(r["personal"] == [] for r in out if not r["text"])
    with pytest.raises(ValueError):
        find_personal(docs, spans="OWN")
    assert find_personal(docs_of([])).collect() == []


def test_query_equals_the_stated_patterns_on_whole_tables(spark):
    folder = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in bootstrapped_pii(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(docs)
    for row in docs:
        spans = stated(row["text"] or "")
        base = ",".join(f"{personal_data.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        mine = got[row["doc_id"]]
        assert [mine[f"n_{k}"] for k in personal_data.SEEDS] == [sum(s[1] == i for s in spans) for i in range(4)]
        assert mine["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(mine["spans"].split(","))
