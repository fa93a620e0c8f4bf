import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from llm_helpers import docs  # noqa: F401

from llm import sketch as sk
from llm.common import documents


def shingles(t):
    w = (t or "").encode().split()
    e = min(5, len(w))
    return {b" ".join(w[i : i + e]) for i in range(len(w) - e + 1)} if e else set()


def likeness(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    """{doc_id: (text, edited text, next text)} for distinct ids."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1] or ""
        t = t or ""
        half = len(t) // 2
        out[i] = (t, t[: len(t) - half] + following[:half], following)
    return out


def check(rows, got):
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        text, changed, following = want[r.doc_id]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.fingerprint == sk.text_of(sk.sketch(text)) and r.edited_fingerprint == sk.text_of(sk.sketch(changed))
        for found, true in ((r.near_edited, likeness(text, changed)), (r.near_next, likeness(text, following))):
            small = len(shingles(text) | shingles(changed) | shingles(following)) <= sk.K
            assert abs(found - true) <= (1e-9 if small else 0.2)


def test_hashes_do_not_depend_on_windows(monkeypatch):
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdé😀") for _ in range(rng.randint(1, 30))) for _ in range(3000)) + " \t\x0b" + "x" * 9000 + " end"
    whole = sk.word_hashes(text.encode())
    assert len(whole) == len(text.encode().split())
    monkeypatch.setattr(sk, "WINDOW", 500)
    assert np.array_equal(whole, sk.word_hashes(text.encode()))
    assert len(set(whole.tolist())) == len(set(text.encode().split()))


def test_estimates_and_merging():
    rng = random.Random(2)
    words = [f"w{rng.randrange(100000)}" for _ in range(6000)]
    a, b = " ".join(words[:4000]), " ".join(words[2000:])
    x, y = sk.sketch(a), sk.sketch(b)
    assert abs(sk.resemblance(x, y) - likeness(a, b)) < 0.15
    assert abs(sk.containment(x, y) - len(shingles(a) & shingles(b)) / len(shingles(a))) < 0.2
    assert abs(sk.distinct_count(x) / len(shingles(a)) - 1) < 0.3
    parts = sk.merge(sk.smallest(sk.shingle_hashes(a)), sk.smallest(sk.shingle_hashes(b)))
    assert np.array_equal(parts, sk.smallest(np.concatenate([sk.shingle_hashes(a), sk.shingle_hashes(b)])))
    assert np.array_equal(sk.of_text(sk.text_of(x)), x)


def test_small_sketches_are_exact():
    a, b = "a b c d e f g", "a b c d e f h"
    assert sk.resemblance(sk.sketch(a), sk.sketch(b)) == likeness(a, b)
    assert sk.containment(sk.sketch(a), sk.sketch(b)) == 2 / 3
    assert sk.resemblance(sk.sketch(""), sk.sketch(None)) == 1.0 and sk.resemblance(sk.sketch(""), sk.sketch("a")) == 0.0


def test_odd_rows(docs):  # noqa: F811
    rows = [(0, "a b c d e f"), (3, None), (4, ""), (5, "x"), (-7, "é😀 " * 50), (2**62, "long word " * 20_000), (None, "no id here")]
    rows += [(100 + 3 * k, f"text {k} " * (k % 11)) for k in range(150)]
    check(rows, sk.fingerprint_pairs(docs(rows)).collect())
    one = sk.fingerprint_pairs(docs([(5, "a b c d")])).collect()
    assert one[0].near_next == 1.0
    assert sk.fingerprint_pairs(docs([])).count() == 0


def test_repeated_ids_follow_each_other(docs):  # noqa: F811
    rows = [(7, "same words in here now"), (7, "same words in here now"), (7, "other"), (1, "last one")]
    got = sk.fingerprint_pairs(docs(rows)).collect()
    assert sorted(r.doc_id for r in got) == [1, 7, 7, 7]
    assert len({r.fingerprint for r in got}) == 3


def test_one_id_lies_in_several_ranges(spark, docs):  # noqa: F811
    """Rows of one id, and rows without an id, are dealt out by their texts' hashes, and still follow each other."""
    rows = [(7, f"text number {k} of many") for k in range(4000)] + [(None, f"no id {k}") for k in range(3000)]
    rows += [(k, f"other {k}") for k in range(100, 200)]
    df = docs(rows)
    dealt = sk.neighbours(df).filter("NOT guest").groupBy("range").count().collect()
    assert len(dealt) >= 12 and max(r["count"] for r in dealt) < 1500
    hashed = {r.text: r.h for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashed[r[1]]))
    want = {t: sk.edited(t, order[(k + 1) % len(order)][1]) for k, (_, t) in enumerate(order)}
    got = sk.fingerprint_pairs(df).collect()
    assert sorted(r.edited_sha256 for r in got) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in want.values())
    assert {r.fingerprint for r in got} == {sk.text_of(sk.sketch(t)) for _, t in rows}


def test_text_ids(spark):
    rows = [("b", "one two three"), ("a", "four five"), ("é", "six"), (None, "seven eight"), ("aa", None), ("", "nine")]
    got = sk.fingerprint_pairs(spark.createDataFrame(rows, "name string, body string"), "name", "body").collect()
    order = ["é", "b", "aa", "a", "", None]
    text = {i: t or "" for i, t in rows}
    want = {i: sk.edited(text[i], text[order[(k + 1) % len(order)]]) for k, i in enumerate(order)}
    assert {r.doc_id: r.edited_sha256 for r in got} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in want.items()}


def test_whole_table(spark, folder):
    df = documents(spark, folder)
    check([(r.doc_id, r.text) for r in df.collect()], sk.fingerprint_pairs(df).collect())
