import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from llm_helpers import docs  # noqa: F401

from llm import exact_dedup as ed
from llm.common import documents


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def brute(rows):
    """[(doc_id, keep_id, group_size)] of (doc_id, text) rows."""
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i))
    best = {k: min(v, key=lambda x: (x[0], x[1], x[2] or 0)) for k, v in groups.items()}
    return sorted(((i, best[norm(t)][2], len(groups[norm(t)])) for i, t in rows), key=str)


ODD = [
    (1, "a b"), (2, "ab"), (3, " a\tb "), (4, None), (5, ""), (6, "\n\x0b"), (7, "ab\xa0"), (7, "ab\xa0"), (None, "x"), (8, "x"),
    (9, "é" * 9000 + "cksC" * 3000), (10, " " + "é" * 9000 + "cksC" * 3000), (11, "é" * 9000 + "cksC" * 2999), (12, "😀 b"), (13, "😀b"),
]


def groups(df):
    numbered = df.withColumn("row_number", F.monotonically_increasing_id())
    return ed.dedup_groups(numbered, row="row_number")


def test_odd_rows(docs):
    got = groups(docs(ODD)).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size) for r in got], key=str) == brute(ODD)
    assert all(r.text_sha256 == hashlib.sha256(norm(dict(ODD)[r.doc_id]).encode()).hexdigest() for r in got)
    assert sum(r.kept for r in got) == len({norm(t) for _, t in ODD})


def test_only_one_of_repeated_rows_stays_with_all_columns(docs):
    df = docs([(1, "a b"), (1, "a b"), (2, "ab"), (3, None)])
    out = ed.exact_dedup(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 3]


def test_empty_table(docs):
    assert groups(docs([])).count() == 0 and ed.exact_dedup(docs([])).count() == 0


def test_chunks_join_to_the_text_and_follow_content(docs):
    rng = random.Random(4)
    body = "".join(rng.choice("etaoinshrdlcks") for _ in range(60_000))
    df = docs([(1, body), (2, "zzz" + body)]).select("doc_id", ed.chunks(ed.normalised(F.col("text"))).alias("c"))
    one, two = [r.c for r in df.orderBy("doc_id").collect()]
    assert "".join(one) == body and "".join(two) == "zzz" + body
    assert len(set(one) & set(two)) > len(one) / 2


@pytest.mark.parametrize("letters", ["оеаинтсрвлкмдпуябзг", "αβγδεηικλμνοπρσςτυω", "".join(map(chr, range(0x4E00, 0x9FA0, 97))), "ابتدرسعفقكلمنهوي", "가나다라마바사아자하한국어이다"])
def test_cuts_follow_content_in_other_scripts(docs, letters):
    rng = random.Random(7)
    body = "".join(rng.choice(letters) for _ in range(60_000))
    df = docs([(1, body), (2, letters[:3] * 5 + body)]).select("doc_id", ed.chunks(ed.normalised(F.col("text"))).alias("c"))
    one, two = [r.c for r in df.orderBy("doc_id").collect()]
    assert "".join(one) == body and len(one) > 20
    assert len(set(one) & set(two)) > len(one) / 2


def test_chunks_with_one_identifier_are_told_apart(spark, docs, monkeypatch):
    """With an identifier that says nothing, digests still keep different texts apart."""
    monkeypatch.setattr(ed.F, "xxhash64", lambda *c: F.lit(5).cast("long"))
    rows = [(i, t) for i, t in ODD if i is not None]
    got = groups(docs(rows)).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size) for r in got], key=str) == brute(rows)


def test_whole_table(spark, folder):
    rows = [(r.doc_id, r.text) for r in documents(spark, folder).collect()]
    got = groups(documents(spark, folder)).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size) for r in got], key=str) == brute(rows)


def test_no_python_in_the_plan(docs):
    plan = ed.exact_dedup(docs(ODD))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
