import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm_helpers import docs  # noqa: F401

from llm import ngram_join as nj
from llm.common import documents


def slow_set(text, k=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, percent=85):
    """(doc_id, set size, smallest id reachable) per row, by comparing all pairs."""
    sets = [slow_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted([(d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))], key=str)


def found(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()], key=str)


def corpus(rng, n):
    """Texts with near copies at all distances, a line and a passage that many share, and odd ones."""
    words = [f"w{i}" for i in range(400)]
    line = " ".join(rng.choices(words, k=12))
    passage = " ".join(rng.choices(words, k=60))
    texts = [None, "", " \t\n", "One two", "one TWO", "one two three four", "a", "É é", "é  x"]
    while len(texts) < n:
        base = rng.choices(words, k=rng.choice([5, 20, 60, 150]))
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(copy) // 20)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(rng.choice(["", line + " ", passage + " "]) + " ".join(copy) + rng.choice(["", " " + line]))
    return texts[:n]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(docs, seed):
    rng = random.Random(seed)
    rows = [(i * 3 % 700, t) for i, t in enumerate(corpus(rng, 500))]
    rows += [(None, rows[40][1]), (None, "lonely text"), (None, None), (5, rows[20][1]), (5, rows[20][1])]
    assert found(nj.similar_groups(docs(rows))) == brute(rows)


def test_small_groups_and_slots_lose_nothing(docs, monkeypatch):
    monkeypatch.setattr(nj, "SLOT", 7)
    monkeypatch.setattr(nj, "LEAST_FREQUENT", 3)
    monkeypatch.setattr(nj, "PAIRS_AT_ONCE", 50)
    monkeypatch.setattr(nj, "BROADCAST_ROWS", 3)
    monkeypatch.setattr(nj.candidates, "__defaults__", (85, 7))
    rng = random.Random(3)
    base = rng.choices([f"w{i}" for i in range(300)], k=80)
    near = []
    for _ in range(120):
        copy = list(base)
        for _ in range(rng.randrange(0, 6)):
            copy[rng.randrange(80)] = rng.choice("xyz")
        near.append(" ".join(copy))
    rows = list(enumerate(corpus(rng, 150) + near))
    assert found(nj.similar_groups(docs(rows), group_tokens=500)) == brute(rows)


def test_the_edge_of_the_threshold(docs):
    def text(shared, own):
        return " ".join([f"s{i}" for i in range(shared)] + [f"{own}{i}" for i in range(9)])

    # 85 of 100 shingles shared is linked, 84 of 100 is not
    a = " ".join(f"s{i}" for i in range(88))
    b = a + "".join(f" t{i}" for i in range(15))
    c = a + "".join(f" u{i}" for i in range(16))
    rows = [(1, a), (2, b), (3, c), (4, text(0, "q")), (5, text(0, "r"))]
    assert len(slow_set(a)) == 85 and len(slow_set(b)) == 100
    got = found(nj.similar_groups(docs(rows)))
    assert got == brute(rows) and [r[2] for r in got] == [1, 1, 3, 4, 5]


def test_prefixes_hold_what_linked_sets_share():
    rng = np.random.default_rng(4)
    for _ in range(300):
        n = int(rng.integers(1, 120))
        common = rng.integers(0, 2**64, n, dtype=np.uint64)
        one = np.unique(np.concatenate([common, rng.integers(0, 2**64, int(rng.integers(0, 2 + n // 6)), dtype=np.uint64)]))
        two = np.unique(np.concatenate([common, rng.integers(0, 2**64, int(rng.integers(0, 2 + n // 6)), dtype=np.uint64)]))
        often = rng.permutation(np.concatenate([common[: n // 2], rng.integers(0, 2**64, 5, dtype=np.uint64)]))
        order = nj.Order([(int(t), 9) for t in often.view(np.int64)])
        both = len(np.intersect1d(one, two))
        if 100 * both >= 85 * (len(one) + len(two) - both):
            (p, least), (q, other) = order.prefix(one), order.prefix(two)
            assert len(np.intersect1d(p, q)) >= min(least, other) >= 1


def test_groups_of_copies_are_opened_once(spark, docs):
    """A thousand near copies and a line in every text: rows that meet stay near the number of sets."""
    rng = random.Random(6)
    base = [f"b{i}" for i in range(100)]
    line = " ".join(f"l{i}" for i in range(10))
    rows = []
    for i in range(1000):
        copy = list(base)
        copy[rng.randrange(100)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, line + " " + " ".join(f"y{i}_{k}" for k in range(30))) for i in range(500)]
    df = docs(rows)
    marks = nj.mark(df, "doc_id", "text")
    order = nj.Order(nj.frequent(marks))
    sets = marks.filter("n > 0").select("n", "bands", F.col("doc_id").alias("num"), "set_id").cache()
    grouped = nj.groups(sets).cache()
    assert grouped.count() > 900 and grouped.select("grp").distinct().count() < 20
    numbered = sets.select("num", "set_id").join(grouped, "num", "left").withColumn("grp", F.coalesce("grp", "num"))
    prefixes = nj._arrays(df, "text", 4, order, 85).join(numbered, "set_id").cache()
    assert nj.candidates(prefixes, order).count() < 3000
    got = found(nj.similar_groups(df))
    assert {r[2] for r in got if r[0] < 1000} == {0} and all(r[2] == r[0] for r in got if r[0] >= 1000)


def test_empty_table_and_text_ids(spark, docs):
    assert found(nj.similar_groups(docs([]))) == []
    names = spark.createDataFrame(
        [("b", "one two three four five", 1), ("a", "one two  three FOUR five", 2), (None, "", 3)],
        T.StructType([T.StructField("key", T.StringType()), T.StructField("body", T.StringType()), T.StructField("n", T.LongType())]),
    )
    got = nj.similar_groups(names, "key", "body").collect()
    assert sorted([tuple(r) for r in got], key=str) == [("a", 2, "a"), ("b", 2, "a"), (None, 0, None)]


def test_very_long_text(docs):
    long = " ".join(f"w{i}" for i in range(200_000))
    rows = [(1, long), (2, long + " more words here"), (3, "short text of five words")]
    assert [r[2] for r in found(nj.similar_groups(docs(rows)))] == [1, 1, 3]


def test_whole_table(spark, folder):
    df = documents(spark, folder)
    assert found(nj.similar_groups(df)) == brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
