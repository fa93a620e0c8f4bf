import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_helpers import docs  # noqa: F401

from llm import simhash as sh
from llm.common import documents
from llm.components import components


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    """doc_id -> smallest id reachable, by comparing all pairs."""
    fps = [slow_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    a = np.array(fps, dtype=np.uint64)
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 4):
            x, y = find(i), find(int(j))
            root[max(x, y)] = min(x, y)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            smallest[find(i)] = min(smallest.get(find(i), d), d)
    return sorted(((d, f"{f:016x}", smallest.get(find(i))) for i, ((d, _), f) in enumerate(zip(rows, fps))), key=str)


def test_fingerprints():
    rng = random.Random(5)
    for t in ["", None, "One", "a B\tc", "a b c d", "É a\x0bb  c d e f", " ".join(rng.choice("abcdef") for _ in range(5000))]:
        assert sh.fingerprint(t) == slow_fingerprint(t)


@pytest.mark.parametrize("wide", [False, True])
def test_every_pair_within_the_distance_shares_a_key(wide):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    b = a.copy()
    for k in range(4):
        move = rng.random(len(a)) < 0.9
        b ^= np.where(move, np.uint64(1) << rng.integers(0, 64, len(a)).astype(np.uint64), np.uint64(0))
    (ka, ra), (kb, rb) = sh.keys(a, wide), sh.keys(b, wide)
    left, right = set(zip(ra.tolist(), ka.tolist())), set(zip(rb.tolist(), kb.tolist()))
    assert {r for r, _ in left & right} == set(range(len(a)))


def test_golay_distances():
    words = np.arange(0, 2**23, 997)
    index = sh.golay().indices(words)
    code = (index << 11) | np.where(index >= 0, sh.golay().check[index], 0)
    distance = np.bitwise_count(code ^ words[:, None])
    assert (distance[:, 0] <= 3).all() and (distance[index >= 0] <= 4).all()
    assert set((index >= 0).sum(axis=1).tolist()) <= {1, 6}


def clusters(n=600):
    """Fingerprints in chains and dense groups, as signed numbers."""
    rng = random.Random(9)
    out = set()
    for _ in range(6):
        f = rng.getrandbits(64)
        for _ in range(n // 6):
            out.add(f if f < 2**63 else f - 2**64)
            g = f
            for _ in range(rng.randint(1, 6)):
                g ^= 1 << rng.randrange(64)
            f = g if rng.random() < 0.6 else f
            out.add(g if g < 2**63 else g - 2**64)
    return sorted(out)


def linked(spark, fps, **more):
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    roots = {r.node: r.root for r in components(sh.links(df, **more)).collect()}
    return sorted({f: roots.get(f, f) for f in fps}.items())


def test_links_with_and_without_blocks(spark):
    fps = clusters()
    a = np.array(fps, dtype=np.int64).view(np.uint64)
    label = list(range(len(fps)))
    for _ in range(len(fps)):
        new = [min(label[j] for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 4)) for i in range(len(fps))]
        if new == label:
            break
        label = new
    want = sorted((f, fps[label[i]]) for i, f in enumerate(fps))
    assert linked(spark, fps) == want
    assert linked(spark, fps, block=3) == want
    assert linked(spark, fps, wide=True) == want
    assert linked(spark, fps, block=3, wide=True) == want


def test_long_keys_are_more_and_rarer():
    """Keys and pairs under them for 40,000 random fingerprints, with and without the third segment."""
    fps = np.random.default_rng(3).integers(0, 2**64, 40_000, dtype=np.uint64)
    seen = {}
    for wide in (False, True):
        key, _ = sh.keys(fps, wide)
        times = np.unique(key, return_counts=True)[1]
        seen[wide] = len(key) / len(fps), (times * (times - 1) // 2).sum()
    assert 2 < seen[True][0] / seen[False][0] < 5 and seen[True][1] < seen[False][1] / 10


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 50 + k) for k in range(30)] + [(7, 7), (3, 2), (3, 2)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{50 + k: 50 for k in range(30)}, 100: 50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def odd_rows():
    rng = random.Random(2)
    base = [rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rng.randrange(50)) for _ in range(300)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "one"), (4, "ONE"), (5, "one two"), (None, "one"), (6, "w " * 30_000), (7, "w w w w w")]
    for k in range(60):
        words = list(base)
        for _ in range(rng.randrange(3)):
            words[rng.randrange(300)] = f"new{k}"
        rows.append((10 + k, " ".join(words)))
    return rows + [(20, rows[-1][1])] * 3


def test_odd_rows(docs):
    rows = odd_rows()
    got = sh.near_groups(docs(rows))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_components(rows)


def test_one_of_each_group_stays(docs):
    rows = odd_rows()
    df = docs(rows)
    out = sh.near_dedup(df)
    assert out.columns == df.columns
    kept = [r.doc_id for r in out.collect()]
    assert sorted(kept) == sorted({c for _, _, c in brute_components(rows)})
    assert sh.near_dedup(docs([])).count() == 0 and sh.near_groups(docs([])).count() == 0


def test_whole_table(spark, folder):
    df = documents(spark, folder)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert sorted([tuple(r) for r in sh.near_groups(df).collect()], key=str) == brute_components(rows)
    assert df.select(F.count("*")).first()[0] == len(rows)
