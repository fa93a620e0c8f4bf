import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm import hard_negatives as hn
from llm.common import table

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        *[T.StructField(c, T.IntegerType()) for c in ("row", "anchor", "score", "rank", "shard", "vector", "id")],
    ]
)


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, *[7] * 7) for r in rows], SCHEMA)


def brute(rows, is_anchor, positives=5, negatives=3, low=50, high=95):
    """All scores of every anchor, in Python's whole numbers."""
    kept = []
    for k, (i, v, label) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((k, i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    for k, i, v, label in kept:
        if i is None or not is_anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j is None, j or 0, m, j, other) for m, j, w, other in kept if m != k]
        scored.sort(key=lambda s: s[:4])
        for p in [s for s in scored if s[5] == label][:positives]:
            fit = [n for n in scored if n[5] != label and low * -p[0] <= 100 * -n[0] <= high * -p[0]]
            out += [(i, p[4], rank, n[4], -p[0], -n[0]) for rank, n in enumerate(fit[:negatives], 1)]
    return sorted(out, key=str)


COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def found(df):
    return sorted([tuple(r) for r in df.select(*COLUMNS).collect()], key=str)


def random_rows(seed, n, width=12, labels=4):
    rng = random.Random(seed)
    common = [rng.gauss(0.2, 0.2) for _ in range(width)]
    rows = []
    for i in range(n):
        v = [rng.gauss(0, 0.3) + 0.1 for _ in range(width)] if rng.random() < 0.6 else list(common)
        rows.append((i, v, rng.randrange(labels)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_scores(spark, seed):
    rows = random_rows(seed, 300)
    got = hn.mine(rows_of(spark, rows), F.col("vec_id") % 10 == 0, most=600, least=200)
    want = brute(rows, lambda i: i % 10 == 0)
    assert want and found(got) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = random_rows(5, 80, 6)
    rows += [(100, None, 1), (110, [1.0, None], 1), (120, [nan, 1.0], 1), (130, [inf], 2), (140, [-inf], 2), (150, [1.0], None)]
    rows += [(160, [], 1), (170, [0.5, 0.5], 1), (180, [0.0] * 6, 2), (None, [0.3] * 6, 1), (None, [0.2] * 9, 2), (190, [-0.4] * 6, 3)]
    got = hn.mine(rows_of(spark, rows).repartition(1), F.col("vec_id") % 10 == 0, most=100, least=50)
    assert found(got) == brute(rows, lambda i: i % 10 == 0)


def test_rows_that_repeat_an_id(spark):
    rows = random_rows(6, 40, 4, 2)
    rows += [rows[10], (20, rows[3][1], rows[20][2]), (20, rows[4][1], 1 - rows[20][2])]
    got = hn.mine(rows_of(spark, rows).coalesce(1), F.col("vec_id") % 10 == 0)
    assert found(got) == brute(rows, lambda i: i % 10 == 0)


def test_few_rows(spark):
    assert found(hn.mine(rows_of(spark, []), F.lit(True))) == []
    one = [(0, [0.5], 1)]
    assert found(hn.mine(rows_of(spark, one), F.lit(True))) == []
    rows = [(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2), (3, [0.95], 2), (4, [0.96], 2), (5, [-1.0], 3)]
    assert found(hn.mine(rows_of(spark, rows), F.col("vec_id") == 0)) == [(0, 1, 1, 3, 65536, 62208), (0, 1, 2, 2, 65536, 32768)]
    assert found(hn.mine(rows_of(spark, rows), F.lit(None).cast("boolean"))) == []


def test_large_components(spark):
    rows = [(0, [3e9, 1.0], 1), (1, [3e9, 2.0], 1), (2, [2e6, 3.0], 2)]
    with pytest.raises(ValueError, match="63 bits"):
        hn.mine(rows_of(spark, rows), F.col("vec_id") == 0)
    rows = [(0, [5e4, 1.0], 1), (1, [5e4, 2.0], 1), (2, [3e4, 3.0], 2), (3, [4.9e4, 3.0], 2)]
    assert found(hn.mine(rows_of(spark, rows), F.col("vec_id") == 0)) == brute(rows, lambda i: i == 0)


def test_window():
    for s in range(-300, 300):
        low, high = hn.window(s)
        assert [n for n in range(-400, 400) if 50 * s <= 100 * n <= 95 * s] == list(range(low, high + 1))


def test_candidates_fall_out_before_the_last_dimension():
    """With a few strong dimensions most rows leave the bitmap early, and none that counts does."""
    rng = np.random.default_rng(1)
    n, width = 5000, 64
    vectors = np.rint(rng.normal(0, 3, (n, width)))
    vectors[:, :8] = np.rint(rng.normal(0, 200, (n, 8)))
    label = rng.integers(0, 3, n)
    shard = hn.Shard(np.arange(n), np.arange(n), np.zeros(n, dtype=bool), label, vectors)
    anchor = vectors[0].copy()
    seen = []
    places, score = shard.scan(anchor, np.ones(n, dtype=bool), lambda low, high: seen.append(len(low)) or high >= np.sort(low)[-5])
    assert seen[0] == n and seen[2] < n / 10
    scores = vectors[shard.row] @ anchor
    assert set(np.argsort(-scores, kind="stable")[:5]) <= set(places.tolist()) and (scores[places] == score).all()


def test_whole_table(spark, folder):
    df = table(spark, folder, "embeddings")
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in df.collect()]
    from llm.queries import QUERIES

    assert found(QUERIES["op11_hard_negatives"](spark, folder)) == brute(rows, lambda i: i % 50 == 0)
