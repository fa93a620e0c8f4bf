"""Hard negatives by a vertical scan: dimensions are read one after the other, and candidates fall out early.

Rows are dealt out over shards, a shard's vectors lie in memory by dimension, and
anchors, a small part of the rows, are sent to every shard. For an anchor the
dimensions are read by descending magnitude of its own components. What the unread
ones can still add lies between sums of per-dimension extremes of the shard; rows
that can't reach the best places, or whose score can't fall into any window, leave
the bitmap of candidates. Scores are exact integers when the last dimension is read.

Two scans: the first finds each anchor's positives, the second, knowing their
scores, the rows of other labels in the window below each. A shard reports only as
many rows as are asked for, and those reports are combined by a window function.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import ship, staged

POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these shares of its positive's, per cent.
LOW, HIGH = 50, 95
#: Components are multiplied by it and rounded down.
SCALE = 256
#: Components of a shard: at most, and at least where there are tasks for more shards.
SHARD_MOST, SHARD_LEAST = 1 << 23, 1 << 18
#: Dimensions read between two looks at the candidates.
STEP = 8


class Shard:
    """Vectors by dimension, sorted by label, with the least and greatest component of each dimension."""

    def __init__(self, row: np.ndarray, id_: np.ndarray, no_id: np.ndarray, label: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(label, kind="stable")
        self.row, self.id, self.no_id, self.label = row[order], id_[order], no_id[order], label[order]
        self.dimensions = np.ascontiguousarray(vectors[order].T)
        self.least = self.dimensions.min(axis=1) if vectors.shape[0] else np.zeros(vectors.shape[1], vectors.dtype)
        self.most = self.dimensions.max(axis=1) if vectors.shape[0] else self.least

    def same_label(self, label: int) -> slice:
        return slice(int(np.searchsorted(self.label, label)), int(np.searchsorted(self.label, label, side="right")))

    def scan(self, anchor: np.ndarray, bitmap: np.ndarray, look) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact scores of the candidates in the bitmap that ``look`` never drops.

        look(low, high) sees the bounds of the candidates' scores and says which stay.
        """
        anchor = anchor[: len(self.dimensions)]
        order = np.argsort(-np.abs(anchor), kind="stable")
        order = order[anchor[order] != 0]
        ends = np.stack([anchor[order] * self.least[order], anchor[order] * self.most[order]])
        unread = np.zeros((2, len(order) + 1), dtype=anchor.dtype)
        unread[:, :-1] = np.cumsum(np.sort(ends, axis=0)[:, ::-1], axis=1)[:, ::-1]
        places = np.flatnonzero(bitmap)
        score = np.zeros(len(places), dtype=anchor.dtype)
        for k in range(0, len(order), STEP):
            if not len(places):
                break
            now = order[k : k + STEP]
            columns = self.dimensions[now]
            score = score + anchor[now] @ (columns if len(places) == columns.shape[1] else columns[:, places])
            low, high = unread[:, min(k + STEP, len(order))]
            stay = look(score + low, score + high)
            if not stay.all():
                bitmap[places[~stay]] = False
                places, score = places[stay], score[stay]
        return places, score

    def best(self, places: np.ndarray, score: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """The first places by score, then id, a missing one last, then row."""
        first = np.lexsort((self.row[places], self.id[places], self.no_id[places], -score))[:count]
        return places[first], score[first]

    def positives(self, anchor: np.ndarray, label: int, row: int, count: int) -> tuple[np.ndarray, np.ndarray]:
        bitmap = np.zeros(len(self.row), dtype=bool)
        bitmap[self.same_label(label)] = True
        bitmap[self.row == row] = False

        def look(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            return high >= np.partition(low, -count)[-count] if len(low) > count else np.ones(len(low), dtype=bool)

        return self.best(*self.scan(anchor, bitmap, look), count)

    def negatives(self, anchor: np.ndarray, label: int, windows: list[tuple[int, int]], count: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per window the best rows of other labels whose scores lie in it."""
        bitmap = np.ones(len(self.row), dtype=bool)
        bitmap[self.same_label(label)] = False

        def look(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            stay = np.zeros(len(low), dtype=bool)
            for a, b in windows:
                inside = low[(low >= a) & (high <= b)]
                least = max(a, np.partition(inside, -count)[-count]) if len(inside) >= count else a
                stay |= (high >= least) & (low <= b)
            return stay

        places, score = self.scan(anchor, bitmap, look)
        found = []
        for a, b in windows:
            inside = (score >= a) & (score <= b)
            found.append(self.best(places[inside], score[inside], count))
        return found


def window(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """Whole scores n with low * score <= 100 * n <= high * score."""
    return -(-low * score // 100), high * score // 100


# ------------------------------------------------------------------ rows to shards


def _vectors(column: pa.Array, kind: type) -> np.ndarray:
    """A matrix of the vectors, the shorter ones filled up with zeros."""
    size = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    wide = int(size.max(initial=0))
    if (size == wide).all():
        return flat.reshape(len(size), wide)
    out = np.zeros((len(size), wide), dtype=kind)
    out[np.arange(wide) < size[:, None]] = flat
    return out


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    wide = max(p.shape[1] for p in parts)
    return np.concatenate([np.pad(p, ((0, 0), (0, wide - p.shape[1]))) for p in parts])


def _meet(answer, kind: type):
    """Task over rows (shard, anchor, row, id, label, vector, scores) sorted by the first two: a shard's rows, then anchors."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, shard = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy(zero_copy_only=False) * 2 + batch.column(1).to_numpy(zero_copy_only=False)
            begins = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]]).tolist()
            found: list[tuple] = []
            for a, b in zip(begins[:-1], begins[1:]):
                rows = batch.slice(a, b - a)
                if key[a] // 2 != current:
                    current, parts, shard = key[a] // 2, [], None
                number, id_, label = (rows.column(k) for k in (2, 3, 4))
                no_id = id_.is_null().to_numpy(zero_copy_only=False)
                plain = [x.to_numpy(zero_copy_only=False) for x in (number, id_.fill_null(0), label)]
                vectors = _vectors(rows.column(5), kind)
                if key[a] % 2 == 0:
                    parts.append((plain[0], plain[1], no_id, plain[2], vectors))
                    continue
                if shard is None and parts:
                    shard = Shard(*[np.concatenate(x) for x in list(zip(*parts))[:4]], _joined([p[4] for p in parts]))
                    parts = []
                if shard is not None:
                    for row, of, vector, scores in zip(plain[0].tolist(), plain[2].tolist(), vectors, rows.column(6).to_pylist()):
                        found += [(row, *x) for x in answer(shard, vector, of, row, scores)]
            columns = [pa.array([f[k] for f in found], pa.int64()) for k in range(len(_FOUND))]
            yield pa.RecordBatch.from_arrays(columns, names=_FOUND)

    return task


_FOUND = ["anchor", "place", "score", "id", "row"]


def _rows(shard: Shard, place: int, places: np.ndarray, score: np.ndarray) -> Iterator[tuple]:
    for p, s in zip(places.tolist(), score.tolist()):
        yield place, int(s), None if shard.no_id[p] else int(shard.id[p]), int(shard.row[p])


def _ranked(found: DataFrame, *group: str, count: int) -> DataFrame:
    order = [F.desc("score"), F.col("id").asc_nulls_last(), F.col("row")]
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("rank") <= count)


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """Components times ``scale``, rounded down to whole numbers."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def usable(label: Column, vector: Column) -> Column:
    """Rows with a label and a vector of finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return label.isNotNull() & vector.isNotNull() & F.forall(vector, finite)


def mine(
    rows: DataFrame, anchor: Column, id_col: str = "vec_id", label: str | Column = "label", vector: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, most: int = SHARD_MOST, least: int = SHARD_LEAST,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the anchors, rows where ``anchor`` holds.

    An anchor's positives are the first other rows of its label; the negatives of a
    positive the first rows of other labels with low * positive_score <= 100 *
    negative_score <= high * positive_score. Higher scores come first, of equal ones
    the smaller id, a missing id last, and of rows that share an id the one stored
    first. Ids and labels are whole numbers; rows that repeat an id are rows of their
    own, also as anchors. A positive without negatives gives no row.

    Rows with a missing label or vector, or with a component that is missing or not
    finite, take no part. Vectors of different length are compared over the
    dimensions both have. An empty table, or one without anchors, gives no rows.
    Further columns are left out, whatever their names. Scores that could leave 63
    bits stop the job with a ValueError. Anchors go to every shard, so their number
    times the shards is what moves: a shard is as large as a task may hold.
    """
    spark = rows.sparkSession
    ship(spark)
    of = F.col(label) if isinstance(label, str) else label
    taken = rows.filter(usable(of, F.col(vector))).select(
        F.col(id_col).cast("long").alias("id"), of.cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(vector).alias("vector"),
    )
    size = F.coalesce(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double")))), F.lit(0.0))
    vectors = staged(
        taken.select("*", size.alias("largest"), F.monotonically_increasing_id().alias("row")).withColumn("vector", quantised(F.col("vector"))),
        "vectors",
    )
    total, wide, largest = vectors.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.max("largest")).first()
    greatest = (wide or 0) * (SCALE * (largest or 0.0) + 1) ** 2
    if greatest * 100 >= 2**63:
        raise ValueError(f"scores up to {greatest:.3g} do not fit whole numbers of 63 bits")
    kind = np.float64 if greatest < 2**53 else np.int64  # both exact, the first faster
    components = total * max(1, wide or 0)
    tasks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-components // most), min(-(-components // least), tasks))

    own = vectors.select(F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"), F.lit(0).cast("long").alias("side"), "row", "id", "label", "vector")
    asking = vectors.filter("anchor").select("row", "id", "label", "vector")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard")

    def meet(asking: DataFrame, answer) -> DataFrame:
        no_scores = F.lit(None).cast("array<long>").alias("scores")
        sent = asking.select(each, F.lit(1).cast("long").alias("side"), "row", "id", "label", "vector", "scores")
        dealt = own.withColumn("scores", no_scores).unionByName(sent).repartition("shard").sortWithinPartitions("shard", "side")
        return dealt.mapInArrow(_meet(answer, kind), "anchor long, place long, score long, id long, row long")

    def near(shard: Shard, vector: np.ndarray, of: int, row: int, _: list | None) -> Iterator[tuple]:
        yield from _rows(shard, 0, *shard.positives(vector, of, row, positives))

    def below(shard: Shard, vector: np.ndarray, of: int, row: int, scores: list[int]) -> Iterator[tuple]:
        for place, found in enumerate(shard.negatives(vector, of, [window(s, low, high) for s in scores], negatives)):
            yield from _rows(shard, place, *found)

    first = meet(asking.withColumn("scores", F.lit(None).cast("array<long>")), near)
    chosen = _ranked(first, "anchor", count=positives)
    chosen = staged(chosen.select("anchor", "score", "id", (F.col("rank") - 1).cast("long").alias("place")), "positives")
    scores = chosen.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("all"))  # at most ``positives``
    scores = scores.select(F.col("anchor").alias("row"), F.col("all.score").alias("scores"))
    second = meet(staged(asking.join(scores, "row"), "asking"), below)
    found = _ranked(second, "anchor", "place", count=negatives)
    named = chosen.join(asking.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    named = named.select("anchor", "place", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(named, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
