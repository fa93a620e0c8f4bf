"""SimHash near-dedup with fuzzy hashing by the Golay code.

A 64-bit fingerprint has three segments, of 23, 23 and 18 bits. The (23, 12)
Golay code has a codeword within 3 bits of every word. A segment's keys are the
indices of all codewords within 4 bits of it: one when the nearest is at most 2
bits away, else six. Two segments that differ in at most 2 bits share a key.

Fingerprints that differ in at most 4 bits leave by the pigeonhole principle
  * one segment without error, and one of the other two with at most 2: they meet
    under the exact first and a key of the second (35 bits); or
  * no segment without error, and then two with exactly one each: they meet under
    a key of both (24 bits and the parity of the two, which such a pair keeps).
    One error changes a segment's parity, so segments of even parity need their
    nearest codeword only.

Equal keys are brought together, all pairs under a key are compared in place,
and a task reports only a spanning forest of the pairs within the distance. Keys
with very many fingerprints are cut into blocks and every two blocks compared
elsewhere, so no key is too large for a task and no pair is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import fresh, lean, ship, staged
from llm.components import components

SHINGLE, DISTANCE, SEED = 4, 4, 42
#: Low bit and width of each segment.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Fixed value: generator polynomial of the binary Golay code, x^11+x^9+x^7+x^6+x^5+x+1.
GENERATOR = 0xAE3
#: Fingerprints under one key that one task compares at once.
BLOCK = 4096
#: Distinct fingerprints from which on comparing under short keys costs more than making three times as many long ones.
WIDE_FROM = 1 << 28
#: Pairs a task holds before it reduces them to a forest.
HELD = 1 << 18
HASHES_AT_ONCE = 1 << 16


# ------------------------------------------------------------------ fingerprints


def fingerprint(text: str | None, words_each: int = SHINGLE) -> int:
    """The SimHash of a text as an unsigned number; 0 for texts without words."""
    words = (text or "").encode().lower().split()  # on bytes both know ASCII alone
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = max(1, len(words) - words_each + 1)
    spans = zip(starts[:n].tolist(), ends[min(words_each, len(words)) - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, n, HASHES_AT_ONCE):
        some = hashes[k : k + HASHES_AT_ONCE].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", words_each: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` and ``fp``, the fingerprint as a signed number, of every row."""
    ship(docs.sparkSession)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep))
            fp = np.array([fingerprint(t.as_py(), words_each) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(fp)], names=[*keep, "fp"])

    narrow = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text))
    schema = narrow.select(*[F.col(f"`{c}`") for c in keep], F.lit(0).cast("long").alias("fp")).schema
    return narrow.mapInArrow(lean(mark), schema)


# ------------------------------------------------------------------ Golay keys


def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


class Golay:
    """Tables of the code: the check bits of each message, the error patterns of each syndrome."""

    def __init__(self) -> None:
        self.check = np.array([_remainder(m << 11) for m in range(4096)], dtype=np.int64)
        patterns: list[list[int]] = [[] for _ in range(2048)]
        for weight in range(5):
            for bits in combinations(range(23), weight):
                error = sum(1 << b for b in bits)
                patterns[_remainder(error)].append(error)
        self.patterns = np.full((2048, max(map(len, patterns))), -1, dtype=np.int64)
        for syndrome, errors in enumerate(patterns):
            self.patterns[syndrome, : len(errors)] = errors  # the lightest first

    def indices(self, words: np.ndarray) -> np.ndarray:
        """Per word the message bits of the codewords within 4 bits, the nearest first; -1 fills up."""
        errors = self.patterns[self.check[words >> 11] ^ (words & 0x7FF)]
        return np.where(errors >= 0, (words[:, None] ^ errors) >> 11, -1)


_golay: list[Golay] = []


def golay() -> Golay:
    if not _golay:
        _golay.append(Golay())
    return _golay[0]


def keys(fps: np.ndarray, wide: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(key, position in fps) of every key of unsigned fingerprints.

    Where two segments have one error each the third has at most two. With ``wide`` its
    codewords are part of those keys: three times as many keys, each 4,096 times rarer.
    """
    parts = [((fps >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64) for low, width in SEGMENTS]
    index = [golay().indices(p) for p in parts]
    parity = [np.bitwise_count(p).astype(np.int64) & 1 for p in parts]
    rows = np.arange(len(fps))
    out_key, out_row = [], []

    def emit(tag: int, key: np.ndarray, valid: np.ndarray) -> None:
        out_key.append((key | (tag << 40))[valid])
        out_row.append(np.broadcast_to(rows[:, None], key.shape)[valid])

    tag = 0
    for exact in range(3):
        for near in range(3):
            if near != exact:
                emit(tag, (parts[exact][:, None] << 12) | index[near], index[near] >= 0)
                tag += 1
    for a, b in combinations(range(3), 2):
        few = [np.where((parity[s][:, None] == 0) & (np.arange(index[s].shape[1]) > 0), -1, index[s]) for s in (a, b)]
        left, right = few[0][:, :, None], few[1][:, None, :]
        both = (left << 13) | (right << 1) | (parity[a] ^ parity[b])[:, None, None]
        valid = (left >= 0) & (right >= 0)
        if wide:
            third = index[3 - a - b][:, None, None, :]
            both, valid = (both[..., None] << 12) | third, valid[..., None] & (third >= 0)
        emit(tag, both.reshape(len(fps), -1), valid.reshape(len(fps), -1))
        tag += 1
    return np.concatenate(out_key), np.concatenate(out_row)


# ------------------------------------------------------------------ comparison


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars that connect the same numbers as the pairs do."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


class _Pairs:
    """Collects pairs of a task and keeps only a forest of them."""

    def __init__(self, distance: int):
        self.distance = distance
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []
        self.held = 0

    def compare(self, group: np.ndarray, fps: np.ndarray) -> None:
        """All pairs of rows with equal group; rows of a group are neighbours."""
        at = np.arange(len(fps) - 1)
        step = 1
        while True:
            at = at[: np.searchsorted(at, len(fps) - step)]
            at = at[group[at] == group[at + step]]
            if not len(at):
                return
            close = at[np.bitwise_count((fps[at] ^ fps[at + step]).view(np.uint64)) <= self.distance]
            close = close[fps[close] != fps[close + step]]
            if len(close):
                self.a.append(fps[close])
                self.b.append(fps[close + step])
                self.held += len(close)
                if self.held > HELD:
                    self.reduce()
            step += 1

    def cross(self, left: np.ndarray, right: np.ndarray) -> None:
        """All pairs of one from each side; the sides have no fingerprint in common."""
        for k in range(0, len(left), 64):
            some = left[k : k + 64]
            i, j = np.nonzero(np.bitwise_count((some[:, None] ^ right[None, :]).view(np.uint64)) <= self.distance)
            if len(i):
                self.a.append(some[i])
                self.b.append(right[j])
                self.held += len(i)
                if self.held > HELD:
                    self.reduce()

    def reduce(self) -> None:
        if self.a:
            a, b = _forest(np.concatenate(self.a), np.concatenate(self.b))
            self.a, self.b, self.held = [a], [b], 0

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        self.reduce()
        none = np.empty(0, dtype=np.int64)
        return (self.a[0], self.b[0]) if self.a else (none, none)


def _found(a: np.ndarray, b: np.ndarray, part: np.ndarray | None = None) -> pa.RecordBatch:
    """Pairs, or with ``part`` rows of a key (a) whose fingerprints (b) are to be compared by blocks."""
    part = np.full(len(a), -1, dtype=np.int64) if part is None else part
    return pa.RecordBatch.from_arrays([pa.array(part), pa.array(a), pa.array(b)], names=["part", "a", "b"])


def _compare_sorted(distance: int, block: int):
    """Task over rows sorted by key: a forest of the close pairs, and the rows of keys with more than ``block`` rows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _Pairs(distance)
        key = np.empty(0, dtype=np.int64)
        fp = np.empty(0, dtype=np.int64)
        long_key, long_rows = None, 0
        for batch in batches:
            key = np.concatenate([key, batch.column(0).to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, batch.column(1).to_numpy(zero_copy_only=False)])
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, dtype=np.int64)
            sizes = np.diff(np.append(starts, len(key)))
            apart = sizes > block
            if len(starts) and long_key is not None and key[0] == long_key:
                apart[0] = True
            ready = np.ones(len(key), dtype=bool)
            for start, size in zip(starts[apart].tolist(), sizes[apart].tolist()):
                if long_key is None or key[start] != long_key:
                    long_key, long_rows = key[start], 0
                rows = slice(start, start + size)
                yield _found(key[rows], fp[rows], (long_rows + np.arange(size)) // block)
                long_rows += size
                ready[rows] = False
            if len(starts) and not apart[-1]:
                ready[starts[-1] :] = False
            pairs.compare(key[ready], fp[ready])
            rest = slice(starts[-1], None) if len(starts) and not apart[-1] else slice(0, 0)
            key, fp = key[rest].copy(), fp[rest].copy()
        if len(key):
            if long_key is not None and key[0] == long_key:
                yield _found(key, fp, (long_rows + np.arange(len(key))) // block)
            else:
                pairs.compare(key, fp)
        yield _found(*pairs.edges())

    return task


def _compare_blocks(distance: int):
    """Task over rows (key, i, j, side, fp) sorted by the first three: the pairs of two blocks, or within one where i is j."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _Pairs(distance)
        held = np.empty((5, 0), dtype=np.int64)  # the group that the next batch may go on with

        def compare(rows: np.ndarray) -> None:
            inside = rows[1] == rows[2]
            group = np.concatenate([[0], np.cumsum((rows[:3, 1:] != rows[:3, :-1]).any(axis=0))])
            pairs.compare(group[inside], rows[4, inside])
            for g in np.unique(group[~inside]):
                mine = rows[:, group == g]
                pairs.cross(mine[4, mine[3] == 0], mine[4, mine[3] == 1])

        for batch in batches:
            held = np.concatenate([held, [c.to_numpy(zero_copy_only=False) for c in batch.columns]], axis=1)
            if not held.shape[1]:
                continue
            group = np.concatenate([[0], np.cumsum((held[:3, 1:] != held[:3, :-1]).any(axis=0))])
            last = int(np.searchsorted(group, group[-1]))
            if last:
                compare(held[:, :last])
            held = held[:, last:].copy()
        if held.shape[1]:
            compare(held)
        yield _found(*pairs.edges())

    return task


def links(fps: DataFrame, distance: int = DISTANCE, block: int = BLOCK, wide: bool | None = None) -> DataFrame:
    """(a, b): edges that connect exactly the fingerprints linked by chains of at most ``distance`` differing bits.

    ``fps`` has one column ``fp`` of distinct fingerprints as signed numbers. ``wide``
    chooses the keys, by their number if it isn't given; the edges connect the same.
    """
    if distance > DISTANCE:
        raise ValueError(f"the keys cover distances up to {DISTANCE}")
    wide = fps.count() >= WIDE_FROM if wide is None else wide
    ship(fps.sparkSession)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for k in range(0, len(fp), 2048):
                some = fp[k : k + 2048]
                key, row = keys(some.view(np.uint64), wide)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(some[row])], names=["key", "fp"])

    keyed = fps.select("fp").mapInArrow(lean(explode), "key long, fp long")
    dealt = keyed.repartition("key").sortWithinPartitions("key")
    found = staged(dealt.mapInArrow(lean(_compare_sorted(distance, block)), "part long, a long, b long"), "close-pairs")
    edges = found.filter("part < 0").select("a", "b")
    large = found.filter("part >= 0").select(F.col("a").alias("key"), "part", F.col("b").alias("fp"))
    if large.isEmpty():
        return edges
    most = large.groupBy("key").agg(F.max("part").alias("most"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("most")))
    both = large.join(most, "key").select("key", "part", "fp", other.alias("other"))
    side = (F.col("part") > F.col("other")).cast("long").alias("side")
    both = both.select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), side, "fp")
    blocks = both.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    more = blocks.mapInArrow(lean(_compare_blocks(distance)), "part long, a long, b long")
    return edges.unionByName(more.select("a", "b"))


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", row: str | None = None, words_each: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id and, if named, the column ``row``.

    Documents are linked when their fingerprints differ in at most ``distance``
    bits; component_id is the smallest id that links reach. Null and blank texts
    have the fingerprint zero and are linked like any other. Missing ids take
    part in links but name no component (null when all are missing). Repeated
    rows each give a row. An empty table gives no rows. Equal fingerprints are
    one before any comparison, so copies cost nothing more.
    """
    ids, *_ = fresh(["fp"], "doc_id")
    named = docs.select(F.col(id_col).alias(ids), F.col(text).alias("text"), *([F.col(row)] if row else []))
    marked = staged(fingerprints(named, [ids, *([row] if row else [])], "text", words_each), "fingerprints")
    distinct = staged(marked.groupBy("fp").agg(F.min(ids).alias("smallest")), "distinct-fingerprints")
    roots = components(links(distinct, distance))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = staged(rooted.select("fp", "smallest", F.coalesce("root", "fp").alias("root")), "rooted")
    named_roots = staged(rooted.groupBy("root").agg(F.min("smallest").alias("component_id")), "components")
    label = staged(rooted.join(named_roots, "root").select("fp", "component_id", "root"), "labels")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return marked.join(label, "fp").select(
        F.col(ids).alias("doc_id"), hexed, "component_id", *([row, "root"] if row else [])
    )


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words_each: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of each group, that with the smallest id, with all its columns.

    Missing ids count as larger than any; of rows with the same id the first
    one read stays. Rows are numbered once and stored with their numbers; only the
    numbers of rows that go travel back to the texts.
    """
    (row,) = fresh([*docs.columns, "fp", "doc_id", "root"], "row_key")
    numbered = staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = staged(near_groups(numbered, id_col, text, row, words_each, distance).select("doc_id", row, "root"), "near-groups")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", row)
    stays = staged(groups.groupBy("root").agg(F.min(order)[row].alias("stays")), "near-keepers")
    gone = groups.join(stays, "root").filter(F.col(row) != F.col("stays")).select(row)
    return numbered.join(staged(gone, "near-copies"), row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
