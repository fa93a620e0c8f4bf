"""A Merkle manifest of a dataset whose inner nodes keep SHA-256 states.

A digest written as hexadecimal text is 64 bytes, one block of SHA-256. So the
state of a parent's hash before each child is 32 bytes that can be stored, and a
child's replacement is folded by resuming that state with the replacement and the
siblings to its right; nothing to its left is hashed again. Blocks are hashed for
many nodes at once, in arrays with one column a node.

Leaves are numbered by range partitions. A shard is 3^7 consecutive nodes of one
tree and is built in one task to a single node, whatever the size of its tree;
those nodes are the leaves of the next round. Paths travel the other way: those of
a round's shards are short rows, and each meets its shard's nodes and leaves once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import ship, staged

#: Children of a node, and the levels that one task builds.
FANOUT, LEVELS = 3, 7
#: What a leaf is made of.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# ------------------------------------------------------------------ SHA-256 states


def _root_bits(degree: int, count: int) -> np.ndarray:
    """The first 32 bits behind the point of the roots of the first primes."""
    found, n = [], 2
    while len(found) < count:
        if all(n % d for d in range(2, int(n**0.5) + 1)):
            low, high = 0, n << 32
            while low < high:  # the integer root of n * 2^(32 * degree)
                middle = (low + high + 1) // 2
                low, high = (middle, high) if middle**degree <= n << 32 * degree else (low, middle - 1)
            found.append(low & 0xFFFFFFFF)
        n += 1
    return np.array(found, dtype=np.uint32)


START = _root_bits(2, 8)
_ROUNDS = _root_bits(3, 64)
#: The two hexadecimal characters of each byte, as one number.
_HEX = np.frombuffer("".join(f"{b:02x}" for b in range(256)).encode(), dtype=">u2").astype(np.uint32)


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> np.uint32(by)) | (x << np.uint32(32 - by))


def advance(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The states (8, n) after a block (16, n) more."""
    w = list(block)
    for t in range(16, 64):
        x, y = w[t - 15], w[t - 2]
        low = _turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))
        high = _turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))
        w.append(w[t - 16] + low + w[t - 7] + high)
    a, b, c, d, e, f, g, h = state
    for t in range(64):
        one = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + _ROUNDS[t] + w[t]
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def resume(state: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """The states after one child's digest (8, n) more, as hexadecimal text."""
    bytes_ = [(digest >> np.uint32(s)) & np.uint32(255) for s in (24, 16, 8, 0)]
    high = (_HEX[bytes_[0]] << np.uint32(16)) | _HEX[bytes_[1]]
    low = (_HEX[bytes_[2]] << np.uint32(16)) | _HEX[bytes_[3]]
    return advance(state, np.stack([high, low], axis=1).reshape(16, -1))


def finish(state: np.ndarray, children: np.ndarray) -> np.ndarray:
    """The digests of states that have taken so many children each."""
    block = np.zeros((16, state.shape[1]), dtype=np.uint32)
    bits = children.astype(np.uint64) * np.uint64(512)
    block[0], block[14], block[15] = 0x80000000, bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return advance(state, block)


def start(n: int) -> np.ndarray:
    return np.repeat(START[:, None], n, axis=1)


def _pack(words: np.ndarray) -> bytes:
    return np.ascontiguousarray(words.T).astype(">u4").tobytes()


def _unpack(parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(parts), dtype=">u4").reshape(-1, 8).T.astype(np.uint32)


def _hexed(words: np.ndarray) -> list[str]:
    text = _pack(words).hex()
    return [text[k : k + 64] for k in range(0, len(text), 64)]


# ------------------------------------------------------------------ leaves


def leaf(*fields: Column) -> Column:
    """Digest (binary) of fields: ``-`` for a null, else the count of bytes, a colon and the value."""
    text = [f.cast("string") for f in fields]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256))


def tampered(id_: Column, text: Column) -> Column:
    """Texts without line ends where the CRC-32 of the decimal id is even; others, and texts without an id, as they are."""
    even = F.crc32(id_.cast("string").cast("binary")) % 2 == 0
    return F.when(F.coalesce(even, F.lit(False)), F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, id, leaf, replacement) of every document, written once; the only step that reads texts.

    A tree is a source: ``.`` and its name, or the empty text for a missing one, so
    that the missing source comes first and names are in the order of their bytes.
    """
    tree = F.coalesce(F.concat(F.lit("."), F.col("source").cast("string")), F.lit("")).alias("tree")
    own = [F.col(c) for c in FIELDS]
    edited = [*own[:-1], tampered(F.col("doc_id"), F.col("text"))]
    rows = docs.select(tree, F.col("doc_id").alias("id"), leaf(*own).alias("leaf"), leaf(*edited).alias("replacement"))
    return staged(rows.withColumn("row", F.monotonically_increasing_id()), "leaves")


def _fresh_runs(trees: pa.Array, before: str | None) -> np.ndarray:
    """Which rows have another tree than the row before them."""
    new = np.ones(len(trees), dtype=bool)
    if len(trees):
        new[0] = trees[0].as_py() != before
        new[1:] = pc.not_equal(trees[1:], trees[:-1]).to_numpy(zero_copy_only=False)
    return new


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """rows with ``pos``, their place from 0 in their tree in the given order.

    Rows are dealt out by ranges, so a tree may lie in many tasks; each counts its
    own. What is known per task, its first and last tree and how many rows of it,
    is added up on the driver, two names and two numbers a task. ``row`` parts equal rows.
    """
    ship(rows.sparkSession)
    keys = [F.col("tree"), *[F.col(c).asc_nulls_first() for c in order], F.col("row")]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    at = dealt.columns.index("tree")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tree, run, local = TaskContext.get().partitionId(), None, -1, -1
        for batch in batches:
            n = batch.num_rows
            new = _fresh_runs(batch.column(at), tree)
            runs = run + np.cumsum(new)
            begin = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            places = np.where(begin >= 0, np.arange(n) - begin, local + 1 + np.arange(n))
            if n:
                tree, run, local = batch.column(at)[-1].as_py(), int(runs[-1]), int(places[-1])
            more = [pa.array(np.full(n, part)), pa.array(runs), pa.array(places)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "part", "run", "local"])

    zero = F.lit(0).cast("long")
    schema = dealt.select("*", zero.alias("part"), zero.alias("run"), zero.alias("local")).schema
    counted = staged(dealt.mapInArrow(count, schema), "counted")
    ends = counted.groupBy("part").agg(F.min(F.struct("run", "tree")).alias("first"), F.max(F.struct("run", "local", "tree")).alias("last"))
    carried, tree, total = [], None, 0
    for e in ends.orderBy("part").collect():
        before = total if e["first"]["tree"] == tree else 0
        if before:
            carried.append((e["part"], before))
        tree, total = e["last"]["tree"], e["last"]["local"] + 1 + (before if e["last"]["run"] == 0 else 0)
    offsets = F.broadcast(rows.sparkSession.createDataFrame(carried, "part long, before long"))  # at most a row a task
    pos = F.col("local") + F.when(F.col("run") == 0, F.coalesce("before", F.lit(0))).otherwise(0)
    return counted.join(offsets, "part", "left").withColumn("pos", pos.cast("long")).drop("part", "run", "local", "before", "row")


# ------------------------------------------------------------------ building


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables with all rows of some (tree, shard), the first two columns by which the rows are sorted, and where each starts."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        begins = _group_starts(table)
        if begins[-1]:
            yield table.slice(0, begins[-1]).combine_chunks(), begins[:-1]
        held = table.slice(begins[-1])
    if held is not None:
        held = held.combine_chunks()
        yield held, _group_starts(held)


def _column(table: pa.Table, k: int | str) -> pa.Array:
    return table.column(k).combine_chunks() if table.column(k).num_chunks != 1 else table.column(k).chunk(0)


def _numbers(table: pa.Table, k: int | str) -> np.ndarray:
    return _column(table, k).to_numpy(zero_copy_only=False)


def _group_starts(table: pa.Table) -> np.ndarray:
    shard = _numbers(table, "shard")
    new = _fresh_runs(_column(table, "tree"), None)
    new[0] = True
    new[1:] |= shard[1:] != shard[:-1]
    return np.flatnonzero(new)


_NODE = "tree string, shard long, level long, at long, digest binary, state binary, left binary, right binary"


def _build(levels: int):
    """Task over rows (tree, shard, pos, digest) sorted by the first three that gives the nodes of each shard.

    A node has its digest, its parent's state before it and the digests to its left
    and right under that parent. A shard's last node has no state.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begins in _whole_groups(batches):
            trees, shards = _column(table, "tree"), _numbers(table, "shard")
            counts = np.diff(np.append(begins, table.num_rows))
            group = np.repeat(np.arange(len(begins)), counts)
            at = np.arange(table.num_rows) - begins[group]
            digest = _unpack(_column(table, "digest").to_pylist())
            level = 0
            while len(group):
                many = np.bincount(group, minlength=len(begins))
                # the first shard ends with a single node: either its tree has no other shard, or it is full
                done = (many[group] == 1) & ((shards[begins[group]] == 0) | (level == levels))
                if done.any():
                    packed = _pack(digest[:, done])
                    parts = [packed[k : k + 32] for k in range(0, len(packed), 32)]
                    none = [None] * len(parts)
                    yield _nodes(trees, shards, begins[group[done]], level, at[done], parts, none, none, none)
                    group, at, digest = group[~done], at[~done], digest[:, ~done]
                    if not len(group):
                        break
                slot = at % FANOUT
                first = np.flatnonzero(slot == 0)
                parent = np.cumsum(slot == 0) - 1
                size = np.diff(np.append(first, len(group)))
                state, before = start(len(first)), np.empty_like(digest)
                for s in range(FANOUT):
                    mine = np.flatnonzero(slot == s)
                    if len(mine):
                        before[:, mine] = state[:, parent[mine]]
                        state[:, parent[mine]] = resume(before[:, mine], digest[:, mine])
                own, states = _pack(digest), _pack(before)
                begin, end = first[parent], (first + size)[parent]
                places = range(len(group))
                yield _nodes(
                    trees,
                    shards,
                    begins[group],
                    level,
                    at,
                    [own[32 * k : 32 * k + 32] for k in places],
                    [states[32 * k : 32 * k + 32] for k in places],
                    [own[32 * b : 32 * k] for b, k in zip(begin.tolist(), places)],
                    [own[32 * k + 32 : 32 * e] for k, e in zip(places, end.tolist())],
                )
                group, at, digest = group[first], at[first] // FANOUT, finish(state, size)
                level += 1

    return task


def _nodes(trees, shards, rows, level, at, digest, state, left, right) -> pa.RecordBatch:
    columns = [trees.take(pa.array(rows)), pa.array(shards[rows]), pa.array(np.full(len(rows), level)), pa.array(at)]
    columns += [pa.array(x, pa.binary()) for x in (digest, state, left, right)]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _NODE.split(", ")])


def _grow(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of nodes over (tree, pos, digest) until each tree is one node, and (tree, digest, round) of that."""
    rounds, ends = [], []
    while True:
        cut = nodes.select("tree", F.floor(F.col("pos") / FANOUT**levels).alias("shard"), "pos", "digest")
        dealt = cut.repartition("tree", "shard").sortWithinPartitions("tree", "shard", "pos")
        rounds.append(staged(dealt.mapInArrow(_build(levels), _NODE), f"nodes-{len(rounds)}"))
        tops = rounds[-1].filter("state IS NULL").select("tree", "shard", "digest")
        more = tops.groupBy("tree").agg(F.max("shard").alias("last")).filter("last > 0").select("tree")
        more = staged(more, "unfinished-trees")
        ends.append(tops.join(more, "tree", "left_anti").select("tree", "digest", F.lit(len(rounds) - 1).alias("round")))
        if more.isEmpty():
            return rounds, reduce(DataFrame.unionByName, ends)
        nodes = tops.join(more, "tree", "left_semi").withColumnRenamed("shard", "pos")


@dataclass(frozen=True)
class Manifest:
    """Stored trees: per source, and one over the sources' roots.

    ``leaves`` has tree, pos, id, leaf and replacement; ``rounds`` and ``top_rounds`` have
    nodes (see _build); ``subroots`` has each source's tree, its root, the round in which
    that was reached and its place among the sources. ``root`` is None without leaves.
    """

    leaves: DataFrame
    rounds: list[DataFrame]
    subroots: DataFrame
    top_rounds: list[DataFrame]
    root: str | None
    levels: int


def build(docs: DataFrame, levels: int = LEVELS) -> Manifest:
    """The manifest of a table with the columns FIELDS; see prove for odd rows."""
    spark = docs.sparkSession
    ship(spark)
    placed = numbered(leaves(docs), "id", "leaf")
    rounds, ends = _grow(placed.select("tree", "pos", F.col("leaf").alias("digest")), levels)
    ranked = ends.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest", "round", F.lit(0).alias("row"))
    subroots = staged(numbered(ranked, "name"), "subroots")
    top_rounds, top = _grow(subroots.select("tree", "pos", "digest"), levels)
    root = top.select(F.lower(F.hex("digest"))).first()
    return Manifest(placed, rounds, subroots.drop("tree").withColumnRenamed("name", "tree"), top_rounds, root and root[0], levels)


# ------------------------------------------------------------------ folding


_STEP = ("tree", "shard", "step", "digest", "state", "left", "right")


def _descend(nodes: DataFrame, steps: DataFrame, levels: int) -> DataFrame:
    """From the steps above a round's shards to those above its lowest nodes, which are the shards of the round below.

    A step has a parent's state before a node and the node's siblings. A node's steps
    are those of its ancestors in the shard, at most ``levels``, and then the shard's.
    """
    inner = nodes.filter("state IS NOT NULL")
    child = (F.col("shard") * FANOUT**levels + F.col("at")).alias("child")
    lowest = nodes.filter("level = 0").select("tree", "shard", "at", child)
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(levels - 1).cast("long"))).alias("level")
    chain = lowest.select("tree", "shard", "child", "at", each)
    chain = chain.withColumn("at", F.floor(F.col("at") / F.pow(F.lit(FANOUT), F.col("level"))))
    chain = chain.join(inner, ["tree", "shard", "level", "at"]).withColumn("step", F.col("level")).withColumn("digest", F.lit(None).cast("binary"))
    above = lowest.join(steps, ["tree", "shard"]).withColumn("step", F.when(F.col("step") < 0, F.col("step")).otherwise(F.col("step") + levels))
    names = [F.col("child").alias("shard") if c == "shard" else F.col(c) for c in _STEP]
    return chain.select(*names).unionByName(above.select(*names))


def steps_above(manifest: Manifest) -> DataFrame:
    """The steps above every shard of leaves; step -1 has the root of its source."""
    none = manifest.top_rounds[-1].limit(0).select("tree", "shard", F.col("level").alias("step"), "digest", "state", "left", "right")
    steps = none
    for nodes in reversed(manifest.top_rounds):
        steps = staged(_descend(nodes, steps, manifest.levels), "top-steps")
    place = manifest.subroots.select("tree", "pos", "round", F.col("digest").alias("subroot"))
    tops = place.join(steps.drop("tree"), F.col("pos") == F.col("shard")).select("round", *_STEP[:1], F.lit(0).cast("long").alias("shard"), *_STEP[2:])
    empty = F.lit(None).cast("binary")
    heads = place.select(
        "round", "tree", F.lit(0).cast("long").alias("shard"), F.lit(-1).cast("long").alias("step"),
        F.col("subroot").alias("digest"), empty.alias("state"), empty.alias("left"), empty.alias("right"),
    )
    tops = staged(tops.unionByName(heads), "source-steps")
    steps = none
    for k in range(len(manifest.rounds) - 1, -1, -1):
        ended = tops.filter(F.col("round") == k).select(*_STEP)
        steps = ended if k == len(manifest.rounds) - 1 else ended.unionByName(_descend(manifest.rounds[k + 1], steps, manifest.levels))
        steps = staged(steps, f"steps-{k}")
    return steps


class _Binary:
    """A column of digests, none to two a row, as numbers."""

    def __init__(self, values: list[bytes | None]) -> None:
        values = [v or b"" for v in values]
        self.count = np.array([len(v) // 32 for v in values])
        self.begin = np.cumsum(self.count) - self.count
        self.words = _unpack(values)

    def take(self, rows: np.ndarray, k: int = 0) -> np.ndarray:
        return self.words[:, self.begin[rows] + k]


NODE, STEP, LEAF = 0, 1, 2


def _fold(levels: int):
    """Task over rows of shards, their nodes, steps and leaves, sorted by tree, shard, kind, level and at: proofs and folded roots."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begins in _whole_groups(batches):
            kind, level, at = (_numbers(table, c) for c in ("kind", "level", "at"))
            group = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, table.num_rows)))
            state, left, right = (_Binary(_column(table, c).to_pylist()) for c in ("state", "left", "right"))
            lanes = np.flatnonzero(kind == LEAF)
            if not len(lanes):
                continue
            mine = group[lanes]
            node = np.flatnonzero(kind == NODE)
            key = group[node] * (levels + 1) + level[node]
            height = np.zeros(len(begins), dtype=np.int64)
            np.maximum.at(height, group[node], level[node] + 1)
            step = np.flatnonzero((kind == STEP) & (level >= 0))
            above = np.bincount(group[step], minlength=len(begins))
            digest = _unpack([x for x in _column(table, "digest").take(pa.array(lanes)).to_pylist()])
            proof, siblings = start(len(lanes)), np.zeros(len(lanes), dtype=np.int64)
            for k in range(int((height + above).max())):
                live = np.flatnonzero(k < (height + above)[mine])
                g = mine[live]
                inside = k < height[g]
                row = np.empty(len(live), dtype=np.int64)
                low, high = np.flatnonzero(inside), np.flatnonzero(~inside)
                row[low] = node[np.searchsorted(key, g[low] * (levels + 1) + k) + at[lanes[live[low]]] // FANOUT**k]
                row[high] = step[np.searchsorted(group[step], g[high]) + k - height[g[high]]]
                for side in (left, right):
                    for s in range(FANOUT - 1):
                        has = np.flatnonzero(side.count[row] > s)
                        if len(has):
                            proof[:, live[has]] = resume(proof[:, live[has]], side.take(row[has], s))
                now = resume(state.take(row), digest[:, live])
                for s in range(FANOUT - 1):
                    has = np.flatnonzero(right.count[row] > s)
                    if len(has):
                        now[:, has] = resume(now[:, has], right.take(row[has], s))
                both = left.count[row] + right.count[row]
                digest[:, live] = finish(now, both + 1)
                siblings[live] += both
            head = np.flatnonzero((kind == STEP) & (level < 0))
            subroot = _column(table, "digest").take(pa.array(head[np.searchsorted(group[head], mine)]))
            columns = [_column(table, c).take(pa.array(lanes)) for c in ("id", "original")]
            columns += [subroot, pa.array(_hexed(finish(proof, siblings))), pa.array(_hexed(digest))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "original", "subroot", "proof_sha256", "folded_root"])

    return task


def fold(manifest: Manifest, replaced: DataFrame) -> DataFrame:
    """(id, original, subroot, proof_sha256, folded_root) of rows (tree, pos, id, leaf, replacement).

    A row is one leaf of the manifest with the digest that takes its place; every
    row is folded alone, with its siblings as they are in the manifest.
    """
    nothing = {c: F.lit(None).cast("binary").alias(c) for c in ("digest", "state", "left", "right", "original")}
    no_id = F.lit(None).cast(replaced.schema["id"].dataType).alias("id")
    number = lambda n: F.lit(n).cast("long")
    nodes = manifest.rounds[0].filter("state IS NOT NULL").select(
        "tree", "shard", number(NODE).alias("kind"), "level", "at", no_id, nothing["original"], nothing["digest"], "state", "left", "right"
    )
    steps = steps_above(manifest).select(
        "tree", "shard", number(STEP).alias("kind"), F.col("step").alias("level"), number(0).alias("at"), no_id,
        nothing["original"], "digest", "state", "left", "right",
    )
    rows = replaced.select(
        "tree", F.floor(F.col("pos") / FANOUT**manifest.levels).alias("shard"), number(LEAF).alias("kind"), number(0).alias("level"),
        (F.col("pos") % FANOUT**manifest.levels).alias("at"), "id", F.col("leaf").alias("original"), F.col("replacement").alias("digest"),
        nothing["state"], nothing["left"], nothing["right"],
    )
    every = nodes.unionByName(steps).unionByName(rows)
    dealt = every.repartition("tree", "shard").sortWithinPartitions("tree", "shard", "kind", "level", "at")
    out = every.select("id", "original", F.col("digest").alias("subroot"), F.lit("").alias("proof_sha256"), F.lit("").alias("folded_root")).schema
    return dealt.mapInArrow(_fold(manifest.levels), out)


def prove(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root and verified.

    A null field is part of its leaf as ``-``; a missing source is a source of its
    own, a missing id sorts first in its source and its text is not tampered with. Of
    rows with the same source and id the one with the smaller leaf comes first; rows
    alike in every field are leaves beside each other. An empty table gives no rows.
    Further columns are left out, whatever their names.
    """
    manifest = build(docs, levels)
    found = fold(manifest, manifest.leaves)
    hexed = lambda c: F.lower(F.hex(c))
    root = F.lit(manifest.root).cast("string")
    return found.select(
        F.col("id").alias("doc_id"), hexed("original").alias("leaf"), hexed("subroot").alias("subroot"), root.alias("root"),
        "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"),
    )
