"""Chat formatting as prefix trees.

Conversations that begin with the same turns share those turns' tokens. A node
of a tree is a distinct beginning; its segment is its last turn as formatted.
Each tree is one sequence, laid out depth-first, in which every node's segment
stands once. A node carries the position ids its tokens have in their
conversations, and the intervals of the sequence its tokens may attend to: its
ancestors, and what stands before in its own segment. Tokens are code points.

How it is computed. The owner of a node is the smallest conversation through it.
The nodes of one owner are the end of its path, a run; runs are what a
depth-first layout puts one behind the other. A run's place in the order is
known from its own path: at which depths, and to which owners, the path passes.
So runs are sorted by that key over all tasks, and their lengths summed within
ranges first. No task holds a tree or all copies of a turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.common import ship, staged

#: Strings that steer chat models, none of which is left in a formatted text.
CONTROL = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"
#: Stands for a missing conversation id inside the computation.
NO_ID = -(2**63)

_CONTROL = re.compile("|".join(map(re.escape, sorted(CONTROL, key=len, reverse=True))))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """Backslashes doubled, and one put behind the first character of every control string."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn's segment and where its text lies in it."""
    head = START + escape(role).replace("\n", "\\\n") + "\n"
    body = escape(text)
    return head + body + END + "\n", len(head), len(head) + len(body)


_SEGMENT = re.compile(re.escape(START) + r"((?:[^\\\n]|\\.)*)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    turns, at = [], 0
    for m in _SEGMENT.finditer(formatted):
        if m.start() != at:
            break
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError("not a formatted conversation")
    return turns


def _formatted_turns(rows: DataFrame) -> DataFrame:
    """Every turn as a segment, with the node it leads to, which is a digest of all turns up to it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, node, depth, pos = None, b"", 0, 0
        for batch in batches:
            out: list[list] = [[] for _ in range(9)]
            for c, role, text in zip(*(col.to_pylist() for col in batch.columns)):
                if c != conv:
                    conv, node, depth, pos = c, b"", 0, 0
                segment, a, b = format_turn(role, text)
                parent = node
                node = hashlib.blake2b(parent + segment.encode(), digest_size=16).digest()
                learned = role == LEARNED_ROLE
                values = (c, depth, pos, node, parent or None, segment, len(segment), a if learned else 0, b if learned else 0)
                for column, v in zip(out, values):
                    column.append(v)
                depth, pos = depth + 1, pos + len(segment)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], names=names)

    names = ["c", "depth", "pos", "node", "parent", "segment", "size", "loss_from", "loss_to"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    ship(rows.sparkSession)
    dealt = rows.repartition("c").sortWithinPartitions("c", "turn", "role", "text").select("c", "role", "text")
    return dealt.mapInArrow(
        task, "c long, depth long, pos long, node binary, parent binary, segment string, size long, loss_from long, loss_to long"
    )


def prefix_trees(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, paths) of (conv_id, turn, role, text).

    nodes: tree, run, node, parent, depth, segment, seq_start, seq_end,
    position_start, loss_start, loss_end, attends (array of start, end). The
    concatenation of a tree's segments by seq_start is its sequence. loss_start
    and loss_end bound an assistant's text in the sequence (equal: none).

    paths: conv_id, n_turns, tree, pieces (array of run, start, end): the
    intervals of the sequence that read a conversation, in order.

    Turns are ordered by turn, then role and text; a null turn comes first. Null
    roles and texts count as empty, a null conv_id as one conversation. Repeated
    rows are turns of their own. An empty table gives no nodes and no paths.
    """
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("c"),
        "turn",
        *[F.coalesce(F.col(x), F.lit("")).alias(x) for x in ("role", "text")],
    )
    turns = staged(_formatted_turns(rows), "turns")
    owners = staged(turns.groupBy("node").agg(F.min("c").alias("owner")), "owners")
    owned = turns.join(owners, "node")

    parts = owned.groupBy("c", "owner").agg(F.min("depth").alias("at"), F.count(F.lit(1)).alias("turns"), F.sum("size").alias("size"))
    chain = F.sort_array(F.collect_list(F.struct("at", "owner", "size")))  # one per owner on the path
    chains = staged(parts.groupBy("c").agg(chain.alias("chain"), F.sum("turns").alias("n_turns")), "chains")
    chains = chains.withColumn("tree", F.col("chain")[0]["owner"])

    last = F.element_at("chain", -1)
    key = F.transform("chain", lambda x: F.struct((-x["at"]).alias("up"), x["owner"].alias("owner")))
    before = F.aggregate(F.slice("chain", 1, F.size("chain") - 1), F.lit(0).cast("long"), lambda a, x: a + x["size"])
    runs = chains.filter(last["owner"] == F.col("c")).select(
        F.col("c").alias("run"), "tree", key.alias("key"), last["size"].alias("size"), before.alias("run_pos")
    )
    placed = _laid_out(runs)

    piece = F.explode(F.col("chain")).alias("part")
    pieces = chains.select("c", "tree", "n_turns", piece).select(
        "c", "tree", "n_turns", F.col("part.owner").alias("run"), F.col("part.at").alias("at"), F.col("part.size").alias("size")
    )
    found = pieces.join(placed.select("run", "start"), "run")
    interval = F.struct("at", "run", F.col("start").alias("start"), (F.col("start") + F.col("size")).alias("end"))
    paths = found.groupBy("c", "tree", "n_turns").agg(F.sort_array(F.collect_list(interval)).alias("pieces"))
    paths = staged(paths, "paths")

    own = owned.filter("c = owner").join(placed.select(F.col("run").alias("c"), "start", "run_pos"), "c")
    own = own.join(paths.select("c", "tree", "pieces"), "c").withColumn("seq_start", F.col("start") + F.col("pos") - F.col("run_pos"))
    above = F.transform(
        F.filter("pieces", lambda p: p["run"] != F.col("c")), lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"))
    )
    own_part = F.struct(F.col("start"), (F.col("seq_start") + F.col("size")).alias("end"))
    nodes = own.select(
        "tree",
        F.col("c").alias("run"),
        "node",
        "parent",
        "depth",
        "segment",
        "seq_start",
        (F.col("seq_start") + F.col("size")).alias("seq_end"),
        F.col("pos").alias("position_start"),
        (F.col("seq_start") + F.col("loss_from")).alias("loss_start"),
        (F.col("seq_start") + F.col("loss_to")).alias("loss_end"),
        F.concat(above, F.array(own_part)).alias("attends"),
    )
    conv = F.when(F.col("c") != NO_ID, F.col("c"))
    out = paths.select(conv.alias("conv_id"), "n_turns", "tree", F.transform("pieces", lambda p: F.struct(p["run"].alias("run"), p["start"].alias("start"), p["end"].alias("end"))).alias("pieces"))
    return staged(nodes, "nodes"), out


def _laid_out(runs: DataFrame) -> DataFrame:
    """Runs with ``start``, the sum of the sizes before them in their tree's depth-first order.

    Runs are sorted into ranges of (tree, key); sizes are summed per range and
    tree, those sums added up per tree, and then within ranges.
    """
    ranged = staged(runs.repartitionByRange("tree", "key").withColumn("range", F.spark_partition_id()), "runs")
    sums = ranged.groupBy("tree", "range").agg(F.sum("size").alias("all"))
    earlier = W.partitionBy("tree").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    bases = sums.select("tree", "range", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("base"))
    inside = W.partitionBy("tree", "range").orderBy("key").rowsBetween(W.unboundedPreceding, -1)
    local = ranged.withColumn("offset", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    start = (F.col("base") + F.col("offset")).alias("start")
    return staged(local.join(bases, ["tree", "range"]).select("run", "tree", "size", "run_pos", start), "layout")


def read_back(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) read from the sequences alone.

    A conversation's intervals pick the nodes of each run; its segments are
    parsed one after the other, so no conversation is held whole.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None

        def close() -> pa.RecordBatch:
            turns, loss, n, learned, chars = state
            values = ([conv], [n], [turns.hexdigest()], [learned], [loss.hexdigest()], [chars])
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=names)

        for batch in batches:
            done = []
            for c, segment, a, b in zip(*(col.to_pylist() for col in batch.columns)):
                if state is None or c != conv:
                    if state is not None:
                        done.append(close())
                    conv, state = c, [hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
                for role, text in parse(segment):
                    state[0].update(f"{role}\n{text}\n".encode())
                    state[2] += 1
                learned = unescape(segment[a:b])
                state[1].update(learned.encode())
                state[3] += len(learned)
                state[4] += len(segment)
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        if state is not None:
            yield close()

    names = ["c", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    ship(nodes.sparkSession)
    wanted = paths.select(F.coalesce("conv_id", F.lit(NO_ID)).alias("c"), F.posexplode("pieces").alias("at", "p"))
    wanted = wanted.select("c", "at", F.col("p.run").alias("run"), F.col("p.start").alias("from"), F.col("p.end").alias("to"))
    inside = (F.col("w.run") == F.col("n.run")) & (F.col("n.seq_start") >= F.col("w.from")) & (F.col("n.seq_start") < F.col("w.to"))
    read = wanted.alias("w").join(nodes.alias("n"), inside).select(
        "w.c",
        "w.at",
        "n.seq_start",
        "n.segment",
        (F.col("n.loss_start") - F.col("n.seq_start")).alias("a"),
        (F.col("n.loss_end") - F.col("n.seq_start")).alias("b"),
    )
    dealt = read.repartition("c").sortWithinPartitions("c", "at", "seq_start").select("c", "segment", "a", "b")
    digests = dealt.mapInArrow(
        task, "c long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    return digests.select(F.when(F.col("c") != NO_ID, F.col("c")).alias("conv_id"), *names[1:])
