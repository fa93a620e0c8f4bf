"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the k smallest distinct 48-bit hashes of a text's word shingles.
Sketches of parts merge into that of the whole (the k smallest of both), and
estimate the number of distinct shingles, the resemblance of two texts and how
much of one is contained in the other. A text with at most k distinct shingles
has an exact sketch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import ship, staged

#: Words of a shingle, and hashes of a sketch.
SHINGLE, K = 5, 128
#: Bits of a hash.
BITS = 48
#: Texts are hashed so many bytes at a time.
WINDOW = 1 << 22
#: Ranges of documents for each of the session's shuffle partitions, and rows sampled for each range.
RANGES_EACH, SAMPLED = 4, 20

_R = 0x9E3779B97F4A7C15
_INVERSE = pow(_R, -1, 2**64)
_grown: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """The powers 0 to n-1 of an odd number modulo 2^64."""
    have = _grown.get(base, np.ones(1, dtype=np.uint64))
    while len(have) < n:
        have = np.concatenate([have, have * np.uint64(int(have[-1]) * base % 2**64)])
    _grown[base] = have
    return have[:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers that spreads every bit over all (the finaliser of SplitMix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_WHITE = np.zeros(256, dtype=bool)
_WHITE[[32, *range(9, 14)]] = True


def word_hashes(data: bytes) -> np.ndarray:
    """One 64-bit hash per word, a run of bytes other than ASCII white space.

    A word's polynomial is the difference of two prefix sums, shifted to start at
    power 0. Longer data are hashed window by window, cut at white space where
    there is any; a word longer than a window is hashed on its own.
    """
    out = []
    start = 0
    while start < len(data):
        end = min(start + WINDOW, len(data))
        if end < len(data):
            white = np.flatnonzero(_WHITE[np.frombuffer(data[start:end], dtype=np.uint8)])
            if len(white):
                end = start + int(white[-1]) + 1
            else:  # one long word
                step = data[start:].split(None, 1)[0]
                end = start + len(step)
        raw = np.frombuffer(data[start:end], dtype=np.uint8)
        white = np.concatenate([[True], _WHITE[raw], [True]])
        edge = np.flatnonzero(white[1:] != white[:-1])
        begin, stop = edge[::2], edge[1::2]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _power(_R, len(raw)))])
        poly = (sums[stop] - sums[begin]) * _power(_INVERSE, len(raw) + 1)[begin]
        out.append(_mixed(poly ^ (stop - begin).astype(np.uint64)))
        start = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingle_hashes(text: str | None, words_each: int = SHINGLE) -> np.ndarray:
    """A hash per shingle; texts with fewer words are one shingle, texts without words have none."""
    words = word_hashes((text or "").encode())
    each = min(words_each, len(words))
    if not each:
        return words
    n = len(words) - each + 1
    h = np.zeros(n, dtype=np.uint64)
    for k in range(each):
        h = _mixed(h * np.uint64(_R) + words[k : k + n])
    return h >> np.uint64(64 - BITS)


def smallest(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch: the k smallest distinct hashes in order."""
    if len(hashes) > 8 * k:
        hashes = hashes[hashes <= np.partition(hashes, 4 * k)[4 * k]]
        distinct = np.unique(hashes)
        if len(distinct) >= k:
            return distinct[:k]
    return np.unique(hashes)[:k]


def sketch(text: str | None, k: int = K, words_each: int = SHINGLE) -> np.ndarray:
    hashes = shingle_hashes(text, words_each)
    found = smallest(hashes, k)
    return found if len(found) == k else np.unique(hashes)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of two parts together."""
    return np.union1d(a, b)[:k]


def distinct_count(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below k."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[k - 1]) + 1) / 2.0**BITS)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of shingles in both among those in either; 1 for two empty texts."""
    both = merge(a, b, k)
    if not len(both):
        return 1.0
    return float(np.isin(both, a).astype(int) @ np.isin(both, b).astype(int)) / len(both)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's distinct shingles that b has; 1 for an empty a."""
    if not len(a):
        return 1.0
    shared = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return min(1.0, shared / distinct_count(a, k))


def text_of(a: np.ndarray) -> str:
    """A sketch as text: 12 hex digits per hash."""
    return a.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8 :].tobytes().hex()


def of_text(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(fingerprint), dtype=np.uint8).reshape(-1, BITS // 8)
    return np.pad(raw, ((0, 0), (8 - BITS // 8, 0))).reshape(-1).view(">u8").astype(np.uint64)


def edited(text: str, following: str) -> str:
    """The text, its last half replaced by as many of the first code points of the following text, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _edges(keys: DataFrame, ranges: int) -> list[tuple]:
    """(id, hash) pairs at which ranges begin, in the order of the documents, from a sample of SAMPLED rows a range.

    They only say how evenly rows are dealt out; any edges give the same result.
    """
    rows = keys.count()
    share = SAMPLED * ranges / max(1, rows)
    found = [(r["doc_id"], r["h"]) for r in (keys if share >= 1 else keys.sample(False, share, 7)).collect()]
    found.sort(key=lambda r: r[1])
    missing = [r for r in found if r[0] is None]
    found = sorted((r for r in found if r[0] is not None), key=lambda r: r[0], reverse=True) + missing
    return list(dict.fromkeys(found[len(found) * k // ranges] for k in range(1, ranges))) if found else []


def _range(edges: list[tuple], id_type: str) -> Column:
    """The range of a row (doc_id, h): how many edges don't lie behind it, found by halving."""
    if not edges:
        return F.lit(0)
    ids = F.array(*[F.lit(e[0]).cast(id_type) for e in edges])
    hashes = F.array(*[F.lit(e[1]) for e in edges])
    doc_id, h = F.col("doc_id"), F.col("h")

    def reached(k: Column) -> Column:
        at, hash_ = F.element_at(ids, k), F.element_at(hashes, k)
        same = doc_id.eqNullSafe(at)
        return F.when(same, h >= hash_).otherwise(F.coalesce(doc_id < at, doc_id.isNull()))

    steps = [1 << k for k in range(len(edges).bit_length() - 1, -1, -1)]
    # acc: edges known not to lie behind the row
    return F.aggregate(
        F.lit(steps),
        F.lit(0),
        lambda acc, step: F.when((acc + step <= len(edges)) & reached(F.least(acc + step, F.lit(len(edges)))), acc + step).otherwise(acc),
    )


def neighbours(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(range, doc_id, text, guest): documents dealt into ranges of their order, and after each range a guest.

    The order is that of falling ids, a missing id last, and among rows with the same
    id that of their texts' hashes; a range is a piece of it, so the rows of one id may
    lie in many ranges. Only rows alike in id and text lie together in any case.
    The guest is a copy of the first document of the next range that has one,
    and of the very first after the last. So every document finds its successor
    in its own range, and each text is shuffled once. The driver sees a bounded sample
    of ids and hashes, and a first id per range; there are as many ranges as the
    session's shuffle partitions ask for.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    hashed = narrow.withColumn("h", F.xxhash64("text"))
    keys = staged(hashed.select("doc_id", "h"), "document-keys")
    id_type = keys.schema["doc_id"].dataType.simpleString()
    edges = _edges(keys, RANGES_EACH * int(spark.conf.get("spark.sql.shuffle.partitions")))
    place = _range(edges, id_type).alias("range")
    # the first of a range has the largest id, and of those the smallest hash
    first = F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", F.bitwise_not("h").alias("flipped")))
    firsts = keys.groupBy(place).agg(first.alias("first")).orderBy("range").select("range", "first.doc_id", "first.flipped").collect()
    own = hashed.select(place, "doc_id", "text", F.lit(False).alias("guest"))
    if not firsts:
        return own
    before = [firsts[-1], *firsts[:-1]]
    hosts = [(b["range"], f["doc_id"], ~f["flipped"]) for b, f in zip(before, firsts)]
    host = F.broadcast(spark.createDataFrame(hosts, f"host int, lead {id_type}, lead_h bigint"))  # a row per range
    leads = hashed.join(host, (F.col("h") == F.col("lead_h")) & F.col("doc_id").eqNullSafe(F.col("lead")))
    head = F.min(F.struct("text", "doc_id")).alias("head")
    guests = leads.groupBy("host").agg(head).select(F.col("host").alias("range"), "head.doc_id", "head.text", F.lit(True).alias("guest"))
    return own.unionByName(guests)


def fingerprint_pairs(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = K, words_each: int = SHINGLE
) -> DataFrame:
    """One row per document: its fingerprint, its edited text's, and how alike they and the next document's are.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, contained_in_edited, n_shingles (estimates). The
    next document has the next smaller id, a missing id being the smallest; rows
    with equal ids follow each other by their texts' hashes, and the last is
    followed by the first. Null texts count as empty; two texts without words
    resemble each other fully. A single document follows itself. Ids may be whole
    numbers or texts. An empty table gives no rows.
    """
    ship(docs.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (range, id, text, sketch) whose successor is still to come

        def row(now, following):
            _, doc_id, body, own = now
            changed = edited(body, following[2])
            other = sketch(changed, k, words_each)
            return (
                doc_id,
                len(body),
                hashlib.sha256(changed.encode()).hexdigest(),
                text_of(own),
                text_of(other),
                resemblance(own, other, k),
                resemblance(own, following[3], k),
                containment(own, other, k),
                distinct_count(own, k),
            )

        for batch in batches:
            rows = []
            for at, doc_id, body, guest in zip(*(c for c in batch.columns)):
                at, doc_id, body, guest = at.as_py(), doc_id.as_py(), body.as_py() or "", guest.as_py()
                now = (at, doc_id, body, sketch(body, k, words_each))
                if last is not None and last[0] == at:
                    rows.append(row(last, now))
                last = None if guest else now
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(zip(*rows), fields.values())], names=list(fields)
                )

    spread = neighbours(docs, id_col, text)
    order = ["range", "guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text"]
    dealt = spread.repartition("range").sortWithinPartitions(*order).select("range", "doc_id", "text", "guest")
    id_type = dealt.schema["doc_id"].dataType.simpleString()
    arrow = pa.int32() if id_type == "int" else pa.string() if id_type == "string" else pa.int64()
    fields = {
        "doc_id": arrow,
        "n_chars": pa.int64(),
        "edited_sha256": pa.string(),
        "fingerprint": pa.string(),
        "edited_fingerprint": pa.string(),
        "near_edited": pa.float64(),
        "near_next": pa.float64(),
        "contained_in_edited": pa.float64(),
        "n_shingles": pa.float64(),
    }
    schema = (
        f"doc_id {id_type}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, contained_in_edited double, n_shingles double"
    )
    return dealt.mapInArrow(task, schema)
