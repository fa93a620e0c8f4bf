"""Byte-pair encoding with segment trees over the ranks of adjacent pairs.

A piece of text (see ``SPLIT``) starts as one symbol per byte. The leaves of a
segment tree hold the rank of each pair of neighbours together with its place,
and inner nodes the smaller child, so the root names the leftmost pair of lowest
rank. Merging ends when the root holds no rank. Short pieces are merged many at a
time: the trees of a block lie side by side, and a merge in each of them sets three
leaves and then makes every level of all trees anew, with one array operation. Long
pieces are merged on their own; a merge changes three paths to the root, which makes
n log n steps.

Texts are cut into pieces, and their tokens put together, by arrays over many texts at
a time: Python looks at each different piece of them once.

The vocabulary is read once by the driver and broadcast: its size is fixed by
the file (about 1 MB for 50,000 tokens), not by the data.
"""

from __future__ import annotations

import hashlib
import json
import sys
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import lean, ship

#: Fixed value: how byte-level vocabularies of this family split a text before merging.
#: ``piece_starts`` follows it without a search.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Kinds of characters, and what stands before the first.
OTHER, LETTER, NUMBER, WHITE, BLANK, EDGE = range(6)
#: Pieces of more bytes are merged one by one, and so are fewer than FEW of a size.
LONG = 256
FEW = 16
#: Symbols in the trees of a block.
BLOCK = 1 << 16
#: Pieces remembered by a worker, in each of two generations.
REMEMBERED = 250_000
#: Texts are encoded together up to so many bytes; a longer text alone.
BYTES_AT_ONCE = 1 << 18


def byte_alphabet() -> list[str]:
    """The printable stand-in of every byte: itself where it is printable, else the next character from 256 on."""
    own = [chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD) for b in range(256)]
    spare = iter(range(256, 512))
    return [chr(b) if own[b] else chr(next(spare)) for b in range(256)]


def kinds() -> np.ndarray:
    """The kind of every character. Letters and digits that the regex library knows but this Python's Unicode
    tables don't assign are newer than the vocabulary's tables, and count as neither."""
    out = np.full(sys.maxunicode + 1, OTHER, dtype=np.uint8)
    for plane in range(0, len(out), 1 << 16):
        codes = np.arange(plane, plane + (1 << 16), dtype="<u4")
        codes[(codes >= 0xD800) & (codes < 0xE000)] = 0x378  # surrogates are in no text; neither letter, digit nor white space
        some = codes.tobytes().decode("utf-32-le")
        for kind, runs in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\s+")):
            for m in regex.finditer(runs, some):
                newer = kind != WHITE and [unicodedata.category(c) == "Cn" for c in m[0]]
                out[plane + m.start() : plane + m.end()] = np.where(newer, OTHER, kind)
    out[0x20] = BLANK
    return out


def piece_starts(codes: np.ndarray, kind: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Whether a piece, as ``SPLIT`` finds them, starts at each character.

    ``codes`` are those of texts laid end to end, ``kind`` their kinds, and ``edges``
    the ascending places where a text starts; nothing reaches across them.
    """
    before = np.empty_like(kind)
    before[1:] = kind[:-1]
    before[edges] = EDGE
    behind = np.full_like(kind, WHITE)
    behind[:-1] = kind[1:]
    behind[edges[1:] - 1] = WHITE
    # white space: the run but its last character, which stands alone or, if a blank, begins the next piece
    white = kind >= WHITE
    white_before = (before == WHITE) | (before == BLANK)
    starts = np.where(white, ~white_before | (behind < WHITE), (before != kind) & (before != BLANK))
    marks = np.flatnonzero((codes == ord("'")) & starts)
    if len(marks):
        n = len(codes)
        # what follows in the same text, else 0
        one, two = np.minimum(marks + 1, n - 1), np.minimum(marks + 2, n - 1)
        inside = (marks + 1 < n) & (before[one] != EDGE)
        first = np.where(inside, codes[one], 0)
        second = np.where(inside & (marks + 2 < n) & (before[two] != EDGE), codes[two], 0)
        short = np.isin(first, [ord(c) for c in "stmd"])
        long = np.zeros(len(marks), dtype=bool)
        for a, b in ("re", "ve", "ll"):
            long |= (first == ord(a)) & (second == ord(b))
        starts[marks[short | long] + 1] = False
        ends = np.concatenate([marks[short] + 2, marks[long] + 3])
        starts[ends[ends < n]] = True
    return starts


class PairTable:
    """Rank of merging two symbols, for arrays of pairs: hash tables, each for what found its place taken before."""

    def __init__(self, merges: Sequence[tuple[int, int, int]]):
        pairs = np.array([(a << 32) | b for a, b, _ in merges], dtype=np.uint64)
        ranks = np.arange(len(pairs), dtype=np.int64)
        self.none = len(pairs)
        self.tables = []
        seed = 0x9E3779B97F4A7C15
        while len(pairs):
            bits = max(10, int(len(pairs)).bit_length() + 2)
            shift = np.uint64(64 - bits)
            slot = (pairs * np.uint64(seed)) >> shift
            _, first = np.unique(slot, return_index=True)
            keys = np.full(1 << bits, np.uint64(2**64 - 1))
            held = np.full(1 << bits, self.none)
            keys[slot[first]], held[slot[first]] = pairs[first], ranks[first]
            rest = np.ones(len(pairs), dtype=bool)
            rest[first] = False
            crowded = np.zeros(1 << bits, dtype=bool)
            crowded[slot[rest]] = True
            self.tables.append((np.uint64(seed), shift, keys, held, crowded))
            pairs, ranks = pairs[rest], ranks[rest]
            seed = (seed * 0xD1342543DE82EF95 + 1) % 2**64 | 1

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of every pair; ``none`` where there is no merge."""
        pair = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        out = np.full(len(pair), self.none)
        places = slice(None)
        for seed, shift, keys, held, crowded in self.tables:
            slot = ((pair * seed) >> shift).astype(np.intp)
            found = np.where(keys[slot] == pair, held[slot], self.none)
            out[places] = found
            again = np.flatnonzero(crowded[slot] & (found == self.none))
            if not len(again):
                break
            pair = pair[again]
            places = again if isinstance(places, slice) else places[again]
        return out


class Bpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, spec: str):
        model = json.loads(spec)
        vocab: dict[str, int] = model["model"]["vocab"]
        letters = byte_alphabet()
        back = {c: b for b, c in enumerate(letters)}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["model"]["merges"]]
        triples = [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]
        self.pairs = PairTable(triples)
        self.result = np.array([m for *_, m in triples], dtype=np.int64)
        self.ranks = {(a, b): (r, m) for r, (a, b, m) in reversed(list(enumerate(triples)))}
        self.of_byte = np.array([vocab[c] for c in letters], dtype=np.int64)
        special = {t["content"]: t["id"] for t in model["added_tokens"]}
        size = max([*vocab.values(), *special.values()]) + 1
        self.no_symbol = size
        bytes_of = [b""] * size
        for token, i in vocab.items():
            bytes_of[i] = bytes(back[c] for c in token)
        for token, i in special.items():
            bytes_of[i] = token.encode()
        self._bytes = pa.array(bytes_of, pa.large_binary())
        self._names = pa.array([b"%d," % i for i in range(size)], pa.large_binary())
        self.special = {token.encode(): i for token, i in special.items()}
        longest_first = sorted(special, key=len, reverse=True)
        self._special = regex.compile("|".join(map(regex.escape, longest_first))) if special else None
        self._kinds = kinds()
        self.remembered = REMEMBERED
        self._young: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Tokens of one piece of any length."""
        n = len(piece)
        if n == 0:
            return ()
        leaves = 1 << (n + 1).bit_length()
        symbol = [int(self.of_byte[b]) for b in piece] + [-1]
        after, before = list(range(1, n + 2)), list(range(-1, n))
        none = (sys.maxsize, 0)
        tree = [none] * (2 * leaves)

        def leaf(i: int) -> tuple[int, int]:
            found = self.ranks.get((symbol[i], symbol[after[i]])) if after[i] < n else None
            return (found[0], i) if found else none

        for i in range(n):
            tree[leaves + i] = leaf(i)
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        gone = bytearray(n)
        while tree[1] is not none and tree[1][0] < sys.maxsize:
            at = tree[1][1]
            right = after[at]
            symbol[at] = self.ranks[symbol[at], symbol[right]][1]
            after[at] = after[right]
            if after[at] < n:
                before[after[at]] = at
            gone[right] = 1
            for i in {at, right, before[at]}:
                if i >= 0:
                    node = leaves + i
                    tree[node] = none if gone[i] else leaf(i)
                    while node > 1:
                        node >>= 1
                        tree[node] = min(tree[2 * node], tree[2 * node + 1])
        return tuple(s for s, g in zip(symbol, gone) if not g)

    def merge_many(self, pieces: Sequence[bytes]) -> list[tuple[int, ...]]:
        """Tokens of every piece; pieces of like length share a block of segment trees."""
        return [tuple(np.frombuffer(t, "<u4").tolist()) for t in self._merged(pieces)]

    def _merged(self, pieces: Sequence[bytes]) -> list[bytes]:
        """Tokens of every piece as little-endian 32-bit numbers."""
        out = [b""] * len(pieces)
        by_size: dict[int, list[int]] = {}
        for k, n in enumerate(map(len, pieces)):
            if n:
                by_size.setdefault(n if n <= 16 else 1 << (n - 1).bit_length(), []).append(k)
        for size, members in by_size.items():
            if size > LONG or len(members) < FEW:
                for k in members:
                    out[k] = np.array(self.merge(pieces[k]), "<u4").tobytes()
                continue
            block = BLOCK // size
            for start in range(0, len(members), block):
                some = members[start : start + block]
                for k, tokens in zip(some, self._merge_block([pieces[k] for k in some], size)):
                    out[k] = tokens
        return out

    def _merge_block(self, pieces: list[bytes], size: int) -> list[bytes]:
        # symbol k of piece r is at k * rows + r; behind the last are symbols that merge with nothing
        rows, leaves = len(pieces), size + 1
        raw = np.frombuffer(b"".join(p.ljust(leaves, b"\0") for p in pieces), dtype=np.uint8).reshape(rows, leaves)
        length = np.array([len(p) for p in pieces])
        symbol = np.where(np.arange(leaves) < length[:, None], self.of_byte[raw], self.no_symbol).T.reshape(-1)
        end = size * rows
        after = np.arange(rows, (leaves + 1) * rows)
        after[end:] -= rows
        before = np.arange(-rows, end)
        before[:rows] += leaves * rows
        none = self.pairs.none << 8
        tree = np.full((2 * leaves, rows), none, dtype=np.int32 if none < 2**31 else np.int64)
        nodes = tree.reshape(-1)
        leaf = leaves * rows
        rank = self.pairs(symbol[:end], symbol[rows:])
        nodes[leaf : leaf + end] = (rank << 8) | (np.arange(end) // rows)
        levels = []
        high = leaves
        while high > 1:
            low = (high + 1) // 2
            levels.append((tree[2 * low : 2 * high : 2], tree[2 * low + 1 : 2 * high : 2], tree[low:high]))
            high = low
        active = np.arange(rows)
        while True:
            for left, right, above in levels:
                np.minimum(left, right, out=above)
            root = tree[1][active]
            going = root < none
            active, root = active[going], root[going]
            if not len(active):
                break
            here = (root & 255).astype(np.intp) * rows + active
            right, ahead = after[here], before[here]
            beyond = after[right]
            merged = self.result[root >> 8]
            symbol[here], symbol[right] = merged, -1
            after[here], before[beyond] = beyond, here
            ranks = self.pairs(np.concatenate([symbol[ahead], merged]), np.concatenate([merged, symbol[beyond]])) << 8
            changed = np.concatenate([ahead, here])
            nodes[leaf + right] = none
            nodes[leaf + changed] = ranks | (changed // rows)
        left_over = symbol[:end].reshape(size, rows).T
        kept = (left_over >= 0) & (left_over != self.no_symbol)
        packed = left_over[kept].astype("<u4").tobytes()
        ends = (4 * np.cumsum(kept.sum(axis=1))).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def _learned(self, wanted: list[bytes]) -> list[bytes]:
        """Tokens of different pieces, which are remembered."""
        if len(self._young) > self.remembered:
            self._old, self._young = self._young, {}
        out = list(map(self._young.get, wanted))
        unknown = [k for k, tokens in enumerate(out) if tokens is None]
        missing = []
        for k in unknown:
            piece = wanted[k]
            tokens = self._old.get(piece)
            if tokens is None:
                missing.append(k)
            else:
                out[k] = self._young[piece] = tokens
        for k, tokens in zip(missing, self._merged([wanted[k] for k in missing])):
            piece = wanted[k]
            if piece in self.special:
                tokens = np.array([self.special[piece]], "<u4").tobytes()
            out[k] = self._young[piece] = tokens
        return out

    def pieces(self, texts: Sequence[str]) -> tuple[pa.BinaryArray, np.ndarray]:
        """The pieces of all texts, in order, that are merged apart from each other or are special tokens; and the
        number of pieces before each text and of all."""
        whole = "".join(texts)
        data = whole.encode()
        codes = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        bounds = np.cumsum([0, *map(len, texts)])
        if not len(codes):
            return pa.array([], pa.binary()), np.zeros(len(bounds), dtype=np.int64)
        special = [
            (at + m.start(), at + m.end())
            for at, t in zip(bounds.tolist(), texts)
            for m in (self._special.finditer(t) if self._special else ())
        ]
        edges = np.unique(np.concatenate([bounds, np.array(special, dtype=np.int64).reshape(-1)]))
        starts = piece_starts(codes, self._kinds[codes], edges[edges < len(codes)])
        for a, b in special:
            starts[a + 1 : b] = False
        places = np.append(np.flatnonzero(starts), len(codes))
        if len(data) > len(codes):
            size = np.ones(len(codes) + 1, dtype=np.uint8)
            for least in (0x80, 0x800, 0x10000):
                size[1:] += codes >= least
            size[0] = 0
            offsets = np.cumsum(size, dtype=np.int32)[places]
        else:
            offsets = places.astype(np.int32)
        found = pa.Array.from_buffers(pa.binary(), len(places) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        return found, np.searchsorted(places, bounds)

    def encode_all(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts, special tokens in them recognised, and how many stand before each text and in all."""
        pieces, bounds = self.pieces(texts)
        distinct = pieces.dictionary_encode()
        which = distinct.indices.to_numpy()
        tokens = self._learned(distinct.dictionary.to_numpy(zero_copy_only=False).tolist())
        count = np.fromiter(map(len, tokens), np.int64, len(tokens)) // 4
        flat = np.frombuffer(b"".join(tokens), "<u4")
        counts = count[which]
        ends = np.concatenate([[0], np.cumsum(counts)])
        shift = (np.cumsum(count) - count)[which] - ends[:-1]
        return flat[np.repeat(shift, counts) + np.arange(ends[-1])], ends[bounds]

    def encode_many(self, texts: Sequence[str]) -> Iterator[list[int]]:
        ids, bounds = self.encode_all(texts)
        ends = bounds.tolist()
        return (ids[a:b].tolist() for a, b in zip(ends, ends[1:]))

    def encode(self, text: str) -> list[int]:
        return next(iter(self.encode_many([text])))

    def decode(self, ids: Sequence[int]) -> str:
        """The text of the ids; bytes that aren't UTF-8 become U+FFFD."""
        return next(self.decode_all(np.array(ids, "<u4"), np.array([0, len(ids)])))

    def decode_all(self, ids: np.ndarray, bounds: np.ndarray) -> Iterator[str]:
        """The text of the ids between each two bounds."""
        return (str(b, "utf-8", "replace") for b in joined(self._bytes, ids, bounds))

    def names(self, ids: np.ndarray, bounds: np.ndarray) -> Iterator[memoryview]:
        """The decimal ids between each two bounds, joined by commas."""
        return (b[:-1] for b in joined(self._names, ids, bounds))


def joined(of: pa.LargeBinaryArray, ids: np.ndarray, bounds: np.ndarray) -> Iterator[memoryview]:
    """For each two bounds, the values of the ids between them as one."""
    values = of.take(pa.array(ids))
    _, offsets, data = values.buffers()
    ends = np.frombuffer(offsets, np.int64, len(values) + 1)[bounds].tolist() if len(values) else [0] * len(bounds)
    view = memoryview(data or b"")
    return (view[a:b] for a, b in zip(ends, ends[1:]))


def together(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours of at most ``most`` in all, or of one."""
    start = total = 0
    for k, size in enumerate(sizes):
        if k > start and total + size > most:
            yield start, k
            start, total = k, 0
        total += size
    if sizes:
        yield start, len(sizes)


_LOADED: dict[int, Bpe] = {}


def _loaded(spec) -> Bpe:
    """This worker's encoder of a broadcast vocabulary; only the newest is kept."""
    if spec.id not in _LOADED:
        _LOADED.clear()
        _LOADED[spec.id] = Bpe(spec.value)
    return _LOADED[spec.id]


class _Spec:
    """A broadcast with an id that survives pickling."""

    def __init__(self, spark: SparkSession, text: str):
        self.id = hash(text)
        self._broadcast = spark.sparkContext.broadcast(text)

    @property
    def value(self) -> str:
        return self._broadcast.value


def encode_documents(
    docs: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text: str = "text",
    packed: bool = False,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if ``packed``, input_ids.

    ``vocabulary`` is the driver's path of a tokenizer file. ``input_ids`` are
    little-endian 32-bit numbers. A worker remembers the tokens of about twice
    ``remembered`` pieces, some 200 bytes each. Null texts count as empty: no tokens, the
    digests of the empty text. Ids may be null or repeat; an empty table gives
    no rows; other columns are not read. Each task holds a few texts at a time,
    and nothing is shuffled.
    """
    ship(docs.sparkSession)
    with open(vocabulary, encoding="utf-8") as f:
        spec = _Spec(docs.sparkSession, f.read())

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(spec)
        bpe.remembered = remembered
        sha = hashlib.sha256
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for start, end in together(sizes, BYTES_AT_ONCE):
                some = batch.slice(start, end - start)
                ids, bounds = bpe.encode_all([t or "" for t in some.column(1).to_pylist()])
                columns = [
                    some.column(0),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array([sha(n).hexdigest() for n in bpe.names(ids, bounds)], pa.string()),
                    pa.array([sha(t.encode()).hexdigest() for t in bpe.decode_all(ids, bounds)], pa.string()),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if packed:
                    ends, stored = (4 * bounds).tolist(), ids.astype("<u4").tobytes()
                    columns.append(pa.array([stored[a:b] for a, b in zip(ends, ends[1:])], pa.binary()))
                    names.append("input_ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return narrow.mapInArrow(lean(tokens), schema + (", input_ids binary" if packed else ""))
