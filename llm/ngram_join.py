"""Join of documents by the Jaccard similarity of their word shingles, with a token-group matrix.

Distinct sets of shingles are partitioned into groups of similar ones: sets whose
smallest shingles agree in some band. A matrix row says which groups hold a
shingle. A set can only be linked with a member of a group if enough of its
shingles are the group's, so a query set is counted against all groups in two
steps, and only groups that pass both are opened:

  * by the matrix of prefixes. In one order of all shingles, the same for every set,
    two sets that share a of their shingles share at least l of the first n - a + l
    of each (n: size of the set). The order has the most frequent shingles last, so
    a prefix holds rare ones and a line that many documents share meets nobody.
  * by the group's whole union, in the task that has the group's sets.

In an opened group all sets that may be linked are compared exactly, in place; a
task reports links that connect what is connected and no more. Members of a group
are compared with each other first. A group has bounded size: a larger one is
several groups, which find each other as any others do, so no limit loses a link.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import fresh, ship, staged
from llm.components import components

SHINGLE = 4
#: Least similarity, per cent.
PERCENT = 85
#: Bands that may bring a set into a group, and smallest shingles in each.
BANDS, ROWS = 4, 3
#: Shingles of a group's sets together, at most, unless one set has more.
GROUP_TOKENS = 1 << 19
#: Query sets that meet a group in one task.
SLOT = 4096
#: Shingles whose frequency decides their place in the order. It has no influence on results.
FREQUENT, LEAST_FREQUENT = 1 << 16, 16
#: Rows of a list that may be sent to every task.
BROADCAST_ROWS = 1 << 19
COUNTED_AT_ONCE = 1 << 20
PAIRS_AT_ONCE = 1 << 19


# ------------------------------------------------------------------ sets


def shingles(text: str | None, words_each: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct shingles of a text, ascending; none for a text without words."""
    words = (text or "").encode().lower().split()  # on bytes both know ASCII alone
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    n = max(1, len(words) - words_each + 1)
    spans = zip((ends - sizes)[:n].tolist(), ends[min(words_each, len(words)) - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b]) for a, b in spans), dtype=np.uint64, count=n))


def identity(tokens: np.ndarray) -> bytes:
    return md5(tokens.tobytes(), usedforsecurity=False).digest()


def bands(tokens: np.ndarray) -> list[int]:
    """A key per band: of the smallest shingle of each of its ranges of hashes, or of the next range that has one."""
    edges = (np.arange(BANDS * ROWS, dtype=np.uint64)) * np.uint64((1 << 64) // (BANDS * ROWS))
    first = tokens[np.searchsorted(tokens, edges) % len(tokens)].reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(row.tobytes(), seed=k) - (1 << 63) for k, row in enumerate(first)]


def least_shared(n: int, percent: int = PERCENT) -> int:
    """Shingles that a set of n must share with any set it is linked with."""
    return -(-percent * n // 100)


class Order:
    """The order of all shingles: by hash, those in the list of frequent ones last, by their place there."""

    def __init__(self, times: list[tuple[int, int]]) -> None:
        """times: (token, times) of frequent shingles, the least frequent first."""
        self.times = times
        tokens = np.array([t for t, _ in times], dtype=np.int64).view(np.uint64)
        self.place = np.argsort(tokens)
        self.frequent = tokens[self.place]

    def prefix(self, tokens: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, int]:
        """The first shingles of a set, and how many of them a linked set shares at least.

        It asks for more than one shared shingle where that needs no frequent one.
        """
        n = len(tokens)
        at = np.minimum(np.searchsorted(self.frequent, tokens), max(len(self.frequent) - 1, 0))
        often = self.frequent[at] == tokens if len(self.frequent) else np.zeros(n, dtype=bool)
        ordered = np.concatenate([tokens[~often], tokens[often][np.argsort(self.place[at[often]])]]) if often.any() else tokens
        spare = n - least_shared(n, percent)
        shared = max(1, min(1 + n // 32, int(n - often.sum()) - spare))
        return ordered[: spare + shared], shared


def _texts(batch: pa.RecordBatch, k: int) -> Iterator[str | None]:
    return (t.as_py() for t in batch.column(k))


def mark(docs: DataFrame, id_col: str, text: str, words_each: int = SHINGLE) -> DataFrame:
    """Per document its id, set size, identity and band keys; and rows (token, times) of shingles frequent somewhere.

    Frequencies are counted over all documents, a million shingles at a time; a
    shingle that comes at most twice in a million adds nothing.
    """
    ship(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    out = narrow.select("doc_id", *[F.lit(None).cast(t).alias(c) for c, t in _MARKS]).schema
    names, types = ["doc_id", *[c for c, _ in _MARKS]], [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64()]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often: dict[int, int] = {}
        seen: list[np.ndarray] = []
        kind = None

        def count() -> None:
            token, times = np.unique(np.concatenate(seen), return_counts=True)
            for t, c in zip(token[times > 2].view(np.int64).tolist(), times[times > 2].tolist()):
                often[t] = often.get(t, 0) + c
            seen.clear()

        held = 0
        for batch in batches:
            kind = batch.schema.field(0).type
            sizes, ids, keys = [], [], []
            for t in _texts(batch, 1):
                tokens = shingles(t, words_each)
                sizes.append(len(tokens))
                ids.append(identity(tokens) if len(tokens) else None)
                keys.append(bands(tokens) if len(tokens) else None)
                seen.append(tokens)
                held += len(tokens)
                if held > COUNTED_AT_ONCE:
                    count()
                    held = 0
            none = pa.nulls(len(sizes), pa.int64())
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(keys, types[2]), none, none]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        if seen:
            count()
        if often:
            nothing = [pa.nulls(len(often), t) for t in (kind, *types[:3])]
            numbers = [pa.array(list(x), pa.int64()) for x in (often.keys(), often.values())]
            yield pa.RecordBatch.from_arrays([*nothing, *numbers], names=names)

    return narrow.mapInArrow(task, out)


_MARKS = (("n", "long"), ("set_id", "binary"), ("bands", "array<long>"), ("token", "long"), ("times", "long"))


def frequent(marks: DataFrame) -> list[tuple[int, int]]:
    """(token, times) of the most frequent shingles, the least frequent first; at most FREQUENT come to the driver."""
    counted = marks.filter("token IS NOT NULL").groupBy("token").agg(F.sum("times").alias("times"))
    top = counted.filter(F.col("times") >= LEAST_FREQUENT).orderBy(F.desc("times"), "token").limit(FREQUENT).collect()
    return [(r["token"], r["times"]) for r in reversed(top)]


# ------------------------------------------------------------------ groups


def few(df: DataFrame) -> DataFrame:
    """df, marked for broadcast only if its counted rows are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def groups(sets: DataFrame, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """(num, grp) of the sets that are in a group with others; any other set is a group of its own, named by its number.

    ``sets`` has num, n and bands. A set goes to its band with the most sets; a
    group whose sets hold too many shingles is dealt out over several.
    """
    keyed = sets.select("num", "n", F.posexplode("bands").alias("band", "key"))
    many = staged(keyed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1"), "bands")
    best = F.max(F.struct("sets", F.col("band"), F.col("key")))
    chosen = staged(keyed.join(many, ["band", "key"]).groupBy("num", "n").agg(best.alias("best")), "chosen-bands")
    parts = chosen.groupBy("best").agg(F.ceil(F.sum("n") / F.lit(group_tokens)).alias("parts"))
    part = F.pmod(F.xxhash64("num"), F.col("parts")).alias("part")
    dealt = staged(chosen.join(staged(parts, "group-parts"), "best").select("num", "best", part), "group-members")
    named = dealt.groupBy("best", "part").agg(F.min("num").alias("grp"), F.count(F.lit(1)).alias("members"))
    named = staged(named.filter("members > 1").select("best", "part", "grp"), "group-names")
    return staged(dealt.join(named, ["best", "part"]).select("num", "grp"), "groups")


def _runs(a: np.ndarray) -> np.ndarray:
    """Where the runs of equal columns start, and the number of columns."""
    return np.concatenate([[0], np.flatnonzero((a[:, 1:] != a[:, :-1]).any(axis=0)) + 1, [a.shape[1]]])


class _Hits:
    """Counts, per (query set, group), the shingles of prefixes that meet."""

    names = ("num", "grp", "hits", "least")

    def __init__(self, percent: int) -> None:
        self.percent, self.held, self.size = percent, [], 0

    def add(self, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Rows of _ENTRIES, sorted by the first three; whole runs of (token, slot). Queries meet matrix rows before them."""
        starts = _runs(rows[:2])
        matrix = rows[5] % 4 != QUERY
        ahead = np.cumsum(matrix) - matrix  # matrix rows ahead of each row
        begin = np.repeat(ahead[starts[:-1]], np.diff(starts))
        before = np.where(rows[5] % 4 != MATRIX, ahead - begin, 0)
        where = np.flatnonzero(matrix)
        total = np.cumsum(before)
        at = 0
        while at < len(before):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS_AT_ONCE)))
            n = before[at:to]
            query = np.repeat(np.arange(at, to), n)
            other = where[np.arange(len(query)) - np.repeat(np.cumsum(n) - n, n) + begin[query]]
            yield from self._meet(rows, query, other)
            at = to

    def _meet(self, rows: np.ndarray, query: np.ndarray, other: np.ndarray) -> Iterator[pa.RecordBatch]:
        token, _, group, num, sizes, form = rows
        n, low, high = sizes[query] & _LOW, sizes[other] & _LOW, sizes[other] >> 31
        fit = (group[query] != group[other]) & (100 * n >= self.percent * low) & (100 * high >= self.percent * n)
        query, other = query[fit], other[fit]
        if len(query):
            least = np.minimum(form[query], form[other]) // 4
            found = np.stack([token[query], num[query], group[other], least])
            found = found[:, np.lexsort((least, *found[2::-1]))]
            found = found[:, _runs(found[:3])[:-1]]  # a token counts once
            self.held.append(np.stack([found[1], found[2], np.ones_like(found[0]), found[3]]))
            self.size += found.shape[1]
        if self.size > PAIRS_AT_ONCE:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        every = np.concatenate(self.held, axis=1)
        every = every[:, np.lexsort((every[1], every[0]))]
        first = _runs(every[:2])[:-1]
        columns = [every[0, first], every[1, first], np.add.reduceat(every[2], first), np.minimum.reduceat(every[3], first)]
        self.held, self.size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=self.names)


#: An entry of the matrix, a query that meets entries, or both in one row.
MATRIX, QUERY, BOTH = 0, 1, 2
#: Columns of the rows that meet; sizes holds a least and a greatest size, form the shared shingles and the kind.
_ENTRIES = ("token", "slot", "grp", "num", "sizes", "form")
_LOW = (1 << 31) - 1


def _entries(prefixes: DataFrame, order: Order, slot: int) -> DataFrame:
    """Matrix rows and queries. Queries under a very frequent shingle are dealt over slots, each with its matrix rows.

    Such a shingle's matrix rows are combined per group before they are copied to
    the slots; under any other shingle a row is an entry and a query at once.
    """
    entries = prefixes.select(F.explode("prefix").alias("token"), "grp", "num", "n", "shared")
    sizes = lambda low, high: (low + high * F.lit(1 << 31)).alias("sizes")
    form = lambda shared, kind: (shared * 4 + F.lit(kind)).alias("form")
    n, shared, token, group, num = (F.col(c) for c in ("n", "shared", "token", "grp", "num"))
    hot = [(t, -(-c // slot)) for t, c in order.times if c > slot]
    if not hot:
        return entries.select(token, F.lit(0).cast("long").alias("slot"), group, num, sizes(n, n), form(shared, BOTH))
    slots = F.broadcast(prefixes.sparkSession.createDataFrame(hot, "token long, slots long"))  # at most FREQUENT rows
    cold = entries.join(slots, "token", "left_anti")
    often = entries.join(slots, "token")
    matrix = often.groupBy("token", "slots", "grp").agg(F.min(n).alias("low"), F.max(n).alias("high"), F.min(shared).alias("shared"))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)).alias("slot")
    matrix = matrix.select(token, each, group, F.lit(-1).cast("long").alias("num"), sizes(F.col("low"), F.col("high")), form(shared, MATRIX))
    asked = often.select(token, F.pmod(F.xxhash64("num"), "slots").alias("slot"), group, num, sizes(n, n), form(shared, QUERY))
    single = cold.select(token, F.lit(0).cast("long").alias("slot"), group, num, sizes(n, n), form(shared, BOTH))
    return single.unionByName(matrix).unionByName(asked)


def candidates(prefixes: DataFrame, order: Order, percent: int = PERCENT, slot: int = SLOT) -> DataFrame:
    """(num, grp): query sets with groups that they may be linked with by the matrix of prefixes.

    ``prefixes`` has num, grp, n, shared and prefix. Of two sets the one in the
    group with the higher number is the query.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = _Hits(percent)
        held = np.empty((len(_ENTRIES), 0), dtype=np.int64)  # the run that the next batch may go on with
        for batch in batches:
            held = np.concatenate([held, [c.to_numpy(zero_copy_only=False) for c in batch.columns]], axis=1)
            if held.shape[1]:
                last = int(_runs(held[:2])[-2])
                if last:
                    yield from hits.add(held[:, :last])
                    held = held[:, last:].copy()
        if held.shape[1]:
            yield from hits.add(held)
        yield from hits.rest()

    entries = _entries(prefixes, order, slot)
    dealt = entries.repartition("token", "slot").sortWithinPartitions("token", "slot", "grp", "num")
    found = dealt.select(*_ENTRIES).mapInArrow(task, "num long, grp long, hits long, least long")
    summed = found.groupBy("num", "grp").agg(F.sum("hits").alias("hits"), F.min("least").alias("least"))
    return staged(summed.filter("hits >= least").select("num", "grp"), "qualifying")


# ------------------------------------------------------------------ opened groups


class _Group:
    """The sets of one group with their union: which of its sets hold which shingle."""

    def __init__(self, nums: list[int], sets: list[np.ndarray], percent: int) -> None:
        self.nums, self.sets, self.percent = np.array(nums), sets, percent
        self.sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        tokens = np.concatenate(sets)
        order = np.argsort(tokens, kind="stable")
        self.union, self.starts = np.unique(tokens[order], return_index=True)
        self.starts = np.append(self.starts, len(tokens))
        self.owner = owner[order]
        self.part = np.arange(len(sets))  # sets known to be connected have the same number

    def held(self, tokens: np.ndarray) -> np.ndarray:
        """Places in the union of the shingles that are in it."""
        at = np.minimum(np.searchsorted(self.union, tokens), len(self.union) - 1)
        return at[self.union[at] == tokens]

    def linked(self, tokens: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The members that are similar enough to a set."""
        begin, n = self.starts[places], self.starts[places + 1] - self.starts[places]
        rows = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin, n)
        both = np.bincount(self.owner[rows], minlength=len(self.sizes))
        return np.flatnonzero(100 * both >= self.percent * (self.sizes + len(tokens) - both))

    def inside(self) -> Iterator[tuple[int, int]]:
        """Links that connect the members that are connected within the group."""
        if len(self.sizes) < 2:
            return
        often = np.diff(self.starts)
        typical = [-float(often[np.searchsorted(self.union, s)].mean()) for s in self.sets]
        order = np.lexsort((self.nums, typical)).tolist()
        for k in order[:8]:  # most members of a group of copies are near its most typical ones
            yield from self._join(k)
        largest = int(np.bincount(self.part).argmax())
        one = int(np.flatnonzero(self.part == largest)[0])  # the largest part needs no comparison with itself
        for k in order[8:]:
            if self.part[k] != self.part[one]:
                yield from self._join(k)

    def _join(self, k: int) -> Iterator[tuple[int, int]]:
        for j in self.linked(self.sets[k], np.searchsorted(self.union, self.sets[k])):
            if self.part[j] != self.part[k]:
                self.part[self.part == self.part[j]] = self.part[k]
                yield int(self.nums[k]), int(self.nums[j])

    def query(self, num: int, tokens: np.ndarray) -> Iterator[tuple[int, int]]:
        """Links of a set from elsewhere with one member of each connected part."""
        places = self.held(tokens)
        if len(places) >= least_shared(len(tokens), self.percent):
            found = self.linked(tokens, places)
            for j in found[np.unique(self.part[found], return_index=True)[1]]:
                yield num, int(self.nums[j])


def _open(percent: int):
    """Task over rows (grp, slot, kind, num, tokens) sorted by the first four: members, then queries, of each group."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group, nums, sets = None, None, [], []
        found: list[tuple[int, int]] = []

        def opened() -> _Group | None:
            if not nums:
                return None
            made = _Group(nums, sets, percent)
            links = list(made.inside())
            if at[1] == 0:  # every slot connects them, one reports
                found.extend(links)
            return made

        for batch in batches:
            for grp, slot, kind, num, tokens in zip(*[c.to_pylist() for c in batch.columns[:4]], batch.column(4)):
                if at != (grp, slot):
                    if group is None:
                        opened()
                    at, group, nums, sets = (grp, slot), None, [], []
                value = np.frombuffer(tokens.as_buffer(), dtype=np.uint64)
                if kind == 0:
                    nums.append(num)
                    sets.append(value.copy())
                else:
                    group = group or opened()
                    found.extend(group.query(num, value) if group else ())
            if len(found) > 10_000:
                yield _edges(found)
                found.clear()
        if group is None:
            opened()
        yield _edges(found)

    return task


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])


def meetings(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """(num, grp, slot, kind): where every set is needed, as a member (0) or a query (1); stored.

    ``members`` and ``pairs`` have (num, grp). A group that very many queries meet
    has several slots, each with its members.
    """
    slots = pairs.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / F.lit(SLOT)).alias("slots"))
    slots = staged(slots.filter("slots > 1"), "slots")
    one = F.coalesce("slots", F.lit(1).cast("long"))
    each = F.explode(F.sequence(F.lit(0).cast("long"), one - 1)).alias("slot")
    mine = members.join(slots, "grp", "left").select("num", "grp", each, F.lit(0).alias("kind"))
    asked = pairs.join(slots, "grp", "left").select("num", "grp", F.pmod(F.xxhash64("num"), one).alias("slot"), F.lit(1).alias("kind"))
    return staged(mine.unionByName(asked), "meetings")


def links(meet: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): numbers of sets, linked ones, that connect just what links connect.

    ``meet`` has the rows of ``meetings`` with the tokens of their sets; a row may repeat.
    """
    dealt = meet.select("grp", "slot", "kind", "num", "tokens").repartition("grp", "slot")
    opened = dealt.sortWithinPartitions("grp", "slot", "kind", "num").mapInArrow(_open(percent), "a long, b long")
    return staged(opened, "links")


# ------------------------------------------------------------------ whole join


def _arrays(docs: DataFrame, text: str, words_each: int, order: Order | None, percent: int) -> DataFrame:
    """(set_id, n, shared, prefix) of the documents' sets, or without an order (set_id, tokens); a task gives a set once."""
    ship(docs.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[bytes] = set()
        for batch in batches:
            out: list[tuple] = []
            for t in _texts(batch, 0):
                tokens = shingles(t, words_each)
                key = identity(tokens)
                if not len(tokens) or key in given:
                    continue
                given.add(key)
                if len(given) > 1_000_000:
                    given.clear()  # a set that comes again does no harm
                if order is None:
                    out.append((key, tokens.tobytes()))
                else:
                    prefix, shared = order.prefix(tokens, percent)
                    out.append((key, len(tokens), shared, prefix.view(np.int64)))
            kinds = (pa.binary(), pa.binary()) if order is None else (pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            names = ("set_id", "tokens") if order is None else ("set_id", "n", "shared", "prefix")
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)], names=names)

    schema = "set_id binary, tokens binary" if order is None else "set_id binary, n long, shared long, prefix array<long>"
    return docs.select(F.col(text)).mapInArrow(task, schema)


def _with_tokens(docs: DataFrame, text: str, meet: DataFrame, ids: str, words_each: int, percent: int) -> DataFrame:
    """``meet`` (num, set_id, some_id, ...) with the tokens of the sets: texts of documents with those ids, hashed once more.

    A set that rows with the same id share may come several times.
    """
    key = F.xxhash64(F.col(ids).isNull(), F.col(ids)).alias("key")
    named = meet.select(F.xxhash64(F.col("some_id").isNull(), F.col("some_id")).alias("key")).distinct()
    texts = docs.select(key, F.col(text).alias("text")).join(few(staged(named, "wanted-ids")), "key", "left_semi")
    return _arrays(texts, "text", words_each, None, percent).join(meet.drop("some_id"), "set_id")


def similar_groups(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", words_each: int = SHINGLE, percent: int = PERCENT, group_tokens: int = GROUP_TOKENS
) -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id.

    Documents are linked when 100 times the shingles they share are at least
    ``percent`` times the shingles they have together. Words are runs of anything
    but ASCII white space, A-Z lower-cased; a text with fewer words than a shingle
    is one shingle. component_id is the smallest id that links reach.

    Null, empty and blank texts have no shingles (0) and are linked with nothing,
    so their component_id is their own id. Equal sets are one before anything is
    compared. Repeated rows give a row each. Missing ids take part in links but
    name no component (null if a component has no id). An empty table gives no
    rows; further columns are left out, whatever their names. Shingles are compared
    by 64-bit hashes, sets by 128-bit ones.
    """
    (ids,) = fresh([], "doc_id")
    marks = staged(mark(docs, id_col, text, words_each), "shingle-marks")
    order = Order(frequent(marks))
    marked = marks.filter("token IS NULL")
    whole = marked.filter("n > 0").groupBy("set_id").agg(
        F.min(ids).alias("smallest"), F.first("n").alias("n"), F.first("bands").alias("bands")
    )
    sets = staged(whole.withColumn("num", F.monotonically_increasing_id()), "distinct-sets")
    grouped = groups(sets, group_tokens)
    numbered = sets.select("set_id", "num", "smallest").join(few(grouped), "num", "left")
    numbered = staged(numbered.withColumn("grp", F.coalesce("grp", "num")), "numbered-sets")

    prefixes = _arrays(docs, text, words_each, order, percent).join(numbered.select("set_id", "num", "grp"), "set_id")
    prefixes = staged(prefixes.select("num", "grp", "n", "shared", "prefix"), "prefixes")
    pairs = candidates(prefixes, order, percent)

    asked = pairs.select("grp").distinct()
    opened = numbered.join(asked.unionByName(grouped.select("grp")).distinct(), "grp", "left_semi").select("num", "grp")
    opened = staged(opened, "opened-members")
    known = numbered.select("num", "set_id", F.col("smallest").alias("some_id"))
    meet = staged(meetings(opened, pairs).join(known, "num"), "meeting-sets")
    roots = components(links(_with_tokens(docs, text, meet, id_col, words_each, percent), percent))
    rooted = numbered.join(roots.withColumnRenamed("node", "num"), "num", "left")
    rooted = staged(rooted.select("set_id", "smallest", F.coalesce("root", "num").alias("root")), "rooted-sets")
    least = staged(rooted.groupBy("root").agg(F.min("smallest").alias("component_id")), "set-components")
    label = staged(rooted.join(least, "root").select("set_id", "component_id"), "set-labels")
    found = marked.select(ids, "n", "set_id").join(label, "set_id", "left")
    own = F.when(F.col("n") == 0, F.col(ids)).otherwise(F.col("component_id")).alias("component_id")
    return found.select(F.col(ids).alias("doc_id"), F.col("n").alias("n_shingles"), own)
