"""Toxicity: a support vector machine over a gapped subsequence string kernel with Nyström landmarks.

Two words are alike as far as they share subsequences of three characters; one
that spreads over more characters counts less, by ``decay`` for each gap, and at
most ``gap`` characters are skipped. So an insult with inserted or missing
characters stays near its plain form. The kernel is normalised and raised to a
power, which keeps it positive definite and makes chance likeness vanish. A
sentence is the sum of its words in the kernel's space; landmarks, words of the
training sample, span that space approximately (Nyström), and a linear support
vector machine is trained on sentences. A toxic document teaches by its most
toxic sentences, chosen anew in each round. A document scores as its most toxic
sentence, calibrated to a probability.

Since the machine is linear, a word adds a fixed number to its sentence's margin,
which a task computes once per distinct word.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import fresh, id_text, ship, staged, uniform, within

SLOTS = 1 << 20
#: Words are compared by stretches of at most so many characters; longer ones are the best of overlapping stretches.
STRETCH, OVERLAP = 48, 16
ENDS = frozenset(".!?")
SENTENCE_WORDS = 64
REMEMBERED = 200_000


@dataclass(frozen=True)
class Settings:
    """per_class, characters: bounds of the training sample, in labelled documents of a class and characters of all."""

    per_class: int = 1000
    characters: int = 6_000_000
    candidates: int = 800
    landmarks: int = 96
    decay: float = 0.75
    gap: int = 3
    power: int = 4
    rounds: int = 3
    steps: int = 300
    penalty: float = 1e-4


# ------------------------------------------------------------------ kernel


def subsequences(words: Sequence[str], s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, slot, value) of the subsequences of every word, each slot of a word once; a word's values have length 1."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    code = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), sizes)
    found, value = [], []
    for second in range(1, s.gap + 2):
        for third in range(second + 1, s.gap + 3):
            n = len(code) - third
            if n <= 0:
                continue
            same = np.flatnonzero(owner[:n] == owner[third:])
            h = code[same] * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ code[same + second]) * np.uint64(0xC2B2AE3D27D4EB4F)
            h = (h ^ code[same + third]) * np.uint64(0x165667B19E3779F9)
            found.append((owner[same].astype(np.uint64) << np.uint64(20)) | (h >> np.uint64(44)))
            value.append(np.full(len(same), s.decay ** (third - 2)))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    key = np.concatenate(found)
    order = np.argsort(key, kind="stable")
    key, weight = key[order], np.concatenate(value)[order]
    if not len(key):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    total = np.add.reduceat(weight, first)
    word, slot = (key[first] >> np.uint64(20)).astype(np.int64), (key[first] & np.uint64(SLOTS - 1)).astype(np.int64)
    norm = np.sqrt(np.bincount(word, weights=total * total, minlength=len(words)))
    return word, slot, total / norm[word]


def stretches(word: str) -> list[str]:
    """A word's letters and digits behind a mark of its start, in one piece or overlapping ones."""
    word = "\x02" + "".join(filter(str.isalnum, word))
    if len(word) <= STRETCH:
        return [word]
    return [word[i : i + STRETCH] for i in range(0, len(word) - OVERLAP, STRETCH - OVERLAP)]


@dataclass
class Kernel:
    """The powered kernel against fixed landmarks."""

    landmarks: list[str]
    s: Settings
    place: np.ndarray = field(init=False, repr=False)
    first: np.ndarray = field(init=False, repr=False)
    column: np.ndarray = field(init=False, repr=False)
    value: np.ndarray = field(init=False, repr=False)

    def __post_init__(self) -> None:
        """Per slot, the landmarks that have it: few of them do."""
        word, slot, value = subsequences(self.landmarks, self.s)
        order = np.argsort(slot, kind="stable")
        used, first = np.unique(slot[order], return_index=True)
        self.place = np.full(SLOTS, -1, dtype=np.int32)
        self.place[used] = np.arange(len(used))
        self.first = np.append(first, len(slot))
        self.column, self.value = word[order], value[order]

    def __call__(self, words: Sequence[str]) -> np.ndarray:
        n = len(self.landmarks)
        word, slot, value = subsequences(words, self.s)
        hit = self.place[slot]
        known = hit >= 0
        word, hit, value = word[known], hit[known], value[known]
        each = self.first[hit + 1] - self.first[hit]
        ends = np.cumsum(each)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[hit] - (ends - each), each)
        cell = np.repeat(word, each) * n + self.column[at]
        alike = np.bincount(cell, weights=np.repeat(value, each) * self.value[at], minlength=len(words) * n)
        return (alike.reshape(len(words), n) ** self.s.power).astype(np.float32)


# ------------------------------------------------------------------ texts


def words_of(text: str | None) -> tuple[list[str], np.ndarray]:
    """Words in lower case and where sentences start; letters set apart by spaces are one word."""
    tokens = (text or "").lower().split()
    if not tokens:
        return [], np.empty(0, dtype=np.int64)
    single = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) == 1
    if len(tokens) > 2 and (single[:-2] & single[1:-1] & single[2:]).any():
        spaced = re.sub(r"(?<!\S)\S(?: \S){2,}(?!\S)", lambda m: m[0].replace(" ", ""), " ".join(tokens))
        tokens = spaced.split()
    last = np.fromiter((t[-1] in ENDS for t in tokens), dtype=bool, count=len(tokens))
    starts = np.concatenate([[0], np.flatnonzero(last[:-1]) + 1])
    gaps = np.diff(np.append(starts, len(tokens)))
    if gaps.max() > SENTENCE_WORDS:  # text without stops
        starts = np.unique(np.concatenate([np.arange(a, a + g, SENTENCE_WORDS) for a, g in zip(starts, gaps)]))
    return tokens, starts


@dataclass
class Model:
    kernel: Kernel
    beta: np.ndarray
    bias: float
    slope: np.ndarray
    offset: float
    _young: dict[str, float] = field(default_factory=dict, repr=False)
    _old: dict[str, float] = field(default_factory=dict, repr=False)

    def word_margins(self, words: list[str]) -> list[float]:
        parts = [stretches(w) for w in words]
        flat = [p for ps in parts for p in ps]
        margins = np.concatenate([self.kernel(flat[k : k + 4096]) @ self.beta for k in range(0, len(flat), 4096)]) if flat else []
        out, at = [], 0
        for ps in parts:
            out.append(float(max(margins[at : at + len(ps)], key=abs)) if len(ps) > 1 else float(margins[at]))
            at += len(ps)
        return out

    def margins(self, texts: Sequence[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """What every word of every text adds to its sentence's margin, and where sentences start."""
        cut = [words_of(t) for t in texts]
        if len(self._young) > REMEMBERED:
            self._old, self._young = self._young, {}
        missing = []
        for w in set().union(*(c[0] for c in cut)):
            if w not in self._young:
                if w in self._old:
                    self._young[w] = self._old[w]
                else:
                    missing.append(w)
        self._young.update(zip(missing, self.word_margins(missing)))
        known = self._young.__getitem__
        return [(np.fromiter(map(known, tokens), dtype=np.float64, count=len(tokens)), starts) for tokens, starts in cut]

    def scores(self, texts: Sequence[str | None]) -> list[float]:
        x = np.array([evidence(m, starts, self.bias) for m, starts in self.margins(texts)])
        return (1 / (1 + np.exp(-np.clip(x @ self.slope + self.offset, -500, 500)))).tolist()


def evidence(word_margins: np.ndarray, starts: np.ndarray, bias: float) -> np.ndarray:
    """What a document's score rests on: its most toxic sentence, the next ones, and its toxic words for its length."""
    if not len(word_margins):
        return np.array([bias, bias, 0.0])
    sentences = np.add.reduceat(word_margins, starts) + bias
    top = np.sort(sentences)[::-1][:4]
    return np.array([top[0], top.mean(), np.maximum(word_margins, 0).sum() / np.sqrt(len(word_margins))])


# ------------------------------------------------------------------ training


def pick_landmarks(toxic: list[set[str]], clean: list[set[str]], s: Settings) -> list[str]:
    """Words that set toxic documents apart from clean ones and aren't alike.

    Candidates are weighted by likelihood ratio and count. Each step of a pivoted
    Cholesky decomposition of their kernel takes the one whose weight, times the
    part of it that the landmarks so far don't explain, is largest.
    """
    a, b = Counter(w for d in toxic for w in d), Counter(w for d in clean for w in d)

    def weight(w: str) -> float:
        p, q = (a[w] + 0.5) / (len(toxic) + 1), (b[w] + 0.5) / (len(clean) + 1)
        return a[w] * np.log(p / q) if p > q else 0.0

    ranked = sorted((w for w in a if len(w) > 2 and a[w] > 1), key=lambda w: (-weight(w), w))[: s.candidates]
    strings = list(dict.fromkeys(stretches(w)[0] for w in ranked))
    if not strings:
        return []
    worth = np.array([weight(w) for w in dict((stretches(w)[0], w) for w in reversed(ranked)).values()][::-1])
    gram = Kernel(strings, s)(strings).astype(np.float64)
    left = np.diag(gram).copy()
    basis = np.zeros((len(strings), 0))
    picked: list[int] = []
    while len(picked) < s.landmarks:
        at = int(np.argmax(worth * np.maximum(left, 0)))
        if left[at] < 0.05:
            break
        column = (gram[:, at] - basis @ basis[at]) / np.sqrt(left[at])
        basis = np.column_stack([basis, column])
        left = left - column**2
        picked.append(at)
    return [strings[k] for k in picked]


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, s: Settings) -> tuple[np.ndarray, float]:
    """A linear support vector machine by averaged subgradient steps."""
    w, b = np.zeros(x.shape[1], dtype=np.float32), 0.0  # of x's type, which is not copied then
    mean_w, mean_b, n = np.zeros(x.shape[1]), 0.0, 0
    pull = (weight * y / weight.sum()).astype(np.float32)
    for t in range(1, s.steps + 1):
        inside = np.where(y * (x @ w + b) < 1, pull, np.float32(0))
        step = 30.0 / np.sqrt(t)
        w = (w * (1 - step * s.penalty) + step * (inside @ x)).astype(np.float32)
        b += step * 0.1 * float(inside.sum())
        if t > s.steps // 2:
            mean_w, mean_b, n = mean_w + w, mean_b + b, n + 1
    return mean_w / max(n, 1), float(mean_b / max(n, 1))


def calibrate(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic function of the documents' evidence, by Newton steps with Platt's targets; more evidence never lowers it."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x1 = np.column_stack([x, np.ones(len(x))])
    free = np.ones(x1.shape[1], dtype=bool)
    w = np.zeros(x1.shape[1])
    for _ in range(x1.shape[1]):
        w[:] = 0
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(x1 @ w, -40, 40)))
            g = x1.T @ (p - target) + 1e-2 * w
            h = (x1 * (p * (1 - p))[:, None]).T @ x1 + 1e-2 * np.eye(len(w))
            w[free] -= np.clip(np.linalg.solve(h[np.ix_(free, free)], g[free]), -2, 2)
        if (w[:-1] >= 0).all():
            break
        free[int(np.argmin(w[:-1]))] = False
        w[~free] = 0
    return w[:-1], float(w[-1])


def fit(rows: list[tuple[str, int]], s: Settings = Settings()) -> Model:
    """A model of (text, toxic) rows. Without rows of both classes every score is the share of toxic rows."""
    cut = [words_of(t) for t, _ in rows]
    label = np.array([1 if toxic else -1 for _, toxic in rows])
    sets = [set(t) for t, _ in cut]
    landmarks = pick_landmarks([d for d, y in zip(sets, label) if y > 0], [d for d, y in zip(sets, label) if y < 0], s)
    kernel = Kernel(landmarks, s)
    if not landmarks or not (label > 0).any() or not (label < 0).any():
        share = float((label > 0).mean()) if len(label) else 0.0
        share = min(max(share, 0.01), 0.99)
        return Model(kernel, np.zeros(len(landmarks), np.float32), 0.0, np.zeros(3), float(np.log(share / (1 - share))))
    gram = kernel(landmarks).astype(np.float64)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    root = vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T

    vocabulary = sorted(set().union(*sets))
    number = {w: i for i, w in enumerate(vocabulary)}
    parts = [max(stretches(w), key=len) for w in vocabulary]
    near = np.concatenate([kernel(parts[k : k + 4096]) for k in range(0, len(parts), 4096)])
    sentences, owner = [], []
    for d, (tokens, starts) in enumerate(cut):
        if tokens:
            at = np.fromiter((number[t] for t in tokens), dtype=np.int64, count=len(tokens))
            sentences.append(np.add.reduceat(near[at], starts, axis=0))
            owner.append(np.full(len(starts), d))
    x = np.concatenate(sentences) @ root.astype(np.float32)
    del sentences
    owner = np.concatenate(owner)
    y = label[owner].astype(np.float32)
    use = np.ones(len(x), dtype=bool)
    for round_no in range(s.rounds):
        pos, neg = use & (y > 0), use & (y < 0)
        weight = np.where(pos, 1.0 / max(pos.sum(), 1), np.where(neg, 2.0 / max(neg.sum(), 1), 0.0)) * use.sum()
        w, b = svm(x[use], y[use], weight[use], s)
        margin = x @ w + b
        best = np.full(len(rows), -np.inf)
        np.maximum.at(best, owner, margin)
        # of a toxic document the sentences that look toxic stay, and the most toxic one in any case
        use = (y < 0) | (margin >= np.minimum(best[owner], 0.5))
    beta = root @ w
    words = (near @ beta.astype(np.float32)).astype(np.float64)
    seen = [evidence(words[[number[t] for t in tokens]], starts, b) for tokens, starts in cut]
    slope, offset = calibrate(np.array(seen), label)
    return Model(kernel, beta.astype(np.float32), b, slope, offset)


def held_out(id_col: Column) -> Column:
    """Whether a row is kept from training: crc32 of its id as text is 0 modulo 5. A missing id is the empty text."""
    return F.pmod(F.crc32(id_text(id_col).cast("binary")), F.lit(5)) == 0


def training_sample(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> list[tuple[str, int]]:
    """(text, toxic) of a bounded sample: about ``per_class`` labelled documents of each class, by the hash of their ids.

    Each class has half of the characters, and what the other one leaves of its half.
    Labels of ids that no document with a text has don't count. Labels are narrow and
    sampled first; texts are then read by the ids found, in one scan. Of rows with the same id the text with the smallest hash is taken,
    and only those texts are shuffled. The driver sees the ids and the sample.
    """
    own = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).filter(~held_out(F.col("doc_id")))
    own = own.join(docs.filter(F.col("text").isNotNull()).select("doc_id"), "doc_id", "left_semi")
    own = own.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in own.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).count().collect()}
    u = uniform(F.col("doc_id"), salt="toxicity-sample")
    share = F.when(F.col("toxic") > 0, F.lit(1.2 * s.per_class / counts.get(1, 1))).otherwise(F.lit(1.2 * s.per_class / counts.get(0, 1)))
    near = own.withColumn("rank", u / share).filter("rank < 1")
    picked = near.orderBy("rank", "doc_id").limit(3 * s.per_class).collect()
    toxic = {r["doc_id"]: int(r["toxic"] > 0) for r in picked}
    if not toxic:
        return []
    chosen = docs.select("doc_id", "text").filter(F.col("doc_id").isin(list(toxic)) & F.col("text").isNotNull())
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))
    one = staged(chosen.groupBy("doc_id").agg(least["text"].alias("text")), "toxicity-sample")
    size = Counter({r["doc_id"]: r["n"] for r in one.select("doc_id", F.length("text").alias("n")).collect()})
    sized = [(toxic[r["doc_id"]], size[r["doc_id"]]) for r in picked]
    kept = [picked[k]["doc_id"] for k in within(sized, s.characters)]
    rows = one.filter(F.col("doc_id").isin(kept)).collect()
    return sorted((r["text"], toxic[r["doc_id"]]) for r in rows)


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep``, score and predicted of every row.

    Null and empty texts have one sentence without words. Long texts are read
    whole. Rows may repeat; an empty table gives no rows; only the text is an
    input of the score. The model's size is bounded by its landmarks.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                some = batch.slice(k, 64)
                p = found.scores(some.column(len(keep)).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[: len(keep)], pa.array(p, pa.float64()), pa.array([int(v >= 0.5) for v in p], pa.int32())],
                    names=[*keep, "score", "predicted"],
                )

    (read,) = fresh(keep, "text_read")
    narrow = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(read))
    found_fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return narrow.mapInArrow(task, T.StructType([*narrow.schema.fields[:-1], *found_fields]))
