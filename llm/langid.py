"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

A text's features are its character n-grams (1 to 3 code points, lower case),
hashed into a fixed number of slots, weighted by TF-IDF and scaled to length 1.
Weights are trained with the follow-the-regularised-leader rule (FTRL-proximal)
under an elastic-net penalty, on a bounded sample of labelled rows; a part of the
sample that training doesn't see sets the temperature that calibrates the scores.
The model is one array of fixed size, so it is sent to every task whatever the
input; texts are scored where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import fresh, id_text, lean, ship, small_table, staged, uniform, within

LETTER = regex.compile(r"\p{L}")
UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    """slots: hashed features. per_language, characters: bounds of the training sample, in rows of a language and in
    characters of all. Every labelled language is learned. most_languages: more than that are refused, as the
    driver holds 16 bytes and every task 4 for each slot of each language (1.3 GB and 0.3 GB at 5,000).
    alpha, beta, l1, l2: FTRL.
    """

    slots: int = 1 << 14
    per_language: int = 600
    characters: int = 24_000_000
    most_languages: int = 5_000
    epochs: int = 4
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 2e-4
    l2: float = 1e-4
    calibration_share: float = 0.2


def ngram_counts(text: str, slots: int) -> np.ndarray:
    """How often the text's n-grams fall into each slot."""
    code = np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    counts = np.zeros(slots, dtype=np.int64)
    shift = np.uint64(64 - (slots.bit_length() - 1))
    for n, mix in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F), (3, 0x165667B19E3779F9)):
        if len(code) < n:
            break
        gram = code[: len(code) - n + 1].copy()
        for k in range(1, n):
            gram = (gram << np.uint64(21)) | code[k : len(code) - n + 1 + k]
        counts += np.bincount(((gram * np.uint64(mix)) >> shift).astype(np.int64), minlength=slots)
    return counts


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def features(self, text: str) -> np.ndarray:
        tf = np.log1p(ngram_counts(text, len(self.idf))) * self.idf
        norm = np.sqrt(tf @ tf)
        return (tf / norm if norm > 0 else tf).astype(np.float32)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language and calibrated probability of each text; without a letter ``und`` and 0."""
        known = [t is not None and LETTER.search(t) is not None for t in texts]
        if not any(known):
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        x = np.stack([self.features(t) for t, k in zip(texts, known) if k])
        p = softmax((x @ self.weights + self.bias) / self.temperature)
        best = iter(zip(p.argmax(axis=1).tolist(), p.max(axis=1).tolist()))
        pairs = [next(best) if k else None for k in known]
        return (
            [UNDETERMINED if b is None else self.languages[b[0]] for b in pairs],
            [0.0 if b is None else float(b[1]) for b in pairs],
        )


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


Row = tuple[np.ndarray, np.ndarray]  # the slots that a text uses, and their values


def ftrl(rows: list[Row], y: np.ndarray, slots: int, classes: int, s: Settings, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of a multinomial logistic regression by FTRL-proximal, one row at a time."""
    z = np.zeros((slots + 1, classes), dtype=np.float64)
    g2 = np.zeros_like(z)
    order = np.random.default_rng(seed)

    def solve(zs: np.ndarray, gs: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zs) * s.l1 - zs
        return np.where(np.abs(zs) <= s.l1, 0.0, shrunk / ((s.beta + np.sqrt(gs)) / s.alpha + s.l2))

    target = np.eye(classes)
    for _ in range(s.epochs):
        for i in order.permutation(len(rows)):
            at, value = np.append(rows[i][0], slots), np.append(rows[i][1], 1.0)
            w = solve(z[at], g2[at])
            error = softmax(value @ w) - target[y[i]]
            g = value[:, None] * error
            new = g2[at] + g * g
            z[at] += g - (np.sqrt(new) - np.sqrt(g2[at])) / s.alpha * w
            g2[at] = new
    w = solve(z, g2)
    return w[:-1].astype(np.float32), w[-1].astype(np.float32)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits under which the rows are likeliest, by golden section on its logarithm."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))
        return float(-np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean())

    low, high, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(rows: list[tuple[str, str]], s: Settings = Settings()) -> Model:
    """A model of (text, language) rows; texts without a letter teach nothing."""
    rows = [(t, lang) for t, lang in rows if t and LETTER.search(t)]
    languages = sorted({lang for _, lang in rows})
    if not languages:
        return Model([UNDETERMINED], np.ones(s.slots, np.float32), np.zeros((s.slots, 1), np.float32), np.zeros(1, np.float32), 1.0)
    used = []
    seen = np.zeros(s.slots, dtype=np.int64)
    for t, _ in rows:
        counts = ngram_counts(t, s.slots)
        at = np.flatnonzero(counts).astype(np.int32)
        used.append((at, np.log1p(counts[at]).astype(np.float32)))
        seen[at] += 1
    idf = np.log((1 + len(rows)) / (1 + seen)) + 1
    x: list[Row] = []
    for at, tf in used:
        value = tf * idf[at]
        x.append((at, (value / np.sqrt(value @ value)).astype(np.float32)))
    y = np.array([languages.index(lang) for _, lang in rows])
    rest = np.random.default_rng(11).random(len(rows)) < s.calibration_share
    if rest.all() or not rest.any():
        rest[:] = False
    w, bias = ftrl([r for r, out in zip(x, rest) if not out], y[~rest], s.slots, len(languages), s)
    logits = np.array([v @ w[at] + bias for (at, v), out in zip(x, rest) if out]).reshape(-1, len(languages))
    return Model(languages, idf, w, bias, temperature(logits, y[rest]))


def training_sample(rows: DataFrame, s: Settings = Settings()) -> list[tuple[str, str]]:
    """(text, language) of a bounded sample of ``rows`` (doc_id, text, lang), spread over the languages.

    Rows with the smallest hashes of their ids and texts, about ``per_language``
    of each language; then as many of them as hold ``characters`` characters, of
    which languages have equal parts. A row that doesn't fit is passed over; of a
    language in which none fits, the beginning of one is taken. Equal rows are one.
    The driver sees a count per language, sizes of about ``per_language`` rows of each, and the sample.
    """
    spark = rows.sparkSession
    labelled = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = labelled.groupBy("lang").count().collect()
    if not counts:
        return []
    if len(counts) > s.most_languages:
        held, sent = (b * s.slots * len(counts) / 1e9 for b in (16, 4))
        raise ValueError(f"{len(counts)} languages would take {held:.1f} GB of the driver and {sent:.1f} GB of every task; is lang a language?")
    part_read = [min(1.0, 1.2 * s.per_language / r["count"]) for r in counts]
    shares = small_table(spark, lang=pa.array([r["lang"] for r in counts], pa.string()), share=pa.array(part_read, pa.float64()))
    u = uniform(F.col("doc_id"), F.md5(F.col("text").cast("binary")), salt="langid-sample")
    near = labelled.select("lang", "text", u.alias("u")).join(F.broadcast(shares), "lang").filter(F.col("u") < F.col("share"))
    one = near.groupBy("lang", "u").agg(F.min("text").alias("text"), (F.col("u") / F.min("share")).alias("rank"))
    near = staged(one, "langid-sample")
    some = near.select("lang", "u", "rank", F.length("text").alias("n")).orderBy("rank", "u", "lang").limit(2 * s.per_language * len(counts)).collect()
    sized, part = [(r["lang"], r["n"]) for r in some], s.characters // len(counts)
    fits = {lang for lang, n in sized if n <= part}
    for k, (lang, n) in enumerate(sized):
        if lang not in fits:
            fits.add(lang)
            sized[k] = lang, part
    kept = within(sized, s.characters)
    chosen = small_table(
        spark,
        lang=pa.array([some[k]["lang"] for k in kept], pa.string()),
        u=pa.array([some[k]["u"] for k in kept], pa.float64()),
        n=pa.array([sized[k][1] for k in kept], pa.int32()),
    )
    read = near.join(F.broadcast(chosen), ["lang", "u"]).select("lang", "u", "rank", F.substr("text", F.lit(1), "n").alias("text"))
    return [(r["text"], r["lang"]) for r in read.orderBy("rank", "u", "lang").collect()]


def held_out(id_col: Column) -> Column:
    """Whether a row is kept from training: crc32 of its id as text is 2 modulo 4. A missing id is the empty text."""
    return F.pmod(F.crc32(id_text(id_col).cast("binary")), F.lit(4)) == 2


def train(docs: DataFrame, s: Settings = Settings()) -> Model:
    return fit(training_sample(docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"), s), s)


def identify(
    docs: DataFrame, model: Model, keep: list[str], text: str = "text", names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """The columns ``keep`` of every row, its language and the score of that, called ``names``.

    ``und`` with score 0 where the text is null or has no letter. Only the text
    is read. An empty table gives no rows; rows may repeat.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # slots x languages numbers, 64 kB a language

    at = keep.index(text) if text in keep else len(keep)  # a text that is kept is sent once

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                some = batch.slice(k, 64)
                lang, score = found.predict(some.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[: len(keep)], pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                    names=[*keep, *names],
                )

    (read,) = fresh(keep, "text_read")
    kept = docs.select(*[F.col(f"`{c}`") for c in keep])
    narrow = kept if text in keep else docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(read))
    found_fields = [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    return narrow.mapInArrow(lean(task), T.StructType([*kept.schema.fields, *found_fields]))


def with_known_language(docs: DataFrame, least: float = 0.0, s: Settings = Settings()) -> DataFrame:
    """The documents whose language is determined, with all their columns; texts without letters go.

    With ``least``, documents whose best score is smaller go as well. How sure a
    score can be depends on how many languages there are, so none goes by default.
    The columns doc_id, text and lang must be there; they keep their values.
    """
    model = train(docs, s)
    lang, score = fresh(docs.columns, "lang_pred", "score")
    found = identify(docs, model, docs.columns, names=(lang, score))
    return found.filter((F.col(lang) != UNDETERMINED) & (F.col(score) >= least)).select(*[F.col(f"`{c}`") for c in docs.columns])
