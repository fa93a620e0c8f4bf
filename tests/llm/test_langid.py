import math
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import docs  # noqa: F401
from pyspark import SparkContext
from pyspark.sql import functions as F

from llm import langid
from llm.common import documents, small_table

WORDS = {"en": "the and of house with water", "de": "und der die haus mit wässer", "fr": "le la et maison avec élève"}


def corpus(n, seed=1):
    rng = random.Random(seed)
    return [(" ".join(rng.choice(WORDS[k].split()) for _ in range(rng.randint(5, 60))), k) for k in rng.choices(list(WORDS), k=n)]


def test_accuracy_and_calibration():
    m = langid.fit(corpus(300))
    held = corpus(200, seed=2)
    pred, score = m.predict([t for t, _ in held])
    assert np.mean([a == b for a, (_, b) in zip(pred, held)]) > 0.98 and all(0 <= s <= 1 for s in score)
    assert m.languages == ["de", "en", "fr"]
    assert (m.weights == 0).mean() > 0.5  # the penalty leaves unused slots empty


def test_temperature_fits_overconfident_logits():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 2000)
    logits = rng.normal(size=(2000, 3)) + 1.0 * np.eye(3)[y]
    t = langid.temperature(logits * 10, y)
    assert 8 < t < 13
    assert langid.temperature(np.empty((0, 3)), np.empty(0, int)) == 1.0


def test_ngrams_are_counted():
    counts = langid.ngram_counts("aBa", 1 << 14)
    assert counts.sum() == 3 + 2 + 1 and langid.ngram_counts("", 1 << 14).sum() == 0


def test_odd_rows(docs):  # noqa: F811
    m = langid.fit(corpus(200))
    rows = [(1, None), (2, ""), (3, "123 !? \u0660"), (None, "der und die haus"), (4, "the house"), (4, "the house"), (5, "the " * 100_000), (6, "²"), (7, "中")]
    got = langid.identify(docs(rows), m, ["doc_id"]).collect()
    assert len(got) == len(rows)
    found = {r.doc_id: r.lang_pred for r in got}
    assert [found[k] for k in (1, 2, 3, 6)] == ["und"] * 4 and found[None] == "de" and found[4] == found[5] == "en" and found[7] in m.languages
    assert langid.identify(docs([]), m, ["doc_id"]).count() == 0
    assert langid.fit([]).predict(["abc", None]) == (["und", "und"], [1.0, 0.0])


def test_sample_is_bounded_and_leaves_held_out_rows(spark, folder):
    d = documents(spark, folder)
    free = d.filter(~langid.held_out(F.col("doc_id")))
    rows = langid.training_sample(free)
    text = {(r.text, r.lang) for r in d.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    assert rows and set(rows) <= text
    small = langid.training_sample(free, langid.Settings(per_language=5, characters=30_000))
    assert 0 < len(small) <= 40 and sum(len(t) for t, _ in small) <= 30_000


def test_held_out_accuracy(spark, folder):
    d = documents(spark, folder)
    got = langid.identify(d, langid.train(d), ["doc_id", "lang"]).filter(langid.held_out(F.col("doc_id"))).collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.95


def test_filter_keeps_columns(docs):  # noqa: F811
    rows = [(i, t, lang) for i, (t, lang) in enumerate(corpus(120))] + [(500, None, "en"), (501, "42", None)]
    df = docs(rows)
    out = langid.with_known_language(df)
    assert out.columns == df.columns
    kept = {r.doc_id for r in out.collect()}
    assert not kept & {500, 501} and len(kept) >= 115
    assert langid.with_known_language(docs([])).count() == 0


def test_every_language_has_its_part_of_a_bounded_sample(docs):  # noqa: F811
    rows = [(i, f"{i} the and of house " + "water " * 20, "en") for i in range(1500)]
    rows += [(2000 + i, f"{i} und der die haus " + "wasser " * 17, "de") for i in range(30)]
    rows += [(3000 + i, f"{i} le la et maison " + "avec " * 5000, "fr") for i in range(3)]
    rows += [(4000, "the longest one " + "water " * 9000, "en")] + [(None, f"{i} la casa y el " + "agua " * 24, "es") for i in range(30)] * 2
    s = langid.Settings(per_language=100, characters=12_000)
    sample = langid.training_sample(docs(rows), s)
    assert sum(len(t) for t, _ in sample) <= s.characters
    n = {k: sum(lang == k for _, lang in sample) for k in ("en", "de", "fr", "es")}
    assert all(15 <= n[k] <= 25 for k in ("en", "de", "es")) and n["fr"] == 1 and len(set(sample)) == len(sample)


def test_more_than_200_languages_are_learned(docs):  # noqa: F811
    rows = [(i, f"text {i}", f"l{i % 230}") for i in range(460)]
    assert len({lang for _, lang in langid.training_sample(docs(rows))}) == 230


def test_a_column_that_holds_no_languages_is_refused(docs):  # noqa: F811
    rows = [(i, f"text {i}", f"row {i}") for i in range(60)]
    with pytest.raises(ValueError, match=r"\d+ languages would take"):
        langid.train(docs(rows), langid.Settings(most_languages=20))


def test_short_clean_texts_of_many_close_languages_stay(docs):  # noqa: F811
    words = "ba ke di mo nu sa te li ro fu".split()
    rows = [(i, f"{words[i % 10]} {words[i // 10 % 10]}", f"l{i % 12}") for i in range(600)]
    out = langid.with_known_language(docs([*rows, (900, "1 2", "l1"), (901, None, "l1")]))
    assert sorted(r.doc_id for r in out.collect()) == list(range(600))


# ------------------------------------------------------------------ beside a slow trainer


MIX = {1: 0x9E3779B97F4A7C15, 2: 0xC2B2AE3D27D4EB4F, 3: 0x165667B19E3779F9}


def slow_counts(text, slots):
    """n-grams listed one by one."""
    text, out = text.lower(), {}
    for n in (1, 2, 3):
        for i in range(len(text) - n + 1):
            gram = 0
            for c in text[i : i + n]:
                gram = (gram << 21 | ord(c)) % 2**64
            slot = (gram * MIX[n] % 2**64) >> (64 - (slots.bit_length() - 1))
            out[slot] = out.get(slot, 0) + 1
    return out


def slow_softmax(z):
    e = [math.exp(v - max(z)) for v in z]
    return [v / sum(e) for v in e]


def slow_model(rows, s):
    """TF-IDF and FTRL-proximal by plain loops over dictionaries, as published; (languages, idf, weight of (slot, class))."""
    languages = sorted({lang for _, lang in rows})
    counts = [slow_counts(t, s.slots) for t, _ in rows]
    idf = {k: math.log((1 + len(rows)) / (1 + sum(k in c for c in counts))) + 1 for c in counts for k in c}
    vectors = [slow_vector(c, idf) for c in counts]
    rest = np.random.default_rng(11).random(len(rows)) < s.calibration_share
    train = [(v, languages.index(lang)) for (v, (_, lang), out) in zip(vectors, rows, rest) if not out]
    z, n = {}, {}

    def weight(key):
        zk = z.get(key, 0.0)
        if abs(zk) <= s.l1:
            return 0.0
        return (math.copysign(s.l1, zk) - zk) / ((s.beta + math.sqrt(n.get(key, 0.0))) / s.alpha + s.l2)

    order = np.random.default_rng(7)
    for _ in range(s.epochs):
        for i in order.permutation(len(train)):
            v, y = train[i]
            items = [*v.items(), ("bias", 1.0)]
            p = slow_softmax([sum(x * weight((k, c)) for k, x in items) for c in range(len(languages))])
            for c in range(len(languages)):
                for k, x in items:
                    g, key, w = x * (p[c] - (c == y)), (k, c), weight((k, c))
                    before = n.get(key, 0.0)
                    z[key] = z.get(key, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / s.alpha * w
                    n[key] = before + g * g
    logits = lambda v: [sum(x * weight((k, c)) for k, x in [*v.items(), ("bias", 1.0)]) for c in range(len(languages))]
    calibration = [(logits(v), languages.index(lang)) for v, (_, lang), out in zip(vectors, rows, rest) if out]
    return languages, idf, logits, calibration


def slow_vector(counts, idf):
    v = {k: math.log1p(c) * idf.get(k, 0.0) for k, c in counts.items()}
    norm = math.sqrt(sum(x * x for x in v.values()))
    return {k: x / norm for k, x in v.items()} if norm else v


def slow_loss(calibration, t):
    return -sum(math.log(max(slow_softmax([x / t for x in z])[y], 1e-12)) for z, y in calibration) / len(calibration)


def test_scores_are_those_of_a_slow_trainer(docs):  # noqa: F811
    rows = corpus(70, seed=5) + [("d'or et de mer", "fr"), ("the end", "en"), ("das ende", "de")]
    s = langid.Settings(slots=1 << 10, epochs=3)
    languages, idf, logits, calibration = slow_model(rows, s)
    model = langid.fit(rows, s)
    grid = [math.exp(x / 20) for x in range(-78, 60)]
    assert slow_loss(calibration, model.temperature) <= min(slow_loss(calibration, t) for t in grid) + 1e-6
    held = corpus(40, seed=6) + [("the", "en"), ("x", "de"), ("zzz qqq", "en")]
    unseen = math.log(1 + len(rows)) + 1  # the weight of an n-gram that no row has
    want = []
    for t, _ in held:
        c = slow_counts(t, s.slots)
        want.append(slow_softmax([x / model.temperature for x in logits(slow_vector(c, {k: idf.get(k, unseen) for k in c}))]))
    got = langid.identify(docs([(i, t) for i, (t, _) in enumerate(held)]), model, ["doc_id"]).orderBy("doc_id").collect()
    for r, p in zip(got, want):
        assert abs(r.score - max(p)) < 2e-3 and (r.lang_pred == languages[p.index(max(p))] or max(p) - sorted(p)[-2] < 1e-3)


def test_held_out_quality_of_the_whole_query(spark):
    from llm.queries import QUERIES

    where = "/root/testdata/sf0.01"
    if not os.path.isdir(where):
        pytest.skip("larger tables are not there")
    lang = {r.doc_id: r.lang for r in documents(spark, where).select("doc_id", "lang").collect()}
    found = [r for r in QUERIES["op10_language_id"](spark, where).collect() if r.held_out and lang[r.doc_id]]
    assert len(found) > 200 and np.mean([r.lang_pred == lang[r.doc_id] for r in found]) > 0.97
    sure = [r for r in found if r.score > 0.9]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in sure]) > 0.97


def test_small_tables_start_no_python_workers(spark, folder, monkeypatch):
    d = documents(spark, folder)
    before = langid.training_sample(d)

    def refuse(*_, **__):
        raise AssertionError("rows of the driver would be read through Python workers")

    monkeypatch.setattr(SparkContext, "parallelize", refuse)
    assert before and langid.training_sample(d) == before


def test_small_tables_keep_values_and_types(spark):
    columns = {"lang": pa.array(["de", "", "中😀"], pa.string()), "u": pa.array([0.1, 5e-324, 1 - 2**-53]), "n": pa.array([1, 0, 2**31 - 1], pa.int32())}
    got = small_table(spark, **columns)
    assert got.dtypes == [("lang", "string"), ("u", "double"), ("n", "int")]
    assert [tuple(r) for r in got.collect()] == list(zip(*[c.to_pylist() for c in columns.values()]))
    empty = small_table(spark, lang=pa.array([], pa.string()))
    assert empty.dtypes == [("lang", "string")] and empty.collect() == []
