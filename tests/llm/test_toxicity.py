import math
import os
import random
import re
import zlib

import numpy as np
import pytest
from llm_helpers import docs  # noqa: F401
from pyspark.sql import functions as F

from llm import toxicity as tx
from llm.common import documents, table


def slow_kernel(a, b, s):
    """The kernel by listing every subsequence of three characters."""

    def all_of(w):
        out = {}
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, len(w)):
                    if k - i <= s.gap + 2:
                        u = w[i] + w[j] + w[k]
                        out[u] = out.get(u, 0) + s.decay ** (k - i - 2)
        return out

    x, y = all_of(a), all_of(b)
    norm = lambda v: sum(c * c for c in v.values()) ** 0.5
    return (sum(x[u] * y.get(u, 0) for u in x) / (norm(x) * norm(y))) ** s.power if x and y else 0.0


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    plain = ["the", "and", "tion", "house", "green", "walking", "thing", "water", "under", "letter", "number", "people"]
    bad = ["idiot", "moron", "worthless", "stupid"]
    rows = []
    for k in range(n):
        words = [rng.choice(plain) + ("." if rng.random() < 0.1 else "") for _ in range(rng.randint(20, 120))]
        toxic = k % 3 == 0
        for _ in range(3 if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((" ".join(words), int(toxic)))
    return rows


def test_kernel():
    s = tx.Settings()
    words = ["idiot", "idxiot", "aaa", "banana", "ab", "", "élan vital"]
    k = tx.Kernel(["idiot", "banana", "aaaa"], s)
    want = [[slow_kernel(w, m, s) for m in k.landmarks] for w in words]
    assert np.allclose(k(words), want, atol=1e-5)


def test_insults_with_gaps_and_inserted_characters():
    m = tx.fit(corpus())
    held = corpus(200, seed=2)
    p = m.scores([t for t, _ in held])
    assert np.mean([(v >= 0.5) == bool(y) for v, (_, y) in zip(p, held)]) > 0.97
    clean = "the green house and the water under people walking. " * 3
    plain = m.scores([clean])[0]
    assert plain < 0.3
    for word in ("idiot", "i.d.i.o.t", "id-iot", "i d i o t", "I*D*I*O*T", "idiots", "mo_ron"):
        assert m.scores([clean + word + " and " + word + " people " + word])[0] > 0.4, word
    assert m.word_margins(["idxiot"])[0] > 5 * abs(m.word_margins(["house"])[0])


def test_fit_without_both_classes():
    for rows in ([], [("a b c", 0)] * 3, [("idiot words here", 1)] * 3):
        p = tx.fit(rows).scores(["", None, "idiot", "x" * 5000])
        assert all(0 <= v <= 1 for v in p) and len(set(p)) == 1


def test_score_of_odd_rows(docs):  # noqa: F811
    m = tx.fit(corpus())
    rows = [(1, None), (2, ""), (None, "idiot moron"), (3, "idiot moron"), (3, "idiot moron"), (4, "z" * 200_000), (5, "the house " * 20_000 + "idiot stupid moron")]
    got = tx.score(docs(rows), m, ["doc_id", "row_key"]).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    score = {r.doc_id: r.score for r in got}
    assert score[1] == score[2] < 0.5 < score[3] and score[5] > 0.5
    assert tx.score(docs([]), m, ["doc_id"]).count() == 0


def test_training_reads_no_held_out_row(spark, folder):
    d, labels = documents(spark, folder), table(spark, folder, "labels")
    sample = tx.training_sample(d, labels)
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    text = {r.doc_id: r.text for r in d.collect()}
    want = sorted((text[i], y) for i, y in toxic.items() if zlib.crc32(str(i).encode()) % 5 and i in text)
    assert sample == want
    bounded = tx.training_sample(d, labels, tx.Settings(per_class=10, characters=20_000))
    assert 0 < len(bounded) <= 60 and sum(len(t) for t, _ in bounded) <= 20_000 and set(bounded) <= set(want)
    empty = labels.filter(F.lit(False))
    assert tx.training_sample(d, empty) == []


def test_rare_class_and_long_documents_in_a_bounded_sample(spark, docs):  # noqa: F811
    rows = [(i, f"idiot {i} " + "x" * 90 if i % 20 == 0 else f"house {i} " + "x" * 90) for i in range(2000)]
    labels = spark.createDataFrame([(i, int(i % 20 == 0)) for i, _ in rows], "doc_id long, toxic int")
    s = tx.Settings(per_class=60, characters=6000)
    sample = tx.training_sample(docs(rows), labels, s)
    assert sum(len(t) for t, _ in sample) <= s.characters
    assert 25 <= sum(y for _, y in sample) <= 30 and 25 <= sum(not y for _, y in sample) <= 30
    # the first documents of each class in the sample's order are too long
    some = {t.split()[1] for t, _ in sample}
    longer = [(i, t + "x" * 7000 if str(i) in some and int(str(i)[-1]) % 4 == 0 else t) for i, t in rows]
    again = tx.training_sample(docs(longer), labels, s)
    assert sum(len(t) for t, _ in again) <= s.characters and min(sum(y for _, y in again), sum(not y for _, y in again)) >= 10


def test_an_id_in_many_rows_is_one_document_of_the_sample(spark, docs):  # noqa: F811
    rows = [(i, f"{'idiot' if i % 2 else 'house'} {i}") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    copies = [(1, f"idiot {k}{'x' * (k % 7)}") for k in range(500)]
    samples = [tx.training_sample(docs(some), labels) for some in ([*copies, *rows], [*rows, *copies[::-1]])]
    used = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5]
    assert samples[0] == samples[1] and len(samples[0]) == len(used) and 1 in used
    assert {t for i, t in rows if i in used and i != 1} <= {t for t, _ in samples[0]}


def test_labels_without_documents_take_no_place_in_the_sample(spark, docs):  # noqa: F811
    rows = [(i, f"{'idiot' if i % 2 else 'house'} {i}") for i in range(100)] + [(200, None)]
    there = [(i, i % 2) for i, _ in rows]
    labels = spark.createDataFrame([*there, *[(1000 + i, i % 2) for i in range(20_000)]], "doc_id long, toxic int")
    s = tx.Settings(per_class=40)
    assert tx.training_sample(docs(rows), labels, s) == tx.training_sample(docs(rows), spark.createDataFrame(there, "doc_id long, toxic int"), s)


# ------------------------------------------------------------------ beside a slow trainer


def slow_sentences(text):
    out = []
    for sentence in re.findall(r"(?:\S*[^\s.!?](?=\s|$)\s*)*\S*[.!?](?=\s|$)|\S.*\S?$", (text or "").lower()):
        words = sentence.split()
        out += [words[k : k + tx.SENTENCE_WORDS] for k in range(0, len(words), tx.SENTENCE_WORDS)]
    return out


def slow_form(word):
    return "\x02" + "".join(c for c in word if c.isalnum())


class SlowModel:
    """The same machine with subsequences listed, a dense gram matrix, and loops over sentences in double precision."""

    def __init__(self, rows, s):
        self.s, self.known = s, {}
        cut = [slow_sentences(t) for t, _ in rows]
        y = [1 if toxic else -1 for _, toxic in rows]
        sets = [{w for sent in c for w in sent} for c in cut]
        toxic, clean = [d for d, k in zip(sets, y) if k > 0], [d for d, k in zip(sets, y) if k < 0]

        def weight(w):
            p = (sum(w in d for d in toxic) + 0.5) / (len(toxic) + 1)
            q = (sum(w in d for d in clean) + 0.5) / (len(clean) + 1)
            return sum(w in d for d in toxic) * math.log(p / q) if p > q else 0.0

        often = sorted((w for w in set().union(*toxic) if len(w) > 2 and sum(w in d for d in toxic) > 1), key=lambda w: (-weight(w), w))[: s.candidates]
        first = {}
        for w in often:
            first.setdefault(slow_form(w), w)
        strings = list(first)
        gram = np.array([[slow_kernel(a, b, s) for b in strings] for a in strings])
        worth = np.array([weight(w) for w in first.values()])
        left, self.landmarks = gram.copy(), []
        picked = []
        while len(picked) < s.landmarks:  # the part of the gram matrix that the picked ones don't explain
            at = int(np.argmax(worth * np.maximum(np.diag(left), 0)))
            if left[at, at] < 0.05:
                break
            picked.append(at)
            left = left - np.outer(left[:, at], left[at]) / left[at, at]
        self.landmarks = [strings[k] for k in picked]
        values, vectors = np.linalg.eigh(gram[np.ix_(picked, picked)])
        root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
        x, owner = [], []
        for d, c in enumerate(cut):
            for sent in c:
                x.append(root @ sum(self.word(w) for w in sent))
                owner.append(d)
        label = [y[d] for d in owner]
        use = [True] * len(x)
        for _ in range(s.rounds):
            w, b = self.machine([(v, k) for v, k, u in zip(x, label, use) if u])
            margin = [float(v @ w) + b for v in x]
            best = {d: max(m for m, o in zip(margin, owner) if o == d) for d in set(owner)}
            use = [k < 0 or m >= min(best[d], 0.5) for m, d, k in zip(margin, owner, label)]
        self.beta, self.bias = root @ w, b
        self.slope, self.offset = tx.calibrate(np.array([self.evidence(c) for c in cut]), np.array(y))

    def word(self, w):
        if w not in self.known:
            self.known[w] = np.array([slow_kernel(slow_form(w), m, self.s) for m in self.landmarks])
        return self.known[w]

    def machine(self, rows):
        pos, neg = sum(y > 0 for _, y in rows), sum(y < 0 for _, y in rows)
        weights = [1 / pos if y > 0 else 2 / neg for _, y in rows]
        whole = sum(weights)
        w, b, ws, bs = np.zeros(len(self.landmarks)), 0.0, [], []
        for t in range(1, self.s.steps + 1):
            step, move, shift = 30 / math.sqrt(t), np.zeros_like(w), 0.0
            for (x, y), a in zip(rows, weights):
                if y * (float(x @ w) + b) < 1:
                    move, shift = move + a * y / whole * x, shift + a * y / whole
            w, b = w * (1 - step * self.s.penalty) + step * move, b + step * 0.1 * shift
            if t > self.s.steps // 2:
                ws.append(w)
                bs.append(b)
        return sum(ws) / len(ws), sum(bs) / len(bs)

    def evidence(self, sentences):
        adds = [[float(self.word(w) @ self.beta) for w in sent] for sent in sentences]
        margins = sorted((sum(a) + self.bias for a in adds), reverse=True)[:4] or [self.bias]
        words = [a for sent in adds for a in sent]
        return [margins[0], sum(margins) / len(margins), sum(max(a, 0) for a in words) / math.sqrt(len(words) or 1)]

    def score(self, text):
        return 1 / (1 + math.exp(-float(np.dot(self.evidence(slow_sentences(text)), self.slope) + self.offset)))


def test_scores_are_those_of_a_slow_trainer(docs):  # noqa: F811
    s = tx.Settings(candidates=40, landmarks=6, rounds=2, steps=60)
    rows = corpus(60, seed=3)
    slow, fast = SlowModel(rows, s), tx.fit(rows, s)
    assert slow.landmarks == fast.kernel.landmarks and len(slow.landmarks) >= 4
    held = [t for t, _ in corpus(60, seed=4)] + ["", "the idxiot house. mor_on", "stupid"]
    got = tx.score(docs(list(enumerate(held))), fast, ["doc_id"]).orderBy("doc_id").collect()
    want = [slow.score(t) for t in held]
    assert max(abs(r.score - p) for r, p in zip(got, want)) < 0.02
    assert [r.predicted for r in got] == [int(r.score >= 0.5) for r in got]


def test_calibration_is_at_its_best():
    """No small move of a free weight makes the targets likelier."""
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(300, 3)), rng.choice([-1, 1], 300)
    x[:, 0] += y
    x[:, 2] -= 0.3 * y
    slope, offset = tx.calibrate(x, y)
    target = np.where(y > 0, ((y > 0).sum() + 1) / ((y > 0).sum() + 2), 1 / ((y < 0).sum() + 2))

    def loss(w, b):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        return -(target * np.log(p) + (1 - target) * np.log(1 - p)).sum() + 0.5e-2 * (w @ w + b * b)

    assert (slope >= 0).all() and slope[2] == 0
    for k in (0, 1):
        for move in (-1e-3, 1e-3):
            other = slope.copy()
            other[k] += move
            assert slope[k] == 0 or loss(other, offset) >= loss(slope, offset)


def test_held_out_quality_of_the_whole_query(spark):
    from llm.queries import QUERIES

    where = "/root/testdata/sf0.01"
    if not os.path.isdir(where):
        pytest.skip("larger tables are not there")
    toxic = {r.doc_id: r.toxic for r in table(spark, where, "labels").collect() if r.toxic is not None}
    found = [(r.score, toxic[r.doc_id], r.predicted) for r in QUERIES["op7_toxicity"](spark, where).collect() if r.held_out and r.doc_id in toxic]
    bad, good = [s for s, t, _ in found if t], [s for s, t, _ in found if not t]
    area = np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])
    assert len(bad) >= 4 and area > 0.85 and np.mean([p == t for _, t, p in found]) > 0.9
