import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import docs  # noqa: F401

from llm import merkle
from llm.common import documents


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute(rows):
    """Rows (doc_id, source, lang, n_chars, text) to what prove returns, by plain recursion over lists."""
    found = []
    for row in rows:
        doc_id, *middle, text = row
        edit = doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
        other = [*row[:-1], text.replace("\n", "") if edit else text]
        found.append((row[1], doc_id, h(*map(field, row)), h(*map(field, other))))
    sources = {}
    for r in sorted(found, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        sources.setdefault(r[0], []).append(r)

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h(*out[-1][k : k + 3]) for k in range(0, len(out[-1]), 3)])
        return out

    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([r[2] for r in sources[s]]) for s in names}
    top = levels([trees[s][-1][0] for s in names])

    def climb(tree, at, value, proof):
        for nodes in tree[:-1]:
            run = nodes[at - at % 3 : at - at % 3 + 3]
            proof += run[: at % 3] + run[at % 3 + 1 :]
            value = h(*run[: at % 3], value, *run[at % 3 + 1 :])
            at //= 3
        return value

    out = []
    for k, s in enumerate(names):
        for at, (_, doc_id, leaf, other) in enumerate(sources[s]):
            proof = []
            folded = climb(top, k, climb(trees[s], at, other, proof), proof)
            out.append((doc_id, leaf, trees[s][-1][0], top[-1][0], h(*proof), folded, folded == top[-1][0]))
    return sorted(out, key=str)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def found(df):
    return sorted([tuple(r) for r in df.select(*COLUMNS).collect()], key=str)


def full(df):
    return [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.collect()]


def test_states_are_those_of_sha256():
    rng = np.random.default_rng(1)
    digests = rng.integers(0, 2**32, (3, 8, 50), dtype=np.uint32)
    texts = [merkle._hexed(d) for d in digests]
    state = merkle.start(50)
    assert merkle._hexed(merkle.finish(state, np.zeros(50, dtype=int))) == [hashlib.sha256().hexdigest()] * 50
    for n in range(3):
        state = merkle.resume(state, digests[n])
        want = [hashlib.sha256("".join(t[i] for t in texts[: n + 1]).encode()).hexdigest() for i in range(50)]
        assert merkle._hexed(merkle.finish(state, np.full(50, n + 1))) == want
    many = merkle.start(1)
    for _ in range(200):
        many = merkle.resume(many, digests[0, :, :1])
    assert merkle._hexed(merkle.finish(many, np.array([200])))[0] == hashlib.sha256((texts[0][0] * 200).encode()).hexdigest()


def odd_rows(rng, n):
    rows = []
    for _ in range(n):
        text = rng.choice([None, "", "line\nline\n", "é\n\U0001f600", "plain", "\n" * 5, "x" * 70_000 + "\n"])
        rows.append((rng.choice([None, rng.randrange(400)]), text, rng.choice([None, "en", ""]), rng.choice([None, "", "a", "b", "é", "z", "src"])))
    return rows + rows[:20]


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_against_recursion(docs, levels):
    df = docs(odd_rows(random.Random(levels), 300) + [(9, "alone\n", "en", "only")])
    got = found(merkle.prove(df, levels))
    assert got == brute(full(df))
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 82])
def test_sizes(docs, n):
    df = docs([(i, f"t{i}\n", "en", "s") for i in range(n)])
    assert found(merkle.prove(df, 2)) == brute(full(df))


def test_many_sources(docs):
    df = docs([(i, f"t{i}\n", "en", f"s{i % 90}") for i in range(200)])
    assert found(merkle.prove(df, 1)) == brute(full(df))


def test_empty_table(docs):
    assert found(merkle.prove(docs([]))) == []


def test_one_source_over_many_ranges(spark, docs):
    df = docs([(i, f"t{i}\n", "en", "s" if i % 10 else "r") for i in range(3000)]).repartition(7)
    assert found(merkle.prove(df, 3)) == brute(full(df))


def test_any_replacement_folds_against_a_stored_manifest(spark, docs):
    """A right leaf folds to the root, a wrong one to the root of the table that holds it."""
    rows = [(i, f"text {i}", "en", "ab"[i % 2]) for i in range(100)]
    manifest = merkle.build(docs(rows), 2)
    changed = docs([(d, "else" if d == 42 else t, lang, s) for d, t, lang, s in rows])
    want = merkle.build(changed, 2)
    leaf = want.leaves.filter("id = 42").select("tree", "pos", "id", F.col("leaf").alias("replacement"))
    asked = leaf.join(manifest.leaves.select("tree", "pos", "leaf"), ["tree", "pos"])
    (row,) = merkle.fold(manifest, asked).collect()
    assert row["folded_root"] == want.root != manifest.root


def test_whole_table(spark, folder):
    df = documents(spark, folder)
    got = found(merkle.prove(df))
    assert got == brute(full(df.select("doc_id", "source", "lang", "n_chars", "text")))
