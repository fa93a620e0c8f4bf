import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_helpers import docs  # noqa: F401

from llm import bpe
from llm.common import documents
from llm.queries import VOCABULARY

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
OWN = bpe.Bpe(open(VOCABULARY, encoding="utf-8").read())


def agrees(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert OWN.encode(text) == want
    assert OWN.decode(want) == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=80))
def test_any_text(text):
    agrees(text)


@pytest.mark.parametrize(
    "text",
    ["", " ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "it's we'll I'M", "\n\n \t x", "日本語 テスト", "აᲊꟜ x", "\x00\x85 "],
)
def test_odd_texts(text):
    agrees(text)


def test_long_pieces_and_both_ways_of_merging():
    rng = random.Random(3)
    for n in (253, 254, 255, 256, 3000, 40_000):
        word = "".join(rng.choice("abcdeths") for _ in range(n))
        agrees(word)
    pieces = ["".join(rng.choice("thereiong ") for _ in range(rng.randint(1, 40))).encode() for _ in range(2000)]
    assert OWN.merge_many(pieces) == [OWN.merge(p) for p in pieces]


def test_forgotten_pieces_are_learned_again():
    own = bpe.Bpe(open(VOCABULARY, encoding="utf-8").read())
    own.remembered = 10
    for k in range(50):
        text = " ".join(f"word{k + j}" for j in range(20))
        assert own.encode(text) == LIBRARY.encode(text).ids


ODD = st.sampled_from("'srevltmdD  a1.\n\t\x85\x1c\u2028é日\u1c89\ua7cb")
TEXTS = st.text(alphabet=st.one_of(ODD, st.characters(exclude_categories=["Cs"])), max_size=30)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(TEXTS, st.builds("{}<|endoftext|>{}".format, TEXTS, TEXTS)), max_size=6))
def test_texts_together_are_cut_as_each_alone(texts):
    newer = {c: "\u0378" for c in map(ord, "".join(texts)) if bpe.unicodedata.category(chr(c)) == "Cn"}
    want = []
    for t in texts:
        parts = bpe.regex.split(r"(<\|endoftext\|>)", t)
        cut = [
            [p] if k % 2 else [p[m.start() : m.end()] for m in bpe.regex.finditer(bpe.SPLIT, p.translate(newer))]
            for k, p in enumerate(parts)
        ]
        want.append([p.encode() for ps in cut for p in ps])
    pieces, bounds = OWN.pieces(texts)
    assert [pieces[a:b].to_pylist() for a, b in zip(bounds, bounds[1:])] == want
    assert list(OWN.encode_many(texts)) == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def test_blocks_of_every_size_merge_as_single_pieces_do():
    rng = random.Random(5)
    sizes = [n for n in [*range(1, 20), 31, 32, 33, 63, 64, 65, 128, 129, 253, 254, 255, 256, 257] for _ in range(bpe.FEW)]
    pieces = ["".join(rng.choice("aeinorst h") for _ in range(n)).encode() for n in sizes]
    assert OWN.merge_many(pieces) == [OWN.merge(p) for p in pieces]


def test_ids_and_texts_between_bounds():
    texts = ["", "one two", "", "é<|endoftext|>é", ""]
    ids, bounds = OWN.encode_all(texts)
    each = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    assert each == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert [bytes(n).decode() for n in OWN.names(ids, bounds)] == [",".join(map(str, e)) for e in each]
    assert list(OWN.decode_all(ids, bounds)) == texts
    half = OWN.encode("日本")[:1]
    assert OWN.decode(half) == LIBRARY.decode(half, skip_special_tokens=False)


def test_python_looks_at_different_pieces_once_not_at_every_piece(monkeypatch):
    own = bpe.Bpe(open(VOCABULARY, encoding="utf-8").read())
    asked = []
    learned = own._learned
    monkeypatch.setattr(own, "_learned", lambda wanted: asked.append(len(wanted)) or learned(wanted))
    texts = [" same words again" * 50] * 100
    assert [i for ids in own.encode_many(texts) for i in ids] == LIBRARY.encode(texts[0], add_special_tokens=False).ids * 100
    assert asked == [3]


def test_texts_are_taken_together_up_to_a_limit():
    assert list(bpe.together([], 5)) == []
    assert list(bpe.together([0, 0, 9, 2, 3, 1], 5)) == [(0, 2), (2, 3), (3, 5), (5, 6)]


def check(rows, got, packed=False):
    assert len(rows) == len(got)
    want = sorted(
        (
            (i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
            for i, t in rows
            for ids in [LIBRARY.encode(t or "", add_special_tokens=False).ids]
        ),
        key=str,
    )
    assert sorted([tuple(r)[:4] for r in got], key=str) == want


def test_documents(spark, folder, docs):
    df = documents(spark, folder)
    check([(r.doc_id, r.text) for r in df.collect()], bpe.encode_documents(df, VOCABULARY).collect())
    rows = [(1, None), (2, ""), (None, "x"), (3, "same"), (3, "same"), (4, "z" * 100_000)]
    got = bpe.encode_documents(docs(rows), VOCABULARY, packed=True).collect()
    check(rows, got)
    assert all(np.frombuffer(r.input_ids, "<u4").size == r.n_tokens for r in got)
    assert bpe.encode_documents(docs([]), VOCABULARY).count() == 0
