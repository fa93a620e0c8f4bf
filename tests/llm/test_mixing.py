import math
import re
from collections import defaultdict

from llm_helpers import docs  # noqa: F401

from llm import mixing
from llm.common import documents


def water_fill(sizes, share=1.5, most=2, weights=(3, 1, 2)):
    """Shares by weight; what is over a bound goes to the others, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-8")))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in target]
        if not free:
            return target
        left = total - sum(target.values())
        each = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if each[s] > most * sizes[s]]
        if not over:
            return target | each
        target |= {s: float(most * sizes[s]) for s in over}


def check(rows, got):
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want, largest = water_fill(sizes), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) <= 1e-6 * max(1, want[r.source])
        assert r.taken <= 2 * r.size and (not r.size or r.taken % r.size == 0)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1


def test_odd_rows(docs):
    rows = [(i, "w " * (i % 17), f"s{i % 5}") for i in range(400)]
    rows += [(1000, None, "s1"), (1001, "", None), (1002, "a b c", None), (1003, "a b c", None), (1004, "a", ""), (1005, " ", "\U0001f600"), (None, "x y", "")]
    rows += [(2000, "same words here", "s0")] * 5 + [(2001, "long " * 50_000, "s2")]
    got = mixing.mix_counts(docs([(i, t, "en", s) for i, t, s in rows])).collect()
    assert len(got) == len(rows)
    check(rows, got)
    # complete epochs come first
    per = defaultdict(set)
    for r in got:
        per[r.source].add(r.copies)
    assert all(max(c) - min(c) <= 1 for c in per.values())


def test_whole_table_and_reruns(spark, folder):
    df = documents(spark, folder)
    rows = [(r.doc_id, r.text, r.source) for r in df.collect()]
    got = mixing.mix_counts(df).collect()
    check(rows, got)
    again = mixing.mix_counts(df.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_mixed_documents_are_the_counted_copies(docs):
    df = docs([(i, "w " * (1 + i % 9), "en", f"s{i % 4}") for i in range(200)] + [(500, "q", "en", None)])
    copies = {r.doc_id: r.copies for r in mixing.mix_counts(df).collect()}
    out = mixing.mix(df)
    assert out.columns == df.columns
    found = defaultdict(int)
    for r in out.collect():
        found[r.doc_id] += 1
    assert {k: v for k, v in copies.items() if v} == dict(found)


def test_better_documents_are_likelier(docs):
    clean, junk = "plain words only", "1234 #### 5678 $$$$ 99"
    rows = [(i, clean if i % 2 else junk, "en", "a") for i in range(3000)] + [(9000, "x " * 30, "en", "b")]
    got = [r for r in mixing.mix_counts(docs(rows)).collect() if r.source == "a"]
    low = min(r.copies for r in got)
    more = [r.copies > low for r in got if r.doc_id % 2]
    less = [r.copies > low for r in got if not r.doc_id % 2]
    assert 0 < sum(less) and sum(less) / len(less) < sum(more) / len(more)


def test_empty_tables_and_plan(docs):
    assert mixing.mix_counts(docs([])).count() == 0 and mixing.mix(docs([])).count() == 0
    assert mixing.mix(docs([(1, None, None, None)])).count() in (0, 1, 2)
    plan = mixing.mix_counts(docs([(1, "a", "en", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian", plan)


def test_cut_below_a_range_of_which_nothing_fits(spark, monkeypatch):
    """The cut is the largest key below the range, however near the range's own keys are to it."""
    monkeypatch.setattr(mixing, "RANGE_ROWS", 1)
    edge = -math.log(0.5)  # with two rows there are two ranges, and the second begins here
    low = edge - 1e-14
    rows = spark.createDataFrame([("a", 10, low), ("a", 1000, edge + 1e-14)], "source string, size long, key double")
    (plan,) = mixing.plan_mix(rows, share=0.02, most=2, weights=(1,)).collect()
    assert 0 < plan.target - plan.epochs * plan.source_size < 510 and plan.cut == low
