import random
import re
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from usageledger.operators import access, skew

MAP = "account string, role string, warehouse string, database string"


@pytest.fixture()
def access_map(spark):
    return spark.createDataFrame(
        [
            ("ANN", None, "WH_A", "DB_A"),
            ("bob", "R1", "WH_.*", "DB_.*"),
            (None, "r1", "WH_1", "DB_1"),
            (None, "R2", "WH_2|WH_3", "DB_[12]"),
            (None, "R2", "WH_2|WH_3", "DB_[12]"),
            (None, "R3", None, "DB_3"),
            ("eve", None, None, "DB_E"),
        ],
        MAP,
    )


def who(ctx, user, *roles):
    return replace(ctx, user=user, roles=roles)


def test_a_users_rows_win_over_roles_whatever_their_case(access_map, ctx):
    assert rows(access.resolve_access_patterns(access_map, who(ctx, "ann", "R1", "R2"))) == [("DB_A", "WH_A")]


def test_roles_apply_to_other_users(access_map, ctx):
    got = rows(access.resolve_access_patterns(access_map, who(ctx, "zoe", "R1", "R2", "R3")))
    assert got == [("DB_1", "WH_1"), ("DB_[12]", "WH_2|WH_3")]


def test_rows_naming_user_and_role_never_apply(access_map, ctx):
    assert rows(access.resolve_access_patterns(access_map, who(ctx, "bob"))) == []


def test_a_user_row_without_pattern_denies_and_still_hides_roles(access_map, ctx):
    assert rows(access.resolve_access_patterns(access_map, who(ctx, "eve", "R1"))) == []


def test_unknown_callers_see_nothing(access_map, spark, ctx):
    patterns = access.resolve_access_patterns(access_map, who(ctx, "zoe", "R9"))
    data = spark.createDataFrame([("DB_1",), (None,)], "database_name string")
    assert access.scope_rows_single(data, patterns, "database_name").count() == 0
    assert access.any_pattern_gate(data, patterns).count() == 0


def test_all_rows_of_a_user_apply(spark, ctx):
    m = spark.createDataFrame([("ann", None, "W1", "D1"), ("ann", None, "W2", "D2")], MAP)
    assert len(rows(access.resolve_access_patterns(m, who(ctx, "Ann")))) == 2


@pytest.fixture()
def data(spark):
    return spark.createDataFrame(
        [(1, "WH_1", "DB_1"), (2, "WH_1", "DB_9"), (3, "WH_9", "DB_1"), (4, "WH_2", "DB_1"), (5, "WH_9", None), (6, None, None), (7, "", "")],
        "id int, warehouse_name string, database_name string",
    )


@pytest.fixture()
def patterns(spark):
    return spark.createDataFrame([("DB_1", "WH_1"), ("DB_5", "WH_2")], "database_pattern string, warehouse_pattern string")


@pytest.mark.parametrize("literal", [1000, 0])
def test_scope_modes(data, patterns, literal):
    """The same rows whether patterns become literals or are read by the tasks."""
    kw = {"literal_characters": literal}
    ids = lambda df: [r[0] for r in rows(df, "id")]
    assert ids(access.scope_rows_single(data, patterns, "database_name", **kw)) == [1, 3, 4]
    assert ids(access.scope_rows_single(data, patterns, "warehouse_name", access.WAREHOUSE, **kw)) == [1, 2, 4]
    assert ids(access.scope_rows_either(data, patterns, **kw)) == [1, 2, 3, 4]
    assert ids(access.scope_rows_both(data, patterns, **kw)) == [1]
    assert ids(access.scope_rows_two_columns(data, patterns, "database_name", "warehouse_name", **kw)) == [1, 3, 4]


def test_scope_keeps_repeated_rows_once_per_row(data, spark):
    overlapping = spark.createDataFrame([("DB_.", "x"), ("DB_1", "x")], "database_pattern string, warehouse_pattern string")
    twice = data.union(data)
    assert access.scope_rows_single(twice, overlapping, "database_name").count() == 8
    assert access.scope_rows_single(twice, overlapping, "database_name", literal_characters=0).count() == 8


@pytest.mark.parametrize("literal", [10**6, 0])
def test_many_patterns(spark, literal):
    """Thousands of patterns are a few expressions, or meet names that are spread over tasks."""
    data = spark.range(3000).selectExpr("id", "concat('DB_', id) AS database_name", "concat('WH_', id % 10) AS warehouse_name")
    wanted = spark.range(2500).selectExpr("concat('DB_', id * 2, '(a|b)?') AS database_pattern", "concat('WH_', id % 5) AS warehouse_pattern")
    got = access.scope_rows_both(data, wanted, literal_characters=literal)
    assert {r.id for r in got.collect()} == {i for i in range(0, 3000, 2) if i % 10 == (i // 2) % 5}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    if literal:
        assert "Join" not in plan and plan.count("RLIKE") <= 12


def test_literal_starts(spark):
    cases = {"DB_1": "DB_1", "DB_1?": "DB_", "DB_1*x": "DB_", "DB_1+": "DB_1", "DB_1{2}": "DB_", ".+": "", "A|B": "", "(?i)db": "", "a.b": "a", "?": "", "": ""}
    df = spark.createDataFrame([(k,) for k in cases], "p string")
    assert {r.p: r.s for r in df.select("p", access._literal_start(access.F.col("p")).alias("s")).collect()} == cases


def test_what_a_pattern_requires(spark):
    cases = {
        ".*_P3_.*": ["_P3", "P3_"], "DB": [], "DB_1": ["DB_", "B_1"], "abcd?e": ["abc"], "abcd+efg": ["abc", "bcd", "efg"], "abc|abd": [],
        "x(abc|abd)yzw": ["yzw"], "x(abc)yzw(a(b)*c)?": ["yzw"], "abc{2}def": ["def"], "[abcd]efg[^hij]{2}klm": ["efg", "klm"], r"abc\.def\dghi": ["abc", "def", "ghi"],
        "(?i)abcdef": [], r"\Qabc\Edef": [], "(?:abc)def": ["def"], "abc.def": ["abc", "def"], "a-b c*": ["a-b", "-b "], "[a[bcd]efg]hij": [], "((((((abc))))))def": [], "": [],
        "ab*cde": ["cde"], "abc(": [], "aaaa": ["aaa"],
    }
    df = spark.createDataFrame([(k,) for k in cases], "p string")
    assert {r.p: r.s for r in df.select("p", access.required_pieces(F.col("p")).alias("s")).collect()} == cases


def test_required_pieces_are_in_every_match(spark):
    """Random patterns over a small alphabet: whatever name a pattern matches contains its trigrams."""
    rng = random.Random(5)
    parts = ["ab", "abc", "a", "b", "_", "a?", "b*", "c+", "[ab]", "(ab|ba)", "(abc)?", ".", ".*", "ab{2}", r"\w", "(a(b|c)a)+", "cab", "[^c]"]
    patterns = ["".join(rng.choices(parts, k=rng.randrange(1, 7))) for _ in range(250)] + ["ab|cabc", "abc_|_abc"]
    names = ["".join(rng.choices("abc_", weights=[4, 4, 3, 1], k=rng.randrange(0, 10))) for _ in range(400)]
    p = spark.createDataFrame([(x,) for x in set(patterns)], "p string").withColumn("need", access.required_pieces(F.col("p")))
    met = p.join(spark.createDataFrame([(x,) for x in set(names)], "n string"), access.full_match_column(F.col("n"), F.col("p")))
    assert met.filter(F.size("need") > 0).count() > 30
    assert met.filter(F.exists("need", lambda t: ~F.contains(F.col("n"), t))).count() == 0
    wanted = p.select(F.col("p").alias("database_pattern"), F.lit("w").alias("warehouse_pattern"))
    data = spark.createDataFrame([(x,) for x in set(names)], "database_name string")
    assert rows(access.scope_rows_single(data, wanted, "database_name", literal_characters=0)) == rows(met.select("n").distinct())


def test_names_meet_few_patterns_that_begin_with_anything(spark):
    """Two thousand patterns of one shape: a name meets about one of them, not all."""
    names = spark.range(4000).select(F.concat(F.lit("DEV_P"), F.col("id").cast("string"), F.lit("_WH")).alias("_subject"))
    middle = F.concat(F.lit(".*_P"), (F.col("id") * 2).cast("string"), F.lit("_.*"))
    patterns = spark.range(2000).select(middle.alias("e"), middle.alias("first"))
    listed = access.indexed_patterns(patterns, names, 4)
    met = access.indexed_names(names, [], 4).join(listed, ["_key", "_slot"])
    per_name = met.groupBy("_subject").count().agg(F.max("count"), F.avg("count")).first()
    assert listed.count() == 2000 and per_name[0] <= 120 and per_name[1] < 40


def test_a_callers_patterns_are_read_in_one_job(spark, access_map, data, ctx):
    caller = who(ctx, "zoe", "R1", "R2", "R3")
    found = access.caller_patterns(access_map, caller)
    assert sorted(found.literals) == rows(access.resolve_access_patterns(access_map, caller))
    assert rows(access.scope_rows_both(data, found)) == rows(access.scope_rows_both(data, found.frame))
    assert access.caller_patterns(access_map, who(ctx, "eve", "R1")).literals == frozenset()
    many = access.caller_patterns(access_map, caller, 3)
    assert many.literals is None and rows(access.scope_rows_either(data, many)) == rows(access.scope_rows_either(data, found))
    assert access.any_pattern_gate(data, many).count() == access.any_pattern_gate(data, found).count() > 0


@pytest.mark.parametrize("literal", [10**6, 0])
def test_all_kinds_of_patterns(spark, literal):
    data = spark.createDataFrame([("DB_1",), ("db_2",), ("DB_11",), ("X",), ("",), ("A-B",), ("Ax B",)], "database_name string")
    wanted = spark.createDataFrame([("DB_1?", "w"), ("(?i)Db_2", "w"), ("Y|X", "w"), ("A.?B", "w"), ("A.{2}B", "w"), ("", "w")], "database_pattern string, warehouse_pattern string")
    got = access.scope_rows_single(data, wanted, "database_name", literal_characters=literal)
    assert rows(got) == [("",), ("A-B",), ("Ax B",), ("DB_1",), ("X",), ("db_2",)]


def test_patterns_with_group_references_stand_alone(spark, data):
    own = spark.createDataFrame([("(D)B_1", "x"), (r"DB_(\d)\1?", "x"), (r"(?<k>W)H_\k<k>?9", "y")], "database_pattern string, warehouse_pattern string")
    assert [r[0] for r in rows(access.scope_rows_single(data, own, "database_name"), "id")] == [1, 2, 3, 4]


def test_few_patterns_add_no_join(data, patterns):
    plan = access.scope_rows_both(data, patterns)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and " IN (" in plan
    loose = patterns.withColumn("database_pattern", F.lit("DB_.*"))
    plan = access.scope_rows_both(data, loose)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.upper().count("RLIKE") == 1


def test_role_gate_and_membership(spark, ctx):
    grants = spark.createDataFrame([("R1", "a"), ("R2", "b")], "grantee_name string, name string")
    assert access.role_gate(grants, ctx).count() == 2
    assert access.role_gate(grants, replace(ctx, roles=("R1",))).count() == 0
    assert rows(access.role_membership_scope(grants, ctx), "name") == [("a",)]


def test_whole_words_are_in_every_match(spark):
    """Words that a pattern has whole are words of every name it matches; through the index the same names are found."""
    cases = {".*_P3_.*": ["P3"], "DB_1_.*": [], ".*_P3": ["P3"], ".*_P3+_x": ["x"], ".*_P3?_x_.*": ["x"], "a.*b_cd-e f": ["cd", "e", "f"], ".*_a|b_c_": [], "(?i).*_ab_": [], ".*_(a|b)_c_": ["c"], r".*_a\_b_c_": ["c"]}
    df = spark.createDataFrame([(k,) for k in cases], "p string")
    assert {r.p: r.s for r in df.select("p", access.required_words(F.col("p")).alias("s")).collect()} == cases
    rng = random.Random(7)
    parts = ["_ab_", "_b", "_", "a", "b_", "_a?", "_b+_", "(_a)?", ".", ".*", "[ab]_", r"\w", "(_b_)+", "-", "_{2}"]
    patterns = ["".join(rng.choices(parts, k=rng.randrange(1, 7))) for _ in range(250)]
    names = ["".join(rng.choices("ab_-", weights=[4, 4, 6, 1], k=rng.randrange(0, 10))) for _ in range(400)]
    p = spark.createDataFrame([(x,) for x in set(patterns)], "p string").withColumn("need", access.required_words(F.col("p")))
    met = p.join(spark.createDataFrame([(x,) for x in set(names)], "n string"), access.full_match_column(F.col("n"), F.col("p")))
    assert met.filter(F.size("need") > 0).count() > 30
    assert met.filter(F.size(F.array_except("need", F.regexp_extract_all("n", F.lit("[A-Za-z0-9]+"), F.lit(0)))) > 0).count() == 0
    wanted = p.select(F.col("p").alias("database_pattern"), F.lit("w").alias("warehouse_pattern"))
    data = spark.createDataFrame([(x,) for x in set(names)], "database_name string")
    assert rows(access.scope_rows_single(data, wanted, "database_name", literal_characters=0)) == rows(met.select("n").distinct())


@pytest.mark.parametrize("middle", ["_P{}_", "p{}q"])
def test_pairs_to_try_grow_with_the_names(spark, middle):
    """Of ten times the names and patterns there are about ten times the pairs, not a hundred times."""
    before, behind = [F.lit(x) for x in middle.split("{}")]

    def pairs(n):
        inner = F.concat(before, (F.col("id") + n).cast("string"), behind)
        names = spark.range(n).select(F.concat(F.lit("DEV"), inner, F.lit("WH")).alias("_subject"))
        expression = F.concat(F.lit(".*"), inner, F.lit(".*"))
        patterns = spark.range(0, n, 2).select(expression.alias("e"), expression.alias("first"))
        return access.indexed_names(names, [], 4).join(access.indexed_patterns(patterns, names, 4), ["_key", "_slot"]).count()

    few, many = pairs(1000), pairs(10_000)
    assert few >= 500 and many <= 12 * few and many <= 5 * 10_000


def test_names_of_a_frequent_key_do_not_meet_in_one_task(spark):
    """Names are listed under keys that patterns ask for; under a key of many names they are dealt out, or left out if nobody looks there."""
    names = spark.range(2000).select(F.concat(F.lit("DB_"), F.col("id").cast("string")).alias("_subject"))
    pattern = F.concat(F.lit("DB_"), F.col("id").cast("string"), F.lit("[0-3]?"))
    patterns = spark.range(1, 2000, 3).select(pattern.alias("e"), pattern.alias("first"))
    listed, hot, kinds = access._listed(patterns, names, 4, 100)
    assert kinds == access.Kinds(starts=(4, 5, 6, 7), pieces=(), words=False, every=False)
    keyed = access.indexed_names(names, kinds.starts, 4, kinds, hot)
    assert keyed.groupBy("_subject").count().agg(F.max("count")).first()[0] <= 4
    assert keyed.filter("_key = 'sDB_1'").count() == 1111
    assert keyed.groupBy("_key", "_slot").count().agg(F.max("count")).first()[0] <= 200
    met = keyed.join(listed, ["_key", "_slot"]).filter(access.full_match_column(F.col("_subject"), F.col("e")))
    want = names.join(patterns, access.full_match_column(F.col("_subject"), F.col("e")), "left_semi")
    assert rows(met.select("_subject").distinct()) == rows(want)
    # nobody looks under the word that all names have, since another one is rarer
    same = names.select(F.concat(F.lit("x_ALL_"), "_subject", F.lit("_")).alias("_subject"))
    both = F.concat(F.lit(".*_ALL_DB_"), F.col("id").cast("string"), F.lit("_.*"))
    listed, hot, kinds = access._listed(spark.range(5).select(both.alias("e"), both.alias("first")), same, 4, 100)
    keyed = access.indexed_names(same, [], 4, kinds, hot)
    assert keyed.filter("_key IN ('wALL', 'wDB', 'w')").count() == 0 and listed.count() == 5
    # and a pattern with nothing to go by meets all names, in every slot
    listed, hot, kinds = access._listed(spark.createDataFrame([("..", "..")], "e string, first string"), names, 4, 100)
    assert kinds.every and sorted(r["_slot"] for r in listed.collect()) == list(range(20))


def test_a_task_holds_a_bounded_number_of_names_with_their_keys(spark, monkeypatch):
    """Names become many rows, one for each of their keys: the tasks are as many as these need, whatever the session's number."""
    names = spark.range(2000).select(F.concat(F.lit("DB_"), F.col("id").cast("string")).alias("database_name"))
    wanted = names.filter("database_name LIKE '%7%'").select(F.concat("database_name", F.lit("[0-3]?")).alias("database_pattern"), F.lit("w").alias("warehouse_pattern"))
    plans, staged = {}, access.staged
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(access, "staged", lambda df, purpose: (plans.update({purpose: plan_of(df)}), staged(df, purpose))[1])
    monkeypatch.setattr(skew, "HOT_BYTES", 500 * 136)  # 500 rows of a name and a key
    got = access.scope_rows_single(names, wanted, "database_name", literal_characters=0)
    tasks = lambda by, plan: [int(n) for n in re.findall(rf"hashpartitioning\({by}, (\d+)\)", plan)]
    assert min(tasks(r"_subject#\d+", plans["name-keys"]), default=0) >= 2000 * 4 / 500
    joined = tasks(r"_key#\d+, _slot#\d+", plan_of(got))
    assert len(joined) == 2 and min(joined) >= 2000 * 4 / 500
    assert min(tasks(r"_subject#\d+", plan_of(got)), default=0) >= 2000 * 4 / 500
    assert rows(got) == rows(names.join(wanted, access.full_match_column(F.col("database_name"), F.col("database_pattern")), "left_semi"))


def test_no_names_or_no_patterns_for_the_join(spark, data, patterns):
    many = {"literal_characters": 0}
    assert access.scope_rows_single(data.limit(0), patterns, "database_name", **many).count() == 0
    assert access.scope_rows_either(data.filter("id = 6"), patterns, **many).count() == 0
    assert access.scope_rows_both(spark.createDataFrame([], data.schema), patterns, **many).count() == 0
    empty = spark.createDataFrame([("", "")], patterns.schema).union(patterns)
    assert [r[0] for r in rows(access.scope_rows_either(data, empty, **many), "id")] == [1, 2, 3, 4, 7]
