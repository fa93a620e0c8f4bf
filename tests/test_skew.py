import pytest
from conftest import rows
from pyspark.sql import functions as F

from usageledger.operators import skew
from usageledger.operators.skew import fits_broadcast, skew_safe_anti, skew_safe_join


@pytest.fixture()
def facts(spark):
    """Key 0 holds most rows, some keys have no partner, and there are exact copies."""
    return spark.range(300).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 7).cast("int").alias("k"), (F.col("id") % 50).alias("v")
    )


@pytest.fixture()
def dim(spark):
    return spark.createDataFrame([(0, "a"), (0, "b"), (1, "c"), (2, "d"), (9, "e")], "k int, name string")


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
@pytest.mark.parametrize("spread_by", [None, ["v"]])
def test_spreading_gives_the_plain_join(facts, dim, how, spread_by):
    plain = rows(facts.join(dim, "k", how))
    spread = skew_safe_join(facts.repartition(5, "v"), dim, ["k"], how, spread_by, small=False, max_bytes=0, hot_rows=20)
    assert rows(spread.select(*facts.join(dim, "k", how).columns)) == plain


def test_hot_rows_meet_their_partners_in_several_slots(facts, dim):
    joined = skew_safe_join(facts, dim, ["k"], "inner", ["v"], small=False, hot_rows=20)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence" in plan and "pmod" in plan


def test_anti_join_keeps_all_copies(spark, facts):
    seen = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    plain = rows(facts.join(seen, "k", "left_anti"))
    assert rows(skew_safe_anti(facts, seen, ["k"])) == plain
    assert rows(skew_safe_anti(facts.repartition(4), seen, ["k"], max_bytes=0, hot_rows=10)) == plain


def test_every_hot_key_is_split(spark, facts):
    assert rows(skew.hot_keys(facts, ["k"], 10)) == [(0, 22), (1, 2), (2, 2), (3, 2), (4, 2), (5, 2), (6, 2)]
    many = spark.range(60_000).select((F.col("id") % 20_000).alias("k"))
    assert skew.hot_keys(many, ["k"], 2).filter("_fan = 2").count() == 20_000


def test_size_check_stops_at_the_bound(spark):
    row = skew.row_bytes(spark.range(1))
    assert row == 16
    assert fits_broadcast(spark.range(10), 10 * row)
    assert not fits_broadcast(spark.range(11), 10 * row)
    assert not fits_broadcast(spark.range(1), 0)
    assert skew.row_bytes(spark.sql("SELECT 'a' AS t, 1 AS i, date'2024-01-01' AS d, 1.5BD AS n")) == 8 + 64 + 4 + 4 + 16


def test_unknown_join_is_refused(facts, dim):
    with pytest.raises(ValueError):
        skew_safe_join(facts, dim, ["k"], "full")
