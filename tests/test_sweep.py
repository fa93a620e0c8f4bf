"""The sweep join against a plain range join."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from usageledger.operators import sweep
from usageledger.operators.attribution import attribute_credits, attribute_groups
from usageledger.sources.logical import logical

T0 = datetime(2024, 3, 9, 22)
MINUTE = timedelta(minutes=1)
INTERVALS = "wh int, name string, begins timestamp_ntz, ends timestamp_ntz"


def points_of(spark, data):
    return spark.createDataFrame(data, "id int, wh int, at timestamp_ntz, begin string")


def cut(rng, keys, minutes):
    """Intervals of all lengths per key, some touching, with gaps between others."""
    out = []
    for k in keys:
        at = 0
        while at < minutes:
            length = rng.choice([1, 1, 10, 60, 1440])
            out.append((k, f"{k}-{at}", T0 + at * MINUTE, T0 + (at + length) * MINUTE))
            at += length + rng.choice([0, 0, 0, 7])
    return out


def plain(points, intervals, closed):
    p, i = points.alias("p"), intervals.alias("i")
    end = F.col("p.at") <= F.col("i.ends") if closed == "both" else F.col("p.at") < F.col("i.ends")
    return p.join(i, (F.col("p.wh") == F.col("i.wh")) & (F.col("p.at") >= F.col("i.begins")) & end).select("id", "name")


@pytest.mark.parametrize("closed", ["left", "both"])
@pytest.mark.parametrize("each", [1, 20])
def test_against_a_range_join(spark, monkeypatch, closed, each):
    monkeypatch.setattr(sweep, "RANGES_EACH", each)
    rng = random.Random(each)
    intervals = spark.createDataFrame(cut(rng, [0, 1, 2, 5], 4000), INTERVALS)
    keys = [0, 0, 0, 0, 1, 2, 3, 5, None]
    data = [(i, rng.choice(keys), T0 + rng.choice([rng.randrange(-10, 4500), 600]) * MINUTE + timedelta(microseconds=rng.choice([0, 0, 1, 999_999])), "p") for i in range(1500)]
    data += [(2000 + i, 0, T0 + 61 * MINUTE, "same") for i in range(500)] + [(9999, 1, None, "never")]
    points = points_of(spark, data)
    got = sweep.sweep_join(points, intervals, "wh", "at", "begins", "ends", ["id"], closed)
    assert rows(got, "id", "name") == rows(plain(points, intervals, closed))
    assert got.columns == ["id", "wh", "at", "begin", "name", "begins", "ends"]


def test_a_hot_key_is_swept_by_many_tasks_and_intervals_stay_one_row(spark):
    intervals = spark.createDataFrame([(0, "all", T0, T0 + timedelta(days=400))], INTERVALS)
    points = spark.range(20_000).select(F.col("id").cast("int").alias("id"), F.lit(0).alias("wh"), F.lit(T0 + MINUTE).cast("timestamp_ntz").alias("at"))
    edges = sweep.sweep_edges(points, "wh", "at", ["id"])
    assert len(edges) >= 14
    got = sweep.sweep_join(points, intervals, "wh", "at", "begins", "ends", ["id"], edges=edges)
    assert got.count() == 20_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
    per_range = sweep._placed(points, "wh", "at", ["id"]).groupBy(sweep._range(edges).alias("r")).count().collect()
    assert len(per_range) >= 14 and max(r["count"] for r in per_range) < 5000


def test_empty_sides(spark):
    intervals, points = spark.createDataFrame([], INTERVALS), points_of(spark, [(1, 1, T0, "p")])
    assert sweep.sweep_join(points, intervals, "wh", "at", "begins", "ends", ["id"]).count() == 0
    some = spark.createDataFrame([(1, "a", T0, T0 + MINUTE)], INTERVALS)
    assert sweep.sweep_join(points.limit(0), some, "wh", "at", "begins", "ends", ["id"]).count() == 0


METERS = "warehouse_id bigint, warehouse_name string, start_time timestamp_ntz, end_time timestamp_ntz, credits_used double"


@pytest.mark.parametrize("closed", ["left", "both"])
def test_meters_of_days_and_minutes_and_overlapping_ones(spark, folder, closed):
    """The same shares as by the hour, also where meters of a warehouse overlap or repeat."""
    queries = logical(spark, folder, "query_history")
    hours = logical(spark, folder, "warehouse_metering").withColumn("credits_used", F.col("credits_used").cast("double"))
    day = F.date_trunc("day", "start_time").cast("timestamp_ntz")
    days = hours.filter("warehouse_id < 4").groupBy("warehouse_id", "warehouse_name", day.alias("start_time")).agg(F.sum("credits_used").alias("credits_used"))
    days = days.withColumn("end_time", F.col("start_time") + F.expr("INTERVAL 1 DAY"))
    quarters = hours.filter("warehouse_id > 6").withColumn("k", F.explode(F.array(*[F.lit(k) for k in range(4)])))
    quarters = quarters.withColumn("start_time", F.col("start_time") + F.expr("make_interval(0, 0, 0, 0, 0, k * 15)"))
    quarters = quarters.withColumn("end_time", F.col("start_time") + F.expr("INTERVAL 15 MINUTES")).drop("k")
    odd = hours.filter("warehouse_id = 5").withColumn("end_time", F.col("end_time") + F.expr("INTERVAL 30 MINUTES"))
    meters = days.unionByName(quarters).unionByName(hours.filter("warehouse_id IN (4, 6)")).unionByName(odd).unionByName(hours.filter("warehouse_id = 6"))
    meters = meters.select(*[c.split()[0] for c in METERS.split(", ")])
    columns = ("query_id", "meter_start", F.round("pct_credit_used_by_query", 9), F.round("credit_used_by_query", 9))
    want = rows(attribute_credits(queries, meters, closed, True), *columns)
    assert rows(attribute_credits(queries, meters, closed, True, max_bytes=0), *columns) == want and len(want) > 500
    sums = lambda most: rows(
        attribute_groups(queries, meters, ["user_name"], closed, max_bytes=most).groupBy("user_name").agg(F.round(F.sum("credits"), 6), F.sum("queries"))
    )
    assert sums(0) == sums(1 << 30)
