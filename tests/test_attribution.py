from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from usageledger.operators.attribution import (
    attribute_credits,
    attribute_groups,
    db_schema_credits,
    month_credits_pivot,
    month_credits_unpivot,
    recent_months,
)
from usageledger.sources.logical import logical

H = datetime(2024, 1, 1, 10)
HOUR = timedelta(hours=1)


@pytest.fixture()
def meters(spark):
    return spark.createDataFrame(
        [(1, "W1", H, H + HOUR, 10.0), (1, "W1", H + HOUR, H + 2 * HOUR, 20.0), (2, "W2", H, H + HOUR, 5.0)],
        "warehouse_id int, warehouse_name string, start_time timestamp_ntz, end_time timestamp_ntz, credits_used double",
    )


def queries(spark, data):
    return spark.createDataFrame(
        data,
        "query_id int, warehouse_id int, start_time timestamp_ntz, execution_time bigint, user_name string, database_name string, schema_name string",
    )


def q(i, wh, t, x, user="u", db="d", schema="s"):
    return (i, wh, t, x, user, db, schema)


@pytest.mark.parametrize("max_bytes", [10**6, 0])
def test_shares(spark, meters, max_bytes):
    df = queries(spark, [q(1, 1, H, 30), q(2, 1, H + HOUR / 2, 10), q(3, 1, H + HOUR, 7), q(4, 2, H + 3 * HOUR, 1)])
    got = attribute_credits(df, meters, max_bytes=max_bytes)
    assert rows(got, "query_id", "pct_credit_used_by_query", "credit_used_by_query") == [(1, 75.0, 7.5), (2, 25.0, 2.5), (3, 100.0, 20.0)]


def test_a_query_on_the_hour_bills_once_or_with_both_ends_twice(spark, meters):
    df = queries(spark, [q(1, 1, H, 10), q(2, 1, H + HOUR, 10)])
    assert attribute_credits(df, meters, "left").filter("query_id = 2").count() == 1
    both = attribute_credits(df, meters, "both").filter("query_id = 2")
    assert rows(both, "meter_start", "credit_used_by_query") == [(H, 5.0), (H + HOUR, 20.0)]
    with pytest.raises(ValueError):
        attribute_credits(df, meters, "right")


def test_an_hour_without_execution_time(spark, meters):
    df = queries(spark, [q(1, 1, H, 0), q(2, 1, H, 0)])
    assert rows(attribute_credits(df, meters), "credit_used_by_query") == [(None,), (None,)]
    assert rows(attribute_credits(df, meters, guard_zero=True), "credit_used_by_query") == [(0.0,), (0.0,)]


def test_meters_longer_than_an_hour(spark):
    long = spark.createDataFrame(
        [(1, "W1", H + HOUR / 2, H + 5 * HOUR, 9.0)],
        "warehouse_id int, warehouse_name string, start_time timestamp_ntz, end_time timestamp_ntz, credits_used double",
    )
    df = queries(spark, [q(1, 1, H, 1), q(2, 1, H + HOUR / 2, 1), q(3, 1, H + 4 * HOUR, 2), q(4, 1, H + 5 * HOUR, 1)])
    assert rows(attribute_credits(df, long), "query_id", "credit_used_by_query") == [(2, 3.0), (3, 6.0)]


def test_groups_sum_to_the_single_queries(spark, folder):
    data, meters = logical(spark, folder, "query_history"), logical(spark, folder, "warehouse_metering")
    single = attribute_credits(data, meters, guard_zero=True).groupBy("meter_name", "user_name").agg(F.round(F.sum("credit_used_by_query"), 6))
    grouped = attribute_groups(data, meters, ["user_name"], max_bytes=0).groupBy("meter_name", "user_name").agg(F.round(F.sum("credits"), 6))
    assert rows(single) == rows(grouped)


def test_all_metered_credits_of_working_hours_are_attributed(spark, folder):
    data, meters = logical(spark, folder, "query_history"), logical(spark, folder, "warehouse_metering")
    per_hour = attribute_credits(data, meters).groupBy("meter_name", "meter_start", "meter_credits").agg(
        F.sum("credit_used_by_query").alias("c"), F.sum("execution_time").alias("t")
    )
    wrong = per_hour.filter((F.col("t") > 0) & (F.abs(F.col("c") - F.col("meter_credits")) > 1e-9))
    assert per_hour.filter("t > 0").count() > 0 and wrong.count() == 0


def test_only_queries_with_a_schema_share_in_the_database_report(spark, meters):
    df = queries(spark, [q(1, 1, H, 10), q(2, 1, H, 90, db=None), q(3, 1, H, 30, schema="t"), q(4, 1, H, 0)])
    got = rows(db_schema_credits(df, meters), "schema_name", "usage_date", "credit_used")
    assert [r[:2] for r in got] == [("s", date(2024, 1, 1)), ("t", date(2024, 1, 1))]
    assert [r[2] for r in got] == pytest.approx([10.0 * 10 / 41, 10.0 * 30 / 41])


def test_months_go_back_over_new_year():
    assert recent_months(date(2024, 2, 10), 3) == [date(2024, 2, 1), date(2024, 1, 1), date(2023, 12, 1)]
    assert recent_months(date(2024, 2, 10), 1, 2) == [date(2023, 12, 1)]


def test_month_pivot_and_back(spark, meters):
    monitors = spark.createDataFrame([("RM", "W1")], "resource_monitor_name string, warehouse_name string")
    df = queries(spark, [q(1, 1, H, 30), q(2, 1, H, 10, "v"), q(3, 2, H, 1)])
    pivoted = month_credits_pivot(df, meters, monitors, date(2024, 2, 10), 2)
    assert pivoted.columns == ["name", "user_name", "resource_monitor_name", "202402_credits", "202401_credits", "202402_query", "202401_query"]
    assert rows(pivoted) == [("W1", "u", "RM", 0.0, 7.5, 0, 1), ("W1", "v", "RM", 0.0, 2.5, 0, 1), ("W2", "u", None, 0.0, 5.0, 0, 1)]
    long = month_credits_unpivot(pivoted)
    assert long.count() == 6 and rows(long.select("attribute").distinct()) == [("202401_credits",), ("202402_credits",)]
    assert long.agg(F.sum("value")).first()[0] == 15.0


@pytest.mark.parametrize("max_bytes", [10**6, 0])
def test_meters_without_a_name_bill_their_queries(spark, max_bytes):
    meters = spark.createDataFrame(
        [(1, "W1", H, H + HOUR, 10.0), (2, None, H, H + HOUR, 6.0)],
        "warehouse_id int, warehouse_name string, start_time timestamp_ntz, end_time timestamp_ntz, credits_used double",
    )
    got = attribute_credits(queries(spark, [q(1, 1, H, 5), q(2, 2, H, 1), q(3, 2, H, 2)]), meters, max_bytes=max_bytes)
    assert rows(got, "query_id", "meter_name", "credit_used_by_query") == [(1, "W1", 10.0), (2, None, 2.0), (3, None, 4.0)]


def test_the_pivot_reaches_back_to_its_first_month(spark, meters):
    monitors = spark.createDataFrame([], "resource_monitor_name string, warehouse_name string")
    df = queries(spark, [q(1, 1, H, 30)])
    got = month_credits_pivot(df, meters, monitors, date(2024, 5, 10), 3, starting_from=2)
    assert got.columns[3:6] == ["202403_credits", "202402_credits", "202401_credits"]
    assert rows(got, "202401_credits", "202401_query") == [(10.0, 1)]


def test_meters_before_the_first_month_are_left_out(spark, meters):
    monitors = spark.createDataFrame([], "resource_monitor_name string, warehouse_name string")
    df = queries(spark, [q(1, 1, H, 30)])
    assert month_credits_pivot(df, meters, monitors, date(2024, 4, 10), 2).count() == 0


def test_sums_shuffle_only_partial_aggregates(spark, folder):
    """With a broadcast meter side the queries themselves are never exchanged."""
    df = db_schema_credits(logical(spark, folder, "query_history"), logical(spark, folder, "warehouse_metering"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
