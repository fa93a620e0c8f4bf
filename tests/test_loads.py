"""Incremental reports: batches, boundaries, and what the keys must tell apart."""

from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from usageledger import queries
from usageledger.functions.times import time_literal
from usageledger.plans import loads, views
from usageledger.plans.spec import incremental_load, new_rows, watermark
from usageledger.sources.logical import logical

T0 = datetime(2024, 2, 1, 10)
HOUR = timedelta(hours=1)


def source_of(spark, folder, spec):
    name = {
        "auto_clustering": "table_service",
        "mv_refresh": "table_service",
        "replication": "database_service",
        "search_optimization": "table_service",
        "serverless_task": "task_service",
        "copy_history": "file_loads",
        "load_history": "bulk_loads",
        "database_storage": "database_storage",
        "account_storage": "account_storage",
        "query_history": "query_history",
        "reader_query_history": "reader_query_history",
        "reader_warehouse_credit": "reader_metering",
        "task_history": "task_runs",
        "org_currency": "org_usage",
        "org_rate_sheet": "rate_sheet",
        "org_metering": "org_metering",
    }[spec.name]
    return logical(spark, folder, name)


def context_of(spec):
    if spec.window_days is not None:
        return queries.FILE_LOADS
    return queries.ORDERS if spec.source_time in ("usage_date", "scheduled_time") else queries.EVENTS


SOURCED = [s for n, s in loads.REPORTS.items() if n not in ("pipe_credit", "sessions", "warehouse_credit")]


@pytest.mark.parametrize("spec", SOURCED, ids=lambda s: s.name)
def test_loading_twice_is_loading_once(spark, folder, spec):
    source, ctx = source_of(spark, folder, spec), context_of(spec)
    once = incremental_load(spec, source, None, ctx, spec.retain_days)
    twice = incremental_load(spec, source, once, ctx, spec.retain_days)
    assert twice.columns == once.columns
    order = sorted(once.columns)
    first, second = rows(once, *order), rows(twice, *order)
    assert first and first == second


def test_there_are_nineteen_reports():
    assert len(loads.REPORTS) == 19 and all(s.columns for s in loads.REPORTS.values())


@pytest.mark.parametrize("spec", SOURCED, ids=lambda s: s.name)
def test_a_new_source_column_is_neither_read_nor_stored(spark, folder, tmp_path, spec):
    source, ctx = source_of(spark, folder, spec), context_of(spec)
    kept = source.columns
    source.withColumn("brand_new", F.lit(1)).write.parquet(str(tmp_path / "s"))
    loaded = incremental_load(spec, spark.read.parquet(str(tmp_path / "s")), None, ctx, spec.retain_days)
    assert "brand_new" not in loaded.columns
    assert loaded.columns == incremental_load(spec, source, None, ctx, spec.retain_days).columns
    plan = loaded._jdf.queryExecution().executedPlan().toString()
    assert "brand_new" not in plan and set(kept) - set(spec.columns) <= {"table_id", "num_bytes"}


def metering(spark, data):
    return spark.createDataFrame(
        data,
        "entity_id int, name string, service_type string, start_time timestamp_ntz, end_time timestamp_ntz, credits_used double",
    )


def test_a_late_warehouse_of_a_loaded_hour_still_lands(spark, ctx):
    early = metering(spark, [(1, "W1", "WAREHOUSE_METERING", T0, T0 + HOUR, 1.0)])
    late = early.union(metering(spark, [(2, "W2", "WAREHOUSE_METERING", T0, T0 + HOUR, 2.0)]))
    stored = incremental_load(loads.WAREHOUSE_CREDIT, early, None, ctx)
    assert rows(incremental_load(loads.WAREHOUSE_CREDIT, late, stored, ctx), "warehouse_name") == [("W1",), ("W2",)]


def test_whole_day_reports_look_at_the_newest_day_again(spark, ctx):
    df = metering(spark, [(1, "W1", "WAREHOUSE_METERING", T0, T0 + HOUR, 1.0)])
    stored = incremental_load(loads.WAREHOUSE_CREDIT, df, None, ctx)
    assert watermark(loads.WAREHOUSE_CREDIT, stored) == datetime(2024, 2, 1)


def test_org_metering_keeps_every_hour(spark, ctx):
    schema = "organization_name string, account_name string, account_locator string, region string, warehouse_id int, start_time timestamp_ntz, credits_used double"
    row = ("O", "N", "A", "R", 1)
    first = spark.createDataFrame([(*row, T0, 1.0)], schema)
    both = first.union(spark.createDataFrame([(*row, T0 + HOUR, 2.0)], schema))
    stored = incremental_load(loads.ORG_METERING, first, None, ctx)
    assert incremental_load(loads.ORG_METERING, both, stored, ctx).count() == 2


def test_currencies_on_one_key_stay_apart(spark, ctx):
    schema = (
        "organization_name string, contract_number bigint, account_name string, account_locator string, region string, "
        "service_level string, usage_date date, usage_type string, currency string, usage double, usage_in_currency double"
    )
    row = ("O", None, "N", "A", "R", "S", T0.date())
    df = spark.createDataFrame([(*row, "overage-compute", "USD", 1.0, 2.0), (*row, "compute", "USD", 3.0, 4.0), (*row, "compute", "EUR", 5.0, 6.0)], schema)
    got = incremental_load(loads.ORG_CURRENCY, df, None, ctx)
    assert rows(got, "currency", "usage", "usage_in_currency") == [("EUR", 5.0, 6.0), ("USD", 4.0, 6.0)]
    assert got.select("sh_key").distinct().count() == 2


def test_missing_names_do_not_come_back_on_every_run(spark, ctx):
    df = spark.createDataFrame([(None, 7, T0.date(), 2**30, 2**31)], "database_name string, database_id int, usage_date date, average_database_bytes bigint, average_failsafe_bytes bigint")
    stored = incremental_load(loads.DATABASE_STORAGE, df, None, ctx)
    again = incremental_load(loads.DATABASE_STORAGE, df, stored, ctx)
    assert rows(again, "avg_database_storage_gb", "total_storage_gb") == [(1.0, 3.0)]


def runs(spark, data):
    return spark.createDataFrame(
        [(i, "t", "d", "s", state, None, None, at, at, done, "root", 1, i, None) for i, state, at, done in data],
        "query_id int, task_name string, database_name string, schema_name string, state string, error_code string, error_message string, "
        "scheduled_time timestamp_ntz, query_start_time timestamp_ntz, completed_time timestamp_ntz, root_task_id string, graph_version int, run_id int, return_value string",
    )


def test_task_states_are_updated_within_the_lookback_only(spark, ctx):
    old, recent = T0 - 48 * HOUR, T0 - 30 * HOUR
    stored = incremental_load(loads.TASK_HISTORY, runs(spark, [(1, "RUN", old, None), (2, "RUN", recent, None), (3, "RUN", T0, None)]), None, ctx)
    now = runs(spark, [(1, "OK", old, T0), (2, "OK", recent, T0), (3, "OK", T0, T0 + HOUR), (4, "RUN", T0 + HOUR, None)])
    got = incremental_load(loads.TASK_HISTORY, now, stored, ctx)
    assert rows(got, "run_id", "state", "completed_time_text") == [
        (1, "RUN", None),
        (2, "OK", "2024-02-01 10:00:00.000"),
        (3, "OK", "2024-02-01 11:00:00.000"),
        (4, "RUN", None),
    ]


def test_only_rows_near_the_watermark_are_compared(spark, ctx, folder):
    source = logical(spark, folder, "query_history")
    stored = incremental_load(loads.QUERY_HISTORY, source.filter(F.col("start_time") < time_literal(queries.EVENTS_CUT)), None, queries.EVENTS)
    fresh = new_rows(loads.QUERY_HISTORY, source, stored, queries.EVENTS)
    assert fresh.count() + stored.count() == source.count()


def test_callers_see_a_part_of_the_unscoped_rows(spark, folder):
    stored = incremental_load(loads.QUERY_HISTORY, logical(spark, folder, "query_history"), None, queries.EVENTS, 30)
    seen = views.query_history_view(stored, queries.patterns(spark, folder))
    ids = {r[0] for r in rows(seen, "query_id")}
    assert ids and ids < {r[0] for r in rows(stored, "query_id")}
    newest = [r[0] for r in rows(views.query_history_view(stored, queries.patterns(spark, folder), 10), "query_id")]
    assert len(newest) == 10 and set(newest) < ids


def test_a_query_delivered_again_with_a_later_start_does_not_land_twice(spark, ctx):
    schema = "query_id string, warehouse_name string, start_time timestamp_ntz"
    first = spark.createDataFrame([("q", "W", T0 - HOUR), ("r", "W", T0)], schema)
    stored = incremental_load(loads.QUERY_HISTORY, first, None, ctx)
    again = spark.createDataFrame([("q", "W", T0 + HOUR), ("s", "W", T0 + HOUR)], schema)
    assert rows(incremental_load(loads.QUERY_HISTORY, again, stored, ctx), "query_id") == [("q",), ("r",), ("s",)]


def test_keys_of_a_millisecond_are_compared_whole(spark, ctx):
    """A stored row a few microseconds before the batch has the batch's key."""
    def usage(micro):
        at = T0.replace(microsecond=5000 + micro)
        return spark.createDataFrame([("d", "s", "t", at, at + HOUR, 1.0)], "database_name string, schema_name string, table_name string, start_time timestamp_ntz, end_time timestamp_ntz, credits_used double")

    stored = incremental_load(loads.AUTO_CLUSTERING, usage(1), None, ctx)
    mark = T0.replace(microsecond=5300)
    assert incremental_load(loads.AUTO_CLUSTERING, usage(400), stored, ctx, mark=mark).count() == 1


def test_the_view_is_distinct_over_repeats_of_a_batch(spark, ctx):
    row = ("d", "s", "t", T0, T0 + HOUR, 1.0)
    df = spark.createDataFrame([row, row], "database_name string, schema_name string, table_name string, start_time timestamp_ntz, end_time timestamp_ntz, credits_used double")
    stored = incremental_load(loads.AUTO_CLUSTERING, df, None, ctx)
    patterns = spark.createDataFrame([("d", "x"), (".", "x")], "database_pattern string, warehouse_pattern string")
    assert stored.count() == 1
    assert rows(views.table_service_view(stored, patterns), "elapsed_time_in_sec") == [(3600,)]
