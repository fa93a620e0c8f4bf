"""Named queries: every operator and report over the tables of one folder.

A query takes (spark, folder) and returns a DataFrame. Sums and money are
rounded to six digits in the output only; keys are shown as hex.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usageledger.context import REPORT_SERVICE_ROLE, ReportContext
from usageledger.functions import labels
from usageledger.functions.keys import business_key, key_text, moment, number, text
from usageledger.functions.times import date_range, derive_time_columns, elapsed_seconds, time_literal
from usageledger.functions.units import bytes_to_gib
from usageledger.operators import access, budget, names, rates, reconcile, settings, tags, watermark
from usageledger.operators.attribution import attribute_credits
from usageledger.operators.calendar import dim_date
from usageledger.operators.merge import merge_insert_only, merge_upsert
from usageledger.operators.metering import (
    metering_history,
    monthly_credit_summary,
    sorted_for_readers,
    warehouse_daily_credits,
)
from usageledger.operators.ranking import top_recent
from usageledger.operators.retention import retention_delete
from usageledger.plans import loads, snapshots, views
from usageledger.plans.live import register_live_views, set_caller
from usageledger.plans.publish import newest_stored, publish_swap, publish_truncate_insert, refresh_history
from usageledger.plans.spec import ReportSpec, from_newest, incremental_load
from usageledger.plans.sql import LOG_TABLES, register_functions, register_views
from usageledger.session import shared_dir, staged, staged_with
from usageledger.sources.logical import logical
from usageledger.sources.tables import access_map_csv, access_map_rows, empty_like, table
from usageledger.streaming.feed import feed_stream, publish_with_feed
from usageledger.streaming.loads import append_stream, connector_type_history, dedup_late, file_stream, history, parquet_stream

Query = Callable[[SparkSession, str], DataFrame]

#: Reports on events are run ten days after the last event, with the roles of an analyst.
EVENTS = ReportContext(
    as_of=datetime(2024, 2, 10, 8),
    user="ANALYST",
    roles=("ROLE_3", "role_18", REPORT_SERVICE_ROLE),
)
#: Reports on orders and line items.
ORDERS = EVENTS.at(datetime(2001, 12, 31, 8))
FILE_LOADS = EVENTS.at(datetime(2001, 7, 15, 12))
#: A caller with rows of their own in the access map.
OWN_ROWS = ReportContext(as_of=EVENTS.as_of, user="USR_2", roles=("ROLE_3",))

#: Where the first of two batches ends.
EVENTS_CUT = datetime(2024, 1, 20, 10, 30)
ORDERS_CUT = datetime(2001, 6, 1)
LOADS_CUT = datetime(2001, 7, 1)
PRICES_CUT = datetime(2023, 10, 5)

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def _plain(f: T.StructField, exact: bool) -> Column:
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (T.DecimalType, T.DoubleType)):
        number = c.cast("double")
        return (number if exact else F.round(number, 6)).alias(f.name)
    if isinstance(f.dataType, T.BinaryType):
        return key_text(c).alias(f.name)
    if isinstance(f.dataType, T.TimestampType):
        return c.cast("timestamp_ntz").alias(f.name)
    return c


def shown(df: DataFrame, exact: bool = False) -> DataFrame:
    """Columns in the form results are compared in.

    Numbers are rounded, since sums depend on the order they are added in;
    ``exact`` numbers come from one row and need no rounding.
    """
    return df.select(*[_plain(f, exact) for f in df.schema.fields])


def patterns(spark: SparkSession, folder: str, ctx: ReportContext = EVENTS) -> access.CallerPatterns:
    return access.caller_patterns(logical(spark, folder, "access_map"), ctx)


def price_list(spark: SparkSession, folder: str) -> DataFrame:
    sheet = logical(spark, folder, "rate_sheet")
    return sheet.withColumn("usage_type", labels.normalize_usage_type(F.col("usage_type"), labels.RATE_LABELS))


def two_batches(spec: ReportSpec, source: DataFrame, cut: datetime, ctx: ReportContext, early: DataFrame | None = None) -> DataFrame:
    """The history table after a load of what existed at the cut, which is stored, and a later load of everything."""
    known = early if early is not None else source.filter(F.col(spec.source_time) < time_literal(cut, source.schema[spec.source_time].dataType))
    first = incremental_load(spec, known, None, ctx, spec.retain_days)
    stored, seen = staged_with(first, "history", newest=F.max(spec.time), rows=F.count(F.lit(1)))
    return incremental_load(spec, source, stored, ctx, spec.retain_days, from_newest(spec, seen["newest"]), seen["rows"])


# ---------------------------------------------------------------- building blocks


@query("business_key")
def _business_key(spark, folder):
    runs = logical(spark, folder, "task_runs")
    key = business_key([text("task_name"), text("schema_name"), number("graph_version", "-1"), number("run_id"), moment("scheduled_time")])
    return shown(runs.select("run_id", key.alias("sh_key")))


@query("high_watermark_scan")
def _high_watermark_scan(spark, folder):
    source = logical(spark, folder, "query_history")
    mark = watermark.newest(source.filter(F.col("start_time") < time_literal(EVENTS_CUT)), "start_time")
    return watermark.high_watermark_scan(source, "start_time", mark, EVENTS, first_months=12).select("query_id", "start_time")


@query("high_watermark_scan_min_default")
def _high_watermark_scan_min_default(spark, folder):
    return shown(watermark.high_watermark_scan_min_default(logical(spark, folder, "rate_sheet"), "rate_date", None))


@query("late_lookback_scan")
def _late_lookback_scan(spark, folder):
    source = logical(spark, folder, "task_runs")
    mark = watermark.newest(source.filter(F.col("scheduled_time") < time_literal(ORDERS_CUT)), "scheduled_time")
    return watermark.late_lookback_scan(source, "scheduled_time", mark, ORDERS, timedelta(hours=36), first_months=12).select("run_id", "scheduled_time", "state")


@query("bounded_window_scan")
def _bounded_window_scan(spark, folder):
    source = logical(spark, folder, "file_loads")
    return watermark.bounded_window_scan(source, "last_load_time", None, FILE_LOADS, days=30, first_months=12).select("file_name", "last_load_time", "row_count")


@query("merge_insert_only")
def _merge_insert_only(spark, folder):
    runs = logical(spark, folder, "task_runs").select(business_key([number("run_id")]).alias("sh_key"), "run_id", "state", "scheduled_time")
    cut = time_literal(ORDERS_CUT)
    stored = runs.filter(F.col("scheduled_time") < cut).withColumn("state", F.lit("STORED"))
    overlap = runs.filter(F.col("scheduled_time") >= cut - F.expr("INTERVAL 30 DAYS"))
    return shown(merge_insert_only(overlap, stored))


@query("merge_upsert")
def _merge_upsert(spark, folder):
    runs = logical(spark, folder, "task_runs").select(business_key([number("run_id")]).alias("sh_key"), "run_id", "state", "scheduled_time")
    cut = time_literal(ORDERS_CUT)
    stored = runs.filter(F.col("scheduled_time") < cut).withColumn("state", F.lit("STORED"))
    overlap = runs.filter(F.col("scheduled_time") >= cut - F.expr("INTERVAL 30 DAYS"))
    return shown(merge_upsert(overlap, stored, updates=["state"], newest_by=["scheduled_time"]))


@query("retention_delete")
def _retention_delete(spark, folder):
    usage = logical(spark, folder, "org_usage")
    return retention_delete(usage, "usage_date", 730, ORDERS).groupBy("account_locator", "usage_date").agg(
        F.count(F.lit(1)).alias("rows_kept")
    )


@query("config_lookup")
def _config_lookup(spark, folder):
    return settings.config_lookup(logical(spark, folder, "settings"), "DAYS_TO_RETAIN", "MACHINERY", "ACC_3")


@query("config_lookup_region")
def _config_lookup_region(spark, folder):
    return settings.config_lookup_region(logical(spark, folder, "settings"), "ORGANIZATION", "GLOBAL", "ACC_3", "R1")


@query("attach_org_context")
def _attach_org_context(spark, folder):
    grants = logical(spark, folder, "role_grants")
    return settings.attach_org_context(grants, logical(spark, folder, "settings"), EVENTS)


@query("metering_history")
def _metering_history(spark, folder):
    found = metering_history(
        logical(spark, folder, "metering"), "WH_[2-9]", ["WAREHOUSE_METERING", "WAREHOUSE_METERING_READER"], date(2024, 1, 5), date(2024, 1, 25)
    )
    return shown(found)


@query("resolve_access_patterns")
def _resolve_access_patterns(spark, folder):
    access_map = logical(spark, folder, "access_map")
    by_role = access.resolve_access_patterns(access_map, EVENTS).withColumn("caller", F.lit("roles"))
    own = access.resolve_access_patterns(access_map, OWN_ROWS).withColumn("caller", F.lit("user"))
    return by_role.unionByName(own)


@query("scope_rows_single")
def _scope_rows_single(spark, folder):
    return access.scope_rows_single(logical(spark, folder, "query_history"), patterns(spark, folder), "database_name").select("query_id", "database_name")


@query("scope_rows_either")
def _scope_rows_either(spark, folder):
    seen = access.scope_rows_either(logical(spark, folder, "query_history"), patterns(spark, folder))
    return seen.select("query_id", "warehouse_name", "database_name")


@query("scope_rows_both")
def _scope_rows_both(spark, folder):
    seen = access.scope_rows_both(logical(spark, folder, "query_history"), patterns(spark, folder))
    return seen.select("query_id", "warehouse_name", "database_name")


@query("scope_rows_two_columns")
def _scope_rows_two_columns(spark, folder):
    seen = access.scope_rows_two_columns(logical(spark, folder, "file_loads"), patterns(spark, folder), "table_catalog_name", "pipe_catalog_name")
    return seen.select("file_name", "table_catalog_name", "pipe_catalog_name")


@query("scope_rows_many")
def _scope_rows_many(spark, folder):
    """A caller with a pattern for every sixth order: thousands of them."""
    name = F.concat(F.lit("DB_"), F.col("o_orderkey").cast("string"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", name.alias("database_name"))
    wanted = orders.filter(F.col("o_custkey") % 6 == 0).select(
        F.concat("database_name", F.lit("[0-3]?")).alias(access.DATABASE), F.lit(".+").alias(access.WAREHOUSE)
    )
    return access.scope_rows_single(orders, wanted, "database_name").select("o_orderkey", "database_name")


@query("scope_rows_by_pieces")
def _scope_rows_by_pieces(spark, folder):
    """A caller with thousands of patterns that begin with anything: they find names by what stands in the middle."""
    number = F.col("o_orderkey").cast("string")
    name = F.concat(F.lit("DEV_BU"), (F.col("o_custkey") % 5).cast("string"), F.lit("_P"), number, F.lit("_LOAD_WH"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", name.alias("warehouse_name"))
    middle = F.concat(F.lit(".*_P"), number, F.lit("_.*"))
    wanted = orders.filter(F.col("o_custkey") % 6 == 0).select(F.lit(".+").alias(access.DATABASE), middle.alias(access.WAREHOUSE))
    return access.scope_rows_single(orders, wanted, "warehouse_name", access.WAREHOUSE).select("o_orderkey", "warehouse_name")


@query("role_gate")
def _role_gate(spark, folder):
    sheet = price_list(spark, folder)
    return shown(access.role_gate(sheet, EVENTS).unionByName(access.role_gate(sheet, OWN_ROWS)))


@query("role_membership_scope")
def _role_membership_scope(spark, folder):
    return access.role_membership_scope(logical(spark, folder, "role_grants"), EVENTS)


@query("any_pattern_gate")
def _any_pattern_gate(spark, folder):
    return access.any_pattern_gate(logical(spark, folder, "connectors"), patterns(spark, folder))


@query("date_range")
def _date_range(spark, folder):
    spans = table(spark, folder, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(
        F.to_date(F.min("o_orderdate")).alias("first_day"), F.to_date(F.max("o_orderdate")).alias("last_day")
    )
    return date_range(spans, "first_day", "last_day")


@query("rate_timeseries")
def _rate_timeseries(spark, folder):
    return shown(rates.rate_timeseries(price_list(spark, folder), "compute", EVENTS))


@query("rate_timeseries_all")
def _rate_timeseries_all(spark, folder):
    return shown(rates.rate_timeseries_all(price_list(spark, folder), "cloud services", EVENTS))


@query("convert_credits_to_currency")
def _convert_credits_to_currency(spark, folder):
    metered = logical(spark, folder, "warehouse_metering").select("warehouse_name", "start_time", "credits_used")
    return shown(
        rates.convert_credits_to_currency(metered, rates.single_rate(price_list(spark, folder), "compute", EVENTS), {"credits_used": "rate"})
    )


@query("attribute_credits")
def _attribute_credits(spark, folder):
    shares = attribute_credits(logical(spark, folder, "query_history"), logical(spark, folder, "warehouse_metering"), guard_zero=True)
    return shown(shares.select("query_id", "meter_start", "pct_credit_used_by_query", "credit_used_by_query"), exact=True)


@query("attribute_credits_swept")
def _attribute_credits_swept(spark, folder):
    """Shares of meters of days, hours and quarters of an hour, matched by a sweep."""
    shares = attribute_credits(logical(spark, folder, "query_history"), logical(spark, folder, "mixed_metering"), guard_zero=True, max_bytes=0)
    return shown(shares.select("query_id", "meter_start", "pct_credit_used_by_query", "credit_used_by_query"), exact=True)


@query("publish_swap")
def _publish_swap(spark, folder):
    where = shared_dir(spark, "published")
    name = "usageledger_daily_credits"
    metered = logical(spark, folder, "named_metering")
    publish_swap(warehouse_daily_credits(metered.filter(F.col("start_time") < time_literal(EVENTS_CUT))), name, where)
    return shown(publish_swap(warehouse_daily_credits(metered), name, where))


@query("publish_truncate_insert")
def _publish_truncate_insert(spark, folder):
    where = shared_dir(spark, "published")
    parts = [snapshots.active_of_kind(_listings(spark, folder), k) for k in snapshots.RESOURCE_KINDS]
    return publish_truncate_insert(parts, "usageledger_resources", where)


@query("snapshot_diff")
def _snapshot_diff(spark, folder):
    return reconcile.snapshot_diff(logical(spark, folder, "access_map_desired"), logical(spark, folder, "access_map_current"))


@query("duplicate_key_check")
def _duplicate_key_check(spark, folder):
    return reconcile.duplicate_key_check(logical(spark, folder, "access_map"))


@query("derive_time_columns")
def _derive_time_columns(spark, folder):
    runs = logical(spark, folder, "query_history").select("query_id", "start_time", "end_time")
    return derive_time_columns(runs)


@query("elapsed_seconds")
def _elapsed_seconds(spark, folder):
    return elapsed_seconds(logical(spark, folder, "query_history").select("query_id", "start_time", "end_time"))


@query("bytes_to_gib")
def _bytes_to_gib(spark, folder):
    size = F.col("storage_bytes")
    return shown(
        logical(spark, folder, "account_storage").select(
            "usage_date",
            bytes_to_gib(size).alias("gib"),
            bytes_to_gib(size, 3, "round").alias("rounded"),
            bytes_to_gib(size, 0, "floor").alias("floored"),
            bytes_to_gib(size, 3, "floor").alias("floored_3"),
        )
    )


@query("normalize_usage_type")
def _normalize_usage_type(spark, folder):
    u = F.col("usage_type")
    both = logical(spark, folder, "org_usage").select("usage_type").unionByName(logical(spark, folder, "rate_sheet").select("usage_type"))
    return both.groupBy(
        "usage_type",
        labels.normalize_usage_type(u, labels.RATE_LABELS).alias("rate_label"),
        labels.normalize_usage_type(u, labels.SPEND_LABELS).alias("spend_label"),
    ).agg(F.count(F.lit(1)).alias("rows"))


@query("top_recent")
def _top_recent(spark, folder):
    return top_recent(logical(spark, folder, "query_history"), "start_time", "query_id", 500).select("query_id", "start_time")


# ---------------------------------------------------------------- incremental reports


@query("rpt_auto_clustering")
def _rpt_auto_clustering(spark, folder):
    loaded = two_batches(loads.AUTO_CLUSTERING, logical(spark, folder, "table_service"), EVENTS_CUT, EVENTS)
    return shown(views.table_service_view(loaded, patterns(spark, folder)))


@query("rpt_copy_history")
def _rpt_copy_history(spark, folder):
    loaded = two_batches(loads.COPY_HISTORY, logical(spark, folder, "file_loads"), LOADS_CUT, FILE_LOADS)
    return shown(views.copy_history_view(loaded, patterns(spark, folder)))


@query("rpt_load_history")
def _rpt_load_history(spark, folder):
    loaded = two_batches(loads.LOAD_HISTORY, logical(spark, folder, "bulk_loads"), LOADS_CUT, FILE_LOADS)
    return shown(views.load_history_view(loaded, patterns(spark, folder)))


@query("rpt_db_storage")
def _rpt_db_storage(spark, folder):
    loaded = two_batches(loads.DATABASE_STORAGE, logical(spark, folder, "database_storage"), ORDERS_CUT, ORDERS)
    return shown(views.database_storage_view(loaded, patterns(spark, folder)))


@query("rpt_mv_refresh")
def _rpt_mv_refresh(spark, folder):
    loaded = two_batches(loads.MV_REFRESH, logical(spark, folder, "table_service").drop("num_bytes", "table_id"), EVENTS_CUT, EVENTS)
    return shown(views.table_service_view(loaded, patterns(spark, folder)))


@query("rpt_pipe_credit")
def _rpt_pipe_credit(spark, folder):
    piped = metering_history(logical(spark, folder, "metering"), ".+", ["PIPE"], EVENTS.today - timedelta(days=365), EVENTS.today)
    source = loads.pipe_usage(piped, logical(spark, folder, "pipes"))
    return shown(views.pipe_credit_view(two_batches(loads.PIPE_CREDIT, source, EVENTS_CUT, EVENTS), patterns(spark, folder)))


@query("rpt_query_history")
def _rpt_query_history(spark, folder):
    loaded = two_batches(loads.QUERY_HISTORY, logical(spark, folder, "query_history"), EVENTS_CUT, EVENTS)
    return shown(views.query_history_view(loaded, patterns(spark, folder), rows=1_000_000))


@query("stored_query_history")
def _stored_query_history(spark, folder):
    """Query history as a stored table: a first load, a daily load, and a load in which old queries come again with a later time."""
    name = f"usageledger_query_history_{uuid.uuid4().hex}"
    source = logical(spark, folder, "query_history")
    refresh_history(spark, loads.QUERY_HISTORY, source.filter(F.col("start_time") < time_literal(EVENTS_CUT)), name, EVENTS, buckets=8)
    refresh_history(spark, loads.QUERY_HISTORY, source, name, EVENTS)
    again = source.filter(F.col("query_id") % 3 == 0).withColumn("start_time", F.col("start_time") + F.expr("INTERVAL 40 DAYS"))
    late = source.unionByName(again)
    stored = refresh_history(spark, loads.QUERY_HISTORY, late, name, EVENTS)
    return shown(stored.select("sh_key", "query_id", "warehouse_name", "start_time", "execution_time"))


@query("newest_stored_queries")
def _newest_stored_queries(spark, folder):
    """The 700 newest queries that a caller may see, of a stored history: where they begin comes from its counts."""
    name = f"usageledger_newest_{uuid.uuid4().hex}"
    source = logical(spark, folder, "query_history")
    refresh_history(spark, loads.QUERY_HISTORY, source.filter(F.col("start_time") < time_literal(EVENTS_CUT)), name, EVENTS, buckets=8)
    refresh_history(spark, loads.QUERY_HISTORY, source, name, EVENTS)
    allowed = patterns(spark, folder)
    seen = newest_stored(spark, loads.QUERY_HISTORY, name, "query_id", 700, lambda df: access.scope_rows_either(df, allowed))
    return seen.select("query_id", "warehouse_name", "database_name", "start_time")


@query("rpt_reader_query_history")
def _rpt_reader_query_history(spark, folder):
    loaded = two_batches(loads.READER_QUERY_HISTORY, logical(spark, folder, "reader_query_history"), EVENTS_CUT, EVENTS)
    return shown(views.reader_query_history_view(loaded, patterns(spark, folder)))


@query("rpt_reader_wh_credit")
def _rpt_reader_wh_credit(spark, folder):
    loaded = two_batches(loads.READER_WAREHOUSE_CREDIT, logical(spark, folder, "reader_metering"), EVENTS_CUT, EVENTS)
    return shown(views.reader_warehouse_credit_view(loaded, patterns(spark, folder)))


@query("rpt_replication")
def _rpt_replication(spark, folder):
    loaded = two_batches(loads.REPLICATION, logical(spark, folder, "database_service"), EVENTS_CUT, EVENTS)
    return shown(views.table_service_view(loaded, patterns(spark, folder)))


@query("rpt_search_opt")
def _rpt_search_opt(spark, folder):
    loaded = two_batches(loads.SEARCH_OPTIMIZATION, logical(spark, folder, "table_service").drop("num_bytes"), EVENTS_CUT, EVENTS)
    return shown(views.priced_service_view(loaded, patterns(spark, folder), price_list(spark, folder), "search optimization", EVENTS))


@query("rpt_serverless_task")
def _rpt_serverless_task(spark, folder):
    loaded = two_batches(loads.SERVERLESS_TASK, logical(spark, folder, "task_service"), EVENTS_CUT, EVENTS)
    return shown(views.priced_service_view(loaded, patterns(spark, folder), price_list(spark, folder), "serverless tasks", EVENTS))


@query("rpt_sessions")
def _rpt_sessions(spark, folder):
    source = loads.session_logins(logical(spark, folder, "sessions"), logical(spark, folder, "logins"))
    return shown(two_batches(loads.SESSIONS, source, EVENTS_CUT, EVENTS))


@query("rpt_storage")
def _rpt_storage(spark, folder):
    return shown(two_batches(loads.ACCOUNT_STORAGE, logical(spark, folder, "account_storage"), ORDERS_CUT, ORDERS))


@query("rpt_task_history")
def _rpt_task_history(spark, folder):
    source = logical(spark, folder, "task_runs")
    cut = time_literal(ORDERS_CUT)
    running = F.col("scheduled_time") >= cut - F.expr("INTERVAL 36 HOURS")
    early = source.filter(F.col("scheduled_time") < cut).withColumns(
        {
            "state": F.when(running, "EXECUTING").otherwise(F.col("state")),
            "completed_time": F.when(~running, F.col("completed_time")),
        }
    )
    loaded = two_batches(loads.TASK_HISTORY, source, ORDERS_CUT, ORDERS, early)
    return shown(views.task_history_view(loaded, patterns(spark, folder)))


@query("rpt_warehouse_credit")
def _rpt_warehouse_credit(spark, folder):
    source = metering_history(
        logical(spark, folder, "metering"),
        ".+",
        ["WAREHOUSE_METERING", "WAREHOUSE_METERING_READER"],
        EVENTS.today - timedelta(days=365),
        EVENTS.today,
    )
    loaded = two_batches(loads.WAREHOUSE_CREDIT, source, EVENTS_CUT, EVENTS)
    return shown(views.warehouse_credit_view(loaded, patterns(spark, folder), price_list(spark, folder), EVENTS))


@query("rpt_org_currency")
def _rpt_org_currency(spark, folder):
    loaded = two_batches(loads.ORG_CURRENCY, logical(spark, folder, "org_usage"), ORDERS_CUT, ORDERS)
    return shown(views.organization_view(loaded, ORDERS))


@query("rpt_org_rate_sheet")
def _rpt_org_rate_sheet(spark, folder):
    loaded = two_batches(loads.ORG_RATE_SHEET, logical(spark, folder, "rate_sheet"), PRICES_CUT, EVENTS)
    return shown(views.organization_view(loaded, EVENTS))


@query("rpt_org_metering")
def _rpt_org_metering(spark, folder):
    loaded = two_batches(loads.ORG_METERING, logical(spark, folder, "org_metering"), EVENTS_CUT, EVENTS)
    return shown(views.organization_metering_view(loaded, price_list(spark, folder), EVENTS))


# ---------------------------------------------------------------- full reports and models


@query("rpt_query_credit")
def _rpt_query_credit(spark, folder):
    credits = snapshots.query_credit(logical(spark, folder, "query_history"), logical(spark, folder, "warehouse_metering"), EVENTS, months=4)
    return shown(snapshots.query_credit_view(credits, patterns(spark, folder)), exact=True)


@query("rpt_db_schema_credit")
def _rpt_db_schema_credit(spark, folder):
    return shown(
        snapshots.db_schema_credit(
            logical(spark, folder, "query_history"), logical(spark, folder, "warehouse_metering"), patterns(spark, folder), EVENTS, months=4
        )
    )


def _watched(spark, folder) -> DataFrame:
    return snapshots.resource_monitor(
        logical(spark, folder, "monitors"), logical(spark, folder, "warehouses"), patterns(spark, folder)
    ).select("resource_monitor_name", "warehouse_name")


def _pivot(spark, folder) -> DataFrame:
    return snapshots.monthly_credits(
        logical(spark, folder, "query_history"),
        logical(spark, folder, "warehouse_metering"),
        _watched(spark, folder),
        patterns(spark, folder),
        EVENTS,
        duration=12,
    )


@query("rpt_month_credits_pivot")
def _rpt_month_credits_pivot(spark, folder):
    return shown(_pivot(spark, folder))


@query("rpt_month_credits_unpivot")
def _rpt_month_credits_unpivot(spark, folder):
    return shown(snapshots.monthly_credits_long(_pivot(spark, folder), patterns(spark, folder)))


@query("rpt_grants_to_roles")
def _rpt_grants_to_roles(spark, folder):
    return snapshots.grants_to_roles_view(snapshots.grants_to_roles(logical(spark, folder, "role_grants"), EVENTS), EVENTS)


@query("rpt_grants_to_users")
def _rpt_grants_to_users(spark, folder):
    return snapshots.passthrough(logical(spark, folder, "user_grants"))


@query("rpt_table_storage")
def _rpt_table_storage(spark, folder):
    stored = snapshots.table_storage(logical(spark, folder, "table_storage"), EVENTS)
    return shown(snapshots.table_storage_view(stored, patterns(spark, folder)))


@query("rpt_object_dependencies")
def _rpt_object_dependencies(spark, folder):
    return snapshots.object_dependencies(logical(spark, folder, "object_dependencies"), EVENTS)


def _listings(spark, folder) -> DataFrame:
    return snapshots.active_resources(
        {
            "DATABASE": logical(spark, folder, "databases"),
            "WAREHOUSE": logical(spark, folder, "warehouses"),
            "ROLE": logical(spark, folder, "roles"),
            "USER": logical(spark, folder, "users"),
            "RM": logical(spark, folder, "monitors"),
        }
    )


@query("rpt_active_resources")
def _rpt_active_resources(spark, folder):
    return _listings(spark, folder)


@query("rpt_resource_monitor")
def _rpt_resource_monitor(spark, folder):
    return snapshots.resource_monitor(logical(spark, folder, "monitors"), logical(spark, folder, "warehouses"), patterns(spark, folder))


@query("rpt_monthly_credit_summary")
def _rpt_monthly_credit_summary(spark, folder):
    return shown(monthly_credit_summary(logical(spark, folder, "metering")))


@query("dim_date")
def _dim_date(spark, folder):
    """The calendar with the orders of each day."""
    per_day = table(spark, folder, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count(F.lit(1)).alias("orders"))
    return dim_date(spark, ORDERS.today, days=730).join(per_day, "date", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


@query("parse_database_names")
def _parse_database_names(spark, folder):
    return names.parse_database_names(logical(spark, folder, "database_listing"))


@query("parse_warehouse_names")
def _parse_warehouse_names(spark, folder):
    return names.parse_warehouse_names(logical(spark, folder, "warehouse_listing"))


@query("warehouse_daily_credits")
def _warehouse_daily_credits(spark, folder):
    return shown(warehouse_daily_credits(logical(spark, folder, "named_metering")))


@query("warehouse_daily_credits_merge")
def _warehouse_daily_credits_merge(spark, folder):
    metered = logical(spark, folder, "named_metering")
    stored = warehouse_daily_credits(metered.filter(F.col("start_time") < time_literal(EVENTS_CUT)))
    merged = merge_upsert(warehouse_daily_credits(metered), stored, ["warehouse_name", "active_date"], ["credits_used"])
    return shown(sorted_for_readers(merged, "warehouse_name", "active_date"))


@query("override_coalesce_database")
def _override_coalesce_database(spark, folder):
    parsed = names.parse_database_names(logical(spark, folder, "database_listing"))
    merged = names.override_coalesce(parsed, logical(spark, folder, "database_overrides"), names.DATABASE_FIELDS, out="database_name")
    return access.scope_rows_single(merged, patterns(spark, folder, OWN_ROWS), "database_name").distinct()


@query("override_coalesce_warehouse")
def _override_coalesce_warehouse(spark, folder):
    parsed = names.parse_warehouse_names(logical(spark, folder, "warehouse_listing"))
    merged = names.override_coalesce(parsed, logical(spark, folder, "warehouse_overrides"), names.WAREHOUSE_FIELDS, out="warehouse_name")
    return access.scope_rows_single(merged, patterns(spark, folder, OWN_ROWS), "warehouse_name", access.WAREHOUSE).distinct()


@query("raw_tags")
def _raw_tags(spark, folder):
    warehouse = snapshots.passthrough(logical(spark, folder, "raw_warehouse_tags")).withColumn("kind", F.lit("WAREHOUSE"))
    database = snapshots.passthrough(logical(spark, folder, "raw_database_tags")).withColumn("kind", F.lit("DATABASE"))
    return warehouse.unionByName(database)


@query("workspace_monthly_budget")
def _workspace_monthly_budget(spark, folder):
    return budget.workspace_monthly_budget(logical(spark, folder, "purchases"), logical(spark, folder, "tracker"))


@query("bu_warehouse_spend")
def _bu_warehouse_spend(spark, folder):
    metered = logical(spark, folder, "named_metering")
    listing = metered.select("name", F.lit("OWN").alias("owner"), F.lit(None).cast("string").alias("comment")).distinct()
    parsed = names.parse_warehouse_names(listing).withColumnRenamed("name", "warehouse_name")
    return shown(
        budget.bu_warehouse_spend(parsed, warehouse_daily_credits(metered), logical(spark, folder, "purchases"), logical(spark, folder, "tracker"))
    )


@query("bu_warehouse_spend_overridden")
def _bu_warehouse_spend_overridden(spark, folder):
    """Spending over metadata with overrides: the warehouses of one product moved to another business unit."""
    metered = logical(spark, folder, "named_metering")
    listing = metered.select("name", F.lit("OWN").alias("owner"), F.lit(None).cast("string").alias("comment")).distinct()
    missing = [F.lit(None).cast("string").alias(c) for c in ("owner", "comment", "wh_type", "env", "db_name", "purpose")]
    moved = listing.filter(F.col("name").contains("_P3_")).select("name", *missing, F.lit("BU1").alias("bu"))
    merged = names.override_coalesce(names.parse_warehouse_names(listing), moved, names.WAREHOUSE_FIELDS, out="warehouse_name")
    return shown(
        budget.bu_warehouse_spend(merged, warehouse_daily_credits(metered), logical(spark, folder, "purchases"), logical(spark, folder, "tracker"))
    )


@query("workspace_details")
def _workspace_details(spark, folder):
    return shown(budget.workspace_details(logical(spark, folder, "tracker"), logical(spark, folder, "purchases")))


@query("workspace_types_seed")
def _workspace_types_seed(spark, folder):
    return budget.workspace_types_seed(logical(spark, folder, "workspace_types"))


@query("tag_pivot")
def _tag_pivot(spark, folder):
    return tags.tag_pivot(logical(spark, folder, "tag_references"))


@query("tag_pivot_existing")
def _tag_pivot_existing(spark, folder):
    """As tag_pivot after one of the tags was dropped."""
    where = {"tag_database": F.lit("GOVERNANCE"), "tag_schema": F.lit("TAGS")}
    references = staged(logical(spark, folder, "tag_references").withColumns(where), "tag-references")
    existing = references.select(*tags.TAG_IDENTITY).distinct().filter(F.col("tag_name") != "ENVIRONMENT")
    return tags.tag_pivot(references, existing)


@query("tag_unresolved")
def _tag_unresolved(spark, folder):
    pivoted = tags.tag_pivot(logical(spark, folder, "tag_references"))
    return tags.tag_unresolved(logical(spark, folder, "object_listing"), pivoted)


def _tag_override(spark, folder, kind: str, pattern: str) -> DataFrame:
    metadata = tags.tag_metadata(logical(spark, folder, "tag_references"), logical(spark, folder, "object_listing"))
    name = f"{kind.lower()}_name"
    merged = tags.tag_override(metadata, logical(spark, folder, "tag_overrides"), kind, name)
    return access.scope_rows_single(merged, patterns(spark, folder, OWN_ROWS), name, pattern).distinct()


@query("tag_override_database")
def _tag_override_database(spark, folder):
    return _tag_override(spark, folder, "DATABASE", access.DATABASE)


@query("tag_override_warehouse")
def _tag_override_warehouse(spark, folder):
    return _tag_override(spark, folder, "WAREHOUSE", access.WAREHOUSE)


@query("grants_to_patterns")
def _grants_to_patterns(spark, folder):
    return reconcile.grants_to_patterns(logical(spark, folder, "role_grants"), logical(spark, folder, "role_tags"))


@query("access_map_refresh")
def _access_map_refresh(spark, folder):
    derived = reconcile.grants_to_patterns(logical(spark, folder, "role_grants"), logical(spark, folder, "role_tags"))
    return reconcile.access_map_refresh(logical(spark, folder, "access_map_current"), derived)


@query("access_map_reconcile")
def _access_map_reconcile(spark, folder):
    desired, current = logical(spark, folder, "access_map_desired"), logical(spark, folder, "access_map_current")
    changes = reconcile.access_map_reconcile(desired, current)
    return reconcile.apply_changes(current, changes)


@query("access_map_from_file")
def _access_map_from_file(spark, folder):
    """The desired state from a CSV file, checked, compared, applied, and completed from grants."""
    path = shared_dir(spark, "access-map")
    logical(spark, folder, "access_map_desired").select("account", "role", "warehouse", "database").write.option("header", True).csv(path)
    return reconcile.reconcile_access_map(
        access_map_csv(spark, path),
        logical(spark, folder, "access_map_current"),
        logical(spark, folder, "role_grants"),
        logical(spark, folder, "role_tags"),
    )


@query("connector_type_current")
def _connector_type_current(spark, folder):
    return snapshots.connector_type_current(logical(spark, folder, "connectors"))


@query("connector_type_history")
def _connector_type_history(spark, folder):
    """Two deliveries of the connector table, the second with one attribute changed, in four micro-batches."""
    base = shared_dir(spark, "connectors")
    connectors = logical(spark, folder, "connectors")
    connectors.repartition(2).write.parquet(f"{base}/changes/delivery=1")
    changed = connectors.withColumn("availability", F.lit("changed")).filter(F.col("broken"))
    changed.repartition(2).write.parquet(f"{base}/changes/delivery=2")
    stream = parquet_stream(spark, f"{base}/changes", connectors.schema, per_trigger=1)
    stored = connector_type_history(stream, f"{base}/history", f"{base}/checkpoint", EVENTS, 365)
    return access.any_pattern_gate(stored, patterns(spark, folder))


def _connector_versions(spark, folder) -> tuple[str, T.StructType]:
    """Three versions of the connector list, published one after the other: where their feed is, and its columns."""
    base, name = shared_dir(spark, "versions"), f"usageledger_connectors_{uuid.uuid4().hex}"
    connectors = logical(spark, folder, "connectors")
    number = F.col("id").cast("int")
    changed = connectors.filter(number % 7 != 0).withColumn("availability", F.when(number % 5 == 0, "changed").otherwise(F.col("availability")))
    more = connectors.filter(number % 7 == 0).withColumn("id", F.concat(F.lit("new_"), "id")).withColumn("synced", F.lit(EVENTS.as_of).cast("timestamp"))
    for version in (connectors, changed, changed.unionByName(more)):
        publish_with_feed(version, name, base, f"{base}/feed", ["id"])
    return base, connectors.schema


@query("change_feed")
def _change_feed(spark, folder):
    """Inserts, deletes and both images of updates, per version, as a stream consumed them."""
    base, schema = _connector_versions(spark, folder)
    append_stream(feed_stream(spark, f"{base}/feed", schema), f"{base}/seen", f"{base}/checkpoint")
    return history(spark, f"{base}/seen").select("version", "change_type", "id", "availability")


@query("connector_type_history_of_versions")
def _connector_type_history_of_versions(spark, folder):
    """How many images of each connector the history holds after it consumed the changes of three versions."""
    base, schema = _connector_versions(spark, folder)
    stored = connector_type_history(feed_stream(spark, f"{base}/feed", schema), f"{base}/history", f"{base}/checkpoint", EVENTS, 365)
    return stored.groupBy("id").agg(F.count(F.lit(1)).alias("images"), F.countDistinct("availability").alias("availabilities"))


#: What each view of the connector log shows: a key and a text.
LOG_COLUMNS = {
    "account": ("id", "name"),
    "account_membership": ("user_id", "account_role"),
    "audit": ("id", "action"),
    "connector": ("connector_id", "connector_name"),
    "destination": ("id", "name"),
    "destination_membership": ("user_id", "CAST(activated AS STRING)"),
    "incremental_mar": ("connector_id", "concat_ws(' ', measured_month, incremental_rows)"),
    "log": ("id", "message_data"),
    "resource_membership": ("id", "resource"),
    "role": ("id", "name"),
    "role_permission": ("permission_id", "permission"),
    "user": ("id", "login"),
}


@query("connector_log_views")
def _connector_log_views(spark, folder):
    """All twelve views of the connector log, each over its own table."""
    logs = {f"log_{n}": logical(spark, folder, f"log_{n}") for n in LOG_TABLES}
    made = register_views(spark, logs, logical(spark, folder, "access_map"), EVENTS, "connector_")
    parts = [
        f"SELECT '{n}' AS log, CAST({key} AS STRING) AS key, {detail} AS detail FROM connector_log_{n}"
        for n, (key, detail) in LOG_COLUMNS.items()
        if f"connector_log_{n}" in made
    ]
    return spark.sql(" UNION ALL ".join(parts))


# ---------------------------------------------------------------- by their SQL names


def _functions(spark, folder) -> None:
    register_functions(
        spark,
        logical(spark, folder, "metering"),
        logical(spark, folder, "settings"),
        price_list(spark, folder),
        logical(spark, folder, "access_map"),
        EVENTS,
    )


@query("sql_metering_history")
def _sql_metering_history(spark, folder):
    _functions(spark, folder)
    services = "array('WAREHOUSE_METERING', 'WAREHOUSE_METERING_READER')"
    return shown(spark.sql(f"SELECT * FROM metering_history('WH_[2-9]', {services}, DATE '2024-01-05', DATE '2024-01-25')"))


@query("sql_settings")
def _sql_settings(spark, folder):
    """Both forms of the settings lookup, for every account that has settings."""
    _functions(spark, folder)
    return spark.sql(
        """SELECT a.account_locator, h.var_value AS highest, o.var_value AS organization
        FROM (SELECT DISTINCT account_locator FROM setting_records) a,
          LATERAL highest_setting('DAYS_TO_RETAIN', 'MACHINERY', a.account_locator) h
          LEFT JOIN LATERAL settings_of('ORGANIZATION', 'GLOBAL', a.account_locator, 'R1') o"""
    )


@query("sql_access_patterns")
def _sql_access_patterns(spark, folder):
    """Queries of the databases that the caller's patterns name, through the table function."""
    _functions(spark, folder)
    logical(spark, folder, "query_history").createOrReplaceTempView("sql_queries")
    return spark.sql(
        r"""SELECT database_name, queries FROM (
          SELECT *, (SELECT collect_list(database_pattern) FROM access_patterns()) AS allowed
          FROM (SELECT database_name, count(*) AS queries FROM sql_queries GROUP BY database_name))
        WHERE exists(allowed, p -> regexp_like(database_name, concat('\\A(?:', p, ')\\z')))"""
    )


@query("sql_date_range")
def _sql_date_range(spark, folder):
    """The days of the orders of each status, through the table function."""
    _functions(spark, folder)
    table(spark, folder, "orders").createOrReplaceTempView("sql_orders")
    return spark.sql(
        """SELECT s.o_orderstatus, d.day FROM
          (SELECT o_orderstatus, to_date(min(o_orderdate)) AS first_day, to_date(max(o_orderdate)) AS last_day FROM sql_orders GROUP BY o_orderstatus) s,
          LATERAL date_range(s.first_day, s.last_day) d"""
    )


@query("sql_rate_timeseries")
def _sql_rate_timeseries(spark, folder):
    _functions(spark, folder)
    return shown(spark.sql("SELECT * FROM rate_timeseries('compute')"))


@query("sql_rate_timeseries_all")
def _sql_rate_timeseries_all(spark, folder):
    _functions(spark, folder)
    return shown(spark.sql("SELECT * FROM rate_timeseries_all('cloud services')"))


def _published(spark, folder, **tables: DataFrame) -> dict[str, str]:
    """Tables under names of their own, by report."""
    where, names = shared_dir(spark, "published"), {}
    for report, df in tables.items():
        names[report] = f"usageledger_{report}_{uuid.uuid4().hex}"
        publish_swap(df, names[report], where)
    return names


@query("live_query_history")
def _live_query_history(spark, folder):
    """A view registered once, read after the access map lost the roles' rows for databases with an odd number."""
    access_map = logical(spark, folder, "access_map")
    names = _published(spark, folder, query_history=logical(spark, folder, "query_history"), access_map=access_map)
    register_live_views(spark, {"query_history": names["query_history"]}, names["access_map"], EVENTS, "live_")
    gone = F.coalesce(F.col("database").rlike("[13579]"), F.lit(False))
    publish_swap(spark.table(names["access_map"]).filter(~gone), names["access_map"], shared_dir(spark, "published"))
    return shown(spark.sql("SELECT query_id, warehouse_name, database_name, start_date, execution_time_in_sec FROM live_query_history"))


@query("live_warehouse_credit")
def _live_warehouse_credit(spark, folder):
    """Credits and amounts per warehouse and currency of a caller set after the view was registered."""
    metered = metering_history(logical(spark, folder, "metering"), ".+", ["WAREHOUSE_METERING"], EVENTS.today - timedelta(days=365), EVENTS.today)
    credit = metered.withColumnRenamed("name", "warehouse_name")
    names = _published(spark, folder, warehouse_credit=credit, org_rate_sheet=price_list(spark, folder), access_map=logical(spark, folder, "access_map"))
    register_live_views(spark, names, names["access_map"], replace(EVENTS, user="nobody", roles=()), "priced_")
    set_caller(spark, EVENTS)
    return shown(
        spark.sql(
            """SELECT warehouse_name, currency, sum(credits_used) AS credits_used, sum(credits_used_effective_rate) AS amount
            FROM priced_warehouse_credit GROUP BY warehouse_name, currency"""
        )
    )


@query("workspace_monthly_budget_recursive")
def _workspace_monthly_budget_recursive(spark, folder):
    return budget.workspace_monthly_budget_recursive(logical(spark, folder, "purchases"), logical(spark, folder, "tracker"))


@query("access_map_first_refresh")
def _access_map_first_refresh(spark, folder):
    """The first refresh of an access map starts from an empty table like the one to come."""
    derived = reconcile.grants_to_patterns(logical(spark, folder, "role_grants"), logical(spark, folder, "role_tags"))
    return reconcile.access_map_refresh(empty_like(logical(spark, folder, "access_map_current")), derived)


@query("access_map_bad_rows")
def _access_map_bad_rows(spark, folder):
    """A file of an access map in which rows lack a cell, have one too many or a quote that isn't closed."""
    number = F.col("c_custkey").cast("string")
    cells = [F.concat(F.lit("USR_"), number), F.lit(""), F.concat(F.lit("WH_"), number), F.concat(F.lit("DB_"), number)]
    whole = F.concat_ws(",", *cells)
    text = (
        F.when(F.col("c_custkey") % 10 == 3, F.concat_ws(",", *cells[:2]))
        .when(F.col("c_custkey") % 10 == 5, F.concat(whole, F.lit(",more")))
        .when(F.col("c_custkey") % 10 == 7, F.concat(F.lit('"'), whole))
        .otherwise(whole)
    )
    path = shared_dir(spark, "access-map")
    rows = table(spark, folder, "customer").select("c_custkey", text.alias("value"))
    head = spark.createDataFrame([(-1, "account,role,warehouse,database")], "c_custkey long, value string")
    head.unionByName(rows).coalesce(1).sortWithinPartitions("c_custkey").select("value").write.text(path)
    good, bad = access_map_rows(spark, path)
    named = good.select(F.lit("good").alias("kind"), "account", "role", "warehouse", "database", F.lit(None).cast("string").alias("bad_row"))
    return named.unionByName(bad.select(F.lit("bad").alias("kind"), "bad_row"), allowMissingColumns=True)


# ---------------------------------------------------------------- streams


@query("stream_incremental_append")
def _stream_incremental_append(spark, folder):
    """Query history as a stream: everything arrives twice, in four micro-batches; every query lands once."""
    base = shared_dir(spark, "stream")
    source = logical(spark, folder, "query_history")
    for _ in range(2):
        source.repartition(2).write.mode("append").parquet(f"{base}/arrived")
    stream = parquet_stream(spark, f"{base}/arrived", source.schema, per_trigger=1)
    append_stream(stream, f"{base}/history", f"{base}/checkpoint", ["query_id"], "start_time")
    return history(spark, f"{base}/history").select("query_id", "warehouse_name", "start_time", "execution_time")


@query("stream_dedup_late")
def _stream_dedup_late(spark, folder):
    """Events in three deliveries, the second with late copies of the first, the third with copies of all.

    Each delivery is one micro-batch of two files. Copies within the 36 hours are
    known and dropped; older ones lie behind the watermark.
    """
    base = shared_dir(spark, "stream")
    events = table(spark, folder, "events")
    cut = time_literal(EVENTS_CUT)
    late = events.filter((F.col("ts") < cut) & (F.col("ts") >= cut - F.expr("INTERVAL 24 HOURS")))
    for delivery in (events.filter(F.col("ts") < cut), events.filter(F.col("ts") >= cut).unionByName(late), events):
        delivery.repartition(2).write.mode("append").parquet(f"{base}/arrived")
    stream = parquet_stream(spark, f"{base}/arrived", events.schema, per_trigger=2)
    file_stream(dedup_late(stream, ["event_id"], "ts", timedelta(hours=36), slots=16), f"{base}/events", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/events").select("event_id", "ts", "user_id", "event_type")


