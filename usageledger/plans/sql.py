"""The reports and table functions under SQL names, for one caller."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usageledger.context import ReportContext
from usageledger.operators import budget, names, tags
from usageledger.operators.access import (
    DATABASE,
    WAREHOUSE,
    CallerPatterns,
    any_pattern_gate,
    caller_patterns,
    resolve_access_patterns,
    role_gate,
    scope_rows_both,
    scope_rows_single,
)
from usageledger.operators.calendar import dim_date
from usageledger.operators.metering import monthly_credit_summary
from usageledger.operators.rates import densify
from usageledger.plans import snapshots, views
from usageledger.plans.refresh import refresh_all

Tables = Mapping[str, DataFrame]
View = Callable[[Tables, CallerPatterns, ReportContext], DataFrame]

SHEET = "org_rate_sheet"
#: Days that the calendar goes back.
CALENDAR_DAYS = 730


def _kind(kind: str) -> View:
    return lambda t, p, c: any_pattern_gate(snapshots.active_of_kind(t["active_resources"], kind), p)


def _overridden(kind: str, fields: tuple[str, ...], pattern: str) -> View:
    def view(t: Tables, p: CallerPatterns, c: ReportContext) -> DataFrame:
        merged = names.override_coalesce(t[f"{kind}_metadata"], t[f"{kind}_overrides"], fields, out=f"{kind}_name")
        return scope_rows_single(merged, p, f"{kind}_name", pattern)

    return view


def _tagged(kind: str, pattern: str) -> View:
    def view(t: Tables, p: CallerPatterns, c: ReportContext) -> DataFrame:
        merged = tags.tag_override(t["tag_metadata"], t["tag_overrides"], kind.upper(), f"{kind}_name")
        return scope_rows_single(merged, p, f"{kind}_name", pattern)

    return view


def _spend(t: Tables, p: CallerPatterns, c: ReportContext) -> DataFrame:
    """Spending by the metadata that people see, overrides included."""
    merged = names.override_coalesce(t["warehouse_metadata"], t["warehouse_overrides"], names.WAREHOUSE_FIELDS, out="warehouse_name")
    return budget.bu_warehouse_spend(merged, t["daily_credits"], t["purchases"], t["tracker"])


# Tables of the connector service's log, each shown as it is.
LOG_TABLES = (
    "account",
    "account_membership",
    "audit",
    "connector",
    "destination",
    "destination_membership",
    "incremental_mar",
    "log",
    "resource_membership",
    "role",
    "role_permission",
    "user",
)

#: Views by name: the tables each needs and how it is made of them.
REPORT_VIEWS: dict[str, tuple[tuple[str, ...], View]] = {
    "auto_clustering": (("auto_clustering",), lambda t, p, c: views.table_service_view(t["auto_clustering"], p)),
    "mv_refresh": (("mv_refresh",), lambda t, p, c: views.table_service_view(t["mv_refresh"], p)),
    "replication": (("replication",), lambda t, p, c: views.table_service_view(t["replication"], p)),
    "search_optimization": (
        ("search_optimization", SHEET),
        lambda t, p, c: views.priced_service_view(t["search_optimization"], p, t[SHEET], "search optimization", c),
    ),
    "serverless_task": (
        ("serverless_task", SHEET),
        lambda t, p, c: views.priced_service_view(t["serverless_task"], p, t[SHEET], "serverless tasks", c),
    ),
    "copy_history": (("copy_history",), lambda t, p, c: views.copy_history_view(t["copy_history"], p)),
    "load_history": (("load_history",), lambda t, p, c: views.load_history_view(t["load_history"], p)),
    "database_storage": (("database_storage",), lambda t, p, c: views.database_storage_view(t["database_storage"], p)),
    "account_storage": (("account_storage",), lambda t, p, c: t["account_storage"]),
    "sessions": (("sessions",), lambda t, p, c: t["sessions"]),
    "pipe_credit": (("pipe_credit",), lambda t, p, c: views.pipe_credit_view(t["pipe_credit"], p)),
    "query_history": (("query_history",), lambda t, p, c: views.query_history_view(t["query_history"], p)),
    "reader_query_history": (
        ("reader_query_history",),
        lambda t, p, c: views.reader_query_history_view(t["reader_query_history"], p),
    ),
    "reader_warehouse_credit": (
        ("reader_warehouse_credit",),
        lambda t, p, c: views.reader_warehouse_credit_view(t["reader_warehouse_credit"], p),
    ),
    "task_history": (("task_history",), lambda t, p, c: views.task_history_view(t["task_history"], p)),
    "warehouse_credit": (
        ("warehouse_credit", SHEET),
        lambda t, p, c: views.warehouse_credit_view(t["warehouse_credit"], p, t[SHEET], c),
    ),
    "org_currency": (("org_currency",), lambda t, p, c: views.organization_view(t["org_currency"], c)),
    "org_rate_sheet": ((SHEET,), lambda t, p, c: views.organization_view(t[SHEET], c)),
    "org_metering": (("org_metering", SHEET), lambda t, p, c: views.organization_metering_view(t["org_metering"], t[SHEET], c)),
    "query_credit": (("query_credit",), lambda t, p, c: snapshots.query_credit_view(t["query_credit"], p)),
    "db_schema_credit": (("db_schema_credit",), lambda t, p, c: scope_rows_both(t["db_schema_credit"], p)),
    "month_credits": (("month_credits",), lambda t, p, c: scope_rows_single(t["month_credits"], p, "name", WAREHOUSE)),
    "grants_to_roles": (("grants_to_roles",), lambda t, p, c: snapshots.grants_to_roles_view(t["grants_to_roles"], c)),
    "grants_to_users": (("grants_to_users",), lambda t, p, c: t["grants_to_users"]),
    "table_storage": (("table_storage",), lambda t, p, c: snapshots.table_storage_view(t["table_storage"], p)),
    "object_dependencies": (("object_dependencies",), lambda t, p, c: t["object_dependencies"]),
    "active_databases": (("active_resources",), _kind("DATABASE")),
    "active_warehouses": (("active_resources",), _kind("WAREHOUSE")),
    "active_roles": (("active_resources",), _kind("ROLE")),
    "active_users": (("active_resources",), _kind("USER")),
    "active_monitors": (("active_resources",), _kind("RM")),
    "resource_monitor": (
        ("resource_monitors", "watched_warehouses"),
        lambda t, p, c: snapshots.resource_monitor(t["resource_monitors"], t["watched_warehouses"], p),
    ),
    "monthly_credit_summary": (("metering",), lambda t, p, c: monthly_credit_summary(t["metering"])),
    "calendar": ((), lambda t, p, c: dim_date(p.frame.sparkSession, c.today, CALENDAR_DAYS)),
    "database_metadata": (
        ("database_metadata", "database_overrides"),
        _overridden("database", names.DATABASE_FIELDS, DATABASE),
    ),
    "warehouse_metadata": (
        ("warehouse_metadata", "warehouse_overrides"),
        _overridden("warehouse", names.WAREHOUSE_FIELDS, WAREHOUSE),
    ),
    "tagged_databases": (("tag_metadata", "tag_overrides"), _tagged("database", DATABASE)),
    "tagged_warehouses": (("tag_metadata", "tag_overrides"), _tagged("warehouse", WAREHOUSE)),
    "warehouse_tags": (("raw_warehouse_tags",), lambda t, p, c: t["raw_warehouse_tags"]),
    "database_tags": (("raw_database_tags",), lambda t, p, c: t["raw_database_tags"]),
    "workspace_monthly_budget": (
        ("purchases", "tracker"),
        lambda t, p, c: budget.workspace_monthly_budget(t["purchases"], t["tracker"]),
    ),
    "bu_warehouse_spend": (("warehouse_metadata", "warehouse_overrides", "daily_credits", "purchases", "tracker"), _spend),
    "workspace_details": (("purchases", "tracker"), lambda t, p, c: budget.workspace_details(t["tracker"], t["purchases"])),
    "connector_types": (("connector_types",), lambda t, p, c: any_pattern_gate(t["connector_types"], p)),
    "connector_type_history": (
        ("connector_type_history",),
        lambda t, p, c: any_pattern_gate(t["connector_type_history"], p),
    ),
    **{f"log_{name}": ((f"log_{name}",), lambda t, p, c, table=f"log_{name}": t[table]) for name in LOG_TABLES},
}


def register_views(
    spark: SparkSession, tables: Tables, access_map: DataFrame, ctx: ReportContext, prefix: str = "ext_", calendar_days: int = CALENDAR_DAYS
) -> list[str]:
    """Temporary views of the given tables, limited to what the caller may see; those whose tables are there.

    Besides the stored tables of a refresh ``tables`` may hold overrides,
    purchases, the tracker, metering records, raw tags and log tables. A caller's
    patterns and the size of the price list are read now, so views are registered
    anew after a refresh (``refresh_and_register``). No view holds anything else
    of this moment.
    """
    patterns = caller_patterns(access_map, ctx)
    made = []
    for name, (needed, view) in REPORT_VIEWS.items():
        if all(n in tables for n in needed):
            shown = dim_date(spark, ctx.today, calendar_days) if name == "calendar" else view(tables, patterns, ctx)
            shown.createOrReplaceTempView(prefix + name)
            made.append(prefix + name)
    return made


def refresh_and_register(
    spark: SparkSession, sources: Tables, settings: DataFrame, ctx: ReportContext, folder: str, access_map: DataFrame, **more
) -> list[str]:
    """The daily run, and the caller's views over what it stored and the inputs it was given."""
    stored = refresh_all(spark, sources, settings, ctx, folder, **more)
    given = {k: v for k, v in (more.get("inputs") or {}).items() if k not in stored}
    return register_views(spark, {**given, **stored}, stored.get("access_map", access_map), ctx)


def register_functions(
    spark: SparkSession,
    metering: DataFrame,
    settings: DataFrame,
    sheet: DataFrame,
    access_map: DataFrame,
    ctx: ReportContext,
) -> None:
    """Temporary SQL table functions for metering, settings, access patterns, days and prices."""
    metering.createOrReplaceTempView("metering_records")
    settings.createOrReplaceTempView("setting_records")
    resolve_access_patterns(access_map, ctx).createOrReplaceTempView("caller_patterns")
    densify(role_gate(sheet, ctx), ctx.today).createOrReplaceTempView("daily_rates")
    own = {"account_locator": ctx.account, "region": ctx.region}
    mine = spark.table("daily_rates")
    for column, value in own.items():
        mine = mine.filter(F.col(column) == F.lit(value))
    mine.createOrReplaceTempView("own_daily_rates")
    for text in FUNCTIONS:
        spark.sql(text)


FUNCTIONS = (
    """CREATE OR REPLACE TEMPORARY FUNCTION metering_history(pattern STRING, services ARRAY<STRING>, first DATE, last DATE)
    RETURNS TABLE RETURN
    SELECT start_time, end_time, entity_id, name, service_type, credits_used, credits_used_compute, credits_used_cloud_services,
      to_date(start_time) AS start_date,
      CAST(floor(unix_seconds(CAST(end_time AS TIMESTAMP)) / 3600) - floor(unix_seconds(CAST(start_time AS TIMESTAMP)) / 3600) AS BIGINT) AS operation_hours,
      date_format(start_time, 'HH:mm:ss') AS time_of_day
    FROM metering_records
    WHERE regexp_like(name, concat('\\\\A(?:', pattern, ')\\\\z')) AND array_contains(services, service_type)
      AND start_time >= CAST(first AS TIMESTAMP_NTZ) AND end_time < CAST(date_add(last, 1) AS TIMESTAMP_NTZ)""",
    """CREATE OR REPLACE TEMPORARY FUNCTION highest_setting(name STRING, used_by STRING, account STRING)
    RETURNS TABLE RETURN
    SELECT max(var_value) AS var_value, max(account_locator) AS account_locator FROM setting_records
    WHERE var_name = name AND var_usage = used_by AND account_locator = account""",
    """CREATE OR REPLACE TEMPORARY FUNCTION settings_of(name STRING, used_by STRING, account STRING, region STRING)
    RETURNS TABLE RETURN
    SELECT account_locator, region_name, var_name, var_value, var_usage, var_description FROM setting_records
    WHERE var_name = name AND var_usage = used_by AND account_locator = account AND region_name = region""",
    """CREATE OR REPLACE TEMPORARY FUNCTION access_patterns() RETURNS TABLE RETURN
    SELECT database_pattern, warehouse_pattern FROM caller_patterns""",
    """CREATE OR REPLACE TEMPORARY FUNCTION date_range(first DATE, last DATE) RETURNS TABLE RETURN
    SELECT explode(CASE WHEN first <= last THEN sequence(first, last) END) AS day""",
    """CREATE OR REPLACE TEMPORARY FUNCTION rate_timeseries(wanted STRING) RETURNS TABLE RETURN
    SELECT usage_type, rate_date, contract_number, service_level, currency, effective_rate, service_type FROM own_daily_rates
    WHERE usage_type = wanted""",
    """CREATE OR REPLACE TEMPORARY FUNCTION rate_timeseries_all(wanted STRING) RETURNS TABLE RETURN
    SELECT account_locator, region, usage_type, rate_date, contract_number, service_level, currency, effective_rate, service_type
    FROM daily_rates WHERE usage_type = wanted""",
)
