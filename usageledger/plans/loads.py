"""The nineteen incremental reports.

Retention days are fixed values of the report set; load history has none, so
nothing is ever deleted from it unless the caller's settings say so.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usageledger.context import ReportContext
from usageledger.functions.keys import VERSION_SENTINEL, day, moment, number, text
from usageledger.functions.labels import RATE_LABELS, SPEND_LABELS, normalize_usage_type
from usageledger.functions.times import derive_time_columns
from usageledger.functions.units import bytes_to_gib
from usageledger.operators.settings import stamp_context
from usageledger.operators.skew import skew_safe_join
from usageledger.plans.columns import columns_of
from usageledger.plans.spec import ReportSpec

# Days of retention, months of a first load, days of the file load reports, and how late task runs change.
YEAR, TWO_YEARS, MONTH = 365, 730, 30
FIRST_MONTHS = 12
LOAD_WINDOW_DAYS = 30
LATE_LOOKBACK = timedelta(hours=36)


def _account_key(*parts: Column) -> list[Column]:
    return [text("region_name"), text("account_locator"), *parts]


def _stamped(df: DataFrame, ctx: ReportContext) -> DataFrame:
    return stamp_context(df, ctx)


def _timed(df: DataFrame, ctx: ReportContext) -> DataFrame:
    return derive_time_columns(stamp_context(df, ctx))


def _database_storage(df: DataFrame, ctx: ReportContext) -> DataFrame:
    live = bytes_to_gib(F.col("average_database_bytes"), 3, "round")
    failsafe = bytes_to_gib(F.col("average_failsafe_bytes"), 3, "round")
    return stamp_context(df, ctx).select(
        "account_locator",
        "region_name",
        F.col("usage_date").alias("usage_month"),
        "database_name",
        "database_id",
        live.alias("avg_database_storage_gb"),
        failsafe.alias("avg_failsafe_storage_gb"),
        (live + failsafe).alias("total_storage_gb"),
        "organization_name",
    )


def _account_storage(df: DataFrame, ctx: ReportContext) -> DataFrame:
    storage, stage, failsafe = F.col("storage_bytes"), F.col("stage_bytes"), F.col("failsafe_bytes")
    return stamp_context(df, ctx).select(
        "account_locator",
        "region_name",
        "organization_name",
        F.col("usage_date").alias("usage_month"),
        bytes_to_gib(storage + stage + failsafe, 3, "floor").alias("total_billable_storage_gb"),
        bytes_to_gib(storage, 0, "floor").alias("storage_billable_storage_gb"),
        bytes_to_gib(stage, 0, "floor").alias("stage_billable_storage_gb"),
        bytes_to_gib(failsafe, 0, "floor").alias("failsafe_billable_storage_gb"),
    )


def _task_runs(df: DataFrame, ctx: ReportContext) -> DataFrame:
    def shown(c: str) -> Column:
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS").alias(f"{c}_text")

    return stamp_context(df, ctx).select(
        "*", shown("scheduled_time"), shown("query_start_time"), shown("completed_time")
    )


def _warehouse_credits(df: DataFrame, ctx: ReportContext) -> DataFrame:
    return (
        stamp_context(df, ctx).withColumnRenamed("entity_id", "warehouse_id").withColumnRenamed("name", "warehouse_name")
    )


def _spending(df: DataFrame, ctx: ReportContext) -> DataFrame:
    group = [
        "organization_name",
        "contract_number",
        "account_name",
        "account_locator",
        "region",
        "service_level",
        "usage_date",
        "usage_type",
        "currency",
    ]
    return (
        df.withColumn("usage_type", normalize_usage_type(F.col("usage_type"), SPEND_LABELS))
        .groupBy(*group)
        .agg(F.sum("usage").alias("usage"), F.sum("usage_in_currency").alias("usage_in_currency"))
    )


def _price_list(df: DataFrame, ctx: ReportContext) -> DataFrame:
    return df.withColumn("usage_type", normalize_usage_type(F.col("usage_type"), RATE_LABELS))


def _as_is(df: DataFrame, ctx: ReportContext) -> DataFrame:
    return df


def _table_service(name: str, *key: str, whole_days: bool = False) -> ReportSpec:
    """Credits of a service that works on tables or tasks, per hour."""
    return ReportSpec(
        name=name,
        columns=columns_of(name),
        source_time="start_time",
        time="start_time",
        first_months=FIRST_MONTHS,
        shape=_timed,
        key=lambda: _account_key(*[text(k) for k in key], moment("start_time")),
        whole_days=whole_days,
        retain_days=YEAR,
    )


AUTO_CLUSTERING = _table_service("auto_clustering", "database_name", "schema_name", "table_name")
MV_REFRESH = _table_service("mv_refresh", "database_name", "schema_name", "table_name", whole_days=True)
REPLICATION = _table_service("replication", "database_name", whole_days=True)
SEARCH_OPTIMIZATION = _table_service("search_optimization", "database_name", "schema_name", "table_name")
SERVERLESS_TASK = _table_service("serverless_task", "database_name", "schema_name", "task_name")

COPY_HISTORY = ReportSpec(
    name="copy_history",
    columns=columns_of("copy_history"),
    source_time="last_load_time",
    time="last_load_time",
    first_months=FIRST_MONTHS,
    shape=_stamped,
    key=lambda: _account_key(
        text("file_name"),
        text("stage_location"),
        text("table_name"),
        text("table_schema_name"),
        text("table_catalog_name"),
        text("pipe_catalog_name"),
        text("pipe_schema_name"),
        text("pipe_name"),
        moment("last_load_time"),
    ),
    window_days=LOAD_WINDOW_DAYS,
    retain_days=YEAR,
)

LOAD_HISTORY = ReportSpec(
    name="load_history",
    columns=columns_of("load_history"),
    source_time="last_load_time",
    time="last_load_time",
    first_months=FIRST_MONTHS,
    shape=_stamped,
    key=lambda: _account_key(
        text("table_name"), text("schema_name"), text("catalog_name"), text("file_name"), moment("last_load_time")
    ),
    window_days=LOAD_WINDOW_DAYS,
)

DATABASE_STORAGE = ReportSpec(
    name="database_storage",
    columns=columns_of("database_storage"),
    source_time="usage_date",
    time="usage_month",
    first_months=FIRST_MONTHS,
    shape=_database_storage,
    key=lambda: _account_key(text("database_name"), day("usage_month")),
    retain_days=YEAR,
)

ACCOUNT_STORAGE = ReportSpec(
    name="account_storage",
    columns=columns_of("account_storage"),
    source_time="usage_date",
    time="usage_month",
    first_months=FIRST_MONTHS,
    distinct=False,
    shape=_account_storage,
    key=lambda: _account_key(day("usage_month")),
    retain_days=YEAR,
)

PIPE_CREDIT = ReportSpec(
    name="pipe_credit",
    columns=columns_of("pipe_credit"),
    source_time="start_time",
    time="start_time",
    first_months=FIRST_MONTHS,
    shape=_stamped,
    key=lambda: _account_key(text("pipe_name"), moment("start_time")),
    whole_days=True,
    retain_days=YEAR,
)

QUERY_HISTORY = ReportSpec(
    name="query_history",
    columns=columns_of("query_history"),
    source_time="start_time",
    time="start_time",
    first_months=FIRST_MONTHS,
    keyed_by_time=False,
    shape=_stamped,
    key=lambda: _account_key(text("query_id")),
    retain_days=MONTH,
    counted_by=("warehouse_name", "database_name"),
)

READER_QUERY_HISTORY = ReportSpec(
    name="reader_query_history",
    columns=columns_of("reader_query_history"),
    source_time="start_time",
    time="start_time",
    first_months=FIRST_MONTHS,
    keyed_by_time=False,
    shape=_stamped,
    key=lambda: _account_key(text("query_id"), text("reader_account_name")),
    retain_days=YEAR,
)

READER_WAREHOUSE_CREDIT = ReportSpec(
    name="reader_warehouse_credit",
    columns=columns_of("reader_warehouse_credit"),
    source_time="start_time",
    time="start_time",
    first_months=FIRST_MONTHS,
    shape=_timed,
    key=lambda: _account_key(text("warehouse_name"), text("reader_account_name"), moment("start_time")),
    retain_days=YEAR,
)

SESSIONS = ReportSpec(
    name="sessions",
    columns=columns_of("sessions"),
    source_time="created_on",
    time="created_on",
    first_months=FIRST_MONTHS,
    distinct=False,
    shape=lambda df, ctx: stamp_context(df, ctx).withColumn("created_date", F.to_date("created_on")),
    key=lambda: _account_key(
        number("session_id"), text("user_name"), text("client_application_id"), moment("created_on")
    ),
    retain_days=YEAR,
)

TASK_HISTORY = ReportSpec(
    name="task_history",
    columns=columns_of("task_history"),
    source_time="scheduled_time",
    time="scheduled_time",
    first_months=FIRST_MONTHS,
    shape=_task_runs,
    key=lambda: _account_key(
        text("query_id"),
        text("task_name"),
        text("database_name"),
        text("schema_name"),
        text("root_task_id"),
        number("run_id"),
        number("graph_version", VERSION_SENTINEL),
        moment("scheduled_time"),
    ),
    lookback=LATE_LOOKBACK,
    updates=("state", "completed_time", "error_code", "error_message", "completed_time_text", "return_value"),
    newest_by=("completed_time",),
    retain_days=YEAR,
)

WAREHOUSE_CREDIT = ReportSpec(
    name="warehouse_credit",
    columns=columns_of("warehouse_credit"),
    source_time="start_time",
    time="start_time",
    first_months=FIRST_MONTHS,
    shape=_warehouse_credits,
    key=lambda: _account_key(number("warehouse_id"), text("service_type"), moment("start_time")),
    whole_days=True,
    retain_days=YEAR,
)

ORG_CURRENCY = ReportSpec(
    name="org_currency",
    columns=columns_of("org_currency"),
    source_time="usage_date",
    time="usage_date",
    shape=_spending,
    key=lambda: [
        text("organization_name"),
        number("contract_number"),
        text("account_name"),
        text("account_locator"),
        text("region"),
        text("service_level"),
        text("usage_type"),
        text("currency"),
        day("usage_date"),
    ],
    dated_only=True,
    retain_days=TWO_YEARS,
)

ORG_RATE_SHEET = ReportSpec(
    name="org_rate_sheet",
    columns=columns_of("org_rate_sheet"),
    source_time="rate_date",
    time="rate_date",
    shape=_price_list,
    key=lambda: [
        text("organization_name"),
        number("contract_number"),
        text("account_name"),
        text("account_locator"),
        text("region"),
        text("service_level"),
        text("usage_type"),
        day("rate_date"),
    ],
    dated_only=True,
    retain_days=TWO_YEARS,
)

ORG_METERING = ReportSpec(
    name="org_metering",
    columns=columns_of("org_metering"),
    source_time="start_time",
    time="start_time",
    shape=_as_is,
    key=lambda: [
        text("organization_name"),
        text("account_name"),
        text("account_locator"),
        text("region"),
        number("warehouse_id"),
        moment("start_time"),
    ],
    dated_only=True,
    retain_days=YEAR,
)

REPORTS = {
    s.name: s
    for s in (
        AUTO_CLUSTERING,
        COPY_HISTORY,
        LOAD_HISTORY,
        DATABASE_STORAGE,
        MV_REFRESH,
        PIPE_CREDIT,
        QUERY_HISTORY,
        READER_QUERY_HISTORY,
        READER_WAREHOUSE_CREDIT,
        REPLICATION,
        SEARCH_OPTIMIZATION,
        SERVERLESS_TASK,
        SESSIONS,
        ACCOUNT_STORAGE,
        TASK_HISTORY,
        WAREHOUSE_CREDIT,
        ORG_CURRENCY,
        ORG_RATE_SHEET,
        ORG_METERING,
    )
}


# Days kept by reports that are not incremental loads.
OTHER_RETENTION = {"query_credit": YEAR, "db_schema_credit": YEAR, "connector_type_history": YEAR}
SETTINGS_SCHEMA = (
    "account_locator string, region_name string, var_name string, var_value string, var_usage string, var_description string"
)


def default_settings(spark: SparkSession, ctx: ReportContext) -> DataFrame:
    """The settings a new account starts with: retention of each report and the organization."""
    kept = {**{s.name: s.retain_days for s in REPORTS.values()}, **OTHER_RETENTION}
    rows = [("DAYS_TO_RETAIN", str(days), name, "days of history to keep") for name, days in kept.items() if days]
    rows += [
        ("ACCOUNT_LOCATOR", ctx.account, "GLOBAL", "account"),
        ("ORGANIZATION", ctx.organization, "GLOBAL", "organization"),
    ]
    return spark.createDataFrame([(ctx.account, ctx.region, *r) for r in rows], SETTINGS_SCHEMA)


def pipe_usage(metering: DataFrame, pipes: DataFrame) -> DataFrame:
    """Metering of pipes with where each pipe lives; source of the pipe report."""
    where = pipes.select(
        F.col("pipe_id").alias("entity_id"),
        "pipe_schema",
        F.col("pipe_catalog").alias("pipe_database"),
        "pipe_owner",
    )
    return skew_safe_join(metering, where, ["entity_id"], spread_by=["start_time"]).select(
        "start_time",
        "end_time",
        F.col("entity_id").alias("pipe_id"),
        F.col("name").alias("pipe_name"),
        "service_type",
        "credits_used",
        "start_date",
        "operation_hours",
        "time_of_day",
        "pipe_schema",
        "pipe_database",
        "pipe_owner",
    )


def session_logins(sessions: DataFrame, logins: DataFrame) -> DataFrame:
    """Sessions with the login that opened them; source of the session report."""
    opened = logins.select(F.col("event_id").alias("login_event_id"), "event_type", "is_success")
    # One login, of a service account say, may have opened a large part of all sessions.
    return skew_safe_join(sessions, opened, ["login_event_id"], spread_by=["session_id"]).select("session_id", "created_on", "user_name", "client_application_id", "event_type", "is_success")
