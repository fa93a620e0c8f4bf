"""What callers see of each history table: their rows, with derived columns.

Exact repeats were removed when a batch was loaded, so views neither shuffle nor
compare rows. They aren't sorted; sorting belongs to whoever shows the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usageledger.context import ReportContext
from usageledger.functions.times import elapsed_seconds
from usageledger.operators.access import (
    WAREHOUSE,
    Patterns,
    role_gate,
    scope_rows_either,
    scope_rows_single,
    scope_rows_two_columns,
)
from usageledger.operators.ranking import top_recent
from usageledger.operators.rates import COMPUTE_AND_CLOUD, price_as_of

CLOUD_AND_COMPUTE = {
    "credits_used": "compute_rate",
    "credits_used_cloud_services": "cloud_rate",
    "credits_used_compute": "compute_rate",
}


def table_service_view(history: DataFrame, patterns: Patterns) -> DataFrame:
    """Clustering, materialized view and replication credits by database."""
    return elapsed_seconds(scope_rows_single(history, patterns, "database_name"))


def priced_service_view(
    history: DataFrame, patterns: Patterns, sheet: DataFrame, usage_type: str, ctx: ReportContext
) -> DataFrame:
    """Table service credits with their price, by database."""
    seen = elapsed_seconds(scope_rows_single(history, patterns, "database_name"))
    return price_as_of(seen, sheet, {"rate": usage_type}, {"credits_used": "rate"}, ctx)


def copy_history_view(history: DataFrame, patterns: Patterns) -> DataFrame:
    return scope_rows_two_columns(history, patterns, "table_catalog_name", "pipe_catalog_name")


def load_history_view(history: DataFrame, patterns: Patterns) -> DataFrame:
    return scope_rows_single(history, patterns, "catalog_name")


def database_storage_view(history: DataFrame, patterns: Patterns) -> DataFrame:
    return scope_rows_single(history, patterns, "database_name")


def pipe_credit_view(history: DataFrame, patterns: Patterns) -> DataFrame:
    return elapsed_seconds(scope_rows_single(history, patterns, "pipe_database"))


def _query_columns(df: DataFrame) -> DataFrame:
    return elapsed_seconds(df).withColumns(
        {
            "start_date": F.to_date("start_time"),
            "execution_time_in_sec": F.floor(F.col("execution_time") / 1000).cast("bigint"),
        }
    )


def query_history_view(history: DataFrame, patterns: Patterns, rows: int | None = None) -> DataFrame:
    """The queries of the caller's warehouses or databases; with ``rows`` so many newest ones, as of this call."""
    seen = scope_rows_either(history, patterns)
    return _query_columns(seen if rows is None else top_recent(seen, "start_time", "query_id", rows))


def reader_query_history_view(history: DataFrame, patterns: Patterns) -> DataFrame:
    return _query_columns(scope_rows_either(history, patterns))


def reader_warehouse_credit_view(history: DataFrame, patterns: Patterns) -> DataFrame:
    return elapsed_seconds(scope_rows_single(history, patterns, "warehouse_name", WAREHOUSE))


def task_history_view(history: DataFrame, patterns: Patterns) -> DataFrame:
    seen = scope_rows_single(history, patterns, "database_name")
    return elapsed_seconds(seen, "query_start_time", "completed_time")


def warehouse_credit_view(
    history: DataFrame, patterns: Patterns, sheet: DataFrame, ctx: ReportContext
) -> DataFrame:
    """Warehouse credits with compute and cloud prices; 0 for callers who may not see prices."""
    seen = elapsed_seconds(scope_rows_single(history, patterns, "warehouse_name", WAREHOUSE))
    return price_as_of(seen, sheet, COMPUTE_AND_CLOUD, CLOUD_AND_COMPUTE, ctx)


def organization_view(history: DataFrame, ctx: ReportContext) -> DataFrame:
    """Organization-wide rows for the report service role."""
    return role_gate(history, ctx)


def organization_metering_view(history: DataFrame, sheet: DataFrame, ctx: ReportContext) -> DataFrame:
    """Warehouse metering of all accounts with each account's own prices."""
    seen = role_gate(history, ctx).withColumn("start_date", F.to_date("start_time"))
    return price_as_of(seen, sheet, COMPUTE_AND_CLOUD, CLOUD_AND_COMPUTE, ctx, all_accounts=True)
