"""Reports that are recomputed in full."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usageledger.context import ReportContext
from usageledger.functions.times import time_literal
from usageledger.functions.units import bytes_to_gib
from usageledger.operators.access import (
    WAREHOUSE,
    Patterns,
    role_membership_scope,
    scope_rows_both,
    scope_rows_either,
    scope_rows_single,
)
from usageledger.operators.attribution import (
    attribute_credits,
    db_schema_credits,
    month_credits_pivot,
    month_credits_unpivot,
    shift_month,
)
from usageledger.operators.settings import stamp_context


def _months_ago(ctx: ReportContext, months: int):
    first = shift_month(ctx.today, -months)
    last = shift_month(first, 1) - timedelta(days=1)
    return first.replace(day=min(ctx.today.day, last.day))


def recent_queries(queries: DataFrame, ctx: ReportContext, months: int | None) -> DataFrame:
    """Queries of the last months, as a literal bound on the time; None is all of them."""
    if months is None:
        return queries
    since = time_literal(_months_ago(ctx, months), queries.schema["start_time"].dataType)
    return queries.filter(F.col("start_time") >= since)


def query_credit(
    queries: DataFrame, metering: DataFrame, ctx: ReportContext, closed: str = "left", months: int | None = None
) -> DataFrame:
    """Credit of each query that ran on a sized warehouse, in the last ``months`` if given."""
    sized = recent_queries(queries, ctx, months).filter(F.col("warehouse_size").isNotNull())
    shares = attribute_credits(
        sized.select("query_id", "warehouse_id", "warehouse_name", "database_name", "start_time", "execution_time"),
        metering,
        closed,
    )
    return stamp_context(shares, ctx).select(
        "account_locator",
        "region_name",
        "organization_name",
        "warehouse_name",
        "database_name",
        "query_id",
        F.to_date("start_time").alias("start_date"),
        "pct_credit_used_by_query",
        "credit_used_by_query",
    )


def query_credit_view(credits: DataFrame, patterns: Patterns) -> DataFrame:
    return scope_rows_either(credits, patterns)


def db_schema_credit(
    queries: DataFrame,
    metering: DataFrame,
    patterns: Patterns | None,
    ctx: ReportContext,
    closed: str = "left",
    months: int | None = None,
) -> DataFrame:
    """Credits per warehouse, database, schema and day, scoped before they are summed."""
    credits = db_schema_credits(recent_queries(queries, ctx, months), metering, closed)
    return credits if patterns is None else scope_rows_both(credits, patterns)


def monthly_credits(
    queries: DataFrame,
    metering: DataFrame,
    monitors: DataFrame,
    patterns: Patterns,
    ctx: ReportContext,
    duration: int = 12,
    closed: str = "left",
    starting_from: int = 0,
) -> DataFrame:
    """Credits and query counts per warehouse, user, monitor and month, scoped first."""
    seen = scope_rows_single(queries, patterns, "warehouse_name", WAREHOUSE)
    return month_credits_pivot(seen, metering, monitors, ctx.today, duration, starting_from, closed)


def monthly_credits_long(pivoted: DataFrame, patterns: Patterns) -> DataFrame:
    return scope_rows_single(month_credits_unpivot(pivoted), patterns, "name", WAREHOUSE)


def grants_to_roles(grants: DataFrame, ctx: ReportContext) -> DataFrame:
    return stamp_context(grants, ctx)


def grants_to_roles_view(stored: DataFrame, ctx: ReportContext) -> DataFrame:
    return role_membership_scope(stored, ctx)


def passthrough(table: DataFrame) -> DataFrame:
    """A table as it is: grants to users and the connector log tables."""
    return table


def table_storage(metrics: DataFrame, ctx: ReportContext) -> DataFrame:
    """Storage of each table in GiB; repeats in the listing count once."""
    sizes = ("active_bytes", "time_travel_bytes", "failsafe_bytes", "retained_for_clone_bytes")
    rest = [c for c in metrics.columns if c not in sizes]
    return stamp_context(metrics, ctx).select(
        "account_locator",
        "region_name",
        "organization_name",
        *rest,
        *[bytes_to_gib(F.col(c)).alias(f"{c}_gb") for c in sizes],
    ).distinct()


def table_storage_view(stored: DataFrame, patterns: Patterns) -> DataFrame:
    total = (
        F.col("active_bytes_gb")
        + F.col("time_travel_bytes_gb")
        + F.col("failsafe_bytes_gb")
        + F.col("retained_for_clone_bytes_gb")
    )
    return scope_rows_single(stored, patterns, "database_name").withColumn("total_storage_gb", total)


def object_dependencies(edges: DataFrame, ctx: ReportContext) -> DataFrame:
    return stamp_context(edges, ctx)


# Kinds of listed resources.
RESOURCE_KINDS = ("DATABASE", "WAREHOUSE", "ROLE", "USER", "RM")


def active_resources(listings: dict[str, DataFrame]) -> DataFrame:
    """All listings below each other, tagged with their kind."""
    out = None
    for kind, listing in listings.items():
        if kind not in RESOURCE_KINDS:
            raise ValueError(f"unknown resource kind {kind!r}")
        part = listing.select(F.lit(kind).alias("resource_type"), F.col("name").alias("resource_name"), "created_on")
        out = part if out is None else out.unionByName(part)
    return out


def active_of_kind(resources: DataFrame, kind: str) -> DataFrame:
    return resources.filter(F.col("resource_type") == kind)


def captured_monitors(monitors: DataFrame) -> DataFrame:
    """Resource monitors that watch warehouses."""
    return monitors.filter(F.col("level") == "WAREHOUSE")


def resource_monitor(monitors: DataFrame, warehouses: DataFrame, patterns: Patterns) -> DataFrame:
    """Monitors with the warehouses they watch, for the caller's warehouses."""
    # The column names of the monitor report.
    watch = captured_monitors(monitors).select(
        F.col("name").alias("resource_monitor_name"),
        "credit_quota",
        "used_credits",
        "remaining_credits",
        "frequency",
        F.col("start_time").alias("rm_start_time"),
        F.col("end_time").alias("rm_end_time"),
        F.col("notify_at").alias("rm_notify_at"),
        F.col("suspend_at").alias("rm_suspend_at"),
        F.col("suspend_immediately_at").alias("rm_suspend_immediately_at"),
        F.col("created_on").alias("rm_created_on"),
        F.col("owner").alias("rm_owner"),
        F.col("comment").alias("rm_comment"),
    )
    watched = warehouses.select(
        F.col("resource_monitor").alias("resource_monitor_name"),
        F.col("name").alias("warehouse_name"),
        F.col("type").alias("warehouse_type"),
        F.col("size").alias("warehouse_size"),
        F.col("min_cluster_count").alias("warehouse_min_cluster_count"),
        F.col("max_cluster_count").alias("warehouse_max_cluster_count"),
        F.col("created_on").alias("warehouse_created_on"),
        F.col("updated_on").alias("warehouse_updated_on"),
        F.col("comment").alias("warehouse_comment"),
        F.col("scaling_policy").alias("warehouse_scaling_policy"),
    )
    seen = scope_rows_single(watched, patterns, "warehouse_name", WAREHOUSE)
    return seen.join(watch, "resource_monitor_name").distinct()


# The columns of the connector list.
CONNECTOR_COLUMNS = (
    "id",
    "official_connector_name",
    "type",
    "availability",
    "created_at",
    "public_beta_at",
    "release_at",
    "deleted",
    "broken",
    "synced",
)


def connector_type_current(connectors: DataFrame) -> DataFrame:
    return connectors.select(*CONNECTOR_COLUMNS)
