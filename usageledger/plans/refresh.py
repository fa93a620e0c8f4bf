"""The daily run: all history tables, then the reports computed from them, then the lists stored as they are."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from usageledger.context import ReportContext
from usageledger.operators import names, tags
from usageledger.operators.merge import merge_upsert
from usageledger.operators.metering import warehouse_daily_credits
from usageledger.operators.reconcile import access_map_refresh, grants_to_patterns
from usageledger.operators.retention import retention_delete
from usageledger.operators.settings import retention_days, setting_value
from usageledger.plans import snapshots
from usageledger.plans.loads import QUERY_HISTORY, REPORTS, WAREHOUSE_CREDIT
from usageledger.plans.publish import history_table, publish_swap, refresh_history
from usageledger.plans.spec import ReportSpec
from usageledger.streaming.loads import connector_type_history

Inputs = Mapping[str, DataFrame]
Full = Callable[[Inputs, ReportContext], DataFrame]


def _resources(t: Inputs, ctx: ReportContext) -> DataFrame:
    of = {"DATABASE": "databases", "WAREHOUSE": "warehouses", "ROLE": "roles", "USER": "users", "RM": "monitors"}
    return snapshots.active_resources({kind: t[name] for kind, name in of.items()})


#: Tables that are replaced whole: the inputs each needs, and how it is made of them.
FULL: dict[str, tuple[tuple[str, ...], Full]] = {
    "table_storage": (("table_storage_metrics",), lambda t, c: snapshots.table_storage(t["table_storage_metrics"], c)),
    "grants_to_roles": (("role_grants",), lambda t, c: snapshots.grants_to_roles(t["role_grants"], c)),
    "grants_to_users": (("user_grants",), lambda t, c: snapshots.passthrough(t["user_grants"])),
    "object_dependencies": (("dependencies",), lambda t, c: snapshots.object_dependencies(t["dependencies"], c)),
    "active_resources": (("databases", "warehouses", "roles", "users", "monitors"), _resources),
    "resource_monitors": (("monitors",), lambda t, c: snapshots.captured_monitors(t["monitors"])),
    "watched_warehouses": (("warehouses",), lambda t, c: snapshots.passthrough(t["warehouses"])),
    "database_metadata": (("database_listing",), lambda t, c: names.parse_database_names(t["database_listing"])),
    "warehouse_metadata": (("warehouse_listing",), lambda t, c: names.parse_warehouse_names(t["warehouse_listing"])),
    "tag_metadata": (
        ("tag_references", "object_listing"),
        lambda t, c: tags.tag_metadata(t["tag_references"], t["object_listing"], t.get("existing_tags")),
    ),
    "connector_types": (("connectors",), lambda t, c: snapshots.connector_type_current(t["connectors"])),
}
#: Columns that a retention setting of a computed report goes by.
RETAINED = {"query_credit": "start_date", "db_schema_credit": "usage_date"}


def stored_name(report: str, prefix: str = "usage_") -> str:
    return f"{prefix}{report}"


def _attributed(
    queries: DataFrame, metering: DataFrame, monitors: DataFrame | None, ctx: ReportContext, months: int | None, pivot: tuple[int, int]
) -> Inputs:
    """The reports that split credits between queries; ``pivot`` are the months of the month report and how many ago the last is."""
    computed = {
        "query_credit": snapshots.query_credit(queries, metering, ctx, months=months),
        "db_schema_credit": snapshots.db_schema_credit(queries, metering, None, ctx, months=months),
    }
    if monitors is not None:
        computed["month_credits"] = snapshots.month_credits_unpivot(
            snapshots.month_credits_pivot(queries, metering, monitors, ctx.today, *pivot)
        )
    return computed


def refresh_all(
    spark: SparkSession,
    sources: Inputs,
    settings: DataFrame,
    ctx: ReportContext,
    folder: str,
    monitors: DataFrame | None = None,
    prefix: str = "usage_",
    inputs: Inputs | None = None,
    attribution_months: int | None = None,
    connector_changes: DataFrame | None = None,
    report_months: int = 12,
    report_starts: int = 0,
    reports: Mapping[str, ReportSpec] = REPORTS,
) -> dict[str, DataFrame]:
    """Refresh every report that has its sources; returns the stored tables by report.

    ``sources`` are those of incremental reports, ``inputs`` what the others are
    made of, by the names in ``FULL``; further ``named_metering`` for daily
    credits, and ``access_map`` and ``role_tags``, with ``role_grants``, for the
    access map. ``connector_changes`` is a stream. Attribution reads the stored
    query and warehouse histories, so it comes after both; ``attribution_months``
    bounds how far it looks back. The month report has ``report_months`` months, the
    last of them ``report_starts`` months ago. ``reports`` are the specs of the
    incremental ones, for callers who want another first load, window or look-back
    (``dataclasses.replace``). Account and organization are those of the
    settings: without an ORGANIZATION setting nothing is loaded. A failing report
    stops the run; the ones before it are already complete, and run again they
    change nothing.
    """
    organization = setting_value(settings, "ORGANIZATION", "GLOBAL", ctx)
    if organization is None:
        return {}
    ctx = replace(ctx, organization=organization)
    inputs = inputs or {}
    stored: dict[str, DataFrame] = {}

    def publish(name: str, df: DataFrame) -> None:
        stored[name] = publish_swap(df, stored_name(name, prefix), f"{folder.rstrip('/')}/{name}")

    for name, source in sources.items():
        days = retention_days(settings, name, ctx)
        stored[name] = refresh_history(spark, reports[name], source, stored_name(name, prefix), ctx, days)
    if QUERY_HISTORY.name in stored and WAREHOUSE_CREDIT.name in stored:
        queries = history_table(spark, stored_name(QUERY_HISTORY.name, prefix))
        metering = history_table(spark, stored_name(WAREHOUSE_CREDIT.name, prefix))
        for name, df in _attributed(queries, metering, monitors, ctx, attribution_months, (report_months, report_starts)).items():
            days = retention_days(settings, name, ctx) if name in RETAINED else None
            publish(name, retention_delete(df, RETAINED[name], days, ctx, None) if days is not None else df)
    for name, (needed, made) in FULL.items():
        if all(n in inputs for n in needed):
            publish(name, made(inputs, ctx))
    if "named_metering" in inputs:
        daily, name = warehouse_daily_credits(inputs["named_metering"]), stored_name("daily_credits", prefix)
        if spark.catalog.tableExists(name):
            daily = merge_upsert(daily, spark.table(name), ["warehouse_name", "active_date"], ["credits_used"])
        publish("daily_credits", daily)
    if all(n in inputs for n in ("access_map", "role_grants", "role_tags")):
        name = stored_name("access_map", prefix)
        current = spark.table(name) if spark.catalog.tableExists(name) else inputs["access_map"]
        publish("access_map", access_map_refresh(current, grants_to_patterns(inputs["role_grants"], inputs["role_tags"])))
    if connector_changes is not None:
        where = f"{folder.rstrip('/')}/connector_type_history"
        days = retention_days(settings, "connector_type_history", ctx)
        stored["connector_type_history"] = connector_type_history(connector_changes, f"{where}/rows", f"{where}/checkpoint", ctx, days)
    return stored
