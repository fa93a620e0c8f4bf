"""What the plans must look like for the reports to scale."""

import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from usageledger.operators.metering import metering_history
from usageledger.operators.ranking import top_recent
from usageledger.plans import loads, snapshots
from usageledger.plans.publish import DAY, refresh_history
from usageledger.plans.spec import can_match, incremental_load
from usageledger.sources.logical import logical

T0 = datetime(2024, 2, 1, 10)


def formatted(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture(scope="module")
def events_on_disk(spark, tmp_path_factory):
    """Stored query and metering tables."""
    from conftest import SMALL

    where = tmp_path_factory.mktemp("stored")
    for name in ("query_history", "warehouse_metering", "metering"):
        logical(spark, SMALL, name).write.parquet(str(where / name))
    return lambda name: spark.read.parquet(str(where / name))


def test_day_bounds_of_metering_reach_the_scan(events_on_disk):
    plan = formatted(metering_history(events_on_disk("metering"), "WH_.*", ["PIPE"], date(2024, 1, 5), date(2024, 1, 9)))
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    assert "GreaterThanOrEqual(start_time" in pushed and "LessThan(end_time" in pushed and "EqualTo(service_type,PIPE)" in pushed


def test_attribution_reads_its_columns_only(events_on_disk, ctx):
    df = snapshots.db_schema_credit(events_on_disk("query_history"), events_on_disk("warehouse_metering"), None, ctx)
    schemas = re.findall(r"ReadSchema: struct<(.*)>", formatted(df))
    queries = next(s for s in schemas if "execution_time" in s)
    assert {c.split(":")[0] for c in queries.split(",")} == {"warehouse_id", "database_name", "schema_name", "start_time", "execution_time"}


def test_query_facts_are_shuffled_as_sums_only(events_on_disk, ctx):
    df = snapshots.db_schema_credit(events_on_disk("query_history"), events_on_disk("warehouse_metering"), None, ctx)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = plan.index("execution_time", plan.index("FileScan"))
    assert "Exchange hashpartitioning" not in plan[plan.rindex("partial_sum", 0, scan) : scan]


def test_a_batch_reads_only_the_days_it_can_meet(spark, ctx):
    data = spark.createDataFrame(
        [("d", "s", "t", T0 - timedelta(days=i), T0, 1.0) for i in range(5)],
        "database_name string, schema_name string, table_name string, start_time timestamp_ntz, end_time timestamp_ntz, credits_used double",
    )
    refresh_history(spark, loads.AUTO_CLUSTERING, data, "plan_days", ctx)
    stored = spark.table("plan_days").filter(F.col(DAY) >= F.lit(T0.date())).drop(DAY)
    loaded = incremental_load(loads.AUTO_CLUSTERING, data, stored, ctx, mark=T0)
    filters = re.findall(r"PartitionFilters: \[(.*)\]", formatted(loaded))
    assert filters and all(DAY in f for f in filters)


def test_keys_are_compared_from_the_watermark_on(events_on_disk, ctx):
    spec = loads.WAREHOUSE_CREDIT
    stored = incremental_load(spec, events_on_disk("metering"), None, ctx)
    seen = stored.filter(can_match(spec, T0, stored)).select("sh_key")
    assert "GreaterThanOrEqual(start_time,2024-02-01T10:00)" in formatted(seen)
    assert can_match(loads.QUERY_HISTORY, T0, stored) is None


def test_the_edge_of_the_newest_rows_reaches_the_scan(events_on_disk):
    plan = formatted(top_recent(events_on_disk("query_history"), "start_time", "query_id", 100))
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(start_time,2024-01-\d\d", plan)
    assert "Exchange" not in plan


def test_views_neither_shuffle_nor_compare_rows(spark, events_on_disk):
    """Nothing is exchanged above a stored history; prices, the one thing joined, are broadcast."""
    from usageledger import queries
    from usageledger.plans import views

    history = events_on_disk("query_history")
    patterns = queries.patterns(spark, queries_folder())
    history = history.withColumns({"catalog_name": F.col("database_name"), "pipe_database": F.col("database_name")})
    task = history.withColumns({"query_start_time": F.col("start_time"), "completed_time": F.col("end_time")})
    seen = [
        views.table_service_view(history, patterns),
        views.load_history_view(history, patterns),
        views.database_storage_view(history, patterns),
        views.pipe_credit_view(history, patterns),
        views.query_history_view(history, patterns),
        views.reader_query_history_view(history, patterns),
        views.reader_warehouse_credit_view(history, patterns),
        views.task_history_view(task, patterns),
        views.organization_view(history, queries.EVENTS),
        views.copy_history_view(history.withColumn("pipe_catalog_name", F.col("database_name")).withColumn("table_catalog_name", F.col("database_name")), patterns),
    ]
    for df in seen:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Aggregate" not in plan


def queries_folder():
    from conftest import SMALL

    return SMALL


@pytest.mark.parametrize(
    "name, most",
    [
        ("rpt_query_history", 7),
        ("rpt_search_opt", 6),
        ("rpt_serverless_task", 6),
        ("rpt_warehouse_credit", 6),
        ("rpt_org_metering", 6),
        ("rpt_month_credits_pivot", 6),
        ("rpt_month_credits_unpivot", 6),
        ("rpt_query_credit", 6),
    ],
)
def test_few_jobs_run_before_the_plan_is_made(spark, name, most):
    """Two loads, a caller's patterns, and sizes: what must be known before the plan."""
    from usageledger import queries

    context = spark.sparkContext
    context.setJobGroup(f"before-{name}", name)
    try:
        queries.QUERIES[name](spark, queries_folder())
        assert len(context.statusTracker().getJobIdsForGroup(f"before-{name}")) <= most
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
