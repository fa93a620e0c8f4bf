"""The daily run end to end, and its results in SQL."""

from dataclasses import replace
from datetime import timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from usageledger import queries
from usageledger.operators import access, rates
from usageledger.operators.metering import metering_history
from usageledger.operators.settings import retention_days
from usageledger.plans import loads
from usageledger.plans.refresh import FULL, refresh_all
from usageledger.plans.sql import LOG_TABLES, REPORT_VIEWS, refresh_and_register, register_functions, register_views
from usageledger.sources.logical import logical
from usageledger.streaming.loads import parquet_stream

CTX = queries.EVENTS


@pytest.fixture(scope="module")
def inputs(spark):
    from conftest import SMALL

    def of(name):
        return logical(spark, SMALL, name)

    year = CTX.today - timedelta(days=365)
    metered = metering_history(of("metering"), ".+", ["WAREHOUSE_METERING", "WAREHOUSE_METERING_READER"], year, CTX.today)
    sources = {
        "warehouse_credit": metered,
        "org_rate_sheet": of("rate_sheet"),
        "query_history": of("query_history"),
        "auto_clustering": of("table_service"),
        "sessions": loads.session_logins(of("sessions"), of("logins")),
    }
    return of, sources


@pytest.fixture(scope="module")
def stored(spark, inputs, tmp_path_factory):
    of, sources = inputs
    settings = loads.default_settings(spark, CTX)
    where = str(tmp_path_factory.mktemp("published"))
    monitors = of("warehouses").selectExpr("resource_monitor AS resource_monitor_name", "name AS warehouse_name")
    first = {n: df.count() for n, df in refresh_all(spark, sources, settings, CTX, where, monitors).items()}
    again = refresh_all(spark, sources, settings, CTX, where, monitors)
    return first, again


def test_a_second_run_changes_nothing(stored):
    first, again = stored
    assert {n: df.count() for n, df in again.items()} == first
    assert set(first) == {"warehouse_credit", "org_rate_sheet", "query_history", "auto_clustering", "sessions", "query_credit", "db_schema_credit", "month_credits"}
    assert all(first.values())


def test_views_show_a_caller_their_part(spark, stored, inputs):
    of, _ = inputs
    _, tables = stored
    names = register_views(spark, tables, of("access_map"), CTX)
    assert set(names) == {f"ext_{n}" for n in tables} | {"ext_calendar"}
    seen = spark.sql("SELECT count(*) FROM ext_query_history").first()[0]
    assert 0 < seen < tables["query_history"].count()
    assert spark.sql("SELECT sum(credits_used_effective_rate) FROM ext_warehouse_credit").first()[0] > 0
    register_views(spark, tables, of("access_map"), replace(CTX, user="nobody", roles=()), "none_")
    for name in tables:
        hidden = spark.table(f"none_{name}").count()
        assert hidden == (tables[name].count() if name == "sessions" else 0), name


def test_table_functions(spark, inputs):
    of, _ = inputs
    settings = loads.default_settings(spark, CTX)
    sheet = of("rate_sheet")
    register_functions(spark, of("metering"), settings, sheet, of("access_map"), CTX)
    got = spark.sql(
        "SELECT * FROM metering_history('WH_[2-9]', array('WAREHOUSE_METERING'), DATE '2024-01-05', DATE '2024-01-25')"
    )
    from datetime import date

    want = metering_history(of("metering"), "WH_[2-9]", ["WAREHOUSE_METERING"], date(2024, 1, 5), date(2024, 1, 25))
    assert rows(got) == rows(want.select(*got.columns)) and got.count() > 0
    assert rows(spark.sql("SELECT * FROM highest_setting('DAYS_TO_RETAIN', 'query_history', 'ACC_0')")) == [("30", "ACC_0")]
    assert spark.sql("SELECT * FROM settings_of('ORGANIZATION', 'GLOBAL', 'ACC_0', 'R1')").count() == 1
    assert spark.sql("SELECT * FROM date_range(DATE '2024-02-27', DATE '2024-03-01')").count() == 4
    patterns = access.resolve_access_patterns(of("access_map"), CTX)
    assert rows(spark.sql("SELECT * FROM access_patterns()")) == rows(patterns)
    for function, operator in (("rate_timeseries", rates.rate_timeseries), ("rate_timeseries_all", rates.rate_timeseries_all)):
        assert rows(spark.sql(f"SELECT * FROM {function}('compute')")) == rows(operator(sheet, "compute", CTX))


def test_default_settings_name_each_retention(spark):
    settings = loads.default_settings(spark, CTX)
    assert retention_days(settings, "org_rate_sheet", CTX) == 730
    assert retention_days(settings, "load_history", CTX) is None


@pytest.fixture(scope="module")
def inputs_of_all(inputs):
    """What the whole run is made of, by name."""
    of, _ = inputs
    logs = {f"log_{n}": of("users") for n in LOG_TABLES}
    return logs | {
        "table_storage_metrics": of("table_storage"),
        "role_grants": of("role_grants"),
        "user_grants": of("user_grants"),
        "dependencies": of("object_dependencies"),
        "databases": of("databases"),
        "warehouses": of("warehouses"),
        "roles": of("roles"),
        "users": of("users"),
        "monitors": of("monitors"),
        "database_listing": of("database_listing"),
        "warehouse_listing": of("warehouse_listing"),
        "database_overrides": of("database_overrides"),
        "warehouse_overrides": of("warehouse_overrides"),
        "tag_references": of("tag_references"),
        "object_listing": of("object_listing"),
        "tag_overrides": of("tag_overrides"),
        "raw_warehouse_tags": of("raw_warehouse_tags"),
        "raw_database_tags": of("raw_database_tags"),
        "connectors": of("connectors"),
        "named_metering": of("named_metering"),
        "metering": of("metering"),
        "purchases": of("purchases"),
        "tracker": of("tracker"),
        "access_map": of("access_map_current"),
        "role_tags": of("role_tags"),
    }


def test_everything_that_is_not_a_history(spark, inputs, inputs_of_all, tmp_path):
    """Twice the run, once the result; every view has a name and can be read."""
    of, _ = inputs
    changes = str(tmp_path / "changes")
    of("connectors").write.parquet(changes)
    settings = loads.default_settings(spark, CTX)

    def run():
        stream = parquet_stream(spark, changes, of("connectors").schema)
        return refresh_all(spark, {}, settings, CTX, str(tmp_path / "out"), prefix="whole_", inputs=inputs_of_all, connector_changes=stream)

    first = {n: df.count() for n, df in run().items()}
    stored = run()
    assert {n: df.count() for n, df in stored.items()} == first
    assert set(first) == {*FULL, "daily_credits", "access_map", "connector_type_history"} and all(first.values())
    for table in FULL:
        assert len(list((tmp_path / "out" / table).iterdir())) == 1  # replaced versions are gone
    made = register_views(spark, {**inputs_of_all, **stored}, of("access_map"), CTX, "whole_ext_")
    histories = set(loads.REPORTS) | {"query_credit", "db_schema_credit", "month_credits"}
    assert set(made) == {f"whole_ext_{n}" for n in REPORT_VIEWS if n not in histories}
    for name in made:
        spark.table(name).write.format("noop").mode("overwrite").save()
    assert spark.table("whole_ext_calendar").count() == 730


def test_organization_comes_from_the_settings(spark, inputs, tmp_path):
    _, sources = inputs
    settings = loads.default_settings(spark, CTX)
    one = {"auto_clustering": sources["auto_clustering"]}
    named = settings.withColumn("var_value", F.when(F.col("var_name") == "ORGANIZATION", "OTHER").otherwise(F.col("var_value")))
    stored = refresh_all(spark, one, named, CTX, str(tmp_path), prefix="org_")
    assert rows(stored["auto_clustering"].select("organization_name").distinct()) == [("OTHER",)]
    without = settings.filter(F.col("var_name") != "ORGANIZATION")
    assert refresh_all(spark, one, without, CTX, str(tmp_path), prefix="absent_") == {}
    assert not spark.catalog.tableExists("absent_auto_clustering")


def test_views_are_registered_anew_after_each_run(spark, inputs, tmp_path):
    """A view of the queries shows what a later load adds."""
    of, sources = inputs
    settings = loads.default_settings(spark, CTX)
    early = {"query_history": sources["query_history"].filter("start_time < TIMESTAMP_NTZ '2024-01-20'")}
    args = (settings, CTX, str(tmp_path), of("access_map"))
    assert refresh_and_register(spark, early, *args, prefix="anew_") == ["ext_query_history", "ext_calendar"]
    before = spark.table("ext_query_history").count()
    refresh_and_register(spark, {"query_history": sources["query_history"]}, *args, prefix="anew_")
    assert spark.table("ext_query_history").count() > before > 0


def test_the_month_report_has_a_start(spark, inputs, tmp_path):
    """Two months that end one month ago: January and December."""
    of, sources = inputs
    monitors = of("warehouses").selectExpr("resource_monitor AS resource_monitor_name", "name AS warehouse_name")
    some = {n: sources[n] for n in ("query_history", "warehouse_credit")}
    settings = loads.default_settings(spark, CTX)
    stored = refresh_all(spark, some, settings, CTX, str(tmp_path), monitors, "month_", report_months=2, report_starts=1)
    assert {r[0] for r in rows(stored["month_credits"], "attribute")} == {"202401_credits", "202312_credits"}


def test_bounds_of_loads_and_of_the_calendar_are_the_callers(spark, inputs, tmp_path):
    of, sources = inputs
    late = CTX.at(CTX.as_of + timedelta(days=800))
    some, settings = {"auto_clustering": sources["auto_clustering"]}, loads.default_settings(spark, late).limit(0)
    settings = settings.unionByName(loads.default_settings(spark, late).filter("var_name = 'ORGANIZATION'"))
    bounded = refresh_all(spark, some, settings, late, str(tmp_path), prefix="bounded_")
    whole = {**loads.REPORTS, "auto_clustering": replace(loads.AUTO_CLUSTERING, first_months=None)}
    free = refresh_all(spark, some, settings, late, str(tmp_path), prefix="free_", reports=whole)
    assert bounded["auto_clustering"].count() == 0 < free["auto_clustering"].count()
    register_views(spark, {}, of("access_map"), CTX, "days_", calendar_days=40)
    assert spark.table("days_calendar").count() == 40


def test_quotes_in_an_account_do_no_harm(spark, inputs):
    of, _ = inputs
    odd = replace(CTX, account="A'C")
    register_functions(spark, of("metering"), loads.default_settings(spark, odd), of("rate_sheet"), of("access_map"), odd)
    assert spark.sql("SELECT * FROM rate_timeseries('compute')").count() == 0
