"""Views that are answered when they are read, beside the operators."""

from dataclasses import replace
from datetime import timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from usageledger import queries
from usageledger.operators.access import caller_patterns
from usageledger.plans import live
from usageledger.plans.loads import default_settings, session_logins
from usageledger.plans.publish import publish_swap
from usageledger.plans.refresh import refresh_all, stored_name
from usageledger.plans.sql import REPORT_VIEWS, register_views
from usageledger.sources.logical import logical

CTX = queries.EVENTS


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    from conftest import SMALL

    from usageledger.operators.metering import metering_history

    of = lambda n: logical(spark, SMALL, n)
    where = str(tmp_path_factory.mktemp("live"))
    year = CTX.today - timedelta(days=365)
    sources = {
        "warehouse_credit": metering_history(of("metering"), ".+", ["WAREHOUSE_METERING"], year, CTX.today),
        "org_rate_sheet": of("rate_sheet"),
        "org_metering": of("org_metering"),
        "query_history": of("query_history"),
        "auto_clustering": of("table_service"),
        "search_optimization": of("table_service").drop("num_bytes"),
        "sessions": session_logins(of("sessions"), of("logins")),
    }
    inputs = {
        "role_grants": of("role_grants"), "user_grants": of("user_grants"), "table_storage_metrics": of("table_storage"), "connectors": of("connectors"),
        "databases": of("databases"), "warehouses": of("warehouses"), "roles": of("roles"), "users": of("users"), "monitors": of("monitors"),
    }
    monitors = of("warehouses").selectExpr("resource_monitor AS resource_monitor_name", "name AS warehouse_name")
    tables = refresh_all(spark, sources, default_settings(spark, CTX), CTX, where, monitors, "live_", inputs)
    publish_swap(of("access_map"), "live_access_map", where)
    return tables, where, of


def test_they_show_what_the_operators_show(spark, stored):
    tables, _, of = stored
    names = {n: stored_name(n, "live_") for n in tables}
    made = live.register_live_views(spark, names, "live_access_map", CTX, "now_")
    assert set(made) >= {f"now_{n}" for n in tables if n in REPORT_VIEWS} and "now_newest_queries" in made
    for caller in (CTX, queries.OWN_ROWS, replace(CTX, user="nobody", roles=())):
        live.set_caller(spark, caller)
        register_views(spark, tables, of("access_map"), caller, "then_")
        for name in made:
            plain = name.replace("now_", "then_").replace("newest_queries", "query_history")
            if not spark.catalog.tableExists(plain):
                continue
            got, want = spark.table(name), spark.table(plain)
            assert set(got.columns) == set(want.columns), name
            numbers = [F.round(F.col(c).cast("double"), 6).alias(c) if t.startswith(("decimal", "double")) else F.col(c) for c, t in sorted(want.dtypes)]
            assert rows(got.select(*numbers)) == rows(want.select(*numbers)), (name, caller.user)


def test_one_registration_follows_the_map_the_caller_and_the_tables(spark, stored):
    _, where, of = stored
    live.register_live_views(spark, {"query_history": "live_query_history", "query_credit": "live_query_credit"}, "live_access_map", CTX, "one_")
    seen = lambda: spark.sql("SELECT count(*) FROM one_query_history").first()[0]
    before = seen()
    publish_swap(of("access_map").withColumn("database", F.lit("none")).withColumn("warehouse", F.lit("WH_3")), "live_access_map", where)
    less = seen()
    expected = spark.table("live_query_history").filter("warehouse_name = 'WH_3'").count()
    assert 0 < less == expected < before
    live.set_caller(spark, replace(CTX, user="nobody", roles=()))
    assert seen() == 0
    publish_swap(of("access_map"), "live_access_map", where)
    live.set_caller(spark, CTX)
    assert seen() == before
    credits = spark.sql("SELECT count(*) FROM one_query_credit").first()[0]
    publish_swap(spark.table("live_query_credit").limit(0), "live_query_credit", where)
    assert credits > 0 and spark.sql("SELECT count(*) FROM one_query_credit").first()[0] == 0


def test_patterns_meet_distinct_names_only(spark, stored):
    live.register_live_views(spark, {"query_history": "live_query_history"}, "live_access_map", CTX, "plan_")
    plan = spark.table("plan_query_history")._jdf.queryExecution().optimizedPlan().toString()
    assert "exists(scalar-subquery" in plan and plan.count("Join LeftSemi") == 1
    assert plan[plan.index("Join LeftSemi") :].count("Aggregate [warehouse_name") == 1  # tested after the names are made distinct
    running = spark.table("plan_query_history")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in running and "Cartesian" not in running


def test_quotes_in_a_caller(spark, stored):
    _, _, of = stored
    odd = replace(CTX, user="a'b\\c", roles=("r'1",))
    live.register_live_views(spark, {"query_history": "live_query_history"}, "live_access_map", odd, "odd_")
    assert spark.table("odd_query_history").count() == 0
    assert spark.sql("SELECT session.report_user, session.report_roles").first() == ("a'b\\c", ["r'1"])
    assert caller_patterns(of("access_map"), odd).literals == frozenset()
