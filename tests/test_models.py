from datetime import date, datetime, timedelta

import pytest
from conftest import rows

from usageledger.operators import budget, names, reconcile, tags
from usageledger.operators.calendar import dim_date
from usageledger.operators.metering import metering_history
from usageledger.operators.ranking import top_recent
from usageledger.plans import snapshots


def listing(spark, *which):
    return spark.createDataFrame([(n, "o", "c") for n in which], "name string, owner string, comment string")


def test_database_names(spark):
    got = names.parse_database_names(
        listing(spark, "ES_SALES_X", "MY_FIRST_POC_DB", "HR_TOOLS_LAB_DB", "DEV_FIN_CORE_DB", "PROD_CORE_DB", "STAGE_A_B_C_DB", "OTHER", "SYSTEM", "ES_POC_DB")
    )
    assert rows(got, "name", "db_type", "env", "bu", "db_name") == [
        ("DEV_FIN_CORE_DB", "DP", "DEV", "FIN", "CORE"),
        ("ES_POC_DB", "ES", "ES", "POC", "DB"),
        ("ES_SALES_X", "ES", "ES", "SALES", "X"),
        ("HR_TOOLS_LAB_DB", "LAB", "LAB", "HR", "TOOLS"),
        ("MY_FIRST_POC_DB", "POC", "POC", None, "MY FIRST"),
        ("OTHER", "UNKNOWN", None, None, None),
        ("PROD_CORE_DB", "DP", "PROD", "CORE", "CORE"),
        ("STAGE_A_B_C_DB", "DP", "STAGE", "A", "B"),
        ("SYSTEM", "UNKNOWN", "META", "META", "META"),
    ]


def test_warehouse_names(spark):
    got = names.parse_warehouse_names(
        listing(spark, "ES_SALES_X", "MY_FIRST_POC_WH", "HR_TOOLS_LAB_WH", "DEV_FIN_CORE_LOAD_WH", "PROD_CORE_WH", "TEST_A_B_C_D_WH", "UTIL_WH", "DEV_WH", "A_B_C")
    )
    assert rows(got, "name", "wh_type", "env", "bu", "db_name", "purpose") == [
        ("A_B_C", "UNKNOWN", None, None, None, None),
        ("DEV_FIN_CORE_LOAD_WH", "DP", "DEV", "FIN", "CORE", "LOAD"),
        ("DEV_WH", "UTIL", None, None, None, "DEV"),
        ("ES_SALES_X", "ES", "ES", "SALES", "X", "X"),
        ("HR_TOOLS_LAB_WH", "LAB", "LAB", "HR", "TOOLS", "TOOLS"),
        ("MY_FIRST_POC_WH", "POC", "POC", None, "MY FIRST", "MY FIRST"),
        ("PROD_CORE_WH", "DP", "PROD", "CORE", "CORE", "CORE"),
        ("TEST_A_B_C_D_WH", "DP", "TEST", "A", "B", "D"),
        ("UTIL_WH", "UTIL", None, None, None, "UTIL"),
    ]


def test_overrides_win_where_they_are_given(spark):
    calculated = spark.createDataFrame([("a", "x", None), ("b", "y", "z")], "name string, f string, g string")
    override = spark.createDataFrame([("a", None, "G"), ("q", "F", "G")], "name string, f string, g string")
    assert rows(names.override_coalesce(calculated, override, ["f", "g"])) == [("a", "x", "G"), ("b", "y", "z")]


def test_tag_pivot_keeps_values_beside_their_names(spark):
    refs = spark.createDataFrame(
        [
            ("d", "DATABASE", "PURPOSE", None, None),
            ("d", "DATABASE", "ENVIRONMENT", "DEV", None),
            ("d", "WAREHOUSE", "PURPOSE", "p", None),
            ("e", "DATABASE", "OTHER", "x", None),
            ("gone", "DATABASE", "PURPOSE", "x", "2024"),
            ("t", "TABLE", "PURPOSE", "x", None),
        ],
        "object_name string, domain string, tag_name string, tag_value string, object_deleted string",
    )
    pivoted = tags.tag_pivot(refs)
    assert rows(pivoted, "object_name", "object_type", "purpose", "environment") == [
        ("d", "DATABASE", None, "DEV"),
        ("d", "WAREHOUSE", "p", None),
        ("e", "DATABASE", None, None),
    ]
    objects = spark.createDataFrame(
        [("d", "DATABASE", ""), ("n", "DATABASE", ""), ("n", "DATABASE", ""), ("s", "DATABASE", "SHARE"), ("w", "WAREHOUSE", "x"), ("no", "DATABASE", None)],
        "object_name string, object_type string, origin string",
    )
    assert rows(tags.tag_unresolved(objects, pivoted), "object_name", "is_resolved") == [("n", False), ("w", False)]


def test_dropped_tags_do_not_count(spark):
    schema = "object_name string, domain string, tag_database string, tag_schema string, tag_name string, tag_value string, object_deleted string"
    refs = spark.createDataFrame([("d", "DATABASE", "T", "S", "PURPOSE", "x", None), ("d", "DATABASE", "OLD", "S", "ENVIRONMENT", "y", None)], schema)
    existing = spark.createDataFrame([("T", "S", "PURPOSE")], "tag_database string, tag_schema string, tag_name string")
    assert rows(tags.tag_pivot(refs, existing), "purpose", "environment") == [("x", None)]


PURCHASE = "pur_id int, ws_id int, purchased_credits bigint, purchased_date date, renewal_date date"


def test_budget_dates_drift_to_the_shortest_month(spark):
    p = spark.createDataFrame([(1, 1, 100, date(2024, 1, 31), date(2024, 5, 31))], PURCHASE)
    t = spark.createDataFrame([(1,)], "ws_id int")
    got = rows(budget.workspace_monthly_budget(p, t), "active_date", "monthly_credit_budget")
    # A last date of 29 April lies before 30 April, so one more month follows.
    assert [r[0] for r in got] == [date(2024, 1, 31), date(2024, 2, 29), date(2024, 3, 29), date(2024, 4, 29), date(2024, 5, 29)]
    assert {r[1] for r in got} == {20}


def test_purchase_and_renewal_in_one_month_has_no_budget_number(spark):
    p = spark.createDataFrame([(1, 1, 100, date(2024, 1, 5), date(2024, 1, 20)), (2, 9, 1, date(2024, 1, 5), date(2024, 1, 20))], PURCHASE)
    t = spark.createDataFrame([(1,)], "ws_id int")
    assert rows(budget.workspace_monthly_budget(p, t)) == [(1, date(2024, 1, 5), 1, None)]


def test_purchases_of_one_workspace_stay_apart(spark):
    p = spark.createDataFrame([(1, 1, 120, date(2024, 1, 1), date(2024, 12, 31)), (2, 1, 24, date(2024, 1, 1), date(2024, 12, 31))], PURCHASE)
    t = spark.createDataFrame([(1,)], "ws_id int")
    got = budget.workspace_monthly_budget(p, t).groupBy("pur_id", "monthly_credit_budget").count()
    assert rows(got) == [(1, 10, 12), (2, 2, 12)]


def test_seed_is_idempotent(spark):
    existing = spark.createDataFrame([("ES", "old"), ("X", "own")], "workspace_type string, workspace_type_desc string")
    once = budget.workspace_types_seed(existing)
    assert rows(budget.workspace_types_seed(once)) == rows(once) and once.count() == 5


CSV = "account string, role string, warehouse string, database string"


def test_diff_matches_missing_key_parts(spark):
    desired = spark.createDataFrame([(None, "r", "w", "d"), ("a", None, "w2", "d"), ("new", None, "w", "d"), ("same", None, None, "d")], CSV)
    current = spark.createDataFrame([(None, "r", "w", "d"), ("a", None, "w", None), ("old", None, "w", "d"), ("same", None, None, "d")], CSV)
    changes = reconcile.access_map_reconcile(desired, current)
    assert rows(changes, "change_type", "account", "warehouse", "current_warehouse") == [
        ("delete", "old", None, "w"),
        ("insert", "new", "w", None),
        ("update", "a", "w2", "w"),
    ]
    assert rows(reconcile.apply_changes(current, changes)) == rows(desired)


def test_a_repeated_key_is_refused(spark):
    desired = spark.createDataFrame([(None, "r", "w", "d"), (None, "r", "x", "d")], CSV)
    with pytest.raises(reconcile.DuplicateKeys):
        reconcile.access_map_reconcile(desired, desired)


def test_patterns_from_grants(spark):
    grants = spark.createDataFrame(
        [("R1", "DATABASE", "B"), ("R1", "DATABASE", "A"), ("R1", "DATABASE", "A"), ("R1", "WAREHOUSE", "W"), ("R1", "TABLE", "T"), ("R2", "DATABASE", "D"), ("SYSADMIN", "DATABASE", "X"), ("R3", "DATABASE", "X")],
        "grantee_name string, granted_on string, name string",
    )
    role_tags = spark.createDataFrame(
        [("r1", "ROLE", '{"workspace_name":"w"}'), ("R2", "ROLE", '{"workspace_name":"w"}'), ("sysadmin", "ROLE", '{"workspace_name":"w"}'), ("r3", "ROLE", "{}")],
        "id string, type string, tags string",
    )
    derived = reconcile.grants_to_patterns(grants, role_tags)
    assert rows(derived) == [(None, "R1", "(W)", "(A)|(B)"), (None, "R2", None, "(D)")]
    current = spark.createDataFrame([(None, "R2", None, "(D)"), ("u", None, "w", "d")], CSV)
    assert rows(reconcile.access_map_refresh(current, derived)) == [("u", None, "w", "d"), (None, "R1", "(W)", "(A)|(B)"), (None, "R2", None, "(D)")]


def test_calendar(spark):
    cal = dim_date(spark, date(2024, 3, 3), 730)
    assert cal.count() == 730
    assert tuple(cal.orderBy("date", ascending=False).first()) == (date(2024, 3, 3), 2024, 1, 3, "Mar", 9, 3, "Sun", 0, 63)


def test_metering_history_bounds_whole_days(spark):
    h = datetime
    df = spark.createDataFrame(
        [(1, "DEMO", "W", h(2024, 1, 1, 0), h(2024, 1, 1, 1)), (2, "DEMO_X", "W", h(2024, 1, 1, 0), h(2024, 1, 1, 1)), (3, "DEMO", "P", h(2024, 1, 1, 0), h(2024, 1, 1, 1)),
         (4, "DEMO", "W", h(2024, 1, 2, 23), h(2024, 1, 3, 0)), (5, "DEMO", "W", h(2024, 1, 2, 22), h(2024, 1, 2, 23))],
        "entity_id int, name string, service_type string, start_time timestamp_ntz, end_time timestamp_ntz",
    ).selectExpr("*", "1.0 credits_used", "1.0 credits_used_compute", "1.0 credits_used_cloud_services")
    assert rows(metering_history(df, "DEMO", ["W"], date(2024, 1, 1), date(2024, 1, 2)), "entity_id") == [(1,), (5,)]


def test_names_in_derived_patterns_match_themselves_alone(spark):
    from usageledger.operators.access import scope_rows_single

    grants = spark.createDataFrame([("R1", "WAREHOUSE", "WH$1"), ("R1", "WAREHOUSE", "A.B"), ("R1", "DATABASE", r"D\(x)[1]{2}|^?*+")], "grantee_name string, granted_on string, name string")
    role_tags = spark.createDataFrame([("r1", "ROLE", '{"workspace_name":"w"}')], "id string, type string, tags string")
    derived = reconcile.grants_to_patterns(grants, role_tags).selectExpr("warehouse AS warehouse_pattern", "database AS database_pattern")
    data = spark.createDataFrame([("WH$1", r"D\(x)[1]{2}|^?*+"), ("A.B", "D"), ("AxB", "D"), ("WH", "D")], "warehouse_name string, database_name string")
    assert rows(scope_rows_single(data, derived, "warehouse_name", "warehouse_pattern"), "warehouse_name") == [("A.B",), ("WH$1",)]
    assert scope_rows_single(data, derived, "database_name").count() == 1


def test_newest_rows_break_ties_by_id(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t, "a"), (2, t, "b"), (3, t, "c"), (3, t, "c"), (0, datetime(2024, 1, 2), "z"), (9, None, "n")], "id int, t timestamp_ntz, v string")
    assert rows(top_recent(df, "t", "id", 2), "id") == [(0,), (3,), (3,)]
    assert top_recent(df, "t", "id", 100).count() == 6
    assert rows(top_recent(df, "t", "id", 6), "id")[-1] == (9,)
    more = df.union(spark.createDataFrame([(8, None, "m")], df.schema))
    assert rows(top_recent(more, "t", "id", 6), "id") == [(0,), (1,), (2,), (3,), (3,), (9,)]
    assert rows(top_recent(df, "t", "id", 1), "id") == [(0,)]
    assert rows(top_recent(df, "t", "id", 4), "id") == [(0,), (2,), (3,), (3,)]


def test_newest_rows_equal_a_sort(spark):
    h = datetime(2024, 1, 1)
    data = [(i, h + timedelta(microseconds=[0, 1, 10**6, 3600 * 10**6][i % 4] + (i % 3)), "v") for i in range(60)]
    df = spark.createDataFrame(data, "id int, t timestamp_ntz, v string")
    order = sorted(data, key=lambda r: (r[1], r[0]), reverse=True)
    for n in (1, 7, 16, 31, 59, 60):
        assert {r[0] for r in rows(top_recent(df, "t", "id", n), "id")} == {r[0] for r in order[:n]}


def test_listings_and_monitors(spark):
    one = spark.createDataFrame([("n", datetime(2024, 1, 1))], "name string, created_on timestamp_ntz")
    all_kinds = snapshots.active_resources({k: one for k in snapshots.RESOURCE_KINDS})
    assert rows(all_kinds, "resource_type") == [("DATABASE",), ("RM",), ("ROLE",), ("USER",), ("WAREHOUSE",)]
    assert snapshots.active_of_kind(all_kinds, "RM").count() == 1
    with pytest.raises(ValueError):
        snapshots.active_resources({"TABLE": one})
