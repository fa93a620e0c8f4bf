from dataclasses import replace
from datetime import date, datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from usageledger.operators import settings, watermark
from usageledger.operators.merge import latest_per_key, merge_insert_only, merge_upsert
from usageledger.operators.retention import retention_delete


def test_insert_only_keeps_repeats_of_the_batch(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    batch = spark.createDataFrame([(1, "new"), (2, "x"), (2, "x")], "k int, v string")
    assert rows(merge_insert_only(batch, target, ["k"])) == [(1, "old"), (2, "x"), (2, "x")]


def test_insert_only_with_a_restricted_target(spark):
    target = spark.createDataFrame([(1, 10), (2, 20)], "k int, t int")
    batch = spark.createDataFrame([(2, 20), (3, 20)], "k int, t int")
    assert rows(merge_insert_only(batch, target, ["k"], F.col("t") >= 20)) == [(1, 10), (2, 20), (3, 20)]


def test_upsert_updates_listed_columns_only(spark):
    schema = "k int, state string, made string, done int"
    target = spark.createDataFrame([(1, "run", "a", None), (2, "run", "b", None)], schema)
    batch = spark.createDataFrame([(2, "ok", "IGNORED", 5), (3, "run", "c", None)], schema)
    got = rows(merge_upsert(batch, target, ["k"], ["state", "done"]))
    assert got == [(1, "run", "a", None), (2, "ok", "b", 5), (3, "run", "c", None)]


def test_upsert_can_set_missing_values(spark):
    target = spark.createDataFrame([(1, "e")], "k int, error string")
    batch = spark.createDataFrame([(1, None)], "k int, error string")
    assert rows(merge_upsert(batch, target, ["k"], ["error"])) == [(1, None)]


def test_upsert_takes_the_newest_of_several(spark):
    target = spark.createDataFrame([(1, "run", None)], "k int, state string, done int")
    batch = spark.createDataFrame([(1, "run", None), (1, "ok", 9), (1, "bad", 5)], "k int, state string, done int")
    assert rows(merge_upsert(batch, target, ["k"], ["state", "done"], ["done"])) == [(1, "ok", 9)]
    assert rows(latest_per_key(batch, ["k"], ["done"])) == [(1, "ok", 9)]


def test_upsert_passes_untouched_history_through(spark):
    target = spark.createDataFrame([(1, 1, "a"), (2, 9, "b"), (3, None, "c")], "k int, t int, v string")
    batch = spark.createDataFrame([(2, 9, "B")], "k int, t int, v string")
    got = rows(merge_upsert(batch, target, ["k"], ["v"], can_match=F.col("t") >= 5))
    assert got == [(1, 1, "a"), (2, 9, "B"), (3, None, "c")]


def test_retention(spark, ctx):
    edge = datetime(2024, 1, 11)
    df = spark.createDataFrame(
        [(1, "ACC_0", edge), (2, "ACC_0", edge + timedelta(seconds=1)), (3, "ACC_1", edge), (4, "ACC_0", None), (5, None, edge)],
        "id int, account_locator string, t timestamp_ntz",
    )
    assert rows(retention_delete(df, "t", 30, ctx), "id") == [(2,), (3,), (4,), (5,)]
    assert retention_delete(df, "t", None, ctx).count() == 5
    assert rows(retention_delete(df, "t", 30, ctx, account=None), "id") == [(2,), (4,)]


def test_watermark_scans(spark, ctx):
    days = [datetime(2023, 2, 9, 23), datetime(2023, 2, 10), datetime(2024, 1, 30), datetime(2024, 2, 1), datetime(2024, 3, 1)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id int, t timestamp_ntz")
    ids = lambda d: [r[0] for r in rows(d, "id")]
    assert ids(watermark.high_watermark_scan(df, "t", None, ctx, 12)) == [1, 2, 3, 4]
    assert ids(watermark.high_watermark_scan(df, "t", days[2], ctx)) == [2, 3, 4]
    assert ids(watermark.high_watermark_scan_min_default(df, "t", None)) == [0, 1, 2, 3, 4]
    assert ids(watermark.late_lookback_scan(df, "t", datetime(2024, 2, 1, 11), ctx, timedelta(hours=36))) == [2 + 1, 4]
    assert ids(watermark.late_lookback_scan(df, "t", datetime(2024, 1, 31, 12), ctx, timedelta(hours=36))) == [2, 3, 4]
    assert ids(watermark.bounded_window_scan(df, "t", None, ctx, 30, 12)) == [2, 3]


def test_the_watermark_reaches_the_scan(spark, ctx, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, datetime(2024, 2, 1))], "id int, t timestamp_ntz").write.parquet(path)
    df = watermark.high_watermark_scan(spark.read.parquet(path), "t", datetime(2024, 1, 1), ctx)
    assert "GreaterThanOrEqual(t," in df._jdf.queryExecution().executedPlan().toString()


def test_year_before_a_leap_day(ctx):
    assert watermark.months_before(ctx.at(datetime(2024, 2, 29, 5)), 12) == datetime(2023, 2, 28)
    assert watermark.months_before(ctx, 12) == datetime(2023, 2, 10)


def test_settings(spark, ctx):
    s = spark.createDataFrame(
        [("ACC_0", "R1", "DAYS_TO_RETAIN", "30", "q", ""), ("ACC_0", "R1", "ORGANIZATION", "BIG", "GLOBAL", ""), ("ACC_1", "R1", "DAYS_TO_RETAIN", "9", "q", "")],
        "account_locator string, region_name string, var_name string, var_value string, var_usage string, var_description string",
    )
    assert settings.retention_days(s, "q", ctx) == 30
    assert settings.retention_days(s, "missing", ctx) is None
    assert rows(settings.config_lookup(s, "nothing", "q", "ACC_0")) == [(None, None)]
    data = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(settings.attach_org_context(data, s, ctx)) == [(1, "ACC_0", "R1", "BIG"), (2, "ACC_0", "R1", "BIG")]
    assert settings.attach_org_context(data, s, replace(ctx, account="ACC_1")).count() == 0


def test_source_day_dates(spark, ctx):
    df = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 2),)], "d date")
    assert watermark.high_watermark_scan_min_default(df, "d", date(2024, 1, 2)).count() == 1
