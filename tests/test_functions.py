from datetime import date, datetime

from conftest import rows
from pyspark.sql import functions as F

from usageledger.functions import labels
from usageledger.functions.keys import business_key, day, moment, number, text
from usageledger.functions.patterns import full_match, full_match_column
from usageledger.functions.times import date_range, derive_time_columns, elapsed_seconds, months_between_starts
from usageledger.functions.units import bytes_to_gib


def test_key_has_twenty_bytes_and_no_missing_value(spark):
    df = spark.createDataFrame(
        [("a", 1, datetime(2024, 1, 1, 0, 0, 0, 123456)), (None, None, None)], "t string, n int, m timestamp_ntz"
    )
    keys = df.select(business_key([text("t"), number("n"), moment("m"), day("m")]).alias("k")).collect()
    assert [len(k["k"]) for k in keys] == [20, 20]


def test_key_renders_times_to_milliseconds(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 0, 0, 123001),), (datetime(2024, 1, 1, 0, 0, 0, 123999),)], "m timestamp_ntz"
    )
    assert df.select(business_key([moment("m")])).distinct().count() == 1


def test_key_sentinels_are_plain_text(spark):
    df = spark.createDataFrame([(None, None), ("~", -9)], "t string, n int")
    assert df.select(business_key([text("t"), number("n")])).distinct().count() == 1


def test_hours_and_seconds_count_boundaries(spark):
    df = spark.createDataFrame(
        [
            (datetime(2024, 1, 1, 10, 59, 59, 900000), datetime(2024, 1, 1, 11, 0, 0, 100000)),
            (datetime(2024, 1, 1, 10, 0), datetime(2024, 1, 1, 10, 59, 59)),
            (datetime(2024, 1, 1, 23, 30), datetime(2024, 1, 2, 1, 15)),
        ],
        "start_time timestamp_ntz, end_time timestamp_ntz",
    )
    got = elapsed_seconds(derive_time_columns(df)).select("operation_hours", "elapsed_time_in_sec").collect()
    assert [tuple(r) for r in got] == [(1, 1), (0, 3599), (2, 6300)]


def test_months_count_boundaries(spark):
    df = spark.createDataFrame([(date(2024, 1, 31), date(2024, 2, 1)), (date(2024, 1, 1), date(2024, 1, 31))], "a date, b date")
    assert [r[0] for r in df.select(months_between_starts(F.col("a"), F.col("b"))).collect()] == [1, 0]


def test_date_range_includes_both_ends_and_skips_reversed(spark):
    df = spark.createDataFrame([(1, date(2024, 2, 28), date(2024, 3, 1)), (2, date(2024, 2, 2), date(2024, 2, 1))], "i int, a date, b date")
    got = rows(date_range(df, "a", "b"), "i", "day")
    assert got == [(1, date(2024, 2, 28)), (1, date(2024, 2, 29)), (1, date(2024, 3, 1))]


def test_patterns_cover_the_whole_value(spark):
    df = spark.createDataFrame([("DEMO",), ("DEMO_X",), ("X_DEMO",), ("DEMO\n",), ("",), (None,)], "name string")
    assert rows(df.filter(full_match(F.col("name"), "DEMO"))) == [("DEMO",)]
    assert rows(df.filter(full_match(F.col("name"), "DEMO|X.*"))) == [("DEMO",), ("X_DEMO",)]
    assert df.filter(full_match(F.col("name"), ".+")).count() == 3
    by_column = df.withColumn("p", F.lit("DEMO|X.*"))
    assert rows(by_column.filter(full_match_column(F.col("name"), F.col("p"))), "name") == [("DEMO",), ("X_DEMO",)]


def test_the_two_label_maps_differ_in_the_adjustment(spark):
    names = ["overage-compute", "overage-adj for incl cloud services", "adj for incl cloud services", "other", None]
    df = spark.createDataFrame([(n,) for n in names], "u string")
    rate = [r[0] for r in df.select(labels.normalize_usage_type(F.col("u"), labels.RATE_LABELS)).collect()]
    spend = [r[0] for r in df.select(labels.normalize_usage_type(F.col("u"), labels.SPEND_LABELS)).collect()]
    assert rate == ["compute", "adj for incl cloud services", "adj for incl cloud services", "other", None]
    assert spend == ["compute", "cloud services", "cloud services", "other", None]


def test_gib_modes(spark):
    df = spark.createDataFrame([(int(1.23456 * 1024**3),)], "b bigint")
    b = F.col("b")
    got = df.select(bytes_to_gib(b, 3, "round"), bytes_to_gib(b, 0, "floor"), bytes_to_gib(b, 3, "floor")).first()
    assert tuple(got) == (1.235, 1.0, 1.234)
