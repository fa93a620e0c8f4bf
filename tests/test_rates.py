import random
from dataclasses import replace
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from usageledger.operators import rates

SHEET = (
    "account_locator string, region string, usage_type string, rate_date date, organization_name string, contract_number bigint, "
    "account_name string, service_level string, currency string, effective_rate decimal(12,2), service_type string"
)


def line(account, day, rate, contract=1, level="STD", usage="compute", region="R1"):
    rate = None if rate is None else Decimal(rate)
    return (account, region, usage, day, "ORG", contract, "N", level, "USD", rate, "S")


@pytest.fixture()
def sheet(spark):
    return spark.createDataFrame(
        [
            line("ACC_0", date(2024, 2, 1), "2.00"),
            line("ACC_0", date(2024, 2, 4), "3.00", level=None),
            line("ACC_0", date(2024, 2, 4), "5.00", usage="cloud services"),
            line("ACC_1", date(2024, 2, 9), "9.00"),
            line("ACC_1", date(2024, 2, 9), "7.00", usage="cloud services"),
        ],
        SHEET,
    )


def test_gaps_are_filled_forward_until_today(sheet, ctx):
    got = rows(rates.rate_timeseries(sheet, "compute", ctx), "rate_date", "effective_rate", "service_level")
    assert [r[0].day for r in got] == list(range(1, 11))
    assert [str(r[1]) for r in got] == ["2.00"] * 3 + ["3.00"] * 7
    assert {r[2] for r in got} == {"STD"}


def test_all_accounts_have_their_own_series(sheet, ctx):
    got = rows(rates.rate_timeseries_all(sheet, "compute", ctx), "account_locator", "rate_date")
    assert len(got) == 12 and sum(r[0] == "ACC_1" for r in got) == 2


def test_several_contracts_on_a_day_all_stay_and_the_highest_is_carried(spark, ctx):
    sheet = spark.createDataFrame(
        [
            line("ACC_0", date(2024, 2, 7), "1.00", 1),
            line("ACC_0", date(2024, 2, 8), "2.00", 1),
            line("ACC_0", date(2024, 2, 8), None, 2),
            line("ACC_0", date(2024, 2, 8), "4.00", 3),
        ],
        SHEET,
    )
    got = rows(rates.rate_timeseries(sheet, "compute", ctx), "rate_date", "contract_number", "effective_rate")
    day = lambda d: date(2024, 2, d)
    one, two, four = Decimal("1.00"), Decimal("2.00"), Decimal("4.00")
    assert got == [(day(7), 1, one), (day(8), 1, two), (day(8), 2, one), (day(8), 3, four), (day(9), 3, four), (day(10), 3, four)]


def test_only_the_report_service_sees_prices(sheet, ctx):
    assert rates.rate_timeseries(sheet, "compute", replace(ctx, roles=())).count() == 0


def test_callers_without_prices_see_zero_amounts(spark, sheet, ctx):
    facts = spark.createDataFrame([(datetime(2024, 2, 5, 3), Decimal("1.5"))], "start_time timestamp_ntz, credits_used decimal(18,9)")
    for caller, amount, currency in ((ctx, 4.5, "USD"), (replace(ctx, roles=()), 0.0, None)):
        rate = rates.single_rate(sheet, "compute", caller)
        got = rates.convert_credits_to_currency(facts, rate, {"credits_used": "rate"}).first()
        assert (float(got["credits_used_effective_rate"]), got["currency"]) == (amount, currency)


def test_rates_of_other_accounts_do_not_fan_out(spark, sheet, ctx):
    facts = spark.createDataFrame(
        [("ACC_0", "R1", datetime(2024, 2, 9), 1.0), ("ACC_1", "R1", datetime(2024, 2, 9), 1.0), ("ACC_0", "R2", datetime(2024, 2, 9), 1.0)],
        "account_locator string, region string, start_time timestamp_ntz, credits_used double",
    )
    both = rates.compute_and_cloud_rates(sheet, ctx, all_accounts=True)
    got = rates.convert_credits_to_currency(facts, both, {"credits_used": "compute_rate"}, ("account_locator", "region"))
    assert [(r[0], r[1], float(r[4])) for r in rows(got)] == [("ACC_0", "R1", 3.0), ("ACC_0", "R2", 0.0), ("ACC_1", "R1", 9.0)]


def test_two_contracts_in_two_currencies_price_a_row_once(spark, ctx):
    """Compute and cloud prices are of one contract, and metered rows stay as many."""
    d = date(2024, 2, 1)
    lines = [
        line("ACC_0", d, "2.00", 1), line("ACC_0", d, "1.00", 1, usage="cloud services"),
        line("ACC_0", d, "3.00", 2), line("ACC_0", d, "5.00", 2, usage="cloud services"),
        line("ACC_0", date(2024, 2, 3), "9.00", 4), line("ACC_0", d, "8.00", 2, level="ABC"),
    ]
    euro = spark.createDataFrame(lines, SHEET).withColumn("currency", F.when(F.col("contract_number") == 2, "EUR").otherwise("USD"))
    both = rates.compute_and_cloud_rates(euro, ctx)
    assert [(r.rate_date.day, r.currency, str(r.compute_rate), str(r.cloud_rate)) for r in both.orderBy("rate_date").collect()] == [
        (k, "EUR", "3.00", "5.00") for k in range(1, 11)
    ]
    one = {r.rate_date.day: (r.currency, str(r.rate)) for r in rates.single_rate(euro, "compute", ctx).collect()}
    assert one == {k: ("EUR", "3.00") if k < 3 else ("USD", "9.00") for k in range(1, 11)}
    facts = spark.createDataFrame([(datetime(2024, 2, k, 3), 1.0) for k in (1, 2, 5)], "start_time timestamp_ntz, credits_used double")
    got = rates.convert_credits_to_currency(facts, both, {"credits_used": "compute_rate"})
    assert [(float(r["credits_used_effective_rate"]), r["currency"]) for r in got.collect()] == [(3.0, "EUR")] * 3


def test_days_need_both_prices(sheet, ctx):
    days = [r[0].day for r in rows(rates.compute_and_cloud_rates(sheet, ctx), "rate_date")]
    assert days == [4, 5, 6, 7, 8, 9, 10]


def test_prices_as_of_a_day_equal_the_daily_ones(spark, ctx):
    """Random price lists: the search among changes gives what the row of each day gives, for one account and all."""
    rng = random.Random(3)
    first = date(2024, 1, 5)
    lines = []
    for account in ("ACC_0", "ACC_1"):
        for _ in range(40):
            day, rate = first + timedelta(days=rng.randrange(45)), rng.choice([None, *"123456789"])
            contract, usage = rng.choice([None, 1, 2, 3]), rng.choice(["compute", "cloud services", "storage"])
            lines.append(line(account, day, rate, contract, rng.choice(["A", "B", None]), usage, rng.choice(["R1", "R2"])))
    sheet = spark.createDataFrame(lines, SHEET).withColumn("currency", F.when(F.col("contract_number") == 2, "EUR").otherwise("USD"))
    hours = [(a, r, datetime(2024, 1, 1, 5) + timedelta(days=d), 2.0) for a in ("ACC_0", "ACC_1", "ACC_2") for r in ("R1", "R2") for d in range(50)]
    facts = spark.createDataFrame(hours, "account_locator string, region string, start_time timestamp_ntz, credits_used double")
    amounts = {"credits_used": "compute_rate"}
    on = ("account_locator", "region")
    daily = rates.convert_credits_to_currency(facts, rates.compute_and_cloud_rates(sheet, ctx, True), amounts, on)
    for most in (rates.BROADCAST_BYTES, 1):  # broadcast, and joined by a shuffle
        assert rows(rates.price_as_of(facts, sheet, rates.COMPUTE_AND_CLOUD, amounts, ctx, True, max_bytes=most)) == rows(daily)
    own = rates.convert_credits_to_currency(facts, rates.single_rate(sheet, "compute", ctx), {"credits_used": "rate"})
    searched = rates.price_as_of(facts, sheet, {"rate": "compute"}, {"credits_used": "rate"}, ctx)
    assert rows(searched) == rows(own) and searched.filter("currency IS NOT NULL").count() > 10
    none = rates.price_as_of(facts, sheet, {"rate": "compute"}, {"credits_used": "rate"}, replace(ctx, roles=()))
    assert none.filter("currency IS NOT NULL OR credits_used_effective_rate != 0").count() == 0


def test_no_row_per_day_is_made(sheet, ctx):
    wanted = rates.COMPUTE_AND_CLOUD
    plan = rates.price_intervals(sheet, wanted, ctx, True)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange") == 1
    got = rows(rates.price_intervals(sheet, {"rate": "compute"}, ctx), "first_day", "next_day", "rate")
    assert [(a.day, b and b.day, str(r)) for a, b, r in got] == [(1, 4, "2.00"), (4, None, "3.00")]


def test_the_price_list_is_read_once(spark, sheet, ctx, tmp_path):
    sheet.write.parquet(str(tmp_path / "sheet"))
    stored = spark.read.parquet(str(tmp_path / "sheet"))
    plan = rates.rate_timeseries_all(stored, "compute", ctx)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") <= 2


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(
        st.tuples(st.sampled_from(["ACC_0", "ACC_1"]), st.integers(0, 12)),
        st.tuples(st.one_of(st.none(), st.integers(1, 9)), st.one_of(st.none(), st.sampled_from("xy"))),
        min_size=1,
        max_size=8,
    )
)
def test_filling_equals_a_day_by_day_walk(spark, ctx, published):
    first = date(2024, 1, 30)
    data = [line(a, first + timedelta(days=d), None if r is None else str(r), level=s) for (a, d), (r, s) in published.items()]
    want = []
    for account in {a for a, _ in published}:
        rate = level = None
        days = [d for a, d in published if a == account and first + timedelta(days=d) <= ctx.today]
        for d in range(min(days, default=99), (ctx.today - first).days + 1):
            r, s = published.get((account, d), (None, None))
            rate, level = (rate if r is None else Decimal(r)), (level if s is None else s)
            want.append((account, first + timedelta(days=d), rate, level))
    got = rates.densify(spark.createDataFrame(data, SHEET), ctx.today).select("account_locator", "rate_date", "effective_rate", "service_level")
    assert rows(got) == sorted(want, key=lambda t: [(x is None, str(x)) for x in t])
