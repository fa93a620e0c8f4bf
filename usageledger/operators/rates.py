"""Daily price series from sparse price lists, and credits in currency."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usageledger.context import ReportContext
from usageledger.functions.search import last_place
from usageledger.operators.access import role_gate
from usageledger.operators.skew import BROADCAST_BYTES, fits_broadcast, skew_safe_join

# The usage types warehouse credits are priced with.
COMPUTE, CLOUD = "compute", "cloud services"
#: The two prices of a metered hour, by the columns they come in.
COMPUTE_AND_CLOUD = {"compute_rate": COMPUTE, "cloud_rate": CLOUD}
SERIES = ("account_locator", "region", "usage_type")
FILLED = (
    "organization_name",
    "contract_number",
    "account_name",
    "service_level",
    "currency",
    "effective_rate",
    "service_type",
)


def densify(
    sheet: DataFrame,
    until: date,
    series: Sequence[str] = SERIES,
    day: str = "rate_date",
    filled: Sequence[str] = FILLED,
    order: str = "contract_number",
) -> DataFrame:
    """One row per series and day from its first day to ``until``, gaps filled forward.

    Days with published rows keep all of them; a missing value takes the last one
    known before that day. Other days repeat the last known values. The list is
    read and dealt out once.

    The window runs over one carried row per series and published day, so a
    window group holds at most one row per calendar day however many contracts a
    day has. Gaps are then filled by expanding each published day up to the next.
    """
    series = list(series)
    sheet = sheet.filter(F.col(day) <= F.lit(until))
    # The last known value of each column on each published day, beside the day's rows.
    last_known = [
        F.expr(f"max(CASE WHEN {c} IS NOT NULL THEN struct({order} AS o, {c} AS v) END) AS _{c}") for c in filled
    ]
    published = sheet.groupBy(*series, day).agg(*last_known, F.collect_list(F.struct(*filled)).alias("_rows"))
    window = f"PARTITION BY {', '.join(series)} ORDER BY {day}"
    carried = published.selectExpr(
        *series,
        day,
        "_rows",
        f"lead({day}) OVER ({window}) AS _next",
        *[f"last(_{c}, true) OVER ({window} ROWS UNBOUNDED PRECEDING).v AS {c}" for c in filled],
        *[
            f"last(_{c}, true) OVER ({window} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING).v AS _was_{c}"
            for c in filled
        ],
    )
    gap_start = F.date_add(F.col(day), 1)
    gap_end = F.coalesce(F.date_sub(F.col("_next"), 1), F.lit(until))
    # Each published day gives its own rows, completed, and its last known values on the days up to the next.
    own = F.transform(
        "_rows", lambda r: F.struct(F.col(day).alias(day), *[F.coalesce(r[c], F.col(f"_was_{c}")).alias(c) for c in filled])
    )
    days = F.when(gap_start <= gap_end, F.sequence(gap_start, gap_end)).otherwise(F.array().cast("array<date>"))
    after = F.transform(days, lambda d: F.struct(d.alias(day), *[F.col(c) for c in filled]))
    return carried.select(*series, F.explode(F.concat(own, after)).alias("_r")).select(*series, f"_r.{day}", *[f"_r.{c}" for c in filled])


RATE = ("usage_type", "rate_date", "contract_number", "service_level", "currency", "effective_rate", "service_type")


def visible_prices(
    sheet: DataFrame, usage_types: Sequence[str], ctx: ReportContext, all_accounts: bool = False
) -> DataFrame:
    """Published prices of the usage types, for the caller's account or all, role gated."""
    chosen = role_gate(sheet, ctx).filter(F.col("usage_type").isin(list(usage_types)))
    if all_accounts:
        return chosen
    return chosen.filter((F.col("account_locator") == ctx.account) & (F.col("region") == ctx.region))


def rate_timeseries(sheet: DataFrame, usage_type: str, ctx: ReportContext) -> DataFrame:
    """Daily prices of one usage type for the caller's account."""
    return densify(visible_prices(sheet, [usage_type], ctx), ctx.today).select(*RATE)


def rate_timeseries_all(sheet: DataFrame, usage_type: str, ctx: ReportContext) -> DataFrame:
    """Daily prices of one usage type for every account and region."""
    series = densify(visible_prices(sheet, [usage_type], ctx, all_accounts=True), ctx.today)
    return series.select("account_locator", "region", *RATE)


def convert_credits_to_currency(
    df: DataFrame,
    rates: DataFrame,
    amounts: dict[str, str],
    on: Sequence[str] = (),
    time: str = "start_time",
    small: bool | None = None,
) -> DataFrame:
    """Add ``<credits>_effective_rate`` columns and the currency.

    ``rates`` has rate_date, the ``on`` columns, currency and the rate columns, one
    row a day and ``on``, so every row of df stays one row;
    ``amounts`` maps a credit column to the rate column it is priced with. Days
    without a price give 0 and no currency. ``small`` tells whether the rates were
    already found to fit a broadcast.
    """
    on = list(on)
    priced = skew_safe_join(
        df.withColumn("rate_date", F.to_date(time)), rates, ["rate_date", *on], "left", small=small
    )
    money = {
        f"{credits}_effective_rate": F.coalesce(F.col(credits) * F.col(rate), F.lit(0)) for credits, rate in amounts.items()
    }
    return priced.withColumns(money).select(*df.columns, *money, "currency")


def daily_prices(
    sheet: DataFrame, wanted: dict[str, str], ctx: ReportContext, all_accounts: bool = False
) -> DataFrame:
    """One row per account, region and day with all wanted prices: column name by usage type.

    Prices of a day go together: they are of one contract and in one currency.
    Each contract's prices are carried over its gaps; of the contracts that have
    all wanted prices on a day the highest counts (a missing number is the
    lowest, then the currency decides). Of several service levels on a day the
    last in order counts. The list is dealt out once, by account and region, and
    all steps keep that.
    """
    series = ["account_locator", "region", "currency", "contract_number"]
    chosen = visible_prices(sheet, list(wanted.values()), ctx, all_accounts).filter(F.col("rate_date") <= F.lit(ctx.today))
    chosen = chosen.repartition("account_locator", "region")
    priced = F.col("effective_rate").isNotNull()
    level = F.struct("service_level", "effective_rate")
    on_day = chosen.groupBy(*series, "rate_date").agg(
        *[F.max(F.when(priced & (F.col("usage_type") == t), level))["effective_rate"].alias(c) for c, t in wanted.items()]
    )
    window = f"PARTITION BY {', '.join(series)} ORDER BY rate_date"
    carried = on_day.selectExpr(
        *series,
        "rate_date",
        f"lead(rate_date) OVER ({window}) AS _next",
        *[f"last({c}, true) OVER ({window} ROWS UNBOUNDED PRECEDING) AS {c}" for c in wanted],
    )
    until = F.coalesce(F.date_sub("_next", 1), F.lit(ctx.today))
    daily = carried.withColumn("rate_date", F.explode(F.sequence("rate_date", until)))
    for c in wanted:
        daily = daily.filter(F.col(c).isNotNull())
    best = F.max(F.struct("contract_number", "currency", *wanted)).alias("best")
    picked = daily.groupBy("account_locator", "region", "rate_date").agg(best)
    return picked.select("account_locator", "region", "rate_date", "best.currency", *[f"best.{c}" for c in wanted])


def intervals_sql(wanted: dict[str, str], sheet: str, until: str, visible: str = "true") -> str:
    """SQL of (account_locator, region, first_day, next_day, currency, a column per wanted price) over a price list.

    One row per change of the prices that count on a day (see daily_prices): none per
    day. They hold from first_day up to, not on, next_day; the last ones from then on.
    A contract's prices never end, so from its first day with all wanted prices on, a
    higher contract counts instead of the lower ones. ``sheet``, ``until`` and
    ``visible`` are SQL: the price list, the last day to read, and whose rows count.
    """
    types = ", ".join("'" + t.replace("'", "\\'") + "'" for t in wanted.values())
    quoted = {c: "'" + t.replace("'", "\\'") + "'" for c, t in wanted.items()}
    series = "account_locator, region, currency, contract_number"
    on_day = ", ".join(
        f"max(CASE WHEN effective_rate IS NOT NULL AND usage_type = {t} THEN struct(service_level, effective_rate) END).effective_rate AS {c}"
        for c, t in quoted.items()
    )
    carried = ", ".join(f"last({c}, true) OVER (PARTITION BY {series} ORDER BY rate_date ROWS UNBOUNDED PRECEDING) AS {c}" for c in wanted)
    return f"""
    WITH on_day AS (
      SELECT {series}, rate_date, {on_day} FROM {sheet}
      WHERE usage_type IN ({types}) AND rate_date <= {until} AND {visible} GROUP BY {series}, rate_date),
    carried AS (SELECT {series}, rate_date, {carried} FROM on_day),
    counting AS (
      SELECT *, max(struct(contract_number, currency)) OVER (PARTITION BY account_locator, region ORDER BY rate_date) AS highest
      FROM carried WHERE {' AND '.join(f'{c} IS NOT NULL' for c in wanted)})
    SELECT account_locator, region, rate_date AS first_day,
      lead(rate_date) OVER (PARTITION BY account_locator, region ORDER BY rate_date) AS next_day, currency, {', '.join(wanted)}
    FROM counting WHERE struct(contract_number, currency) <=> highest"""


def price_intervals(sheet: DataFrame, wanted: dict[str, str], ctx: ReportContext, all_accounts: bool = False) -> DataFrame:
    """The intervals of ``intervals_sql`` that a caller may see, for their account or all."""
    chosen = visible_prices(sheet, list(wanted.values()), ctx, all_accounts).repartition("account_locator", "region")
    return sheet.sparkSession.sql(intervals_sql(wanted, "{chosen}", f"DATE '{ctx.today}'"), chosen=chosen)


def price_books(intervals: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """(account_locator, region, prices): an account's intervals in one row, in order."""
    entry = F.struct("first_day", "currency", *wanted)
    return intervals.groupBy("account_locator", "region").agg(F.sort_array(F.collect_list(entry)).alias("prices"))


#: Prices of one account that the search can tell apart.
LONGEST_BOOK = (1 << 15) - 1


def price_on(prices: Column, day: Column) -> Column:
    """The last entry of a book that begins on or before a day, found by halving; NULL before the first."""
    n = F.coalesce(F.size(prices), F.lit(0))
    place = last_place(LONGEST_BOOK, lambda k: (k <= n) & (F.get(prices, k - 1)["first_day"] <= day))
    return F.when(place > 0, F.get(prices, place - 1))


def price_as_of(
    df: DataFrame,
    sheet: DataFrame,
    wanted: dict[str, str],
    amounts: dict[str, str],
    ctx: ReportContext,
    all_accounts: bool = False,
    time: str = "start_time",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``<credits>_effective_rate`` columns and the currency, as convert_credits_to_currency does with daily prices.

    Each row looks its day up in the book of its account, a row of price changes in
    order, so no row per account and day is made and a metered row stays one row. The
    caller's own book is a scalar subquery: no join. Books of all accounts are joined by
    account and region, and broadcast only if the counted price list is small. Days
    after today, and before the first price, give 0 and no currency.
    """
    books = price_books(price_intervals(sheet, wanted, ctx, all_accounts), list(wanted))
    if all_accounts:
        listed = visible_prices(sheet, list(wanted.values()), ctx, True).select("currency", "rate_date", "effective_rate")
        priced = skew_safe_join(df, books, ["account_locator", "region"], "left", small=fits_broadcast(listed, max_bytes), max_bytes=max_bytes)
    else:
        priced = df.withColumn("prices", books.select("prices").scalar())
    day = F.to_date(time)
    priced = priced.withColumn("_price", F.when(day <= F.lit(ctx.today), price_on(F.col("prices"), day)))
    money = {
        f"{credits}_effective_rate": F.coalesce(F.col(credits) * F.col("_price")[rate], F.lit(0)) for credits, rate in amounts.items()
    }
    return priced.withColumns(money).select(*df.columns, *money, F.col("_price")["currency"].alias("currency"))


def _for_caller(prices: DataFrame, all_accounts: bool) -> DataFrame:
    return prices if all_accounts else prices.drop("account_locator", "region")


def single_rate(sheet: DataFrame, usage_type: str, ctx: ReportContext) -> DataFrame:
    """rate_date, currency, rate of one usage type: one price a day."""
    return _for_caller(daily_prices(sheet, {"rate": usage_type}, ctx), False)


def compute_and_cloud_rates(sheet: DataFrame, ctx: ReportContext, all_accounts: bool = False) -> DataFrame:
    """Compute and cloud services rates of one contract side by side, for days that have both."""
    return _for_caller(daily_prices(sheet, COMPUTE_AND_CLOUD, ctx, all_accounts), all_accounts)
