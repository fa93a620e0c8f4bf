"""Splitting hourly credits between the queries that ran in the hour.

A query's share of a meter interval is its execution time divided by the total
of the interval, and its credit is that share of the interval's credits. Shares
are linear, so every report that only shows sums aggregates execution time per
(interval, group) first; the facts are then shuffled only as partial aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usageledger.functions.times import hour_number, time_literal
from usageledger.operators.skew import BROADCAST_BYTES, fits_broadcast, skew_safe_join
from usageledger.operators.sweep import overlapping, sweep_edges, sweep_join

HOUR_KEY = ("warehouse_id", "_hour")
#: Meter columns after the interval join.
METER = ("meter_name", "meter_start", "meter_end", "meter_credits")


def meter_rows(metering: DataFrame) -> DataFrame:
    """Meters under the names they have after the join, one row each."""
    return metering.select(
        "warehouse_id",
        F.col("warehouse_name").alias("meter_name"),
        F.col("start_time").alias("meter_start"),
        F.col("end_time").alias("meter_end"),
        F.col("credits_used").cast("double").alias("meter_credits"),
    )


def by_hour(meters: DataFrame, closed: str = "left") -> DataFrame:
    """Meters with one row per clock hour a query can start in; an hourly meter stays one row."""
    last = F.col("meter_end")
    if closed == "left":
        last = F.greatest(F.col("meter_start"), last - F.expr("INTERVAL 0.000001 SECOND"))
    return meters.withColumn("_hour", F.explode(F.sequence(hour_number(F.col("meter_start")), hour_number(last))))


def hourly_meters(metering: DataFrame, closed: str = "left") -> DataFrame:
    return by_hour(meter_rows(metering), closed)


def _within(closed: str) -> Column:
    """A query starting on the boundary belongs to one interval, or with both ends to two."""
    t, start, end = F.col("start_time"), F.col("meter_start"), F.col("meter_end")
    if closed == "left":
        return (t >= start) & (t < end)
    if closed == "both":
        return t.between(start, end)
    raise ValueError(f"closed must be 'left' or 'both', not {closed!r}")


def _keyed(queries: DataFrame) -> DataFrame:
    return queries.withColumn("_hour", hour_number(F.col("start_time")))


def match_meters(
    queries: DataFrame,
    hourly: DataFrame,
    closed: str = "left",
    small: bool | None = None,
    hot: DataFrame | None = None,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Queries with the meter interval they started in; ``hourly`` comes from ``hourly_meters``.

    The hour is a second equi key, so a warehouse's queries meet only the meters
    of their hour and not every meter of the warehouse.
    """
    joined = skew_safe_join(
        _keyed(queries), hourly, HOUR_KEY, "inner", ["query_id", "start_time"], small, hot, max_bytes
    )
    return joined.filter(_within(closed)).drop("_hour")


_UNIQUE = ("query_id", "start_time")


def sweep_meters(queries: DataFrame, meters: DataFrame, closed: str = "left", shared: DataFrame | None = None, edges: list | None = None) -> DataFrame:
    """As match_meters for meters of any number and length, of which each stays one row.

    ``meters`` come from ``meter_rows``. Warehouses with overlapping meters, named in
    ``shared``, can't be swept and are matched by the hour.
    """
    swept = lambda q, m: sweep_join(q, m, "warehouse_id", "start_time", "meter_start", "meter_end", _UNIQUE, closed, edges)
    if shared is None:
        return swept(queries, meters)
    apart = [df.join(shared, "warehouse_id", "left_anti") for df in (queries, meters)]
    together = [df.join(shared, "warehouse_id", "left_semi") for df in (queries, meters)]
    matched = match_meters(together[0], by_hour(together[1], closed), closed, small=False)
    rest = swept(*apart)
    return rest.unionByName(matched.select(*rest.columns))


def _shared(meters: DataFrame, closed: str) -> DataFrame | None:
    return overlapping(meters, "warehouse_id", "meter_start", "meter_end", closed)


def _units(guard_zero: bool) -> Column:
    """What a query adds to the interval's total; idle queries may count as one unit."""
    t = F.col("execution_time")
    return F.when(t == 0, F.lit(1)).otherwise(t) if guard_zero else t


def attribute_credits(
    queries: DataFrame,
    metering: DataFrame,
    closed: str = "left",
    guard_zero: bool = False,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Each matched query with its percentage and its credit.

    Totals come from a partial aggregation and are joined back through the
    meters, instead of a window that would gather all queries of an interval in
    one task. An interval without any execution time gives NULL.
    """
    slim = queries.select("query_id", "warehouse_id", "start_time", "execution_time")
    # Meters without a name form intervals like the others.
    meters = meter_rows(metering).withColumns({"_name": F.coalesce("meter_name", F.lit("")), "_unnamed": F.col("meter_name").isNull()})
    interval = ["_name", "_unnamed", "meter_start", "meter_end"]
    if fits_broadcast(by_hour(meters, closed), max_bytes):
        match = lambda q, m: match_meters(q, by_hour(m, closed), closed, True)
    else:
        shared, edges = _shared(meters, closed), sweep_edges(slim, "warehouse_id", "start_time", _UNIQUE)
        match = lambda q, m: sweep_meters(q, m, closed, shared, edges)
    totals = match(slim, meters).groupBy(*interval).agg(F.sum(_units(guard_zero)).alias("_total"))
    # Never more rows than the meters themselves, so the same choice of join holds.
    with_total = meters.join(totals, interval)
    share = F.try_divide(F.col("execution_time"), F.col("_total"))
    return (
        match(queries, with_total)
        .withColumns({"pct_credit_used_by_query": share * 100, "credit_used_by_query": share * F.col("meter_credits")})
        .drop("_total", "_name", "_unnamed")
    )


def attribute_groups(
    queries: DataFrame,
    metering: DataFrame,
    group: Sequence[str],
    closed: str = "left",
    guard_zero: bool = True,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Credits and query counts per meter interval and group.

    One pass over the queries: they are summed per (interval, group) on the map
    side, and the interval's total is taken over those few sums.
    """
    meters = meter_rows(metering)
    if fits_broadcast(by_hour(meters, closed), max_bytes):
        matched = match_meters(queries, by_hour(meters, closed), closed, True)
    else:
        narrow = queries.select("query_id", "warehouse_id", "start_time", "execution_time", *group)
        matched = sweep_meters(narrow, meters, closed, _shared(meters, closed))
    sums = matched.groupBy(*METER, *group).agg(
        F.sum("execution_time").alias("_time"), F.sum(_units(guard_zero)).alias("_units"), F.count(F.lit(1)).alias("queries")
    )
    interval = Window.partitionBy("meter_name", "meter_start", "meter_end")
    share = F.try_divide(F.col("_time"), F.sum("_units").over(interval))
    return sums.withColumn("credits", share * F.col("meter_credits")).drop("_time", "_units")


def db_schema_credits(queries: DataFrame, metering: DataFrame, closed: str = "left", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Credits per warehouse, database, schema and day, of queries that used a schema."""
    placed = queries.filter(F.col("database_name").isNotNull() & F.col("schema_name").isNotNull()).withColumn(
        "usage_date", F.to_date("start_time")
    )
    groups = attribute_groups(placed, metering, ["database_name", "schema_name", "usage_date"], closed, max_bytes=max_bytes)
    return groups.groupBy(
        F.col("meter_name").alias("warehouse_name"), "database_name", "schema_name", "usage_date"
    ).agg(F.sum("credits").alias("credit_used"))


def shift_month(day: date, months: int) -> date:
    """First of the month ``months`` after the day's month."""
    index = day.year * 12 + day.month - 1 + months
    return date(index // 12, index % 12 + 1, 1)


def recent_months(today: date, duration: int, starting_from: int = 0) -> list[date]:
    """First days of ``duration`` months, going back from ``starting_from`` months ago."""
    return [shift_month(today, -(starting_from + i)) for i in range(duration)]


def month_credits_pivot(
    queries: DataFrame,
    metering: DataFrame,
    monitors: DataFrame,
    today: date,
    duration: int = 12,
    starting_from: int = 0,
    closed: str = "left",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per warehouse, user and resource monitor: credits and query count of each month.

    ``monitors`` has resource_monitor_name and warehouse_name. The month list is
    known beforehand, so the pivot is a plain conditional aggregation. Meters are
    read from the first of the months on.
    """
    months = recent_months(today, duration, starting_from)
    since = time_literal(months[-1])
    groups = attribute_groups(
        queries, metering.filter(F.col("start_time") >= since), ["user_name"], closed, max_bytes=max_bytes
    )
    monthly = groups.groupBy(
        F.col("meter_name").alias("name"), "user_name", F.trunc("meter_start", "month").alias("usage_month")
    ).agg(F.sum("credits").alias("credits"), F.sum("queries").alias("queries"))
    with_monitor = monthly.join(
        monitors.select(F.col("warehouse_name").alias("name"), "resource_monitor_name").distinct(), "name", "left"
    )
    in_month = {m: F.col("usage_month") == F.lit(m) for m in months}
    return with_monitor.groupBy("name", "user_name", "resource_monitor_name").agg(
        *[F.round(F.sum(F.when(in_month[m], F.col("credits")).otherwise(0.0)), 9).alias(f"{m:%Y%m}_credits") for m in months],
        *[F.sum(F.when(in_month[m], F.col("queries")).otherwise(0)).alias(f"{m:%Y%m}_query") for m in months],
    )


def month_credits_unpivot(pivoted: DataFrame) -> DataFrame:
    """Long form of the credit columns; query counts are left out."""
    values = [c for c in pivoted.columns if "credit" in c.lower()]
    return pivoted.unpivot(["name", "user_name", "resource_monitor_name"], values, "attribute", "value").filter(
        F.col("value").isNotNull()
    )
