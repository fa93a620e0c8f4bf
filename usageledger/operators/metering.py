"""Hourly metering records by name, service and day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usageledger.functions.patterns import full_match
from usageledger.functions.times import derive_time_columns, time_literal


def metering_history(
    metering: DataFrame, pattern: str, services: Sequence[str], start: date, end: date
) -> DataFrame:
    """Metering rows of the services whose name matches and whose days lie in [start, end].

    The day bounds are written as bounds on the times themselves, so that they
    reach the scan: day(t) <= end means t < end + 1 day.
    """
    kind = metering.schema["start_time"].dataType
    first = time_literal(datetime.combine(start, time()), kind)
    after = time_literal(datetime.combine(end + timedelta(days=1), time()), kind)
    chosen = metering.filter(
        F.col("service_type").isin(list(services))
        & (F.col("start_time") >= first)
        & (F.col("end_time") < after)
        & full_match(F.col("name"), pattern)
    )
    return derive_time_columns(
        chosen.select(
            "start_time",
            "end_time",
            "entity_id",
            "name",
            "service_type",
            "credits_used",
            "credits_used_compute",
            "credits_used_cloud_services",
        )
    )


def monthly_credit_summary(metering: DataFrame) -> DataFrame:
    """Three credit sums per month."""
    month = F.trunc("start_time", "month")
    return metering.groupBy(month.alias("usage_month")).agg(
        *[F.sum(c).alias(c) for c in ("credits_used", "credits_used_compute", "credits_used_cloud_services")]
    )


def warehouse_daily_credits(metering: DataFrame, name: str = "name") -> DataFrame:
    """Credits per warehouse and day, the day as text."""
    return metering.groupBy(
        F.col(name).alias("warehouse_name"), F.date_format("start_time", "yyyy-MM-dd").alias("active_date")
    ).agg(F.coalesce(F.sum("credits_used"), F.lit(0)).alias("credits_used"))


def sorted_for_readers(df: DataFrame, *columns: str) -> DataFrame:
    """Range-partition and sort by the columns, so that readers skip files."""
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)
