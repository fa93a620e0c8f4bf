"""Reading only what is new in a source.

The newest loaded time is one aggregated value. It is fetched first and put into
the filter as a literal, so that the predicate reaches the Parquet scan.
"""

from __future__ import annotations

import calendar
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usageledger.context import ReportContext
from usageledger.functions.times import time_literal


def newest(df: DataFrame, column: str):
    """max(column), or None when there are no rows."""
    return df.agg(F.max(column)).first()[0]


def oldest(df: DataFrame, column: str):
    return df.agg(F.min(column)).first()[0]


def months_before(ctx: ReportContext, months: int | None) -> datetime | None:
    """Midnight so many months before today; a month without that day ends earlier."""
    if months is None:
        return None
    d = ctx.today
    year, month = divmod(d.year * 12 + d.month - 1 - months, 12)
    day = min(d.day, calendar.monthrange(year, month + 1)[1])
    return datetime(year, month + 1, day)


def _from(df: DataFrame, column: str, start) -> DataFrame:
    return df if start is None else df.filter(F.col(column) >= time_literal(start, df.schema[column].dataType))


def high_watermark_scan(
    source: DataFrame, time: str, watermark, ctx: ReportContext, first_months: int | None = None
) -> DataFrame:
    """Rows at or after the watermark; without one all rows, or those of the last ``first_months`` months."""
    return _from(source, time, watermark if watermark is not None else months_before(ctx, first_months))


def high_watermark_scan_min_default(source: DataFrame, time: str, watermark) -> DataFrame:
    """Rows at or after the watermark, or from the source's first day without one.

    The first day is the minimum, so without a watermark every dated row is read.
    """
    if watermark is None:
        return source.filter(F.col(time).isNotNull())
    return _from(source, time, watermark)


def late_lookback_scan(
    source: DataFrame, time: str, watermark, ctx: ReportContext, lookback: timedelta, first_months: int | None = None
) -> DataFrame:
    """Start some hours before the watermark to see rows that changed late."""
    return _from(source, time, watermark - lookback if watermark is not None else months_before(ctx, first_months))


def bounded_window_scan(
    source: DataFrame, time: str, watermark, ctx: ReportContext, days: int, first_months: int | None = None
) -> DataFrame:
    """As the watermark scan, and not before the last days nor after now.

    After a pause longer than the window the rows between are left out; a caller
    who wants them asks for more days.
    """
    kind = source.schema[time].dataType
    in_window = F.col(time).between(
        time_literal(ctx.as_of - timedelta(days=days), kind), time_literal(ctx.as_of, kind)
    )
    return high_watermark_scan(source.filter(in_window), time, watermark, ctx, first_months)
