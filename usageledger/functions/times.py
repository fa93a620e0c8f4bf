"""Time arithmetic that counts calendar boundaries, not elapsed units."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def time_literal(value: date | datetime, kind: T.DataType | None = None) -> Column:
    """A date or time as a literal of a column's type.

    Zone-less times go through text: a Python datetime would be read in the
    driver's zone, which need not be the session's.
    """
    if kind is None or isinstance(kind, T.TimestampNTZType):
        return F.lit(value.isoformat()).cast("timestamp_ntz")
    if isinstance(kind, T.DateType):
        return F.lit(value.date() if isinstance(value, datetime) else value)
    return F.lit(value).cast(kind)


def _epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from start to end."""
    return _epoch_seconds(end) - _epoch_seconds(start)


def hours_between(start: Column, end: Column) -> Column:
    """Hour boundaries crossed from start to end."""
    hour = lambda ts: F.floor(_epoch_seconds(ts) / F.lit(3600)).cast("bigint")
    return hour(end) - hour(start)


def months_between_starts(start: Column, end: Column) -> Column:
    """Month boundaries crossed from start to end."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def hour_number(ts: Column) -> Column:
    """Clock hours since 1970 as a number; cheaper than truncating a time."""
    return F.unix_date(F.to_date(ts)) * 24 + F.hour(ts)


def truncate_ntz(unit: str, ts: Column) -> Column:
    """``date_trunc`` that keeps the zone-less type of its input."""
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def derive_time_columns(df: DataFrame, start: str = "start_time", end: str = "end_time") -> DataFrame:
    """Add start_date, operation_hours and time_of_day."""
    return df.withColumns(
        {
            "start_date": F.to_date(start),
            "operation_hours": hours_between(F.col(start), F.col(end)),
            "time_of_day": F.date_format(start, "HH:mm:ss"),
        }
    )


def elapsed_seconds(df: DataFrame, start: str = "start_time", end: str = "end_time") -> DataFrame:
    return df.withColumn("elapsed_time_in_sec", seconds_between(F.col(start), F.col(end)))


def date_range(df: DataFrame, start: str, end: str, out: str = "day") -> DataFrame:
    """One row per input row and day from start to end, both included.

    Rows whose end lies before their start give nothing.
    """
    span = F.when(F.col(start) <= F.col(end), F.sequence(F.col(start), F.col(end)))
    return df.withColumn(out, F.explode(span))
