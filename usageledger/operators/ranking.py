"""Newest rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usageledger.functions.times import time_literal, truncate_ntz
from usageledger.session import staged

#: The edge of the newest rows is narrowed down in these steps.
STEPS = {
    "hour": "INTERVAL 1 HOUR",
    "second": "INTERVAL 1 SECOND",
    "millisecond": "INTERVAL 0.001 SECOND",
    "microsecond": "INTERVAL 0.000001 SECOND",
}


def _edge_bucket(counts: DataFrame, wanted: int) -> tuple:
    """(start, newer, undated): the bucket (b, n) the wanted-th newest row is in, the rows of newer buckets, and of none.

    start is None, and newer all dated rows, when they are fewer. The driver sees one
    row per bucket: the hours of a history, or a few thousand parts of an hour.
    """
    rows = counts.collect()
    undated = sum(r["n"] for r in rows if r["b"] is None)
    newer = 0
    for start, n in sorted(((r["b"], r["n"]) for r in rows if r["b"] is not None), reverse=True):
        if newer + n >= wanted:
            return start, newer, undated
        newer += n
    return None, newer, undated


def _counts(rows: DataFrame, bucket: Column) -> DataFrame:
    return rows.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))


def top_recent(df: DataFrame, time: str, unique: str, rows: int, hours: DataFrame | None = None, day: str | None = None) -> DataFrame:
    """The ``rows`` newest rows by time, ties broken by a unique column; rows without a time are the oldest.

    Rows are expected once each; loading sees to that. Where the newest rows end
    is found from counts per hour, summed before the shuffle, or from counts that are
    stored: ``hours``, with b, an hour, and n. Only the (time, unique) pairs of the
    hour at the edge are stored and narrowed by second and microsecond. The rows are
    then filtered by that edge, a literal that reaches the scan; with ``day``, a
    partition column that holds the date of the time, older partitions are not opened.
    The result is not sorted; the consumer orders what it shows.
    """
    kind = df.schema[time].dataType
    start, wanted, pairs = None, rows, _pairs(df, time, unique)
    dated = df.filter(F.col(time).isNotNull())
    for unit, step in STEPS.items():
        counts = hours if unit == "hour" and hours is not None else _counts(pairs, truncate_ntz(unit, F.col("t")))
        start, newer, undated = _edge_bucket(counts, wanted)
        wanted -= newer
        if start is None:
            return df if undated <= wanted else _with_undated(df, time, unique, wanted)
        begin = time_literal(start)
        if unit == "hour" and day is not None:
            dated = dated.filter(F.col(day) >= F.lit(start.date()))
            pairs = _pairs(dated, time, unique)
        pairs = pairs.filter((F.col("t") >= begin) & (F.col("t") < begin + F.expr(step)))
        if unit == "hour":
            pairs = staged(pairs, "edge-hour")
    last = pairs.select("u").orderBy(F.desc("u")).limit(wanted).agg(F.min("u")).first()[0]
    edge = time_literal(start).cast(kind)
    newer_than_edge = (F.col(time) > edge) | (F.col(unique) >= F.lit(last))
    return dated.filter((F.col(time) >= edge) & newer_than_edge)


def _pairs(dated: DataFrame, time: str, unique: str) -> DataFrame:
    return dated.select(F.col(time).cast("timestamp_ntz").alias("t"), F.col(unique).alias("u"))


def _with_undated(df: DataFrame, time: str, unique: str, room: int) -> DataFrame:
    """All dated rows, and as many of the others as there is room for."""
    if not room:
        return df.filter(F.col(time).isNotNull())
    undated = df.filter(F.col(time).isNull())
    last = undated.select(unique).orderBy(F.desc(unique)).limit(room).agg(F.min(unique)).first()[0]
    return df.filter(F.col(time).isNotNull() | (F.col(unique) >= F.lit(last)))
