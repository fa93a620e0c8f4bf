"""Joining points in time to the interval they lie in, by one sweep over both in order.

Points and interval starts are sorted together by key and time; a point's interval
is the last one that started. Rows are dealt out by ranges of that order, so a key
or an hour that holds most points is swept by many tasks; each range gets one row
more, the last interval that started before it. An interval is one row however long
it is, and points are shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usageledger.functions.search import last_place
from usageledger.session import staged

#: Ranges for each of the session's shuffle partitions, and points sampled for each range.
RANGES_EACH, SAMPLED = 4, 50
#: Kinds of rows in the order in which they are swept.
_CARRIED, _START, _POINT = -1, 0, 1
_BEFORE_ALL = -(1 << 63)


def _micros(time: str, kind: T.DataType) -> Column:
    """A time as a number that orders like it, whatever the session's zone."""
    t = F.col(time)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(t)
    seconds = F.unix_date(F.to_date(t)).cast("long") * 86400 + F.hour(t) * 3600 + F.minute(t) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("long")


def _placed(points: DataFrame, key: str, time: str, unique: Sequence[str]) -> DataFrame:
    """Points with the columns they are ordered by; those without a key or a time lie in no interval."""
    dated = points.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
    order = {"_key": F.col(key), "_t": _micros(time, points.schema[time].dataType), "_salt": F.xxhash64(*unique)}
    return dated.withColumns(order)


def sweep_edges(points: DataFrame, key: str, time: str, unique: Sequence[str]) -> list[tuple]:
    """(key, time, salt) at which ranges begin, from a bounded sample of the points.

    They decide how evenly points are dealt out and nothing else.
    """
    order = _placed(points, key, time, unique).select("_key", "_t", "_salt")
    ranges = RANGES_EACH * int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = SAMPLED * ranges / max(1, order.count())
    found = sorted(tuple(r) for r in (order if share >= 1 else order.sample(False, share, 7)).collect())
    return list(dict.fromkeys(found[len(found) * k // ranges] for k in range(1, ranges))) if found else []


def _range(edges: list[tuple]) -> Column:
    if not edges:
        return F.lit(0)
    keys, times, salts = (F.array(*[F.lit(e[k]) for e in edges]) for k in range(3))
    key, t, salt = F.col("_key"), F.col("_t"), F.col("_salt")

    def holds(k: Column) -> Column:
        at_key, at_t, at_salt = (F.element_at(a, k) for a in (keys, times, salts))
        return (key > at_key) | ((key == at_key) & ((t > at_t) | ((t == at_t) & (salt >= at_salt))))

    return last_place(len(edges), holds)


def overlapping_keys(intervals: DataFrame, key: str, start: str, end: str, closed: str = "left") -> DataFrame:
    """Keys with intervals that share more than an end, or with ones that hold no time; a sweep can't serve them."""
    before = Window.partitionBy(key).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    shares = F.coalesce(F.max(end).over(before) > F.col(start), F.lit(False))
    empty = F.col(start) >= F.col(end) if closed == "both" else F.lit(False)
    return intervals.withColumn("_shares", shares | empty).filter("_shares").select(key).distinct()


def sweep_join(
    points: DataFrame,
    intervals: DataFrame,
    key: str,
    time: str,
    start: str,
    end: str,
    unique: Sequence[str],
    closed: str = "left",
    edges: list[tuple] | None = None,
) -> DataFrame:
    """Points with the columns of the interval of their key they lie in, start included and end not.

    With ``closed="both"`` the end is part of the interval, and a point on the border
    of two is two rows. Points in no interval are left out. Intervals of a key must not
    overlap (``overlapping_keys`` names those that do); of such only the last started is
    met. ``unique`` are columns that differ between points of one key and time.
    """
    if closed not in ("left", "both"):
        raise ValueError(f"closed must be 'left' or 'both', not {closed!r}")
    spark = points.sparkSession
    edges = sweep_edges(points, key, time, unique) if edges is None else edges
    values = [c for c in intervals.columns if c != key]
    known = intervals.filter(F.col(key).isNotNull() & (F.col(start) < F.col(end) if closed == "left" else F.col(start) <= F.col(end)))
    own = F.struct(*values)
    before = F.lag(own).over(Window.partitionBy(key).orderBy(start)) if closed == "both" else F.lit(None)
    starts = known.select(
        F.col(key).alias("_key"),
        _micros(start, intervals.schema[start].dataType).alias("_t"),
        F.lit(_BEFORE_ALL).alias("_salt"),
        F.struct(F.col(key).alias("key"), own.alias("own"), before.alias("before")).alias("_open"),
    ).withColumn("_range", _range(edges))

    lasts = starts.groupBy("_range").agg(F.max_by(F.struct("_key", "_t", "_open"), F.struct("_key", "_t")).alias("_last"))
    every = spark.range(len(edges) + 1).select(F.col("id").cast("int").alias("_range"))  # a row a range
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.join(lasts, "_range", "left").withColumn("_last", F.last("_last", True).over(earlier)).filter("_last IS NOT NULL")

    no_point = F.lit(None).cast(T.StructType(points.schema.fields)).alias("_point")
    salt = F.lit(_BEFORE_ALL).alias("_salt")
    rows = _placed(points, key, time, unique).withColumn("_range", _range(edges)).select(
        "_range", "_key", "_t", F.lit(_POINT).alias("_kind"), "_salt",
        F.struct(*[F.col(c) for c in points.columns]).alias("_point"), F.lit(None).cast(starts.schema["_open"].dataType).alias("_open"),
    )
    rows = rows.unionByName(starts.select("_range", "_key", "_t", F.lit(_START).alias("_kind"), "_salt", no_point, "_open"))
    rows = rows.unionByName(carried.select("_range", "_last._key", "_last._t", F.lit(_CARRIED).alias("_kind"), salt, no_point, "_last._open"))

    swept = Window.partitionBy("_range").orderBy("_key", "_t", "_kind", "_salt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = rows.withColumn("_open", F.last("_open", True).over(swept)).filter(F.col("_kind") == _POINT)
    met = met.filter(F.col("_open.key") == F.col("_key"))
    t = F.col(f"_point.{time}")
    out = [F.col(f"_point.{c}").alias(c) for c in points.columns]
    if closed == "left":
        inside = met.filter(t < F.col(f"_open.own.{end}"))
        return inside.select(*out, *[F.col(f"_open.own.{v}").alias(v) for v in values])
    # at most two: the open interval, and the one before where it ends as this one starts
    found = F.filter(F.array("_open.own", "_open.before"), lambda m: m.isNotNull() & t.between(m[start], m[end]))
    return met.withColumn("_met", F.explode(found)).select(*out, *[F.col(f"_met.{v}").alias(v) for v in values])


def overlapping(intervals: DataFrame, key: str, start: str, end: str, closed: str = "left") -> DataFrame | None:
    """overlapping_keys, stored; None when there are none."""
    keys = staged(overlapping_keys(intervals, key, start, end, closed), "overlapping-keys")
    return None if keys.isEmpty() else keys
