"""Publishing results as tables that readers see complete or not at all."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usageledger.context import ReportContext
from usageledger.functions.times import time_literal, truncate_ntz
from usageledger.operators.ranking import top_recent
from usageledger.operators.retention import retention_cutoff
from usageledger.operators.watermark import newest
from usageledger.plans.spec import KEY, ReportSpec, from_newest, incremental_load, new_rows, next_batch
from usageledger.session import remove, staged

DAY = "part_day"
#: Buckets of a history whose key holds no time.
BUCKETS = 64


#: Properties of a published name: the version it shows, how many there were, and the ones before it that still exist.
VERSION, NUMBER, EARLIER = "usageledger.version", "usageledger.number", "usageledger.earlier"


def publish_swap(df: DataFrame, name: str, folder: str, keep: int = 1) -> DataFrame:
    """Write df as a new version of a published name and show it from the next read on.

    A version is a table of its own, ``<name>__<version>``, whose rows lie below
    ``folder/<name>``; the name is a view of one of them. Replacing the view is the one
    statement in which old becomes new, whatever the columns of either, so there is
    always something to read under the name. A failed write leaves the old version,
    and df may read the name it replaces.

    The last ``keep`` versions before this one stay, for queries that began before;
    older ones that this name has shown are deleted, and nothing else is. Of several
    publishers at once the last one wins; the versions of the others stay until somebody
    drops them. A plain table under the name becomes the first version.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    place = f"{folder.rstrip('/')}/{name}/version-{version}"
    df.write.mode("error").parquet(place)
    spark.catalog.createTable(f"{name}__{version}", path=place, source="parquet", schema=df.schema)
    number, shown = published_versions(spark, name)
    kept, gone = shown[:keep], shown[keep:]
    properties = {VERSION: version, NUMBER: number + 1, EARLIER: ",".join(kept)}
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({listed}) AS SELECT * FROM {name}__{version}")
    for old in gone:
        where = _location(spark, f"{name}__{old}")
        spark.sql(f"DROP TABLE IF EXISTS {name}__{old}")
        if where is not None:
            remove(spark, where)
    return spark.table(name)


def published_versions(spark: SparkSession, name: str) -> tuple[int, list[str]]:
    """How many versions a published name has had, and those it shows or has shown that still exist, the newest first."""
    if not spark.catalog.tableExists(name):
        return 0, []
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    properties = {r["key"]: r["value"] for r in found if r["key"] in (VERSION, NUMBER, EARLIER)}
    if VERSION not in properties:  # a table from elsewhere
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}__plain")
        return 1, ["plain"]
    return int(properties[NUMBER]), [properties[VERSION], *filter(None, properties[EARLIER].split(","))]


def _location(spark: SparkSession, name: str) -> str | None:
    if not spark.catalog.tableExists(name):
        return None
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"]


def publish_truncate_insert(parts: Sequence[DataFrame], name: str, folder: str) -> DataFrame:
    """Replace a table by several parts below each other, in one step."""
    return publish_swap(reduce(DataFrame.unionByName, parts), name, folder)


def _by_day(df: DataFrame, spec: ReportSpec) -> DataFrame:
    """Rows brought together by day before they are written, large days in several parts."""
    return df.withColumn(DAY, F.to_date(spec.time)).hint("rebalance", F.col(DAY))


def _by_bucket(df: DataFrame, spec: ReportSpec, buckets: int) -> DataFrame:
    """Rows brought together as a bucketed table has them, so that a task writes one file a day."""
    return df.withColumn(DAY, F.to_date(spec.time)).repartition(buckets, KEY)


def _buckets(spark: SparkSession, name: str) -> int | None:
    """Into how many buckets a table is cut by key, if it is."""
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name IN ('Num Buckets', 'Bucket Columns')").collect()
    described = {r["col_name"]: r["data_type"] for r in found}
    return int(described["Num Buckets"]) if described.get("Bucket Columns") == f"[`{KEY}`]" else None


def stored_keys(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The keys of a batch that a history has which is bucketed by key.

    Only the batch is shuffled, to the buckets. Of the history the key column is read
    and streamed past a hash table of the batch's keys: no exchange, no sort.
    """
    return stored.select(KEY).join(batch.select(KEY).hint("shuffle_hash"), KEY, "left_semi").distinct()


def _append(df: DataFrame, name: str) -> None:
    # A new partition column order would move data, so columns are named.
    spark = df.sparkSession
    df.select(*spark.table(name).columns).write.insertInto(name)


def refresh_history(
    spark: SparkSession,
    spec: ReportSpec,
    source: DataFrame,
    name: str,
    ctx: ReportContext,
    retain_days: int | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Bring a stored history table, partitioned by day, up to date.

    New rows are appended; the stored history is neither rewritten nor, beyond
    the newest days, read. An upsert rewrites only the days it can change.
    Expired days are dropped as partitions.

    A key without a time may come again on any day. Such a history is also cut into
    ``buckets`` by its key when it is first stored, so that a batch finds the keys
    that are there without a shuffle or a sort of stored rows (``stored_keys``).

    Beside the history its counts per hour are kept (``stored_counts``).
    """
    if not spark.catalog.tableExists(name):
        first = incremental_load(spec, source, None, ctx, retain_days)
        if spec.keyed_by_time:
            _by_day(first, spec).write.partitionBy(DAY).format("parquet").saveAsTable(name)
        else:
            _by_bucket(first, spec, buckets).write.partitionBy(DAY).bucketBy(buckets, KEY).format("parquet").saveAsTable(name)
        _count(spark, spec, name, None)
        return history_table(spark, name)
    mark = stored_watermark(spark, spec, name)
    trusted = _counts_hold(spark, name)
    if trusted:
        spark.sql(f"ALTER VIEW {counts_name(name)} SET TBLPROPERTIES ('{OPEN}' = 'true')")
    recent = spark.table(name)
    if mark is not None and spec.keyed_by_time:
        recent = recent.filter(F.col(DAY) >= F.lit(first_day(spec, mark)))
    bucketed = _buckets(spark, name)
    if spec.updates:
        _rewrite_days(spark, spec, source, recent.drop(DAY), name, ctx, mark)
    elif bucketed is not None:
        batch = next_batch(spec, source, mark, ctx)
        known = staged(stored_keys(recent, batch), "known-keys")
        fresh = batch.join(known, KEY, "left_anti").select(*[c for c in recent.columns if c != DAY])
        _append(_by_bucket(fresh, spec, bucketed), name)
    else:
        _append(_by_day(new_rows(spec, source, recent.drop(DAY), ctx, mark), spec), name)
    rewritten = _drop_expired(spark, spec, name, ctx, retain_days)
    spark.catalog.refreshTable(name)
    _count(spark, spec, name, first_day(spec, mark) if trusted and mark is not None else None, rewritten)
    return history_table(spark, name)


def _overwrite_days(spark: SparkSession, aside: str, name: str) -> None:
    """Replace the days found in the table written aside, and no others."""
    rows = spark.table(aside)
    buckets = _buckets(spark, name)
    if buckets is not None:
        same = rows.select(*spark.table(name).columns).repartition(buckets, KEY)
        same.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(name)
        spark.sql(f"DROP TABLE {aside}")
        return
    by_day = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY)
    by_day.parquet(_location(spark, name))
    for r in rows.select(DAY).distinct().filter(F.col(DAY).isNotNull()).collect():  # the days of a batch
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({DAY} = DATE '{r[DAY]}')")
    spark.catalog.refreshTable(name)
    spark.sql(f"DROP TABLE {aside}")


#: Property of counts that a load has begun to outdate.
OPEN = "usageledger.open"


def counts_name(name: str) -> str:
    return f"{name}__counts"


def _counts_hold(spark: SparkSession, name: str) -> bool:
    """Whether a history has counts and no load was broken off since they were made."""
    counts = counts_name(name)
    if not spark.catalog.tableExists(counts):
        return False
    return not any(r["key"] == OPEN for r in spark.sql(f"SHOW TBLPROPERTIES {counts}").collect())


def _count(spark: SparkSession, spec: ReportSpec, name: str, since: date | None, also: Sequence[date] = ()) -> None:
    """Bring the counts of a history up to date: those of the days a load can have changed, and ``also``, or all.

    Expired days leave the counts with their partitions. A load marks the counts before
    it begins; if it never came to its end, the next one counts anew.
    """
    stored = spark.table(name)
    t = F.col(spec.time)
    by = [c for c in spec.counted_by if c in stored.columns]
    changed = F.lit(True) if since is None else (F.col(DAY) >= F.lit(since)) | F.col(DAY).isin(list(also))
    touched = stored.filter(changed)
    hour = truncate_ntz("hour", t.cast("timestamp_ntz")).alias("hour")
    counts = touched.groupBy(DAY, hour, *by).agg(F.count(F.lit(1)).alias("rows"), F.max(t).alias("newest"))
    if since is not None:
        days = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
        kept = spark.table(counts_name(name)).filter(~F.coalesce(changed, F.lit(False)))
        kept = kept.filter(F.coalesce(F.col(DAY).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")).isin(days))
        counts = kept.unionByName(counts)
    publish_swap(counts, counts_name(name), _location(spark, name).rsplit("/", 1)[0])


def stored_counts(spark: SparkSession, name: str) -> DataFrame | None:
    """(part_day, hour, columns of counted_by, rows, newest) of a stored history; None when they can't be trusted."""
    return spark.table(counts_name(name)) if _counts_hold(spark, name) else None


def stored_watermark(spark: SparkSession, spec: ReportSpec, name: str):
    """The watermark of a stored table, from its counts, or else from its newest day that holds rows.

    The days come from the catalog, one entry each, so the history itself is not
    scanned.
    """
    counts = stored_counts(spark, name)
    if counts is not None:
        return from_newest(spec, newest(counts, "newest"))
    days = sorted((r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()), reverse=True)
    for day in days:
        value = newest(spark.table(name).filter(F.col(DAY) == F.to_date(F.lit(day))), spec.time)
        if value is not None:
            return from_newest(spec, value)
    return None


def newest_stored(
    spark: SparkSession, spec: ReportSpec, name: str, unique: str, rows: int, scope: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """The ``rows`` newest rows of a stored history, of those that ``scope`` lets a caller see.

    Where they begin is read from the counts, so only the partitions that hold them are
    opened. ``scope`` must go by columns that the history is counted by.
    """
    seen = scope or (lambda df: df)
    counts = stored_counts(spark, name)
    history = seen(spark.table(name))
    if counts is None:
        return top_recent(history, spec.time, unique, rows, day=DAY).drop(DAY)
    hours = seen(counts).groupBy(F.col("hour").alias("b")).agg(F.sum("rows").alias("n"))
    return top_recent(history, spec.time, unique, rows, hours, DAY).drop(DAY)


def first_day(spec: ReportSpec, mark) -> date:
    """The first day a batch can hold rows of."""
    start = mark - spec.lookback if spec.lookback is not None else mark
    return start.date() if isinstance(start, datetime) else start


def history_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).drop(DAY)


def _rewrite_days(
    spark: SparkSession, spec: ReportSpec, source: DataFrame, recent: DataFrame, name: str, ctx: ReportContext, mark
) -> None:
    """Overwrite the partitions from the batch's first day on with their merged rows."""
    merged = _by_day(incremental_load(spec, source, recent, ctx, mark=mark), spec)
    merged = merged.select(*spark.table(name).columns)
    # The merged days are written aside first: a table cannot be read and replaced at once.
    aside = f"{name}_incoming"
    spark.sql(f"DROP TABLE IF EXISTS {aside}")
    merged.write.format("parquet").saveAsTable(aside)
    _overwrite_days(spark, aside, name)


def _drop_expired(
    spark: SparkSession, spec: ReportSpec, name: str, ctx: ReportContext, retain_days: int | None
) -> list[date]:
    """Drop whole expired days, and expired rows of the day the cutoff falls on; the days that lost some rows.

    Days that also hold rows of other accounts keep those rows.
    """
    if retain_days is None:
        return []
    cutoff = retention_cutoff(ctx, retain_days)
    stored = spark.table(name)
    expired = stored.filter(F.col(DAY) <= F.lit(cutoff.date()))
    gone = F.col(spec.time) <= time_literal(cutoff, stored.schema[spec.time].dataType)
    if spec.account is not None:
        gone = gone & (F.col(spec.account) == F.lit(ctx.account))
    days = expired.groupBy(DAY).agg(F.count_if(gone).alias("gone"), F.count(F.lit(1)).alias("rows"))
    touched = days.filter(F.col("gone") > 0).collect()
    for day in [r[DAY] for r in touched if r["gone"] == r["rows"]]:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({DAY} = DATE '{day}')")
    partly = [r[DAY] for r in touched if r["gone"] < r["rows"]]
    if partly:
        aside = f"{name}_kept"
        spark.sql(f"DROP TABLE IF EXISTS {aside}")
        kept = expired.filter(F.col(DAY).isin(partly) & ~F.coalesce(gone, F.lit(False)))
        kept.write.format("parquet").saveAsTable(aside)
        _overwrite_days(spark, aside, name)
    return partly


