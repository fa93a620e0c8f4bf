"""Streams that keep history tables current.

Every stream runs with ``availableNow``: it takes what has arrived since its
checkpoint, writes it and stops; without new data it does nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from usageledger.context import ReportContext
from usageledger.operators.retention import retention_cutoff, retention_delete
from usageledger.plans.snapshots import CONNECTOR_COLUMNS
from usageledger.session import folders, remove

BATCH, DAY = "batch_id", "part_day"


def parquet_stream(
    spark: SparkSession, folder: str, schema: StructType, files: str = "*.parquet", per_trigger: int | None = None
) -> DataFrame:
    """New Parquet files in a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(folder)


def history(spark: SparkSession, path: str) -> DataFrame:
    """A table written by ``append_stream``."""
    return spark.read.parquet(path).drop(BATCH, DAY)


def _with_day(rows: DataFrame, time: str | None) -> DataFrame:
    """The day that decides where a row is stored; rows without a time, and tables without one, have one folder."""
    day = F.lit(None).cast("date") if time is None else F.to_date(time)
    return rows.withColumn(DAY, F.coalesce(day.cast("string"), F.lit("none")))


def _earlier(spark: SparkSession, path: str, rows: DataFrame, batch_id: int) -> DataFrame | None:
    """What earlier batches stored of the days that rows have; other days are neither listed nor read."""
    days = {f"{DAY}={r[DAY]}" for r in rows.select(DAY).distinct().collect()}
    there = sorted(days.intersection(folders(spark, path)))
    if not there:
        return None
    schema = T.StructType([*rows.schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{d}" for d in there]).filter(F.col(BATCH) < batch_id)


def append_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    key: Sequence[str] | None = None,
    time: str | None = None,
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> None:
    """Append what is new in a stream to a Parquet table, by day of ``time`` and by batch.

    Each micro-batch writes partitions of its own and replaces them when the
    batch is replayed after a failure, so a replay adds nothing. With ``key``
    rows whose key an earlier batch wrote are left out, and repeats inside a
    batch collapse. A key names one event with one ``time``, so a batch is
    compared with the stored rows of its own days only, and its cost doesn't
    grow with the number of batches before it. Without ``time`` there is one
    folder, which is compared whole. Rows are brought together by day before they are
    written, so a day gets few files.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = _with_day(shape(batch), time)
        cached = None
        if key is not None:
            rows = cached = rows.dropDuplicates(list(key)).persist()
            before = _earlier(spark, path, rows, batch_id)
            if before is not None:
                # the batch's size is known once it is kept, so stored rows are streamed past its keys
                known = before.select(*key).join(rows.select(*key), list(key), "left_semi").distinct()
                rows = rows.join(known, list(key), "left_anti").select(*rows.columns)
        by_day = rows.withColumn(BATCH, F.lit(batch_id).cast("bigint")).hint("rebalance", F.col(DAY))
        out = by_day.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        out.partitionBy(DAY, BATCH).parquet(path)
        if cached is not None:
            cached.unpersist()

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def drop_expired(spark: SparkSession, path: str, days: int | None, ctx: ReportContext) -> None:
    """Delete the stored days that lie wholly before the retention's cutoff."""
    if days is None:
        return
    cutoff = retention_cutoff(ctx, days).date().isoformat()
    for name in folders(spark, path):
        day = name.removeprefix(f"{DAY}=")
        if name != day and day != "none" and day < cutoff:
            remove(spark, f"{path}/{name}")


def dedup_late(
    stream: DataFrame, key: Sequence[str], time: str, delay: timedelta, slots: int
) -> DataFrame:
    """First row per key among rows that arrive within the delay; state is bounded by it.

    Copies are dropped in two steps, first per key and slot and then per key. The
    slot is the input partition's, so the copies of a key that makes up a large
    part of the stream are spread over ``slots`` tasks, and the second step gets
    at most one row per slot. Ask for as many slots as there are tasks; a stream
    keeps its number, as its state does.
    """
    hours = int(delay.total_seconds() // 3600)
    timed = stream.withColumns(
        {
            "_event_time": F.col(time).cast("timestamp"),
            "_slot": F.pmod(F.spark_partition_id(), F.lit(slots)),
        }
    ).withWatermark("_event_time", f"{hours} hours")
    return (
        timed.dropDuplicatesWithinWatermark([*key, "_slot"])
        .dropDuplicatesWithinWatermark(list(key))
        .drop("_event_time", "_slot")
    )


def file_stream(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Write an append-mode stream as Parquet, exactly once."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def connector_type_history(
    changes: DataFrame, path: str, checkpoint: str, ctx: ReportContext, days: int | None
) -> DataFrame:
    """Every image of a connector type that a change stream delivered, within retention.

    Expired days are deleted; rows of the day the cutoff falls on are left out. Old and new images both stay, so there is no key.
    """
    append_stream(changes.select(*CONNECTOR_COLUMNS), path, checkpoint, time="synced")
    drop_expired(changes.sparkSession, path, days, ctx)
    return retention_delete(history(changes.sparkSession, path), "synced", days, ctx, account=None)
