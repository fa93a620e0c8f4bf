"""A published table's changes from version to version, as a feed that streams consume.

Each version's changes are one folder of the feed, derived by a keyed full join of
the version with the one before it. Both are stored, so a feed that a broken publish
left behind is caught up from them. A stream reads each folder once, in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usageledger.operators.reconcile import require_unique_keys, snapshot_diff
from usageledger.plans.publish import publish_swap, published_versions
from usageledger.session import exists
from usageledger.streaming.loads import parquet_stream

CHANGE, VERSION = "change_type", "version"
#: Kinds of change; an update is two rows, the image before and the one after.
INSERT, DELETE, BEFORE, AFTER = "insert", "delete", "update_before", "update_after"


def row_changes(before: DataFrame | None, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """change_type and the columns of ``after``: the rows that came, went, or changed between two versions.

    Keys must be unique in both; missing key parts match each other, and a missing
    value equals a missing value. Without a version before, every row is an insert.
    """
    columns = after.columns
    if before is None:
        return after.select(F.lit(INSERT).alias(CHANGE), *columns)
    values = [c for c in columns if c not in key]
    diff = snapshot_diff(require_unique_keys(after, key), before.select(*columns), key, values)
    image = lambda kind, prefix: F.struct(F.lit(kind).alias(CHANGE), *[F.col(c if c in key else prefix + c).alias(c) for c in columns])
    kind = F.col("change_type")
    images = (
        F.when(kind == "insert", F.array(image(INSERT, "")))
        .when(kind == "delete", F.array(image(DELETE, "current_")))
        .otherwise(F.array(image(BEFORE, "current_"), image(AFTER, "")))
    )
    return diff.select(F.explode(images).alias("_i")).select("_i.*")


def _catch_up(spark: SparkSession, name: str, feed: str, key: Sequence[str]) -> None:
    """Write the newest version's changes to the feed if they aren't there."""
    number, versions = published_versions(spark, name)
    place = f"{feed.rstrip('/')}/{VERSION}={number}"
    if not versions or exists(spark, f"{place}/_SUCCESS"):
        return
    before = spark.table(f"{name}__{versions[1]}") if len(versions) > 1 else None
    row_changes(before, spark.table(f"{name}__{versions[0]}"), key).write.mode("overwrite").parquet(place)


def publish_with_feed(df: DataFrame, name: str, folder: str, feed: str, key: Sequence[str]) -> DataFrame:
    """publish_swap, and the changes that the new version brings, in the feed."""
    spark = df.sparkSession
    _catch_up(spark, name, feed, key)
    published = publish_swap(df, name, folder)
    _catch_up(spark, name, feed, key)
    return published


def feed_stream(spark: SparkSession, feed: str, schema: T.StructType, per_trigger: int | None = None) -> DataFrame:
    """The feed as a stream: change_type, the table's columns, and the version that made the change."""
    fields = [T.StructField(CHANGE, T.StringType()), *schema.fields, T.StructField(VERSION, T.LongType())]
    return parquet_stream(spark, feed, T.StructType(fields), per_trigger=per_trigger)
