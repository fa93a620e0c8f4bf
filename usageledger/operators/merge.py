"""Merging a batch into a history table, as DataFrames.

Plain Parquet tables have no MERGE, so a merge is a join. ``can_match`` narrows
the target to the rows a batch can meet: keys contain the row's time, so only
target rows at or after the batch's start need to be read for the join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usageledger.operators.skew import skew_safe_anti

_ROW, _MATCHED, _OLD = "_new", "_matched", "_old"


def unmatched(
    batch: DataFrame, target: DataFrame, key: Sequence[str], can_match: Column | None = None, most: int | None = None
) -> DataFrame:
    """Batch rows whose key the target, of at most ``most`` rows if that is known, does not hold."""
    seen = target if can_match is None else target.filter(can_match)
    return skew_safe_anti(batch, seen.select(*key), key, most=most).select(*batch.columns)


def merge_insert_only(
    batch: DataFrame,
    target: DataFrame,
    key: Sequence[str] = ("sh_key",),
    can_match: Column | None = None,
    most: int | None = None,
) -> DataFrame:
    """Target plus the batch rows with new keys. Repeats inside the batch all land."""
    return target.unionByName(unmatched(batch, target, key, can_match, most).select(*target.columns))


def latest_per_key(batch: DataFrame, key: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``newest_by``; NULL sorts first.

    The aggregation keeps one row per key before the shuffle, so a key with very
    many copies does not reach one task as a group.
    """
    rest = [c for c in batch.columns if c not in key]
    order = F.struct(*newest_by, *[c for c in rest if c not in newest_by])
    picked = batch.groupBy(*key).agg(F.max(order).alias(_ROW))
    return picked.select(*key, *[F.col(f"{_ROW}.{c}").alias(c) for c in rest]).select(*batch.columns)


def merge_upsert(
    batch: DataFrame,
    target: DataFrame,
    key: Sequence[str] = ("sh_key",),
    updates: Sequence[str] = (),
    newest_by: Sequence[str] | None = None,
    can_match: Column | None = None,
) -> DataFrame:
    """Update the listed columns of matched target rows and insert the others: one full outer join.

    Several batch rows of one key are ambiguous; with ``newest_by`` the last
    wins, without it the largest row does. Either way one row per key is left,
    which is found before the shuffle, so neither side has a hot key but for
    repeats in the target. A missing key part matches nothing. Rows that a batch
    can't meet take no part in the join.
    """
    key = list(key)
    batch = latest_per_key(batch, key, newest_by or ())
    touched = target if can_match is None else target.filter(can_match)
    theirs, ours = touched.withColumn(_OLD, F.lit(True)).alias("t"), batch.withColumn(_MATCHED, F.lit(True)).alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"t.{k}") == F.col(f"b.{k}") for k in key])
    stays, changes = F.col(_OLD).isNotNull(), F.col(_MATCHED).isNotNull()

    def merged_column(c: str) -> Column:
        old, new = F.col(f"t.{c}"), F.col(f"b.{c}")
        return F.when(changes, new).otherwise(old) if c in updates else F.when(stays, old).otherwise(new)

    merged = theirs.join(ours, same, "full_outer").select(*[merged_column(c).alias(c) for c in target.columns])
    if can_match is None:
        return merged
    return target.filter(~F.coalesce(can_match, F.lit(False))).unionByName(merged)
