"""What an incremental report is, and the one load that runs all of them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usageledger.context import ReportContext
from usageledger.functions.keys import business_key
from usageledger.functions.times import time_literal
from usageledger.operators.merge import latest_per_key, merge_insert_only, merge_upsert, unmatched
from usageledger.operators.retention import retention_delete
from usageledger.operators.watermark import (
    bounded_window_scan,
    high_watermark_scan,
    high_watermark_scan_min_default,
    late_lookback_scan,
    newest,
)

KEY = "sh_key"


@dataclass(frozen=True)
class ReportSpec:
    """One history table: where its rows come from and how a batch enters it.

    ``source_time`` is the time column of the source the watermark applies to and
    ``time`` its name in the stored table. ``shape`` turns scanned source rows
    into stored rows without the key; ``key`` lists the key parts over the
    stored columns.

    ``columns``: source columns that are read, as far as the source has them;
    others are left out on purpose. None reads all. ``distinct``: exact repeats in
    a batch are one row, so nobody who reads the history has to remove them.
    ``keyed_by_time``: the key holds the time, so stored rows before a batch can't
    have its keys. ``first_months``: how far a first load reaches back.
    ``counted_by``: columns that a stored history's counts per hour are split by.
    """

    name: str
    source_time: str
    time: str
    shape: Callable[[DataFrame, ReportContext], DataFrame]
    key: Callable[[], list[Column]]
    whole_days: bool = False
    columns: tuple[str, ...] | None = None
    distinct: bool = True
    keyed_by_time: bool = True
    first_months: int | None = None
    dated_only: bool = False
    lookback: timedelta | None = None
    window_days: int | None = None
    updates: tuple[str, ...] = ()
    newest_by: tuple[str, ...] = ()
    retain_days: int | None = None
    account: str | None = "account_locator"
    counted_by: tuple[str, ...] = ()


def watermark(spec: ReportSpec, target: DataFrame | None):
    """Newest loaded time, or the start of its day for reports that re-read whole days."""
    return from_newest(spec, None if target is None else newest(target, spec.time))


def from_newest(spec: ReportSpec, value):
    """The watermark that belongs to a newest loaded time."""
    if value is not None and spec.whole_days and isinstance(value, datetime):
        return datetime.combine(value.date(), time())
    return value


def scan(spec: ReportSpec, source: DataFrame, mark, ctx: ReportContext) -> DataFrame:
    """Source rows the next batch consists of."""
    if spec.window_days is not None:
        return bounded_window_scan(source, spec.source_time, mark, ctx, spec.window_days, spec.first_months)
    if spec.dated_only:
        return high_watermark_scan_min_default(source, spec.source_time, mark)
    if spec.lookback is not None:
        return late_lookback_scan(source, spec.source_time, mark, ctx, spec.lookback, spec.first_months)
    return high_watermark_scan(source, spec.source_time, mark, ctx, spec.first_months)


def next_batch(spec: ReportSpec, source: DataFrame, mark, ctx: ReportContext) -> DataFrame:
    """The scanned rows as stored rows with their key."""
    if spec.columns is not None:
        source = source.select(*[c for c in source.columns if c in spec.columns])
    rows = spec.shape(scan(spec, source, mark, ctx), ctx)
    rows = rows.distinct() if spec.distinct else rows
    return rows.select(business_key(spec.key()).alias(KEY), *rows.columns)


def can_match(spec: ReportSpec, mark, target: DataFrame) -> Column | None:
    """Target rows a batch can meet, or None for all.

    Where the key holds the time, none of them lies before the batch's start.
    Keys hold milliseconds, so the start is one too. Other keys, a query's id say,
    may come again with a later time and are compared with the whole history; of
    that only the key is read.
    """
    if mark is None or not spec.keyed_by_time:
        return None
    start: datetime | date = mark - spec.lookback if spec.lookback is not None else mark
    if isinstance(start, datetime):
        start = start.replace(microsecond=start.microsecond // 1000 * 1000)
    # NULL times never match a batch that was selected by time.
    return F.col(spec.time) >= time_literal(start, target.schema[spec.time].dataType)


def incremental_load(
    spec: ReportSpec,
    source: DataFrame,
    target: DataFrame | None,
    ctx: ReportContext,
    retain_days: int | None = None,
    mark=None,
    most: int | None = None,
) -> DataFrame:
    """The history table after the next batch: scan, key, merge, retention.

    ``mark`` is the target's watermark and ``most`` a bound of its rows, if they are known.
    """
    mark = watermark(spec, target) if mark is None else mark
    batch = next_batch(spec, source, mark, ctx)
    if target is None:
        # A first batch meets no rows, but an upsert still keeps one row per key.
        merged = latest_per_key(batch, [KEY], spec.newest_by) if spec.updates else batch
    elif spec.updates:
        merged = merge_upsert(
            batch, target, [KEY], spec.updates, spec.newest_by, can_match(spec, mark, target)
        )
    else:
        merged = merge_insert_only(batch, target, [KEY], can_match(spec, mark, target), most)
    return retention_delete(merged, spec.time, retain_days, ctx, spec.account)


def new_rows(spec: ReportSpec, source: DataFrame, target: DataFrame, ctx: ReportContext, mark=None) -> DataFrame:
    """Only the rows an insert-only batch adds, for appending to a stored table."""
    mark = watermark(spec, target) if mark is None else mark
    batch = next_batch(spec, source, mark, ctx)
    return unmatched(batch, target, [KEY], can_match(spec, mark, target)).select(*target.columns)
