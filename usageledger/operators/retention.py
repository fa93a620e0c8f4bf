"""Dropping history that is past its retention time."""

from __future__ import annotations

from datetime import datetime, time, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usageledger.context import ReportContext
from usageledger.functions.times import time_literal


def retention_cutoff(ctx: ReportContext, days: int) -> datetime:
    return datetime.combine(ctx.today - timedelta(days=days), time())


def retention_delete(
    df: DataFrame,
    column: str,
    days: int | None,
    ctx: ReportContext,
    account: str | None = "account_locator",
) -> DataFrame:
    """Keep rows newer than the cutoff, of other accounts, or without a time.

    No setting (``days=None``) deletes nothing.
    """
    if days is None:
        return df
    cutoff = time_literal(retention_cutoff(ctx, days), df.schema[column].dataType)
    keep = (F.col(column) > cutoff) | F.col(column).isNull()
    if account is not None:
        keep = keep | F.col(account).isNull() | (F.col(account) != F.lit(ctx.account))
    return df.filter(keep)
