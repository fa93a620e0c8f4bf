"""Key/value settings per account and region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usageledger.context import ReportContext


def config_lookup(settings: DataFrame, name: str, usage: str, account: str) -> DataFrame:
    """Highest value and account for a setting; always exactly one row."""
    return settings.filter(
        (F.col("var_name") == name) & (F.col("var_usage") == usage) & (F.col("account_locator") == account)
    ).agg(F.max("var_value").alias("var_value"), F.max("account_locator").alias("account_locator"))


def config_lookup_region(settings: DataFrame, name: str, usage: str, account: str, region: str) -> DataFrame:
    """The matching setting rows of one account in one region."""
    return settings.filter(
        (F.col("var_name") == name)
        & (F.col("var_usage") == usage)
        & (F.col("account_locator") == account)
        & (F.col("region_name") == region)
    ).select("account_locator", "region_name", "var_name", "var_value", "var_usage", "var_description")


def setting_value(settings: DataFrame, name: str, usage: str, ctx: ReportContext) -> str | None:
    """One setting of the caller's account; account, region, name, usage are its key."""
    rows = config_lookup_region(settings, name, usage, ctx.account, ctx.region).limit(1).collect()
    return rows[0]["var_value"] if rows else None


def retention_days(settings: DataFrame, usage: str, ctx: ReportContext) -> int | None:
    value = setting_value(settings, "DAYS_TO_RETAIN", usage, ctx)
    return None if value is None else int(value)


def attach_org_context(df: DataFrame, settings: DataFrame, ctx: ReportContext) -> DataFrame:
    """Add account, region and the configured organization to every row.

    Without an ORGANIZATION setting the result is empty, as with an inner join
    to the missing setting row.
    """
    organization = setting_value(settings, "ORGANIZATION", "GLOBAL", ctx)
    return stamp_context(df, ctx, organization).filter(F.lit(organization is not None))


def stamp_context(df: DataFrame, ctx: ReportContext, organization: str | None = None) -> DataFrame:
    """Add account, region and organization as literals: no join, no shuffle."""
    return df.withColumns(
        {
            "account_locator": F.lit(ctx.account),
            "region_name": F.lit(ctx.region),
            "organization_name": F.lit(ctx.organization if organization is None else organization),
        }
    )
