"""Tags of databases and warehouses as columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usageledger.operators.names import override_coalesce

# The tags that become columns, in report order.
TAGS = (
    "BUSINESS_UNIT",
    "COST_CENTRE",
    "BUSINESS_DIVISION",
    "PRODUCT_TYPE",
    "PRODUCT_NAME",
    "PURPOSE",
    "ENVIRONMENT",
)
FIELDS = tuple(t.lower() for t in TAGS)


TAG_IDENTITY = ("tag_database", "tag_schema", "tag_name")


def tag_pivot(references: DataFrame, existing_tags: DataFrame | None = None) -> DataFrame:
    """One row per live tagged object with a column per known tag.

    The list of tags is fixed, so this is a conditional aggregation. Objects
    that carry only other tags stay, with empty columns. With ``existing_tags``
    references to tags that were dropped do not count.
    """
    if existing_tags is not None:
        references = references.join(existing_tags.select(*TAG_IDENTITY), list(TAG_IDENTITY), "left_semi")
    live = references.filter(F.col("object_deleted").isNull() & F.col("domain").isin("DATABASE", "WAREHOUSE"))
    return (
        live.groupBy("object_name", F.col("domain").alias("object_type"))
        .agg(*[F.max(F.when(F.col("tag_name") == t, F.col("tag_value"))).alias(t.lower()) for t in TAGS])
        .withColumn("is_resolved", F.lit(True))
    )


def tag_unresolved(listing: DataFrame, pivoted: DataFrame) -> DataFrame:
    """Listed objects without tags. Databases shared by others have an origin and are left out."""
    owned = listing.filter((F.col("object_type") != "DATABASE") | (F.col("origin") == ""))
    names = owned.select("object_name", "object_type").distinct()
    empty = [F.lit(None).cast("string").alias(f) for f in FIELDS]
    return names.join(pivoted.select("object_name", "object_type"), ["object_name", "object_type"], "left_anti").select(
        "object_name", "object_type", *empty, F.lit(False).alias("is_resolved")
    )


def tag_metadata(references: DataFrame, listing: DataFrame, existing_tags: DataFrame | None = None) -> DataFrame:
    """Resolved and unresolved objects together."""
    pivoted = tag_pivot(references, existing_tags)
    return pivoted.unionByName(tag_unresolved(listing, pivoted))


def tag_override(metadata: DataFrame, override: DataFrame, object_type: str, out: str) -> DataFrame:
    """Tag columns of one kind of object with manual overrides."""
    return override_coalesce(
        metadata.filter(F.col("object_type") == object_type), override, FIELDS, "object_name", out
    )
