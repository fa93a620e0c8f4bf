"""Business meaning of database and warehouse names, with manual overrides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Name parts that tell what a resource is for.
STAGES = ("DEV_", "TEST_", "STAGE_", "PROD_")
EXPLORE, PROOF, LAB, PRODUCT, UTILITY, UNKNOWN, META = "ES", "POC", "LAB", "DP", "UTIL", "UNKNOWN", "META"

DATABASE_FIELDS = ("owner", "comment", "db_type", "env", "bu", "db_name")
WAREHOUSE_FIELDS = ("owner", "comment", "wh_type", "env", "bu", "db_name", "purpose")


def _kind(suffix: str, two_parts: str | None) -> Column:
    name, parts = F.col("name"), F.col("_parts")
    staged = F.startswith(name, F.lit(STAGES[0]))
    for stage in STAGES[1:]:
        staged = staged | F.startswith(name, F.lit(stage))
    kind = F.when(F.get(parts, F.lit(0)) == EXPLORE, EXPLORE)
    kind = kind.when(F.endswith(name, F.lit(f"_POC_{suffix}")), PROOF)
    kind = kind.when(F.endswith(name, F.lit(f"_LAB_{suffix}")), LAB)
    if two_parts is not None:
        kind = kind.when(F.size(parts) == 2, two_parts)
    return kind.when(staged, PRODUCT).otherwise(UNKNOWN)


def _by_kind(kind: str, system_name: str, **values: Column) -> Column:
    """Value by kind; the system catalog itself is META and the rest has none."""
    out = None
    for name, value in values.items():
        test = F.col(kind) == name
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.when(F.col("name") == system_name, META)


def _part(i: int) -> Column:
    return F.get(F.col("_parts"), F.lit(i))


def _proof_name() -> Column:
    """A proof of concept's name without its seven-letter ending, in words."""
    stem = F.expr("left(name, length(name) - 7)")
    return F.replace(stem, F.lit("_"), F.lit(" "))


def parse_database_names(listing: DataFrame, system_name: str = "SYSTEM") -> DataFrame:
    """db_type, env, bu and db_name of each listed database."""
    kinds = listing.withColumn("_parts", F.split("name", "_")).withColumn("db_type", _kind("DB", None))
    n = F.size("_parts")
    return kinds.select(
        "name",
        "owner",
        "comment",
        "db_type",
        _by_kind("db_type", system_name, ES=F.lit(EXPLORE), POC=F.lit(PROOF), LAB=F.lit(LAB), DP=_part(0)).alias("env"),
        _by_kind(
            "db_type", system_name, ES=_part(1), POC=F.lit(None).cast("string"), LAB=_part(0), DP=_part(1)
        ).alias("bu"),
        _by_kind(
            "db_type", system_name, ES=_part(2), POC=_proof_name(), LAB=_part(1), DP=F.when(n > 3, _part(2)).otherwise(_part(1))
        ).alias("db_name"),
    )


def parse_warehouse_names(listing: DataFrame, system_name: str = "SYSTEM") -> DataFrame:
    """wh_type, env, bu, db_name and purpose of each listed warehouse."""
    kinds = listing.withColumn("_parts", F.split("name", "_")).withColumn("wh_type", _kind("WH", UTILITY))
    n = F.size("_parts")
    before_last = F.get(F.col("_parts"), n - 2)
    return kinds.select(
        "name",
        "owner",
        "comment",
        "wh_type",
        _by_kind("wh_type", system_name, ES=F.lit(EXPLORE), POC=F.lit(PROOF), LAB=F.lit(LAB), DP=_part(0)).alias("env"),
        _by_kind(
            "wh_type", system_name, ES=_part(1), POC=F.lit(None).cast("string"), LAB=_part(0), DP=_part(1)
        ).alias("bu"),
        _by_kind(
            "wh_type", system_name, ES=_part(2), POC=_proof_name(), LAB=_part(1), DP=F.when(n >= 5, _part(2)).otherwise(_part(1))
        ).alias("db_name"),
        _by_kind(
            "wh_type", system_name, ES=_part(2), POC=_proof_name(), LAB=_part(1), DP=before_last, UTIL=before_last
        ).alias("purpose"),
    )


def override_coalesce(
    calculated: DataFrame, override: DataFrame, fields: Sequence[str], name: str = "name", out: str | None = None
) -> DataFrame:
    """Calculated fields, each replaced by its override where one is given."""
    fixes = override.select(name, *[F.col(f).alias(f"_o_{f}") for f in fields])
    return calculated.join(fixes, name, "left").select(
        F.col(name).alias(out or name), *[F.coalesce(F.col(f"_o_{f}"), F.col(f)).alias(f) for f in fields]
    )
