"""Keeping the access map in step with its desired state and with grants."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usageledger.functions.keys import business_key, text
from usageledger.operators.merge import merge_insert_only

KEY = ("account", "role")
VALUES = ("warehouse", "database")
# Roles that never get patterns from grants.
SYSTEM_ROLES = ("SECURITYADMIN", "ACCOUNTADMIN", "SYSADMIN", "USERADMIN", "ORGADMIN")


class DuplicateKeys(ValueError):
    """The desired state names a key more than once."""


def duplicate_key_check(df: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Keys that occur more than once; missing parts are equal to each other."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def require_unique_keys(df: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    repeated = duplicate_key_check(df, key).limit(20).collect()
    if repeated:
        raise DuplicateKeys(f"keys listed more than once: {[tuple(r)[:-1] for r in repeated]}")
    return df


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def snapshot_diff(
    desired: DataFrame, current: DataFrame, key: Sequence[str] = KEY, values: Sequence[str] = VALUES
) -> DataFrame:
    """Changes that turn current into desired: change_type, key, desired and current values.

    Missing key parts match each other, and a missing value equals a missing value.
    """
    d = desired.select(*key, *values, F.lit(True).alias("_in")).alias("d")
    c = current.select(*key, *values, F.lit(True).alias("_in")).alias("c")
    joined = d.join(c, _all(F.col(f"d.{k}").eqNullSafe(F.col(f"c.{k}")) for k in key), "full_outer")
    in_d, in_c = F.col("d._in").isNotNull(), F.col("c._in").isNotNull()
    same = _all(F.col(f"d.{v}").eqNullSafe(F.col(f"c.{v}")) for v in values)
    change = F.when(in_d & ~in_c, "insert").when(in_c & ~in_d, "delete").when(~same, "update")
    return joined.select(
        change.alias("change_type"),
        *[F.when(in_d, F.col(f"d.{k}")).otherwise(F.col(f"c.{k}")).alias(k) for k in key],
        *[F.col(f"d.{v}").alias(v) for v in values],
        *[F.col(f"c.{v}").alias(f"current_{v}") for v in values],
    ).filter(F.col("change_type").isNotNull())


def access_map_reconcile(desired: DataFrame, current: DataFrame) -> DataFrame:
    """Changes to the access map; fails when the desired state repeats a key.

    The result only describes changes. Applying them is ``apply_changes``.
    """
    return snapshot_diff(require_unique_keys(desired), current)


def apply_changes(current: DataFrame, changes: DataFrame) -> DataFrame:
    """The access map after the changes."""
    gone = changes.filter(F.col("change_type") != "insert").select(*[F.col(k).alias(f"_{k}") for k in KEY])
    kept = current.join(gone, _all(F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEY), "left_anti")
    written = changes.filter(F.col("change_type") != "delete").select(*KEY, *VALUES)
    return kept.select(*KEY, *VALUES).unionByName(written)


def grants_to_patterns(grants: DataFrame, role_tags: DataFrame) -> DataFrame:
    """Access map rows of workspace roles, made from the objects granted to them.

    A role's databases become one pattern ``(A)|(B)``, its warehouses another, each
    name quoted so that it matches itself alone. A pattern is one cell and holds
    the names of all objects granted to the role, as long as that may be.
    Objects are made distinct before they are joined into a pattern, so several
    privileges on one object do not repeat it.
    """
    workspace = F.upper(F.get_json_object("tags", "$.workspace_name"))
    roles = (
        role_tags.filter((F.col("type") == "ROLE") & workspace.isNotNull())
        .select(F.upper("id").alias("role"))
        .filter(~F.col("role").isin(list(SYSTEM_ROLES)))
        .distinct()
    )
    objects = (
        grants.filter(F.col("granted_on").isin("DATABASE", "WAREHOUSE"))
        .select(F.col("grantee_name").alias("role"), "granted_on", "name")
        .distinct()
        .join(roles, "role", "left_semi")
    )

    quoted = F.regexp_replace("name", r"([\\^$.|?*+()\[\]{}])", r"\\$1")

    def alternatives(kind: str) -> Column:
        names = F.sort_array(F.collect_set(F.when(F.col("granted_on") == kind, quoted)))
        return F.when(F.size(names) > 0, F.concat(F.lit("("), F.array_join(names, ")|("), F.lit(")")))

    return objects.groupBy("role").agg(
        alternatives("WAREHOUSE").alias("warehouse"), alternatives("DATABASE").alias("database")
    ).select(F.lit(None).cast("string").alias("account"), "role", "warehouse", "database")


def access_map_refresh(current: DataFrame, derived: DataFrame) -> DataFrame:
    """The access map with derived rows it does not hold yet."""
    columns = [*KEY, *VALUES]
    keyed = lambda df: df.select(business_key([text(c) for c in columns]).alias("sh_key"), *columns)
    return merge_insert_only(keyed(derived), keyed(current)).select(*columns)


def reconcile_access_map(
    desired: DataFrame, current: DataFrame, grants: DataFrame | None = None, role_tags: DataFrame | None = None
) -> DataFrame:
    """The access map after all steps: check and compare the desired state, apply the changes, add derived rows.

    The desired state comes from a file read with ``access_map_csv``. A repeated
    key in it stops everything before anything is changed.
    """
    applied = apply_changes(current, access_map_reconcile(desired, current))
    if grants is None or role_tags is None:
        return applied
    return access_map_refresh(applied, grants_to_patterns(grants, role_tags))
