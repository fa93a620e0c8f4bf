"""Joining a large side to a smaller one when a few keys hold most rows.

A side is broadcast only after its rows were counted, against a bound in bytes. Beyond the bound the join
shuffles, and the rows of very frequent keys are spread over several tasks while
the matching rows of the other side are repeated once per slot. Nothing is
dropped: every row meets exactly the partners it meets in the plain join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usageledger.session import staged

#: A side of at most so many bytes, by its schema, may be broadcast.
BROADCAST_BYTES = 32 << 20
#: What a text or another value of no fixed size counts as, in bytes.
TEXT_BYTES = 64
#: A key with more bytes of rows than this, by their schema, is spread over several tasks.
HOT_BYTES = 128 << 20

_SLOT, _FAN, _ROWS = "_slot", "_fan", "_rows"


def row_bytes(df: DataFrame) -> int:
    """Bytes of a row as far as the schema tells: numbers and times by their type, others as TEXT_BYTES."""
    fixed = {"boolean": 1, "int": 4, "date": 4, "float": 4, "decimal": 16}
    return 8 + sum(
        8 if t in ("bigint", "double", "timestamp", "timestamp_ntz") else fixed.get(t.split("(")[0], TEXT_BYTES) for _, t in df.dtypes
    )


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether df has at most max_bytes; counts no more rows than needed to tell."""
    most = max_bytes // row_bytes(df)
    if most <= 0:
        return False
    return df.select(F.lit(1).alias("one")).limit(most + 1).count() <= most


def hot_rows_of(facts: DataFrame) -> int:
    return max(1, HOT_BYTES // row_bytes(facts))


def hot_keys(facts: DataFrame, on: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys with more than hot_rows rows, and over how many slots each is spread.

    One pass of partial counts, written to the shared folder so that the joins
    do not count again. There may be any number of them: as a stored table their
    size is known, and Spark broadcasts the list or joins it by a shuffle.
    """
    counts = facts.groupBy(*on).agg(F.count(F.lit(1)).alias(_ROWS)).filter(F.col(_ROWS) > hot_rows)
    return staged(counts, "hot-keys").select(*on, F.ceil(F.col(_ROWS) / F.lit(hot_rows)).cast("int").alias(_FAN))


def _into_slots(facts: DataFrame, hot: DataFrame, on: Sequence[str], place: Column) -> DataFrame:
    slot = F.coalesce(F.pmod(place, F.col(_FAN)).cast("int"), F.lit(0))
    return facts.join(hot, list(on), "left").withColumn(_SLOT, slot).drop(_FAN)


def _for_each_slot(dim: DataFrame, hot: DataFrame, on: Sequence[str]) -> DataFrame:
    slots = F.sequence(F.lit(0), F.coalesce(F.col(_FAN), F.lit(1)) - 1)
    return dim.join(hot, list(on), "left").withColumn(_SLOT, F.explode(slots)).drop(_FAN)


def skew_safe_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    spread_by: Sequence[str] | None = None,
    small: bool | None = None,
    hot: DataFrame | None = None,
    max_bytes: int = BROADCAST_BYTES,
    hot_rows: int | None = None,
) -> DataFrame:
    """Inner, left or left anti equi join of facts to dim.

    ``spread_by`` names fact columns that differ between rows of one key (a row
    id); without it rows are spread by the input partition they come from, since
    copies of a row have nothing else to tell them apart. Both give a row the
    same slot again when its task is run again after a lost executor. ``small``
    tells that dim was already found to fit a broadcast, or not, and ``hot`` are
    the facts' hot keys if they are known.
    """
    if how not in ("inner", "left", "left_anti"):
        raise ValueError(f"cannot spread a {how} join")
    on = list(on)
    if fits_broadcast(dim, max_bytes) if small is None else small:
        return facts.join(F.broadcast(dim), on, how)
    if hot is None:
        hot = hot_keys(facts, on, hot_rows or hot_rows_of(facts))
    place = F.spark_partition_id() if spread_by is None else F.xxhash64(*spread_by)
    spread = _into_slots(facts, hot, on, place)
    return spread.join(_for_each_slot(dim, hot, on), [*on, _SLOT], how).drop(_SLOT)


def skew_safe_anti(
    rows: DataFrame,
    seen: DataFrame,
    on: Sequence[str],
    max_bytes: int = BROADCAST_BYTES,
    hot_rows: int | None = None,
    most: int | None = None,
) -> DataFrame:
    """Rows whose key is not in seen, which has at most ``most`` rows if that is known."""
    keys = seen.select(*on)
    small = (most is not None and most <= max_bytes // row_bytes(keys)) or fits_broadcast(keys, max_bytes)
    return skew_safe_join(
        rows, keys if small else keys.distinct(), on, "left_anti", small=small, max_bytes=max_bytes, hot_rows=hot_rows
    )
