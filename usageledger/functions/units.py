"""Storage units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GIB = 1024.0**3


def bytes_to_gib(size: Column, digits: int | None = None, mode: str = "exact") -> Column:
    """Bytes as GiB: ``exact``, or ``round``/``floor`` at ``digits`` decimals."""
    gib = size.cast("double") / F.lit(GIB)
    if mode == "exact":
        return gib
    if mode == "round":
        return F.round(gib, digits or 0)
    if mode == "floor":
        scale = float(10 ** (digits or 0))
        return F.floor(gib * F.lit(scale)).cast("double") / F.lit(scale)
    raise ValueError(f"unknown mode {mode!r}")
