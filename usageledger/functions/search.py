"""Searching sorted arrays inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_place(longest: int, holds: Callable[[Column], Column]) -> Column:
    """The largest place from 1 to ``longest`` for which ``holds`` is true, 0 when there is none, found by halving.

    What holds for a place must hold for all places before it, and for none behind the
    end of what is searched.
    """
    if longest < 1:
        return F.lit(0)
    steps = [1 << k for k in range(longest.bit_length() - 1, -1, -1)]
    return F.aggregate(
        F.array(*[F.lit(k) for k in steps]),
        F.lit(0),
        lambda place, step: F.when((place + step <= longest) & holds(F.least(place + step, F.lit(longest))), place + step).otherwise(place),
    )
