"""Hashed business keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a missing key part is replaced by, and the part separator.
TEXT_SENTINEL = "~"
NUMBER_SENTINEL = "-9"
VERSION_SENTINEL = "-1"
SEPARATOR = "|"

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
DATE_FORMAT = "yyyy-MM-dd"


def text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(TEXT_SENTINEL))


def number(name: str, missing: str = NUMBER_SENTINEL) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(missing))


def moment(name: str) -> Column:
    """Timestamp rendered to milliseconds; missing times get the text sentinel."""
    return F.coalesce(F.date_format(F.col(name), TIMESTAMP_FORMAT), F.lit(TEXT_SENTINEL))


def day(name: str) -> Column:
    return F.coalesce(F.date_format(F.col(name), DATE_FORMAT), F.lit(TEXT_SENTINEL))


def business_key(parts: Sequence[Column]) -> Column:
    """20-byte SHA-1 of the parts joined by a pipe."""
    return F.unhex(F.sha1(F.concat_ws(SEPARATOR, *parts)))


def key_text(key: Column) -> Column:
    """The key as lower-case hex, for output."""
    return F.lower(F.hex(key))
