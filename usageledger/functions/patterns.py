"""Whole-string regular expression tests."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Patterns that refer to groups by number or name can't share an expression with others.
_REFERS = re.compile(r"\\[1-9k]|\(\?<[A-Za-z]")
#: Patterns that match one text only, themselves.
_PLAIN = re.compile(r"[\w \-\x00]*")


def whole(pattern: str) -> str:
    return rf"\A(?:{pattern})\z"


def full_match(value: Column, pattern: str) -> Column:
    """True when the pattern covers the whole value; NULL stays NULL."""
    return value.rlike(whole(pattern))


def full_match_column(value: Column, pattern: Column) -> Column:
    """As ``full_match`` with the pattern taken from a column."""
    return F.regexp_like(value, F.concat(F.lit(r"\A(?:"), pattern, F.lit(r")\z")))


def is_plain(pattern: str) -> bool:
    return _PLAIN.fullmatch(pattern) is not None


def alternations(patterns: Iterable[str], longest: int = 20_000) -> Iterator[str]:
    """The patterns as few expressions, each an alternation of about ``longest`` characters."""
    held: list[str] = []
    size = 0
    for p in patterns:
        if _REFERS.search(p):
            yield p
            continue
        if held and size + len(p) > longest:
            yield "|".join(held)
            held, size = [], 0
        held.append(f"(?:{p})")
        size += len(p) + 5
    if held:
        yield "|".join(held)
