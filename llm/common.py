"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import itertools
import os
import tempfile
import zipfile
from collections import defaultdict
from collections.abc import Callable, Hashable, Iterable, Iterator, Sequence

import pyarrow as pa
import usageledger
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usageledger.session import shared_dir, staged
from usageledger.sources.tables import table

__all__ = [
    "ascii_lower",
    "documents",
    "fresh",
    "id_text",
    "lean",
    "pages",
    "shared_dir",
    "ship",
    "small_table",
    "staged",
    "table",
    "uniform",
    "within",
    "WORD",
]

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


_shipped: set[str] = set()

#: Bytes of rows that a task hands to Python at once, where the session has Spark's own bound.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 2 << 20


def ship(spark: SparkSession) -> None:
    """Sends this package and the library to the executors' Python, once per application.

    Whole texts travel to Python, and a batch of them is held several times outside of
    an executor's heap. So the session's batches are bounded, unless it has a bound of
    its own; that changes no result.
    """
    if spark.conf.get(BATCH, None) == f"{64 << 20}b":
        spark.conf.set(BATCH, f"{BATCH_BYTES}b")
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "packages.zip")  # the driver serves it
    with zipfile.ZipFile(path, "w") as out:
        for package in (os.path.dirname(os.path.abspath(__file__)), os.path.dirname(os.path.abspath(usageledger.__file__))):
            for folder, _, names in os.walk(package):
                for name in sorted(n for n in names if n.endswith(".py")):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def lean(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A task that gives the memory it no longer needs back at its end; Python workers live on and hold it otherwise."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run


def small_table(spark: SparkSession, **columns: pa.Array) -> DataFrame:
    """A table of the few rows that the driver holds.

    It becomes part of the plan. A list of Python rows would be read through Python
    workers with a daemon of their own, which executors hold beside those of the tasks.
    """
    return spark.createDataFrame(pa.table(columns))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages")


def ascii_lower(c: Column) -> Column:
    """Lower case of A-Z alone; every other character stays."""
    return F.translate(c, _UPPER, _UPPER.lower())


def id_text(c: Column) -> Column:
    """An id as text; a missing id is the empty text."""
    return F.coalesce(c.cast("string"), F.lit(""))


def uniform(*parts: Column, salt: str) -> Column:
    """A number strictly between 0 and 1 that depends on the parts alone (52 bits of their MD5)."""
    digest = F.md5(F.concat_ws("\x1f", F.lit(salt), *[id_text(p) for p in parts]).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def within(rows: Sequence[tuple[Hashable, int]], characters: int) -> list[int]:
    """The places of (group, size) rows that hold at most ``characters`` together, in order.

    Groups have equal parts; what a group doesn't need of its own is shared by the
    larger ones. A row that doesn't fit is passed over, and rows passed over may
    use what is left when every group had its part.
    """
    groups = defaultdict(list)
    for k, (group, _) in enumerate(rows):
        groups[group].append(k)
    need = {g: sum(rows[k][1] for k in places) for g, places in groups.items()}
    left, spare, taken = characters, 0, set()
    for i, g in enumerate(sorted(groups, key=need.__getitem__)):
        part = min(need[g], left // (len(groups) - i))
        left -= part
        for k in groups[g]:
            if rows[k][1] <= part:
                part -= rows[k][1]
                taken.add(k)
        spare += part
    spare += left
    for k, (_, size) in enumerate(rows):
        if k not in taken and size <= spare:
            spare -= size
            taken.add(k)
    return sorted(taken)


def fresh(taken: Iterable[str], *wanted: str) -> list[str]:
    """Column names like the wanted ones that clash with no taken name, whatever its case."""
    used = {t.lower() for t in taken}
    out = []
    for name in wanted:
        candidates = (name if i == 0 else f"{name}_{i}" for i in itertools.count())
        found = next(c for c in candidates if c.lower() not in used)
        used.add(found.lower())
        out.append(found)
    return out
