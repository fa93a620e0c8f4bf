"""Exact dedup by recipes of content-defined chunks; DataFrame functions only.

A text is normalised by deleting ASCII white space and cut where its own
characters say so, so equal stretches of different texts give equal chunks. A
chunk becomes a 64-bit identifier. The identifiers are verified once over all
distinct chunks: should two chunks with different SHA-256 digests and lengths
share an identifier, each gets an ordinal of its own. A document is then only
its recipe, the ordered list of verified identifiers, and documents are equal
when their recipes are. Text is read where it lies and never shuffled; what
moves are digests of distinct chunks and recipes (8 bytes per chunk).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import fresh, staged

#: Shortest and longest chunk in characters; the last chunk of a text may be shorter.
SHORTEST, LONGEST = 512, 8192
#: Where the letters of other scripts begin and how many there are: Latin beyond the first 256 characters, Greek, Cyrillic,
#: Hebrew, Arabic, Devanagari, Thai, the two kana, Chinese characters (from the middle on, the common ones come first) and Hangul.
LETTERS = (
    (0x100, 0x80), (0x3B1, 0x19), (0x430, 0x20), (0x5D0, 0x1B), (0x627, 0x24), (0x905, 0x35), (0xE01, 0x2E),
    (0x3041, 0x56), (0x30A1, 0x5A), (0x8140, 0x5200), (0xAC00, 0x2BA4),
)
#: A cut falls behind two neighbours of this class: of the first 256 characters those whose code is 3 modulo 8, and the
#: first eighth of each other script's letters.
CUT_CLASS = (
    "["
    + "".join(f"\\x{{{c:x}}}" for c in range(0x23, 0x100) if c % 8 == 3)
    + "".join(f"\\x{{{a:x}}}-\\x{{{a + n // 8:x}}}" for a, n in LETTERS)
    + "]"
)
WHITE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for c in WHITE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def chunks(norm: Column, shortest: int = SHORTEST, longest: int = LONGEST) -> Column:
    """The text cut into content-defined chunks; joined they are the text again."""
    cut = f"(?s).{{{shortest - 2},{longest - 2}}}?{CUT_CLASS}{{2}}|.{{1,{longest}}}"
    return F.regexp_extract_all(norm, F.lit(cut), F.lit(0))


def recipes(docs: DataFrame, row: str, text: str = "text") -> DataFrame:
    """(row, n_chars, text_sha256, recipe) of every row, stored in the shared folder."""
    norm = docs.select(
        F.col(row), F.coalesce(F.length(text), F.lit(0)).alias("n_chars"), normalised(F.col(text)).alias("norm")
    )
    cut = norm.select(
        row,
        "n_chars",
        F.sha2("norm", 256).alias("text_sha256"),
        F.transform(
            chunks(F.col("norm")),
            lambda c: F.struct(F.xxhash64(c).alias("id"), F.unhex(F.sha2(c, 256)).alias("digest"), F.length(c).alias("size")),
        ).alias("cut"),
    )
    cut = staged(cut, "recipes")
    clashes = _clashes(cut)
    plain = F.transform("cut", lambda c: c["id"])
    if clashes is None:
        return cut.select(row, "n_chars", "text_sha256", plain.alias("recipe"))
    return _with_ordinals(cut, clashes, row)


def _clashes(cut: DataFrame) -> DataFrame | None:
    """(id, digest, size, ordinal) of chunks whose identifier belongs to several chunks; None when there are none.

    One pass of partial aggregation over (identifier, digest) pairs; the digests
    of a chunk with many copies are combined before the shuffle.
    """
    chunk = cut.select(F.explode("cut").alias("c")).select("c.id", "c.digest", "c.size")
    distinct = chunk.distinct()
    shared = distinct.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    found = staged(shared.select("id"), "chunk-clashes")
    if found.isEmpty():
        return None
    several = distinct.join(found, "id", "left_semi")
    order = F.sort_array(F.collect_list(F.struct("digest", "size")))  # as many as share a 64-bit hash
    ranked = several.groupBy("id").agg(order.alias("all")).select("id", F.posexplode("all").alias("ordinal", "c"))
    return ranked.select("id", "c.digest", "c.size", "ordinal")


def _with_ordinals(cut: DataFrame, clashes: DataFrame, row: str) -> DataFrame:
    """Recipes in which every identifier is followed by its ordinal among the chunks that share it."""
    one = cut.select(row, "n_chars", "text_sha256", F.posexplode_outer("cut").alias("at", "c"))
    one = one.select(row, "n_chars", "text_sha256", "at", "c.id", "c.digest", "c.size")
    named = one.join(clashes, ["id", "digest", "size"], "left")
    pair = F.struct("at", "id", F.coalesce("ordinal", F.lit(0)).cast("long").alias("ordinal"))
    gathered = named.groupBy(row, "n_chars", "text_sha256").agg(
        F.sort_array(F.collect_list(F.when(F.col("at").isNotNull(), pair))).alias("parts")
    )
    flat = F.flatten(F.transform("parts", lambda p: F.array(p["id"], p["ordinal"])))
    return gathered.select(row, "n_chars", "text_sha256", flat.alias("recipe"))


def dedup_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", row: str = "row_key") -> DataFrame:
    """One row per document: row, doc_id, keep_id, keep_row, group_size, kept, text_sha256.

    ``docs`` must have a column ``row`` that tells its rows apart. Of equal texts
    the row with most code points in the original text stays, then the smallest
    id (a missing id counts as larger than any), then the smallest row, so that
    exactly one of repeated rows stays. Null and blank texts are equal to the
    empty text. An empty table gives no rows. Groups are counted before the
    shuffle; a group that holds much of the table costs one row per task.
    """
    key = docs.select(F.col(row), F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    both = recipes(key.withColumn("id_and_row", F.struct(F.col(row).alias("row"), "doc_id")), "id_and_row")
    one = staged(
        both.select(
            F.col("id_and_row.row").alias(row),
            F.col("id_and_row.doc_id").alias("doc_id"),
            "n_chars",
            "text_sha256",
            F.xxhash64("recipe").alias("recipe_hash"),
            "recipe",
        ),
        "recipe-rows",
    )
    best = F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id", row))
    groups = one.groupBy("recipe_hash", "recipe").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    groups = staged(groups, "recipe-groups").select(
        "recipe_hash",
        "recipe",
        "group_size",
        F.col("best.doc_id").alias("keep_id"),
        F.col(f"best.{row}").alias("keep_row"),
    )
    kept = (F.col(row) == F.col("keep_row")).alias("kept")
    return one.join(groups, ["recipe_hash", "recipe"]).select(
        row, "doc_id", "keep_id", "keep_row", "group_size", kept, "text_sha256"
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; see dedup_groups for which do.

    Rows are numbered once and stored with their numbers, as a second scan may be
    split otherwise and number them anew. The list that travels back to the texts
    names the rows that go, not the texts.
    """
    (row,) = fresh(docs.columns, "row_key")
    numbered = staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    gone = staged(dedup_groups(numbered, id_col, text, row).filter(~F.col("kept")).select(row), "repeats")
    return numbered.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
