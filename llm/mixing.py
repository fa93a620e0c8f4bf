"""Mixing sources to target weights by weighted sampling without replacement; DataFrame functions only.

Efraimidis and Spirakis: a document with quality weight w gets the exponential
key -ln(u)/w; the smallest keys of a source are a weighted sample of it. A
source's target is met by complete epochs first. For what remains, documents
are taken in the order of their keys while their sizes add up to it. Only
narrow rows are counted: sizes are summed by ranges of keys before the shuffle,
those sums are added up, and only the one range in which the budget ends is
sorted. The result is a cut key per source, which each document compares with
its own key, so neither texts nor a whole source are ever moved or sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.common import WORD, fresh, staged, uniform

#: Share of all words that the mix takes; a source gives at most so many times its own.
SHARE, MOST_EPOCHS = 1.5, 2
#: Weights of the sources in code point order, repeated.
WEIGHTS = (3, 1, 2)
#: Rows in a range of keys, on average.
RANGE_ROWS = 4096
#: Characters that lower a document's quality.
JUNK = "0123456789!#$%&*+/<=>?@[\\]^_`{|}~"
SALT = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality(text: Column) -> Column:
    """1 to 2: more for texts with fewer digits and symbols. Missing and empty texts: 1."""
    n = F.length(text)
    clean = F.length(F.translate(text, JUNK, ""))
    return F.coalesce(F.when(n > 0, 1.0 + clean / n), F.lit(1.0))


def source_targets(
    sizes: DataFrame, share: float = SHARE, most: int = MOST_EPOCHS, weights: Sequence[int] = WEIGHTS
) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row per source, null last.

    Water-filling in closed form. Sources are ordered by the level at which they
    reach their bound; the first prefix whose level lies below the next source's
    is the bounded one. A source without words has target 0.
    """
    by_source = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    weighted = sizes.withColumn("rank", F.row_number().over(by_source) - 1).withColumn("weight", weight)
    whole = W.partitionBy()
    order = W.orderBy(F.col("level"), F.col("rank"))
    before = order.rowsBetween(W.unboundedPreceding, -1)
    filled = (
        weighted.withColumn("bound", F.lit(most) * F.col("source_size"))
        .withColumn("level", F.col("bound") / F.col("weight"))
        .withColumn("all", F.sum("source_size").over(whole) * F.lit(share))
        .withColumn("left", F.col("all") - F.coalesce(F.sum("bound").over(before), F.lit(0)))
        .withColumn("sharing", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        # the water level if every source from here on shares what is left
        .withColumn("water", F.col("left") / F.col("sharing"))
        .withColumn("open", F.col("water") <= F.col("level"))
        .withColumn("final", F.min(F.when(F.col("open"), F.struct("level", "rank", "water"))).over(whole)["water"])
    )
    target = F.least(F.col("bound").cast("double"), F.coalesce(F.col("final") * F.col("weight"), F.col("bound").cast("double")))
    return filled.select("source", "source_size", target.alias("target"))


def _measured(docs: DataFrame, id_col: str, source: str, text: str, salt: str) -> DataFrame:
    """(doc_id, source, size, key) of every document; key is exponential with the quality as rate."""
    u = uniform(F.col(id_col), F.md5(F.col(text).cast("binary")), salt=salt)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        (-F.log(u) / quality(F.col(text))).alias("key"),
    )


def plan_mix(rows: DataFrame, share: float = SHARE, most: int = MOST_EPOCHS, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """(source, source_size, target, epochs, cut) from (source, size, key): one stored row per source.

    A document is taken ``epochs`` times, and once more when key <= cut. The cut
    is the largest key up to which the sizes, counting half of the last one, fit
    the remaining budget, so the words taken miss the target by at most half a
    document. Documents with equal keys are copies and fall on the same side.
    """
    stats = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    stats = staged(stats, "mix-sources")
    targets = source_targets(stats.select("source", "source_size"), share, most, weights)
    whole_epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goals = targets.join(stats.select(F.col("source").alias("s"), "n"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    goals = goals.withColumn("epochs", whole_epochs.cast("long"))
    goals = goals.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    goals = goals.withColumn("ranges", F.ceil(F.col("n") / F.lit(RANGE_ROWS)))
    goals = staged(goals, "mix-goals")

    # 1 - exp(-key) spreads keys over 0 to 1 with a density of at most the largest quality
    place = F.floor((1 - F.exp(-F.col("key"))) * F.col("ranges"))
    seen = F.col("r.source").eqNullSafe(F.col("g.source"))
    placed = rows.alias("r").join(goals.alias("g"), seen).select(
        "g.source", "g.rest", "r.size", "r.key", place.alias("range")
    )
    sums = placed.groupBy("source", "range").agg(F.sum("size").alias("words"), F.max("key").alias("top"), F.first("rest").alias("rest"))
    in_order = W.partitionBy("source").orderBy("range")
    ends = sums.withColumn("end", F.sum("words").over(in_order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    ends = ends.withColumn("below", F.max("top").over(in_order.rowsBetween(W.unboundedPreceding, -1)))
    crossed = ends.filter((F.col("end") > F.col("rest")) & (F.col("end") - F.col("words") <= F.col("rest")))
    crossed = staged(crossed.select("source", "range", (F.col("end") - F.col("words")).alias("start"), "below"), "mix-ranges")

    inside = placed.alias("p").join(
        crossed.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")) & (F.col("p.range") == F.col("c.range"))
    ).select("p.source", "p.rest", "p.size", "p.key", "c.start", "c.below")
    ties = inside.groupBy("source", "key").agg(
        F.sum("size").alias("size"), F.first("rest").alias("rest"), F.first("start").alias("start"), F.first("below").alias("below")
    )
    before = W.partitionBy("source").orderBy("key").rowsBetween(W.unboundedPreceding, -1)
    middle = F.col("start") + F.coalesce(F.sum("size").over(before), F.lit(0)) + F.col("size") / 2
    fits = ties.withColumn("middle", middle).withColumn("fits", F.col("middle") <= F.col("rest"))
    # below the crossed range everything is taken, up to the largest key there, whether or not a key inside it fits
    none = F.lit(-1.0)
    best = F.coalesce(F.max(F.when(F.col("fits"), F.col("key"))), F.first("below"), none)
    cuts = fits.groupBy("source").agg(best.alias("cut")).select(F.col("source").alias("s"), "cut")
    out = goals.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", "epochs", F.coalesce("cut", F.when(F.col("rest") > 0, F.lit(float("inf"))), none).alias("cut")
    )
    return staged(out, "mix-plan")


def mix_counts(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", salt: str = SALT) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    Null ids and texts are allowed: a null text has size 0, rows alike in id and
    text are taken alike. A null source is a source of its own, the last one. An
    empty table gives no rows. Documents without words are taken like others of
    their key and add nothing. The same rows give the same mix on every run.
    """
    rows = staged(_measured(docs, id_col, source, text, salt), "mix-rows")
    plan = plan_mix(rows)
    copies = F.col("epochs") + F.when(F.col("key") <= F.col("cut"), 1).otherwise(0)
    return (
        rows.alias("r")
        .join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")))
        .select("r.doc_id", "r.source", "r.size", "p.source_size", "p.target", copies.alias("copies"))
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def mix(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", salt: str = SALT) -> DataFrame:
    """The mixed documents with all their columns; a document taken twice is two rows.

    The plan has one row per source; each document finds its own number of
    copies where its text lies.
    """
    narrow = staged(_measured(docs, id_col, source, text, salt), "mix-rows")
    plan = plan_mix(narrow)
    key, copies, s, epochs, cut = fresh(docs.columns, "key", "copies", "plan_source", "epochs", "cut")
    u = uniform(F.col(id_col), F.md5(F.col(text).cast("binary")), salt=salt)
    keyed = docs.withColumn(key, -F.log(u) / quality(F.col(text)))
    goal = plan.select(F.col("source").alias(s), F.col("epochs").alias(epochs), F.col("cut").alias(cut))
    times = F.col(epochs) + F.when(F.col(key) <= F.col(cut), 1).otherwise(0)
    taken = keyed.join(goal, F.col(source).eqNullSafe(F.col(s))).withColumn(copies, times).filter(F.col(copies) > 0)
    repeated = taken.withColumn(copies, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies).cast("long"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
