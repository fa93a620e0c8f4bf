"""A corpus from the documents table: known languages, one copy of each text, sources mixed, tokens.

Every stage but the last returns the columns of ``documents``; each is written
as Parquet and read again by the next. An empty table passes through every
stage; extra columns are carried to the last one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from llm import bpe, exact_dedup, langid, mixing, simhash
from llm.common import documents, staged
from llm.queries import VOCABULARY

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language is determined; texts without letters go."""
    return langid.with_known_language(docs)


def one_of_equals(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group that is equal but for white space."""
    return exact_dedup.exact_dedup(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group linked by fingerprints that differ in at most four bits."""
    return simhash.near_dedup(docs)


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Sources at their target weights; a document taken twice is two rows."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every row, packed, with their number and digests."""
    return bpe.encode_documents(docs, VOCABULARY, packed=True, remembered=100_000)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("exact_dedup", one_of_equals),
    ("simhash_dedup", one_of_near_copies),
    ("mixing", mixed),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: A trained model and a tokenizer can't be written as SQL; tests/llm holds the stages against brute force.
ORACLE_SQL: str | None = None

QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
