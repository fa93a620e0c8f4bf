from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
#: Columns whose names the operators use inside.
CLASHING = ("row_key", "fp", "key", "copies", "size", "kept", "range", "target", "lang_pred", "score", "root", "cut")


def documents_of(spark, rows):
    """A documents table of (doc_id, text[, lang[, source]]) rows, with further columns of clashing names."""
    from pyspark.sql import functions as F

    full = []
    for r in rows:
        doc_id, text, lang, source = [*r, None, None, None][:4]
        full.append((doc_id, text, lang, source, len(text) if text is not None else None))
    df = spark.createDataFrame(full, DOCS)
    return df.select("*", *[F.lit(7).alias(c) for c in CLASHING])


@pytest.fixture()
def docs(spark):
    return lambda rows: documents_of(spark, rows)
