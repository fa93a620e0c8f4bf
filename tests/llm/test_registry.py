"""The registered queries: names, contracts' columns, and SQL where there is some."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

import compare  # noqa: E402

import corpus_pipeline  # noqa: E402
from llm.queries import ORACLE, QUERIES  # noqa: E402

COLUMNS = {
    "op1_url_filter": "page_id host path rule verdict",
    "op2_chat": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op3_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op4_mix": "doc_id size source_size target taken",
    "op5_sketch": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op6_simhash_dedup": "doc_id fingerprint component_id",
    "op7_toxicity": "doc_id held_out score predicted",
    "op8_archive": "page_id payload_bytes payload_digest record_type refers_to",
    "op9_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op10_language_id": "doc_id held_out lang_pred score",
    "op11_hard_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op12_merkle_manifest": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "op13_ngram_join": "doc_id n_shingles component_id",
}


def test_names():
    import __spark_entry__ as contract

    assert set(COLUMNS) == set(QUERIES)
    assert {*COLUMNS, "pipeline"} <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_dedup", "mixing", "bpe"]


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, folder, name):
    assert set(COLUMNS[name].split()) <= set(QUERIES[name](spark, folder).columns)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, folder, name):
    df = QUERIES[name](spark, folder)
    got = compare.normalized(df.columns, df.collect())
    cursor = compare.duck(folder).execute(ORACLE[name])
    assert got == compare.normalized([c[0] for c in cursor.description], cursor.fetchall())
