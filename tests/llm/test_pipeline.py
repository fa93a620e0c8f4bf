"""Each stage against brute force on its own input, and the whole on odd rows."""

from collections import Counter

import corpus_pipeline
import pytest
import test_bpe
import test_exact_dedup
import test_simhash
from llm_helpers import docs  # noqa: F401

from llm import exact_dedup, mixing, simhash
from llm.common import documents, staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, folder):
    df = documents(spark, folder)
    rows = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows[name] = [(r.doc_id, r.text) for r in df.collect()]
        before, df = df, staged(stage(spark, df, folder), name)
        rows[name + "_out"] = [(r.doc_id, r.text) for r in df.collect()]
        assert df.columns == COLUMNS and set(rows[name + "_out"]) <= set(rows[name])
        if name == "mixing":
            want = Counter({r.doc_id: r.copies for r in mixing.mix_counts(before).collect() if r.copies})
    assert len(rows["language_id_out"]) >= 0.97 * len(rows["language_id"])
    keep = {k for _, k, _ in test_exact_dedup.brute(rows["exact_dedup"])}
    assert sorted(i for i, _ in rows["exact_dedup_out"]) == sorted(keep)
    stays = {c for *_, c in test_simhash.brute_components(rows["simhash_dedup"])}
    assert sorted(i for i, _ in rows["simhash_dedup_out"]) == sorted(stays)
    assert Counter(i for i, _ in rows["mixing_out"]) == want
    test_bpe.check(rows["mixing_out"], corpus_pipeline.STAGES[-1][1](spark, df, folder).collect())


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "input_ids"] and out.count() > 0


def test_odd_and_empty_tables(spark, docs, folder):  # noqa: F811
    rows = [(i, f"the house number {i} stands with water and the people", "en", f"s{i % 3}") for i in range(40)]
    rows += [(i, f"der haus nummer {i} und die leute mit wasser", "de", None) for i in range(40, 80)]
    rows += [(90, None, "en", "s1"), (91, "", None, "s1"), (None, "the house of nobody", "en", "s2"), (5, rows[5][1], "en", "s1"), (92, "12 34", "en", "s0")]
    for df in (docs(rows), docs([])):
        before = df.count()
        columns = df.columns
        for name, stage in corpus_pipeline.STAGES:
            df = staged(stage(spark, df, folder), name)
            if name != "bpe":
                assert df.columns == columns
        assert df.count() <= 2 * before


@pytest.mark.parametrize("dedup", [exact_dedup.exact_dedup, simhash.near_dedup])
def test_rows_keep_their_number_when_files_are_split_otherwise(spark, docs, tmp_path, dedup):  # noqa: F811
    rows = [(i, " ".join(f"w{i // 2}x{k}" for k in range(60))) for i in range(80)]
    docs(rows).repartition(8).write.parquet(str(tmp_path / "docs"))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")  # a partition for each file, then fewer
        out = dedup(spark.read.parquet(str(tmp_path / "docs")))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
        assert sorted(r.doc_id for r in out.collect()) == list(range(0, 80, 2))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
