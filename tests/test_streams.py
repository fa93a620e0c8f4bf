from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from usageledger.plans.snapshots import CONNECTOR_COLUMNS
from usageledger.streaming.loads import append_stream, connector_type_history, dedup_late, file_stream, history, parquet_stream

T0 = datetime(2024, 2, 1, 10)
SCHEMA = "id int, t timestamp_ntz, v string"


@pytest.fixture()
def arrive(spark, tmp_path):
    """Write rows as newly arrived files; returns the folder."""
    folder = str(tmp_path / "arrived")

    def write(*data):
        spark.createDataFrame([(i, T0 + timedelta(hours=h), v) for i, h, v in data], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        return folder

    return write


def stream(spark, folder, **kw):
    return parquet_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, **kw)


def test_each_key_lands_once_over_several_runs(spark, arrive, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    folder = arrive((1, 0, "a"), (1, 0, "a"), (2, 1, "b"))
    append_stream(stream(spark, folder), out, checkpoint, ["id"], "t")
    arrive((2, 1, "b"), (3, 2, "c"))
    append_stream(stream(spark, folder), out, checkpoint, ["id"], "t")
    append_stream(stream(spark, folder), out, checkpoint, ["id"], "t")
    assert rows(history(spark, out), "id", "v") == [(1, "a"), (2, "b"), (3, "c")]


def test_a_replayed_batch_replaces_itself(spark, arrive, tmp_path):
    out = str(tmp_path / "out")
    folder = arrive((1, 0, "a"), (2, 1, "b"))
    append_stream(stream(spark, folder), out, str(tmp_path / "cp1"), ["id"])
    append_stream(stream(spark, folder), out, str(tmp_path / "cp2"), ["id"])
    assert rows(history(spark, out), "id") == [(1,), (2,)]


def test_without_a_key_every_image_lands(spark, arrive, tmp_path):
    out = str(tmp_path / "out")
    append_stream(stream(spark, arrive((1, 0, "a"), (1, 0, "a"))), out, str(tmp_path / "cp"))
    assert history(spark, out).count() == 2


@pytest.mark.parametrize("slots", [1, 16])
def test_late_copies_are_dropped(spark, arrive, tmp_path, slots):
    out = str(tmp_path / "out")
    arrive((1, 0, "a"), (1, 0, "a"), (1, 0, "a"), (2, 1, "b"))
    folder = arrive((1, 0, "a"), (2, 1, "b"), (3, 2, "c"))
    source = stream(spark, folder, per_trigger=1).repartition(3)
    file_stream(dedup_late(source, ["id"], "t", timedelta(hours=36), slots), out, str(tmp_path / "cp"))
    assert rows(spark.read.parquet(out), "id", "v") == [(1, "a"), (2, "b"), (3, "c")]


def test_a_batch_reads_only_its_own_days(spark, arrive, tmp_path):
    """Other days of the history aren't even listed: one that can't be read does no harm."""
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    folder = arrive((1, 0, "a"), (2, 48, "b"))
    append_stream(stream(spark, folder), out, checkpoint, ["id"], "t")
    for f in (tmp_path / "out" / "part_day=2024-02-01").rglob("*.parquet"):
        f.write_bytes(b"broken")
    arrive((2, 48, "b"), (3, 49, "c"))
    append_stream(stream(spark, folder), out, checkpoint, ["id"], "t")
    assert rows(spark.read.parquet(f"{out}/part_day=2024-02-03"), "id") == [(2,), (3,)]


def test_stream_and_batch_agree(spark, arrive, tmp_path):
    out = str(tmp_path / "out")
    folder = arrive(*[(i % 40, i % 40, str(i % 40)) for i in range(200)])
    append_stream(stream(spark, folder), out, str(tmp_path / "cp"), ["id"], "t")
    assert rows(history(spark, out)) == rows(spark.read.parquet(folder).distinct())


def test_connector_history_keeps_images_within_retention(spark, ctx, tmp_path):
    folder = str(tmp_path / "changes")
    def image(i, kind, synced):
        return (i, "n", kind, "ga", T0, None, None, False, False, synced)

    kinds = ["string"] * 4 + ["timestamp_ntz"] * 3 + ["boolean"] * 2 + ["timestamp_ntz"]
    schema = ", ".join(f"{c} {k}" for c, k in zip(CONNECTOR_COLUMNS, kinds, strict=True))
    df = spark.createDataFrame([image("1", "old", T0), image("1", "new", T0), image("2", "x", T0 - timedelta(days=60))], schema)
    df.write.parquet(folder)
    args = (str(tmp_path / "out"), str(tmp_path / "cp"), ctx)
    got = connector_type_history(parquet_stream(spark, folder, df.schema), *args, 30)
    assert rows(got, "id", "type") == [("1", "new"), ("1", "old")]
    again = connector_type_history(parquet_stream(spark, folder, df.schema), *args, None)
    assert again.count() == 2 and again.filter(F.col("id") == "2").count() == 0  # the expired day is gone
