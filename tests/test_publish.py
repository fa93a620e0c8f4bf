import threading
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from usageledger.plans import loads
from usageledger.plans.publish import (
    DAY,
    OPEN,
    newest_stored,
    publish_swap,
    publish_truncate_insert,
    refresh_history,
    stored_counts,
    stored_keys,
    stored_watermark,
)
from usageledger.plans.spec import incremental_load
from usageledger import session
from usageledger.session import shared_dir
from test_loads import runs

T0 = datetime(2024, 2, 1, 10)
HOUR = timedelta(hours=1)


def test_swap_may_read_the_table_it_replaces(spark, tmp_path):
    where = str(tmp_path / "t")
    publish_swap(spark.range(3).select("id"), "swap_self", where)
    publish_swap(spark.table("swap_self").select((F.col("id") + 10).alias("id")), "swap_self", where)
    assert rows(spark.table("swap_self")) == [(10,), (11,), (12,)]
    publish_swap(spark.table("swap_self"), "swap_self", where)
    assert len(list((tmp_path / "t" / "swap_self").iterdir())) == 2  # the version before stays, the one before that is deleted


def test_a_reader_never_fails_and_never_sees_a_mixture(spark, tmp_path):
    """Twenty publishes of frames with a constant column, and in the middle other columns, under a reader that doesn't stop."""
    where, name = str(tmp_path / "t"), "swap_read"
    frame = lambda k: spark.range(200).select(F.lit(k).alias("k"), F.col("id").alias("own" if k % 7 else "other"))
    publish_swap(frame(0), name, where)
    done, seen, failed = threading.Event(), [], []

    def read():
        while not done.is_set():
            try:
                seen.append(tuple(spark.table(name).agg(F.min("k"), F.max("k"), F.count("k")).first()))
            except Exception as e:  # noqa: BLE001
                failed.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for k in range(1, 21):
            publish_swap(frame(k), name, where)
    finally:
        done.set()
        reader.join()
    assert not failed and len({k for k, _, _ in seen}) > 3
    assert all(low == high and n == 200 for low, high, n in seen)
    assert [k for k, _, _ in seen] == sorted(k for k, _, _ in seen)
    assert len(list((tmp_path / "t" / name).iterdir())) == 2


def test_two_names_share_a_folder(spark, tmp_path):
    where = str(tmp_path / "t")
    for k in range(3):
        publish_swap(spark.range(k + 1), "swap_left", where, keep=0)
        publish_swap(spark.range(10 * k + 10), "swap_right", where, keep=0)
    assert spark.table("swap_left").count() == 3 and spark.table("swap_right").count() == 30
    assert spark.sql("SHOW TABLES LIKE 'swap_left__*'").count() == 1


def test_a_plain_table_becomes_the_first_version(spark, tmp_path):
    spark.range(4).write.saveAsTable("swap_plain")
    got = publish_swap(spark.table("swap_plain").select((F.col("id") + 1).alias("id")), "swap_plain", str(tmp_path / "t"))
    assert rows(got) == [(1,), (2,), (3,), (4,)] and spark.table("swap_plain__plain").count() == 4


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    where = str(tmp_path / "t")
    publish_swap(spark.range(3).select("id"), "swap_fail", where)
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        publish_swap(broken, "swap_fail", where)
    assert spark.table("swap_fail").count() == 3


def test_swap_may_change_the_columns(spark, tmp_path):
    where = str(tmp_path / "t")
    publish_swap(spark.range(3).select("id"), "swap_columns", where)
    assert publish_swap(spark.range(2).select(F.lit("x").alias("v")), "swap_columns", where).columns == ["v"]


def test_truncate_insert_replaces_all_parts(spark, tmp_path):
    where = str(tmp_path / "t")
    publish_truncate_insert([spark.range(3), spark.range(4)], "parts", where)
    assert publish_truncate_insert([spark.range(1), spark.range(1)], "parts", where).count() == 2


def usage(spark, data):
    return spark.createDataFrame(
        [("d", "s", t, at, at + HOUR, 1.0) for t, at in data],
        "database_name string, schema_name string, table_name string, start_time timestamp_ntz, end_time timestamp_ntz, credits_used double",
    )


def test_stored_history_grows_by_new_rows_and_loses_expired_days(spark, ctx):
    spec, name = loads.AUTO_CLUSTERING, "stored_clustering"
    first = [("a", T0 - timedelta(days=25)), ("b", T0 - timedelta(days=20)), ("c", T0)]
    refresh_history(spark, spec, usage(spark, first), name, ctx, None)
    before = {f for f in spark.table(name).inputFiles()}
    more = first + [("c2", T0), ("d", T0 + 30 * HOUR)]
    got = refresh_history(spark, spec, usage(spark, more), name, ctx, None)
    assert rows(got, "table_name") == [("a",), ("b",), ("c",), ("c2",), ("d",)]
    assert before < set(spark.table(name).inputFiles())
    again = refresh_history(spark, spec, usage(spark, more), name, ctx, 30)
    assert rows(again, "table_name") == [("b",), ("c",), ("c2",), ("d",)]
    assert rows(again) == rows(incremental_load(spec, usage(spark, more), None, ctx, 30))
    assert DAY not in again.columns


def test_expired_rows_leave_a_day_that_others_still_need(spark, ctx):
    spec, name = loads.ORG_METERING, "stored_metering"
    at = datetime(2024, 1, 5, 3)
    df = spark.createDataFrame(
        [("O", "N", a, "R", 1, t) for a, t in (("ACC_0", at), ("ACC_1", at), ("ACC_0", T0))],
        "organization_name string, account_name string, account_locator string, region string, warehouse_id int, start_time timestamp_ntz",
    )
    refresh_history(spark, spec, df, name, ctx, None)
    got = refresh_history(spark, spec, df, name, ctx, 30)
    assert rows(got, "account_locator", "start_time") == [("ACC_0", T0), ("ACC_1", at)]


def test_stored_upsert_rewrites_recent_days_only(spark, ctx):
    name = "stored_tasks"
    old, recent = T0 - timedelta(days=5), T0 - 30 * HOUR
    refresh_history(spark, loads.TASK_HISTORY, runs(spark, [(1, "RUN", old, None), (2, "RUN", recent, None), (3, "RUN", T0, None)]), name, ctx)
    day_of = lambda f: f.split(f"{DAY}=")[1].split("/")[0]
    before = {day_of(f): f for f in spark.table(name).inputFiles()}
    now = runs(spark, [(1, "OK", old, T0), (2, "OK", recent, T0), (3, "OK", T0, T0 + HOUR), (4, "RUN", T0 + HOUR, None)])
    got = refresh_history(spark, loads.TASK_HISTORY, now, name, ctx)
    assert rows(got, "run_id", "state") == [(1, "RUN"), (2, "OK"), (3, "OK"), (4, "RUN")]
    after = spark.table(name).inputFiles()
    assert before[str(old.date())] in after and before[str(recent.date())] not in after


def queries(spark, data):
    return spark.createDataFrame([(i, "WH", at, 5) for i, at in data], "query_id bigint, warehouse_name string, start_time timestamp_ntz, execution_time bigint")


def test_a_key_without_time_is_found_without_a_shuffle_of_the_history(spark, ctx):
    name, at = "stored_queries", lambda d: T0 + timedelta(days=d)
    refresh_history(spark, loads.QUERY_HISTORY, queries(spark, [(i, at(-(i % 20)) - i // 50 * 10 * HOUR) for i in range(100)]), name, ctx, buckets=4)
    late = [(i, at(1)) for i in range(0, 100, 7)] + [(i, at(1)) for i in range(100, 110)] + [(105, at(1))]
    got = refresh_history(spark, loads.QUERY_HISTORY, queries(spark, late), name, ctx)
    assert sorted(r[0] for r in rows(got, "query_id")) == list(range(110))
    plan = stored_keys(spark.table(name), got.limit(5))._jdf.queryExecution().executedPlan().toString()
    left = plan[plan.index("ShuffledHashJoin") :].split("+- Exchange")[0]
    assert "FileScan" in left and "Bucketed: true" in left and "Exchange" not in left and "Sort" not in left
    # an expired part of a day is taken out of the buckets as well, and loads go on
    kept = refresh_history(spark, loads.QUERY_HISTORY, queries(spark, [(500, at(2))]), name, ctx, 25)
    assert min(t for (t,) in rows(kept, "start_time")) == datetime(2024, 1, 16, 10)
    again = refresh_history(spark, loads.QUERY_HISTORY, queries(spark, [(500, at(3)), (105, at(3)), (501, at(3))]), name, ctx)
    assert again.filter("query_id IN (500, 105, 501)").count() == 3
    assert {f.rsplit("_", 1)[1].split(".")[0] for f in spark.table(name).inputFiles()} <= {f"{k:05d}" for k in range(4)}


def test_the_stored_watermark_comes_from_the_newest_day(spark, ctx):
    name = "stored_newest"
    data = usage(spark, [("a", T0 - timedelta(days=25)), ("b", T0), ("c", T0 + HOUR)])
    refresh_history(spark, loads.AUTO_CLUSTERING, data, name, ctx)
    assert stored_watermark(spark, loads.AUTO_CLUSTERING, name) == T0 + HOUR
    refresh_history(spark, loads.MV_REFRESH, data, f"{name}_days", ctx)
    assert stored_watermark(spark, loads.MV_REFRESH, f"{name}_days") == datetime(2024, 2, 1)


def test_the_newest_rows_open_two_partitions(spark, ctx):
    """Twenty days of a hundred queries: the edge of the newest 150 is read from the counts."""
    name = "stored_counted"
    data = [(i, T0 - timedelta(days=i // 100) + timedelta(minutes=i % 100)) for i in range(2000)]
    refresh_history(spark, loads.QUERY_HISTORY, queries(spark, data[100:]), name, ctx, buckets=2)
    refresh_history(spark, loads.QUERY_HISTORY, queries(spark, data), name, ctx)
    counts = stored_counts(spark, name)
    assert counts.agg(F.sum("rows"), F.max("newest")).first() == (2000, max(t for _, t in data))
    got = newest_stored(spark, loads.QUERY_HISTORY, name, "query_id", 150)
    assert {i for (i,) in rows(got, "query_id")} == {i for i, _ in sorted(data, key=lambda r: (r[1], r[0]), reverse=True)[:150]}
    assert {f.split(f"{DAY}=")[1][:10] for f in got.inputFiles()} == {"2024-02-01", "2024-01-31"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert f"{DAY}" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_counts_follow_appends_rewrites_and_expired_days(spark, ctx):
    def exact(name, spec):
        stored = spark.table(name)
        hour = F.date_trunc("hour", F.col(spec.time)).cast("timestamp_ntz")
        return rows(stored.groupBy(DAY, hour.alias("hour")).agg(F.count(F.lit(1)).alias("rows"), F.max(spec.time).alias("newest")))

    spec, name = loads.AUTO_CLUSTERING, "counted_clustering"
    cutoff = datetime(2024, 1, 11)
    first = [("a", T0 - timedelta(days=25)), ("b", T0 - timedelta(days=20)), ("m", cutoff), ("c", T0), ("n", T0 + HOUR)]
    refresh_history(spark, spec, usage(spark, first), name, ctx)
    for more in ([*first, ("d", T0 + 2 * HOUR)], [*first, ("e", T0 + 30 * HOUR)]):
        refresh_history(spark, spec, usage(spark, more), name, ctx, 30)
        assert rows(stored_counts(spark, name), DAY, "hour", "rows", "newest") == exact(name, spec)
    task, name = loads.TASK_HISTORY, "counted_tasks"
    for k in range(3):
        refresh_history(spark, task, runs(spark, [(i, f"S{k}", T0 + (i - 3) * 20 * HOUR, None) for i in range(4 + k)]), name, ctx)
        assert rows(stored_counts(spark, name), DAY, "hour", "rows", "newest") == exact(name, task)


def test_counts_that_a_broken_load_left_are_made_anew(spark, ctx):
    spec, name = loads.AUTO_CLUSTERING, "counted_broken"
    refresh_history(spark, spec, usage(spark, [("a", T0 - timedelta(days=3)), ("b", T0)]), name, ctx)
    spark.sql(f"ALTER VIEW {name}__counts SET TBLPROPERTIES ('{OPEN}' = 'true')")
    assert stored_counts(spark, name) is None and stored_watermark(spark, spec, name) == T0
    refresh_history(spark, spec, usage(spark, [("c", T0 + HOUR)]), name, ctx)
    assert stored_counts(spark, name).agg(F.sum("rows")).first()[0] == 3 and stored_watermark(spark, spec, name) == T0 + HOUR


def test_written_state_goes_below_the_cluster_folder(spark, monkeypatch):
    settings = {}

    class Cluster:
        class sparkContext:
            master = "yarn"

        class conf:
            @staticmethod
            def get(key, default=None):
                return settings.get(key, default)

    with pytest.raises(RuntimeError):
        shared_dir(Cluster, "x")
    for master in ("yarn", "k8s://host", "spark://host:7077"):
        Cluster.sparkContext.master = master
        for base, scheme in (("hdfs:///shared/state/", "hdfs"), ("/shared/state/", "hdfs"), ("file:/shared/state/", "file"), ("/shared/state/", "file")):
            monkeypatch.setattr(session, "_scheme", lambda spark, path, scheme=scheme: scheme)
            settings.clear()
            settings["spark.checkpoint.dir"] = base
            if scheme == "file":
                with pytest.raises(RuntimeError, match="its own"):
                    shared_dir(Cluster, "x")
                settings["spark.usageledger.mounted"] = "true"
            assert shared_dir(Cluster, "x").startswith(f"{base}x-")
    monkeypatch.undo()
    assert session._scheme(spark, "file:/tmp") == session._scheme(spark, "/tmp") == "file"


class Far:
    """A session whose master says that it is a cluster's."""

    def __init__(self, spark, base):
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.checkpoint.dir": base}.get(key, default)

        class sparkContext:
            master = "spark://host:7077"
            applicationId = spark.sparkContext.applicationId
            defaultParallelism = 3

        self.conf, self.sparkContext, self._spark = conf, sparkContext, spark

    def __getattr__(self, name):
        return getattr(self._spark, name)


def test_a_mounted_folder_is_found_to_be_one(spark, tmp_path, monkeypatch):
    tried = []
    monkeypatch.setattr(session, "remove", lambda spark, path, gone=session.remove: (tried.append(path), gone(spark, path)))
    base = f"file://{tmp_path}/shared"
    for _ in range(3):
        assert shared_dir(Far(spark, base), "x").startswith(f"{base}/x-")
    assert len(tried) == 1 and list((tmp_path / "shared").iterdir()) == []
    assert shared_dir(Far(spark, str(tmp_path)), "x").startswith(f"{tmp_path}/x-")


def test_a_folder_that_rows_do_not_come_back_from_is_refused(spark, tmp_path):
    class Lossy(Far):
        """The driver finds the files of one executor only."""

        @property
        def read(self):
            class Reader:
                schema = staticmethod(lambda schema: Reader)
                parquet = staticmethod(lambda path: self._spark.read.parquet(path).filter("id % 3 = 0"))

            return Reader

    with pytest.raises(RuntimeError, match="its own of: 6 of 16 rows"):
        shared_dir(Lossy(spark, f"file://{tmp_path}/lossy"), "x")
    (tmp_path / "taken").write_text("a file")
    with pytest.raises(RuntimeError, match="its own"):
        shared_dir(Far(spark, f"file://{tmp_path}/taken"), "x")
