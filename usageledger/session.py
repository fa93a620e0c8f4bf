"""Session settings for local runs and the shared folder for written state."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("usageledger")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("USAGELEDGER_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="usageledger-")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its machine. A path of the machines' file
    systems, with a scheme or without, may be a folder mounted on all of them. So it is
    tried before it is first used there, unless ``spark.usageledger.mounted`` says that
    it is one, and refused when what tasks write isn't all there to be read.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = _local_base()
    elif not spark.sparkContext.master.startswith("local") and spark.conf.get("spark.usageledger.mounted", "false") != "true":
        if _scheme(spark, base) == "file":
            _require_mounted(spark, base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


#: (application, folder) of the folders that were found to be mounted on all machines.
_mounted: set[tuple[str, str]] = set()


def _require_mounted(spark: SparkSession, base: str) -> None:
    """Refuse a folder unless the rows that tasks on the executors there are write into it are all read back."""
    try:
        tried = (spark.sparkContext.applicationId, base)
        if tried in _mounted:
            return
        path = f"{base.rstrip('/')}/mounted-{uuid.uuid4().hex}"
        tasks = max(16, spark.sparkContext.defaultParallelism)
        spark.range(0, tasks, 1, tasks).write.parquet(path)
        found = spark.read.schema("id bigint").parquet(path).distinct().count()
        remove(spark, path)
    except Exception as e:
        raise RuntimeError(f"spark.checkpoint.dir is {base}, which can't be used, as when each machine of a cluster has its own: {e}") from e
    if found != tasks:
        raise RuntimeError(f"spark.checkpoint.dir is {base}, which each machine of a cluster has its own of: {found} of {tasks} rows were found again")
    _mounted.add(tried)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """df written to the shared folder and read back: computed once, and kept when executors are lost."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_with(df: DataFrame, purpose: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """As staged, and aggregates of the rows, taken while they are written."""
    seen = Observation()
    stored = staged(df.observe(seen, *[c.alias(name) for name, c in metrics.items()]), purpose)
    return stored, seen.get


def _store(spark: SparkSession, path: str):
    """The file system and path of a folder, wherever it is."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path


def _scheme(spark: SparkSession, path: str) -> str:
    """The kind of file system a path lies in; that of the cluster's default one without a scheme."""
    return _store(spark, path)[0].getScheme()


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _store(spark, path)
    return store.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all files in it, if it is there."""
    store, where = _store(spark, path)
    store.delete(where, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none when it is missing."""
    store, where = _store(spark, path)
    return sorted(f.getPath().getName() for f in store.listStatus(where) if f.isDirectory()) if store.exists(where) else []
