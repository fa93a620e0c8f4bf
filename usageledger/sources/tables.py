"""Table and file readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usageledger.session import staged

ACCESS_MAP_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("account", "role", "warehouse", "database")]
)


#: Schemas of the given tables, so that opening one starts no job to infer them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def access_map_csv(spark: SparkSession, path: str) -> DataFrame:
    """The desired access map; empty cells are missing values. Names keep their case."""
    df = spark.read.schema(ACCESS_MAP_SCHEMA).option("header", True).option("enforceSchema", True).csv(path)
    return df.select(*[F.when(F.col(c) != "", F.col(c)).alias(c) for c in df.columns])


class MalformedRows(ValueError):
    """A file has rows that can't be read."""


#: The column of a row's text in the file, where the row can't be read.
BAD_ROW = "bad_row"


def access_map_rows(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The rows of a desired access map that can be read, and the texts (bad_row) of those that can't.

    A row is bad when it has too few or too many cells or a quote that isn't closed.
    Bad rows are set apart, never guessed at; empty cells are missing values. The file
    is parsed once and what came of it is stored.
    """
    schema = T.StructType([*ACCESS_MAP_SCHEMA.fields, T.StructField(BAD_ROW, T.StringType())])
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", True)
    parsed = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_ROW).csv(path)
    parsed = staged(parsed, "access-map-rows")
    cells = [F.when(F.col(c) != "", F.col(c)).alias(c) for c in ACCESS_MAP_SCHEMA.fieldNames()]
    return parsed.filter(F.col(BAD_ROW).isNull()).select(*cells), parsed.filter(F.col(BAD_ROW).isNotNull()).select(BAD_ROW)


def well_formed_access_map(spark: SparkSession, path: str) -> DataFrame:
    """The desired access map of a file; refused with the number of bad rows and the first of them."""
    good, bad = access_map_rows(spark, path)
    count = bad.count()
    if count:
        first = [r[BAD_ROW] for r in bad.limit(5).collect()]
        raise MalformedRows(f"{count} rows can't be read, such as {first}")
    return good


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same columns."""
    return df.sparkSession.createDataFrame([], df.schema)
