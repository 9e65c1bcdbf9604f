"""Parquet scans with stated schemas: no footer inference over many files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamReader

SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(table_path(folder, name))


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same table as a stream. The pattern lets it be one file or a folder of files."""
    return spark.readStream.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parque[t]")


def at_most(stream: DataStreamReader, files: int | None) -> DataStreamReader:
    """A reader of files that gives so many of them to a batch, or all that there are."""
    return stream if files is None else stream.option("maxFilesPerTrigger", files)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, bounds: tuple[int, int],
              partitions: int, **options: str) -> DataFrame:
    """Relational extract straight from a database, split into ranges of a numeric key."""
    low, high = bounds
    return (spark.read.format("jdbc")
            .options(url=url, dbtable=table, partitionColumn=key, lowerBound=str(low),
                     upperBound=str(high), numPartitions=str(partitions), **options)
            .load())
