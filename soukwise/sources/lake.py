"""The Parquet lake: month-partitioned events, plain tables, CSV exports, inventory."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from soukwise.operators.quality import coerce_numeric
from soukwise.session import settle


#: What a task of a rebalanced write gets, and with it the size of a file.
FILE_BYTES = "64m"


@contextmanager
def part_size(spark: SparkSession, size: str) -> Iterator[None]:
    """Shuffles inside are put together to parts of another size than the session's."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    usual = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, usual)


def write_by_month(events: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per month. Rows are rebalanced by month, so that a small month gives one
    file and a large one is split over many tasks. Overwriting replaces only the months
    present in ``events``."""
    with part_size(events.sparkSession, FILE_BYTES):
        (events.hint("rebalance", "event_month").write.mode(mode)
         .option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
         .partitionBy("event_month").parquet(path))


def read_by_month(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Events of the months ``first`` to ``last``; other folders are not opened."""
    events = settle(spark).read.parquet(path)
    if first:
        events = events.where(F.col("event_month") >= first)
    if last:
        events = events.where(F.col("event_month") <= last)
    return events


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked of Spark's own file system layer."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files of a folder, 0 if there is none, from Spark's own file system layer."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.getContentSummary(target).getLength() if system.exists(target) else 0


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, through Spark's own file system layer."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """The names of what a folder holds, from Spark's own file system layer."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(entry.getPath().getName() for entry in system.listStatus(target))


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """A table laid out by key: later joins and groupings on the key need no shuffle.

    The rows are first spread by the key, so that a bucket is one file, not one per task.
    """
    (df.repartition(buckets, key).write.mode("overwrite").option("path", path).option("compression", "snappy")
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))


def bucket_facts(lines: DataFrame, orders: DataFrame, prefix: str, root: str, buckets: int) -> None:
    """Raw lines and orders laid out by order number, for ``CatalogMarketplace``."""
    write_bucketed(lines, f"{prefix}lineitem", f"{root}/lineitem", "l_orderkey", buckets)
    write_bucketed(orders, f"{prefix}orders", f"{root}/orders", "o_orderkey", buckets)


def write_raw_zone(tables: dict[str, DataFrame], events: DataFrame, root: str) -> None:
    for name, df in tables.items():
        write_table(df, f"{root}/raw/{name}")
    write_by_month(events, f"{root}/raw/clickstream_events")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, in the order of ``df``; one file per task."""
    df.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def read_csv(spark: SparkSession, path: str, limit: int | None = None, order_by: list | None = None,
             schema: str | None = None) -> DataFrame:
    """An export with its types: stated, or found per column from the text itself."""
    reader = spark.read.option("header", True)
    if schema:
        df = reader.schema(schema).csv(path)
    else:
        text = reader.csv(path)
        df = typed_text(text)
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(limit) if limit else df


def typed_text(df: DataFrame) -> DataFrame:
    """Whole numbers to BIGINT, other numbers to DOUBLE, the rest stays text. One pass over all columns."""
    names = df.columns
    whole = {c: (F.count(F.col(f"`{c}`").try_cast("bigint")) == F.count(f"`{c}`")) for c in names}
    flags = df.agg(*[(hit & (F.count(f"`{c}`") > 0)).alias(c) for c, hit in whole.items()]).first().asDict()
    typed = df.withColumns({c: F.col(f"`{c}`").cast("bigint") for c in names if flags[c]}) if any(
        flags.values()) else df
    return coerce_numeric(typed)


# ---------------------------------------------------------------- inventory
def file_inventory(df: DataFrame, name: str) -> DataFrame:
    """(table, files, bytes, rows) of a file-backed frame; counts come from the file footers."""
    files = df.groupBy("_metadata.file_path").agg(
        F.count("*").alias("n"), F.max("_metadata.file_size").alias("size"))
    return files.agg(F.count("*").alias("files"), F.sum("size").alias("bytes"),
                     F.coalesce(F.sum("n"), F.lit(0)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "files", "bytes",
        (F.col("bytes") / F.nullif(F.col("files"), F.lit(0))).alias("average_bytes"), "row_count")


def dataset_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [file_inventory(df, name) for name, df in tables.items()])


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def list_folder(spark: SparkSession, path: str) -> DataFrame:
    """Folder listing with sizes, folders before files, through Spark's own file system layer."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    entries = [(e.getPath().getName(), "DIRECTORY" if e.isDirectory() else "FILE", e.getLen(),
                e.getBlockSize(), e.getReplication(), e.getModificationTime())
               for e in system.listStatus(root)]
    entries.sort(key=lambda e: (e[1] != "DIRECTORY", e[0]))
    return spark.createDataFrame(
        entries, "name string, type string, size bigint, block_size bigint, replication int, modified bigint")
