"""Curated months that follow the raw zone: only months whose rows have changed are computed again.

A manifest holds, for each month of the raw zone, a sum over its files (name, size, time) and a sum over its rows.
A month whose files are the same is not opened. One whose files differ is read once for its row sum; a raw zone that was
replaced with the same rows, by other files, leaves the curated month alone.

The manifest is written after the months, so a refresh that stops in between does those months again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from soukwise.session import materialise, settle
from soukwise.sources.lake import exists, folder_names, remove, write_by_month

MISSING = "__HIVE_DEFAULT_PARTITION__"
_MANIFEST = "month string, files bigint, file_sum bigint, rows bigint, row_sum string"


def _month() -> Column:
    return F.coalesce("event_month", F.lit(MISSING))


def file_sums(spark: SparkSession, raw: str) -> DataFrame:
    """(month, files, file_sum) of a folder of months, from the listing alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("basePath", raw).load(raw)
    return files.groupBy(_month().alias("month")).agg(
        F.count("*").alias("files"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("file_sum"))


def row_sums(rows: DataFrame) -> DataFrame:
    """(month, rows, row_sum): the same for the same rows in any order and in any files, repeated rows counted."""
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(rows.columns)]).cast("decimal(28,0)")
    return rows.groupBy(_month().alias("month")).agg(
        F.count("*").alias("rows"), F.sum(hashed).cast("string").alias("row_sum"))


def _of(rows: DataFrame, months: list[str]) -> DataFrame:
    """The rows of some month folders; no other folder is opened."""
    named = F.col("event_month").isin([m for m in months if m != MISSING])
    return rows.where(named | F.col("event_month").isNull() if MISSING in months else named)


def refresh(spark: SparkSession, raw: str, curated: str, build: Callable[[DataFrame], DataFrame],
            manifest: str | None = None) -> list[str]:
    """Bring ``curated`` in line with ``raw`` and return the months that were computed again or removed.

    ``build`` gives the curated rows of raw ones; it keeps ``event_month`` and looks at one month at a time. A month that
    the raw zone lacks, or of which ``build`` leaves nothing, is removed. Months are few: their sums go through the driver.
    """
    settle(spark)
    manifest = manifest or f"{curated.rstrip('/')}-manifest"
    listed = {r["month"]: r for r in file_sums(spark, raw).collect()}
    held = {r["month"]: r for r in spark.read.schema(_MANIFEST).parquet(manifest).collect()} if exists(spark, manifest) else {}
    built = ({name.removeprefix("event_month=") for name in folder_names(spark, curated) if name.startswith("event_month=")}
             if exists(spark, curated) else set())

    suspects = [m for m, r in listed.items()
                if m not in held or (r["files"], r["file_sum"]) != (held[m]["files"], held[m]["file_sum"])]
    source = spark.read.option("basePath", raw).parquet(raw)
    sums = {r["month"]: r for r in row_sums(_of(source, suspects)).collect()} if suspects else {}
    changed = [m for m in suspects if m in sums and (
        m not in held or (sums[m]["rows"], sums[m]["row_sum"]) != (held[m]["rows"], held[m]["row_sum"]))]
    emptied = [m for m in suspects if m not in sums]

    stale = built & ((built - set(listed)) | set(emptied))
    if changed:
        rows = materialise(build(_of(source, changed)))
        write_by_month(rows, curated)
        filled = {r[0] for r in rows.select(_month()).distinct().collect()}
        stale |= built & (set(changed) - filled)
    for month in stale:
        remove(spark, f"{curated}/event_month={month}")

    kept = [(m, r["files"], r["file_sum"], *((sums[m]["rows"], sums[m]["row_sum"]) if m in sums
                                              else (held[m]["rows"], held[m]["row_sum"]) if m not in suspects else (0, None)))
            for m, r in listed.items()]
    spark.createDataFrame(kept, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(manifest)
    return sorted(set(changed) | stale)


def read_curated(spark: SparkSession, curated: str) -> DataFrame:
    return settle(spark).read.parquet(curated)
