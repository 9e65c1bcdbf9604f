"""Reading the document tables, and the split into held-out and learning rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from soukwise.session import settle, ship_code


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """Columns of a table, with the session settings applied and the code at the workers."""
    ship_code(settle(spark))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet").select(*columns)


def held_out(id_col: str) -> Column:
    """True where crc32 of the id as text leaves 0 modulo 5; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def rows_where(docs: DataFrame, text_col: str, keep: Callable[[list[str]], list[bool]]) -> DataFrame:
    """The rows of ``docs`` for which ``keep`` says so of their texts, with all columns; a null text is shown as empty."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(keep([t or "" for t in batch.column(at).to_pylist()]), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
