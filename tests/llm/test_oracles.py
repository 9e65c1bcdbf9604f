"""Queries with a SQL counterpart against it."""

import duckdb
import pytest

from soukwise.llm.queries import ORACLES, QUERIES
from tests.compare import duck_rows, spark_rows


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, data, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"create view {table} as select * from '{data}/{table}.parquet'")
    assert spark_rows(QUERIES[name](spark, data)) == duck_rows(con, ORACLES[name])
