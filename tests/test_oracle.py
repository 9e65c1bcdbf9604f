"""Every query against its SQL counterpart, over whole tables."""

import pytest

import __spark_entry__ as jobs
from soukwise.plans import registry
from tests.compare import connect, duck_rows, spark_rows

OWN = set(registry.QUERIES)
QUERIES = {name: run for name, run in jobs.queries().items() if name in OWN}
ORACLES = {name: sql for name, sql in jobs.oracle_sql().items() if name in OWN}


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, data, duck, name):
    names, rows = spark_rows(QUERIES[name](spark, data))
    expected_names, expected = duck_rows(duck, ORACLES[name])
    assert names == expected_names
    assert rows == expected


def test_every_oracle_has_a_query():
    assert set(ORACLES) == set(QUERIES)


def test_oracle_types_are_plain(duck):
    for name, sql in ORACLES.items():
        kinds = {r[1] for r in duck.execute(f"describe {sql}").fetchall()}
        assert kinds <= {"BIGINT", "DOUBLE", "VARCHAR", "BOOLEAN"}, name


def test_entry_has_a_stable_schema(spark):
    assert jobs.entry(spark).columns == [
        "product_id", "product_name", "category", "shop", "orders", "units", "revenue", "views", "carts",
        "view_to_order_pct"]
