"""Plans as they would run on large tables: no broadcast, predicates at the scan, no single task."""

import re

import pytest

from soukwise.plans.registry import QUERIES


@pytest.fixture(scope="module")
def big(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["product_merge", "revenue_month_category", "lake_monthly_revenue",
                                  "top_sellers_in_range", "aov_month_channel"])
def test_delivered_orders_are_picked_at_the_scan(big, data, name):
    assert "EqualTo(o_orderstatus,F)" in plan(QUERIES[name](big, data))


def test_dates_are_picked_at_the_scan(big, data):
    text = plan(QUERIES["top_sellers_in_range"](big, data))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_only_used_columns_are_read(big, data):
    text = plan(QUERIES["lake_monthly_revenue"](big, data))
    read = re.findall(r"ReadSchema: struct<([^>]*)", text)
    assert {c.split(":")[0] for part in read for c in part.split(",") if ":" in c} <= {
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "o_orderkey", "o_orderstatus", "o_orderdate",
        "p_partkey", "p_type", "..."}


def test_best_products_shrink_before_the_shuffle(big, data):
    text = plan(QUERIES["top_products_per_category"](big, data))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_sales_are_summed_before_the_product_join(big, data):
    text = plan(QUERIES["lake_monthly_revenue"](big, data))
    assert text.index("Join [product_id") < text.index("partial_sum(line_revenue")


def test_order_totals_reuse_the_partitioning_of_the_join(big, data):
    """Grouping by order after joining by order adds no exchange: lines and orders move once each."""
    text = plan(QUERIES["orders_to_purchase_events"](big, data))
    assert text.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("name", ["rfm", "seller_scorecard", "leak_products", "session_replay", "user_history"])
def test_no_window_runs_in_one_task(big, data, name):
    assert "SinglePartition" not in plan(QUERIES[name](big, data))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"stream_ingest", "stream_event_stats", "stream_hourly",
                                                        "stream_stock"}))
def test_no_cross_join_of_tables(spark, data, name):
    """A nested-loop or cartesian join is allowed for one-row sides only, and none is used."""
    text = plan(QUERIES[name](spark, data))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_a_hot_product_is_split_in_the_join(big):
    """A third of all lines on one product: the join partition is cut at run time."""
    from pyspark.sql import functions as F

    from soukwise.plans import business
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16"}
    before = {k: big.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        big.conf.set(key, value)
    try:
        lines = big.range(0, 90_000, 1, 8).select(
            F.col("id").alias("order_id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("product_id"),
            F.lit("Delivered").alias("status"), F.lit(1).alias("quantity"),
            F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("order_date"),
            (F.col("id") % 97).cast("decimal(18,2)").alias("line_revenue"))
        products = big.range(500).select(F.col("id").alias("product_id"), F.lit("c").alias("category"))
        result = business.revenue_month_category(lines, products)
        row = result.collect()[0]
        assert (row["orders"], row["units"]) == (90_000, 90_000)
        assert "skew=true" in plan(result)
    finally:
        for key, value in before.items():
            big.conf.set(key, value) if value is not None else big.conf.unset(key)
