"""The model and the business questions as temporary views, for use from SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from soukwise.plans.registry import CODES, QUERIES
from soukwise.session import settle
from soukwise.sources.model import Marketplace

MODEL = ("sellers", "customers", "products", "variants", "inventory", "promotions", "orders", "order_lines",
         "order_line_wide", "order_totals", "payments", "shipments", "scans", "reviews", "clickstream")


def create_model_views(spark: SparkSession, folder: str) -> None:
    """Views named like the tables of the model. Nothing is computed until they are queried."""
    m = Marketplace(settle(spark), folder)
    for name in MODEL:
        getattr(m, name)().createOrReplaceTempView(name)


def create_question_views(spark: SparkSession, folder: str, codes: tuple[str, ...] = tuple(CODES)) -> None:
    """Views named like the queries that answer the questions, ``top_sellers(first_day, last_day)``,
    and ``low_ratings(min_pct)``, a table function with a default. Questions that rank all rows compute the ranks here."""
    for code in codes:
        name = CODES[code][0]
        QUERIES[name](spark, folder).createOrReplaceTempView(name)
    if "YC02" in codes:
        Marketplace(settle(spark), folder).order_lines().createOrReplaceTempView("order_lines")
        spark.sql("""
            create or replace temporary function top_sellers(first_day date, last_day date)
            returns table (product_id bigint, units bigint, revenue decimal(28,2))
            return select product_id, sum(quantity), sum(line_revenue) from order_lines
                   where status = 'Delivered' and order_date >= top_sellers.first_day
                     and order_date < date_add(top_sellers.last_day, 1)
                   group by product_id order by sum(quantity) desc, product_id limit 10""")
    if "YC10" in codes:
        spark.sql("""
            create or replace temporary function low_ratings(min_pct double default 0)
            returns table (category string, reviews bigint, low bigint, low_pct double, avg_rating double)
            return select category, reviews, low, low_pct, avg_rating from low_rating_rate
                   where low_pct >= low_ratings.min_pct""")
