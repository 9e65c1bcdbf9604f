"""Use from SQL, and over bucketed catalog tables."""

from soukwise.plans.registry import QUERIES, answer
from soukwise.plans.views import MODEL, create_model_views, create_question_views
from soukwise.sources import lake
from soukwise.sources.model import CatalogMarketplace, Marketplace


def test_model_views(spark, data):
    create_model_views(spark, data)
    assert all(spark.catalog.tableExists(name) for name in MODEL)
    left, right = spark.sql("""
        select (select sum(line_revenue) from order_lines where status = 'Delivered'),
               (select sum(line_revenue) from order_line_wide where status = 'Delivered')""").first()
    assert left == right > 0


def test_question_views_and_table_function(spark, data):
    create_question_views(spark, data, ("YC01", "YC04", "YC10"))
    assert spark.sql("select sum(orders) from cancel_rate").first()[0] == Marketplace(spark, data).orders().count()
    everything = spark.sql("select * from low_ratings()").count()
    some = [r["low_pct"] for r in spark.sql("select low_pct from low_ratings(40)").collect()]
    assert everything == spark.table("low_rating_rate").count() and all(p >= 40 for p in some)


def test_bucketed_tables_give_the_same_answers_with_fewer_shuffles(spark, data, tmp_path):
    m = Marketplace(spark, data)
    lake.bucket_facts(m.table("lineitem"), m.table("orders"), "laid_out_", str(tmp_path), 4)
    laid_out = CatalogMarketplace(spark, data, "laid_out_")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("lake_monthly_revenue", "orders_to_purchase_events", "fact_shipment"):
            plain, bucketed = QUERIES[name](spark, data), answer(name, laid_out)
            count = [df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
                     for df in (plain, bucketed)]
            assert count[1] == count[0] - 2, name
            assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, bucketed.collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_sellers_of_a_stated_period(spark, data):
    create_question_views(spark, data, ("YC02",))
    rows = spark.sql("select * from top_sellers(date '1995-01-01', date '1996-12-31')").collect()
    sold = spark.sql("""select product_id, sum(quantity) as units from order_lines where status = 'Delivered'
                        and year(order_date) in (1995, 1996) group by 1 order by 2 desc, 1 limit 10""").collect()
    assert [(r["product_id"], r["units"]) for r in rows] == [tuple(r) for r in sold] and len(rows) == 10
