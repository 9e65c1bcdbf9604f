"""Small literal tables for behaviour the generated data cannot show."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from soukwise.functions.exact import half_up, money_average, percent
from soukwise.operators import integrity, quality
from soukwise.plans import business, catalogue, history, insights, merges
from soukwise.plans.registry import CODES, QUERIES, query_catalog, run_code
from soukwise.sources.model import discounts

LINES = ("order_id bigint, customer_id bigint, order_date timestamp_ntz, status string, product_id bigint, "
         "variant_id bigint, quantity int, line_revenue decimal(18,2)")
PRODUCTS = ("product_id bigint, product_name string, category string, shop string, seller_id bigint, "
            "base_price decimal(18,2), is_approved boolean")
EVENTS = ("event_id bigint, ts timestamp_ntz, user_id bigint, session_id string, event_type string, "
          "product_id bigint, platform string, source string")
NOON = datetime(2024, 5, 1, 12)


def line(order, product, quantity, revenue, status="Delivered", at=NOON, customer=1):
    return (order, customer, at, status, product, product * 2, quantity, Decimal(revenue))


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([
        (1, "Red cup", "Cups", "S1", 1, Decimal(10), True), (2, "Blue cup", "Cups", "S1", 1, Decimal(20), True),
        (3, "Old pan", "Pans", "S2", 2, Decimal(30), False)], PRODUCTS)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# ------------------------------------------------------------------ rounding
def test_half_up_on_exact_ties(spark):
    df = spark.createDataFrame([(1005, 100000), (5, 1000), (-5, 1000), (1, 3), (7, 0), (None, 4)], "n bigint, d bigint")
    got = [r[0] for r in df.select(half_up(F.col("n"), F.col("d"))).collect()]
    assert got == [0.01, 0.01, -0.01, 0.33, None, None]


def test_percent_and_money_average_beyond_double_precision(spark):
    df = spark.createDataFrame([(Decimal("90071992547409930.05"), 2)], "t decimal(28,2), n bigint")
    assert df.select(money_average(F.col("t"), F.col("n"))).first()[0] == Decimal("45035996273704965.03") \
        .quantize(Decimal("0.01"))
    assert df.select(percent(F.lit(1), F.lit(8))).first()[0] == 12.5


# ------------------------------------------------------------ business rules
def test_scorecard_branches_do_not_multiply(spark, products):
    sellers = spark.createDataFrame([(1, "S1", "P"), (2, "S2", "Q"), (3, "S3", "Q")],
                                    "seller_id bigint, shop string, province string")
    lines = spark.createDataFrame([line(1, 1, 1, 100), line(1, 2, 1, 50), line(2, 1, 1, 25),
                                   line(3, 1, 1, 999, "Pending")], LINES)
    reviews = spark.createDataFrame([(1, 1, 5), (2, 1, 4)], "order_id bigint, product_id bigint, rating int")
    got = rows(business.seller_scorecard(sellers, products, lines, reviews, buckets=4), "seller_id",
               "delivered_orders", "revenue", "products", "avg_rating", "reviews", "revenue_rank")
    assert got == [(1, 2, Decimal(175), 2, 4.5, 2, 1), (2, 0, Decimal(0), 1, None, 0, 2),
                   (3, 0, Decimal(0), 0, None, 0, 2)]


def test_equal_discounts_are_all_counted_and_orders_weigh_the_same(spark):
    promos = spark.createDataFrame([(1, "A", Decimal(10), Decimal(5), date(2024, 1, 1), date(2024, 12, 31)),
                                    (2, "B", Decimal(10), Decimal(5), date(2024, 1, 1), date(2024, 12, 31))],
                                   "promotion_id bigint, promo_code string, discount_pct decimal(5,2), "
                                   "max_discount decimal(18,2), start_date date, end_date date")
    orders = spark.createDataFrame([(1, 1, NOON, "Delivered"), (2, 1, NOON, "Delivered"), (3, 1, NOON, "Delivered"),
                                    (4, None, NOON, "Delivered"), (5, 1, NOON, "Cancelled")],
                                   "order_id bigint, promotion_id bigint, order_date timestamp_ntz, status string")
    totals = spark.createDataFrame([(i, Decimal(v)) for i, v in ((1, 100), (2, 200), (3, 600), (4, 50), (5, 70))],
                                   "order_id bigint, total decimal(28,2)")
    got = rows(business.promotion_effect(promos, discounts(totals, orders, promos)), "promo_code", "orders",
               "gross", "discount", "aov_with", "aov_without")
    assert got == [("A", 3, Decimal(900), Decimal(15), Decimal(300), Decimal(50)),
                   ("B", 0, Decimal(0), Decimal(0), None, Decimal(50))]


def test_discount_window_and_rounding(spark):
    promos = spark.createDataFrame([(1, Decimal("12.50"), Decimal(1000), date(2024, 1, 1), date(2024, 1, 31))],
                                   "promotion_id bigint, discount_pct decimal(5,2), max_discount decimal(18,2), "
                                   "start_date date, end_date date")
    orders = spark.createDataFrame([(1, 1, datetime(2024, 1, 31, 23, 59), "Delivered"), (2, 1, NOON, "Delivered")],
                                   "order_id bigint, promotion_id bigint, order_date timestamp_ntz, status string")
    totals = spark.createDataFrame([(1, Decimal("0.20")), (2, Decimal("0.20"))], "order_id bigint, total decimal(28,2)")
    assert rows(discounts(totals, orders, promos), "order_id", "discount") == [
        (1, Decimal("0.03")), (2, Decimal("0.03"))]
    assert rows(discounts(totals, orders, promos, enforce_window=True), "order_id", "discount") == [
        (1, Decimal("0.03")), (2, Decimal("0.00"))]


def test_end_day_counts_in_full(spark, products):
    lines = spark.createDataFrame([
        line(1, 1, 5, 10, at=datetime(2024, 5, 31, 23, 59, 59)), line(2, 2, 7, 10, at=datetime(2024, 6, 1)),
        line(3, 2, 1, 10, at=datetime(2024, 5, 1))], LINES)
    got = business.top_sellers_in_range(lines, products, date(2024, 5, 1), date(2024, 5, 31), 10)
    assert [tuple(r) for r in got.select("product_id", "units").collect()] == [(1, 5), (2, 1)]
    assert business.top_sellers_in_range(lines, products, date(2024, 5, 1), date(2024, 6, 1), 1).count() == 1


def test_cancel_reason_ties_take_the_smallest_and_ignore_null(spark):
    orders = spark.createDataFrame([("X", "Cancelled", "b"), ("X", "Cancelled", "a"), ("X", "Delivered", None),
                                    ("X", "Delivered", None), ("X", "Delivered", None), ("Y", "Pending", None)],
                                   "ship_province string, status string, cancel_reason string")
    got = rows(business.cancel_rate(orders), "province", "orders", "cancelled", "cancel_pct", "top_reason")
    assert got == [("X", 5, 2, 40.0, "a"), ("Y", 1, 0, 0.0, None)]


def test_low_rating_by_both_keys(spark, products):
    reviews = spark.createDataFrame([(1, 1), (1, 5), (3, 2)], "product_id bigint, rating int")
    assert rows(business.low_rating_rate(reviews, products, by="both"), "category", "seller_id", "low_pct") == [
        ("Cups", 1, 50.0), ("Pans", 2, 100.0)]
    assert rows(business.low_rating_rate(reviews, products, min_pct=60), "category") == [("Pans",)]


def test_rfm_scores_in_order(spark):
    lines = spark.createDataFrame(
        [line(i * 10 + k, 1, 1, 10 * i, at=datetime(2024, 1, i), customer=i) for i in range(1, 11) for k in range(i)],
        LINES)
    customers = spark.createDataFrame([(i, f"c{i}", "P") for i in range(1, 11)],
                                      "customer_id bigint, full_name string, province string")
    got = rows(business.rfm(lines, customers, date(2024, 2, 1), buckets=4), "customer_id", "r", "f", "m", "segment")
    assert {r[0]: r[1:4] for r in got} == {i: ((i + 1) // 2,) * 3 for i in range(1, 11)}
    segments = {r[0]: r[4] for r in got}
    assert segments[10] == "VIP-Champions" and segments[5] == "Loyal" and segments[1] == "Regular"


# -------------------------------------------------------------------- merges
@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame([
        (1, NOON, 1, "s1", "product_view", 1, "ios", "mock"), (2, NOON, 1, "s1", "product_view", 1, "ios", "mock"),
        (3, NOON, None, "s2", "product_view", 1, "web", "live_ui"), (4, NOON, 1, "s1", "add_to_cart", 1, "ios", "mock"),
        (5, NOON, 1, "s1", "purchase", None, "ios", "mock")], EVENTS)


def test_delivered_only_and_all_status_disagree_as_documented(spark, products, events):
    lines = spark.createDataFrame([line(1, 1, 3, 30), line(2, 1, 4, 40, "Cancelled")], LINES)
    strict = rows(merges.product_merge(lines, products, events), "product_id", "orders", "units", "revenue", "views",
                  "carts", "view_to_order_pct")
    assert strict == [(1, 1, 3, Decimal(30), 2, 1, 150.0), (2, 0, 0, Decimal(0), 0, 0, None),
                      (3, 0, 0, Decimal(0), 0, 0, None)]
    loose = rows(merges.product_merge_all_status(lines, products, events), "product_id", "orders", "units_sold",
                 "view_to_sale_pct")
    assert loose[0] == (1, 1, 7, 350.0)
    # On delivered lines alone the two agree.
    only = lines.where("status = 'Delivered'")
    assert rows(merges.product_merge(only, products, events), "product_id", "units", "revenue") == \
        rows(merges.product_merge_all_status(only, products, events), "product_id", "units_sold", "revenue")


def test_funnel_edges(spark, events):
    assert rows(merges.funnel(events), "step_no", "sessions", "events", "pct") == [
        (1, 2, 3, 100.0), (2, 1, 1, 50.0), (3, 0, 0, 0.0), (4, 1, 1, 50.0)]
    assert rows(merges.funnel_max_base(events), "step_no", "pct") == [(1, 100.0), (2, 50.0), (4, 50.0)]
    nothing = events.where("false")
    assert rows(merges.funnel(nothing), "step_no", "sessions", "pct") == [(i, 0, 0.0) for i in range(1, 5)]
    assert merges.funnel_max_base(nothing).count() == 0
    assert tuple(insights.insight_funnel(nothing).first()) == (100.0, 0.0, 0.0)


def test_missing_scan_log_is_null_in_one_merge_and_zero_in_the_other(spark):
    day = datetime(2024, 1, 1)
    shipments = spark.createDataFrame(
        [(1, "T1", "C", "Delivered", day, datetime(2024, 1, 3)), (2, "T2", "C", "Delivered", day, datetime(2024, 1, 4)),
         (3, "T3", "C", "InTransit", day, None), (4, "T4", "C", "Preparing", None, None)],
        "order_id bigint, tracking_no string, carrier string, status string, shipped_at timestamp_ntz, "
        "delivered_at timestamp_ntz")
    scans = spark.createDataFrame([("T1", 1, "A"), ("T1", 1, "A"), ("T1", 1, "B"), ("T9", 9, "A")],
                                  "tracking_no string, order_id bigint, station string")
    assert rows(merges.carrier_merge(shipments, scans), "shipments", "avg_days", "avg_scans", "avg_stations") == [
        (2, 2.5, 3.0, 2.0)]
    assert rows(insights.carrier_perf(shipments, scans), "days", "scans", "n") == [(2.5, 1.5, 2)]
    assert rows(merges.shipment_merge(shipments, scans), "order_id", "delivery_days", "scans", "stations") == [
        (1, 2.0, 3, 2), (2, 3.0, 0, None), (3, None, 0, None)]
    assert rows(history.scan_reconcile(shipments, scans), "order_id", "shipments", "scans", "state") == [
        (1, 1, 3, "matched"), (2, 1, 0, "no scan"), (3, 1, 0, "no scan"), (4, 1, 0, "no scan"),
        (9, 0, 1, "no shipment")]
    assert rows(business.delivery_time(shipments), "shipments", "delivered", "avg_days", "p95_days") == [
        (3, 2, 2.5, 2.95)]


def test_hours_take_the_first_on_ties_and_local_time(spark):
    at = [datetime(2024, 1, 1, 23), datetime(2024, 1, 1, 5)]
    df = spark.createDataFrame([(i, t, 1, "s", "page_view", None, p, "mock") for i, (t, p) in
                                enumerate([(at[0], "b"), (at[1], "a")])], EVENTS)
    assert tuple(insights.insight_hours(df).first()) == (5, 0, "a")
    assert rows(merges.hourly_platform(df, "Asia/Ho_Chi_Minh"), "hour", "platform") == [(12, "a"), (6, "b")]
    matrix = insights.hour_matrix(df)
    assert len(matrix.columns) == 25 and matrix.count() == 2


def test_history_of_one_key_equals_its_part_of_the_replay(spark, events):
    one = [r["event_id"] for r in history.session_replay(events, "s1").collect()]
    assert one == [1, 2, 4, 5]
    for hot_rows in (1, 10 ** 9):
        every = {(r["session_id"], r["event_id"]): r["seq"] for r in
                 history.session_replay(events, hot_rows=hot_rows).collect()}
        assert [every["s1", e] for e in one] == [1, 2, 3, 4] and every["s2", 3] == 1
        newest = {r["event_id"]: r["seq"] for r in history.user_history(events, hot_rows=hot_rows).collect()}
        assert newest[5] == 1 and newest[1] == 4 and newest[3] == 1
    assert [r["event_id"] for r in history.user_history(events, 1).collect()] == [5, 4, 2, 1]
    assert [r["event_id"] for r in history.recent_events(events, 1, only_live=True).collect()] == [3]


# ----------------------------------------------------------------- catalogue
def test_product_search_filters_and_ratings(spark, products):
    variants = spark.createDataFrame([(i, (i + 1) // 2, f"K{i}", Decimal(i)) for i in range(1, 7)],
                                     "variant_id bigint, product_id bigint, sku string, price_adjust decimal(18,2)")
    held = spark.createDataFrame([(i, i % 3) for i in range(1, 7)], "variant_id bigint, quantity_on_hand int") \
        .withColumn("safety_stock", F.lit(5))
    reviews = spark.createDataFrame([(1, 4), (1, 5), (3, 1)], "product_id bigint, rating int")

    def search(**kw):
        return rows(catalogue.product_search(products, variants, held, reviews, **kw), "variant_id", "sell_price",
                    "avg_rating")

    assert search() == [(1, Decimal(11), 4.5), (2, Decimal(12), 4.5), (3, Decimal(23), 0.0), (4, Decimal(24), 0.0)]
    assert [r[0] for r in search(text="BLUE")] == [3, 4]
    assert search(category="Pans") == []
    assert [r[0] for r in search(limit=1)] == [2]
    assert rows(catalogue.inventory_lookup(held, 4), "quantity_on_hand") == [(1,)]
    assert rows(catalogue.category_counts(products), "category", "products") == [("Cups", 2)]


def test_query_catalog_and_dispatch(spark, data):
    listed = query_catalog(spark).collect()
    assert [r["code"] for r in listed] == sorted(CODES) and all(r["query"] in QUERIES for r in listed)
    assert run_code("yc04", spark, data, limit=3).count() == 3
    with pytest.raises(KeyError):
        run_code("YC99", spark, data)


# ----------------------------------------------------------------- integrity
def test_reviews_need_a_delivered_order_of_the_same_customer(spark):
    lines = spark.createDataFrame([line(1, 1, 1, 1, customer=7), line(2, 1, 1, 1, "Shipping", customer=7)], LINES)
    reviews = spark.createDataFrame([(1, 7, 1, 5), (1, 8, 1, 5), (2, 7, 1, 5), (1, 7, 2, 5)],
                                    "order_id bigint, customer_id bigint, product_id bigint, rating int")
    assert rows(integrity.review_eligible(reviews, lines), "order_id", "customer_id", "product_id") == [(1, 7, 1)]
    assert integrity.review_rejected(reviews, lines).count() == 3


def test_seller_rating_falls_to_zero_without_reviews(spark, products):
    reviews = spark.createDataFrame([(1, 5), (2, 4), (2, 4)], "product_id bigint, rating int")
    gone = spark.createDataFrame([(3,)], "product_id bigint")
    affected = integrity.affected_sellers(reviews, gone, products)
    assert rows(integrity.seller_rating(affected, reviews, products), "seller_id", "rating_avg") == [
        (1, 4.33), (2, 0.0)]


def test_delete_propagation(spark):
    gone = spark.createDataFrame([(1,), (2,)], "k bigint")
    child = spark.createDataFrame([(1, "a"), (3, "b"), (None, "c")], "k bigint, name string")
    assert rows(integrity.restricted(gone, child, "k"), "k") == [(1,)]
    assert rows(integrity.cascaded(child, gone, "k"), "name") == [("b",), ("c",)]
    assert rows(integrity.set_null(child, gone, "k"), "name", "k") == [("a", None), ("b", 3), ("c", None)]


def test_each_broken_rule_is_counted_once_and_null_passes(spark):
    def frame(schema, *values):
        return spark.createDataFrame(list(values), schema)

    good, bad = datetime(2024, 1, 2), datetime(2024, 1, 1)
    found = dict(rows(quality.dq_checks({
        "customer": frame("email string", ("a@b.c",), ("nope",), (None,)),
        "seller": frame("rating_avg double", (5.0,), (5.1,), (None,)),
        "category": frame("category_id bigint, parent_id bigint", (1, None), (2, 1), (3, 3)),
        "product": frame("base_price double", (1.0,), (0.0,), (None,)),
        "inventory": frame("quantity_on_hand int, safety_stock int", (0, 0), (-1, 1), (1, -1)),
        "promotion": frame("discount_pct double, start_date date, end_date date",
                           (100.0, date(2024, 1, 1), date(2024, 1, 1)), (0.0, date(2024, 1, 2), date(2024, 1, 1)),
                           (101.0, None, date(2024, 1, 1))),
        "orders": frame("status string, cancel_reason string, discount double", ("Cancelled", "why", 0.0),
                        ("Cancelled", None, -1.0), ("Lost", None, None)),
        "order_line": frame("quantity int, unit_price double", (1, 1.0), (0, 0.0)),
        "payment": frame("status string, method string, amount double, paid_at timestamp", ("Paid", "COD", 0.0, good),
                         ("Paid", "Barter", -1.0, None), ("Odd", "EWallet", None, None)),
        "shipment": frame("status string, shipped_at timestamp, delivered_at timestamp", ("Failed", good, None),
                          ("Picked", good, bad), ("Flying", bad, good)),
        "review": frame("rating int", (1,), (5,), (0,), (6,), (None,))}), "rule", "violations"))
    assert found == {
        "customer.email": 1, "seller.rating": 1, "category.not_self": 1, "product.price": 1, "inventory.quantity": 1,
        "inventory.safety": 1, "promotion.pct": 2, "promotion.range": 1, "orders.status": 1, "orders.discount": 1,
        "orders.cancel": 1, "order_line.quantity": 1, "order_line.price": 1, "payment.status": 1, "payment.method": 1,
        "payment.amount": 1, "payment.paid_at": 1, "shipment.status": 1, "shipment.dates": 1, "review.rating": 2}


def test_unique_and_orphans(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None)], "k bigint, c string")
    assert rows(quality.duplicates(df, ["k", "c"], "r"), "repeated_keys", "extra_rows") == [(1, 2)]
    parent = spark.createDataFrame([(1,)], "id bigint")
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k bigint")
    assert rows(quality.orphans(child, "k", parent, "id", "r"), "orphans") == [(2,)]


def test_coerce_numeric_needs_every_value_and_at_least_one(spark):
    df = spark.createDataFrame([("1", "1", None, 7), ("2.5", "x", None, 8), (None, "3", None, 9)],
                               "all_numbers string, mixed string, empty string, kept int")
    assert dict(quality.coerce_numeric(df).dtypes) == {
        "all_numbers": "double", "mixed": "string", "empty": "string", "kept": "int"}
