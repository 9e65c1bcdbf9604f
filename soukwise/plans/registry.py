"""Every query by name: a function from a session and a data folder to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from soukwise.operators import deletes, integrity, quality, stock
from soukwise.plans import business, catalogue, history, insights, merges
from soukwise.session import deal, materialise, new_folder, settle
from soukwise.sources import documents, lake, refresh
from soukwise.sources.model import Marketplace, discounts
from soukwise.sources.tables import SCHEMAS, stream_table, table_path
from soukwise.streaming import events as event_streams
from soukwise.streaming import placement, views
from soukwise.streaming import stock as stock_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
BUILDERS: dict[str, Callable[[Marketplace], DataFrame]] = {}

# Parameters of the parameterised queries.
AS_OF = date(2001, 12, 31)
PERIOD = (date(1996, 1, 1), date(1997, 12, 31))
EVENT_WINDOW = (datetime(2024, 1, 8), datetime(2024, 1, 22))
WATCH_VIEWS, WATCH_REVENUE = 10, 500_000


DELIVERED = ("Delivered",)


def prepared(m: Marketplace) -> Marketplace:
    """The model with its session set for the size of its tables."""
    deal(settle(m.spark), sum(lake.size_of(m.spark, table_path(m.folder, name)) for name in SCHEMAS))
    return m


def query(build: Callable[[Marketplace], DataFrame]) -> Callable[[Marketplace], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(prepared(Marketplace(spark, folder)))

    QUERIES[build.__name__] = run
    BUILDERS[build.__name__] = build
    return build


# ------------------------------------------------------------------ extracts
@query
def dim_product(m):
    return m.products(shop=True)


@query
def dim_customer(m):
    return m.customers()


@query
def fact_order_line(m):
    return m.order_lines(province=True).select(
        "order_id", "customer_id", "order_date", "status", "ship_province", "promotion_id",
        "product_id", "variant_id", "quantity", "line_revenue")


@query
def fact_shipment(m):
    return m.shipments()


@query
def order_line_wide(m):
    return m.order_line_wide()


@query
def table_counts(m):
    return lake.table_counts({
        "seller": m.sellers(), "customer": m.customers(), "product": m.products(),
        "variant": m.variants(), "inventory": m.inventory(), "promotion": m.promotions(),
        "orders": m.orders(), "order_line": m.bare_lines(), "payment": m.table("orders"),
        "shipment": m.shipments(), "review": m.reviews(), "scan": m.scans(), "event": m.table("events")})


@query
def dataset_inventory(m):
    names = ("nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    return lake.dataset_inventory({n: m.table(n) for n in names}).select("table_name", "files", "row_count")


# ---------------------------------------------------------------------- lake
@query
def events_by_month(m):
    return merges.events_by_month(m.clickstream())


def _event_lake(m: Marketplace) -> str:
    path = new_folder(m.spark, "events")
    lake.write_by_month(m.clickstream(), path)
    return path


@query
def write_events_lake(m):
    back = lake.read_by_month(m.spark, _event_lake(m))
    return back.groupBy("event_month", "event_type").agg(
        F.count("*").alias("events"), F.sum("revenue").alias("revenue"))


@query
def events_month_pruned(m):
    month = f"{EVENT_WINDOW[0]:%Y-%m}"
    back = lake.read_by_month(m.spark, _event_lake(m), month, month)
    return back.groupBy("event_month", "platform").agg(F.count("*").alias("events"))


@query
def events_flat(m):
    path = new_folder(m.spark, "event-documents")
    documents.write_documents(documents.as_documents(m.clickstream()), path)
    return documents.events_flat(documents.read_events(m.spark, path))


@query
def scans_clean(m):
    path = new_folder(m.spark, "scan-documents")
    documents.write_documents(documents.scan_documents(m.scans()), path)
    return (documents.read_scans(m.spark, path)
            .select("tracking_no", "order_id", "station", F.col("timestamp").alias("scanned_at")))


def _product_csv(m: Marketplace) -> str:
    path = new_folder(m.spark, "csv")
    merged = merges.product_merge_all_status(*_merge_args(m))
    lake.write_csv(merged.orderBy(F.desc("revenue"), "product_id"), path)
    return path


@query
def export_csv(m):
    schema = ("product_id bigint, product_name string, category string, shop string, orders bigint, "
              "units_sold bigint, revenue decimal(28,2), product_view bigint, add_to_cart bigint, "
              "remove_from_cart bigint, view_to_sale_pct double")
    return lake.read_csv(m.spark, _product_csv(m), schema=schema)


@query
def curated_read(m):
    return lake.read_csv(m.spark, _product_csv(m), limit=200,
                         order_by=[F.desc("revenue"), F.col("product_id")])


@query
def coerce_numeric(m):
    text = m.table("orders").select(
        "o_orderkey", F.col("o_totalprice").cast("string").alias("price_text"),
        F.col("o_orderpriority").alias("priority_text"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey").cast("string")).alias("sparse_text"))
    return quality.coerce_numeric(text)


# ---------------------------------------------------------- business questions
@query
def revenue_month_category(m):
    return business.revenue_month_category(m.order_lines(only=DELIVERED), m.products())


@query
def top_sellers_in_range(m):
    return business.top_sellers_in_range(m.order_lines(only=DELIVERED), m.products(shop=True), *PERIOD, n=10)


@query
def rfm(m):
    return business.rfm(m.order_lines(only=DELIVERED), m.customers(), AS_OF)


@query
def rfm_segments(m):
    return business.rfm_segments(business.rfm(m.order_lines(only=DELIVERED), m.customers(), AS_OF))


@query
def cancel_rate(m):
    return business.cancel_rate(m.orders(province=True))


@query
def low_stock(m):
    return business.low_stock(m.inventory(), m.variants(), m.products(shop=True))


@query
def seller_scorecard(m):
    return business.seller_scorecard(m.sellers(), m.products(), m.order_lines(only=DELIVERED), m.reviews())


def _discounted(m: Marketplace, only: tuple[str, ...] = ()) -> DataFrame:
    return discounts(m.order_totals(), m.orders(only=only), m.promotions())


@query
def aov_month_channel(m):
    return business.aov_month_channel(_discounted(m, DELIVERED), m.payments())


@query
def promotion_effect(m):
    return business.promotion_effect(m.promotions(), _discounted(m, DELIVERED))


@query
def delivery_time(m):
    return business.delivery_time(m.shipments())


@query
def low_rating_rate(m):
    return business.low_rating_rate(m.reviews(), m.products())


@query
def low_rating_rate_by_seller(m):
    return business.low_rating_rate(m.reviews(), m.products(), min_pct=40, by="seller")


# -------------------------------------------------------------------- merges
def _merge_args(m: Marketplace, only: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    return m.order_lines(only=only), m.products(shop=True), m.clickstream(merges.PRODUCT_EVENTS)


@query
def product_merge(m):
    return merges.product_merge(*_merge_args(m, DELIVERED))


@query
def high_view_low_sale(m):
    return merges.high_view_low_sale(merges.product_merge(*_merge_args(m, DELIVERED)), WATCH_VIEWS, WATCH_REVENUE)


@query
def top_products_per_category(m):
    return merges.top_products_per_category(merges.product_merge(*_merge_args(m, DELIVERED)))


@query
def product_revenue_all_status(m):
    return merges.product_revenue_all_status(m.order_lines(), m.products(shop=True))


@query
def product_merge_all_status(m):
    return merges.product_merge_all_status(*_merge_args(m))


@query
def funnel(m):
    return merges.funnel(m.clickstream(merges.FUNNEL_STEPS))


@query
def funnel_max_base(m):
    return merges.funnel_max_base(m.clickstream(merges.FUNNEL_STEPS))


@query
def lake_monthly_revenue(m):
    return merges.lake_monthly_revenue(m.order_lines(only=DELIVERED), m.products())


@query
def carrier_merge(m):
    return merges.carrier_merge(m.shipments(), m.scans())


@query
def scan_counts(m):
    return merges.scan_counts(m.scans())


@query
def shipment_merge(m):
    return merges.shipment_merge(m.shipments(), m.scans())


@query
def merge_match_counts(m):
    return merges.merge_match_counts(merges.product_merge_all_status(*_merge_args(m)),
                                     merges.shipment_merge(m.shipments(), m.scans()))


@query
def hourly_platform(m):
    return merges.hourly_platform(m.clickstream())


@query
def engagement(m):
    return merges.engagement(m.clickstream(merges.PRODUCT_EVENTS))


@query
def event_stats(m):
    return merges.event_stats(m.clickstream())


# ------------------------------------------------------------------ insights
def _monthly(m: Marketplace) -> DataFrame:
    return insights.month_category_revenue(m.order_lines(only=DELIVERED), m.products())


@query
def insight_funnel(m):
    return insights.insight_funnel(m.clickstream(merges.FUNNEL_STEPS))


@query
def monthly_trend(m):
    return insights.monthly_trend(_monthly(m))


@query
def insight_months(m):
    return insights.insight_months(_monthly(m))


@query
def insight_view_revenue(m):
    return insights.insight_view_revenue(merges.product_merge_all_status(*_merge_args(m)))


@query
def leak_products(m):
    return insights.leak_products(merges.product_merge_all_status(*_merge_args(m)))


@query
def view_revenue_points(m):
    return insights.view_revenue_points(merges.product_merge_all_status(*_merge_args(m)))


@query
def hour_matrix(m):
    return insights.hour_matrix(m.clickstream())


@query
def insight_hours(m):
    return insights.insight_hours(m.clickstream())


@query
def carrier_perf(m):
    return insights.carrier_perf(m.shipments(), m.scans())


@query
def insight_carriers(m):
    return insights.insight_carriers(m.shipments(), m.scans())


@query
def category_mix(m):
    return insights.category_mix(merges.product_merge_all_status(*_merge_args(m)))


@query
def insight_categories(m):
    return insights.insight_categories(
        insights.category_mix(merges.product_merge_all_status(*_merge_args(m))))


@query
def insight_report(m):
    # Both frames feed two charts each.
    monthly = materialise(_monthly(m))
    merged = materialise(merges.product_merge_all_status(*_merge_args(m)))
    return insights.insight_report(m.clickstream(), monthly, merged, m.shipments(), m.scans())


# ------------------------------------------------------------ shop and history
@query
def category_counts(m):
    return catalogue.category_counts(m.products())


@query
def product_search(m):
    return catalogue.product_search(m.products(shop=True), m.variants(), m.inventory(), m.reviews(),
                                    text="WIDGET")


@query
def customer_list(m):
    return catalogue.customer_list(m.customers())


@query
def inventory_lookup(m):
    asked = m.orders(only=("Pending", "Confirmed")).select("order_id")
    wanted = m.bare_lines().join(asked, "order_id", "left_semi").select("variant_id")
    return catalogue.inventory_lookup(m.inventory(), wanted)


@query
def product_popularity(m):
    return catalogue.product_popularity(m.products(), m.bare_lines())


@query
def user_history(m):
    return history.user_history(m.clickstream())


@query
def events_by_type_range(m):
    return history.events_by_type_range(m.clickstream(("product_view",)), "product_view", *EVENT_WINDOW)


@query
def session_replay(m):
    return history.session_replay(m.clickstream())


@query
def shipment_journey(m):
    return history.shipment_journey(m.scans())


@query
def session_chunks(m):
    """Small arrays, so that sessions have several here."""
    step = F.transform("events", lambda e: F.concat_ws(":", e["seq"], e["event_id"], e["event_type"], e["product_id"]))
    return history.session_chunks(m.clickstream(), 3).select(
        "session_id", "chunk", "first_seq", "n", F.array_join(step, ",").alias("steps"))


@query
def shipment_chunks(m):
    step = F.transform("scans", lambda s: F.concat_ws(":", s["seq"], s["order_id"], s["station"]))
    return history.shipment_chunks(m.scans(), 2).select(
        "tracking_no", "chunk", "first_seq", "n", F.array_join(step, ",").alias("steps"))


@query
def recent_events(m):
    return history.recent_events(m.clickstream())


@query
def scan_reconcile(m):
    return history.scan_reconcile(m.shipments(), m.scans())


# ----------------------------------------------------------------- integrity
@query
def dq_checks(m):
    lines = m.bare_lines().withColumn("unit_price", F.col("line_revenue"))
    due = _discounted(m).select("order_id", "discount")
    return quality.dq_checks({
        "customer": m.customers(), "seller": m.sellers(),
        "product": m.products(), "inventory": m.inventory(), "promotion": m.promotions(),
        "orders": m.orders().join(due, "order_id", "left"), "order_line": lines, "payment": m.payments(),
        "shipment": m.shipments(), "review": m.reviews()})


@query
def dq_unique(m):
    raw = m.table("lineitem")
    return quality.dq_unique([
        ("customer.pk", m.customers(), ["customer_id"]), ("seller.shop", m.sellers(), ["shop"]),
        ("product.pk", m.products(), ["product_id"]), ("variant.sku", m.variants(), ["sku"]),
        ("promotion.code", m.promotions(), ["promo_code"]), ("orders.pk", m.orders(), ["order_id"]),
        ("order_line.number", raw, ["l_orderkey", "l_linenumber"]),
        ("order_line.pk", m.bare_lines(), ["order_id", "variant_id"]),
        ("variant.pk", m.variants(), ["variant_id"]), ("inventory.pk", m.inventory(), ["variant_id"]),
        ("promotion.pk", m.promotions(), ["promotion_id"]), ("payment.order", m.payments(), ["order_id"]),
        ("shipment.order", m.shipments(), ["order_id"]), ("shipment.tracking", m.shipments(), ["tracking_no"]),
        ("review.once", m.reviews(), ["order_id", "product_id", "customer_id"])])


@query
def dq_orphans(m):
    lines, orders = m.bare_lines(), m.orders()
    return quality.dq_orphans([
        ("orders.customer", orders, "customer_id", m.table("customer"), "c_custkey"),
        ("orders.promotion", orders, "promotion_id", m.promotions(), "promotion_id"),
        ("order_line.order", lines, "order_id", orders, "order_id"),
        ("order_line.variant", lines, "variant_id", m.variants(), "variant_id"),
        ("product.seller", m.products(), "seller_id", m.table("supplier"), "s_suppkey"),
        ("variant.product", m.variants(), "product_id", m.products(), "product_id"),
        ("inventory.variant", m.inventory(), "variant_id", m.variants(), "variant_id"),
        ("payment.order", m.payments(), "order_id", orders, "order_id"),
        ("shipment.order", m.shipments(), "order_id", orders, "order_id"),
        ("review.product", m.reviews(), "product_id", m.products(), "product_id"),
        ("review.customer", m.reviews(), "customer_id", m.table("customer"), "c_custkey"),
        ("review.order", m.reviews(), "order_id", orders, "order_id"),
        ("event.product", m.clickstream(), "product_id", m.products(), "product_id"),
        ("event.user", m.clickstream(), "user_id", m.table("customer"), "c_custkey")])


@query
def cascade_delete(m):
    """What a delete of all unapproved products, half of the promotions, the cancelled orders, every
    tenth customer and every tenth seller would touch."""
    void = m.orders(only=("Cancelled",)).select("order_id")
    buyers = m.table("customer").select(F.col("c_custkey").alias("customer_id")).where("customer_id % 10 = 0")
    shops = m.table("supplier").select(F.col("s_suppkey").alias("seller_id")).where("seller_id % 10 = 0")
    gone = m.products().where("not is_approved").select("product_id")
    variants = m.variants().join(gone, "product_id", "left_semi")
    ended = m.promotions().where(F.col("promotion_id") % 2 == 0).select("promotion_id")
    return integrity.cascade_report([
        ("product-variant", "cascade", variants),
        ("variant-inventory", "cascade", m.inventory().join(variants.select("variant_id"), "variant_id", "left_semi")),
        ("product-review", "cascade", m.reviews().join(gone, "product_id", "left_semi")),
        ("variant-order_line", "restrict", integrity.restricted(variants, m.bare_lines(), "variant_id")),
        ("order-order_line", "cascade", m.bare_lines().join(void, "order_id", "left_semi")),
        ("order-payment", "cascade", m.payments().join(void, "order_id", "left_semi")),
        ("order-shipment", "cascade", m.shipments().join(void, "order_id", "left_semi")),
        ("order-review", "cascade", m.reviews().join(void, "order_id", "left_semi")),
        ("customer-orders", "restrict", integrity.restricted(buyers, m.orders(), "customer_id")),
        ("seller-product", "cascade", m.products().join(shops, "seller_id", "left_semi")),
        ("promotion-orders", "set null", m.orders().join(ended, "promotion_id", "left_semi")),
        ("product-review", "kept", integrity.cascaded(m.reviews(), gone, "product_id")),
        ("promotion-orders", "without", integrity.set_null(m.orders(), ended, "promotion_id")
         .where(F.col("promotion_id").isNull()))])


def references() -> list[deletes.Reference]:
    """What each reference of the model does when its parent goes; fixed values."""
    return [deletes.Reference(*row) for row in (
        ("product", "seller_id", "seller", deletes.CASCADE),
        ("variant", "product_id", "product", deletes.CASCADE),
        ("inventory", "variant_id", "variant", deletes.CASCADE),
        ("orders", "customer_id", "customer", deletes.RESTRICT),
        ("orders", "promotion_id", "promotion", deletes.SET_NULL),
        ("order_line", "order_id", "orders", deletes.CASCADE),
        ("order_line", "variant_id", "variant", deletes.RESTRICT),
        ("payment", "order_id", "orders", deletes.CASCADE),
        ("shipment", "order_id", "orders", deletes.CASCADE),
        ("review", "product_id", "product", deletes.CASCADE),
        ("review", "customer_id", "customer", deletes.CASCADE),
        ("review", "order_id", "orders", deletes.CASCADE))]


def keyed_tables(m: Marketplace) -> dict[str, DataFrame]:
    """The tables of the model by name, each with its key and its references."""
    def pair(a: str, b: str):
        return F.concat_ws("-", a, b)
    orders = m.orders()
    return {
        "seller": m.table("supplier").select(F.col("s_suppkey").alias("key")),
        "customer": m.table("customer").select(F.col("c_custkey").alias("key")),
        "promotion": m.promotions().select(F.col("promotion_id").alias("key")),
        "product": m.products().select(F.col("product_id").alias("key"), "seller_id"),
        "variant": m.variants().select(F.col("variant_id").alias("key"), "product_id"),
        "inventory": m.inventory().select(F.col("variant_id").alias("key"), "variant_id"),
        "orders": orders.select(F.col("order_id").alias("key"), "customer_id", "promotion_id"),
        "order_line": stock.one_line_per_order(m.bare_lines()).select(
            pair("order_id", "variant_id").alias("key"), "order_id", "variant_id"),
        "payment": m.payments().select(F.col("order_id").alias("key"), "order_id"),
        "shipment": m.shipments().select(F.col("order_id").alias("key"), "order_id"),
        "review": m.reviews().select(pair("order_id", "product_id").alias("key"), "product_id", "customer_id", "order_id")}


@query
def delete_chain(m):
    """What deletes of unapproved products, every tenth seller and customer, the cancelled orders and half of
    the promotions would touch, followed to the end; a restriction anywhere blocks its whole delete."""
    roots = {
        "product": m.products().where("not is_approved").select(F.col("product_id").alias("key")),
        "seller": m.table("supplier").where("s_suppkey % 10 = 0").select(F.col("s_suppkey").alias("key")),
        "customer": m.table("customer").where("c_custkey % 10 = 0").select(F.col("c_custkey").alias("key")),
        "orders": m.orders(only=("Cancelled",)).select(F.col("order_id").alias("key")),
        "promotion": m.promotions().where("promotion_id % 2 = 0").select(F.col("promotion_id").alias("key"))}
    return deletes.Deletion(keyed_tables(m), references(), roots).report()


@query
def orders_with_lines(m):
    return integrity.orders_with_lines(m.orders(), m.bare_lines())


@query
def review_eligible(m):
    return integrity.review_eligible(m.reviews(), m.order_lines(only=DELIVERED))


@query
def review_rejected(m):
    return integrity.review_rejected(m.reviews(), m.order_lines(only=DELIVERED))


def _affected(m: Marketplace) -> DataFrame:
    reviews, lines = m.reviews(), m.order_lines(only=DELIVERED)
    return integrity.affected_sellers(integrity.review_eligible(reviews, lines),
                                      integrity.review_rejected(reviews, lines), m.products())


@query
def affected_sellers(m):
    return _affected(m)


@query
def seller_rating(m):
    accepted = integrity.review_eligible(m.reviews(), m.order_lines(only=DELIVERED))
    everyone = m.sellers().select("seller_id")
    return integrity.seller_rating(everyone, accepted, m.products())


@query
def care_queue(m):
    return integrity.care_queue(m.reviews(), m.products(shop=True), m.orders())


@query
def order_discount(m):
    return _discounted(m).select("order_id", "total", "discount")


@query
def order_totals(m):
    return integrity.order_totals(_discounted(m))


@query
def price_drift(m):
    return integrity.price_drift(m.bare_lines(), m.variants(), m.products())


@query
def status_derivation(m):
    return integrity.status_derivation(m.orders())


@query
def promo_out_of_window(m):
    return integrity.promo_out_of_window(m.orders(), m.promotions())


def _status_changes(m: Marketplace) -> DataFrame:
    """The latest status change of every order; the data keep the new status only."""
    key = F.col("order_id")
    old = F.when(key % 7 == 0, "Cancelled").when(key % 3 == 0, "Shipping").otherwise("Pending")
    return m.orders().select("order_id", old.alias("old_status"), F.col("status").alias("new_status"))


@query
def failed_payment_cancels(m):
    before = _status_changes(m).select("order_id", F.col("old_status").alias("status"))
    return integrity.failed_payment_cancels(before, m.payments())


@query
def orders_to_purchase_events(m):
    return integrity.orders_to_purchase_events(m.orders(), m.order_totals())


@query
def purchase_products(m):
    """The products of each order's purchase, written as documents with a list and read back under their schema."""
    path = new_folder(m.spark, "purchase-documents")
    bought = placement.purchase_events(placement.order_documents(m.bare_lines(), m.orders()))
    documents.write_documents(documents.purchase_documents(bought), path)
    return documents.purchased_products(documents.read_events(m.spark, path))


@query
def curated_refresh(m):
    """The raw zone is replaced after a first refresh; the second one finds what has changed."""
    raw, curated = new_folder(m.spark, "raw"), new_folder(m.spark, "curated")
    events = m.clickstream()
    for rows in (events.where(F.col("source") == "mock"), events):
        lake.write_by_month(rows, raw)
        refresh.refresh(m.spark, raw, curated, merges.monthly_activity)
    return refresh.read_curated(m.spark, curated)


@query
def recent_lake_events(m):
    return history.recent_lake_events(m.spark, _event_lake(m))


# --------------------------------------------------------------------- stock
def _on_hand(m: Marketplace) -> DataFrame:
    return m.inventory().select("variant_id", F.col("quantity_on_hand").cast("bigint").alias("on_hand"))


@query
def stock_set_check(m):
    return stock.set_shortages(m.bare_lines(), _on_hand(m))


@query
def stock_set_allocate(m):
    return stock.set_allocate(m.bare_lines(), _on_hand(m))


@query
def restock(m):
    return stock.restock(_status_changes(m), m.bare_lines(), _on_hand(m))


@query
def stock_line_greedy(m):
    return stock.allocate_lines(stock.one_line_per_order(m.bare_lines()), _on_hand(m))


@query
def stock_order_atomic(m):
    return stock.allocate_orders(stock.one_line_per_order(m.bare_lines()), _on_hand(m))


# ----------------------------------------------------------------- streaming
@query
def stream_ingest(m):
    source, out = new_folder(m.spark, "arrivals"), new_folder(m.spark, "events")
    documents.write_documents(documents.as_documents(m.clickstream()), source)
    event_streams.ingest(m.spark, source, out, new_folder(m.spark, "progress")).awaitTermination()
    return lake.read_by_month(m.spark, out).select(
        "event_id", "session_id", "user_id", "event_type", "timestamp", "platform", "province", "channel",
        "product_id", "revenue", "source", "event_month")


class _Live(Marketplace):
    """The same model with one table read as a stream."""

    def __init__(self, m: Marketplace, live: str):
        super().__init__(m.spark, m.folder)
        self.live = live

    def table(self, name: str) -> DataFrame:
        return stream_table(self.spark, self.folder, name) if name == self.live else super().table(name)


@query
def stream_event_stats(m):
    out = new_folder(m.spark, "stats")
    event_streams.run_event_stats(_Live(m, "events").clickstream(), out,
                                  new_folder(m.spark, "progress")).awaitTermination()
    return event_streams.latest(m.spark, out, ["event_type"], "events")


@query
def stream_hourly(m):
    out = new_folder(m.spark, "hourly")
    timed = _Live(m, "events").clickstream().withColumn("ts", F.col("ts").cast("timestamp"))
    event_streams.run_hourly(timed, out, new_folder(m.spark, "progress")).awaitTermination()
    return event_streams.latest(m.spark, out, ["hour_start", "platform"], "events")


@query
def stream_stock(m):
    out = new_folder(m.spark, "served")
    stock_stream.run_batches(_Live(m, "lineitem").bare_lines(), _on_hand(m), out,
                             new_folder(m.spark, "progress")).awaitTermination()
    return stock_stream.served(m.spark, out).groupBy("variant_id").agg(
        F.count("*").alias("lines"), F.count_if("accepted").alias("accepted"),
        F.sum(F.when(F.col("accepted"), F.col("quantity")).otherwise(0)).alias("units"))


#: Deliveries that the tables are cut into for the streams below.
DELIVERIES = 3


def _deliver(df: DataFrame, key: str, file_format: str, follow: Callable[[str], StreamingQuery]) -> None:
    """``df`` arrives in a folder in deliveries by ascending ranges of a number; the stream that ``follow`` starts on the folder
    takes each one before the next arrives.

    A delivery has as many files as its rows need, and is one micro-batch.
    """
    path, rows = new_folder(df.sparkSession, "deliveries"), materialise(df)
    cuts = rows.approxQuantile(key, [i / DELIVERIES for i in range(1, DELIVERIES)], 0.01)
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = rows if low is None else rows.where(F.col(key) > low)
        part = part if high is None else part.where(F.col(key) <= high)
        part.write.mode("append").format(file_format).save(path)
        follow(path).awaitTermination()


def _placed(m: Marketplace) -> str:
    """Where the orders of the model were placed, as three deliveries of order documents."""
    out, progress = new_folder(m.spark, "placed"), new_folder(m.spark, "progress")
    _deliver(placement.order_documents(m.bare_lines(), m.orders()), "order_id", "json",
             lambda source: placement.run_placement(placement.read_orders(m.spark, source, None), _on_hand(m), out, progress))
    return out


@query
def stream_orders(m):
    return placement.decisions(m.spark, _placed(m)).select("order_id", "accepted")


@query
def stream_purchase_events(m):
    events = placement.logged(m.spark, _placed(m))
    return events.select("event_id", "session_id", "user_id", "event_type", "timestamp", "event_month", "order_id", "revenue",
                         F.array_join("product_ids", ",").alias("products"), "payment_method", "source")


@query
def stream_restock(m):
    out, progress = new_folder(m.spark, "returned"), new_folder(m.spark, "progress")
    _deliver(_status_changes(m), "order_id", "parquet", lambda source: views.run_returned_units(
        views.read_changes(m.spark, source, views.STATUS_CHANGE, None), m.bare_lines(), out, progress))
    return views.stock_view(m.spark, _on_hand(m), out)


def _review_changes(m: Marketplace) -> DataFrame:
    """Every review is written; every seventh order's is changed afterwards, every fifth order's deleted in the end."""
    new, key = m.reviews(), F.col("order_id")
    head = ["order_id", "customer_id", "product_id"]
    none, changed = F.lit(None).cast("int"), (1 + F.col("rating") % 5).cast("int")
    steps = [(F.lit(True), none, F.col("rating")), (key % 7 == 1, F.col("rating"), changed),
             (key % 5 == 0, F.when(key % 7 == 1, changed).otherwise(F.col("rating")), none)]
    return new.select(*head, F.explode(F.filter(F.array(*[
        F.struct(F.lit(i).alias("step"), when.alias("applies"), old.cast("int").alias("old_rating"), to.cast("int").alias("new_rating"))
        for i, (when, old, to) in enumerate(steps)]), lambda s: s["applies"])).alias("s")).select(
        *head, "s.step", "s.old_rating", "s.new_rating")


@query
def stream_seller_rating(m):
    out, progress = new_folder(m.spark, "ratings"), new_folder(m.spark, "progress")
    _deliver(_review_changes(m).drop("step"), "order_id", "parquet", lambda source: views.run_rating_sums(
        views.read_changes(m.spark, source, views.REVIEW_CHANGE, None), m.products(), out, progress))
    return views.rating_view(m.spark, m.sellers(), out)


# ------------------------------------------------------------------ catalogue
# The code of each business question and the query that answers it.
CODES = {
    "YC01": ("revenue_month_category", "Revenue by month and category"),
    "YC02": ("top_sellers_in_range", "Best-selling products of a period"),
    "YC03": ("rfm", "Customer segments by recency, frequency and spend"),
    "YC04": ("cancel_rate", "Cancelled orders by province"),
    "YC05": ("low_stock", "Stock below the safety level"),
    "YC06": ("seller_scorecard", "Seller performance"),
    "YC07": ("aov_month_channel", "Average order value by month and payment method"),
    "YC08": ("promotion_effect", "Effect of promotions"),
    "YC09": ("delivery_time", "Delivery time by carrier"),
    "YC10": ("low_rating_rate", "Low ratings by category"),
}


def query_catalog(spark: SparkSession) -> DataFrame:
    rows = [(code, name, title) for code, (name, title) in sorted(CODES.items())]
    return spark.createDataFrame(rows, "code string, query string, title string")


def answer(name: str, m: Marketplace) -> DataFrame:
    """A query over any marketplace, for instance one with bucketed tables."""
    return BUILDERS[name](prepared(m))


def run_code(code: str, spark: SparkSession, folder: str, limit: int | None = None) -> DataFrame:
    """Answer a business question by its code; with a limit, the first rows by the answer's columns from left to right."""
    if code.upper() not in CODES:
        raise KeyError(f"unknown query code {code}")
    found = QUERIES[CODES[code.upper()][0]](spark, folder)
    return found if limit is None else found.orderBy(*found.columns).limit(limit)
