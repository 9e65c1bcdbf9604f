"""The marketplace model over a folder of Parquet tables.

Each method is a lazy DataFrame. Attributes that cost a join (a shop name, a
province) are added on request only, because an inner join that nobody reads
is still a shuffle of the whole fact table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from soukwise.functions.exact import MONEY, cents
from soukwise.sources.tables import read_table

# Fixed values of the model.
ORDER_STATUS = ("Pending", "Confirmed", "Shipping", "Delivered", "Cancelled", "Returned")
PAYMENT_STATUS = ("Pending", "Paid", "Failed", "Refunded")
PAYMENT_METHOD = ("COD", "CreditCard", "EWallet", "BankTransfer")
SHIPMENT_STATUS = ("Preparing", "Picked", "InTransit", "Delivered", "Failed")
EVENT_TYPES = ("page_view", "search", "product_view", "add_to_cart", "remove_from_cart",
               "checkout_start", "purchase")


def payment_status_for(order_status: Column) -> Column:
    """NULL for a state that is not one of the model's."""
    return (F.when(order_status == "Pending", "Pending")
            .when(order_status == "Cancelled", "Failed")
            .when(order_status == "Returned", "Refunded")
            .when(order_status.isin("Confirmed", "Shipping", "Delivered"), "Paid"))


def shipment_status_for(order_status: Column) -> Column:
    """NULL for orders that never leave the warehouse."""
    return (F.when(order_status == "Delivered", "Delivered")
            .when(order_status == "Shipping", "InTransit")
            .when(order_status == "Returned", "Failed"))


# What the raw codes mean.
RAW_STATUS = {"Delivered": "F", "Pending": "O", "Confirmed": "O", "Shipping": "O", "Cancelled": "P",
              "Returned": "P"}
RAW_EVENT = {"product_view": "view", "add_to_cart": "click", "checkout_start": "signup",
             "remove_from_cart": "error", "purchase": "purchase"}


def _order_status() -> Column:
    key, raw = F.col("o_orderkey"), F.col("o_orderstatus")
    return (F.when(raw == "F", "Delivered")
            .when((raw == "O") & (key % 10 < 2), "Pending")
            .when((raw == "O") & (key % 10 < 5), "Confirmed")
            .when(raw == "O", "Shipping")
            .when((raw == "P") & (key % 10 < 7), "Cancelled").when(raw == "P", "Returned"))


def tracking_number(order_id: Column) -> Column:
    return F.concat(F.lit("TRK"), F.lpad(order_id.cast("string"), 8, "0"))


class Marketplace:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)

    # ------------------------------------------------------------ dimensions
    def sellers(self) -> DataFrame:
        return (self.table("supplier")
                .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
                .select(F.col("s_suppkey").alias("seller_id"), F.col("s_name").alias("shop"),
                        F.col("n_name").alias("province")))

    def customers(self) -> DataFrame:
        return (self.table("customer")
                .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
                .select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name"),
                        F.col("n_name").alias("province"), F.col("c_mktsegment").alias("segment")))

    @property
    def _seller_count(self) -> Column:
        """A scalar subquery: counted when a query that needs it runs."""
        return self.table("supplier").agg(F.count("*")).scalar()

    def products(self, shop: bool = False) -> DataFrame:
        base = self.table("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            (F.col("p_partkey") % self._seller_count).alias("seller_id"),
            F.col("p_retailprice").cast(MONEY).alias("base_price"),
            (F.col("p_partkey") % 25 >= 2).alias("is_approved"))
        if not shop:
            return base
        names = self.table("supplier").select(F.col("s_suppkey").alias("seller_id"),
                                              F.col("s_name").alias("shop"))
        return (base.join(names, "seller_id")
                .select("product_id", "product_name", "category", "shop", "seller_id",
                        "base_price", "is_approved"))

    def variants(self) -> DataFrame:
        return (self.table("part")
                .select("p_partkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
                .select((F.col("p_partkey") * 2 + F.col("k")).alias("variant_id"),
                        F.col("p_partkey").alias("product_id"),
                        F.concat(F.lit("SKU-"), F.lpad(F.col("p_partkey").cast("string"), 6, "0"),
                                 F.lit("-"), F.col("k").cast("string")).alias("sku"),
                        (F.col("k") * 10).cast(MONEY).alias("price_adjust")))

    def inventory(self) -> DataFrame:
        return self.variants().select(
            "variant_id",
            ((F.col("variant_id") * 37) % 900).cast("int").alias("quantity_on_hand"),
            F.when(F.col("variant_id") % 3 == 0, 10).when(F.col("variant_id") % 3 == 1, 20)
            .otherwise(50).alias("safety_stock"))

    def promotions(self) -> DataFrame:
        key = F.col("n_nationkey")
        pct = (F.when(key % 6 == 0, 5).when(key % 6 == 1, 10).when(key % 6 == 2, 15)
               .when(key % 6 == 3, 20).when(key % 6 == 4, 30).otherwise(50))
        cap = F.when(key % 4 == 0, 5000).when(key % 4 == 1, 10000).when(key % 4 == 2, 20000).otherwise(50000)
        year = 1995 + key % 6
        month = 1 + key % 12
        return (self.table("nation")
                .select(key.alias("promotion_id"),
                        F.concat(F.lit("SALE"), F.lpad(key.cast("string"), 2, "0")).alias("promo_code"),
                        pct.cast("decimal(5,2)").alias("discount_pct"), cap.cast(MONEY).alias("max_discount"),
                        F.make_date(year, month, F.lit(1)).alias("start_date"),
                        F.make_date(year, month, F.lit(28)).alias("end_date")))

    # ----------------------------------------------------------------- facts
    def _raw_orders(self, only: tuple[str, ...]) -> DataFrame:
        """Orders in the given states. The raw code is tested as well: Parquet can skip by it,
        but not by the status derived from it."""
        raw = self.table("orders")
        if not only:
            return raw.withColumn("status", _order_status())
        codes = sorted({RAW_STATUS[s] for s in only})
        return (raw.where(F.col("o_orderstatus").isin(codes)).withColumn("status", _order_status())
                .where(F.col("status").isin(*only)))

    def orders(self, province: bool = False, only: tuple[str, ...] = ()) -> DataFrame:
        key = F.col("o_orderkey")
        base = self._raw_orders(only).select(
            key.alias("order_id"), F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_date"), "status",
            F.when(F.col("status") == "Cancelled", F.col("o_orderpriority")).alias("cancel_reason"),
            F.when(key % 25 < 7, F.call_function("div", key, F.lit(25)) % 25).alias("promotion_id"))
        if not province:
            return base
        homes = self.customers().select("customer_id", F.col("province").alias("ship_province"))
        return base.join(homes, "customer_id")

    def order_lines(self, province: bool = False, only: tuple[str, ...] = ()) -> DataFrame:
        """Lines with the head of their order, joined on the order number."""
        return self.bare_lines().join(self.orders(province, only), "order_id")

    def bare_lines(self) -> DataFrame:
        """Lines without their order head: one scan, no join."""
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
            (F.col("l_partkey") * 2 + F.col("l_linenumber") % 2).alias("variant_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").cast(MONEY).alias("line_revenue"))

    def order_line_wide(self) -> DataFrame:
        """The six-way star: lines, order, variant, product, category and shop."""
        return self.order_lines(province=True).join(self.products(shop=True), "product_id").select(
            "order_id", "customer_id", "order_date", "status", "ship_province", "promotion_id",
            "variant_id", "quantity", "line_revenue", "product_id", "seller_id", "category",
            "product_name", "shop")

    def order_totals(self) -> DataFrame:
        return (self.bare_lines().groupBy("order_id")
                .agg(F.sum("line_revenue").alias("total"), F.sum("quantity").alias("units")))

    def payments(self) -> DataFrame:
        return self._raw_orders(()).select(
            F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("method"),
            payment_status_for(F.col("status")).alias("status"),
            F.col("o_totalprice").cast(MONEY).alias("amount"))

    def shipments(self) -> DataFrame:
        """First and last ship date per order; lines shrink to one row before the join."""
        span = (self.table("lineitem").groupBy(F.col("l_orderkey").alias("order_id"))
                .agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")))
        shipped = (self.orders(only=("Shipping", "Delivered", "Returned"))
                   .select("order_id", F.col("status").alias("order_status")))
        return span.join(shipped, "order_id").select(
            "order_id", tracking_number(F.col("order_id")).alias("tracking_no"),
            F.concat(F.lit("CARRIER_"), (F.col("order_id") % 5).cast("string")).alias("carrier"),
            shipment_status_for(F.col("order_status")).alias("status"),
            F.col("first_ship").alias("shipped_at"),
            F.when(F.col("order_status") != "Shipping", F.col("last_ship")).alias("delivered_at"))

    def scans(self) -> DataFrame:
        """Parcel scan log: a scan for every line. Orders that never left have scans but no shipment."""
        return self.table("lineitem").select(
            tracking_number(F.col("l_orderkey")).alias("tracking_no"),
            F.col("l_orderkey").alias("order_id"),
            F.concat(F.lit("ST_"), (F.col("l_suppkey") % 7).cast("string")).alias("station"),
            F.col("l_shipdate").alias("scanned_at"))

    def reviews(self) -> DataFrame:
        marks = self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), "l_quantity")
        buyers = self.table("orders").select(F.col("o_orderkey").alias("order_id"),
                                             F.col("o_custkey").alias("customer_id"))
        # Joined first, so that the grouping runs on the join's partitioning.
        return (marks.join(buyers, "order_id").groupBy("order_id", "product_id", "customer_id")
                .agg((1 + F.max(F.col("l_quantity").cast("int")) % 5).alias("rating")))

    def clickstream(self, only: tuple[str, ...] = ()) -> DataFrame:
        """Behaviour events, all or of some types; a type is tested by its raw code, as for orders."""
        kind, user = F.col("event_type"), F.col("user_id")
        raw = self.table("events")
        if only:
            raw = raw.where(kind.isin([RAW_EVENT[t] for t in only]))
        step = (F.when(kind == "view", "product_view").when(kind == "click", "add_to_cart")
                .when(kind == "signup", "checkout_start").when(kind == "error", "remove_from_cart")
                .when(kind == "purchase", "purchase"))
        platform = (F.when(user % 4 == 0, "android").when(user % 4 == 1, "ios")
                    .when(user % 4 == 2, "mobile_web").otherwise("desktop_web"))
        return raw.select(
            "event_id", "ts", F.date_format("ts", "yyyy-MM").alias("event_month"), "user_id",
            F.concat(F.coalesce(user.cast("string"), F.lit("guest")), F.lit("-"), F.date_format("ts", "yyyyMMdd"))
            .alias("session_id"),
            step.alias("event_type"),
            F.when(kind.isin("view", "click", "error"),
                   F.get_json_object("props", "$.k").cast("bigint")).alias("product_id"),
            platform.alias("platform"),
            F.when(kind == "purchase", F.col("value").cast(MONEY)).alias("revenue"),
            F.when(F.col("event_id") % 10 == 0, "live_ui").otherwise("mock").alias("source"))


class CatalogMarketplace(Marketplace):
    """The model over catalog tables, named ``prefix`` plus the table name; tables the catalog
    lacks are read from the folder.

    With lines and orders bucketed by order number (see ``lake.bucket_facts``) the
    order join and every grouping by order run without a shuffle.
    """

    def __init__(self, spark: SparkSession, folder: str, prefix: str):
        super().__init__(spark, folder)
        self.prefix = prefix

    def table(self, name: str) -> DataFrame:
        full = f"{self.prefix}{name}"
        return self.spark.table(full) if self.spark.catalog.tableExists(full) else super().table(name)


def discounts(totals: DataFrame, orders: DataFrame, promotions: DataFrame,
              enforce_window: bool = False) -> DataFrame:
    """Order totals with the order's head and its discount: the promotion's share of the total,
    at most its cap."""
    offer = promotions.select(F.col("promotion_id").alias("_offer"), "discount_pct", "max_discount",
                              "start_date", "end_date")
    # Most orders have no promotion. Each of those gets a key of its own that matches
    # nothing, so that they do not meet in one task if the join has to shuffle.
    spread = F.coalesce(F.col("promotion_id"), -1 - F.col("order_id"))
    joined = (totals.join(orders.select("order_id", "promotion_id", "order_date", "status"), "order_id")
              .withColumn("_offer", spread).join(offer, "_offer", "left"))
    usable = F.col("discount_pct").isNotNull()
    if enforce_window:
        usable &= F.col("order_date").cast("date").between(F.col("start_date"), F.col("end_date"))
    share = F.call_function("div", cents(F.col("total")) * cents(F.col("discount_pct")) + 5000,
                            F.lit(10000).cast("decimal(38,0)"))
    amount = F.least((share.cast("decimal(20,0)") * F.lit(0.01).cast("decimal(3,2)")).cast(MONEY),
                     F.col("max_discount"))
    return joined.select(*totals.columns, "promotion_id", "order_date", "status",
                         F.when(usable, amount).otherwise(F.lit(0).cast(MONEY)).alias("discount"))
