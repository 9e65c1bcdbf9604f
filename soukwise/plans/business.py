"""The ten business questions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soukwise.functions.exact import half_up, money_average, percent, seconds_between, zero_money
from soukwise.operators.percentile import percentile_hundredths
from soukwise.operators.ranking import global_ranks, ntiles
from soukwise.session import materialise

DAY = 86_400


def month_of(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month")


def delivered(df: DataFrame) -> DataFrame:
    return df.where(F.col("status") == "Delivered")


def revenue_month_category(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Delivered orders, units and revenue by month and category."""
    sold = delivered(lines).select("order_id", "product_id", "quantity", "line_revenue",
                                   month_of(F.col("order_date")).alias("month"))
    return (sold.join(products.select("product_id", "category"), "product_id")
            .groupBy("month", "category")
            .agg(F.count_distinct("order_id").alias("orders"), F.sum("quantity").alias("units"),
                 F.sum("line_revenue").alias("revenue")))


def top_sellers_in_range(lines: DataFrame, products: DataFrame, first: date, last: date,
                         n: int = 10) -> DataFrame:
    """Best-selling products of a period; the end day counts in full."""
    until = F.lit(last).cast("timestamp_ntz") + F.expr("interval 1 day")
    sold = delivered(lines).where((F.col("order_date") >= F.lit(first).cast("timestamp_ntz"))
                                  & (F.col("order_date") < until))
    top = (sold.groupBy("product_id")
           .agg(F.sum("quantity").alias("units"), F.sum("line_revenue").alias("revenue"))
           .orderBy(F.desc("units"), "product_id").limit(n))
    # Names are looked up for n rows only.
    return (products.select("product_id", "product_name", "category", "shop")
            .join(top, "product_id").orderBy(F.desc("units"), "product_id"))


def rfm(lines: DataFrame, customers: DataFrame, as_of: date, buckets: int | None = None) -> DataFrame:
    """Recency, frequency and spend of every buyer, scored 1 to 5, and the segment they imply."""
    per_order = (delivered(lines).groupBy("order_id", "customer_id", "order_date")
                 .agg(F.sum("line_revenue").alias("total")))
    base = (per_order.groupBy("customer_id")
            .agg(F.datediff(F.lit(as_of), F.max("order_date").cast("date")).alias("recency"),
                 F.count("*").alias("frequency"), F.sum("total").alias("monetary")))
    scored = ntiles(base, 5, {"r": ("recency", True), "f": ("frequency", False),
                              "m": ("monetary", False)}, "customer_id", buckets)
    r, f, m = F.col("r"), F.col("f"), F.col("m")
    segment = (F.when((r >= 4) & (f >= 4) & (m >= 4), "VIP-Champions")
               .when((r >= 3) & (f >= 3), "Loyal")
               .when((r >= 4) & (f <= 2), "Promising")
               .when((r <= 2) & (f >= 3), "At-risk")
               .otherwise("Regular"))
    return (scored.join(customers.select("customer_id", "full_name", "province"), "customer_id")
            .select("customer_id", "full_name", "province", "recency", "frequency", "monetary",
                    "r", "f", "m", segment.alias("segment")))


def rfm_segments(scores: DataFrame) -> DataFrame:
    return scores.groupBy("segment").agg(F.count("*").alias("customers"),
                                         F.sum("monetary").alias("monetary"))


def cancel_rate(orders: DataFrame) -> DataFrame:
    """Cancelled share per province and its most common reason (smallest text on ties)."""
    per_reason = (orders.groupBy("ship_province", "cancel_reason")
                  .agg(F.count("*").alias("n"), F.count_if(F.col("status") == "Cancelled").alias("c")))
    reason = F.col("cancel_reason")
    weight = F.when(reason.isNotNull(), F.struct(-F.col("n"), reason))
    return (per_reason.groupBy(F.col("ship_province").alias("province"))
            .agg(F.sum("n").alias("orders"), F.sum("c").alias("cancelled"),
                 F.min_by(reason, weight).alias("top_reason"))
            .select("province", "orders", "cancelled",
                    percent(F.col("cancelled"), F.col("orders")).alias("cancel_pct"), "top_reason"))


def low_stock(inventory: DataFrame, variants: DataFrame, products: DataFrame) -> DataFrame:
    """Variants below their safety stock."""
    held, safe = F.col("quantity_on_hand"), F.col("safety_stock")
    level = F.when(held == 0, "OUT").when(held * 2 < safe, "CRITICAL").otherwise("WARN")
    return (inventory.where(held < safe)
            .join(variants.select("variant_id", "product_id", "sku"), "variant_id")
            .join(products.select("product_id", "product_name", "category", "shop"), "product_id")
            .select("sku", "product_name", "category", "shop", held.alias("on_hand"), safe.alias("safety"),
                    (safe - held).alias("shortfall"), level.alias("level")))


def seller_scorecard(sellers: DataFrame, products: DataFrame, lines: DataFrame, reviews: DataFrame,
                     buckets: int | None = None) -> DataFrame:
    """Sales, range and ratings per seller. Each branch is summed before it is joined, so none
    multiplies another."""
    owner = products.select("product_id", "seller_id")
    sales = (delivered(lines).select("order_id", "product_id", "line_revenue").join(owner, "product_id")
             .groupBy("seller_id")
             .agg(F.count_distinct("order_id").alias("delivered_orders"),
                  F.sum("line_revenue").alias("revenue")))
    listed = products.groupBy("seller_id").agg(F.count("*").alias("products"))
    marks = (reviews.groupBy("product_id")
             .agg(F.count("*").alias("n"), F.sum("rating").alias("stars"))
             .join(owner, "product_id").groupBy("seller_id")
             .agg(F.sum("n").alias("reviews"), F.sum("stars").alias("stars")))
    table = (sellers.join(sales, "seller_id", "left").join(listed, "seller_id", "left")
             .join(marks, "seller_id", "left")
             .select("seller_id", "shop", "province",
                     F.coalesce("delivered_orders", F.lit(0)).alias("delivered_orders"),
                     F.coalesce("revenue", zero_money()).alias("revenue"),
                     F.coalesce("products", F.lit(0)).alias("products"),
                     half_up(F.col("stars"), F.col("reviews")).alias("avg_rating"),
                     F.coalesce("reviews", F.lit(0)).alias("reviews")))
    # Ranked in whole cents, which a double holds exactly.
    ranked = global_ranks(table.withColumn("_cents", (F.col("revenue") * 100).cast("decimal(38,0)")),
                          "_cents", "seller_id", descending=True, buckets=buckets)
    return ranked.select(*table.columns, F.col("rank").alias("revenue_rank"))


def order_values(discounted: DataFrame) -> DataFrame:
    return discounted.withColumn("order_value", F.col("total") - F.col("discount"))


def aov_month_channel(discounted: DataFrame, payments: DataFrame) -> DataFrame:
    """Average value of delivered and paid orders by month and payment method."""
    paid = payments.where(F.col("status") == "Paid").select("order_id", "method")
    return (order_values(delivered(discounted)).join(paid, "order_id")
            .groupBy(month_of(F.col("order_date")).alias("month"), "method")
            .agg(F.count("*").alias("orders"), F.sum("order_value").alias("revenue"))
            .select("month", "method", "orders",
                    money_average(F.col("revenue"), F.col("orders")).alias("aov"), "revenue"))


def promotion_effect(promotions: DataFrame, discounted: DataFrame) -> DataFrame:
    """Delivered orders with each promotion, next to the average order that used none.

    One grouping serves both: orders without a promotion are the NULL group. It has a
    row per promotion and is stored, because it is read twice.
    """
    per_promo = materialise(delivered(discounted).groupBy("promotion_id")
                            .agg(F.count("*").alias("orders"), F.sum("total").alias("gross"),
                                 F.sum("discount").alias("discount")))
    without = per_promo.agg(F.max(F.when(F.col("promotion_id").isNull(),
                                         money_average(F.col("gross"), F.col("orders")))))
    return (promotions.join(per_promo, "promotion_id", "left")
            .select("promo_code", "discount_pct", "start_date", "end_date",
                    F.coalesce("orders", F.lit(0)).alias("orders"),
                    F.coalesce("gross", zero_money()).alias("gross"),
                    F.coalesce("discount", zero_money()).alias("discount"),
                    money_average(F.col("gross"), F.col("orders")).alias("aov_with"),
                    without.scalar().alias("aov_without")))


def delivery_time(shipments: DataFrame) -> DataFrame:
    """Shipments per carrier with mean and exact 95th percentile of the days on the road.

    Shipments are counted by carrier, status and duration in one pass; everything else
    is read from those counts.
    """
    counted = materialise(
        shipments.where(F.col("shipped_at").isNotNull())
        .groupBy("carrier", "status",
                 seconds_between(F.col("shipped_at"), F.col("delivered_at")).alias("seconds"))
        .agg(F.count("*").alias("n")))
    n = F.col("n")

    def rows_with(condition: Column) -> Column:
        return F.sum(F.when(condition, n).otherwise(0))

    totals = counted.groupBy("carrier").agg(
        F.sum(n).alias("shipments"), rows_with(F.col("status") == "Delivered").alias("delivered"),
        rows_with(F.col("status") == "Failed").alias("failed"),
        F.sum(F.col("seconds") * n).alias("seconds"),
        rows_with(F.col("seconds").isNotNull()).alias("timed"))
    p95 = percentile_hundredths(counted, "carrier", "seconds", "n", 95, width=DAY)
    return totals.join(p95, "carrier", "left").select(
        "carrier", "shipments", "delivered", "failed",
        half_up(F.col("seconds"), F.col("timed") * DAY).alias("avg_days"),
        half_up(F.col("hundredths"), F.lit(100 * DAY)).alias("p95_days"))


def low_rating_rate(reviews: DataFrame, products: DataFrame, min_pct: float = 0,
                    by: str = "category") -> DataFrame:
    """Share of reviews with two stars or fewer; ``by`` is category, seller or both."""
    keys = {"category": ["category"], "seller": ["seller_id"], "both": ["category", "seller_id"]}[by]
    per_product = reviews.groupBy("product_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("rating") <= 2).alias("bad"),
        F.sum("rating").alias("stars"))
    return (per_product.join(products.select("product_id", *keys), "product_id").groupBy(*keys)
            .agg(F.sum("n").alias("reviews"), F.sum("bad").alias("low"), F.sum("stars").alias("stars"))
            .select(*keys, "reviews", "low", percent(F.col("low"), F.col("reviews")).alias("low_pct"),
                    half_up(F.col("stars"), F.col("reviews")).alias("avg_rating"))
            .where(F.col("low_pct") >= min_pct))
