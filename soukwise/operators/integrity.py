"""Cross-table rules as jobs over sets of changes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soukwise.functions.exact import half_up
from soukwise.sources.model import payment_status_for, shipment_status_for

CLOSED = ("Cancelled", "Returned", "Delivered")
REVIEW_KEY = ["order_id", "customer_id", "product_id"]


# ------------------------------------------------------------------ reviews
def _reviewable(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("status") == "Delivered").select(*REVIEW_KEY)


def review_eligible(reviews: DataFrame, lines: DataFrame) -> DataFrame:
    """Reviews of a product that the same customer received in that order."""
    return reviews.join(_reviewable(lines), REVIEW_KEY, "left_semi")


def review_rejected(reviews: DataFrame, lines: DataFrame) -> DataFrame:
    return reviews.join(_reviewable(lines), REVIEW_KEY, "left_anti")


def affected_sellers(inserted: DataFrame, deleted: DataFrame, products: DataFrame) -> DataFrame:
    """Sellers of any product whose reviews changed."""
    changed = inserted.select("product_id").union(deleted.select("product_id")).distinct()
    return changed.join(products.select("product_id", "seller_id"), "product_id").select("seller_id").distinct()


def seller_rating(affected: DataFrame, reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Mean rating of each affected seller over all its reviews, 0 when none remain."""
    per_product = reviews.groupBy("product_id").agg(F.count("*").alias("n"), F.sum("rating").alias("stars"))
    per_seller = (per_product.join(products.select("product_id", "seller_id"), "product_id")
                  .groupBy("seller_id").agg(F.sum("n").alias("n"), F.sum("stars").alias("stars")))
    return affected.join(per_seller, "seller_id", "left").select(
        "seller_id", F.coalesce(half_up(F.col("stars"), F.col("n")), F.lit(0.0)).alias("rating_avg"))


def care_queue(reviews: DataFrame, products: DataFrame, orders: DataFrame, max_rating: int = 2) -> DataFrame:
    """Reviews that call for a follow-up, with what an agent needs to know."""
    return (reviews.where(F.col("rating") <= max_rating)
            .join(orders.select("order_id", "status"), "order_id")
            .join(products.select("product_id", "product_name", "shop"), "product_id")
            .select("order_id", "customer_id", "product_id", "rating", "product_name", "shop", "status"))


# ------------------------------------------------------------ orders, money
def order_totals(discounted: DataFrame) -> DataFrame:
    """Units, sum of the lines, discount and amount due per order."""
    return discounted.select("order_id", "units", "total", "discount",
                             (F.col("total") - F.col("discount")).alias("amount_due"))


def price_drift(lines: DataFrame, variants: DataFrame, products: DataFrame) -> DataFrame:
    """Lines whose stored price is not today's list price, per variant.

    Equal lines are counted first, so that a best-seller does not reach the join
    row by row.
    """
    price = (variants.join(products.select("product_id", "base_price"), "product_id")
             .select("variant_id", (F.col("base_price") + F.col("price_adjust")).alias("sell_price")))
    alike = lines.groupBy("variant_id", "quantity", "line_revenue").agg(F.count("*").alias("n"))
    gap = F.col("line_revenue") - F.col("sell_price") * F.col("quantity")
    return (alike.join(price, "variant_id").groupBy("variant_id")
            .agg(F.sum("n").alias("lines"), F.sum(F.when(gap != 0, F.col("n")).otherwise(0)).alias("drifted"),
                 F.sum(gap * F.col("n")).alias("drift_amount")))


def status_derivation(orders: DataFrame) -> DataFrame:
    """Payment and shipment state that follow from an order's state."""
    return orders.select("order_id", "status", payment_status_for(F.col("status")).alias("payment_status"),
                         shipment_status_for(F.col("status")).alias("shipment_status"))


def promo_out_of_window(orders: DataFrame, promotions: DataFrame) -> DataFrame:
    """Orders that used a promotion on a day outside its dates."""
    day = F.col("order_date").cast("date")
    return (orders.where(F.col("promotion_id").isNotNull()).join(promotions, "promotion_id")
            .where(~day.between(F.col("start_date"), F.col("end_date")))
            .select("order_id", "promo_code", day.alias("order_day"), "start_date", "end_date"))


def failed_payment_cancels(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Status changes due because the payment of an open order failed; input for a restock.

    ``orders`` is (order_id, status) as it stands before the change.
    """
    failed = payments.where(F.col("status") == "Failed").select("order_id")
    return (orders.where(~F.col("status").isin(*CLOSED)).join(failed, "order_id", "left_semi")
            .select("order_id", F.col("status").alias("old_status"), F.lit("Cancelled").alias("new_status")))


def orders_to_purchase_events(accepted: DataFrame, totals: DataFrame) -> DataFrame:
    """One purchase event for each accepted order, as the shop would log it."""
    return accepted.join(totals.select("order_id", "total"), "order_id").select(
        F.concat(F.lit("order-"), F.col("order_id").cast("string")).alias("event_id"),
        F.col("customer_id").alias("user_id"), F.lit("purchase").alias("event_type"),
        F.col("order_date").alias("ts"), F.date_format("order_date", "yyyy-MM").alias("event_month"),
        F.lit("desktop_web").alias("platform"), "order_id", F.col("total").alias("revenue"),
        F.lit("COD").alias("payment_method"), F.lit("live_ui").alias("source"))


def orders_with_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders without any line are removed."""
    return orders.join(lines.select("order_id"), "order_id", "left_semi").select(
        "order_id", "customer_id", "status")


# --------------------------------------------------------- delete propagation
def restricted(deleted: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """Keys that may not go because a child row still refers to them."""
    return deleted.select(key).join(child.select(key), key, "left_semi")


def cascaded(child: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """Child rows that stay after the delete."""
    return child.join(deleted.select(key), key, "left_anti")


def set_null(child: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """Child rows with the reference to a deleted key emptied."""
    gone = deleted.select(key, F.lit(True).alias("_gone"))
    return (child.join(gone, key, "left")
            .withColumn(key, F.when(F.col("_gone").isNull(), F.col(key))).select(*child.columns))


def cascade_report(effects: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """(relation, action, rows touched) for frames of touched rows."""
    parts = [df.agg(F.count("*").alias("touched")).select(
        F.lit(relation).alias("relation"), F.lit(action).alias("action"), "touched")
        for relation, action, df in effects]
    return reduce(DataFrame.unionByName, parts)
