"""What the shop asks for: category list, catalogue search, customers, stock of an item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soukwise.functions.exact import half_up
from soukwise.session import materialise


def category_counts(products: DataFrame) -> DataFrame:
    """Approved products per category; a category without any does not appear."""
    return products.where("is_approved").groupBy("category").agg(F.count("*").alias("products"))


def product_search(products: DataFrame, variants: DataFrame, inventory: DataFrame, reviews: DataFrame,
                   category: str | None = None, text: str | None = None, limit: int = 24) -> DataFrame:
    """Approved items, best stocked first, with their mean rating (0 if unrated).

    Ratings are read for the products on the page only.
    """
    listed = products.where("is_approved")
    if category is not None:
        listed = listed.where(F.col("category") == category)
    if text:
        listed = listed.where(F.col("product_name").ilike(f"%{text}%"))
    page = materialise(
        inventory.select("variant_id", "quantity_on_hand")
        .join(variants, "variant_id").join(listed, "product_id")
        .select("product_id", "product_name", "base_price", "category", "shop", "variant_id", "sku",
                (F.col("base_price") + F.col("price_adjust")).alias("sell_price"), "quantity_on_hand")
        .orderBy(F.desc("quantity_on_hand"), "product_id", "variant_id").limit(limit))
    rated = (reviews.join(page.select("product_id").distinct(), "product_id", "left_semi")
             .groupBy("product_id").agg(half_up(F.sum("rating"), F.count("*"), 1).alias("avg_rating")))
    # At most one rating per product of the page.
    return (page.join(rated, "product_id", "left")
            .withColumn("avg_rating", F.coalesce("avg_rating", F.lit(0.0)))
            .orderBy(F.desc("quantity_on_hand"), "product_id", "variant_id"))


def customer_list(customers: DataFrame, limit: int = 30) -> DataFrame:
    return (customers.select("customer_id", "full_name", "province").orderBy("customer_id").limit(limit))


def inventory_lookup(inventory: DataFrame, wanted: DataFrame | int) -> DataFrame:
    """Stock of one variant, or of all variants in a frame of requests."""
    rows = inventory.select("variant_id", "quantity_on_hand", "safety_stock")
    if isinstance(wanted, int):
        return rows.where(F.col("variant_id") == wanted)
    return rows.join(wanted.select("variant_id"), "variant_id", "left_semi")


def product_popularity(products: DataFrame, lines: DataFrame) -> DataFrame:
    """Units sold of each approved product, whatever became of the order."""
    sold = lines.groupBy("product_id").agg(F.sum("quantity").alias("units"))
    return (products.where("is_approved").select("product_id").join(sold, "product_id", "left")
            .select("product_id", F.coalesce("units", F.lit(0)).alias("units")))
