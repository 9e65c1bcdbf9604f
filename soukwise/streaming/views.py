"""Views that follow change rows: signed sums by key, kept as stream state.

A change row says what was and what is. What was is taken off and what is is added, so the sums
do not depend on the order of the changes nor on how they are cut into batches. A
batch gives out the keys it touched, under its own number; a repeated batch replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from soukwise.functions.exact import half_up
from soukwise.operators.stock import RELEASED
from soukwise.sources.tables import at_most

STATUS_CHANGE = "order_id bigint, old_status string, new_status string"
#: A new review has no old rating, a deleted one no new rating.
REVIEW_CHANGE = "order_id bigint, customer_id bigint, product_id bigint, old_rating int, new_rating int"


def read_changes(spark: SparkSession, folder: str, schema: str, files_per_batch: int | None = 100) -> DataFrame:
    """Change rows as a stream; without a number of files a batch takes all that has arrived."""
    return at_most(spark.readStream.schema(schema), files_per_batch).parquet(folder)


def returned_units(changes: DataFrame, lines: DataFrame) -> DataFrame:
    """(variant_id, returned): units of orders that moved into a released state. A batch frame or a stream.

    A missing old state counts as not released.
    """
    entered = F.col("new_status").isin(*RELEASED) & ~F.coalesce(F.col("old_status").isin(*RELEASED), F.lit(False))
    moved = changes.where(entered).select("order_id")
    return (moved.join(lines.select("order_id", "variant_id", "quantity"), "order_id")
            .groupBy("variant_id").agg(F.sum("quantity").alias("returned")))


def rating_sums(changes: DataFrame, products: DataFrame) -> DataFrame:
    """(seller_id, n, stars): number and sum of the ratings of a seller's products. A batch frame or a stream."""
    new, old = F.col("new_rating"), F.col("old_rating")
    signed = changes.select("product_id", (new.isNotNull().cast("int") - old.isNotNull().cast("int")).alias("n"),
                            (F.coalesce(new, F.lit(0)) - F.coalesce(old, F.lit(0))).alias("stars"))
    return (signed.join(products.select("product_id", "seller_id"), "product_id")
            .groupBy("seller_id").agg(F.sum("n").alias("n"), F.sum("stars").alias("stars")))


def _run(view: DataFrame, out: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (view.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def run_returned_units(changes: DataFrame, lines: DataFrame, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Status changes as a stream; the lines of an order do not change once it is placed."""
    return _run(returned_units(changes, lines), out, checkpoint, trigger)


def run_rating_sums(changes: DataFrame, products: DataFrame, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Review changes as a stream; a product stays with its seller."""
    return _run(rating_sums(changes, products), out, checkpoint, trigger)


def _last(spark: SparkSession, out: str, key: str, values: list[str]) -> DataFrame:
    """The last row of each key."""
    rows = spark.read.option("basePath", out).parquet(out)
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*values), F.col("batch").cast("bigint")).alias("v"))
    return newest.select(key, "v.*")


def stock_view(spark: SparkSession, stock: DataFrame, out: str) -> DataFrame:
    """Stock with all returned units, as ``stock.restock`` gives it for all changes at once."""
    units = F.coalesce(F.col("returned"), F.lit(0))
    return (stock.join(_last(spark, out, "variant_id", ["returned"]), "variant_id", "left")
            .select("variant_id", "on_hand", units.alias("returned"), (F.col("on_hand") + units).alias("on_hand_after")))


def rating_view(spark: SparkSession, sellers: DataFrame, out: str) -> DataFrame:
    """Mean rating of each seller, 0 where no review remains."""
    sums = _last(spark, out, "seller_id", ["n", "stars"])
    return sellers.select("seller_id").join(sums, "seller_id", "left").select(
        "seller_id", F.coalesce(half_up(F.col("stars"), F.col("n")), F.lit(0.0)).alias("rating_avg"))
