"""Orders placed as they arrive: an order gets all its units or none, and an accepted one is logged as a purchase.

Each micro-batch has two sinks, the decisions with the stock that they take and the purchase events. A
commit record is written last, and readers look at committed batches only: a batch that fails between the sinks
shows neither half, and when it is repeated it starts from the same stock and replaces what it left.

Stock is kept as what each batch took, and from time to time as a whole table, so that a batch
reads and writes in proportion to itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from soukwise.operators.skew import HOT_ROWS
from soukwise.operators.stock import allocate_orders, one_line_per_order
from soukwise.session import materialise
from soukwise.sources.documents import month_key
from soukwise.sources.lake import exists, folder_names
from soukwise.sources.tables import at_most

ORDER_DOCUMENT = """
    order_id bigint, customer_id bigint, session_id string, placed_at timestamp, payment_method string,
    lines array<struct<variant_id: bigint, product_id: bigint, quantity: int, line_revenue: decimal(18,2)>>
"""
#: A whole stock table is written by every so many batches.
WHOLE_EVERY = 20


def session_of(customer: Column, placed_at: Column) -> Column:
    return F.concat(customer.cast("string"), F.lit("-"), F.date_format(placed_at, "yyyyMMdd"))


def order_documents(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders with their lines nested, as a shop front end would send them; an order holds few lines."""
    nested = lines.groupBy("order_id").agg(F.sort_array(F.collect_list(
        F.struct("variant_id", "product_id", "quantity", "line_revenue"))).alias("lines"))
    heads = orders.select("order_id", "customer_id", session_of(F.col("customer_id"), F.col("order_date")).alias("session_id"),
                          F.col("order_date").cast("timestamp").alias("placed_at"), F.lit("COD").alias("payment_method"))
    return heads.join(nested, "order_id")


def read_orders(spark: SparkSession, folder: str, files_per_batch: int | None = 100) -> DataFrame:
    """Order documents as a stream; an order delivered again is dropped, by the stream's own state.

    Without a number of files a batch takes all that has arrived.
    """
    return at_most(spark.readStream.schema(ORDER_DOCUMENT), files_per_batch).json(folder).dropDuplicates(["order_id"])


def purchase_events(accepted: DataFrame) -> DataFrame:
    """One purchase event for each accepted order; its products are a list."""
    revenue = F.aggregate("lines", F.lit(0).cast("decimal(18,2)"), lambda total, line: (total + line["line_revenue"]).cast("decimal(18,2)"))
    return accepted.select(
        F.concat(F.lit("order-"), F.col("order_id").cast("string")).alias("event_id"), "session_id",
        F.col("customer_id").alias("user_id"), F.lit("purchase").alias("event_type"), F.col("placed_at").alias("timestamp"),
        month_key(F.col("placed_at")).alias("event_month"), "order_id", revenue.alias("revenue"),
        F.array_sort(F.array_distinct(F.transform("lines", lambda line: line["product_id"]))).alias("product_ids"),
        "payment_method", F.lit("live_ui").alias("source"))


# ------------------------------------------------------------------- readers
def committed(spark: SparkSession, out: str) -> list[int]:
    """The numbers of the batches both of whose halves are there."""
    folder = f"{out}/commits"
    if not exists(spark, folder):
        return []
    return sorted(int(name.removeprefix("batch=")) for name in folder_names(spark, folder) if name.startswith("batch="))


def _of_committed(spark: SparkSession, out: str, part: str, schema: str) -> DataFrame:
    paths = [f"{out}/{part}/batch={n}" for n in committed(spark, out)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{out}/{part}").parquet(*paths)


def decisions(spark: SparkSession, out: str) -> DataFrame:
    """(order_id, accepted, batch) of all decided orders."""
    return _of_committed(spark, out, "orders", "order_id bigint, accepted boolean, batch int")


def logged(spark: SparkSession, out: str) -> DataFrame:
    """The purchase events of all accepted orders."""
    return _of_committed(spark, out, "events", "event_id string, session_id string, user_id bigint, event_type string, "
                         "timestamp timestamp, order_id bigint, revenue decimal(18,2), product_ids array<bigint>, "
                         "payment_method string, source string, batch int, event_month string")


def stock_after(spark: SparkSession, stock: DataFrame, out: str, before: int | None = None) -> DataFrame:
    """(variant_id, on_hand) after the committed batches, or after those that came before one of them."""
    done = [n for n in committed(spark, out) if before is None or n < before]
    whole = [n for n in done if exists(spark, f"{out}/stock/batch={n}")]
    base = spark.read.parquet(f"{out}/stock/batch={whole[-1]}") if whole else stock.select("variant_id", "on_hand")
    since = [f"{out}/taken/batch={n}" for n in done if not whole or n > whole[-1]]
    if not since:
        return base
    taken = spark.read.schema("variant_id bigint, taken bigint").parquet(*since).groupBy("variant_id").agg(F.sum("taken").alias("taken"))
    return base.join(taken, "variant_id", "left").select(
        "variant_id", (F.col("on_hand") - F.coalesce("taken", F.lit(0))).alias("on_hand"))


# -------------------------------------------------------------------- writer
def _write_events(accepted: DataFrame, out: str, batch_id: int) -> None:
    (purchase_events(accepted).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("event_month").parquet(f"{out}/events/batch={batch_id}"))


def _commit(spark: SparkSession, out: str, batch_id: int) -> None:
    spark.range(1).select(F.lit(batch_id).alias("number")).write.mode("overwrite").parquet(f"{out}/commits/batch={batch_id}")


def _place_batch(stock: DataFrame, out: str, hot_rows: int):
    def place(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id in committed(spark, out):
            return
        orders = materialise(batch)
        lines = one_line_per_order(orders.select("order_id", F.inline("lines")))
        held = stock_after(spark, stock, out, before=batch_id)
        allocate_orders(lines, held, hot_rows).write.mode("overwrite").parquet(f"{out}/orders/batch={batch_id}")
        won = spark.read.parquet(f"{out}/orders/batch={batch_id}").where("accepted").select("order_id")
        (lines.join(won, "order_id", "left_semi").groupBy("variant_id").agg(F.sum("quantity").alias("taken"))
         .write.mode("overwrite").parquet(f"{out}/taken/batch={batch_id}"))
        if batch_id % WHOLE_EVERY == WHOLE_EVERY - 1:
            taken = spark.read.parquet(f"{out}/taken/batch={batch_id}")
            left = F.col("on_hand") - F.coalesce("taken", F.lit(0))
            (held.join(taken, "variant_id", "left").select("variant_id", left.alias("on_hand"))
             .write.mode("overwrite").parquet(f"{out}/stock/batch={batch_id}"))
        _write_events(orders.join(won, "order_id", "left_semi"), out, batch_id)
        _commit(spark, out, batch_id)
    return place


def run_placement(orders: DataFrame, stock: DataFrame, out: str, checkpoint: str, hot_rows: int = HOT_ROWS,
                  **trigger) -> StreamingQuery:
    """Streaming order documents against ``stock`` (variant_id, on_hand).

    Orders of one batch are served by number, and after all of the batches before it. A variant without a stock row
    has nothing to give; an order without lines is not placed.
    """
    return (orders.writeStream.foreachBatch(_place_batch(stock, out, hot_rows)).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
