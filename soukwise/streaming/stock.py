"""Stock under arriving lines: what is left carries over from batch to batch.

Two forms. Keyed state answers with low latency, and one task sees all lines of a
variant that a trigger read. The batch form serves every micro-batch with the
distributed rule, which splits variants too big for one task, and keeps the stock as
a table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from soukwise.operators.skew import HOT_ROWS
from soukwise.operators.stock import allocate_lines, one_line_per_order
from soukwise.session import ship_code

RESULT = "variant_id bigint, order_id bigint, quantity bigint, accepted boolean, left bigint"


def _take(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Serve the lines of one variant in order sequence. A batch holds what one trigger read."""
    rows = pd.concat(list(batches)).sort_values(["order_id", "quantity"])
    left = state.get[0] if state.exists else int(rows["on_hand"].iloc[0])
    accepted, remaining = [], []
    for quantity in rows["quantity"]:
        fits = quantity <= left
        left -= int(quantity) if fits else 0
        accepted.append(bool(fits))
        remaining.append(left)
    state.update((left,))
    yield pd.DataFrame({"variant_id": key[0], "order_id": rows["order_id"], "quantity": rows["quantity"],
                        "accepted": accepted, "left": remaining})


def allocate(lines: DataFrame, stock: DataFrame) -> DataFrame:
    """Streaming lines (order_id, variant_id, quantity) against stock on hand at the start.

    A variant without a stock row starts at zero. How much one task sees of one
    variant is bounded by the trigger's maxFilesPerTrigger or maxBytesPerTrigger.
    """
    ship_code(lines.sparkSession)
    known = lines.join(stock.select("variant_id", "on_hand"), "variant_id", "left").na.fill(0, ["on_hand"])
    return (known.select("variant_id", "order_id", "quantity", "on_hand").groupBy("variant_id")
            .applyInPandasWithState(_take, RESULT, "left bigint", "append", GroupStateTimeout.NoTimeout))


def run_allocate(lines: DataFrame, stock: DataFrame, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    return (allocate(lines, stock).writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(**(trigger or {"availableNow": True})).start())


# ------------------------------------------------------------- batch by batch
def served(spark: SparkSession, out: str) -> DataFrame:
    """All decided lines, with the number of the batch that decided them."""
    return spark.read.option("basePath", f"{out}/lines").parquet(f"{out}/lines/batch=*")


def _serve_batch(stock: DataFrame, out: str, hot_rows: int):
    """Serve one batch from the stock the batch before it left. A repeated batch starts from
    the same stock and replaces its own output."""
    def serve(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = stock if batch_id == 0 else spark.read.parquet(f"{out}/stock/batch={batch_id - 1}")
        decided = allocate_lines(one_line_per_order(batch), held, hot_rows)
        decided.write.mode("overwrite").parquet(f"{out}/lines/batch={batch_id}")
        taken = (spark.read.parquet(f"{out}/lines/batch={batch_id}").where("accepted")
                 .groupBy("variant_id").agg(F.sum("quantity").alias("taken")))
        left = F.col("on_hand") - F.coalesce("taken", F.lit(0))
        (held.join(taken, "variant_id", "left").select("variant_id", left.alias("on_hand"))
         .write.mode("overwrite").parquet(f"{out}/stock/batch={batch_id}"))
    return serve


def run_batches(lines: DataFrame, stock: DataFrame, out: str, checkpoint: str, hot_rows: int = HOT_ROWS,
                **trigger) -> StreamingQuery:
    """Streaming lines (order_id, variant_id, quantity) against ``stock``, batch by batch."""
    return (lines.select("order_id", "variant_id", "quantity").writeStream
            .foreachBatch(_serve_batch(stock, out, hot_rows)).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
