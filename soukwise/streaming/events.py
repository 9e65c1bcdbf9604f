"""Live events: ingest, running counts, hourly counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from soukwise.session import materialise
from soukwise.sources.documents import EVENT_DOCUMENT, events_flat
from soukwise.sources.lake import exists, write_by_month

def _or_default(branch: str, default: Column) -> Column:
    """The branch, or the default where it is missing or none of its fields has a value."""
    fields = F.to_json(branch)
    return F.when(F.coalesce(fields, F.lit("{}")) == "{}", default).otherwise(F.col(branch))


def with_defaults(documents: DataFrame) -> DataFrame:
    """Fill in what a live client left out and mark where the event came from."""
    # What an event without these branches is taken to be.
    device = F.struct(F.lit("desktop_web").alias("platform"), F.lit(None).cast("string").alias("os_version"),
                      F.lit(None).cast("string").alias("app_version"))
    geo = F.struct(F.lit("VN").alias("country"), F.lit("Ha Noi").alias("province"))
    traffic = F.struct(F.lit("direct").alias("channel"), F.lit("demo").alias("campaign"))
    return documents.withColumns({
        "device": _or_default("device", device), "geo": _or_default("geo", geo),
        "traffic_source": _or_default("traffic_source", traffic),
        "timestamp": F.coalesce("timestamp", F.current_timestamp()),
        "source": F.coalesce("source", F.lit("live_ui"))})


def read_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    return (spark.readStream.schema(EVENT_DOCUMENT).option("maxFilesPerTrigger", files_per_batch).json(folder))


def with_ids(batch: DataFrame) -> DataFrame:
    """An id for each event that came without one, from its file (``_file``), what it says and its number among the
    events of that file that say the same.

    Equal events of a file are counted, not sorted, and the numbers are given out again from the count. So the ids do not
    depend on how files are cut into tasks or ordered, equal events get different ids, and one event that fills a file
    is no hot key. A missing time is the time of the file (``_arrived``).
    """
    batch = batch.withColumn("timestamp", F.coalesce("timestamp", "_arrived")).drop("_arrived")
    said = [c for c in batch.columns if c != "event_id"]
    counted = batch.where("event_id is null").groupBy(*said).agg(F.count("*").alias("_n"))
    blocks = counted.withColumn("_block", F.explode(F.sequence(F.lit(0), F.expr("(_n - 1) div 4096"))))
    each = blocks.withColumn("_no", F.explode(F.expr("sequence(_block * 4096 + 1, least(_n, (_block + 1) * 4096))")))
    place = F.to_json(F.struct(*said, "_no"))
    own = each.select(F.concat(F.lit("live-"), F.sha2(place, 256)).alias("event_id"), *said)
    return batch.where("event_id is not null").select("event_id", *said).unionByName(own).drop("_file")


def _append_new(out: str):
    """Add the events of a batch that the lake does not hold. An event delivered again, late or
    by a repeated batch, is stored once; only the months of the batch are looked at."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        events = materialise(events_flat(with_defaults(with_ids(batch))).dropDuplicates(["event_id"]))
        # A batch touches few months, whatever it holds.
        months = [r[0] for r in events.select("event_month").distinct().collect()]
        held = [f"{out}/event_month={month}" for month in months if exists(spark, f"{out}/event_month={month}")]
        if held:
            events = events.join(spark.read.option("basePath", out).parquet(*held).select("event_id"), "event_id", "left_anti")
        write_by_month(events, out, "append")
    return write


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str, files_per_batch: int = 100,
           **trigger) -> StreamingQuery:
    """Documents to the month-partitioned lake, every event once, however late it is."""
    events = read_stream(spark, folder, files_per_batch).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_modification_time").alias("_arrived"))
    return (events.writeStream.foreachBatch(_append_new(out)).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _keep_batch(out: str):
    """Store the changed rows of each batch under its number; a repeated batch replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    return write


def latest(spark: SparkSession, out: str, keys: list[str], value: str) -> DataFrame:
    """The last stored value of every key."""
    rows = spark.read.option("basePath", out).parquet(out)
    return rows.groupBy(*keys).agg(F.max_by(value, F.col("batch").cast("bigint")).alias(value))


def run_event_stats(events: DataFrame, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Running number of events by type."""
    counts = events.groupBy("event_type").agg(F.count("*").alias("events"))
    return (counts.writeStream.outputMode("update").foreachBatch(_keep_batch(out))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def run_hourly(events: DataFrame, out: str, checkpoint: str, lateness: str | None = None,
               **trigger) -> StreamingQuery:
    """Events per hour window and platform. All rows count: the state is one row per hour and platform.

    With ``lateness`` an hour is closed, and its state freed, when it is that far behind; later rows are left out.
    """
    timed = events.withWatermark("ts", lateness) if lateness else events
    counts = (timed.groupBy(F.window("ts", "1 hour").alias("w"), "platform").agg(F.count("*").alias("events"))
              .select(F.col("w.start").alias("hour_start"), "platform", "events"))
    return (counts.writeStream.outputMode("update").foreachBatch(_keep_batch(out))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())
