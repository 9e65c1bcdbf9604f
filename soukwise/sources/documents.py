"""Nested behaviour and scan documents (JSON lines) and their flat form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# One schema for all event types; a field a type lacks is NULL.
EVENT_DOCUMENT = """
    event_id string, session_id string, user_id bigint, event_type string, timestamp timestamp,
    device struct<platform: string, os_version: string, app_version: string>,
    geo struct<country: string, province: string>,
    traffic_source struct<channel: string, campaign: string>,
    payload struct<product_id: bigint, variant_id: bigint, quantity: int, dwell_seconds: int,
        position_in_list: int, query: string, result_count: int, filters_applied: array<string>,
        cart_size: int, cart_value: double, product_ids: array<bigint>, revenue: double,
        payment_method: string, page: string, referrer: string, order_id: bigint,
        category_id: bigint, price: double>,
    source string
"""

SCAN_DOCUMENT = """
    scan_id string, tracking_no string, order_id bigint, scan_type string, station string,
    carrier string, device_id string, operator string, timestamp timestamp, weight_kg double
"""


def write_documents(df: DataFrame, path: str) -> None:
    """JSON lines; times keep their microseconds."""
    df.write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)


def read_events(spark: SparkSession, path: str, keep_raw: bool = False) -> DataFrame:
    """Event documents. ``keep_raw`` adds the text of each line, so that fields outside the
    schema are not lost."""
    if not keep_raw:
        return spark.read.schema(EVENT_DOCUMENT).json(path)
    parsed = F.from_json("value", EVENT_DOCUMENT)
    return spark.read.text(path).select(parsed.alias("d"), F.col("value").alias("_raw")).select("d.*", "_raw")


def read_scans(spark: SparkSession, path: str) -> DataFrame:
    """Scan documents without the name of the person who scanned."""
    return scans_clean(spark.read.schema(SCAN_DOCUMENT).json(path))


def scans_clean(scans: DataFrame) -> DataFrame:
    return scans.drop("operator", "_id")


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def events_flat(documents: DataFrame) -> DataFrame:
    """The analytic columns of an event document. Missing branches give NULL, a missing source 'mock'."""
    return documents.select(
        "event_id", "session_id", "user_id", "event_type", F.col("timestamp"),
        F.col("device.platform").alias("platform"), F.col("geo.province").alias("province"),
        F.col("traffic_source.channel").alias("channel"), F.col("payload.product_id").alias("product_id"),
        F.col("payload.revenue").alias("revenue"), F.col("payload.quantity").alias("quantity"),
        F.coalesce("source", F.lit("mock")).alias("source"),
        month_key(F.col("timestamp")).alias("event_month"))


def purchased_products(documents: DataFrame) -> DataFrame:
    """One row per product in a purchase; purchases name their products in a list only."""
    return documents.where(F.col("event_type") == "purchase").select(
        "event_id", "session_id", "user_id", F.explode_outer("payload.product_ids").alias("product_id"))


def purchase_documents(purchases: DataFrame) -> DataFrame:
    """Purchases (event_id, session_id, user_id, timestamp, order_id, revenue, product_ids, payment_method, source) in document form."""
    return purchases.select(
        "event_id", "session_id", "user_id", F.lit("purchase").alias("event_type"), "timestamp",
        F.struct("product_ids", F.col("revenue").cast("double").alias("revenue"), "payment_method", "order_id").alias("payload"), "source")


def as_documents(events: DataFrame) -> DataFrame:
    """Flat clickstream rows in document form, as a shop front end would send them.

    Live events come without device, geo, traffic source and source, which the
    ingest has to fill in.
    """
    sent = F.col("source") != "live_ui"
    return events.select(
        F.col("event_id").cast("string").alias("event_id"), "session_id", "user_id", "event_type",
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(sent, F.struct("platform")).alias("device"),
        F.when(sent, F.struct(F.lit("VN").alias("country"), F.lit("Hue").alias("province"))).alias("geo"),
        F.when(sent, F.struct(F.lit("ads").alias("channel"))).alias("traffic_source"),
        F.struct("product_id", F.col("revenue").cast("double").alias("revenue")).alias("payload"),
        F.when(sent, F.col("source")).alias("source"))


def scan_documents(scans: DataFrame) -> DataFrame:
    return scans.select(
        "tracking_no", "order_id", "station", F.col("scanned_at").cast("timestamp").alias("timestamp"),
        F.concat(F.lit("clerk-"), F.col("station")).alias("operator"))
