"""Reading the logs back: one customer, one session, one parcel, or all of them.

Without a key the functions replay the whole log, every row with its place in the
sequence. A key that holds very many rows is cut into time ranges.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from soukwise.operators.skew import HOT_ROWS, hot_keys, running_sums
from soukwise.sources.lake import folder_names


def numbered(df: DataFrame, key: str, order: list[Column], range_on: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``seq``, the 1-based place of a row among the rows of its key."""
    ordered = df.withColumns({"_order": F.struct(*order), "_one": F.lit(1), "_range_on": F.col(range_on)})
    hot = hot_keys(ordered, key, "_range_on", hot_rows)
    return (running_sums(ordered, key, "_order", {"_one": "seq"}, hot, range_on="_range_on")
            .drop("_order", "_one", "_range_on"))


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


#: Rows of a nested array at most.
CHUNK_ROWS = 1000

EVENT = ["event_id", "ts", "user_id", "session_id", "event_type", "product_id", "platform", "source"]


def user_history(events: DataFrame, user_id: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Events of one customer (or of each), newest first."""
    rows = events.select(*EVENT)
    if user_id is not None:
        return rows.where(F.col("user_id") == user_id).orderBy(F.desc("ts"), F.desc("event_id"))
    backwards = rows.withColumn("_back", -_micros("ts"))
    return numbered(backwards, "user_id", [F.col("_back"), -F.col("event_id")], "_back", hot_rows).drop("_back")


def session_replay(events: DataFrame, session_id: str | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Events of one session (or of each) in time order."""
    rows = events.select(*EVENT)
    if session_id is not None:
        return rows.where(F.col("session_id") == session_id).orderBy("ts", "event_id")
    timed = rows.withColumn("_at", _micros("ts"))
    return numbered(timed, "session_id", [F.col("_at"), F.col("event_id")], "_at", hot_rows).drop("_at")


def shipment_journey(scans: DataFrame, tracking_no: str | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Scans of one parcel (or of each) in time order."""
    if tracking_no is not None:
        return scans.where(F.col("tracking_no") == tracking_no).orderBy("scanned_at", "station")
    timed = scans.withColumn("_at", _micros("scanned_at"))
    return numbered(timed, "tracking_no", [F.col("_at"), F.col("station")], "_at", hot_rows).drop("_at")


def chunked(numbered_rows: DataFrame, key: str, steps: str, rows_per_chunk: int) -> DataFrame:
    """(key, chunk, first_seq, n, ``steps``): the rows of each key as nested arrays in the order of ``seq``.

    An array holds ``rows_per_chunk`` rows at most; a key with more has several, one after the other. So the rows of a
    hot key meet in many small groups, whatever their number. A missing key is a key.
    """
    if rows_per_chunk < 1:
        raise ValueError("a chunk holds one row at least")
    fields = ["seq", *[c for c in numbered_rows.columns if c not in (key, "seq")]]
    chunk = F.floor((F.col("seq") - 1) / F.lit(rows_per_chunk)).cast("bigint")
    return (numbered_rows.groupBy(key, chunk.alias("chunk"))
            .agg(F.min("seq").alias("first_seq"), F.count("*").alias("n"),
                 F.array_sort(F.collect_list(F.struct(*fields))).alias(steps)))


def session_chunks(events: DataFrame, rows_per_chunk: int = CHUNK_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each session as nested arrays of its events in time order."""
    return chunked(session_replay(events, hot_rows=hot_rows), "session_id", "events", rows_per_chunk)


def shipment_chunks(scans: DataFrame, rows_per_chunk: int = CHUNK_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each parcel as nested arrays of its scans in time order."""
    return chunked(shipment_journey(scans, hot_rows=hot_rows), "tracking_no", "scans", rows_per_chunk)


def events_by_type_range(events: DataFrame, event_type: str, start: datetime, end: datetime) -> DataFrame:
    """Events of one type in [start, end). The month is bounded too, which prunes lake folders."""
    months = F.col("event_month").between(f"{start:%Y-%m}", f"{end:%Y-%m}")
    return (events.where(months & (F.col("event_type") == event_type)
                         & (F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
                         & (F.col("ts") < F.lit(end).cast("timestamp_ntz")))
            .select(*EVENT))


def recent_events(events: DataFrame, limit: int = 25, only_live: bool = False) -> DataFrame:
    rows = events.where(F.col("source") == "live_ui") if only_live else events
    return rows.select(*EVENT).orderBy(F.desc("ts"), F.desc("event_id")).limit(limit)


def recent_lake_events(spark: SparkSession, path: str, limit: int = 25, only_live: bool = False) -> DataFrame:
    """The same over a lake of month folders, the newest month first; older folders are opened only while rows are missing.

    Events without a time are in the last folder to be opened.
    """
    months = [name for name in folder_names(spark, path) if name.startswith("event_month=")]
    months.sort(key=lambda name: ("__HIVE_DEFAULT_PARTITION__" not in name, name), reverse=True)
    opened, found = [], 0
    for month in months:
        opened.append(f"{path}/{month}")
        rows = spark.read.option("basePath", path).parquet(opened[-1])
        # Months do not overlap in time, so the newest folder's rows all come before the next one's.
        found += (rows.where(F.col("source") == "live_ui") if only_live else rows).select("event_id").limit(limit - found).count()
        if found >= limit:
            break
    if not opened:
        raise FileNotFoundError(f"no month folder in {path}")
    return recent_events(spark.read.option("basePath", path).parquet(*opened), limit, only_live)


def scan_reconcile(shipments: DataFrame, scans: DataFrame) -> DataFrame:
    """Shipments and scans per order, from either side, and whether both are there."""
    sent = shipments.groupBy("order_id").agg(F.count("*").alias("shipments"))
    seen = scans.groupBy("order_id").agg(F.count("*").alias("scans"))
    both = sent.join(seen, "order_id", "full").na.fill(0, ["shipments", "scans"])
    state = (F.when(F.col("scans") == 0, "no scan").when(F.col("shipments") == 0, "no shipment")
             .otherwise("matched"))
    return both.select("order_id", "shipments", "scans", state.alias("state"))
