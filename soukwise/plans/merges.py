"""Jobs that put orders and behaviour logs side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soukwise.functions.exact import half_up, percent, seconds_between, zero_money
from soukwise.plans.business import DAY, delivered

# The behaviours that carry a product, and the steps of the funnel.
PRODUCT_EVENTS = ("product_view", "add_to_cart", "remove_from_cart")
FUNNEL_STEPS = ("product_view", "add_to_cart", "checkout_start", "purchase")
# Size of the percentile sketch: exact up to this many rows per carrier, a few megabytes beyond.
P95_ACCURACY = 100_000


def product_sessions(events: DataFrame) -> DataFrame:
    """Distinct sessions per product, one column per behaviour."""
    return (events.where(F.col("product_id").isNotNull())
            .groupBy("product_id").pivot("event_type", list(PRODUCT_EVENTS))
            .agg(F.count_distinct("session_id")))


def product_merge(lines: DataFrame, products: DataFrame, events: DataFrame) -> DataFrame:
    """Delivered sales of every product beside the sessions that viewed and carted it."""
    sales = (delivered(lines).groupBy("product_id")
             .agg(F.count_distinct("order_id").alias("orders"), F.sum("quantity").alias("units"),
                  F.sum("line_revenue").alias("revenue")))
    seen = product_sessions(events).select("product_id", F.col("product_view").alias("views"),
                                           F.col("add_to_cart").alias("carts"))
    merged = (products.select("product_id", "product_name", "category", "shop")
              .join(sales, "product_id", "left").join(seen, "product_id", "left")
              .na.fill(0, ["orders", "units", "views", "carts"])
              .withColumn("revenue", F.coalesce("revenue", zero_money())))
    return merged.withColumn("view_to_order_pct", percent(F.col("units"), F.col("views")))


def product_revenue_all_status(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Units and revenue over all order states, orders over delivered ones only."""
    is_delivered = F.col("status") == "Delivered"
    sales = lines.groupBy("product_id").agg(
        F.count_distinct(F.when(is_delivered, F.col("order_id"))).alias("orders"),
        F.sum("quantity").alias("units_sold"), F.sum("line_revenue").alias("revenue"))
    return (products.select("product_id", "product_name", "category", "shop")
            .join(sales, "product_id", "left").na.fill(0, ["orders", "units_sold"])
            .withColumn("revenue", F.coalesce("revenue", zero_money())))


def product_merge_all_status(lines: DataFrame, products: DataFrame, events: DataFrame) -> DataFrame:
    merged = (product_revenue_all_status(lines, products)
              .join(product_sessions(events), "product_id", "left").na.fill(0, list(PRODUCT_EVENTS)))
    return merged.withColumn("view_to_sale_pct", percent(F.col("units_sold"), F.col("product_view")))


def high_view_low_sale(merged: DataFrame, min_views: int, max_revenue: int) -> DataFrame:
    """Products many look at and few buy."""
    return (merged.where((F.col("views") > min_views) & (F.col("revenue") < max_revenue))
            .select("product_id", "product_name", "category", "views", "revenue")
            .orderBy(F.desc("views"), "product_id"))


def top_products_per_category(merged: DataFrame, n: int = 3) -> DataFrame:
    """Best products of each category. Every task keeps n rows per category before the shuffle."""
    best = Window.partitionBy("category").orderBy(F.desc("revenue"), "product_id")
    return (merged.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)
            .select("category", "rank", "product_id", "product_name", "shop", "units", "revenue"))


# ------------------------------------------------------------------- funnel
def _steps(events: DataFrame) -> DataFrame:
    return (events.where(F.col("event_type").isin(*FUNNEL_STEPS)).groupBy("event_type")
            .agg(F.count_distinct("session_id").alias("sessions"), F.count("*").alias("events")))


def _step_number(step: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in FUNNEL_STEPS]), step).cast("bigint")


def _at_least_one(n: Column) -> Column:
    return F.greatest(F.coalesce(n, F.lit(0)), F.lit(1))


def funnel_row(events: DataFrame) -> DataFrame:
    """One row: the sessions and events of each step, zero where a step never occurred."""
    return _steps(events).agg(*[
        F.coalesce(F.max(F.when(F.col("event_type") == step, F.col(what))), F.lit(0)).alias(f"{step}_{what}")
        for step in FUNNEL_STEPS for what in ("sessions", "events")])


def funnel(events: DataFrame) -> DataFrame:
    """All four steps as a share of the first; steps are counted independently of each other."""
    rows = F.inline(F.array(*[
        F.struct(F.lit(step).alias("step"), F.lit(i).cast("bigint").alias("step_no"),
                 F.col(f"{step}_sessions").alias("sessions"), F.col(f"{step}_events").alias("events"))
        for i, step in enumerate(FUNNEL_STEPS, 1)]))
    base = _at_least_one(F.col(f"{FUNNEL_STEPS[0]}_sessions")).alias("base")
    return funnel_row(events).select(base, rows).select(
        "step", "step_no", "sessions", "events", percent(F.col("sessions"), F.col("base")).alias("pct"))


def funnel_max_base(events: DataFrame) -> DataFrame:
    """The steps that occurred, as a share of the largest."""
    found = _steps(events).agg(
        _at_least_one(F.max("sessions")).alias("base"),
        # At most one entry per step.
        F.collect_list(F.struct(F.col("event_type").alias("step"), "sessions", "events")).alias("steps"))
    return found.select("base", F.inline("steps")).select(
        "step", _step_number(F.col("step")).alias("step_no"), "sessions", "events",
        percent(F.col("sessions"), F.col("base")).alias("pct"))


# ---------------------------------------------------------------- lake jobs
def lake_monthly_revenue(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Delivered revenue by text month and category; summed per product before the join."""
    per_product = (delivered(lines)
                   .groupBy(F.date_format("order_date", "yyyy-MM").alias("month"), "product_id")
                   .agg(F.sum("line_revenue").alias("revenue"), F.sum("quantity").alias("units")))
    return (per_product.join(products.select("product_id", "category"), "product_id")
            .groupBy("month", "category")
            .agg(F.round(F.sum("revenue"), 0).alias("revenue"), F.sum("units").alias("units")))


def scan_counts(scans: DataFrame) -> DataFrame:
    return scans.groupBy("tracking_no").agg(F.count("*").alias("scans"),
                                            F.count_distinct("station").alias("stations"))


def carrier_merge(shipments: DataFrame, scans: DataFrame) -> DataFrame:
    """Days on the road and scans per carrier, over parcels with both dates.

    Parcels without a scan log do not enter the scan averages.
    """
    timed = (shipments.where(F.col("shipped_at").isNotNull() & F.col("delivered_at").isNotNull())
             .select("tracking_no", "carrier",
                     seconds_between(F.col("shipped_at"), F.col("delivered_at")).alias("seconds")))
    joined = timed.join(scan_counts(scans), "tracking_no", "left")
    totals = joined.groupBy("carrier").agg(
        F.count("*").alias("shipments"), F.sum("seconds").alias("seconds"),
        F.percentile_approx("seconds", 0.95, P95_ACCURACY).alias("p95"), F.count("scans").alias("logged"),
        F.sum("scans").alias("scans"), F.sum("stations").alias("stations"))
    return totals.select(
        "carrier", "shipments", half_up(F.col("seconds"), F.col("shipments") * DAY).alias("avg_days"),
        half_up(F.col("p95"), F.lit(DAY)).alias("p95_days"),
        half_up(F.col("scans"), F.col("logged"), 1).alias("avg_scans"),
        half_up(F.col("stations"), F.col("logged"), 1).alias("avg_stations"))


def shipment_merge(shipments: DataFrame, scans: DataFrame) -> DataFrame:
    """Shipped parcels with their delivery time and scans; a missing log counts as zero scans."""
    days = seconds_between(F.col("shipped_at"), F.col("delivered_at")) / F.lit(float(DAY))
    return (shipments.where(F.col("shipped_at").isNotNull())
            .join(scan_counts(scans), "tracking_no", "left")
            .select("order_id", "tracking_no", "carrier", "status", days.alias("delivery_days"),
                    F.coalesce("scans", F.lit(0)).alias("scans"), "stations"))


def merge_match_counts(products_merged: DataFrame, shipments_merged: DataFrame) -> DataFrame:
    """How many rows of either merge found their counterpart in the logs."""
    def line(df: DataFrame, name: str, hit: Column) -> DataFrame:
        return df.agg(F.count("*").alias("row_count"), F.count_if(hit).alias("matched")).select(
            F.lit(name).alias("merge"), "row_count", "matched")

    return line(products_merged, "product", F.col("product_view") > 0).unionByName(
        line(shipments_merged, "shipment", F.col("scans") > 0))


# ---------------------------------------------------------------- behaviour
def hourly_platform(events: DataFrame, tz: str | None = None) -> DataFrame:
    """Events by hour of day and platform; ``tz`` shifts UTC times to local ones."""
    ts = F.from_utc_timestamp(F.col("ts").cast("timestamp"), tz) if tz else F.col("ts")
    return events.groupBy(F.hour(ts).alias("hour"), "platform").agg(F.count("*").alias("events"))


def engagement(events: DataFrame) -> DataFrame:
    return (events.where(F.col("product_id").isNotNull()).groupBy("product_id", "event_type")
            .agg(F.count("*").alias("events"), F.count_distinct("session_id").alias("sessions")))


def event_stats(events: DataFrame) -> DataFrame:
    """Events in all, events from the live site, and events by type, in one grouping."""
    counted = events.groupBy("event_type").agg(
        F.count("*").alias("n"), F.count_if(F.col("source") == "live_ui").alias("live"))
    sets = counted.select(F.inline(F.array(
        F.struct(F.lit("total").alias("metric"), F.col("n").alias("events")),
        F.struct(F.lit("live").alias("metric"), F.col("live").alias("events")),
        F.struct(F.concat(F.lit("type:"), F.col("event_type")).alias("metric"), F.col("n").alias("events")))))
    return sets.groupBy("metric").agg(F.sum("events").alias("events"))


def events_by_month(events: DataFrame) -> DataFrame:
    return events.groupBy("event_month").agg(
        F.count("*").alias("events"), F.count_distinct("session_id").alias("sessions"))


def monthly_activity(events: DataFrame) -> DataFrame:
    """Events and sessions by month, type and platform. A month depends on its own events only."""
    return events.groupBy("event_month", "event_type", "platform").agg(
        F.count("*").alias("events"), F.count_distinct("session_id").alias("sessions"))
