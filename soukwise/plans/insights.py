"""The numbers behind the six charts of the management report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soukwise.functions.exact import cents, half_up, percent, seconds_between, whole
from soukwise.operators.ranking import pct_ranks
from soukwise.plans.business import DAY, delivered, month_of
from soukwise.plans.merges import FUNNEL_STEPS, funnel_row, hourly_platform, scan_counts
from soukwise.session import materialise

# Fixed values of the report.
TOP_CATEGORIES = 4
SCATTER_CATEGORIES = 6
MIX_CATEGORIES = 10
LEAK_VIEWS = 0.75
LEAK_REVENUE = 0.35
STRONG = 0.6
BILLION = 10 ** 9


def insight_funnel(events: DataFrame) -> DataFrame:
    first, cart, checkout, last = (F.col(f"{step}_sessions") for step in FUNNEL_STEPS)
    base = F.greatest(first, F.lit(1))
    return funnel_row(events).select(percent(base - last, base, 1).alias("drop_pct"),
                                     percent(cart, base, 1).alias("cart_pct"),
                                     percent(checkout, base, 1).alias("checkout_pct"))


def month_category_revenue(lines: DataFrame, products: DataFrame) -> DataFrame:
    per_product = (delivered(lines).groupBy(month_of(F.col("order_date")).alias("month"), "product_id")
                   .agg(F.sum("line_revenue").alias("revenue")))
    return (per_product.join(products.select("product_id", "category"), "product_id")
            .groupBy("month", "category").agg(F.sum("revenue").alias("revenue")))


def monthly_trend(monthly: DataFrame) -> DataFrame:
    """Revenue by month in all and for the leading categories."""
    monthly = materialise(monthly)
    leaders = (monthly.groupBy("category").agg(F.sum("revenue").alias("r"))
               .orderBy(F.desc("r"), "category").limit(TOP_CATEGORIES).select("category"))
    total = monthly.groupBy("month").agg(F.sum("revenue").alias("revenue")).select(
        F.lit("total").alias("series"), "month", "revenue")
    lines = monthly.join(leaders, "category", "left_semi").select(
        F.col("category").alias("series"), "month", "revenue")
    return total.unionByName(lines)


def insight_months(monthly: DataFrame) -> DataFrame:
    """Best and worst month, the earlier one on ties."""
    total = monthly.groupBy("month").agg(F.sum("revenue").alias("revenue"))
    best, worst = F.struct(-F.col("revenue"), "month"), F.struct("revenue", "month")
    return total.agg(F.min_by("month", best).alias("best_month"), F.max("revenue").alias("best_revenue"),
                     F.min_by("month", worst).alias("worst_month"), F.min("revenue").alias("worst_revenue"))


# ------------------------------------------------------- views and revenue
def viewed_and_sold(merged: DataFrame) -> DataFrame:
    return merged.where((F.col("product_view") > 0) & (F.col("revenue") > 0)).select(
        "product_id", "product_name", "category", F.col("product_view").alias("views"), "revenue")


def leaks_among(pairs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Products in the top quarter by views but the bottom 35 percent by revenue."""
    both = pct_ranks(pairs.withColumn("_cents", cents(F.col("revenue"))), {"views_pct": "views", "revenue_pct": "_cents"},
                     "product_id", buckets)
    return both.where((F.col("views_pct") > LEAK_VIEWS) & (F.col("revenue_pct") < LEAK_REVENUE)).select(
        "product_id", "product_name", "category", "views", "revenue", "views_pct", "revenue_pct")


def leak_products(merged: DataFrame, buckets: int | None = None) -> DataFrame:
    return leaks_among(viewed_and_sold(merged), buckets)


def insight_view_revenue(merged: DataFrame, buckets: int | None = None) -> DataFrame:
    pairs = materialise(viewed_and_sold(merged))
    leaks = leaks_among(pairs, buckets).agg(F.count("*"))
    return pairs.agg(F.round(F.corr("views", F.col("revenue").cast("double")), 6).alias("corr"),
                     F.count("*").alias("products")).select(
        "corr", "products", leaks.scalar().alias("leak_count"))


def view_revenue_points(merged: DataFrame) -> DataFrame:
    """Scatter points of the categories with the most such products."""
    pairs = materialise(viewed_and_sold(merged))
    biggest = (pairs.groupBy("category").agg(F.count("*").alias("n"))
               .orderBy(F.desc("n"), "category").limit(SCATTER_CATEGORIES).select("category"))
    return pairs.join(biggest, "category", "left_semi").select("product_id", "category", "views", "revenue")


# -------------------------------------------------------------------- hours
def hour_matrix(events: DataFrame) -> DataFrame:
    """Events per platform, one column for each hour, zero where there were none."""
    hours = list(range(24))
    wide = (hourly_platform(events).groupBy("platform").pivot("hour", hours).agg(F.sum("events")))
    return wide.select("platform", *[
        F.coalesce(F.col(f"`{h}`"), F.lit(0)).alias(f"h{h:02d}") for h in hours])


def insight_hours(events: DataFrame) -> DataFrame:
    """Busiest hour, quietest hour and leading platform; the first on ties."""
    matrix = hour_matrix(events)
    hours = [f"h{h:02d}" for h in range(24)]
    whole_row = F.reduce(F.array(*hours), F.lit(0).cast("bigint"), lambda a, x: a + x)
    totals = matrix.agg(*[F.sum(h).alias(h) for h in hours],
                        F.min_by("platform", F.struct(-whole_row, "platform")).alias("top_platform"))
    by_hour = F.array(*hours)
    return totals.select((F.array_position(by_hour, F.array_max(by_hour)) - 1).alias("peak_hour"),
                         (F.array_position(by_hour, F.array_min(by_hour)) - 1).alias("quiet_hour"),
                         "top_platform")


# ----------------------------------------------------------------- carriers
def _carrier_sums(shipments: DataFrame, scans: DataFrame) -> DataFrame:
    timed = (shipments.where(F.col("shipped_at").isNotNull() & F.col("delivered_at").isNotNull())
             .select("tracking_no", "carrier",
                     seconds_between(F.col("shipped_at"), F.col("delivered_at")).alias("seconds")))
    return (timed.join(scan_counts(scans), "tracking_no", "left").groupBy("carrier")
            .agg(F.sum("seconds").alias("seconds"), F.coalesce(F.sum("scans"), F.lit(0)).alias("scans"),
                 F.count("*").alias("n")))


def carrier_perf(shipments: DataFrame, scans: DataFrame) -> DataFrame:
    """Mean days and mean scans of delivered parcels; a parcel without a log has zero scans."""
    return _carrier_sums(shipments, scans).select(
        "carrier", half_up(F.col("seconds"), F.col("n") * DAY, 4).alias("days"),
        half_up(F.col("scans"), F.col("n"), 4).alias("scans"), "n")


def insight_carriers(shipments: DataFrame, scans: DataFrame) -> DataFrame:
    means = _carrier_sums(shipments, scans).select(
        "carrier", (F.col("seconds") / (F.col("n") * F.lit(float(DAY)))).alias("days"),
        (F.col("scans") / F.col("n").cast("double")).alias("scans"))
    summary = means.agg(
        F.min_by("carrier", F.struct("days", "carrier")).alias("fastest"),
        F.max_by("carrier", F.struct("days", "carrier")).alias("slowest"),
        F.round(F.max("days") - F.min("days"), 6).alias("gap"),
        F.when(F.count("*") > 2, F.round(F.corr("days", "scans"), 6)).alias("corr"))
    label = (F.when(F.col("corr") >= STRONG, "together").when(F.col("corr") <= -STRONG, "opposite")
             .otherwise("weak"))
    return summary.withColumn("relation", label)


# --------------------------------------------------------------- categories
def category_mix(merged: DataFrame) -> DataFrame:
    """Leading categories by revenue with the sessions that viewed them per billion of revenue."""
    return (merged.groupBy("category")
            .agg(F.sum("revenue").alias("revenue"), F.sum("product_view").alias("views"))
            .orderBy(F.desc("revenue"), "category").limit(MIX_CATEGORIES)
            .withColumn("view_per_billion",
                        half_up(whole(F.col("views")) * (BILLION * 100), cents(F.col("revenue")))))


def insight_categories(mix: DataFrame) -> DataFrame:
    exact = F.col("views") / F.nullif(F.col("revenue").cast("double"), F.lit(0.0))
    hot = F.when(exact.isNotNull(), F.struct(-exact, -F.col("revenue"), "category"))
    return mix.agg(F.min_by("category", F.struct(-F.col("revenue"), "category")).alias("leader"),
                   F.min_by("category", hot).alias("hot"))


# ------------------------------------------------------------------- report
def _report_lines(df: DataFrame, chart: str, title: str, numbers: list[str], labels: list[str]) -> DataFrame:
    def entry(metric: str, value: Column, label: Column) -> Column:
        return F.struct(F.lit(chart).alias("id"), F.lit(title).alias("title"), F.lit(metric).alias("metric"),
                        value.cast("double").alias("value"), label.cast("string").alias("label"))

    entries = [entry(m, F.col(m), F.lit(None)) for m in numbers] + [
        entry(m, F.lit(None), F.col(m)) for m in labels]
    return df.select(F.inline(F.array(*entries)))


def insight_report(events: DataFrame, monthly: DataFrame, merged: DataFrame, shipments: DataFrame,
                   scans: DataFrame) -> DataFrame:
    """All findings as rows: chart, metric and either a number or a label."""
    parts = [
        _report_lines(insight_funnel(events), "01_funnel", "Conversion funnel",
                      ["drop_pct", "cart_pct", "checkout_pct"], []),
        _report_lines(insight_months(monthly), "02_monthly_revenue", "Revenue by month",
                      ["best_revenue", "worst_revenue"], ["best_month", "worst_month"]),
        _report_lines(insight_view_revenue(merged), "03_view_vs_revenue", "Views against revenue",
                      ["corr", "leak_count"], []),
        _report_lines(insight_hours(events), "04_hourly_heatmap", "Events by hour",
                      ["peak_hour", "quiet_hour"], ["top_platform"]),
        _report_lines(insight_carriers(shipments, scans), "05_carrier_performance", "Carriers",
                      ["gap", "corr"], ["fastest", "slowest", "relation"]),
        _report_lines(insight_categories(category_mix(merged)), "06_category_mix", "Categories",
                      [], ["leader", "hot"]),
    ]
    return reduce(DataFrame.unionByName, parts)
