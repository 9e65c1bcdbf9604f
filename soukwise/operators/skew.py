"""Keys that hold too many rows for one task, and sums that run across them."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from soukwise.session import materialise

HOT_ROWS = 1_000_000
RANGES = 256


def hot_keys(df: DataFrame, key: str, range_on: str, floor: int = HOT_ROWS, ranges: int = RANGES) -> DataFrame | None:
    """(key, points) for every key of ``floor`` rows or more, NULL among them: where to cut its rows into ranges
    of the number ``range_on``. None if there is no such key.

    A table, however many keys it has; the points of a key follow from its own rows, so its ranges are even.
    """
    counted = df.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") >= floor)
    hot = materialise(counted.select(F.col(key).alias("_hot"), F.lit(True).alias("_is_hot")))
    if hot.isEmpty():
        return None
    probes = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    own = df.join(hot, F.col(key).eqNullSafe(F.col("_hot"))).groupBy("_hot").agg(
        F.percentile_approx(F.col(range_on).cast("double"), probes, 4 * ranges).alias("_points"))
    return materialise(own.select("_hot", F.coalesce("_points", F.array().cast("array<double>")).alias("_points")))


def split_points(df: DataFrame, columns: list[str], buckets: int) -> list[list[float]]:
    """Quantile probes per column from one pass over ``df``; repeats mean frequent values."""
    probes = [i / buckets for i in range(1, buckets)]
    found = df.approxQuantile(columns, probes, 1.0 / (4 * buckets))
    return [list(points) for points in found]


def with_buckets(df: DataFrame, points: dict[str, list[float]], prefix: str = "_in_") -> DataFrame:
    """Range bucket of numeric columns, a pure function of their values.

    Adds ``prefix + column`` for every column in ``points``.
    """
    columns = list(points)
    wide = df.selectExpr("*", *[f"double(`{c}`) as `_double_{c}`" for c in columns])
    # A column of an empty table has no points; any cut will do.
    cut = Bucketizer(splitsArray=[[float("-inf"), *sorted(set(points[c]) or {0.0}), float("inf")] for c in columns],
                     inputCols=[f"_double_{c}" for c in columns], outputCols=[f"{prefix}{c}" for c in columns])
    return cut.transform(wide).drop(*[f"_double_{c}" for c in columns])


def running_sums(df: DataFrame, group: str, order: str, values: dict[str, str],
                 hot: DataFrame | None, range_on: str | None = None) -> DataFrame:
    """Inclusive running sums per group in ``order`` (unique within a group).

    Groups in ``hot`` are cut into ranges of the order key: every range is summed
    on its own and starts from the total of the ranges before it. Other groups
    fit one window partition. ``range_on`` is a number that rises with ``order``,
    needed where ``order`` itself is not one.
    """
    if hot is None:
        frame = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({out: F.sum(src).over(frame) for src, out in values.items()})

    place = F.col(range_on or order).cast("double")
    ranged = (df.join(hot, F.col(group).eqNullSafe(F.col("_hot")), "left")
              .withColumn("_range", F.coalesce(F.size(F.filter("_points", lambda p: p < place)), F.lit(0)))
              .withColumn("_cut", F.col("_points").isNotNull()).drop("_hot", "_points"))
    totals = (ranged.where("_cut").groupBy(group, "_range").agg(*[F.sum(src).alias(f"_{src}") for src in values]))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per hot group and range.
    starts = totals.select(F.col(group).alias("_of"), F.col("_range").alias("_from"), *[
        F.coalesce(F.sum(f"_{src}").over(earlier), F.lit(0)).alias(f"_start_{src}") for src in values])
    frame = (Window.partitionBy(group, "_range").orderBy(order)
             .rowsBetween(Window.unboundedPreceding, 0))
    summed = (ranged.join(starts, F.col("_cut") & F.col(group).eqNullSafe(F.col("_of")) & (F.col("_range") == F.col("_from")),
                          "left")
              .withColumns({out: F.sum(src).over(frame) + F.coalesce(F.col(f"_start_{src}"), F.lit(0))
                            for src, out in values.items()}))
    return summed.drop("_range", "_cut", "_of", "_from", *[f"_start_{src}" for src in values])
