"""Exact interpolated percentiles of whole numbers, per group.

The built-in exact percentile keeps all distinct values of a group in one buffer.
This one starts from counted values, sums them over coarse ranges of ``width``, and
looks inside only the ranges that hold the wanted positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def percentile_hundredths(counted: DataFrame, group: str, value: str, weight: str, percent: int,
                          width: int) -> DataFrame:
    """(group, hundredths): the percentile times 100, a whole number, nothing rounded.

    ``counted`` holds each value of a group with the number of rows that have it. It
    is read twice, so it should be a stored table. The position is
    percent * (n - 1) / 100, counted from zero.
    """
    values = (counted.where(F.col(value).isNotNull())
              .withColumn("_range", F.call_function("div", F.col(value), F.lit(width)))
              .groupBy(group, "_range", value).agg(F.sum(weight).alias("_n")))
    upto = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    position = F.lit(percent) * (F.col("_total") - 1)
    ranges = (values.groupBy(group, "_range").agg(F.sum("_n").alias("_rows"))
              .withColumn("_before", F.sum("_rows").over(upto) - F.col("_rows"))
              .withColumn("_total", F.sum("_rows").over(Window.partitionBy(group)))
              .withColumn("_low", F.call_function("div", position, F.lit(100)))
              .withColumn("_part", position % 100)
              # The next position counts only when the wanted one lies between two rows.
              .withColumn("_high", F.col("_low") + F.when(F.col("_part") > 0, 1).otherwise(0))
              .where((F.col("_before") <= F.col("_high"))
                     & (F.col("_low") < F.col("_before") + F.col("_rows"))))
    inner = (Window.partitionBy(group, "_range").orderBy(value)
             .rowsBetween(Window.unboundedPreceding, 0))
    seen = (values.join(ranges, [group, "_range"])
            .withColumn("_end", F.col("_before") + F.sum("_n").over(inner))
            .withColumn("_begin", F.col("_end") - F.col("_n")))

    def covers(position: str):
        return (F.col("_begin") <= F.col(position)) & (F.col(position) < F.col("_end"))

    bottom = F.max(F.when(covers("_low"), F.col(value)))
    top = F.max(F.when(covers("_high"), F.col(value)))
    return (seen.groupBy(group)
            .agg(bottom.alias("_bottom"), top.alias("_top"), F.max("_part").alias("_part"))
            .select(group, (F.col("_bottom") * 100 + (F.col("_top") - F.col("_bottom")) * F.col("_part"))
                    .alias("hundredths")))
