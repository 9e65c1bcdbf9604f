"""Constraint checks as jobs: CHECK, UNIQUE and foreign keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soukwise.sources.model import ORDER_STATUS, PAYMENT_METHOD, PAYMENT_STATUS, SHIPMENT_STATUS


def _one_of(column: str, values: tuple[str, ...]) -> str:
    return f"{column} in ({', '.join(repr(v) for v in values)})"


# The CHECK rules of the model, as (rule, columns read, condition). A rule holds when
# its condition is true or NULL.
CHECKS = (
    ("customer.email", ("email",), "email like '%@%.%'"),
    ("seller.rating", ("rating_avg",), "rating_avg between 0 and 5"),
    ("category.not_self", ("parent_id", "category_id"), "parent_id is null or parent_id <> category_id"),
    ("product.price", ("base_price",), "base_price > 0"),
    ("inventory.quantity", ("quantity_on_hand",), "quantity_on_hand >= 0"),
    ("inventory.safety", ("safety_stock",), "safety_stock >= 0"),
    ("promotion.pct", ("discount_pct",), "discount_pct > 0 and discount_pct <= 100"),
    ("promotion.range", ("start_date", "end_date"), "end_date >= start_date"),
    ("orders.status", ("status",), _one_of("status", ORDER_STATUS)),
    ("orders.discount", ("discount",), "discount >= 0"),
    ("orders.cancel", ("status", "cancel_reason"), "status <> 'Cancelled' or cancel_reason is not null"),
    ("order_line.quantity", ("quantity",), "quantity > 0"),
    ("order_line.price", ("unit_price",), "unit_price > 0"),
    ("payment.status", ("status",), _one_of("status", PAYMENT_STATUS)),
    ("payment.method", ("method",), _one_of("method", PAYMENT_METHOD)),
    ("payment.amount", ("amount",), "amount >= 0"),
    ("payment.paid_at", ("status", "paid_at"), "status <> 'Paid' or paid_at is not null"),
    ("shipment.status", ("status",), _one_of("status", SHIPMENT_STATUS)),
    ("shipment.dates", ("shipped_at", "delivered_at"),
     "delivered_at is null or shipped_at is null or delivered_at >= shipped_at"),
    ("review.rating", ("rating",), "rating between 1 and 5"),
)


def check_table(df: DataFrame, table: str) -> DataFrame:
    """(rule, violations) for all rules of a table, in one pass; NULL where the table lacks a column of the rule."""
    rules = [(rule, F.count_if(~F.expr(sql)) if set(columns) <= set(df.columns) else F.lit(None).cast("bigint"))
             for rule, columns, sql in CHECKS if rule.split(".")[0] == table]
    row = df.agg(F.count("*"), *[found.alias(rule) for rule, found in rules])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.col(f"`{rule}`").alias("violations")) for rule, _ in rules])))


def dq_checks(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [check_table(df, name) for name, df in tables.items()])


def duplicates(df: DataFrame, keys: list[str], rule: str) -> DataFrame:
    """Key values that occur more than once; a key with a NULL part repeats nothing."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counted = df.where(complete).groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)
    return counted.agg(F.count("*").alias("repeated_keys"),
                       F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows")).select(
        F.lit(rule).alias("rule"), "repeated_keys", "extra_rows")


def dq_unique(keys: list[tuple[str, DataFrame, list[str]]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [duplicates(df, cols, rule) for rule, df, cols in keys])


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, rule: str) -> DataFrame:
    """Child rows that refer to nothing. References are counted before they are looked up."""
    refs = (child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("_ref"))
            .agg(F.count("*").alias("n")))
    lost = refs.join(parent.select(F.col(parent_key).alias("_ref")), "_ref", "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans")).select(
        F.lit(rule).alias("rule"), "orphans")


def dq_orphans(links: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [orphans(c, ck, p, pk, rule) for rule, c, ck, p, pk in links])


def coerce_numeric(df: DataFrame) -> DataFrame:
    """Turn text columns into DOUBLE where every non-null value is a number, and some value exists."""
    text = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    if not text:
        return df
    tests = [((F.count(F.col(f"`{c}`").try_cast("double")) == F.count(f"`{c}`"))
              & (F.count(f"`{c}`") > 0)).alias(c) for c in text]
    numeric = df.agg(*tests).first().asDict()
    return df.withColumns({c: F.col(f"`{c}`").cast("double") for c in text if numeric[c]})
