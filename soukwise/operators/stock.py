"""Stock rules: who gets the units that are on hand.

Lines are (order_id, variant_id, quantity), one line per order and variant, and
orders are served in the sequence of their numbers. Stock is (variant_id,
on_hand); a variant without a stock row has nothing to give.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from soukwise.operators.skew import HOT_ROWS, RANGES, hot_keys, running_sums
from soukwise.session import materialise, ship_code



def one_line_per_order(lines: DataFrame) -> DataFrame:
    return lines.groupBy("order_id", "variant_id").agg(F.sum("quantity").alias("quantity"))


# ---------------------------------------------------------- check as a set
def set_shortages(lines: DataFrame, stock: DataFrame) -> DataFrame:
    """Variants whose summed demand exceeds the stock; any row means the batch is refused."""
    need = lines.groupBy("variant_id").agg(F.sum("quantity").alias("needs"))
    has = F.coalesce(F.col("on_hand"), F.lit(0))
    return (need.join(stock.select("variant_id", "on_hand"), "variant_id", "left")
            .where(F.col("on_hand").isNull() | (F.col("on_hand") < F.col("needs")))
            .select("variant_id", has.alias("has"), "needs"))


def set_allocate(lines: DataFrame, stock: DataFrame) -> DataFrame:
    """Stock after the batch; untouched when the batch is refused."""
    need = lines.groupBy("variant_id").agg(F.sum("quantity").alias("needs"))
    refused = set_shortages(lines, stock).agg(F.count("*") > 0).scalar()
    left = F.col("on_hand") - F.when(refused, 0).otherwise(F.coalesce(F.col("needs"), F.lit(0)))
    return stock.join(need, "variant_id", "left").select("variant_id", left.alias("on_hand"))


# ------------------------------------------------------------ line by line
def _serve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hand out stock along rows sorted by variant and order; keeps one number per task."""
    current, left = None, 0
    for batch in batches:
        taken = []
        for variant, quantity, on_hand in zip(batch["variant_id"], batch["quantity"], batch["on_hand"]):
            if variant != current:
                current, left = variant, on_hand
            fits = quantity <= left
            left -= quantity if fits else 0
            taken.append(fits)
        yield batch[["order_id", "variant_id", "quantity"]].assign(accepted=taken)


def _serve_hot(lines: DataFrame, stock: DataFrame, hot: DataFrame) -> DataFrame:
    """The same decision for variants too big for one task.

    A line can win only if it fits the units left. Along the lines that still
    could, running sums find the first that no longer fits; from there on the
    smaller rest is what counts. Every round shrinks the largest quantity that can
    still win, so there are no more rounds than distinct quantities. A round leaves
    one row per variant: up to which order lines of up to which quantity win.
    """
    lines = materialise(lines)
    state = materialise(stock.select("variant_id", F.lit(-1).cast("bigint").alias("after"), F.col("on_hand").alias("units")))
    windows = []
    while True:
        candidates = (lines.join(state, "variant_id")
                      .where((F.col("order_id") > F.col("after")) & (F.col("quantity") <= F.col("units"))))
        summed = running_sums(candidates, "variant_id", "order_id", {"quantity": "taken"}, hot)
        over = F.col("taken") > F.col("units")
        ends = summed.groupBy("variant_id").agg(F.min(F.when(over, F.col("order_id"))).alias("stop"),
                                                F.max(F.when(~over, F.col("taken"))).alias("used"))
        done = materialise(state.join(ends, "variant_id", "left"))
        windows.append(done.select("variant_id", "after", "stop", "units"))
        left = F.col("units") - F.coalesce("used", F.lit(0))
        state = materialise(done.where(F.col("stop").isNotNull() & (left > 0)).select(
            "variant_id", F.col("stop").alias("after"), left.alias("units")))
        if state.isEmpty():
            break
    # A line lies in at most one window of its variant.
    per_variant = reduce(DataFrame.union, windows).groupBy("variant_id").agg(
        F.collect_list(F.struct("after", "stop", "units")).alias("windows"))
    won = lines.join(per_variant, "variant_id", "left")
    fits = F.exists("windows", lambda w: (F.col("order_id") > w["after"])
                    & (w["stop"].isNull() | (F.col("order_id") < w["stop"]))
                    & (F.col("quantity") <= w["units"]))
    return won.select("order_id", "variant_id", "quantity", F.coalesce(fits, F.lit(False)).alias("accepted"))


def allocate_lines(lines: DataFrame, stock: DataFrame, hot_rows: int = HOT_ROWS,
                   ranges: int = RANGES) -> DataFrame:
    """Line-greedy: in order sequence a line wins if its variant still has enough, else it is skipped."""
    demand = lines.groupBy("variant_id").agg(F.sum("quantity").alias("demand"))
    # One row per variant, stored because both branches below look it up.
    known = materialise(demand.join(stock.select("variant_id", "on_hand"), "variant_id", "left").select(
        "variant_id", "demand", F.coalesce(F.col("on_hand"), F.lit(0)).alias("on_hand")))
    facts = lines.select("order_id", "variant_id", "quantity").join(known, "variant_id")
    out = ["order_id", "variant_id", "quantity", "accepted"]

    # Most variants never run short, and a line larger than the whole stock never wins.
    easy = F.col("demand") <= F.col("on_hand")
    hopeless = F.col("quantity") > F.col("on_hand")
    settled = facts.where(easy | hopeless).select(*out[:3], easy.alias("accepted"))
    contended = materialise(
        facts.where(~easy & ~hopeless).select("variant_id", "order_id", "quantity", "on_hand"))

    hot = hot_keys(contended, "variant_id", "order_id", hot_rows, ranges)
    named = None if hot is None else hot.select(F.col("_hot").alias("variant_id"))
    ship_code(lines.sparkSession)
    cold = contended if hot is None else contended.join(named, "variant_id", "left_anti")
    served = (cold.repartition("variant_id").sortWithinPartitions("variant_id", "order_id")
              .mapInPandas(_serve, "order_id bigint, variant_id bigint, quantity bigint, accepted boolean"))
    result = settled.unionByName(served)
    if hot is not None:
        big = contended.join(named, "variant_id", "left_semi").select("order_id", "variant_id", "quantity")
        result = result.unionByName(_serve_hot(big, known.join(named, "variant_id", "left_semi"), hot))
    return result


# ----------------------------------------------------------- order by order
def _round(work: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Decide what can be decided: adds ``lost`` and closes the lines of winners."""
    quantity, is_open = F.col("quantity"), F.col("open")
    split = work.withColumns({"_open": F.when(is_open, quantity).otherwise(0),
                              "_won": F.when(is_open, 0).otherwise(quantity)})
    summed = running_sums(split, "variant_id", "order_id", {"_open": "open_to", "_won": "won_to"}, hot)
    # The running sums include the row itself, as an open line.
    fits_after_all = F.col("won_to") + F.col("open_to") <= F.col("on_hand")
    fits_after_winners = F.col("won_to") + quantity <= F.col("on_hand")
    verdict = (summed.where("open").groupBy("order_id")
               .agg(F.bool_and(fits_after_all).alias("_wins"), F.bool_and(fits_after_winners).alias("_may_win")))
    return work.join(verdict, "order_id", "left").select(
        "order_id", "variant_id", "quantity", "on_hand",
        (is_open & ~F.coalesce(F.col("_wins"), F.lit(False)) & F.coalesce(F.col("_may_win"), F.lit(True)))
        .alias("open"),
        (~F.coalesce(F.col("_may_win"), F.lit(True))).alias("lost"))


def _between_open(work: DataFrame) -> DataFrame:
    """Only what still matters to an open line.

    Winners ahead of a variant's first open line are taken off its stock, winners
    behind its last one and variants without an open line are left out.
    """
    span = work.where("open").groupBy("variant_id").agg(F.min("order_id").alias("_first"),
                                                        F.max("order_id").alias("_last"))
    near = work.join(span, "variant_id")
    spent = (near.where(F.col("order_id") < F.col("_first")).groupBy("variant_id")
             .agg(F.sum("quantity").alias("_spent")))
    kept = (near.where(F.col("order_id").between(F.col("_first"), F.col("_last")))
            .join(spent, "variant_id", "left")
            .select("order_id", "variant_id", "quantity",
                    (F.col("on_hand") - F.coalesce("_spent", F.lit(0))).alias("on_hand"), "open"))
    return materialise(kept)


def allocate_orders(lines: DataFrame, stock: DataFrame, hot_rows: int = HOT_ROWS, ranges: int = RANGES) -> DataFrame:
    """Order-atomic: an order wins if all its lines fit what earlier winners left, else it takes nothing.

    Solved in rounds. An open order wins if it fits even when every earlier open
    order wins, and loses if it does not fit even when none of them does. The
    earliest open order is always decided; in practice each round decides about
    half of the rest. Lines that no open order depends on leave the rounds.
    """
    demand = lines.groupBy("variant_id").agg(F.sum("quantity").alias("demand"))
    known = demand.join(stock.select("variant_id", "on_hand"), "variant_id", "left").select(
        "variant_id", "demand", F.coalesce(F.col("on_hand"), F.lit(0)).alias("on_hand"))
    # Variants that cover their whole demand restrict nobody.
    scarce = known.where(F.col("demand") > F.col("on_hand")).select("variant_id", "on_hand")
    work = materialise(lines.select("order_id", "variant_id", "quantity").join(scarce, "variant_id")
                       .withColumn("open", F.lit(True)))
    hot = hot_keys(work, "variant_id", "order_id", hot_rows, ranges)

    losers = []
    while True:
        count = Observation()
        decided = materialise(_round(work, hot).observe(
            count, F.count_if("open").alias("open"), F.count_if(~F.col("lost")).alias("kept")))
        losers.append(decided.where("lost").select("order_id"))
        # Losers leave; winners stay as taken stock. A loser is never open again.
        work = decided.where(~F.col("lost")).drop("lost")
        still_open, kept = count.get["open"], count.get["kept"]
        if still_open == 0:
            break
        if still_open * 4 < kept:
            work = _between_open(work)
    lost = reduce(DataFrame.union, losers).distinct().withColumn("_lost", F.lit(True))
    return (lines.select("order_id").distinct().join(lost, "order_id", "left")
            .select("order_id", F.col("_lost").isNull().alias("accepted")))


# ------------------------------------------------------------------ restock
RELEASED = ("Cancelled", "Returned")


def restock(changes: DataFrame, lines: DataFrame, stock: DataFrame) -> DataFrame:
    """Stock after orders moved into a released state from outside: their units come back.

    ``changes`` is (order_id, old_status, new_status).
    """
    released = changes.where(F.col("new_status").isin(*RELEASED) & ~F.col("old_status").isin(*RELEASED))
    back = (lines.join(released.select("order_id"), "order_id", "left_semi")
            .groupBy("variant_id").agg(F.sum("quantity").alias("returned")))
    units = F.coalesce(F.col("returned"), F.lit(0))
    return (stock.join(back, "variant_id", "left")
            .select("variant_id", "on_hand", units.alias("returned"),
                    (F.col("on_hand") + units).alias("on_hand_after")))
