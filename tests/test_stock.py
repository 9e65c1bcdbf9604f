"""The distributed stock rules against a plain sequential model."""

import random

import pytest

from soukwise.operators import stock
from soukwise.streaming.stock import _serve_batch, run_allocate, run_batches, served

LINES = "order_id bigint, variant_id bigint, quantity bigint"
STOCK = "variant_id bigint, on_hand bigint"


def greedy(lines, on_hand):
    left, out = dict(on_hand), {}
    for order, variant, quantity in sorted(lines):
        fits = quantity <= left.get(variant, 0)
        if fits:
            left[variant] -= quantity
        out[order, variant] = fits
    return out


def atomic(lines, on_hand):
    left, out, by_order = dict(on_hand), {}, {}
    for order, variant, quantity in lines:
        by_order.setdefault(order, []).append((variant, quantity))
    for order in sorted(by_order):
        fits = all(q <= left.get(v, 0) for v, q in by_order[order])
        if fits:
            for v, q in by_order[order]:
                left[v] -= q
        out[order] = fits
    return out


def sample(seed, orders=120, variants=6, hot=True):
    rng = random.Random(seed)
    lines = []
    for order in range(1, orders + 1):
        wanted = set(rng.sample(range(variants), rng.randint(1, 3)))
        if hot and rng.random() < 0.6:
            wanted.add(0)
        lines += [(order, v, rng.choice([1, 2, 3, 5, 8, 13])) for v in wanted]
    on_hand = {v: rng.randint(0, 120) for v in range(variants - 1)}  # the last variant has no stock row
    rng.shuffle(lines)
    return lines, on_hand


CASES = {
    "exact fit": ([(1, 1, 5), (2, 1, 5)], {1: 10}),
    "one over": ([(1, 1, 5), (2, 1, 6)], {1: 10}),
    "big line skipped, small one fits": ([(1, 1, 4), (2, 1, 9), (3, 1, 6)], {1: 10}),
    "no stock row": ([(1, 9, 1), (2, 1, 1)], {1: 10}),
    "one short line": ([(1, 1, 2), (1, 2, 9), (2, 1, 9), (2, 2, 5)], {1: 10, 2: 5}),
    "all gone": ([(1, 1, 1), (2, 1, 1)], {1: 0}),
    **{f"random {seed}": sample(seed) for seed in range(4)},
}


def all_cases():
    """All cases side by side, each with its own orders and variants."""
    lines, on_hand = [], {}
    for i, (case, held) in enumerate(CASES.values()):
        lines += [(1000 * i + o, 100 * i + v, q) for o, v, q in case]
        on_hand |= {100 * i + v: n for v, n in held.items()}
    return lines, on_hand


def frames(spark, lines, on_hand):
    return spark.createDataFrame(lines, LINES), spark.createDataFrame(list(on_hand.items()), STOCK)


@pytest.mark.parametrize("hot_rows", [1, 40, 10 ** 9], ids=["split", "mixed", "fold"])
def test_line_by_line(spark, hot_rows):
    lines, on_hand = all_cases()
    rows = stock.allocate_lines(*frames(spark, lines, on_hand), hot_rows, ranges=8).collect()
    assert len(rows) == len(lines)
    assert {(r["order_id"], r["variant_id"]): r["accepted"] for r in rows} == greedy(lines, on_hand)


@pytest.mark.parametrize("hot_rows", [1, 40, 10 ** 9], ids=["split", "some", "whole"])
def test_order_by_order(spark, hot_rows):
    lines, on_hand = all_cases()
    rows = stock.allocate_orders(*frames(spark, lines, on_hand), hot_rows, 8).collect()
    assert {r["order_id"]: r["accepted"] for r in rows} == atomic(lines, on_hand)


@pytest.mark.parametrize("name", list(CASES)[:6])
def test_the_models_themselves(name):
    expected = {"exact fit": ([True, True], [True, True]), "one over": ([True, False], [True, False]),
                "big line skipped, small one fits": ([True, False, True], [True, False, True]),
                "no stock row": ([False, True], [False, True]),
                "one short line": None,
                "all gone": ([False, False], [False, False])}[name]
    lines, on_hand = CASES[name]
    if expected:
        assert list(greedy(lines, on_hand).values()) == expected[0]
        assert list(atomic(lines, on_hand).values()) == expected[1]
    else:
        assert greedy(lines, on_hand) == {(1, 1): True, (1, 2): False, (2, 1): False, (2, 2): True}
        assert atomic(lines, on_hand) == {1: False, 2: True}


def test_set_check_refuses_the_whole_batch(spark):
    held = spark.createDataFrame([(1, 10), (2, 5)], STOCK)
    good = spark.createDataFrame([(1, 1, 4), (2, 1, 6), (2, 2, 1)], LINES)
    assert stock.set_shortages(good, held).count() == 0
    assert {tuple(r) for r in stock.set_allocate(good, held).collect()} == {(1, 0), (2, 4)}
    bad = spark.createDataFrame([(1, 1, 4), (2, 1, 7), (2, 3, 1)], LINES)
    assert {tuple(r) for r in stock.set_shortages(bad, held).collect()} == {(1, 10, 11), (3, 0, 1)}
    assert {tuple(r) for r in stock.set_allocate(bad, held).collect()} == {(1, 10), (2, 5)}


def test_restock_on_entering_a_released_state_only(spark):
    changes = spark.createDataFrame(
        [(1, "Pending", "Cancelled"), (2, "Cancelled", "Returned"), (3, "Delivered", "Returned"),
         (4, "Pending", "Pending")], "order_id bigint, old_status string, new_status string")
    lines = spark.createDataFrame([(1, 1, 2), (2, 1, 30), (3, 1, 4), (3, 2, 1), (4, 1, 50)], LINES)
    held = spark.createDataFrame([(1, 10), (2, 0), (3, 7)], STOCK)
    got = {r["variant_id"]: (r["returned"], r["on_hand_after"]) for r in
           stock.restock(changes, lines, held).collect()}
    assert got == {1: (6, 16), 2: (1, 1), 3: (0, 7)}


def test_streaming_stock_remembers_what_is_left(spark, tmp_path):
    lines, on_hand = sample(11, orders=60)
    lines.sort()
    source = str(tmp_path / "lines")
    for part in (lines[:70], lines[70:]):
        spark.createDataFrame(part, LINES).coalesce(1).write.mode("append").parquet(source)
    held = spark.createDataFrame(list(on_hand.items()), STOCK)
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    for _ in range(2):  # the second run finds nothing new and must not repeat anything
        stream = spark.readStream.schema(LINES).option("maxFilesPerTrigger", 1).parquet(source)
        run_allocate(stream, held, out, progress).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert len(rows) == len(lines)
    assert {(r["order_id"], r["variant_id"]): r["accepted"] for r in rows} == greedy(lines, on_hand)


def test_stock_batch_by_batch(spark, tmp_path):
    lines, on_hand = sample(12, orders=60)
    lines.sort()
    source, out, progress = (str(tmp_path / n) for n in ("lines", "out", "progress"))
    held = spark.createDataFrame(list(on_hand.items()), STOCK)
    for part in (lines[:70], lines[70:]):
        spark.createDataFrame(part, LINES).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(LINES).parquet(source)
        run_batches(stream, held, out, progress, hot_rows=20).awaitTermination()
    # A batch that is delivered again changes nothing.
    _serve_batch(held, out, 20)(spark.createDataFrame(lines[70:], LINES), 1)
    # An order whose lines fall into two batches is still served line by line.
    rows = served(spark, out).collect()
    assert len(rows) == len(lines)
    assert {(r["order_id"], r["variant_id"]): r["accepted"] for r in rows} == greedy(lines, on_hand)
