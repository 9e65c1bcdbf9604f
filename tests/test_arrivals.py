"""Order placement, views over change rows and chained deletes against sequential models."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from soukwise.operators.deletes import CASCADE, RESTRICT, SET_NULL, Deletion, Reference
from soukwise.streaming import placement, views


def orders(rnd, n, variants=6):
    return [(k, 100 + k % 3, [(rnd.randrange(variants), rnd.randrange(40), rnd.randrange(1, 5)) for _ in range(rnd.randrange(1, 4))])
            for k in range(n)]


def write_orders(spark, path, rows):
    schema = "order_id bigint, customer_id bigint, lines array<struct<variant_id: bigint, product_id: bigint, quantity: int>>"
    frame = spark.createDataFrame(rows, schema)
    priced = F.transform("lines", lambda x: F.struct(x["variant_id"].alias("variant_id"), x["product_id"].alias("product_id"),
                         x["quantity"].alias("quantity"), (x["quantity"] * 10).cast("decimal(18,2)").alias("line_revenue")))
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("order_id") * 86400)
    (frame.withColumns({"lines": priced, "placed_at": at, "session_id": F.lit("s"), "payment_method": F.lit("COD")})
     .coalesce(1).write.mode("append").json(path))


def served_one_by_one(rows, on_hand):
    left, accepted = dict(on_hand), {}
    for key, _, lines in rows:
        need = Counter()
        for variant, _, quantity in lines:
            need[variant] += quantity
        accepted[key] = all(left.get(v, 0) >= q for v, q in need.items())
        if accepted[key]:
            for v, q in need.items():
                left[v] -= q
    return accepted, left


@pytest.fixture
def shop(spark, tmp_path):
    rnd = random.Random(6)
    rows, on_hand = orders(rnd, 60), {v: 12 + 9 * v for v in range(5)}
    frame = spark.createDataFrame(list(on_hand.items()), "variant_id bigint, on_hand bigint")
    return rows, on_hand, frame, str(tmp_path)


def place(spark, shop, **more):
    _, _, frame, root = shop
    placement.run_placement(placement.read_orders(spark, f"{root}/in", 1), frame, f"{root}/out", f"{root}/progress", **more).awaitTermination()


def check(spark, shop):
    rows, on_hand, frame, root = shop
    accepted, left = served_one_by_one(rows, on_hand)
    assert {r["order_id"]: r["accepted"] for r in placement.decisions(spark, f"{root}/out").collect()} == accepted
    assert dict(placement.stock_after(spark, frame, f"{root}/out").collect()) == left
    events = placement.logged(spark, f"{root}/out").collect()
    assert sorted(e["order_id"] for e in events) == sorted(k for k, ok in accepted.items() if ok)
    lines = {k: x for k, _, x in rows}
    for e in events:
        assert e["product_ids"] == sorted({p for _, p, _ in lines[e["order_id"]]})
        assert e["revenue"] == sum(10 * q for _, _, q in lines[e["order_id"]])


def test_orders_over_several_triggers(spark, shop, monkeypatch):
    monkeypatch.setattr(placement, "WHOLE_EVERY", 2)
    rows, root = shop[0], shop[3]
    for part in (rows[:20], rows[20:35], rows[35:]):
        write_orders(spark, f"{root}/in", part)
    place(spark, shop)
    assert len(placement.committed(spark, f"{root}/out")) == 3
    check(spark, shop)
    # An order that is delivered again changes nothing.
    write_orders(spark, f"{root}/in", rows[10:40])
    place(spark, shop)
    check(spark, shop)


def test_a_batch_that_fails_between_its_sinks_shows_neither(spark, shop, monkeypatch):
    rows, root = shop[0], shop[3]
    write_orders(spark, f"{root}/in", rows[:30])
    place(spark, shop)
    before = placement.decisions(spark, f"{root}/out").count(), placement.logged(spark, f"{root}/out").count()
    write_orders(spark, f"{root}/in", rows[30:])
    with monkeypatch.context() as broken:
        def fail(*_):
            raise RuntimeError("lost")
        broken.setattr(placement, "_write_events", fail)
        with pytest.raises(Exception, match="lost"):
            place(spark, shop)
    assert (placement.decisions(spark, f"{root}/out").count(), placement.logged(spark, f"{root}/out").count()) == before
    with monkeypatch.context() as broken:
        broken.setattr(placement, "_commit", fail)
        with pytest.raises(Exception, match="lost"):
            place(spark, shop)
    assert placement.logged(spark, f"{root}/out").count() == before[1]
    place(spark, shop)
    check(spark, shop)


def test_a_committed_batch_is_not_served_twice(spark, shop):
    rows, _, frame, root = shop
    write_orders(spark, f"{root}/in", rows)
    place(spark, shop)
    batch = spark.read.schema(placement.ORDER_DOCUMENT).json(f"{root}/in")
    placement._place_batch(frame, f"{root}/out", 1000)(batch, 0)
    check(spark, shop)


def test_nothing_placed_yet(spark, tmp_path):
    assert placement.decisions(spark, str(tmp_path)).collect() == placement.logged(spark, str(tmp_path)).collect() == []


def deliver(spark, path, rows, schema, cuts):
    for low, high in zip([0, *cuts], [*cuts, len(rows)]):
        spark.createDataFrame(rows[low:high], schema).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("cuts", [[], [1], [5, 30, 31], [10, 20, 30, 40]])
def test_rating_view_for_any_split(spark, tmp_path, cuts):
    rnd = random.Random(9)
    rows, held = [], {}
    for _ in range(50):
        key = rnd.randrange(12)
        new = rnd.choice([1, 2, 3, 4, 5, None]) if key in held else rnd.randrange(1, 6)
        rows.append((key, 1, key % 5, held.get(key), new))
        held[key] = new
        if new is None:
            del held[key]
    products = spark.createDataFrame([(p, p % 2) for p in range(4)], "product_id bigint, seller_id bigint")
    sellers = spark.createDataFrame([(0,), (1,), (2,)], "seller_id bigint")
    root = str(tmp_path)
    deliver(spark, f"{root}/in", rows, views.REVIEW_CHANGE, cuts)
    views.run_rating_sums(views.read_changes(spark, f"{root}/in", views.REVIEW_CHANGE, 1), products, f"{root}/out",
                          f"{root}/progress").awaitTermination()
    found = {r["seller_id"]: float(r["rating_avg"]) for r in views.rating_view(spark, sellers, f"{root}/out").collect()}
    for seller in (0, 1, 2):
        marks = [r for k, r in held.items() if k % 5 < 4 and k % 5 % 2 == seller]
        assert found[seller] == pytest.approx(sum(marks) / len(marks) if marks else 0, abs=0.0051)


@pytest.mark.parametrize("cuts", [[], [3, 4], [8, 16, 24]])
def test_stock_view_for_any_split(spark, tmp_path, cuts):
    rnd = random.Random(10)
    states = ["Pending", "Shipping", "Cancelled", "Returned", "Delivered", None]
    rows = [(rnd.randrange(10), rnd.choice(states), rnd.choice(states)) for _ in range(30)]
    lines = spark.createDataFrame([(o, v, 1 + o % 3) for o in range(9) for v in range(o % 4)], "order_id bigint, variant_id bigint, quantity int")
    held = spark.createDataFrame([(v, 5) for v in range(4)], "variant_id bigint, on_hand bigint")
    root = str(tmp_path)
    deliver(spark, f"{root}/in", rows, views.STATUS_CHANGE, cuts)
    views.run_returned_units(views.read_changes(spark, f"{root}/in", views.STATUS_CHANGE, 1), lines, f"{root}/out",
                             f"{root}/progress").awaitTermination()
    back = Counter()
    for order, old, new in rows:
        if new in ("Cancelled", "Returned") and old not in ("Cancelled", "Returned"):
            back.update({v: 1 + order % 3 for v in range(order % 4)} if order < 9 else {})
    assert {r["variant_id"]: (r["returned"], r["on_hand_after"]) for r in views.stock_view(spark, held, f"{root}/out").collect()} == {
        v: (back[v], 5 + back[v]) for v in range(4)}


def test_chained_deletes_against_one_by_one(spark):
    rnd = random.Random(12)
    sizes = {"a": 8, "b": 20, "c": 40, "d": 60}
    refs = [Reference("b", "a_id", "a", CASCADE), Reference("c", "b_id", "b", CASCADE), Reference("d", "c_id", "c", RESTRICT),
            Reference("d", "a_id", "a", SET_NULL), Reference("b", "up", "b", CASCADE)]
    rows = {"a": [(k,) for k in range(8)], "b": [(k, rnd.randrange(8), rnd.choice([None, rnd.randrange(20)])) for k in range(20)],
            "c": [(k, rnd.choice([None, rnd.randrange(20)])) for k in range(40)],
            "d": [(k, rnd.choice([None, None, None, rnd.randrange(12)]), rnd.randrange(8)) for k in range(60)]}
    columns = {"a": ["key"], "b": ["key", "a_id", "up"], "c": ["key", "b_id"], "d": ["key", "c_id", "a_id"]}
    tables = {n: spark.createDataFrame(rows[n], ", ".join(f"{c} bigint" for c in columns[n])) for n in sizes}
    roots = {"a": [0, 3, 5, 99], "b": [1, 2], "c": [39]}

    def children(reference, keys):
        at = columns[reference.child].index(reference.column)
        return {r[0] for r in rows[reference.child] if r[at] in keys and r[at] is not None}

    going, state = {n: set() for n in sizes}, {}
    for table, keys in roots.items():
        for key in keys:
            reach = {n: set() for n in sizes}
            reach[table].add(key)
            while True:
                before = {n: set(s) for n, s in reach.items()}
                for r in refs:
                    if r.action == CASCADE:
                        reach[r.child] |= children(r, reach[r.parent])
                if reach == before:
                    break
            stopped = any(children(r, reach[r.parent]) for r in refs if r.action == RESTRICT)
            state[table, key] = stopped
            if not stopped:
                for n in sizes:
                    going[n] |= reach[n]
    found = Deletion(tables, refs, {n: spark.createDataFrame([(k,) for k in ks], "key bigint") for n, ks in roots.items()})
    assert {r["root"] for r in found.blocked.collect()} == {f"{t}:{k}" for (t, k), stopped in state.items() if stopped}
    for n in sizes:
        gone = found.going(n)
        assert (set() if gone is None else {r["key"] for r in gone.collect()}) == going[n], n
        left = sorted(map(str, ((r[0], *[None if columns[n][i] == "a_id" and n == "d" and v in going["a"] else v
                                         for i, v in enumerate(r)][1:]) for r in rows[n] if r[0] not in going[n])))
        assert sorted(str(tuple(r)) for r in found.after(n).collect()) == left, n
    report = {(r["relation"], r["action"]): r["touched"] for r in found.report().collect()}
    assert report["d.a_id", SET_NULL] == len(children(refs[3], going["a"]))
    assert report["c.b_id", CASCADE] == len(children(refs[1], going["b"]))
    assert sum(n for (_, action), n in report.items() if action == "blocked") == sum(state.values())
    assert any(state.values()) and not all(state.values())


def test_latest_events_open_only_the_months_they_need(spark, tmp_path):
    from soukwise.plans import history
    from soukwise.sources import lake
    path = str(tmp_path / "lake")
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 40_000)
    rows = spark.range(400).select(
        F.col("id").alias("event_id"), F.when(F.col("id") < 395, at).alias("ts"), F.lit(1).alias("user_id"), F.lit("s").alias("session_id"),
        F.lit("page_view").alias("event_type"), F.lit(None).cast("bigint").alias("product_id"), F.lit("ios").alias("platform"),
        F.when(F.col("id") % 50 == 0, "live_ui").otherwise("mock").alias("source")).withColumn("event_month", F.date_format("ts", "yyyy-MM"))
    lake.write_by_month(rows, path)
    for limit, live, opened in ((5, False, 1), (150, False, 3), (2, True, 2), (10_000, False, 8)):
        found = history.recent_lake_events(spark, path, limit, live)
        assert [tuple(r) for r in found.collect()] == [tuple(r) for r in history.recent_events(rows, limit, live).collect()]
        months = {f.split("event_month=")[1].split("/")[0] for f in found.inputFiles()}
        assert len(months) == opened, (limit, months)
    with pytest.raises(FileNotFoundError):
        (tmp_path / "none").mkdir()
        history.recent_lake_events(spark, str(tmp_path / "none"))
