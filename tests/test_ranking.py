import random

import pytest
from pyspark.sql import functions as F

from soukwise.operators.percentile import percentile_hundredths
from soukwise.operators.ranking import _tile_ends, global_ranks, ntiles, pct_ranks
from soukwise.operators.skew import hot_keys, running_sums


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id bigint, v bigint")


SAMPLES = {
    "distinct": random.Random(1).sample(range(10_000), 500),
    "one value": [7] * 300,
    "a third is one value": [5] * 200 + random.Random(2).choices(range(100), k=400),
    "few values": random.Random(3).choices([1, 2, 3], k=500),
    "negative": random.Random(4).choices(range(-50, 50), k=300),
    "single row": [3],
}


@pytest.mark.parametrize("name", SAMPLES)
@pytest.mark.parametrize("descending", [False, True])
def test_global_ranks(spark, name, descending):
    values = SAMPLES[name]
    rows = {r["id"]: r for r in global_ranks(frame(spark, values), "v", "id", descending, buckets=8).collect()}
    assert len(rows) == len(values)
    sign = -1 if descending else 1
    order = sorted(range(len(values)), key=lambda i: (sign * values[i], i))
    for place, i in enumerate(order, 1):
        rank = 1 + sum(sign * v < sign * values[i] for v in values)
        ties = values.count(values[i])
        assert rows[i]["row_number"] == place
        assert rows[i]["rank"] == rank
        assert rows[i]["pct_rank"] == pytest.approx((rank + (ties - 1) / 2) / len(values))


def test_percent_ranks_by_several_keys_at_once(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice([1, 1, 1, 2, 7, i]), 5 if rnd.random() < 0.4 else rnd.randrange(90)) for i in range(500)]
    df = spark.createDataFrame(rows, "id bigint, v bigint, w bigint")
    got = {r["id"]: r for r in pct_ranks(df, {"v_pct": "v", "w_pct": "w", "again": "v"}, "id", buckets=8).collect()}
    assert len(got) == 500 and set(df.columns) | {"v_pct", "w_pct", "again"} == set(next(iter(got.values())).asDict())
    for at, name in ((1, "v_pct"), (2, "w_pct"), (1, "again")):
        values = [r[at] for r in rows]
        for i, v in enumerate(values):
            rank = 1 + sum(x < v for x in values)
            assert got[i][name] == pytest.approx((rank + (values.count(v) - 1) / 2) / 500)
    assert pct_ranks(df.where("false"), {"v_pct": "v"}, "id").count() == 0


@pytest.mark.parametrize("name,tiles", [*((n, 5) for n in SAMPLES), ("distinct", 7)])
def test_ntiles(spark, name, tiles):
    values = SAMPLES[name]
    got = {r["id"]: (r["up"], r["down"]) for r in ntiles(
        frame(spark, values), tiles, {"up": ("v", False), "down": ("v", True)}, "id", buckets=8).collect()}
    for column, sign in ((0, 1), (1, -1)):
        order = sorted(range(len(values)), key=lambda i: (sign * values[i], i))
        size, extra = divmod(len(values), tiles)
        expected = [t + 1 for t in range(tiles) for _ in range(size + (t < extra))]
        assert [got[i][column] for i in order] == expected


def test_tile_ends():
    assert _tile_ends(12, 5) == [3, 6, 8, 10]
    assert _tile_ends(2, 5) == [1, 2, 2, 2]


def test_large_keys_are_ranked(spark):
    big = spark.createDataFrame([(1, 2 ** 60), (2, 5)], "id bigint, v bigint")
    assert {r["id"]: r["rank"] for r in global_ranks(big, "v", "id").collect()} == {1: 2, 2: 1}


def test_no_window_over_the_whole_table(spark):
    plan = global_ranks(frame(spark, SAMPLES["distinct"]), "v", "id", buckets=8)._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("percent", [0, 50, 95, 100])
def test_percentile(spark, percent):
    rng = random.Random(percent)
    groups = {"a": rng.choices(range(1000), k=101), "b": [4], "c": [7] * 50 + [9], "d": rng.choices(range(5), k=60)}
    rows = [(g, v, 1) for g, vs in groups.items() for v in vs] + [("a", None, 1)]
    df = spark.createDataFrame(rows, "g string, v bigint, n bigint")
    got = {r["g"]: r["hundredths"] for r in percentile_hundredths(df, "g", "v", "n", percent, width=10).collect()}
    for g, vs in groups.items():
        vs = sorted(vs)
        low, part = divmod(percent * (len(vs) - 1), 100)
        high = vs[min(low + 1, len(vs) - 1)]
        assert got[g] == vs[low] * 100 + (high - vs[low]) * part


@pytest.mark.parametrize("floor", [1, 50, 10 ** 6])
def test_running_sums_over_hot_groups(spark, floor):
    rng = random.Random(9)
    rows = [(1 if i % 3 else i % 7, i, rng.randint(1, 9)) for i in range(400)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g bigint, i bigint, q bigint")
    hot = hot_keys(df, "g", "i", floor, 16)
    assert (hot is not None and 1 in {r["_hot"] for r in hot.collect()}) == (floor <= 50)
    got = {(r["g"], r["i"]): r["s"] for r in running_sums(df, "g", "i", {"q": "s"}, hot).collect()}
    sums = {}
    for g, i, q in sorted(rows, key=lambda r: r[1]):
        sums[g] = sums.get(g, 0) + q
        assert got[g, i] == sums[g]


@pytest.mark.parametrize("floor", [1, 10])
def test_rows_without_a_key_are_a_group(spark, floor):
    df = spark.createDataFrame([(None, 1, 2), (1, 2, 3), (None, 3, 4)], "g bigint, i bigint, q bigint")
    got = running_sums(df, "g", "i", {"q": "s"}, hot_keys(df, "g", "i", floor)).select(F.sum("s"), F.count("*")).first()
    assert tuple(got) == (2 + 3 + 6, 3)


def test_a_hot_key_is_cut_by_its_own_rows(spark):
    # Key 1 and the rows without a key lie in a short stretch of a long axis.
    rows = [(None if i % 2 else 1, 10 ** 9 + i) for i in range(2000)] + [(2 + i, i * 10 ** 7) for i in range(1000)]
    df = spark.createDataFrame(rows, "g bigint, at bigint").withColumn("one", F.lit(1))
    hot = hot_keys(df, "g", "at", 500, 16)
    assert {r["_hot"] for r in hot.collect()} == {None, 1}
    pieces = (df.join(hot, F.col("g").eqNullSafe(F.col("_hot")))
              .groupBy("g", F.expr("size(filter(_points, p -> p < at))").alias("piece")).count().collect())
    assert max(r["count"] for r in pieces) < 200
    assert df.count() == running_sums(df, "g", "at", {"one": "n"}, hot).where("n > 0").count()


def test_more_hot_keys_than_any_list(spark):
    df = spark.range(12_000).selectExpr("id % 6000 as g", "id as i", "1 as one")
    hot = hot_keys(df, "g", "i", 2, 2)
    assert hot.count() == 6000
    assert running_sums(df, "g", "i", {"one": "n"}, hot).where("n = 2").count() == 6000


def test_ranks_of_numbers_that_doubles_merge(spark):
    rows = [(i, 2 ** 60 + i % 40) for i in range(2000)]
    df = spark.createDataFrame(rows, "i bigint, v bigint")
    got = {r["i"]: (r["rank"], r["row_number"]) for r in global_ranks(df, "v", "i", buckets=8).collect()}
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    first = {}
    for place, (i, v) in enumerate(order, 1):
        first.setdefault(v, place)
        assert got[i] == (first[v], place)
