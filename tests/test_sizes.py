"""What one task gets does not grow with the input."""

import glob

import pytest

from soukwise.plans import registry
from soukwise.session import PART_BYTES, deal
from soukwise.sources import lake

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@pytest.fixture
def usual(spark):
    yield spark
    spark.conf.unset(INITIAL)


def test_larger_inputs_are_dealt_into_more_parts(usual):
    counted = usual.range(2_000_000).selectExpr("xxhash64(id) as key").groupBy("key").count()
    deal(usual, 1000)
    assert usual.conf.get(INITIAL, None) is None and counted.rdd.getNumPartitions() == 4
    deal(usual, 50 * PART_BYTES)
    assert usual.conf.get(INITIAL) == "50"
    # The shuffle has about 25 MB, and Spark leaves a part to each of the eight cores.
    assert counted.selectExpr("*").rdd.getNumPartitions() >= 7


def test_parts_are_not_taken_back(usual):
    deal(usual, 50 * PART_BYTES)
    deal(usual, 10 * PART_BYTES)
    assert usual.conf.get(INITIAL) == "50"


def test_a_query_deals_by_the_size_of_its_tables(usual, tmp_path, monkeypatch):
    for name, schema in registry.SCHEMAS.items():
        usual.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    size = sum(lake.size_of(usual, f"{tmp_path}/{name}.parquet") for name in registry.SCHEMAS)
    assert size > 0 and lake.size_of(usual, f"{tmp_path}/none.parquet") == 0
    monkeypatch.setattr("soukwise.session.PART_BYTES", size // 20)
    assert registry.QUERIES["low_rating_rate"](usual, str(tmp_path)).count() == 0
    assert usual.conf.get(INITIAL) == str(-(-size // (size // 20)))


def test_months_keep_large_files(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    with lake.part_size(spark, lake.FILE_BYTES):
        assert spark.conf.get(key) == "64m"
    assert spark.conf.get(key) == before == "8m"


def test_a_delivery_is_written_by_many_tasks_and_is_one_batch(spark, tmp_path):
    files, batches = [], {}

    def follow(source):
        files.append(len(glob.glob(f"{source.removeprefix('file:')}/part-*")))
        stream = registry.views.read_changes(spark, source, "number bigint", None)
        return stream.writeStream.foreachBatch(lambda rows, n: batches.update({n: (rows.count(), rows.agg({"number": "max"}).first()[0])})).option(
            "checkpointLocation", f"{tmp_path}/progress").trigger(availableNow=True).start()

    registry._deliver(spark.range(3000).withColumnRenamed("id", "number").repartition(6), "number", "parquet", follow)
    assert len(files) == 3 and files[0] > 1 and files[2] - files[1] > 1
    assert sorted(batches) == [0, 1, 2] and sum(n for n, _ in batches.values()) == 3000
    assert batches[0][1] < batches[1][1] < batches[2][1] == 2999
