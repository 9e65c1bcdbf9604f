"""Documents, lake, exports and streams on small inputs."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from soukwise.plans import history, merges
from soukwise.sources import documents, lake, refresh
from soukwise.sources.documents import EVENT_DOCUMENT
from soukwise.sources.model import Marketplace
from soukwise.streaming import events as streams

DOCUMENTS = [
    {"event_id": "1", "session_id": "s1", "user_id": 5, "event_type": "product_view", "timestamp": "2024-01-31T23:59:59Z",
     "device": {"platform": "ios"}, "geo": {"province": "Hue"}, "traffic_source": {"channel": "ads"},
     "payload": {"product_id": 7, "dwell_seconds": 3}, "source": "mock"},
    {"event_id": "2", "session_id": "s2", "event_type": "purchase", "timestamp": "2024-02-01T00:00:00Z",
     "payload": {"product_ids": [7, 8], "revenue": 12.5, "payment_method": "COD"}},
    {"event_id": "3", "session_id": "s2", "user_id": None, "event_type": "search", "timestamp": "2024-02-01T00:00:01Z",
     "device": None, "payload": {"query": "cup", "filters_applied": ["red"], "product_id": None}, "odd": {"x": 1}},
    {"event_id": "4", "session_id": "s3", "user_id": 6, "event_type": "remove_from_cart",
     "timestamp": "2024-02-02T10:00:00Z", "source": "live_ui", "payload": {"variant_id": 3, "quantity": 2}},
    {"event_id": "5", "session_id": "s3", "user_id": 6, "event_type": "page_view", "timestamp": "2024-02-02T10:00:00Z",
     "payload": {"page": "/", "referrer": "x"}},
    {"event_id": "6", "session_id": "s3", "user_id": 6, "event_type": "checkout_start",
     "timestamp": "2024-02-02T10:00:00Z", "payload": {"cart_size": 2, "cart_value": 9.5}},
    {"event_id": "7", "session_id": "s3", "user_id": 6, "event_type": "add_to_cart",
     "timestamp": "2024-02-02T10:00:00Z", "payload": {"product_id": 8, "quantity": 1}},
]


def write_lines(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(r) for r in rows))
    return str(path)


def test_flattening(spark, tmp_path):
    docs = documents.read_events(spark, write_lines(tmp_path / "in", "a.json", DOCUMENTS))
    flat = {r["event_id"]: r for r in documents.events_flat(docs).collect()}
    assert len(flat) == 7
    assert (flat["1"]["platform"], flat["1"]["province"], flat["1"]["channel"], flat["1"]["product_id"]) == \
        ("ios", "Hue", "ads", 7)
    assert (flat["2"]["user_id"], flat["2"]["platform"], flat["2"]["product_id"], flat["2"]["source"]) == \
        (None, None, None, "mock")
    assert flat["2"]["revenue"] == 12.5 and flat["4"]["source"] == "live_ui" and flat["4"]["product_id"] is None
    assert [flat[i]["event_month"] for i in "123"] == ["2024-01", "2024-02", "2024-02"]
    bought = documents.purchased_products(docs).select("product_id").collect()
    assert sorted(r[0] for r in bought) == [7, 8]


def test_unknown_fields_survive_in_the_raw_column(spark, tmp_path):
    path = write_lines(tmp_path / "in", "a.json", DOCUMENTS)
    raw = documents.read_events(spark, path, keep_raw=True).where("event_id = '3'").first()
    assert json.loads(raw["_raw"])["odd"] == {"x": 1} and raw["payload"]["filters_applied"] == ["red"]


def test_scans_lose_the_operator(spark, tmp_path):
    path = write_lines(tmp_path / "in", "s.json", [
        {"scan_id": "a", "tracking_no": "T1", "order_id": 1, "station": "X", "operator": "Ann",
         "timestamp": "2024-01-01T00:00:00Z", "weight_kg": 1.5}])
    assert "operator" not in documents.read_scans(spark, path).columns


def test_month_folders_are_pruned_and_rewritten_alone(spark, tmp_path):
    path = str(tmp_path / "lake")
    docs = documents.read_events(spark, write_lines(tmp_path / "in", "a.json", DOCUMENTS))
    flat = documents.events_flat(docs)
    lake.write_by_month(flat, path)
    february = lake.read_by_month(spark, path, "2024-02", "2024-02")
    assert february.count() == 6
    assert dict(february.dtypes)["event_month"] == "string"
    plan = february._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in plan
    assert len(february.inputFiles()) == 2 and len({f for f in february.inputFiles() if "2024-02" in f}) == 1
    # A second load of one month replaces that month only.
    lake.write_by_month(flat.where("event_id = '2'"), path)
    assert sorted(r[0] for r in lake.read_by_month(spark, path).select("event_id").collect()) == ["1", "2"]
    ranged = history.events_by_type_range(
        lake.read_by_month(spark, path).withColumn("ts", F.col("timestamp").cast("timestamp_ntz")),
        "purchase", datetime(2024, 2, 1), datetime(2024, 2, 2))
    assert ranged.count() == 1


def test_csv_round_trip_with_types(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([(1, "a", 1.5, None), (-2, "b", 2.0, 3)], "i int, t string, d double, sparse int")
    lake.write_csv(df, path)
    back = lake.read_csv(spark, path)
    assert dict(back.dtypes) == {"i": "bigint", "t": "string", "d": "double", "sparse": "bigint"}
    assert sorted(map(tuple, back.collect())) == [(-2, "b", 2.0, 3), (1, "a", 1.5, None)]
    assert lake.read_csv(spark, path, limit=1, order_by=["i"]).first()["i"] == -2


def test_inventory_and_listing(spark, tmp_path):
    path = str(tmp_path / "t")
    lake.write_table(spark.range(10).repartition(2), path)
    row = lake.dataset_inventory({"t": spark.read.parquet(path)}).first()
    assert (row["files"], row["row_count"]) == (2, 10) and row["bytes"] > 0
    names = [r["type"] for r in lake.list_folder(spark, str(tmp_path)).collect()]
    assert names[0] == "DIRECTORY"


def test_raw_zone(spark, tmp_path, data):
    m = Marketplace(spark, data)
    lake.write_raw_zone({"dim_customer": m.customers()}, m.clickstream(), str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "raw/dim_customer")).count() == m.customers().count()


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path, data):
    m = Marketplace(spark, data)
    lake.write_bucketed(m.bare_lines(), "b_lines", str(tmp_path / "lines"), "order_id", 4)
    lake.write_bucketed(m.orders(), "b_orders", str(tmp_path / "orders"), "order_id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("b_lines").join(spark.table("b_orders"), "order_id").groupBy("order_id").count()
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == m.bare_lines().select("order_id").distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ----------------------------------------------------------------- streaming
def test_ingest_fills_defaults_and_stores_a_repeated_event_once(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "lake")
    write_lines(folder, "a.json", DOCUMENTS[3:])
    progress = str(tmp_path / "progress")
    streams.ingest(spark, str(folder), out, progress).awaitTermination()
    write_lines(folder, "b.json", DOCUMENTS[3:5] + [
        {"event_id": "8", "session_id": "s", "event_type": "search", "timestamp": "2024-02-02T10:01:00Z"}])
    streams.ingest(spark, str(folder), out, progress).awaitTermination()
    rows = {r["event_id"]: r for r in lake.read_by_month(spark, out).collect()}
    assert sorted(rows) == ["4", "5", "6", "7", "8"] and lake.read_by_month(spark, out).count() == 5
    assert (rows["8"]["platform"], rows["8"]["province"], rows["8"]["channel"], rows["8"]["source"]) == \
        ("desktop_web", "Ha Noi", "direct", "live_ui")


def test_missing_time_is_the_time_of_arrival(spark):
    docs = spark.createDataFrame([("1", None)], "event_id string, timestamp timestamp")
    for name, kind in (("device", "struct<platform:string,os_version:string,app_version:string>"),
                       ("geo", "struct<country:string,province:string>"),
                       ("traffic_source", "struct<channel:string,campaign:string>"), ("source", "string")):
        docs = docs.withColumn(name, F.lit(None).cast(kind))
    assert streams.with_defaults(docs).first()["timestamp"] is not None


EVENT = "event_id bigint, ts timestamp, event_type string, platform string"


def write_events(spark, folder, rows):
    spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(folder)


@pytest.mark.parametrize("lateness", [None, "10 minutes"])
def test_hourly_counts_hold_late_rows_unless_told_otherwise(spark, tmp_path, lateness):
    folder, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def run():
        stream = spark.readStream.schema(EVENT).parquet(folder)
        streams.run_hourly(stream, out, progress, lateness).awaitTermination()
        return {(r["hour_start"].hour, r["platform"]): r["events"] for r in
                streams.latest(spark, out, ["hour_start", "platform"], "events").collect()}

    day = (2024, 1, 1)
    write_events(spark, folder, [(1, datetime(*day, 8, 5), "v", "ios"), (2, datetime(*day, 8, 50), "v", "ios"),
                                 (3, datetime(*day, 12, 0), "v", "web")])
    assert run() == {(8, "ios"): 2, (12, "web"): 1}
    # 08:55 is hours late, 11:55 only five minutes.
    write_events(spark, folder, [(4, datetime(*day, 8, 55), "v", "ios"), (5, datetime(*day, 11, 55), "v", "web")])
    assert run() == {(8, "ios"): 2 if lateness else 3, (11, "web"): 1, (12, "web"): 1}


def test_ingest_stores_late_events(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "lake")
    for k, day in enumerate((20, 19, 1)):
        write_lines(folder, f"{k}.json", [{"event_id": f"{k}-{i}", "event_type": "search",
                                           "timestamp": f"2024-02-{day:02d}T10:0{i}:00Z"} for i in range(5)])
    streams.ingest(spark, str(folder), out, str(tmp_path / "progress"), files_per_batch=1).awaitTermination()
    assert lake.read_by_month(spark, out).count() == 15


def test_live_events_without_an_id_are_kept_apart(spark, tmp_path):
    folder, out, progress = tmp_path / "in", str(tmp_path / "lake"), str(tmp_path / "progress")
    live = {"session_id": "s", "event_type": "search", "device": {}, "geo": {}, "traffic_source": {},
            "timestamp": "2024-02-02T10:01:00Z"}
    write_lines(folder, "a.json", [live] * 5)
    streams.ingest(spark, str(folder), out, progress).awaitTermination()
    rows = lake.read_by_month(spark, out).collect()
    assert len({r["event_id"] for r in rows}) == len(rows) == 5
    assert {(r["platform"], r["province"], r["channel"], r["source"]) for r in rows} == {
        ("desktop_web", "Ha Noi", "direct", "live_ui")}


def test_reading_back_odd_numbers(spark, tmp_path):
    path = str(tmp_path / "csv")
    lake.write_csv(spark.createDataFrame([("--5", "12345678901234567890", "7"), ("4", "1", "-8")], "a string, b string, c string"), path)
    kinds = dict(lake.read_csv(spark, path).dtypes)
    assert kinds == {"a": "string", "b": "double", "c": "bigint"}


def test_running_counts_over_several_batches(spark, tmp_path):
    folder, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for part in ([(1, datetime(2024, 1, 1), "view", "x")], [(2, datetime(2024, 1, 1), "view", "x"),
                                                           (3, datetime(2024, 1, 1), "buy", "x")]):
        write_events(spark, folder, part)
        stream = spark.readStream.schema(EVENT).parquet(folder)
        streams.run_event_stats(stream, out, progress).awaitTermination()
    got = {r["event_type"]: r["events"] for r in streams.latest(spark, out, ["event_type"], "events").collect()}
    assert got == {"view": 2, "buy": 1}


def test_own_ids_do_not_depend_on_how_a_batch_is_cut(spark, tmp_path):
    live = {"session_id": "s", "event_type": "search", "timestamp": "2024-02-02T10:01:00Z"}
    lines = [live] * 9000 + [{**live, "user_id": k % 7} for k in range(50)] + [{**live, "event_id": "e"}] * 3 + [{"session_id": "t"}]
    for name in ("a.json", "b.json"):
        write_lines(tmp_path / "in", name, lines)
    documents = spark.read.schema(EVENT_DOCUMENT).json(str(tmp_path / "in")).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_modification_time").alias("_arrived"))
    whole = sorted(r["event_id"] for r in streams.with_ids(documents.coalesce(1)).collect())
    parts = sorted(r["event_id"] for r in streams.with_ids(documents.repartition(13)).collect())
    assert whole == parts and len(whole) == 2 * len(lines)
    assert len(set(whole)) == 2 * (len(lines) - 3) + 1
    assert streams.with_ids(documents).where("timestamp is null").isEmpty()


def test_a_batch_repeated_with_other_splits_stores_nothing_twice(spark, tmp_path):
    live = {"session_id": "s", "event_type": "search", "timestamp": "2024-02-02T10:01:00Z"}
    for name in ("a.json", "b.json"):
        write_lines(tmp_path / "in", name, [live] * 40 + [{**live, "user_id": k} for k in range(40)] + [{"session_id": "late"}])
    out, before = str(tmp_path / "lake"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for run, (split, files) in enumerate((("128m", 100), ("500b", 1))):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            streams.ingest(spark, str(tmp_path / "in"), out, str(tmp_path / f"progress{run}"), files).awaitTermination()
            assert lake.read_by_month(spark, out).count() == 162
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def month_rows(spark, rows):
    return spark.createDataFrame(rows, "event_month string, event_type string, platform string, session_id string")


def test_refresh_computes_changed_months_only(spark, tmp_path):
    raw, curated = str(tmp_path / "raw"), str(tmp_path / "curated")
    rows = [(month, kind, "ios", f"s{k % 3}") for month in ("2024-01", "2024-02", "2024-03", None) for kind in "ab" for k in range(5)]
    seen = []

    def build(df):
        seen.append(sorted(str(r[0]) for r in df.select("event_month").distinct().collect()))
        return merges.monthly_activity(df.where("event_type <> 'none'"))

    def check(every):
        got = sorted(map(str, refresh.read_curated(spark, curated).select("event_month", "event_type", "platform", "events", "sessions").collect()))
        assert got == sorted(map(str, merges.monthly_activity(month_rows(spark, every).where("event_type <> 'none'")).collect()))

    lake.write_by_month(month_rows(spark, rows), raw)
    assert len(refresh.refresh(spark, raw, curated, build)) == 4
    check(rows)
    assert refresh.refresh(spark, raw, curated, build) == [] and len(seen) == 1
    # The same rows in other files.
    lake.write_by_month(month_rows(spark, rows[::-1]).repartition(3), raw)
    assert refresh.refresh(spark, raw, curated, build) == [] and len(seen) == 1
    # A repeated row counts; the month without a name is a month.
    more = [*rows, rows[10], (None, "c", "ios", "s")]
    lake.write_by_month(month_rows(spark, [r for r in more if r[0] in ("2024-02", None)]), raw)
    kept = {p: p.stat().st_mtime_ns for p in (tmp_path / "curated" / "event_month=2024-01").iterdir()}
    assert refresh.refresh(spark, raw, curated, build) == ["2024-02", refresh.MISSING] and seen[-1] == ["2024-02", "None"]
    assert kept == {p: p.stat().st_mtime_ns for p in (tmp_path / "curated" / "event_month=2024-01").iterdir()}
    check(more)
    # A month that is gone, one of which nothing is left, and one that is new.
    lake.remove(spark, f"{raw}/event_month=2024-01")
    last = [r for r in more if r[0] in ("2024-02", None)] + [("2024-03", "none", "ios", "s"), ("2024-04", "a", "ios", "s")]
    lake.write_by_month(month_rows(spark, last[-2:]), raw)
    assert refresh.refresh(spark, raw, curated, build) == ["2024-01", "2024-03", "2024-04"]
    check(last)


def test_refresh_that_stopped_before_its_manifest_is_done_again(spark, tmp_path):
    raw, curated, manifest = (str(tmp_path / n) for n in ("raw", "curated", "manifest"))
    rows = [("2024-01", "a", "ios", "s"), ("2024-02", "a", "ios", "s")]
    lake.write_by_month(month_rows(spark, rows), raw)
    refresh.refresh(spark, raw, curated, merges.monthly_activity, manifest)
    lake.remove(spark, manifest)
    assert refresh.refresh(spark, raw, curated, merges.monthly_activity, manifest) == ["2024-01", "2024-02"]
    assert refresh.read_curated(spark, curated).count() == 2


@pytest.mark.parametrize("hot_rows", [4, 10 ** 9])
@pytest.mark.parametrize("size", [1, 3, 1000])
def test_nested_replay_joins_to_the_numbered_one(spark, hot_rows, size):
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64("id"), F.lit(9)) * 60)
    events = spark.range(60).select(
        F.col("id").alias("event_id"), at.alias("ts"), F.lit(1).alias("user_id"),
        F.expr("case when id % 3 = 0 then 'hot' when id % 3 = 1 then concat('s', id % 7) end").alias("session_id"),
        F.lit("search").alias("event_type"), F.lit(None).cast("bigint").alias("product_id"), F.lit("ios").alias("platform"),
        F.lit("mock").alias("source"))
    chunks = history.session_chunks(events, size, hot_rows).collect()
    assert all(r["n"] == len(r["events"]) <= size and r["first_seq"] == r["chunk"] * size + 1 for r in chunks)
    opened = [(r["session_id"], e["seq"], e["event_id"]) for r in sorted(chunks, key=lambda r: (r["session_id"] or "", r["chunk"])) for e in r["events"]]
    flat = [(r["session_id"], r["seq"], r["event_id"]) for r in history.session_replay(events, hot_rows=hot_rows).collect()]
    assert opened == sorted(flat, key=lambda r: (r[0] or "", r[1]))
    with pytest.raises(ValueError):
        history.session_chunks(events, 0)
