"""Very long texts: many known sentences, many spans, and runs that a pattern could try again and again."""

import random
import time

import pytest

from soukwise.llm import licenses, pii, secret_scan

GRANT, NOTICE = licenses.SENTENCES["mit-grant"], licenses.SENTENCES["mit-notice"]


def one(spark, text):
    return spark.createDataFrame([(1, text)], "doc_id bigint, text string")


@pytest.mark.parametrize("text,named", [
    # The rule covers what lies between its sentences.
    (f"{GRANT}.\n" + "All rights reserved.\n" * 20_000 + f"{NOTICE}.", ["MIT"]),
    (f"{NOTICE}.\n" + f"{GRANT}.\n" * 20_000, []),
    (f"{GRANT}.\n{NOTICE}.\n" * 5000 + f"{GRANT}.\n" * 5000, ["MIT"])])
def test_many_known_sentences(spark, text, named):
    assert licenses.licences(one(spark, text)).first()["licences"] == named


def test_a_rule_covers_what_a_plain_pattern_covers(spark):
    rnd = random.Random(1)
    ids = ["mit-grant", "mit-notice", "bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "reserved"]
    rows = [("".join(f" {x} " for x in rnd.choices(ids, k=rnd.randrange(0, 12))),) for _ in range(400)]
    frame = spark.createDataFrame(rows, "at string")
    import re
    for rule in ("mit-grant mit-notice", "bsd-grant bsd-source bsd-binary bsd-endorse", "bsd-source+bsd-binary reserved", "reserved"):
        found = frame.select("at", licenses.without_rule("at", rule).alias("left")).collect()
        assert all(r["left"] == re.sub(licenses.rule_pattern(rule), "", r["at"]) for r in found)


def test_a_long_run_is_read_once(spark):
    started = time.monotonic()
    assert pii.personal_data(one(spark, "a1-" * 350_000)).first()["spans"] == []
    assert time.monotonic() - started < 60


def test_many_names_and_hashes(spark):
    names = pii.personal_data(one(spark, "mail a@b.com name: Dr. Anna Smith, " * 20_000)).first()
    assert len(names["base"]) == 20_000 and len(names["spans"]) == 40_000
    rnd = random.Random(2)
    hashes = secret_scan.secrets(one(spark, " ".join(f"{rnd.getrandbits(128):032x}" for _ in range(20_000)))).first()
    assert len(hashes["base"]) >= 19_999


def test_spans_in_blocks_are_those_of_all_pairs(spark):
    from pyspark.sql import functions as F

    from soukwise.llm import spans
    rnd = random.Random(3)
    kind = "array<struct<start: bigint, end: bigint>>"

    def some(n):
        return sorted((s, s + rnd.randrange(1, 30)) for s in (rnd.randrange(4000) for _ in range(n)))
    rows = [(some(n), some(m)) for n, m in ((0, 5), (5, 0), (300, 700), (600, 20), (1, 1))]
    frame = spark.createDataFrame(rows, f"a {kind}, b {kind}").select(
        "a", "b", spans.in_blocks(F.col("b")).alias("cut"), spans.in_blocks(F.col("a")).alias("own"))
    found = frame.select("a", "b", spans.apart_from(F.col("a"), "cut").alias("x"), spans.not_within_earlier(F.col("a"), "own").alias("y")).collect()
    for r in found:
        assert r["x"] == [s for s in r["a"] if not any(o["start"] < s["end"] and s["start"] < o["end"] for o in r["b"])]
        assert r["y"] == [s for s in r["a"] if not any(o["start"] < s["start"] < o["end"] for o in r["a"])]
