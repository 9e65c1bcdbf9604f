"""Every operator and stage over nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

from collections import Counter

import pytest

import corpus_pipeline
from tests.llm import odd


@pytest.mark.parametrize("name", sorted(odd.EACH))
def test_a_row_for_each_row(spark, name):
    found = odd.EACH[name](odd.frame(spark)).collect()
    assert Counter(r["id"] for r in found) == Counter(r[0] for r in odd.rows())
    same = [tuple(r)[1:] for r in found if r["id"] in (5, 6)]
    if name != "spots":
        assert len(set(map(str, same))) == 1
    nameless = [tuple(r)[1:] for r in found if r["id"] is None]
    assert len(nameless) == 3


@pytest.mark.parametrize("name", sorted(odd.EACH))
def test_an_empty_table(spark, name):
    assert odd.EACH[name](odd.frame(spark, [])).collect() == []


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd"))
    odd.frame(spark).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(5, 0), (9, 1), (None, 1), (9, 0), (77, None)], "doc_id bigint, toxic int").write.parquet(
        f"{path}/labels.parquet")
    spark.createDataFrame([(1, "the cat sat on the mat"), (2, None), (None, "x"), (3, ""), (3, "a b")],
                          "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_keep_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        if name != "encoding":
            assert docs.columns == columns, name
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert docs.count() > 0


def test_stages_on_an_empty_table(spark, folder):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.frame(spark, []), folder).collect() == [], name


def test_near_copies_of_odd_rows(spark, folder):
    kept = corpus_pipeline.drop_near_copies(spark, odd.frame(spark), folder).collect()
    # Texts without a word are copies of each other, so are the repeated sentence's rows.
    assert Counter(r["doc_id"] for r in kept) == Counter([0, 4, 5, 7, 8, 9, 10, 11, None])


def test_decontamination_of_odd_rows(spark, folder):
    kept = corpus_pipeline.drop_benchmark(spark, odd.frame(spark), folder).collect()
    # Rows 5 and 6 hold the first item, row 10 the words "a b" of the short one, which has to occur as it is.
    assert {5, 6, 10} & {r["doc_id"] for r in kept} == set()
    assert len(kept) == len(odd.rows()) - 4


def test_masked_text_and_size(spark, folder):
    from pyspark.sql import functions as F
    docs = odd.frame(spark).withColumn("n_chars", F.length("text"))
    found = {r["doc_id"]: r for r in corpus_pipeline.mask_personal_data(spark, docs, folder).collect()}
    assert found[10]["text"] == "mail me: [EMAIL] or [PHONE]"
    assert found[10]["n_chars"] == len(found[10]["text"])
    assert found[0]["text"] is None and found[5]["text"] == odd.TEXTS[5]
    assert found[7]["text"].count("[IP]") == 3000
