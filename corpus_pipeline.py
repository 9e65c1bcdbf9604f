"""A corpus made ready for training, stage by stage; each stage is written and read by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from soukwise.llm import bpe, decontam, neardup, pii, toxicity
from soukwise.llm.tables import read
from soukwise.session import new_folder, settle, ship_code


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier of the labelled rows does not reject."""
    model = toxicity.fit(*toxicity.sample(read(spark, sf_dir, "documents", "doc_id", "text"),
                                          read(spark, sf_dir, "labels", "doc_id", "toxic")))
    return toxicity.without_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies, the one with the smallest id."""
    ship_code(settle(spark))
    return neardup.without_near_copies(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.without_items(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and ``n_chars`` to match."""
    settle(spark)
    return pii.without_personal_data(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of the ids and of what they decode to."""
    ship_code(settle(spark))
    vocabulary = bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.digests(docs, vocabulary).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("near-dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("personal data", mask_personal_data),
    ("encoding", encode),
]

#: SQL cannot express the trained stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of a folder."""
    docs = read(spark, sf_dir, "documents", "*")
    for name, stage in STAGES:
        path = new_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
