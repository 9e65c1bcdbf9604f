"""The operators as queries over whole tables, with the columns their contracts name."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from soukwise.llm import (alignment, bpe, decontam, langid, licenses, negatives, pii, quality, secret_scan, simhash, spots,
                          tokencount, toxicity)
from soukwise.llm.tables import held_out, read


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.selectExpr("id as doc_id", "lower(lpad(hex(fp), 16, '0')) as fingerprint",
                            "component as component_id")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.secrets(read(spark, sf_dir, "documents", "doc_id", "text")))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read(spark, sf_dir, "documents", "doc_id", "text"),
                                 read(spark, sf_dir, "benchmark", "item_id", "text"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return (bpe.digests(read(spark, sf_dir, "documents", "doc_id", "text"), vocabulary)
            .withColumnRenamed("id", "doc_id"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit(*toxicity.sample(docs, read(spark, sf_dir, "labels", "doc_id", "toxic")))
    return toxicity.score(docs, model).select(
        F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licences(read(spark, sf_dir, "documents", "doc_id", "text")).select(
        F.col("id").alias("doc_id"), F.array_join("sentences", ",").alias("sentences"),
        F.array_join("licences", ",").alias("licences"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return langid.identify(docs, ~held_out("doc_id")).select(
        F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "lang_pred", "score", "rejected")


def op8_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.fingerprints(read(spark, sf_dir, "documents", "doc_id", "text")).select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", F.array_join("signatures", "").alias("fingerprint"),
        F.array_join("edited_signatures", "").alias("edited_fingerprint"), "near_edited", "near_next")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokencount.Model.load(public_tokenizers.path("piece_bpe_32k.model"))
    counts = tokencount.token_counts(read(spark, sf_dir, "documents", "doc_id", "text"), model)
    return counts.selectExpr("id as doc_id", "n_bytes", "n_tokens", f"n_tokens > {tokencount.LIMIT} as over_limit")


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_data(read(spark, sf_dir, "documents", "doc_id", "text")))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.learn(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.score(docs, model).select(
        F.col("id").alias("doc_id"), quality.held_out("id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizers = alignment.Tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
                                      public_tokenizers.PATTERN)
    return (alignment.alignments(read(spark, sf_dir, "documents", "doc_id", "text"), tokenizers)
            .withColumnRenamed("id", "doc_id"))


QUERIES = {f.__name__: f for f in (
    op1_simhash_near_dedup, op2_secret_scan, op3_decontamination, op4_byte_bpe, op5_toxicity, op6_license_scan, op7_language_id, op8_spot_signatures, op9_token_counts, op10_personal_data,
    op11_quality, op12_hard_negatives, op13_alignment,
)}

ORACLES: dict[str, str] = {"op6_license_scan": licenses.oracle_sql(), "op12_hard_negatives": negatives.oracle_sql()}
