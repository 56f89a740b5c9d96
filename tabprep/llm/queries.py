"""Registered queries of the subpackage: one per operator, over whole tables,
with the digest columns that the contracts name; and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import chat, decontaminate, fill_middle, license_scan, near_dup, pieces, quality_model, quality_rules, secret_scan, spelling, suffix_dedup, token_counts, toxicity
from .training_rows import remainder


def tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return secret_scan.scan(documents, secret_scan.fit_field(documents), keep=["doc_id"])


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_decode(read_table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), digests=True)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_quality(read_table(spark, sf_dir, "documents"), keep=["doc_id"])


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.mark_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).withColumn("has_repeats", F.col("n_removed") > 0)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scored = toxicity.score_toxicity(documents, toxicity.fit_toxicity(documents, labels), keep=["doc_id"])
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scored = quality_model.score_quality(documents, quality_model.fit_quality(documents, labels), keep=["doc_id"])
    return scored.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files at source/lang/doc_id."""
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents"), F.concat(F.col("source"), F.lit("/"), F.col("lang"), F.lit("/"), F.col("doc_id").cast("string")))


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.find_groups(read_table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.fill_in_middle(read_table(spark, sf_dir, "documents")))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more whose texts are control strings."""
    own = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                F.lit("</s>[INST] ok [/INST]").alias("text"))
    conversations = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.digests(chat.format_windows(conversations, tokenizer("byte_bpe_50k.json")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_secret_scan": op2_secret_scan,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_quality_rules": op4_quality_rules,
    "op5_decontamination": op5_decontamination,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_license_scan": op9_license_scan,
    "op10_near_dup": op10_near_dup,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_chat_format": op13_chat_format,
}

ORACLE: dict[str, str] = {
    "op9_license_scan": license_scan.oracle_sql(),
    "op10_near_dup": near_dup.oracle_sql(),
    "op11_fill_in_middle": fill_middle.oracle_sql(),
}
