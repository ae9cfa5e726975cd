"""Registered queries of the corpus operators.

Each applies its operator, with production parameters, to its whole table and
derives the digest columns from what the operator returns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ball_tree_search, best_fit_packing, conversation_repair, decontamination, embedding_near_dedup, language_id, license_scan,
               ngram_jaccard, one_bit_search, quality_classifier, substring_dedup, suffix_array_dedup, token_counts)
from .common import held_out_remainder, table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = best_fit_packing.pack(table(spark, sf_dir, "documents"), "word_bpe_49k.json")
    return out.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = language_id.fit(docs)
    return (language_id.identify(docs.select("doc_id", "text"), network)
            .select("doc_id", (held_out_remainder(3) == 1).alias("held_out"), "lang_pred", "score"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "paragraph", "family", "score", "overlap", "confirmed")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), "byte_bpe_50k.json")


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_dedup.links(table(spark, sf_dir, "embeddings"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.join(table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.score(docs, model).select(
        "doc_id", (held_out_remainder(4) == 2).alias("held_out"), "score", "predicted")


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array_dedup.digests(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op11_ball_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_one_bit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_bit_search.neighbours(table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {"op4_substring_dedup": substring_dedup.ORACLE, "op7_decontamination": decontamination.ORACLE, "op8_ngram_jaccard": ngram_jaccard.ORACLE,
            "op11_ball_tree_search": ball_tree_search.ORACLE, "op13_conversation_repair": conversation_repair.ORACLE}
