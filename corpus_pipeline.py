"""A training corpus from ``documents``, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps,
with the columns of ``documents``; the last returns packed pieces. Between
stages the rows are written as Parquet to the shared checkpoint folder and read
again, so a lost executor never brings back an earlier stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwise.llm import best_fit_packing, decontamination, language_id, ngram_jaccard, substring_dedup
from barwise.llm.common import table
from barwise.session import checkpoint_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language the network tells; texts that are null or
    have no letter are rejected. Labels come from the input's own rows; without
    any, all texts with a letter stay."""
    return language_id.keep_known(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return ngram_jaccard.keep_one(docs)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that a document with a smaller id has; a document that
    loses all its words goes."""
    out = substring_dedup.remove(docs)
    return out.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents contaminated by benchmark items."""
    return decontamination.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' token ids into sequences."""
    return best_fit_packing.pack(docs, "word_bpe_49k.json")


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard", drop_near_copies),
    ("substring_dedup", cut_passages),
    ("decontamination", decontaminate),
    ("best_fit_packing", pack),
]

#: SQL can't express the first and the last stage; tests hold run() against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
