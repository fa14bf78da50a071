"""A cleaning pipeline for a text corpus: five stages over ``documents``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import decontaminate, language_id, minhash_dedup, packing, secret_scan
from tallyloom.llm.common import tokenizer_path
from tallyloom.settings import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
SURE = 0.5
BATCH_ROWS = 1000


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those no language takes with at least one half."""
    model = language_id.fit_language_model(language_id.training_rows(docs))
    named = language_id.predict_languages(docs, model)
    known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= SURE)
    return named.where(known).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id. Whole texts go
    through Python here, so batches are kept small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    found = minhash_dedup.near_duplicates(docs).where(~F.col("kept")).select(
        F.col("doc_id").alias("gone"))
    return docs.join(found, docs["doc_id"] == found["gone"], "left_anti")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; every document stays."""
    return secret_scan.mask_secrets(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in the training sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_known_languages),
    ("near_dedup", keep_one_of_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("secret_scan", mask_secrets),
    ("packing", pack_sequences),
]

# Neither a trained classifier nor tokenization can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
