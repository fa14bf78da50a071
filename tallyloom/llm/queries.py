"""The operators as registered queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import (
    collocations, decontaminate, html_render, language_id, license_scan, minhash_dedup, packing, rule_ensemble, secret_scan,
    source_divergence, sql, suffix_dedup, topk_search, warc,
)
from tallyloom.llm.common import tokenizer_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def archives(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived_and_read(table(spark, folder, "pages")).drop("url")


def searched(spark: SparkSession, folder: str) -> DataFrame:
    """Every document whose id is divisible by 100 is a query."""
    documents = table(spark, folder, "documents")
    queries = documents.where("doc_id % 100 = 0").select(documents["doc_id"].alias("query_id"), "text")
    return topk_search.search(documents, queries)


def passages(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.dedup_passages(table(spark, folder, "documents"))


def rendered(spark: SparkSession, folder: str) -> DataFrame:
    return html_render.render_pages(table(spark, folder, "pages"))


def quality(spark: SparkSession, folder: str) -> DataFrame:
    return rule_ensemble.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def near(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, folder, "documents"))


def secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, folder, "documents"))


def languages(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify_languages(table(spark, folder, "documents"))


def packed(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_path())


def licenses(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, folder, "documents"))


def divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence.source_divergence(table(spark, folder, "documents"))


def phrases(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc": archives,
        "op2_topk_search": searched,
        "op3_suffix_dedup": passages,
        "op4_html_render": rendered,
        "op5_rule_ensemble": quality,
        "op6_decontamination": leaks,
        "op7_near_dedup": near,
        "op8_secret_scan": secrets,
        "op9_language_id": languages,
        "op10_packing": packed,
        "op11_license_scan": licenses,
        "op12_source_divergence": divergence,
        "op13_collocations": phrases,
    }


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLES)
