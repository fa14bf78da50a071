"""Every operator as a query over the test tables."""

from __future__ import annotations

import contextlib
import datetime as dt
import hashlib
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.functions.scoring import NEUTRAL, lexicon_scorer
from tallyloom.functions.text import clean_text, preview
from tallyloom.operators import articles as art
from tallyloom.operators import keywords, quality, ratings as rat, sentiment, similarity as sim
from tallyloom.plans.fixtures import INGESTED_AT, NEGATIVE, POSITIVE, RUN_AT, TICKERS, Tables, hash_score
from tallyloom.plans import reports
from tallyloom.settings import scratch_path, written_table
from tallyloom.sources import delimited, results, store

TARGET = "Supplier#000000001"  # supplier 1, an item of every test scale
FIXTURE_SIMILARITY = {"min_common": 10, "threshold": 0.05, "digits": 9}


def written_as_text(t: Tables, table: DataFrame, label: str, separator: str) -> str:
    path = scratch_path(t.spark, label)
    table.write.csv(path, sep=separator)
    return path


def scan_ratings(t: Tables) -> DataFrame:
    path = written_as_text(t, t.ratings_file(), "ratings", delimited.RATINGS_SEPARATOR)
    return delimited.read_ratings(t.spark, path).withColumn(
        "rating", F.col("rating").cast("double"))


def scan_items(t: Tables) -> DataFrame:
    path = written_as_text(
        t, t.items_file(schemas.GENRES), "items", delimited.DIMENSION_SEPARATOR)
    return delimited.read_items(t.spark, path)


def scan_users(t: Tables) -> DataFrame:
    path = written_as_text(t, t.users_file(), "users", delimited.DIMENSION_SEPARATOR)
    return delimited.read_users(t.spark, path)


def rounded(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("score", F.round("score", 9))


def similarity_stats(t: Tables) -> DataFrame:
    stats = sim.similarity_stats(sim.pair_metrics(t.ratings_dense(), 1))
    return stats.withColumn("avg_similarity", F.round("avg_similarity", 9))


def paired_ratings(t: Tables) -> DataFrame:
    return sim.paired_ratings(t.ratings_dense(), 1).select(
        "user_id", F.round("target_rating", 9).alias("target_rating"), "other_item_id",
        F.round("other_rating", 9).alias("other_rating"))


def captured(t: Tables) -> DataFrame:
    return art.extract_articles(t.pages(), "captured", INGESTED_AT)


def dated(articles: DataFrame) -> DataFrame:
    return articles.withColumn("published", art.iso_timestamp(F.col("published")))


def tagged(t: Tables) -> DataFrame:
    return art.tag_tickers(t.articles(), TICKERS)


def latest_per_ticker(t: Tables, count: int = art.ARTICLES_PER_TICKER) -> DataFrame:
    return art.latest_per_ticker(dated(tagged(t)), count).select("ticker", "url", "published", "position")


def flaky_scorer() -> Callable[[pd.Series], pd.Series]:
    """The hash score, except that some texts always make the call fail."""

    def score(texts: pd.Series) -> pd.Series:
        digests = [hashlib.md5(text.encode()).hexdigest() for text in texts]
        if any(digest.startswith("00") for digest in digests):
            raise ConnectionError("no answer")
        return pd.Series([int(digest[:8], 16) / 4294967295.0 for digest in digests],
                         index=texts.index)

    return score


def page_counts(t: Tables) -> DataFrame:
    """The pages of a run by status, as the job that parsed them counted."""
    run = reports.article_run({"captured": t.pages_damaged()}, INGESTED_AT, hash_score)
    return t.spark.createDataFrame(list(run.pages.items()), "status string, pages long")


def scored(t: Tables) -> DataFrame:
    return sentiment.score_articles(art.process_articles(t.articles()), hash_score)


def stored(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "sentiment")
    store.store_sentiment(scored(t), path, RUN_AT)
    return store.read_sentiment(t.spark, path)


def stored_neutral(t: Tables) -> DataFrame:
    """Many articles that differ in nothing but their text."""
    path = scratch_path(t.spark, "neutral")
    neutral = t.articles().select(
        "source", "title", F.lit(NEUTRAL).alias("sentiment_score"), F.lit("HDFC").alias("ticker"))
    store.store_sentiment(neutral, path, RUN_AT)
    return store.read_sentiment(t.spark, path)


def two_runs(t: Tables) -> str:
    """A store of two days, in files of 64 rows."""
    path = scratch_path(t.spark, "store")
    articles = written_table(scored(t), "scored")
    for run_at in (RUN_AT - dt.timedelta(days=1), RUN_AT):
        store.store_sentiment(articles, path, run_at, rows_per_file=64)
    return path


def stored_day(t: Tables) -> DataFrame:
    day = (RUN_AT - dt.timedelta(days=1)).date()
    found = store.read_sentiment(t.spark, two_runs(t), first_date=day, last_date=day, with_run_date=True)
    return found.withColumn("run_date", F.col("run_date").cast("string"))


def deep_page(t: Tables) -> DataFrame:
    """From the last rows of the newer run on to the older one."""
    path = two_runs(t)
    first_run = store.rows_of_run(t.spark, path, RUN_AT)
    return store.stored_page(t.spark, path, limit=40, offset=first_run - 20)


def page_after(t: Tables) -> DataFrame:
    path = two_runs(t)
    last = store.stored_page(t.spark, path, limit=1, offset=99).first()
    return store.page_after(t.spark, path, RUN_AT, last["id"], limit=30)


def rated_stats(t: Tables) -> DataFrame:
    return rat.item_rating_stats(t.ratings()).select(
        F.col("item_id").alias("movie_id"), F.col("avg_rating").alias("rating"))


def observed_runs(t: Tables) -> DataFrame:
    """Two writes and a failure, read back from the table of runs, without their times."""
    path, target = scratch_path(t.spark, "runs"), scratch_path(t.spark, "target")

    def run(task_id: str, table: DataFrame, write) -> None:
        quality.recorded_run(task_id, table, write, lambda row: results.append_run_metrics(row, path))

    run("items", t.items(), lambda table: table.write.parquet(f"{target}/items"))
    run("ratings", t.ratings(), lambda table: table.write.parquet(f"{target}/ratings"))
    with contextlib.suppress(AnalysisException):
        run("again", t.items(), lambda table: table.write.mode("error").parquet(f"{target}/items"))
    runs = results.read_run_metrics(t.spark, path)
    return runs.select("task_id", "status", "rows", (F.col("duration") > 0).alias("timed"),
                       F.col("error").isNotNull().alias("explained"))


def written_reports(t: Tables) -> dict[str, DataFrame]:
    """The four reports, each read back from its table."""
    similar = {"metric": "cosine", "min_common": 2, "threshold": 0.5, "digits": 9}
    path = scratch_path(t.spark, "reports")
    tables = reports.report_tables(t.ratings(), t.items(), t.users(), "small ring", similar=similar)
    reports.write_reports(tables, path)
    return reports.read_reports(t.spark, path, tables)


def report_sizes(t: Tables) -> DataFrame:
    """How many rows each written report has."""
    return reduce(DataFrame.unionByName, [
        table.agg(F.count("*").alias("rows")).select(F.lit(name).alias("report"), "rows")
        for name, table in written_reports(t).items()])


def bundle(t: Tables) -> DataFrame:
    similar = {"metric": "cosine", "min_common": 2, "threshold": 0.5, "digits": 9}
    return reports.ratings_bundle(
        t.ratings(), t.items(), t.users(), "small ring", similar=similar, digits=9)


def cleaned(table: DataFrame, key: str, column: str) -> DataFrame:
    return table.select(key, clean_text(F.col(column)).alias("text_processed"))


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    # ratings
    "scan_ratings": scan_ratings,
    "scan_items": scan_items,
    "scan_users": scan_users,
    "occupation_mean_age": lambda t: rat.mean_age_by_occupation(t.users()),
    "occupation_mean_age_fmt": lambda t: reports.mean_age_lines(
        rat.mean_age_by_occupation(t.users())),
    "item_rating_stats": lambda t: rat.item_rating_stats(t.ratings()),
    "top_rated_items": lambda t: rat.top_rated_items(t.ratings(), t.items()),
    "top_rated_items_fmt": lambda t: reports.top_rated_lines(
        rat.top_rated_items(t.ratings(), t.items())),
    "age_group": lambda t: rat.with_age_group(t.users()),
    "age_group_strict": lambda t: rat.with_age_group(t.users(), under_20="under 20"),
    "genre_melt": lambda t: rat.item_genres(t.items()),
    "genre_stats": lambda t: rat.genre_stats(t.ratings(), t.items(), t.users()),
    "genre_by_demographic": lambda t: rat.genre_ranking(t.ratings(), t.items(), t.users()),
    "genre_topk": lambda t: rat.genre_ranking(t.ratings(), t.items(), t.users(), top_k=3),
    "genre_by_demographic_fmt": lambda t: reports.genre_lines(
        rat.genre_ranking(t.ratings(), t.items(), t.users())),
    # similarity
    "title_search": lambda t: sim.search_titles(t.items(), "RING"),
    "title_search_like": lambda t: sim.search_titles(t.items(), "R_d", like=True),
    "title_lookup": lambda t: sim.title_lookup(t.items(), "small ring"),
    "paired_ratings": paired_ratings,
    "pair_metrics": lambda t: rounded(sim.pair_metrics(t.ratings_dense(), 1)),
    "pair_metrics_repeated": lambda t: rounded(sim.pair_metrics(t.ratings_repeated(), 1)),
    "similarity_stats": similarity_stats,
    "item_similarity": lambda t: sim.item_similarity(
        t.ratings_dense(), t.items_dense(), TARGET, **FIXTURE_SIMILARITY),
    "item_similarity_fmt": lambda t: reports.similar_lines(sim.item_similarity(
        t.ratings_dense(), t.items_dense(), TARGET, **FIXTURE_SIMILARITY)),
    "item_similarity_cosine": lambda t: sim.item_similarity(
        t.ratings_dense(), t.items_dense(), TARGET, metric="cosine",
        **FIXTURE_SIMILARITY | {"threshold": 0.8}),
    "item_similarity_deduped": lambda t: sim.item_similarity(
        t.ratings_repeated(), t.items_dense(), TARGET, dedupe="avg", **FIXTURE_SIMILARITY),
    "all_pairs_similarity": lambda t: sim.all_pairs_similarity(
        t.ratings_dense(), min_common=10, threshold=0.8, digits=9, top_n=50),
    "all_pairs_similarity_split": lambda t: sim.all_pairs_similarity(
        t.ratings_repeated(), min_common=10, threshold=0.8, digits=9, top_n=50, busy_degree=20),
    "all_pairs_similarity_blocks": lambda t: sim.all_pairs_similarity(
        t.ratings_repeated(), min_common=10, threshold=0.8, digits=9, top_n=50, busy_degree=20,
        plan="pairs"),
    "all_pairs_similarity_prefix": lambda t: sim.all_pairs_similarity(
        t.ratings_dense(), min_common=10, threshold=0.8, digits=9, top_n=50, plan="prefix"),
    "all_pairs_similarity_any": lambda t: sim.all_pairs_similarity(
        t.ratings(), min_common=0, threshold=0.9, digits=9, top_n=50),
    "all_pairs_similarity_sparse": lambda t: sim.all_pairs_similarity(
        t.ratings(), min_common=3, threshold=0.5, digits=9, plan="prefix"),
    "all_pairs_similarity_strict": lambda t: sim.all_pairs_similarity(
        t.ratings_dense(), min_common=50, threshold=0.8, digits=9, top_n=50, plan="prefix"),
    "all_pairs_pearson": lambda t: sim.all_pairs_similarity(
        t.ratings_dense(), metric="pearson", min_common=10, threshold=0.0512345, digits=9),
    # articles
    "article_title": lambda t: captured(t).select("url", "title"),
    "article_extract": captured,
    "article_sites": lambda t: art.parsed_articles(art.parse_pages(
        t.pages_of_sites(), F.col("site"), INGESTED_AT)),
    "article_preview": lambda t: captured(t).select(
        "url", preview(F.col("title")).alias("title")),
    "article_quarantine": lambda t: art.quarantined_pages(
        art.parse_pages(t.pages_damaged(), "captured", INGESTED_AT)),
    "article_published": lambda t: art.with_publish_time(
        t.articles(), INGESTED_AT).select("url", "published"),
    "article_union": lambda t: art.union_articles(t.articles(), captured(t)),
    "text_clean": lambda t: cleaned(t.read("documents"), "doc_id", "text"),
    "text_clean_pages": lambda t: cleaned(t.pages(), "page_id", "html"),
    "article_nonempty": lambda t: art.drop_empty(art.with_clean_text(t.articles())).select(
        "url", "title_processed", "text_processed"),
    "article_dedup": lambda t: art.deduplicate(t.articles()),
    "article_process": lambda t: art.with_iso_dates(art.process_articles(t.articles())),
    "ticker_tag_table": lambda t: keywords.tag_keywords(t.articles(), t.keywords()).select("url", "ticker"),
    "ticker_tag": lambda t: tagged(t).select("url", "ticker"),
    "latest_per_ticker": latest_per_ticker,
    "latest_per_ticker_5000": lambda t: latest_per_ticker(t, 5000),
    "article_dedup_by_ticker": lambda t: art.deduplicate(tagged(t), "ticker").select(
        "url", "ticker"),
    "article_dedup_dated": lambda t: art.deduplicate(dated(t.articles())).select("url", "published"),
    "article_dedup_by_ticker_dated": lambda t: art.deduplicate(dated(tagged(t)), "ticker").select(
        "url", "ticker", "published"),
    # sentiment
    "sentiment_score": scored,
    "sentiment_lexicon": lambda t: sentiment.score_articles(
        art.process_articles(t.articles()), lexicon_scorer(POSITIVE, NEGATIVE)),
    "article_pipeline": lambda t: reports.article_sentiment(
        {"captured": t.pages_damaged()}, INGESTED_AT, lexicon_scorer(POSITIVE, NEGATIVE)),
    "article_pipeline_by_ticker": lambda t: reports.ticker_sentiment(
        {"captured": t.pages_damaged()}, INGESTED_AT, lexicon_scorer(POSITIVE, NEGATIVE), TICKERS),
    "article_pipeline_pages": page_counts,
    "sentiment_fallback": lambda t: sentiment.score_articles_in_batches(
        art.process_articles(t.articles()), flaky_scorer),
    "sentiment_store": stored,
    "sentiment_store_neutral": stored_neutral,
    "sentiment_store_day": stored_day,
    "sentiment_page_deep": deep_page,
    "sentiment_page_after": page_after,
    "sentiment_page": lambda t: results.sentiment_page(stored(t), limit=100, offset=50),
    # checks
    "dq_rules": lambda t: quality.rule_checks(t.ratings().select(
        F.col("item_id").alias("movie_id"), "rating")),
    "dq_rules_stats": lambda t: quality.rule_checks(rated_stats(t)),
    "dq_rules_nan": lambda t: quality.rule_checks(t.ratings().select(
        F.col("item_id").alias("movie_id"),
        F.when(F.col("item_id") % 10 == 0, F.lit("NaN").cast("double")).otherwise(F.col("rating")).alias("rating"))),
    "dq_profile_wide": lambda t: quality.table_profile(t.read("lineitem"), t.read("lineitem").columns),
    "dq_profile": lambda t: quality.table_profile(t.users(), ("user_id", "age")),
    "run_metrics_store": observed_runs,
    "run_metrics": lambda t: quality.run_metrics(t.run_log()),
    "result_bundle": bundle,
    "result_bundle_written": lambda t: reports.bundle(written_reports(t), digits=9),
    "report_tables": report_sizes,
    "report_genre_analysis": lambda t: written_reports(t)["genre_analysis"],
    "report_movie_similarity": lambda t: written_reports(t)["movie_similarity"],
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def over_folder(build: Callable[[Tables], DataFrame]):
        return lambda spark, folder: build(Tables(spark, folder))

    return {name: over_folder(build) for name, build in QUERIES.items()}
