"""Finished reports: as printable lines, as one document, and the whole article pipeline."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import articles, ratings as reports, sentiment, similarity


# How the reports are printed.
AGE_LINE = "%s: %s"
TOP_LINE = "%s: %s (%d ratings)"
GENRE_LINE = "  Age Group %-12s : %-12s (Avg Rating: %s, Count: %d)"
SIMILAR_LINE = "%-50s score: %-50s strength: %d"


def printed(name: str, digits: int) -> Column:
    """A number with a fixed count of decimals. Unlike ``%f`` of ``format_string``, this
    rounds the number itself, not its shortest spelling, and exact ties to even."""
    return F.call_function("format_number", F.col(name), F.lit("0." + "0" * digits))


def mean_age_lines(mean_ages: DataFrame) -> DataFrame:
    return mean_ages.select("occupation", F.format_string(
        AGE_LINE, "occupation", printed("mean_age", 1)).alias("line"))


def top_rated_lines(top_items: DataFrame) -> DataFrame:
    return top_items.select(F.format_string(
        TOP_LINE, "title", printed("avg_rating", 2), "rating_count").alias("line"))


def genre_lines(ranking: DataFrame) -> DataFrame:
    return ranking.select("occupation", F.format_string(
        GENRE_LINE, "age_group", "genre", printed("avg_rating", 2), "rating_count").alias("line"))


def similar_lines(similar: DataFrame) -> DataFrame:
    return similar.select(F.format_string(
        SIMILAR_LINE, "title", F.col("score").cast("string"), "strength").alias("line"))


def report_rows(report: DataFrame, order: list[Column], fields: list[Column]) -> Column:
    """All rows of a finished report as one array, in a stated order."""
    keyed = F.struct(*[key.alias(f"k{i}") for i, key in enumerate(order)],
                     F.struct(*fields).alias("row"))
    in_order = F.sort_array(F.collect_list(keyed))
    return report.agg(F.transform(in_order, lambda entry: entry["row"]).alias("rows")).scalar()


def report_tables(
    ratings: DataFrame, items: DataFrame, users: DataFrame, title: str, *,
    min_ratings: int = 35, top_n: int = 20, similar: dict | None = None,
) -> dict[str, DataFrame]:
    """The four reports by name. ``similar`` holds options of ``item_similarity``."""
    # The names of the reports.
    return {
        "top_movies": reports.top_rated_items(ratings, items, min_ratings, top_n),
        "genre_analysis": reports.genre_ranking(ratings, items, users),
        "occupation_age_analysis": reports.mean_age_by_occupation(users),
        "movie_similarity": similarity.item_similarity(ratings, items, title, **(similar or {})),
    }


def write_reports(tables: dict[str, DataFrame], path: str) -> None:
    """Each report as a table of its own below ``path``; a rerun replaces it."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")


def read_reports(spark: SparkSession, path: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}


def bundle(tables: dict[str, DataFrame], digits: int | None = None) -> DataFrame:
    """Finished reports as one JSON document in one row, from ``report_tables`` or from
    what ``read_reports`` gives back. ``digits`` rounds the means."""
    c = F.col

    def mean(name: str) -> Column:
        return c(name) if digits is None else F.round(c(name), digits).alias(name)

    # The names of the reports and of their columns.
    document = {
        "top_movies": report_rows(
            tables["top_movies"],
            [-c("avg_rating"), -c("rating_count"), c("title")],
            [c("title"), mean("avg_rating"), c("rating_count")]),
        "genre_analysis": report_rows(
            tables["genre_analysis"],
            [c("occupation"), c("age_group"), c("rank")],
            [c("occupation"), c("age_group"), c("genre"), mean("avg_rating"),
             c("rating_count"), c("rank")]),
        "occupation_age_analysis": F.struct(report_rows(
            tables["occupation_age_analysis"],
            [c("occupation")], [c("occupation"), mean("mean_age")]).alias("occupation_stats")),
        "movie_similarity": report_rows(
            tables["movie_similarity"],
            [-c("score"), -c("strength"), c("title")],
            [c("title"), c("score"), c("strength")]),
    }
    one_row = tables["top_movies"].sparkSession.range(1)
    return one_row.select(F.to_json(
        F.struct(*[value.alias(name) for name, value in document.items()]),
        {"ignoreNullFields": "false"}).alias("document"))


def ratings_bundle(
    ratings: DataFrame, items: DataFrame, users: DataFrame, title: str, *,
    digits: int | None = None, **options,
) -> DataFrame:
    """The four reports as one JSON document in one row; ``options`` are those of
    ``report_tables``.

    Only finished reports are gathered: their size depends on the numbers of top rows,
    of occupations and of age groups, not on the number of ratings.
    """
    return bundle(report_tables(ratings, items, users, title, **options), digits)


@dataclass(frozen=True)
class ArticleRun:
    """What became of all captured pages: scored articles, pages to look at, and the number
    of pages by status. Pages that are not scored are duplicates or empty after cleaning."""

    scored: DataFrame
    quarantined: DataFrame
    pages: dict[str, int]


def article_run(
    feeds: dict[str, DataFrame], ingested_at: dt.datetime, scorer: Callable[[Column], Column],
    ticker: str | Column | None = None,
) -> ArticleRun:
    """Captured pages per site, to scored articles: parse, unite, deduplicate, clean, drop
    empty ones, score. Every page is parsed once, and none is lost without being counted."""
    parsed = articles.written_pages(articles.union_articles(*[
        articles.parse_pages(pages, site, ingested_at) for site, pages in feeds.items()]))
    processed = articles.process_articles(articles.parsed_articles(parsed.pages))
    return ArticleRun(sentiment.score_articles(processed, scorer, ticker or sentiment.DEFAULT_TICKER),
                      articles.quarantined_pages(parsed.pages), parsed.counts)


def article_sentiment(
    feeds: dict[str, DataFrame], ingested_at: dt.datetime, scorer: Callable[[Column], Column],
    ticker: str | Column | None = None,
) -> DataFrame:
    """The scored articles of ``article_run``."""
    return article_run(feeds, ingested_at, scorer, ticker).scored


def ticker_sentiment(
    feeds: dict[str, DataFrame], ingested_at: dt.datetime, scorer: Callable[[Column], Column],
    tickers: Sequence[str] = articles.TICKERS, count: int = articles.ARTICLES_PER_TICKER,
) -> DataFrame:
    """The last articles of each ticker, scored: parse, tag, deduplicate within a ticker,
    clean, drop empty ones, take the latest, score."""
    parsed = articles.written_pages(articles.union_articles(*[
        articles.parse_pages(pages, site, ingested_at) for site, pages in feeds.items()]))
    tagged = articles.tag_tickers(articles.parsed_articles(parsed.pages), tickers)
    latest = articles.latest_per_ticker(articles.process_articles(tagged, "ticker"), count)
    return sentiment.score_articles(latest, scorer, F.col("ticker"))
