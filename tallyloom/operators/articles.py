"""Articles: from captured pages to cleaned, deduplicated records."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.dates import iso_timestamp, publish_time
from tallyloom.functions.html import parse_article
from tallyloom.functions.text import clean_text
from tallyloom.operators.ordering import ranked_within
from tallyloom.settings import scratch_path, written_table

logger = logging.getLogger(__name__)

# Keywords articles are searched for, and how many are kept of each.
TICKERS = ("HDFC", "Tata Motors")
ARTICLES_PER_TICKER = 5

PARSED_COLUMNS = ("title", "text", "published", "url", "source", "status")
# What becomes of a page.
STATUSES = ("ok", "no_content", "failed")


def parse_pages(
    pages: DataFrame, source: str | Column, ingested_at: dt.datetime,
    url_column: str = "url", html_column: str = "html",
) -> DataFrame:
    """Article records of captured pages plus a ``status``: ``ok``, ``no_content`` where
    neither title nor text was found, ``failed`` where there is no page or it cannot be
    parsed (all fields but url and source are then NULL).

    ``source`` names the site, whose layout decides where title and text are looked for.
    A page that fails never fails the others. Pages stream through the workers in Arrow
    batches; nothing is shuffled.
    """
    if ingested_at.tzinfo is None:
        ingested_at = ingested_at.replace(tzinfo=dt.timezone.utc)
    fallback = ingested_at.isoformat()
    source = F.lit(source) if isinstance(source, str) else source

    layout = pa.schema([(name, pa.string()) for name in PARSED_COLUMNS])

    def parse_page(page: dict[str, str | None]) -> dict[str, str | None]:
        try:
            fields = parse_article(page["html"], page["source"], fallback)
        except Exception as error:  # a broken page must not stop the rest
            logger.warning("page %s skipped: %s", page["url"], error)
            return page | {"status": "failed"}
        return page | fields | {"status": "ok" if fields["found"] else "no_content"}

    def parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parsed = [parse_page(page) for page in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(parsed, schema=layout)

    captured = pages.select(
        F.col(url_column).alias("url"), F.col(html_column).alias("html"),
        source.alias("source"))
    return captured.mapInArrow(
        parse_batches, ", ".join(f"{name} string" for name in PARSED_COLUMNS))


@dataclass(frozen=True)
class WrittenPages:
    """Parsed pages, read back from a table with one folder per status, and the number of
    pages of each status."""

    pages: DataFrame
    counts: dict[str, int]


def written_pages(parsed: DataFrame) -> WrittenPages:
    """Writes the parse, so that pages are parsed once however often they are used: good
    pages and bad ones are then read from folders of their own. The counts are taken on the
    way by the job that writes."""
    spark, counted = parsed.sparkSession, Observation("pages")
    path = scratch_path(spark, "pages")
    by_status = [F.count_if(F.col("status") == status).alias(status) for status in STATUSES]
    parsed.observe(counted, *by_status).write.partitionBy("status").parquet(path)
    schema = T.StructType([*(T.StructField(name, T.StringType()) for name in PARSED_COLUMNS)])
    return WrittenPages(spark.read.schema(schema).parquet(path), dict(counted.get))


def parsed_articles(parsed: DataFrame) -> DataFrame:
    """The article records of all pages that could be parsed. Missing parts carry their
    placeholder text."""
    return parsed.where(F.col("status") != "failed").drop("status")


def quarantined_pages(parsed: DataFrame) -> DataFrame:
    """The pages to look at: failed, or parsed without finding an article."""
    return parsed.where(F.col("status") != "ok").select("url", "source", "status")


def extract_articles(
    pages: DataFrame, source: str | Column, ingested_at: dt.datetime,
    url_column: str = "url", html_column: str = "html",
) -> DataFrame:
    """Article records of captured pages; pages that fail are logged and left out."""
    return parsed_articles(parse_pages(pages, source, ingested_at, url_column, html_column))


def union_articles(*feeds: DataFrame) -> DataFrame:
    """All articles of all feeds, matched by column name, duplicates kept."""
    return reduce(DataFrame.unionByName, feeds)


def with_publish_time(articles: DataFrame, ingested_at: dt.datetime) -> DataFrame:
    """Replace the date text by a timestamp, the ingestion time where it is no date."""
    return articles.withColumn("published", publish_time(F.col("published"), ingested_at))


def with_clean_text(articles: DataFrame) -> DataFrame:
    """Add ``title_processed`` and ``text_processed``.

    The pair goes through ``inline`` because a filter on a plain projection is pushed
    below it, which makes Spark run every regular expression twice.
    """
    cleaned = F.struct(
        clean_text(F.col("title")).alias("title_processed"),
        clean_text(F.col("text")).alias("text_processed"))
    return articles.select("*", F.inline(F.array(cleaned)))


def drop_empty(cleaned: DataFrame) -> DataFrame:
    """Keep articles whose cleaned title and cleaned text both have characters."""
    return cleaned.where(
        (F.length("title_processed") > 0) & (F.length("text_processed") > 0))


def text_digest(*names: str) -> Column:
    """256 bits that tell texts apart; NULL differs from an empty text, and where one text
    ends and the next begins matters."""
    parts = [F.coalesce(F.concat(F.length(name).cast("string"), F.lit(":"), F.col(name)), F.lit("-"))
             for name in names]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def deduplicate(articles: DataFrame, *within: str) -> DataFrame:
    """One article of each (title, text), within groups of the given columns: the
    earliest published, undated ones last, then the smallest url and source.

    Articles are told apart by a digest, so that long texts are neither compared nor part
    of a sort key. Every map task keeps one row per group before the shuffle, so a text
    that makes up a third of the input still sends only one row per task.
    """
    digest = "digest__"
    first = Window.partitionBy(digest, *within).orderBy(
        F.asc_nulls_last("published"), "url", "source")
    return (articles.withColumn(digest, text_digest("title", "text"))
            .withColumn("copy", F.row_number().over(first))
            .where(F.col("copy") == 1).drop("copy", digest))


def process_articles(articles: DataFrame, *within: str) -> DataFrame:
    """Cleaned articles without empty ones and duplicates, dates as timestamps.

    Cleaned text depends on title and text alone, so all copies of an article pass or
    fail the filter together. Duplicates can therefore go first, and only what is left
    is cleaned.
    """
    dated = articles.withColumn("published", iso_timestamp(F.col("published")))
    return drop_empty(with_clean_text(deduplicate(dated, *within))).select(
        *articles.columns, "title_processed", "text_processed",
        F.col("title").alias("title_original"), F.col("text").alias("text_original"))


def with_iso_dates(articles: DataFrame) -> DataFrame:
    """Timestamps written out for a hand-off as text, without a zone."""
    return articles.withColumn(
        "published", F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss"))


def tag_tickers(
    articles: DataFrame, tickers: Sequence[str] = TICKERS, column: str = "text"
) -> DataFrame:
    """One row per article and keyword its text contains.

    The keywords are a configured list, checked as literals row by row: no join, no
    shuffle.
    """
    named = F.array(*[F.lit(ticker) for ticker in tickers])
    found = F.filter(named, lambda ticker: F.contains(F.col(column), ticker))
    return articles.select("*", F.explode(found).alias("ticker"))


def latest_per_ticker(tagged: DataFrame, count: int = ARTICLES_PER_TICKER) -> DataFrame:
    """The last published articles of each ticker; articles without a date come last.

    Up to the count Spark limits ranks for inside of tasks (1,000 by default), map tasks
    pass on at most ``count`` rows per ticker. For any larger count, articles older than
    needed go first (``recent_enough``), and the others are ranked over many tasks.
    """
    order = [F.desc_nulls_last("published"), F.asc("url"), F.asc("title"), F.asc("text")]
    limited = tagged.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
    if count <= int(limited):
        newest = Window.partitionBy("ticker").orderBy(*order)
        ranked = tagged.withColumn("position", F.row_number().over(newest))
    else:
        ranked = ranked_within(recent_enough(tagged, count), ["ticker"], order, label="latest").withColumn(
            "position", F.col("position").cast("int"))
    return ranked.where(F.col("position") <= count)


def recent_enough(tagged: DataFrame, count: int) -> DataFrame:
    """The articles that can be among the last ``count`` of their ticker, all ties included.

    The number of articles per ticker and hour, added up inside of tasks first, gives the
    hour that reaches ``count``; whatever is older is dropped where it is read. Articles
    without a date stay only where the dated ones do not suffice.
    """
    hour = F.date_trunc("hour", "published")
    hours = tagged.groupBy("ticker", hour.alias("hour")).agg(F.count("*").alias("articles"))
    later = Window.partitionBy("ticker").orderBy(F.desc_nulls_last("hour")).rowsBetween(
        Window.unboundedPreceding, -1)
    needed = hours.withColumn("later", F.coalesce(F.sum("articles").over(later), F.lit(0))).where(
        F.col("later") < count)
    bounds = written_table(needed.groupBy(F.col("ticker").alias("of_ticker")).agg(
        F.min("hour").alias("since"), F.bool_or(F.col("hour").isNull()).alias("undated")), "bounds")
    reached = F.col("undated") | (F.col("published") >= F.col("since"))
    return (tagged.join(bounds, tagged["ticker"].eqNullSafe(bounds["of_ticker"]))
            .where(reached).select(*tagged.columns))
