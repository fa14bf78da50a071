"""The library's inputs derived from the test tables, once for Spark and once as SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.settings import apply_session_conf

INGESTED_AT = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
RUN_AT = dt.datetime(2024, 3, 2, 19, 0, tzinfo=dt.timezone.utc)
ITEM_WORDS = (
    "small", "hot", "widget", "gear", "plate", "red", "blue", "bolt",
    "large", "ring", "rod", "gizmo", "old", "cold", "anvil", "new",
)
TICKERS = ("the", "que", "der")
DATE_MARKUP = (
    '<time datetime="2024-01-02T03:04:05Z">today</time><meta property="article:published_time" content="2023-01-01">',
    '<meta property="article:published_time" content="2024-01-05">', "<time>yesterday</time>", "")
POSITIVE, NEGATIVE = ("the", "and", "que", "der", "la"), ("of", "to", "en", "die", "is")


def hash_score(text: Column) -> Column:
    """Evenly spread scores for tests of what comes before and after a scorer."""
    leading = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return leading / F.lit(4294967295.0)


class Tables:
    """The test tables of one folder and the views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = apply_session_conf(spark)
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def order_lines(self) -> DataFrame:
        orders = self.read("orders").withColumnRenamed("o_orderkey", "l_orderkey")
        rating = 1 + F.floor((F.col("l_quantity") - 1) / 10)
        return self.read("lineitem").join(orders, "l_orderkey").withColumn(
            "rating", rating.cast("double"))

    def ratings(self) -> DataFrame:
        """Item = part; the same user rates some items repeatedly."""
        return self.order_lines().select(
            F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"), "rating")

    def ratings_dense(self) -> DataFrame:
        """Item = supplier, one row per user and item."""
        return (self.order_lines()
                .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_suppkey").alias("item_id"))
                .agg(F.avg("rating").alias("rating")))

    def ratings_repeated(self) -> DataFrame:
        """Item = supplier, repeated ratings kept."""
        return self.order_lines().select(
            F.col("o_custkey").alias("user_id"), F.col("l_suppkey").alias("item_id"), "rating")

    def ratings_file(self) -> DataFrame:
        """In the layout of the ratings file."""
        return self.order_lines().select(
            F.col("o_custkey").cast("int").alias("user_id"),
            F.col("l_partkey").cast("int").alias("item_id"),
            F.col("rating").cast("float").alias("rating"),
            F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).cast("int").alias("timestamp"))

    def users(self) -> DataFrame:
        key = F.col("c_custkey")
        age = F.when(key % 97 != 0, 15 + key % 50).cast("int")
        return self.read("customer").select(
            key.alias("user_id"), age.alias("age"),
            F.when(key % 2 == 0, "M").otherwise("F").alias("gender"),
            F.col("c_mktsegment").alias("occupation"))

    def users_file(self) -> DataFrame:
        return self.users().withColumns({
            "user_id": F.col("user_id").cast("int"),
            "zip_code": F.lpad(F.col("user_id").cast("string"), 8, "0")})

    def items(self) -> DataFrame:
        words = F.split("p_name", " ")
        return self.read("part").select(
            F.col("p_partkey").alias("movie_id"), F.col("p_name").alias("title"),
            *[F.array_contains(words, word).cast("int").alias(word) for word in ITEM_WORDS])

    def items_file(self, genres: tuple[str, ...]) -> DataFrame:
        """In the layout of the items file: the flags take the place of the genres, the
        last two of which come from the part type."""
        flags = [F.col(word).alias(genre) for word, genre in zip(ITEM_WORDS, genres)]
        flags += [(F.col("p_type") == kind).cast("int").alias(genre)
                  for kind, genre in zip(("ECONOMY", "SMALL"), genres[len(ITEM_WORDS):])]
        parts = self.read("part").select(F.col("p_partkey").alias("movie_id"), "p_type", "p_brand")
        return self.items().join(parts, "movie_id").select(
            F.col("movie_id").cast("int").alias("movie_id"), "title",
            F.lit("01-Jan-1995").alias("release_date"),
            F.lit(None).cast("string").alias("video_release_date"),
            F.concat(F.lit("https://example.org/"), "p_brand").alias("imdb_url"),
            F.lit(0).alias("unknown"), *flags)

    def items_dense(self) -> DataFrame:
        return self.read("supplier").select(
            F.col("s_suppkey").alias("movie_id"), F.col("s_name").alias("title"))

    def articles(self) -> DataFrame:
        """With exact copies, two spellings of dates, and bad dates."""
        key = F.col("doc_id")
        published = (F.when(key % 50 == 0, "not a date")
                     .when(key % 2 == 0, "2024-01-01T10:00:00+05:30")
                     .otherwise("2024-02-03T04:05:06Z"))
        return self.read("documents").select(
            F.substring("text", 1, 40).alias("title"), "text", published.alias("published"),
            F.concat(F.lit("https://example.org/"), key.cast("string")).alias("url"), "source")

    def keywords(self) -> DataFrame:
        """The third word of every document."""
        third = F.try_element_at(F.split("text", " "), F.lit(3))
        return self.read("documents").select(third.alias("ticker")).where(F.length(third) > 0)

    def pages(self) -> DataFrame:
        return self.read("pages")

    def pages_damaged(self) -> DataFrame:
        """Some pages lose their content, some are missing altogether."""
        key = F.col("page_id")
        html = (F.when(key % 7 == 0, "<html></html>")
                .when(key % 11 != 0, F.col("html")))
        return self.pages().withColumn("html", html)

    def pages_of_sites(self) -> DataFrame:
        """The pages in the layouts of three sites, with dates in four ways. A first title
        without the site's class is a decoy, as is the date in running text."""
        key, html = F.col("page_id"), F.col("html")
        site = F.element_at(F.array(F.lit("yourstory"), F.lit("finshots"), F.lit("other")), (key % 3 + 1).cast("int"))
        title, body = (F.concat(F.when(key % 3 == 0, "article").otherwise("post"), F.lit(name))
                       for name in ("-title", "-content"))
        turned = F.replace(html, F.lit("<h1>"), F.concat(F.lit('<h1 class="wide '), title, F.lit('">')))
        turned = F.replace(turned, F.lit("<article>"), F.concat(F.lit('<div class="'), body, F.lit('">')))
        turned = F.replace(turned, F.lit("</article>"), F.lit("</div>"))
        decoy = F.when(html.contains("<h1>"), "<h1>Not this</h1><p>2024-09-09</p>").otherwise("")
        dates = F.element_at(F.array(*map(F.lit, DATE_MARKUP)), (key % 4 + 1).cast("int"))
        return self.pages().select(
            "url", site.alias("site"),
            F.concat(dates, F.when(key % 3 == 2, html).otherwise(F.concat(decoy, turned))).alias("html"))

    def run_log(self) -> DataFrame:
        """One run per user."""
        return self.read("events").groupBy("user_id").agg(
            F.min(F.col("ts").cast("timestamp")).alias("start_time"),
            F.max(F.col("ts").cast("timestamp")).alias("end_time"),
        ).select(F.concat(F.lit("task_"), F.col("user_id").cast("string")).alias("task_id"),
                 "start_time", "end_time")


# The same views as SQL, to be inlined as common table expressions.
def flag(word: str) -> str:
    return f"CAST(concat(' ', p_name, ' ') LIKE '% {word} %' AS INT)"


VIEWS = {
    "order_lines": """
        SELECT l.*, o.*, CAST(1 + floor((l_quantity - 1) / 10) AS DOUBLE) AS rating
        FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey""",
    "ratings": """
        SELECT o_custkey AS user_id, l_partkey AS item_id, rating FROM order_lines""",
    "ratings_dense": """
        SELECT o_custkey AS user_id, l_suppkey AS item_id, avg(rating) AS rating
        FROM order_lines GROUP BY 1, 2""",
    "ratings_single": """
        SELECT user_id, item_id, avg(rating) AS rating FROM ratings GROUP BY 1, 2""",
    "ratings_repeated": """
        SELECT o_custkey AS user_id, l_suppkey AS item_id, rating FROM order_lines""",
    "users": """
        SELECT c_custkey AS user_id,
               CAST(CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE 15 + c_custkey % 50 END AS INT) AS age,
               CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
               c_mktsegment AS occupation
        FROM customer""",
    "items": "SELECT p_partkey AS movie_id, p_name AS title, "
             + ", ".join(f"{flag(word)} AS {word}" for word in ITEM_WORDS) + " FROM part",
    "item_genres": " UNION ALL ".join(
        f"SELECT movie_id, '{word}' AS genre FROM items WHERE {word} = 1" for word in ITEM_WORDS),
    "items_dense": "SELECT s_suppkey AS movie_id, s_name AS title FROM supplier",
    "articles": """
        SELECT substr(text, 1, 40) AS title, text,
               CASE WHEN doc_id % 50 = 0 THEN 'not a date'
                    WHEN doc_id % 2 = 0 THEN '2024-01-01T10:00:00+05:30'
                    ELSE '2024-02-03T04:05:06Z' END AS published,
               concat('https://example.org/', CAST(doc_id AS VARCHAR)) AS url, source
        FROM documents""",
    "tickers": "SELECT * FROM (VALUES "
               + ", ".join(f"('{ticker}')" for ticker in TICKERS) + ") t(ticker)",
    "keywords": """
        SELECT DISTINCT string_split(text, ' ')[3] AS ticker FROM documents
        WHERE length(string_split(text, ' ')[3]) > 0""",
    "pages_damaged": """
        SELECT page_id, url, CASE WHEN page_id % 7 = 0 THEN '<html></html>'
                                  WHEN page_id % 11 = 0 THEN NULL ELSE html END AS html
        FROM pages""",
    "run_log": """
        SELECT concat('task_', CAST(user_id AS VARCHAR)) AS task_id,
               min(ts) AS start_time, max(ts) AS end_time
        FROM events GROUP BY user_id""",
}
