import datetime as dt

import pytest
from conftest import plan_of, values
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.functions.html import NO_CONTENT, NO_TITLE, parse_article
from tallyloom.operators import articles as art

NOW = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
NOW_TEXT = NOW.isoformat()
PAGE = """<html><head><title>no</title><meta property="article:published_time"
content="2024-05-06T07:08:09Z"></head><body><h1>First</h1>
<h1 class="big article-title"> Story &amp; more </h1><h1 class="post-title">Post</h1>
<article>whole <div class="article-content">body<script>var x = "<p>";</script><br>of <b>A
</div><div class="post-content">body of B</div></article><main>main</main></body></html>"""


@pytest.mark.parametrize("source, title, text", [
    ("YourStory", "Story & more", "bodyof A"), ("finshots", "Post", "body of B"),
    ("elsewhere", "First", "whole bodyof A\nbody of B"), (None, "First", "whole bodyof A\nbody of B")])
def test_layouts(source, title, text):
    parsed = parse_article(PAGE, source, NOW_TEXT)
    assert (parsed["title"], parsed["text"]) == (title, text)
    assert parsed["published"] == "2024-05-06T07:08:09+00:00"


@pytest.mark.parametrize("html, title, text", [
    ("", NO_TITLE, NO_CONTENT),
    ("<h1></h1><article> </article>", "", ""),
    ("<h1>a<h1>b</h1>c</h1>", "abc", NO_CONTENT),
    ("<main>m", NO_TITLE, "m"),
    ("<article>a<!-- no --><style>p{}</style>&copy;&middot;&quot;</p>b", NO_TITLE, 'a©·"b'),
    ("<p><b><article>x<p>y</b>z</article>w", NO_TITLE, "xy"),
    ("<article>a<template>t</template><![CDATA[c]]></article>", NO_TITLE, "ac"),
])
def test_markup(html, title, text):
    parsed = parse_article(html, "elsewhere", NOW_TEXT)
    assert (parsed["title"], parsed["text"]) == (title, text)


DATES = {
    '<time datetime="2024-01-02">x</time>': "2024-01-02T00:00:00",
    '<time content="2024-01-02T03:04">x</time>': "2024-01-02T03:04:00",
    "<time>2024-01-02 03:04:05.123456+05:30</time>": "2024-01-02T03:04:05.123456+05:30",
    '<time datetime="">2024-01-02T03Z</time>': "2024-01-02T03:00:00+00:00",
    "<time>March 3, 2024</time>": NOW_TEXT,
    "<time>2024-13-01</time>": NOW_TEXT,
    '<time>bad</time><meta property="article:published_time" content="2024-01-02">': NOW_TEXT,
    '<meta property="other" content="2024-01-02">': NOW_TEXT,
}


@pytest.mark.parametrize("html, published", DATES.items())
def test_dates_in_pages(html, published):
    assert parse_article(html, None, NOW_TEXT)["published"] == published


def test_publish_time_of_columns(spark):
    dates = ["2024-01-02", "2024-01-02T03:04", "2024-01-02T03", "2024-01-02T03Z", "2024",
             "2024-02-30", "not a date", None, "2024-01-02T03:04:05.123456+05:30",
             "2024-01-02T03:04:05Z", " 2024-01-02"]
    frame = spark.createDataFrame([(i, date) for i, date in enumerate(dates)], "n int, published string")
    got = art.with_publish_time(frame, NOW).orderBy("n").select(
        F.date_format("published", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("p"))
    fallback = "2024-03-01 00:00:00.000000"
    assert values(got, "p") == [
        "2024-01-02 00:00:00.000000", "2024-01-02 03:04:00.000000", "2024-01-02 03:00:00.000000",
        "2024-01-02 03:00:00.000000", fallback, fallback, fallback, fallback,
        "2024-01-01 21:34:05.123456", "2024-01-02 03:04:05.000000", fallback]


def test_a_failing_page_does_not_stop_the_others(spark):
    pages = spark.createDataFrame(
        [("u1", "<h1>t</h1><main>x</main>"), ("u2", None), ("u3", "<p>nothing")], "url string, html string")
    parsed = art.parse_pages(pages, "elsewhere", NOW)
    assert values(art.extract_articles(pages, "elsewhere", NOW), "url", "title") == [
        ("u1", "t"), ("u3", NO_TITLE)]
    assert values(art.quarantined_pages(parsed), "url", "status") == [
        ("u2", "failed"), ("u3", "no_content")]
    by_column = art.extract_articles(
        pages.withColumn("site", F.lit("Finshots")), F.col("site"), NOW)
    assert values(by_column, "source") == ["Finshots", "Finshots"]
    assert by_column.columns == schemas.ARTICLE.fieldNames()


def article(title, text, published="2024-01-01", url="u", source="s"):
    return (title, text, published, url, source)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.ARTICLE)


def test_duplicates(spark):
    articles = table(
        spark, article("t", "x", url="late", published="2024-01-02"),
        article("t", "x", url="b"), article("t", "x", url="a"), article("t", "y", url="other"),
        article(None, "x", url="n2"), article(None, "x", url="n1"))
    assert sorted(values(art.deduplicate(articles), "url")) == ["a", "n1", "other"]
    assert plan_of(art.deduplicate(articles)).count("WindowGroupLimit") == 2


def test_processing(spark):
    articles = table(
        spark, article("T", "X 5%", url="b", published="bad"), article("T", "X 5%", url="a"),
        article("###", "X"), article("T", "<p>"), article(None, "X"),
        article("Same", "one", url="c"), article("Same", "two", url="d"))
    processed = art.process_articles(articles)
    assert sorted(values(processed, "url", "title_processed", "text_processed")) == [
        ("a", "t", "x 5 percent"), ("c", "same", "one"), ("d", "same", "two")]
    assert processed.columns == [
        "title", "text", "published", "url", "source", "title_processed", "text_processed",
        "title_original", "text_original"]
    written = art.with_iso_dates(processed)
    assert sorted(values(written, "url", "published")) == [
        ("a", "2024-01-01T00:00:00"), ("c", "2024-01-01T00:00:00"), ("d", "2024-01-01T00:00:00")]
    assert plan_of(art.process_articles(articles)).count("Exchange hashpartitioning") == 1


def test_filter_first_or_duplicates_first_is_the_same(spark):
    articles = table(spark, *[article(f"t{i % 3}", ["#", "a", "B <i>"][i % 2 + (i > 4)], url=str(i))
                              for i in range(12)])
    filter_first = art.deduplicate(art.drop_empty(art.with_clean_text(articles)))
    assert sorted(values(filter_first, "url")) == sorted(values(art.process_articles(articles), "url"))


def test_union_keeps_duplicates_and_takes_empty_feeds(spark):
    one, none = table(spark, article("t", "x")), table(spark)
    assert art.union_articles(one, one.select(*reversed(one.columns)), none).count() == 2
    assert art.process_articles(art.union_articles(none, none)).count() == 0


def test_tickers(spark):
    articles = table(
        spark, *[article("t", "HDFC and Tata Motors", f"2024-01-0{i}", f"u{i}") for i in range(1, 8)],
        article("t", "hdfc"), article("t", "nothing"), article("t", "Tata Motors", None, "none"))
    tagged = art.tag_tickers(articles)
    assert tagged.groupBy("ticker").count().orderBy("ticker").collect() == [("HDFC", 7), ("Tata Motors", 8)]
    latest = art.latest_per_ticker(tagged)
    assert values(latest.where("ticker = 'HDFC'").orderBy("position"), "url") == [
        "u7", "u6", "u5", "u4", "u3"]
    plan = plan_of(latest)
    assert plan.count("WindowGroupLimit") == 2 and "Join" not in plan
    assert art.deduplicate(tagged.withColumn("text", F.lit("x")), "ticker").count() == 2


def test_undated_copies_come_last(spark):
    rows = [("t", "x", None, "a", "s"), ("t", "x", dt.datetime(2024, 1, 2), "c", "s"),
            ("t", "x", dt.datetime(2024, 1, 1), "d", "s"), ("t", "y", None, "f", "s"), ("t", "y", None, "e", "s")]
    articles = spark.createDataFrame(rows, "title string, text string, published timestamp, url string, source string")
    assert sorted(values(art.deduplicate(articles), "url")) == ["d", "e"]


def test_digests_keep_columns_apart(spark):
    rows = [("ab", "c"), ("a", "bc"), ("", None), (None, ""), (None, None), ("", ""), ("1:a", "-"), ("ab", "c")]
    articles = table(spark, *[article(title, text, url=str(k)) for k, (title, text) in enumerate(rows)])
    assert sorted(values(art.deduplicate(articles), "url")) == [str(k) for k in range(7)]
    digest = articles.select(F.length(art.text_digest("title", "text")).alias("n"))
    assert set(values(digest, "n")) == {32}
