import datetime as dt

import pandas as pd
import pytest
from conftest import values
from pyspark.sql import functions as F

from tallyloom.functions.scoring import NEUTRAL, lexicon_scorer, score_batch
from tallyloom.operators import articles as art
from tallyloom.operators import sentiment
from tallyloom.plans.fixtures import hash_score
from tallyloom.plans.reports import article_run, article_sentiment
from tallyloom.sources import results

RUN = dt.datetime(2024, 3, 2, 19, 0, tzinfo=dt.timezone.utc)
PROCESSED = "source string, title string, title_processed string, text_processed string"


def processed(spark, *texts):
    return spark.createDataFrame([("s", f"T{i}", "t", text) for i, text in enumerate(texts)], PROCESSED)


def test_native_score(spark):
    scored = sentiment.score_articles(processed(spark, "a", "b", None), hash_score)
    assert scored.columns == ["source", "title", "sentiment_score", "ticker"]
    found = values(scored, "sentiment_score")
    assert all(0 <= score <= 1 for score in found) and len(set(found)) == 3
    assert set(values(scored, "ticker")) == {"HDFC"}
    assert found == values(
        sentiment.score_articles(processed(spark, "a", "b", None), hash_score), "sentiment_score")
    with pytest.raises(TypeError):
        sentiment.score_articles(processed(spark, "a"))


def test_lexicon(spark):
    scorer = lexicon_scorer(["good", "fine"], ["bad"])
    scored = sentiment.score_articles(processed(spark, "good bad", "good fine  goods", "so so", None, "bad\tbad"), scorer)
    assert values(scored, "sentiment_score") == [0.5, 1.0, NEUTRAL, NEUTRAL, 0.0]
    assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        lexicon_scorer(["good"], [])


def test_own_scorer_and_ticker(spark):
    scored = sentiment.score_articles(
        processed(spark, "abc"), scorer=lambda text: F.length(text) / F.lit(10.0), ticker=F.col("title"))
    assert values(scored, "sentiment_score", "ticker") == [(0.5, "T0")]


class Scorer:
    """Fails on its first calls, on some texts always, or gives a wrong answer for them."""

    def __init__(self, failures=0, bad=(), answer=None):
        self.failures, self.bad, self.answer, self.calls = failures, bad, answer, 0

    def __call__(self, texts):
        self.calls += 1
        hit = bool(set(texts) & set(self.bad))
        if self.calls <= self.failures or hit and self.answer is None:
            raise ConnectionError
        return self.answer if hit else pd.Series([0.25] * len(texts), index=texts.index)


@pytest.mark.parametrize("scorer, wanted, calls", [
    (Scorer(), [0.25] * 4, 1),
    (Scorer(failures=1), [0.25] * 4, 3),  # the batch, then both halves
    (Scorer(bad=("b",)), [0.25, 0.5, 0.25, 0.25], 6),  # abcd, ab, a, b, b, cd
    (Scorer(bad=("b",), answer=[0.1]), [0.25, 0.1, 0.25, 0.25], 5),  # too few scores for abcd and ab
    (Scorer(bad=("b",), answer=[float("nan")] * 4), [0.25, 0.5, 0.25, 0.25], 6),
    (Scorer(bad=("b",), answer=[7.0]), [0.25, 0.5, 0.25, 0.25], 6),
    (Scorer(failures=99), [0.5] * 4, 11)])  # 3 with more rows than one, 4 times 2
def test_failing_batches_are_halved(scorer, wanted, calls):
    assert list(score_batch(scorer, pd.Series(["a", "b", "c", "d"], index=[5, 6, 7, 9]))) == wanted
    assert scorer.calls == calls


def test_calls_are_bounded():
    rows = pd.Series([str(k) for k in range(1000)])
    one, all_bad, none = Scorer(bad=("500",)), Scorer(failures=10 ** 9), Scorer()
    assert list(score_batch(one, rows)).count(NEUTRAL) == 1 and one.calls <= 2 * 10 + 2
    assert set(score_batch(all_bad, rows)) == {NEUTRAL} and all_bad.calls < 3000
    assert len(score_batch(none, rows.iloc[:0])) == 0 and none.calls == 0


def test_batch_scorer_runs_in_the_workers(spark):
    def factory():
        def score(texts):
            if any("bad" in text for text in texts):
                raise ValueError(texts)
            return texts.str.len() / 10.0
        return score

    scored = sentiment.score_articles_in_batches(processed(spark, "abc", "bad", None), factory)
    assert sorted(values(scored, "title", "sentiment_score")) == [("T0", 0.5), ("T1", 0.5), ("T2", 0.1)]
    assert sentiment.score_articles_in_batches(processed(spark, "x").where("false"), factory).count() == 0


def test_storing_and_paging(spark, new_path):
    scored = sentiment.score_articles(processed(spark, *"abcdef"), hash_score)
    results.store_sentiment(scored, new_path, RUN)
    results.store_sentiment(scored, new_path, RUN, replace_run=True)
    once = results.read_sentiment(spark, new_path)
    assert once.count() == 6 and once.select("id").distinct().count() == 6
    results.store_sentiment(scored, new_path, RUN)
    assert results.read_sentiment(spark, new_path).count() == 12
    results.store_sentiment(scored.limit(1), new_path, RUN + dt.timedelta(days=1), replace_run=True)
    stored = results.read_sentiment(spark, new_path)
    assert stored.count() == 13
    pages = [values(results.sentiment_page(stored, 5, offset), "title", "created_at")
             for offset in (0, 5, 10)]
    assert [len(page) for page in pages] == [5, 5, 3]
    assert pages[0][0][0] == "T0" and pages[0][0][1] > pages[0][1][1]
    assert results.sentiment_page(stored).columns == [
        "source", "ticker", "title", "sentiment_score", "created_at"]


def test_pages_to_scores(spark):
    page = "<h1>T {0}</h1><article>text {0}</article>"
    feed = spark.createDataFrame(
        [("u1", page.format(1)), ("u2", page.format(1)), ("u3", None), ("u4", "<h1>#</h1>")],
        "url string, html string")
    feeds = {"yourstory": feed, "finshots": feed.where("url = 'u1'")}
    run = article_run(feeds, RUN, hash_score)
    assert values(run.scored, "title") == ["T 1"]
    assert run.pages == {"ok": 4, "no_content": 0, "failed": 1}
    assert values(run.quarantined, "url", "status") == [("u3", "failed")]
    assert "MapInArrow" not in run.scored._jdf.queryExecution().executedPlan().toString()
    assert values(article_sentiment(feeds, RUN, hash_score), "title") == ["T 1"]
    assert art.extract_articles(feed.where("false"), "x", RUN).count() == 0
