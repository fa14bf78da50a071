"""Sentiment of processed articles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.scoring import BatchScorer, batch_mapper

# Fixed value: the ticker of every scored article unless the articles carry their own.
DEFAULT_TICKER = "HDFC"


def scoring_input(processed: DataFrame, ticker: str | Column = DEFAULT_TICKER) -> DataFrame:
    """What a scorer needs: cleaned title and text as one string, and the columns kept."""
    ticker = F.lit(ticker) if isinstance(ticker, str) else ticker
    return processed.select(
        "source", "title", ticker.alias("ticker"),
        F.concat_ws(" ", "title_processed", "text_processed").alias("combined_text"))


def score_articles(
    processed: DataFrame, scorer: Callable[[Column], Column],
    ticker: str | Column = DEFAULT_TICKER,
) -> DataFrame:
    """Score with a native expression."""
    return scoring_input(processed, ticker).select(
        "source", "title", scorer(F.col("combined_text")).alias("sentiment_score"), "ticker")


def score_articles_in_batches(
    processed: DataFrame, scorer_factory: Callable[[], BatchScorer],
    ticker: str | Column = DEFAULT_TICKER,
) -> DataFrame:
    """Score with a Python scorer over Arrow batches. The factory runs once per
    partition. A failing batch is halved until the bad rows are alone; a row that fails
    twice gets the neutral score."""
    scored = scoring_input(processed, ticker).mapInPandas(
        batch_mapper(scorer_factory, "combined_text", "sentiment_score"),
        "source string, title string, ticker string, sentiment_score double")
    return scored.select("source", "title", "sentiment_score", "ticker")
