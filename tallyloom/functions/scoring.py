"""Sentiment scorers. A scorer maps text to a number in [0, 1]."""

from __future__ import annotations

import logging
import math
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

logger = logging.getLogger(__name__)

# Fixed value: the score of a text that could not be scored.
NEUTRAL = 0.5

BatchScorer = Callable[[pd.Series], pd.Series]


def lexicon_scorer(positive: Sequence[str], negative: Sequence[str]) -> Callable[[Column], Column]:
    """A scorer of Spark expressions: the share of positive words among all words of the two
    lists, neutral for a text without any or without text. Words are what blanks separate."""
    lists = {"for": list(positive), "against": list(negative)}
    if not all(lists.values()):
        raise ValueError("both word lists need a word")

    def score(text: Column) -> Column:
        words = F.split(F.coalesce(text, F.lit("")), r"\s+")
        good, bad = (F.size(F.filter(words, lambda word: word.isin(some))) for some in lists.values())
        return F.coalesce(F.try_divide(good, good + bad), F.lit(NEUTRAL))

    return score


def checked(scorer: BatchScorer, texts: pd.Series) -> list[float]:
    """Scores of a batch; an answer of the wrong length or a score that is no number in
    [0, 1] counts as a failure."""
    scores = [float(score) for score in scorer(texts)]
    if len(scores) != len(texts):
        raise ValueError(f"{len(scores)} scores for {len(texts)} texts")
    if not all(math.isfinite(score) and 0 <= score <= 1 for score in scores):
        raise ValueError("a score is not within 0 and 1")
    return scores


def score_batch(scorer: BatchScorer, texts: pd.Series) -> pd.Series:
    """Score a batch. One that fails is halved, and so on down to single rows; a single row
    is tried twice and then gets the neutral score.

    A batch of n rows takes one call if nothing fails; each bad row adds at most two calls
    per halving. If everything fails, there are less than 3 n calls.
    """
    scores = [NEUTRAL] * len(texts)
    parts = [(0, len(texts), 1)] if len(texts) else []
    while parts:
        begin, end, attempt = parts.pop()
        try:
            scores[begin:end] = checked(scorer, texts.iloc[begin:end])
        except Exception as error:  # a scorer is foreign code and may raise anything
            logger.warning("scorer failed on %d rows: %s", end - begin, error)
            if end - begin > 1:
                middle = (begin + end) // 2
                parts += [(middle, end, 1), (begin, middle, 1)]
            elif attempt == 1:
                parts.append((begin, end, 2))
    return pd.Series(scores, index=texts.index, dtype="float64")


def batch_mapper(
    scorer_factory: Callable[[], BatchScorer], text_column: str, score_column: str
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A ``mapInPandas`` function: one scorer (one client, one model) per partition."""

    def score_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = scorer_factory()
        for batch in batches:
            scores = score_batch(scorer, batch[text_column])
            yield batch.drop(columns=text_column).assign(**{score_column: scores})

    return score_partition
