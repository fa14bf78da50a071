"""Similarity scores from sums, so that they can be added up in any order and place.

Spark's ``corr`` fails with a division by zero in ANSI mode when one side does not vary,
and takes no weights. Here such a group scores NULL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PairSums:
    """Sums over the pairs in which both ratings are present."""

    n: Column
    x: Column
    y: Column
    xx: Column
    yy: Column
    xy: Column
    x_varies: Column
    y_varies: Column


def pearson(s: PairSums) -> Column:
    spread_x = F.sqrt(F.greatest(s.n * s.xx - s.x * s.x, F.lit(0.0)))
    spread_y = F.sqrt(F.greatest(s.n * s.yy - s.y * s.y, F.lit(0.0)))
    score = F.try_divide(s.n * s.xy - s.x * s.y, spread_x * spread_y)
    # Rounding can leave a tiny spread where there is none, hence the exact test.
    return F.when(s.x_varies & s.y_varies, in_range(score))


def cosine(s: PairSums) -> Column:
    return in_range(F.try_divide(s.xy, F.sqrt(s.xx) * F.sqrt(s.yy)))


def in_range(score: Column) -> Column:
    """Rounding can push a score past the ends; NULL stays NULL."""
    return F.when(score.isNotNull(), F.greatest(F.least(score, F.lit(1.0)), F.lit(-1.0)))


METRICS = {"pearson": pearson, "cosine": cosine}
# The sums that each of them reads.
SUMS_OF = {
    "pearson": ("n", "x", "y", "xx", "yy", "xy", "min_x", "max_x", "min_y", "max_y"),
    "cosine": ("n", "xx", "yy", "xy"),
}


def metric(name: str):
    try:
        return METRICS[name]
    except KeyError:
        raise ValueError(f"unknown metric {name!r}, expected one of {sorted(METRICS)}") from None
