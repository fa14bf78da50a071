"""Numbers and ranks of any size without sorting a group in one task.

Rows are dealt to tasks by ranges of the whole sort key, so that a group of any size is
spread over as many tasks as it needs; rows with equal keys are told apart by a random
number, so that even these spread. What a row lacks to its number is how many rows come
before its range, and those counts are one row per task.

The ranges are written to the scratch folder before they are counted: counts and rows then
speak of the same ranges, also if a task has to run again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.settings import written_table

SPREAD, SLOT, RANGE = "spread__", "slot__", "range__"
# A slot is the number of the range times this, plus the place in the range.
RANGE_BITS = 33


def in_ranges(rows: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """The rows, written in ranges of ``order``, each with its range and its place there."""
    spread = rows.withColumn(SPREAD, F.rand(7))
    placed = (spread.repartitionByRange(*order, F.col(SPREAD))
              .sortWithinPartitions(*order, F.col(SPREAD)).drop(SPREAD)
              .withColumn(SLOT, F.monotonically_increasing_id()))
    return written_table(placed, label).withColumn(RANGE, F.shiftright(SLOT, RANGE_BITS))


def place_in_range() -> Column:
    return F.col(SLOT).bitwiseAND((1 << RANGE_BITS) - 1)


def numbered(rows: DataFrame, order: Sequence[Column], name: str = "number", start: int = 1,
             label: str = "numbered") -> DataFrame:
    """Rows numbered without gaps in a given order. Rows that are equal in ``order`` get
    their numbers in any order, so these depend on nothing but the rows if ``order`` tells
    all that differ apart."""
    placed = in_ranges(rows, order, label)
    counts = sorted(placed.groupBy(RANGE).count().collect())  # one row per range
    before = accumulate((row["count"] for row in counts), initial=start)
    offsets = rows.sparkSession.createDataFrame(
        [(row[RANGE], first) for row, first in zip(counts, before)], f"{RANGE} long, first__ long")
    return (placed.join(offsets, RANGE)
            .withColumn(name, F.col("first__") + place_in_range())
            .drop(RANGE, SLOT, "first__"))


def ranked_within(rows: DataFrame, group: Sequence[str], order: Sequence[Column],
                  name: str = "position", label: str = "ranked") -> DataFrame:
    """Rows with their place in the group, as ``row_number`` gives it; NULL is a group."""
    placed = in_ranges(rows, [*map(F.col, group), *order], label)
    spans = placed.groupBy(*group, RANGE).agg(
        F.min(place_in_range()).alias("first__"), F.count("*").alias("rows__"))
    # One row per group and range it touches.
    earlier = Window.partitionBy(*group).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        *[F.col(column).alias(f"{column}__") for column in group], F.col(RANGE).alias("of__"),
        (F.coalesce(F.sum("rows__").over(earlier), F.lit(0)) - F.col("first__")).alias("shift__"))
    same = reduce(and_, [placed[column].eqNullSafe(spans[f"{column}__"]) for column in group])
    return (placed.join(spans, (placed[RANGE] == spans["of__"]) & same)
            .withColumn(name, place_in_range() + F.col("shift__") + 1)
            .select(*rows.columns, name))
