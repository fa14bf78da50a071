"""Age groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bound (inclusive), upper bound (exclusive), label.
AGE_BANDS = ((20, 25, "20-25"), (25, 35, "25-35"), (35, 45, "35-45"))
OTHER_AGES = "45 and older"


def age_group(age: Column, under_20: str | None = None) -> Column:
    """Label of the band. Ages below the first band share the last label, unless
    ``under_20`` names a group of their own."""
    lowest = AGE_BANDS[0][0]
    bands = [(age >= low) & (age < high) for low, high, _ in AGE_BANDS]
    labels = [label for _, _, label in AGE_BANDS]
    if under_20 is not None:
        bands.append(age < lowest)
        labels.append(under_20)
    branches = F.when(bands[0], labels[0])
    for band, label in zip(bands[1:], labels[1:]):
        branches = branches.when(band, label)
    return branches.otherwise(OTHER_AGES)
