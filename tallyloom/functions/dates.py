"""ISO-8601 dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the spellings that count as an ISO date. Spark's own cast is more
# lenient (it reads "2024" as a date), so the shape is checked first.
ISO_DATE = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}(:\d{2}(:\d{2}(\.\d{3}(\d{3})?)?)?)?([+-]\d{2}:\d{2})?)?$"
)


def with_offset(text: Column) -> Column:
    """Spell the UTC suffix ``Z`` as an offset."""
    return F.replace(text, F.lit("Z"), F.lit("+00:00"))


def iso_timestamp(text: Column) -> Column:
    """Timestamp of an ISO date, NULL for anything else. Never fails in ANSI mode."""
    spelled = with_offset(text)
    # Spark's parser wants minutes and seconds in front of an offset.
    for time in (r"\d{2}", r"\d{2}:\d{2}"):
        spelled = F.regexp_replace(spelled, rf"^(\S{{10}}[T ]{time})($|[+-])", "$1:00$2")
    return F.when(with_offset(text).rlike(ISO_DATE), F.try_to_timestamp(spelled))


def publish_time(text: Column, ingested_at: dt.datetime) -> Column:
    """The publish date, or the time of ingestion where there is none or a bad one.

    The ingestion time is an argument, so that a rerun gives the same rows."""
    return F.coalesce(iso_timestamp(text), timestamp_literal(ingested_at))


def timestamp_literal(moment: dt.datetime) -> Column:
    """A literal that does not depend on the machine's zone; naive means UTC."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    micros = (moment - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros))
