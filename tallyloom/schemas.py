"""Declared table layouts. Every column is nullable, as the files carry no header."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

INT, FLOAT, DOUBLE = T.IntegerType(), T.FloatType(), T.DoubleType()
TEXT, TIMESTAMP, DATE = T.StringType(), T.TimestampType(), T.DateType()


def layout(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Column names and types of the three delimited files, the article
# records and the stored tables.
ITEM_TEXT_COLUMNS = ("title", "release_date", "video_release_date", "imdb_url")
GENRES = (
    "Action", "Adventure", "Animation", "Children", "Comedy", "Crime",
    "Documentary", "Drama", "Fantasy", "Film_Noir", "Horror", "Musical",
    "Mystery", "Romance", "Sci_Fi", "Thriller", "War", "Western",
)
NOT_A_GENRE = ("movie_id", *ITEM_TEXT_COLUMNS, "unknown")

RATINGS = layout(user_id=INT, item_id=INT, rating=FLOAT, timestamp=INT)
USERS = layout(user_id=INT, age=INT, gender=TEXT, occupation=TEXT, zip_code=TEXT)
ITEMS = layout(movie_id=INT, **dict.fromkeys(ITEM_TEXT_COLUMNS, TEXT),
               **dict.fromkeys(("unknown", *GENRES), INT))
ARTICLE = layout(title=TEXT, text=TEXT, published=TEXT, url=TEXT, source=TEXT)
STORED_SENTIMENT = layout(id=TEXT, source=TEXT, ticker=TEXT, title=TEXT,
                          sentiment_score=DOUBLE, created_at=TIMESTAMP)
RUN_METRICS = layout(task_id=TEXT, start_time=TIMESTAMP, end_time=TIMESTAMP,
                     duration=DOUBLE, status=TEXT, error=TEXT, rows=T.LongType())


def genre_columns(items: DataFrame) -> list[str]:
    """Every column that is not descriptive is a genre flag; ``unknown`` is not a genre."""
    return [name for name in items.columns if name not in NOT_A_GENRE]
