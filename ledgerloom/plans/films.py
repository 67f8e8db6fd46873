"""Film records cut out of listing texts, and their average rating."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numeric import round_even
from ledgerloom.functions.text import nth_part, remove


def clean_films(raw: DataFrame) -> DataFrame:
    """``heading, rating, genre, credits`` texts to title, year, director, actors, rating.

    The heading is ``number / title / year`` on three lines; the credits hold the
    directors up to "Stars" and the actors after "Stars:".  Of the heading "Directors"
    only the plural ``s`` goes, never a letter of a name.  Missing parts are NULL.
    """
    people = F.col("credits")
    directors = F.regexp_replace(nth_part(people, "Stars", 1), "Directors?", "")
    return raw.select(
        *[c for c in raw.columns if c not in ("heading", "rating", "genre", "credits")],
        nth_part(F.col("heading"), "\n", 2).alias("title"),
        nth_part(F.col("heading"), "\n", 3).alias("year"),
        "genre",
        remove(directors, "\n", ":").alias("director"),
        remove(nth_part(people, "Stars:", 2), "\n").alias("actors"),
        F.col("rating").try_cast("double").alias("rating"),
    )


def average_rating(films: DataFrame) -> DataFrame:
    """Mean rating rounded to 2 digits (one row)."""
    return films.agg(round_even(F.avg("rating"), 2).alias("avg_rating"))
