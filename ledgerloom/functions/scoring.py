"""Score, class and label columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Recency and frequency scores of each customer segment; money counts for none.
SEGMENTS = {
    "Одноразовые": ((1, 2, 3), 1),
    "Ушедшие": ((1, 2, 3), 5),
    "Недавние": ((4,), 1),
    "Потенциально - постоянные": ((4, 5), 5),
    "Новенькие": ((5,), 1),
}

# Line widths of a drawn edge by amount class, thinnest first.
EDGE_WIDTHS = (0.1, 0.3, 0.5, 1.0, 2.0, 3.0)
WIDEST_EDGE = 5.0


def step_score(value: Column, cuts: Sequence[Column], scores: Sequence[float | int]) -> Column:
    """Score of the first cut that is not below ``value``; the last score above all cuts."""
    if len(scores) != len(cuts) + 1:
        raise ValueError("one more score than cuts is needed")
    choice = F.when(value <= cuts[0], F.lit(scores[0]))
    for cut, score in zip(cuts[1:], scores[1:-1]):
        choice = choice.when(value <= cut, F.lit(score))
    return choice.otherwise(F.lit(scores[-1]))


def low_is_good(value: Column, cuts: Sequence[Column]) -> Column:
    """Quintile score 5 to 1: small values score high."""
    return step_score(value, cuts, (5, 4, 3, 2, 1))


def high_is_good(value: Column, cuts: Sequence[Column]) -> Column:
    """Quintile score 1 to 5: large values score high."""
    return step_score(value, cuts, (1, 2, 3, 4, 5))


def segment_name(recency: Column, frequency: Column) -> Column:
    """Customer segment of two scores; NULL for scores no segment covers."""
    name = F.lit(None).cast("string")
    for segment, (recencies, own) in SEGMENTS.items():
        name = F.when(recency.isin(list(recencies)) & (frequency == own), segment).otherwise(name)
    return name


def verdict(p_value: Column, alpha: float = 0.05) -> Column:
    """Text decision about a null hypothesis."""
    return (
        F.when(p_value.isNull(), F.lit(None).cast("string"))
        .when(p_value <= alpha, F.lit("reject H0: the groups differ"))
        .otherwise(F.lit("keep H0: no difference found"))
    )
