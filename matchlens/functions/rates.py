"""Rates, score and grade."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calibrated weights of win rate and presence around the mean score.
BASE_SCORE = 50.0
WIN_WEIGHT = 1.6
PRESENCE_WEIGHT = 3.5

# Lowest score of each grade, best first.
GRADES = ((56.0, "OP"), (54.5, "1"), (51.5, "2"), (48.5, "3"), (45.5, "4"))
LOWEST_GRADE = "5"


def rate(part: Column, whole: Column) -> Column:
    """Share as a double; NULL over zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def champion_score(
    win_rate: Column, pick_rate: Column, position_cnt: Column, ban_rate: Column | None = None
) -> Column:
    """Score from the win rate and the presence relative to an even share of picks.

    A NULL ban rate, a rate outside the logarithm's domain or exactly 200
    candidates give a NULL score.
    """
    presence = F.ln(pick_rate) - F.ln(F.lit(2.0) / position_cnt)
    if ban_rate is not None:
        presence = presence - F.ln(F.lit(1.0) - ban_rate)
    strength = F.lit(WIN_WEIGHT) * (win_rate * 100.0 - 50.0)
    return F.lit(BASE_SCORE) + strength + F.try_divide(
        F.lit(PRESENCE_WEIGHT) * presence, F.ln(F.lit(200.0) / position_cnt)
    )


def grade(score: Column) -> Column:
    """Grade of a score; a NULL score gets the lowest."""
    result = None
    for least, name in GRADES:
        result = F.when(score >= least, name) if result is None else result.when(score >= least, name)
    return result.otherwise(LOWEST_GRADE)
