"""Daily pick and ban tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PARTICIPANTS = 10


def daily_picks(facts: DataFrame) -> DataFrame:
    """Picks and wins per day, tier, champion and position, with the day's number of matches.

    The window runs over champions and positions of one day and tier, which is
    small after the aggregation.
    """
    counted = facts.groupBy("date", "tier", "p_championId", "p_teamPosition").agg(
        F.count("*").alias("pick"), F.count_if("p_win").alias("win")
    )
    rows = F.sum("pick").over(Window.partitionBy("date", "tier"))
    return counted.withColumn("total", rows / PARTICIPANTS)


def daily_bans(facts: DataFrame) -> DataFrame:
    """Ban slots per day, tier and champion; empty slots keep their own rows."""
    return facts.groupBy("date", "tier", F.col("ban").alias("championId")).agg(
        F.count("*").alias("bans")
    )
