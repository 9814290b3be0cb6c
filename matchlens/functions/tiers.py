"""Ranked tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cohort ladder from low to high, and the tiers folded into its top.
LADDER = ("platinum", "emerald", "diamond", "master")
APEX = ("master", "grandmaster", "challenger")

# Order in which users are fetched.
FETCH_ORDER = ("CHALLENGER", "GRANDMASTER", "MASTER", "DIAMOND", "EMERALD", "PLATINUM")


def canonical_tier(tier: Column) -> Column:
    """Lower-case tier with every apex tier folded into ``master``."""
    lowered = F.lower(tier)
    return F.when(lowered.isin(*APEX), F.lit("master")).otherwise(lowered)


def tier_rank(tier: Column, ladder: tuple[str, ...] = LADDER) -> Column:
    """1-based position on the ladder; NULL for a tier below it."""
    lowered = F.lower(tier)
    rank = F.when(F.lit(False), F.lit(0))
    for place, name in enumerate(ladder, 1):
        names = APEX if name == "master" else (name,)
        rank = rank.when(lowered.isin(*names), F.lit(place))
    return rank


def tier_priority(tier: Column) -> Column:
    """Fetch priority of a tier, first is 1; tiers that are not listed come last."""
    position = F.array_position(F.array(*map(F.lit, FETCH_ORDER)), tier)
    return F.when(position > 0, position).otherwise(len(FETCH_ORDER) + 1).cast("int")
