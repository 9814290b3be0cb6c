"""Picks, wins, bans and damage per champion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlens.operators.cohorts import ALL, COHORT, RANK, Cohorts, match_totals, win_weight

# Grouping keys: output name to fact column.
LANE_KEYS = {"championId": "p_championId", "teamPosition": "p_teamPosition"}
ARAM_KEYS = {"championId": "p_championId"}

# Pick threshold, and the marker of an unused ban.
MIN_PICK_SHARE = 0.005
NO_BAN = -1

DAMAGE = {
    "physicalDamage": "p_physicalDamageDealtToChampions",
    "magicDamage": "p_magicDamageDealtToChampions",
    "trueDamage": "p_trueDamageDealtToChampions",
    "teamDamagePercentage": "p_teamDamagePercentage",
    "damageTakenOnTeamPercentage": "p_damageTakenOnTeamPercentage",
}


def key_columns(keys: dict[str, str]) -> list[Column]:
    return [F.col(source).alias(name) for name, source in keys.items()]


def damage_struct() -> Column:
    total = F.col("magicDamage") + F.col("physicalDamage") + F.col("trueDamage")
    return F.struct(
        "physicalDamage",
        "magicDamage",
        "trueDamage",
        total.alias("totalDamage"),
        "teamDamagePercentage",
        "damageTakenOnTeamPercentage",
    )


def champion_base(
    facts: DataFrame,
    keys: dict[str, str] = LANE_KEYS,
    cohorts: Cohorts = ALL,
    counts: dict[str, Column] | None = None,
    damage: bool = True,
) -> DataFrame:
    """Picks, wins and mean damage per key in one aggregation.

    ``counts`` adds further sums, such as the rows an option relation looks at.
    """
    sums = {"pick_cnt": F.lit(1), "win_cnt": win_weight(), **(counts or {})}
    means = {name: F.col(source) for name, source in DAMAGE.items()} if damage else {}
    grouped = cohorts.member_rows(facts).groupBy(*key_columns(keys))
    rows = cohorts.rows(grouped.agg(*cohorts.measures(sums, means)), [*sums, *means], "pick_cnt")
    if not damage:
        return rows
    return rows.withColumn("damage", damage_struct()).drop(*DAMAGE)


def keep_picked(base: DataFrame, totals: DataFrame, min_share: float = MIN_PICK_SHARE) -> DataFrame:
    """Keys picked in more than ``min_share`` of the cohort's matches, with ``total_cnt``."""
    counted = base.join(totals, COHORT)
    return counted.where(F.col("pick_cnt") / F.col("total_cnt") > min_share)


def picks(
    facts: DataFrame,
    keys: dict[str, str] = LANE_KEYS,
    cohorts: Cohorts = ALL,
    min_share: float = MIN_PICK_SHARE,
) -> DataFrame:
    """Wins, picks and number of matches of every key above the pick threshold."""
    base = champion_base(facts, keys, cohorts, damage=False)
    return keep_picked(base, match_totals(facts, cohorts), min_share)


def bans(facts: DataFrame, cohorts: Cohorts = ALL, no_ban: int = NO_BAN) -> DataFrame:
    """Matches in which each champion was banned, by one team or by both."""
    rows = cohorts.member_rows(facts).where(F.col("ban") != no_ban)
    banned = rows.groupBy("matchId", F.col("ban").alias("championId")).agg(F.max(RANK).alias(RANK))
    counted = banned.groupBy("championId").agg(*cohorts.measures({"ban_cnt": F.lit(1)}))
    return cohorts.rows(counted, ["ban_cnt"], "ban_cnt")


def damage_profile(
    facts: DataFrame, keys: dict[str, str] = LANE_KEYS, cohorts: Cohorts = ALL
) -> DataFrame:
    """Mean damage by kind and mean team shares, packed in one struct."""
    return champion_base(facts, keys, cohorts).drop("pick_cnt", "win_cnt")
