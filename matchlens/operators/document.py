"""Scored statistics document per champion."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlens.functions import champion_score, grade, rate
from matchlens.operators.cohorts import (
    ALL,
    COHORT,
    LADDER_COHORTS,
    Cohorts,
    current_version,
    match_totals,
    recent_days,
    with_canonical_values,
)
from matchlens.operators.matchups import (
    LANE_PARTNER,
    MIN_GAMES,
    OPPONENT,
    aram_counter,
    aram_synergy,
    counter,
    nest_ranked,
    synergy,
)
from matchlens.operators.options import families, nest_options, option_shares, option_totals
from matchlens.operators.picks import ARAM_KEYS, LANE_KEYS, bans, champion_base, keep_picked


def with_relations(
    picked: DataFrame, relations: list[DataFrame], keys: list[str], banned: DataFrame | None = None
) -> DataFrame:
    """Picks left-joined to ban counts by champion and to every relation by key."""
    document = picked
    if banned is not None:
        document = document.join(banned, [COHORT, "championId"], "left")
    for relation in relations:
        document = document.join(relation, [COHORT, *keys], "left")
    return document


def with_score(
    document: DataFrame, candidates: list[str] | None, null_ban_as_zero: bool = False
) -> DataFrame:
    """Rates, number of candidates, score and grade.

    A champion nobody banned has no ban rate and so no score; it gets the
    lowest grade. ``null_ban_as_zero`` scores it as banned in no match.
    ``candidates`` are the columns whose rows compete; None leaves each row alone.
    """
    banned = "ban_cnt" in document.columns
    rates = {
        "win_rate": rate(F.col("win_cnt"), F.col("pick_cnt")),
        "pick_rate": rate(F.col("pick_cnt"), F.col("total_cnt")),
        "position_cnt": F.lit(1).cast("bigint")
        if candidates is None
        else F.count("*").over(Window.partitionBy(COHORT, *candidates)),
    }
    ban_rate = None
    if banned:
        count = F.coalesce("ban_cnt", F.lit(0)) if null_ban_as_zero else F.col("ban_cnt")
        rates["ban_rate"] = rate(count, F.col("total_cnt"))
        ban_rate = F.col("ban_rate")
    score = champion_score(F.col("win_rate"), F.col("pick_rate"), F.col("position_cnt"), ban_rate)
    scored = document.withColumns(rates).withColumn("score", score)
    return scored.withColumn("tier", grade(F.col("score"))).drop("win_cnt", "total_cnt", "ban_cnt")


def _option_documents(facts: DataFrame, keys: dict[str, str], cohorts: Cohorts) -> DataFrame:
    """Picks, damage and all option arrays of the keys above the pick threshold."""
    chosen = families()
    base = champion_base(facts, keys, cohorts, option_totals(chosen))
    picked = keep_picked(base, match_totals(facts, cohorts)).withColumnRenamed(
        "total_cnt", "match_cnt"
    )
    shares = option_shares(facts, chosen, keys, cohorts, picked)
    nested = nest_options(shares, chosen, keys, ("pick_cnt", "pick_win_cnt", "match_cnt", "damage"))
    return nested.withColumnsRenamed({"pick_win_cnt": "win_cnt", "match_cnt": "total_cnt"})


def champion_documents(
    facts: DataFrame,
    as_of: datetime.date,
    days: int = 14,
    cohorts: Cohorts = LADDER_COHORTS,
    min_games: int = MIN_GAMES,
    null_ban_as_zero: bool = False,
) -> DataFrame:
    """Documents of the lane queues per cohort, champion and position, best score first.

    Picks and options are of the latest version; matchups are of the last days.
    Cohorts that are ``canonical`` take the tiers and versions of the facts as they are stored.
    """
    known = facts if cohorts.canonical else with_canonical_values(facts)
    current = current_version(known)
    recent = recent_days(known, as_of, days)
    keys = list(LANE_KEYS)
    relations = [
        nest_ranked(counter(recent, cohorts=cohorts, min_games=min_games), LANE_KEYS, OPPONENT, "counter"),
        nest_ranked(
            synergy(recent, cohorts, min_games=min_games), LANE_KEYS, list(LANE_PARTNER), "synergy"
        ),
    ]
    options = _option_documents(current, LANE_KEYS, cohorts)
    document = with_relations(options, relations, keys, bans(current, cohorts))
    scored = with_score(document, ["teamPosition"], null_ban_as_zero)
    return scored.orderBy(F.desc_nulls_last("score"), COHORT, *keys)


def aram_documents(
    facts: DataFrame, as_of: datetime.date, days: int = 14, compete: bool = False
) -> DataFrame:
    """Documents of the aram queue per champion, best score first.

    By default the number of candidates is 1 for every champion; ``compete``
    counts all champions instead.
    """
    known = with_canonical_values(facts)
    current = current_version(known)
    recent = recent_days(known, as_of, days)
    relations = [
        nest_ranked(aram_counter(recent), ARAM_KEYS, ["c_championId"], "counter"),
        nest_ranked(aram_synergy(recent), ARAM_KEYS, ["s_championId"], "synergy"),
    ]
    document = with_relations(_option_documents(current, ARAM_KEYS, ALL), relations, list(ARAM_KEYS))
    scored = with_score(document, [] if compete else None)
    return scored.orderBy(F.desc_nulls_last("score"), "championId").drop(COHORT)
