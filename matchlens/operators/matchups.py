"""Counters and synergies.

A champion meets at most as many partners as there are champions and positions,
so the windows over a champion's partners are small whatever the data size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlens.functions import rate
from matchlens.operators.cohorts import ALL, COHORT, RANK, Cohorts, win_weight
from matchlens.operators.joins import join_null_safe
from matchlens.operators.options import without_place
from matchlens.operators.picks import ARAM_KEYS, LANE_KEYS, champion_base, key_columns

# Thresholds of a matchup, and lengths of the lists.
MIN_SHARE = 0.01
EVEN = 0.5
MIN_GAMES = 50
COUNTERS = 10
SYNERGIES = 40
ARAM_TOP = 10

OPPONENT = ["o_championId"]
LANE_PARTNER = {"s_championId": "championId", "s_teamPosition": "teamPosition"}


def ranked(matchups: DataFrame, keys: list[str], partner: list[str], k: int, worst_first: bool) -> DataFrame:
    """First ``k`` partners of each key by win rate; ties by games, then partner."""
    by_rate = F.asc("win_rate") if worst_first else F.desc("win_rate")
    order = Window.partitionBy(COHORT, *keys).orderBy(
        by_rate, F.desc("select_cnt"), *map(F.asc, partner)
    )
    return matchups.withColumn("row_num", F.row_number().over(order)).where(F.col("row_num") <= k)


def with_rates(counts: DataFrame) -> DataFrame:
    return counts.withColumns(
        {
            "win_rate": rate(F.col("win_cnt"), F.col("select_cnt")),
            "pick_rate": rate(F.col("select_cnt"), F.col("total_cnt")),
        }
    )


def counter(
    facts: DataFrame,
    keys: dict[str, str] = LANE_KEYS,
    cohorts: Cohorts = ALL,
    min_share: float = MIN_SHARE,
    max_rate: float = EVEN,
    min_games: int = MIN_GAMES,
    k: int = COUNTERS,
) -> DataFrame:
    """Lane opponents a champion loses to most often."""
    met = cohorts.member_rows(facts).where(F.col("o_championId").isNotNull())
    weights = {"select_cnt": F.lit(1), "win_cnt": win_weight()}
    grouped = met.groupBy(*key_columns(keys), *OPPONENT).agg(*cohorts.measures(weights))
    counts = cohorts.rows(grouped, list(weights), "select_cnt")
    whole = Window.partitionBy(COHORT, *keys)
    rates = with_rates(counts.withColumn("total_cnt", F.sum("select_cnt").over(whole)))
    kept = rates.where(
        (F.col("pick_rate") >= min_share)
        & (F.col("win_rate") < max_rate)
        & (F.col("select_cnt") >= min_games)
    )
    return ranked(kept, list(keys), OPPONENT, k, worst_first=True)


def pair_counts(
    facts: DataFrame,
    keys: dict[str, str],
    partner: dict[str, str],
    within: list[str],
    apart: str,
    cohorts: Cohorts = ALL,
) -> DataFrame:
    """Games and wins of every (key, partner) pair that met in the same group.

    A group is the rows that agree in ``within``; two of them pair up when
    ``apart`` differs. Equal rows of a group are counted first, on the map side
    already. What is then gathered is no larger than the number of different
    champions, positions and outcomes, so one match holding a large part of all
    rows costs one small group. Pairs are made inside the gathered row: facts
    are read once and move twice, and nothing is joined. Both members' games
    are in a cohort when the lower of their ranks is.
    """
    known = reduce(lambda x, y: x & y, [F.col(name).isNotNull() for name in within])
    counted = (
        cohorts.member_rows(facts)
        .where(known)
        .groupBy(*within, *key_columns(keys), F.col(apart).alias("apart"), "p_win", RANK)
        .agg(F.count("*").alias("n"))
    )
    member = F.struct(*keys, "apart", "p_win", RANK, "n")
    groups = counted.groupBy(*within).agg(F.collect_list(member).alias("members"))
    firsts = groups.select(F.explode("members").alias("a"), "members")
    # A second explode and a filter are compiled, a lambda over the members is not.
    met = firsts.select("a", F.explode("members").alias("b")).where(F.col("a.apart") != F.col("b.apart")).select(
        *[F.col(f"a.{key}").alias(key) for key in keys],
        *[F.col(f"b.{key}").alias(name) for name, key in partner.items()],
        F.least(f"a.{RANK}", f"b.{RANK}").alias(RANK),
        F.col("a.p_win").alias("p_win"),
        (F.col("a.n") * F.col("b.n")).alias("games"),
    )
    weights = {"select_cnt": F.col("games"), "win_cnt": F.when(F.col("p_win"), F.col("games"))}
    grouped = met.groupBy(*keys, *partner).agg(*cohorts.measures(weights))
    return cohorts.rows(grouped, list(weights), "select_cnt")


def with_own_picks(
    pairs: DataFrame, facts: DataFrame, keys: dict[str, str], cohorts: Cohorts
) -> DataFrame:
    """Pair counts with the key's own number of games as ``total_cnt``."""
    own = champion_base(facts, keys, cohorts, damage=False).drop("win_cnt")
    return join_null_safe(pairs, own.withColumnRenamed("pick_cnt", "total_cnt"), [COHORT, *keys])


def synergy(
    facts: DataFrame,
    cohorts: Cohorts = ALL,
    min_share: float = MIN_SHARE,
    min_rate: float = EVEN,
    min_games: int = MIN_GAMES,
    k: int = SYNERGIES,
) -> DataFrame:
    """Teammates in other positions a champion wins with most often."""
    pairs = pair_counts(
        facts, LANE_KEYS, LANE_PARTNER, ["matchId", "p_teamId"], "p_teamPosition", cohorts
    )
    rates = with_rates(with_own_picks(pairs, facts, LANE_KEYS, cohorts))
    kept = rates.where(
        (F.col("win_rate") > min_rate)
        & (F.col("pick_rate") > min_share)
        & (F.col("select_cnt") >= min_games)
    )
    return ranked(kept, list(LANE_KEYS), list(LANE_PARTNER), k, worst_first=False)


def _aram_top(
    facts: DataFrame,
    partner: str,
    within: list[str],
    apart: str,
    cohorts: Cohorts,
    min_share: float,
    k: int,
    ascending: bool,
) -> DataFrame:
    pairs = pair_counts(facts, ARAM_KEYS, {partner: "championId"}, within, apart, cohorts)
    rates = with_rates(with_own_picks(pairs, facts, ARAM_KEYS, cohorts))
    kept = rates.where(F.col("pick_rate") >= min_share)
    return ranked(kept, list(ARAM_KEYS), [partner], k, worst_first=ascending)


def aram_synergy(
    facts: DataFrame, cohorts: Cohorts = ALL, min_share: float = MIN_SHARE, k: int = ARAM_TOP
) -> DataFrame:
    """Other champions of the team a champion wins with most often."""
    return _aram_top(
        facts, "s_championId", ["matchId", "p_teamId"], "p_championId", cohorts, min_share, k, False
    )


def aram_counter(
    facts: DataFrame,
    cohorts: Cohorts = ALL,
    min_share: float = MIN_SHARE,
    k: int = ARAM_TOP,
    ascending: bool = False,
) -> DataFrame:
    """Enemy champions by win rate, by default the ones most often won against."""
    return _aram_top(
        facts, "c_championId", ["matchId"], "p_teamId", cohorts, min_share, k, ascending
    )


def nest_ranked(
    matchups: DataFrame, keys: dict[str, str], partner: list[str], name: str
) -> DataFrame:
    """One row per key with its partners as an array ordered by rank."""
    shown = [*partner, "win_rate", "pick_rate", "select_cnt"]
    ordered: Column = F.sort_array(F.collect_list(F.struct("row_num", *shown)))
    return matchups.groupBy(COHORT, *keys).agg(without_place(ordered, shown).alias(name))
