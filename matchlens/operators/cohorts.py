"""Cumulative tier cohorts, version and date selections.

A match of tier *t* counts in every cohort up to *t*. The rows are not copied
once per cohort: an aggregation keeps one conditional measure per cohort and
the few aggregated rows are turned into one row per cohort afterwards. All
cohorts therefore share one scan and one shuffle.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlens.functions import LADDER, canonical_tier, major_minor, tier_rank, version_order

COHORT = "cohort"
RANK = "tierRank"


@dataclass(frozen=True)
class Cohorts:
    """Cohorts to compute; without a ladder there is one, of all rows.

    ``canonical`` says that facts hold canonical tiers, as stored facts do; the
    tiers of the ladder are then a filter that reaches the files.
    """

    ladder: tuple[str, ...] = ()
    canonical: bool = False

    @property
    def names(self) -> tuple[str, ...]:
        return self.ladder or ("all",)

    def member_rows(self, facts: DataFrame) -> DataFrame:
        """Rows that belong to a cohort, with their rank on the ladder."""
        if not self.ladder:
            return facts.withColumn(RANK, F.lit(1))
        if self.canonical:
            rank = F.array_position(F.array(*map(F.lit, self.ladder)), F.col("tier"))
            return facts.where(F.col("tier").isin(*self.ladder)).withColumn(RANK, rank.cast("int"))
        return facts.withColumn(RANK, tier_rank(F.col("tier"), self.ladder)).where(
            F.col(RANK).isNotNull()
        )

    def within(self, level: int, value: Column) -> Column:
        """Value on rows of the cohort at ``level``, NULL elsewhere."""
        return F.when(F.col(RANK) > level, value) if self.ladder else value

    def measures(
        self, counts: dict[str, Column], averages: dict[str, Column] | None = None
    ) -> list[Column]:
        """Aggregates for every cohort: sums of ``counts``, means of ``averages``."""
        made = []
        for level in range(len(self.names)):
            for name, weight in counts.items():
                total = F.coalesce(F.sum(self.within(level, weight)), F.lit(0))
                made.append(total.cast("bigint").alias(f"{name}_{level}"))
            for name, value in (averages or {}).items():
                made.append(F.avg(self.within(level, value)).alias(f"{name}_{level}"))
        return made

    def rows(self, aggregated: DataFrame, measures: list[str], present: str) -> DataFrame:
        """One row per cohort out of the columns :meth:`measures` made.

        A group is in a cohort when its ``present`` count is above zero.
        """
        made = {f"{name}_{level}" for name in measures for level in range(len(self.names))}
        keys = [name for name in aggregated.columns if name not in made]
        entries = [
            F.struct(
                F.lit(cohort).alias(COHORT),
                *[F.col(f"{name}_{level}").alias(name) for name in measures],
            )
            for level, cohort in enumerate(self.names)
        ]
        spread = aggregated.select(*keys, F.inline(F.array(*entries)))
        return spread.where(F.col(present) > 0).select(COHORT, *keys, *measures)


ALL = Cohorts()
LADDER_COHORTS = Cohorts(LADDER)
STORED_COHORTS = Cohorts(LADDER, canonical=True)


def win_weight() -> Column:
    return F.when(F.col("p_win"), F.lit(1))


def with_canonical_values(facts: DataFrame) -> DataFrame:
    """Facts with folded tiers and ``major.minor`` versions."""
    return facts.withColumns(
        {
            "tier": canonical_tier(F.col("tier")),
            "gameVersion": major_minor(F.col("gameVersion")),
        }
    )


def latest_version(facts: DataFrame) -> DataFrame:
    """The greatest version, compared by number, as one row.

    Versions are few, so they are made distinct before they are taken apart.
    """
    versions = facts.select("gameVersion").distinct()
    newest = F.max_by("gameVersion", version_order(F.col("gameVersion")))
    return versions.agg(newest.alias("gameVersion"))


def finished_games(facts: DataFrame) -> DataFrame:
    """Without games ended by an early surrender."""
    return facts.where(~F.col("p_gameEndedInEarlySurrender"))


def current_version(facts: DataFrame, version: str | None = None) -> DataFrame:
    """Finished games of one version, by default the latest one in the facts.

    The latest version stays inside the plan as a scalar subquery.
    """
    wanted = F.lit(version) if version else latest_version(facts).scalar()
    return finished_games(facts).where(F.col("gameVersion") == wanted)


def recent_days(facts: DataFrame, as_of: datetime.date, days: int = 14) -> DataFrame:
    """Finished games from ``days`` before ``as_of`` on."""
    start = as_of - datetime.timedelta(days=days)
    return finished_games(facts).where(F.col("date") >= F.lit(start))


def recent_days_in_zone(
    facts: DataFrame, as_of: Column, zone: str = "Asia/Seoul", days: int = 14
) -> DataFrame:
    """As :func:`recent_days`, counted back from the calendar day of a UTC time in a zone."""
    today = F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), as_of))
    return finished_games(facts).where(F.col("date") >= F.date_sub(today, days))


def retained(df: DataFrame, as_of: datetime.date, days: int = 14, column: str = "date") -> DataFrame:
    """Rows that a retention of ``days`` keeps."""
    return df.where(F.col(column) > F.lit(as_of - datetime.timedelta(days=days)))


def tier_filter(facts: DataFrame, lowest: str, ladder: tuple[str, ...] = LADDER) -> DataFrame:
    """Rows of one cohort: ``lowest`` and every tier above it."""
    wanted = ladder[ladder.index(lowest) :]
    return facts.where(canonical_tier(F.col("tier")).isin(*wanted))


def match_totals(facts: DataFrame, cohorts: Cohorts = ALL) -> DataFrame:
    """Exact number of different matches per cohort."""
    rows = cohorts.member_rows(facts)
    matches = rows.groupBy("matchId").agg(F.max(RANK).alias(RANK))
    totals = matches.agg(*cohorts.measures({"total_cnt": F.lit(1)}))
    return cohorts.rows(totals, ["total_cnt"], "total_cnt")


def daily_match_sketches(facts: DataFrame, bits: int = 12) -> DataFrame:
    """A mergeable sketch of the different matches of each day and tier, ``2 ** bits`` registers.

    A day's sketch is stored once; any number of days or tiers are merged without reading facts again.
    """
    return facts.groupBy("date", "tier").agg(F.hll_sketch_agg("matchId", bits).alias("sketch"))


def merged_match_totals(sketches: DataFrame, cohorts: Cohorts) -> DataFrame:
    """Estimated number of different matches per cohort, out of daily sketches.

    The standard error is about ``1.04 / sqrt(2 ** bits)``: 1.6 per cent with 12 bits.
    """
    ranked = cohorts.member_rows(sketches)
    parts = [F.hll_union_agg(cohorts.within(level, F.col("sketch"))).alias(f"sketch_{level}") for level in range(len(cohorts.names))]
    rows = [
        F.struct(F.lit(name).alias(COHORT), F.hll_sketch_estimate(f"sketch_{level}").alias("total_cnt")) for level, name in enumerate(cohorts.names)
    ]
    return ranked.agg(*parts).select(F.inline(F.array(*rows))).where(F.col("total_cnt") > 0)
