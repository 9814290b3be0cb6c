"""Option shares: how often each choice is made, and how often it wins.

All families (runes, spells, items, skills, game length) come from one scan and
one shuffle: ``GROUPING SETS`` emits a row once per family before the map-side
aggregation. A group's total is an aggregate of its own joined back, not a
window over the options, so a champion with very many different options never
has to fit in one task. What is collected afterwards is bounded: at most
``1 / min_share`` options of a family can hold ``min_share`` of a total.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlens.functions import duration_bucket, rate
from matchlens.operators.cohorts import ALL, COHORT, Cohorts, win_weight
from matchlens.operators.joins import join_null_safe
from matchlens.operators.picks import LANE_KEYS, champion_base, key_columns

# Smallest share of an option, and lengths of the compared sequences.
MIN_OPTION_SHARE = 0.01
BUILD_LENGTH = 3
SKILL_LENGTH = 13

FAMILY = "family"


@dataclass(frozen=True)
class Family:
    """One kind of choice.

    ``columns`` are the grouped values. With ``where``, other rows count neither
    as an option nor in the total; the first column must not be NULL where it
    holds. ``present`` changes a value after grouping. ``min_share`` None keeps
    every option. ``by_value`` orders a collected family by its values instead
    of by how often they were chosen.
    """

    name: str
    columns: dict[str, Column]
    where: Column | None = None
    present: Callable[[Column], Column] | None = None
    min_share: float | None = MIN_OPTION_SHARE
    by_value: bool = False

    @property
    def total(self) -> str:
        return f"total_{self.name}"

    def total_weight(self) -> Column:
        return F.lit(1) if self.where is None else F.when(self.where, F.lit(1))

    def grouped(self) -> list[Column]:
        made = []
        for name, value in self.columns.items():
            kept = value if self.where is None else F.when(self.where, value)
            made.append(kept.alias(name))
        return made


def long_enough(column: str, length: int) -> Column:
    return F.size(column) >= length


def families(normalize_start: bool = False) -> list[Family]:
    """Every family of the statistics document.

    Starting items are grouped in their own order and shown sorted, so equal
    sets bought in a different order stay apart; ``normalize_start`` merges them.
    """
    start = F.col("p_itemStart")
    return [
        Family("statPerks", {"statPerks": F.col("p_statPerks")}),
        Family(
            "perks",
            {"primaryStyles": F.col("p_primaryStyles"), "subStyles": F.col("p_subStyles")},
        ),
        Family(
            "summonerSpell",
            {"summoner1Id": F.col("p_summoner1Id"), "summoner2Id": F.col("p_summoner2Id")},
        ),
        Family("itemStart", {"itemStart": F.array_sort(start)})
        if normalize_start
        else Family("itemStart", {"itemStart": start}, present=F.array_sort),
        Family("itemMiddle", {"itemMiddle": F.col("p_itemMiddle")}),
        Family(
            "itemBuild",
            {"itemBuild": F.slice("p_itemBuild", 1, BUILD_LENGTH)},
            where=long_enough("p_itemBuild", BUILD_LENGTH),
        ),
        Family(
            "skillTree",
            {"skillTree": F.slice("p_skillTree", 1, SKILL_LENGTH)},
            where=long_enough("p_skillTree", SKILL_LENGTH),
        ),
        power_curve_family(),
    ]


def power_curve_family() -> Family:
    return Family(
        "powerCurve",
        {"minute": duration_bucket(F.col("gameDuration"))},
        min_share=None,
        by_value=True,
    )


def option_counts(
    facts: DataFrame, chosen: list[Family], keys: dict[str, str], cohorts: Cohorts
) -> DataFrame:
    """Rows and wins of every option, for all families in one aggregation."""
    options = [name for family in chosen for name in family.columns]
    slim = cohorts.member_rows(facts).select(
        *key_columns(keys), "tierRank", "p_win", *[c for family in chosen for c in family.grouped()]
    )
    sets = [[*map(F.col, keys), *map(F.col, family.columns)] for family in chosen]
    marks = [F.grouping(next(iter(family.columns))).alias(f"off_{family.name}") for family in chosen]
    weights = {"select_cnt": F.lit(1), "win_cnt": win_weight()}
    counted = slim.groupingSets(sets, *keys, *options).agg(*marks, *cohorts.measures(weights))

    name = F.coalesce(
        *[F.when(F.col(f"off_{family.name}") == 0, F.lit(family.name)) for family in chosen]
    )
    kept = counted.withColumn(FAMILY, name).drop(*[f"off_{family.name}" for family in chosen])
    for family in chosen:
        if family.where is not None:
            left_out = (F.col(FAMILY) == family.name) & F.col(next(iter(family.columns))).isNull()
            kept = kept.where(~left_out)
    return cohorts.rows(kept, list(weights), "select_cnt")


def option_totals(chosen: list[Family]) -> dict[str, Column]:
    """Sums to add to :func:`champion_base` so that it carries every family's total."""
    return {family.total: family.total_weight() for family in chosen}


def option_shares(
    facts: DataFrame,
    chosen: list[Family],
    keys: dict[str, str] = LANE_KEYS,
    cohorts: Cohorts = ALL,
    base: DataFrame | None = None,
) -> DataFrame:
    """Options of each key with ``win_rate``, ``pick_rate`` and ``select_cnt``.

    ``base`` is a :func:`champion_base` carrying :func:`option_totals`; its
    further columns are kept, and keys it lacks are dropped.
    """
    if base is None:
        base = champion_base(facts, keys, cohorts, option_totals(chosen), damage=False)
        base = base.drop("pick_cnt", "win_cnt")
    else:
        base = base.withColumnRenamed("win_cnt", "pick_win_cnt")
    counts = option_counts(facts, chosen, keys, cohorts)
    joined = join_null_safe(counts, base, [COHORT, *keys])

    total = F.coalesce(*[F.when(F.col(FAMILY) == f.name, F.col(f.total)) for f in chosen])
    least = F.coalesce(
        *[F.when(F.col(FAMILY) == f.name, F.lit(f.min_share or 0.0)) for f in chosen]
    )
    kept = joined.where(F.col("select_cnt") / total >= least)
    shown = kept.withColumns(
        {
            "win_rate": rate(F.col("win_cnt"), F.col("select_cnt")),
            "pick_rate": rate(F.col("select_cnt"), total),
            "total_cnt": total,
        }
    )
    for family in chosen:
        if family.present:
            shown = shown.withColumns({c: family.present(F.col(c)) for c in family.columns})
    return shown.drop(*[family.total for family in chosen])


def option_share(
    facts: DataFrame,
    family: Family,
    keys: dict[str, str] = LANE_KEYS,
    cohorts: Cohorts = ALL,
) -> DataFrame:
    """Option shares of a single family."""
    return option_shares(facts, [family], keys, cohorts).drop(FAMILY)


def power_curve(
    facts: DataFrame, keys: dict[str, str] = LANE_KEYS, cohorts: Cohorts = ALL
) -> DataFrame:
    """Win rate and share by game length."""
    return option_share(facts, power_curve_family(), keys, cohorts)


def nest_options(
    shares: DataFrame,
    chosen: list[Family],
    keys: dict[str, str] = LANE_KEYS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per key with an ordered array of structs for every family.

    ``carry`` columns are constant per key.
    """
    measures = ["win_rate", "pick_rate", "select_cnt"]
    arrays = []
    for family in chosen:
        shown = [*family.columns, *measures]
        order = [] if family.by_value else [(-F.col("select_cnt")).alias("place")]
        entry = F.when(F.col(FAMILY) == family.name, F.struct(*order, *shown))
        ordered = F.sort_array(F.collect_list(entry))
        arrays.append(without_place(ordered, shown).alias(family.name))
    carried = [F.any_value(name).alias(name) for name in carry]
    return shares.groupBy(COHORT, *keys).agg(*carried, *arrays)


def without_place(entries: Column, shown: list[str]) -> Column:
    """Ordered structs reduced to the fields to show."""
    return F.transform(entries, lambda e: F.struct(*[e[name].alias(name) for name in shown]))
