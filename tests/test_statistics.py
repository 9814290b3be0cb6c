"""Statistics against counts made in plain Python."""

import datetime
import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from matchlens.functions import grade, major_minor, rate
from matchlens.functions.rates import champion_score
from matchlens.operators import cohorts as C
from matchlens.operators import document, matchups, options, picks

POSITIONS = ["TOP", "JUNGLE", "MIDDLE"]
TIERS = ["gold", "platinum", "EMERALD", "diamond", "master", "GRANDMASTER", "challenger"]
LEVEL = {"platinum": 1, "emerald": 2, "diamond": 3, "master": 4, "grandmaster": 4, "challenger": 4}
SCHEMA = (
    "matchId string, tier string, gameVersion string, date date, gameDuration bigint, ban bigint, "
    "p_championId bigint, p_teamPosition string, p_teamId bigint, p_win boolean, "
    "p_gameEndedInEarlySurrender boolean, o_championId bigint, p_statPerks array<bigint>, "
    "p_primaryStyles array<bigint>, p_subStyles array<bigint>, p_summoner1Id bigint, "
    "p_summoner2Id bigint, p_itemStart array<string>, p_itemMiddle array<string>, "
    "p_itemBuild array<string>, p_skillTree array<bigint>, p_physicalDamageDealtToChampions bigint, "
    "p_magicDamageDealtToChampions bigint, p_trueDamageDealtToChampions bigint, "
    "p_teamDamagePercentage double, p_damageTakenOnTeamPercentage double"
)
NAMES = [part.split()[0] for part in SCHEMA.split(", ")]


def row(rng, match, tier, team):
    return dict(
        matchId=match,
        tier=tier,
        gameVersion=rng.choice(["9.10.1", "13.2.5", "13.10.1"]),
        date=datetime.date(2024, 1, 1) + datetime.timedelta(days=rng.randrange(30)),
        gameDuration=rng.choice([600, 900, 901, 1500, 2100, 2101, 3000]),
        ban=rng.choice([-1, None, 1, 2, 3]),
        p_championId=rng.randrange(4),
        p_teamPosition=rng.choice(POSITIONS),
        p_teamId=team,
        p_win=team == 100,
        p_gameEndedInEarlySurrender=False,
        o_championId=rng.choice([None, 0, 1, 2]),
        p_statPerks=[rng.randrange(2)],
        p_primaryStyles=[rng.randrange(2)],
        p_subStyles=[1],
        p_summoner1Id=rng.randrange(2),
        p_summoner2Id=4,
        p_itemStart=rng.sample(["1", "2"], 2),
        p_itemMiddle=None if rng.random() < 0.3 else ["5"],
        p_itemBuild=["1", "2", "3", "4"][: rng.randrange(5)],
        p_skillTree=[1] * rng.choice([12, 13, 14]),
        p_physicalDamageDealtToChampions=rng.randrange(1000),
        p_magicDamageDealtToChampions=rng.randrange(1000),
        p_trueDamageDealtToChampions=rng.randrange(1000),
        p_teamDamagePercentage=rng.random(),
        p_damageTakenOnTeamPercentage=rng.random(),
    )


def made_rows(matches=80, seed=3):
    rng = random.Random(seed)
    rows = []
    for number in range(matches):
        tier = rng.choice(TIERS)
        for team in (100, 200):
            rows += [row(rng, f"m{number}", tier, team) for _ in range(3)]
    # One match holds a third of all rows.
    rows += [row(rng, "hot", "diamond", rng.choice((100, 200))) for _ in range(len(rows) // 2)]
    return rows


ROWS = made_rows()


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame([tuple(r[n] for n in NAMES) for r in ROWS], SCHEMA).cache()


def members(cohort):
    low = C.LADDER_COHORTS.names.index(cohort) + 1
    return [r for r in ROWS if LEVEL.get(r["tier"].lower(), 0) >= low]


def test_picks_per_cohort_equal_filtered_passes(facts):
    found = {
        (r.cohort, r.championId, r.teamPosition): (r.win_cnt, r.pick_cnt, r.total_cnt)
        for r in picks.picks(facts, cohorts=C.LADDER_COHORTS).collect()
    }
    expected = {}
    for cohort in C.LADDER_COHORTS.names:
        rows = members(cohort)
        total = len({r["matchId"] for r in rows})
        picked = Counter((r["p_championId"], r["p_teamPosition"]) for r in rows)
        won = Counter((r["p_championId"], r["p_teamPosition"]) for r in rows if r["p_win"])
        for key, n in picked.items():
            if n / total > 0.005:
                expected[(cohort, *key)] = (won[key], n, total)
    assert found == expected


def test_cohorts_shrink_up_the_ladder(facts):
    totals = {r.cohort: r.total_cnt for r in C.match_totals(facts, C.LADDER_COHORTS).collect()}
    counts = [totals[name] for name in C.LADDER_COHORTS.names]
    assert counts == sorted(counts, reverse=True)
    assert C.match_totals(facts).collect()[0].total_cnt == len({r["matchId"] for r in ROWS})


def test_bans_count_matches(facts):
    found = {(r.cohort, r.championId): r.ban_cnt for r in picks.bans(facts, C.LADDER_COHORTS).collect()}
    expected = Counter()
    for cohort in C.LADDER_COHORTS.names:
        for _, ban in {(r["matchId"], r["ban"]) for r in members(cohort)}:
            if ban is not None and ban != -1:
                expected[(cohort, ban)] += 1
    assert found == dict(expected)


def option_of(family, r):
    if family == "itemBuild":
        return tuple(r["p_itemBuild"][:3]) if len(r["p_itemBuild"]) >= 3 else None
    if family == "skillTree":
        return tuple(r["p_skillTree"][:13]) if len(r["p_skillTree"]) >= 13 else None
    if family == "itemMiddle":
        return ("null",) if r["p_itemMiddle"] is None else tuple(r["p_itemMiddle"])
    return tuple(r["p_statPerks"])


@pytest.mark.parametrize("family", ["statPerks", "itemBuild", "skillTree", "itemMiddle"])
def test_option_shares(facts, family):
    chosen = [f for f in options.families() if f.name == family]
    shares = options.option_shares(facts, chosen, cohorts=C.LADDER_COHORTS).collect()
    found = {
        (r.cohort, r.championId, r.teamPosition, ("null",) if r[family] is None else tuple(r[family])): (
            r.select_cnt,
            round(r.pick_rate, 9),
            round(r.win_rate, 9),
        )
        for r in shares
    }
    expected = {}
    for cohort in C.LADDER_COHORTS.names:
        rows = [r for r in members(cohort) if option_of(family, r) is not None]
        totals = Counter((r["p_championId"], r["p_teamPosition"]) for r in rows)
        counts = Counter((r["p_championId"], r["p_teamPosition"], option_of(family, r)) for r in rows)
        wins = Counter(
            (r["p_championId"], r["p_teamPosition"], option_of(family, r)) for r in rows if r["p_win"]
        )
        for key, n in counts.items():
            if n / totals[key[:2]] >= 0.01:
                expected[(cohort, *key)] = (n, round(n / totals[key[:2]], 9), round(wins[key] / n, 9))
    assert found == expected


def test_shares_of_a_key_add_up(facts):
    curve = options.power_curve(facts)
    sums = curve.groupBy("championId", "teamPosition").agg(F.sum("pick_rate").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in sums)
    assert {r.minute for r in curve.collect()} == {"15", "20", "25", "35", "35+"}


def test_start_items_in_another_order(facts):
    apart = next(f for f in options.families() if f.name == "itemStart")
    merged = next(f for f in options.families(normalize_start=True) if f.name == "itemStart")
    split_rows = options.option_share(facts, apart).collect()
    merged_rows = options.option_share(facts, merged).collect()
    assert all(r.itemStart == ["1", "2"] for r in split_rows)
    assert len(split_rows) == 2 * len(merged_rows)


def brute_pairs(rows, within, apart, key, partner):
    games, wins = Counter(), Counter()
    groups = {}
    for r in rows:
        groups.setdefault(tuple(r[w] for w in within), []).append(r)
    for group in groups.values():
        for a, b in itertools.permutations(group, 2):
            if a[apart] != b[apart]:
                pair = (*[a[k] for k in key], *[b[k] for k in partner])
                games[pair] += 1
                wins[pair] += a["p_win"]
    return games, wins


def test_teammate_pairs_with_a_hot_match(facts):
    found = matchups.pair_counts(
        facts,
        picks.LANE_KEYS,
        matchups.LANE_PARTNER,
        ["matchId", "p_teamId"],
        "p_teamPosition",
        C.LADDER_COHORTS,
    ).collect()
    lane = ["p_championId", "p_teamPosition"]
    for cohort in C.LADDER_COHORTS.names:
        games, wins = brute_pairs(
            members(cohort), ["matchId", "p_teamId"], "p_teamPosition", lane, lane
        )
        mine = {
            (r.championId, r.teamPosition, r.s_championId, r.s_teamPosition): (r.select_cnt, r.win_cnt)
            for r in found
            if r.cohort == cohort
        }
        assert mine == {pair: (n, wins[pair]) for pair, n in games.items()}


def test_enemy_pairs_allow_the_same_champion(facts):
    found = matchups.aram_counter(facts, min_share=0.0, k=99).collect()
    games, wins = brute_pairs(ROWS, ["matchId"], "p_teamId", ["p_championId"], ["p_championId"])
    assert {(r.championId, r.c_championId): (r.select_cnt, r.win_cnt) for r in found} == {
        pair: (n, wins[pair]) for pair, n in games.items()
    }


def test_counter_is_ordered_and_cut(facts):
    found = matchups.counter(facts, max_rate=1.1, min_games=1, k=2).collect()
    by_key = {}
    for r in sorted(found, key=lambda r: r.row_num):
        by_key.setdefault((r.championId, r.teamPosition), []).append(r)
    for rows in by_key.values():
        assert [r.row_num for r in rows] == list(range(1, len(rows) + 1)) and len(rows) <= 2
        assert [r.win_rate for r in rows] == sorted(r.win_rate for r in rows)


def test_latest_version_compares_numbers(facts):
    known = C.with_canonical_values(facts)
    assert C.latest_version(known).collect()[0][0] == "13.10"
    assert {r[0] for r in C.current_version(known).select("gameVersion").distinct().collect()} == {"13.10"}
    assert C.current_version(known, "9.10").count() == sum(r["gameVersion"] == "9.10.1" for r in ROWS)


def documents(facts, **options_of):
    return document.champion_documents(facts, datetime.date(2024, 2, 1), 60, min_games=1, **options_of)


def test_documents_do_not_depend_on_partitions(spark, facts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    for partitions in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        results.append([str(r) for r in documents(facts.repartition(int(partitions))).drop("damage").collect()])
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] and results[0]


def test_documents_without_bans_get_the_lowest_grade(facts):
    rows = documents(facts).collect()
    never = [r for r in rows if r.championId == 0]
    assert never and all(r.score is None and r.tier == "5" for r in never)
    scored = documents(facts, null_ban_as_zero=True).where("championId = 0").collect()
    assert all(r.score is not None for r in scored)
    known = [r.score for r in rows if r.score is not None]
    assert known == sorted(known, reverse=True) and rows[-1].score is None


def test_document_arrays_are_ordered(facts):
    for r in documents(facts).collect():
        counts = [o.select_cnt for o in r.statPerks]
        assert counts == sorted(counts, reverse=True)
        minutes = [o.minute for o in r.powerCurve]
        assert minutes == sorted(minutes)
        assert sum(o.select_cnt for o in r.powerCurve) == r.pick_cnt


def test_aram_documents(facts):
    rows = document.aram_documents(facts, datetime.date(2024, 2, 1), 60).collect()
    assert {r.championId for r in rows} == {0, 1, 2, 3}
    assert all(r.position_cnt == 1 for r in rows)
    competing = document.aram_documents(facts, datetime.date(2024, 2, 1), 60, compete=True).collect()
    assert all(r.position_cnt == 4 for r in competing)


def test_score_and_grade(spark):
    scores = [56.0, 54.5, 54.49, 51.5, 48.5, 45.5, 45.4, None]
    rows = spark.createDataFrame([(s,) for s in scores], "s double").select(grade(F.col("s"))).collect()
    assert [r[0] for r in rows] == ["OP", "1", "2", "2", "3", "4", "5", "5"]
    one = spark.range(1).select(
        champion_score(F.lit(0.5), F.lit(0.1), F.lit(20), F.lit(0.0)).alias("even"),
        champion_score(F.lit(0.5), F.lit(0.1), F.lit(200)).alias("crowded"),
        rate(F.lit(1), F.lit(0)).alias("none"),
    ).collect()[0]
    assert abs(one.even - 50) < 1e-9 and one.crowded is None and one.none is None


def test_major_minor(spark):
    versions = ["13.14.522.7601", "13.14", "13", ""]
    rows = spark.createDataFrame([(v,) for v in versions], "v string").select(major_minor(F.col("v")))
    assert [r[0] for r in rows.collect()] == ["13.14", "13.14", "13", ""]


def test_pairs_read_the_facts_once_and_move_them_twice(spark, tmp_path):
    from matchlens.operators.matchups import LANE_PARTNER, pair_counts
    from matchlens.operators.picks import LANE_KEYS

    rows = [("m", 100, c, p, True) for c, p in enumerate(["TOP", "JUNGLE", None, "MIDDLE", "TOP"])] + [(None, 100, 9, "TOP", False)] * 2
    schema = "matchId string, p_teamId bigint, p_championId bigint, p_teamPosition string, p_win boolean"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "facts"))
    pairs = pair_counts(spark.read.parquet(str(tmp_path / "facts")), LANE_KEYS, LANE_PARTNER, ["matchId", "p_teamId"], "p_teamPosition")
    found = {(r.championId, r.s_championId): (r.select_cnt, r.win_cnt) for r in pairs.collect()}
    assert found == {(a, b): (1, 1) for a, b in ((0, 1), (0, 3), (1, 0), (1, 3), (1, 4), (3, 0), (3, 1), (3, 4), (4, 1), (4, 3))}
    plan = pairs._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan
    executed = pairs._jdf.queryExecution().executedPlan().toString()
    # By member, by group, and the counts by pair.
    assert executed.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 3
