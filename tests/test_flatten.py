import datetime

from pyspark.sql import functions as F

from matchlens.functions import game_day
from matchlens.operators.flatten import canonical_matches, flatten_matches
from matchlens.operators.picks import bans
from matchlens.schema import FETCHED_MATCH, RAW_MATCH
from workloads import views
from workloads.queries import text


def rune_tree(sub=True):
    styles = [
        {"description": "primaryStyle", "style": 8000, "selections": [{"perk": 1}, {"perk": 2}]},
        {"description": "subStyle", "style": 8100, "selections": [{"perk": 3}]},
    ]
    return {
        "statPerks": {"defense": 11, "flex": 12, "offense": 13},
        "styles": styles if sub else styles[:1],
    }


def player(champion, team, position, sub=True):
    return {
        "championId": champion,
        "teamId": team,
        "teamPosition": position,
        "win": team == 100,
        "gameEndedInEarlySurrender": False,
        "perks": rune_tree(sub),
    }


def team(number, bans_of):
    return {
        "teamId": number,
        "bans": [{"championId": c, "pickTurn": t} for t, c in bans_of.items()],
    }


def match(name, participants, teams):
    return {
        "metadata": {"matchId": name, "tier": "gold", "gameVersion": "13.1.2", "gameStartTimestamp": 0},
        "queueId": 420,
        "participants": participants,
        "teams": teams,
    }


MATCHES = [
    match(
        "full",
        [player(1, 100, "TOP"), player(2, 100, "JUNGLE"), player(3, 200, "TOP", sub=False)],
        [team(100, {1: 50, 2: -1}), team(200, {3: 50})],
    ),
    match("alone", [player(4, 100, "TOP"), player(5, 200, "JUNGLE")], [team(100, {9: 1})]),
    match("empty", [], []),
    match("none", None, None),
]


def flat(spark, **options):
    return flatten_matches(spark.createDataFrame(MATCHES, RAW_MATCH), **options)


def test_lane_rows(spark):
    rows = flat(spark).select("matchId", "p_championId", "ban", "o_championId").collect()
    assert sorted(map(tuple, rows), key=str) == [
        ("alone", 4, None, None),
        ("alone", 5, None, None),
        ("empty", None, None, None),
        ("full", 1, 50, 3),
        ("full", 2, -1, None),
        ("full", 3, 50, 1),
        ("none", None, None, None),
    ]


def test_aram_rows_leave_out_empty_matches(spark):
    facts = flat(spark, with_opponent=False)
    assert facts.count() == 5
    assert not [c for c in facts.columns if c.startswith("o_") or c == "ban"]


def test_runes(spark):
    rows = {
        r.p_championId: r
        for r in flat(spark).where("matchId = 'full'").collect()
    }
    assert rows[1].p_statPerks == [11, 12, 13]
    assert (rows[1].p_primaryStyle, rows[1].p_subStyle) == (8000, 8100)
    assert (rows[1].p_primaryStyles, rows[1].p_subStyles) == ([1, 2], [3])
    assert (rows[3].p_subStyle, rows[3].p_subStyles) == (None, None)
    assert rows[1].o_statPerks == [11, 12, 13] and rows[1].o_subStyle is None
    assert rows[2].o_statPerks is None
    assert "p_perks" not in rows[1]


def test_both_teams_ban_the_same_champion_once(spark):
    counted = bans(flat(spark)).select("championId", "ban_cnt").collect()
    assert [tuple(r) for r in counted] == [(50, 1)]


def test_game_day_turns_three_hours_early(spark):
    ms = [(21 * 3600 - 1) * 1000, 21 * 3600 * 1000, 86_400_000 * 2 - 1, -1]
    rows = spark.createDataFrame([(m,) for m in ms], "ms bigint").select(game_day(F.col("ms"))).collect()
    epoch = datetime.date(1970, 1, 1)
    assert [(r[0] - epoch).days for r in rows] == [0, 1, 2, 0]


def test_fetched_documents_become_canonical(spark):
    fetched = {
        "metadata": {"tier": "DIAMOND", "matchId": "K_1"},
        "info": {
            "gameCreation": 5,
            "gameDuration": 1700,
            "gameVersion": "13.14.5",
            "participants": [
                {
                    "championId": 7,
                    "teamId": 100,
                    "challenges": {"teamDamagePercentage": 0.25, "damageTakenOnTeamPercentage": 0.5},
                    "perks": rune_tree(),
                }
            ],
            "teams": [team(100, {1: 9})],
        },
    }
    made = canonical_matches(spark.createDataFrame([fetched], FETCHED_MATCH))
    row = flatten_matches(made).collect()[0]
    assert (row.tier, row.matchId, row.gameDuration) == ("diamond", "K_1", 1700)
    assert (row.p_teamDamagePercentage, row.p_damageTakenOnTeamPercentage) == (0.25, 0.5)
    assert (row.p_championId, row.ban) == (7, 9)


def test_flatten_does_not_shuffle(spark):
    plan = flat(spark)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_customers_of_one_row_group_are_many_tasks(spark, tmp_path, monkeypatch):
    customers = spark.range(1000).selectExpr("if(id % 2 = 0, 7L, id) AS c_custkey", "id % 25 AS c_nationkey", "cast(id AS double) AS c_acctbal", "'BUILDING' AS c_mktsegment")
    customers.coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    whole = views.raw_matches(spark, str(tmp_path))
    monkeypatch.setattr(views, "MATCHES_PER_TASK", 100)
    dealt = views.raw_matches(spark, str(tmp_path))
    sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 10 and max(sizes) < 200
    assert dealt.exceptAll(whole).count() == 0 and dealt.count() == 1000


def test_arrays_are_shown_without_a_lambda(spark):
    rows = spark.sql("SELECT * FROM VALUES (array(1L, null, 3L)), (array()), (null) AS t(a)").withColumn("shown", text("a"))
    assert [r["shown"] for r in rows.collect()] == ["1,3", "", None]
    assert "lambda" not in rows._jdf.queryExecution().toString()
