"""The engine's inputs as views of the test tables.

Every view reads whole tables. ``facts`` is one row per line item, ``raw_matches``
one document per customer, ``timelines`` one log per block of 200 events. Documents
and logs are of bounded size however the keys of the tables are distributed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS_PER_MATCH = 200
EVENTS_PER_FRAME = 20
PARTS_PER_POSITION = 150
CATALOGUE_SIZE = 40
# A customer is some 60 bytes of a file and a document of many kilobytes, so file splits make tasks too large.
MATCHES_PER_TASK = 5_000

POSITIONS = "array('TOP','JUNGLE','MIDDLE','BOTTOM','UTILITY')"

TIER = """
    CASE o_orderpriority WHEN '1-URGENT' THEN 'challenger'
    WHEN '2-HIGH' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'master' ELSE 'grandmaster' END
    WHEN '3-MEDIUM' THEN 'diamond' WHEN '4-NOT SPECIFIED' THEN 'emerald'
    ELSE CASE WHEN o_orderkey % 11 = 0 THEN 'gold' ELSE 'platinum' END END
"""
VERSION = """
    concat(9 + (year(o_orderdate) - 1995) div 3, '.', 9 + if(month(o_orderdate) > 2, 1, 0), '.',
    day(o_orderdate))
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_columns() -> dict[str, str]:
    return {
        "tier": TIER,
        "gameVersion": VERSION,
        "date": "cast(o_orderdate as date)",
        "gameDuration": "600 + (o_orderkey * 37) % 2000",
        "p_gameEndedInEarlySurrender": "o_orderkey % 20 = 0",
    }


def line_columns() -> dict[str, str]:
    trees = [
        f"WHEN {kind} THEN array({', '.join(f'{1 + (kind * i + i // 3) % 4}L' for i in range(1, 16))})"
        for kind in range(3)
    ]
    skills = f"CASE l_partkey % 3 {' '.join(trees)} END"
    return {
        "matchId": "concat('M_', l_orderkey)",
        "p_championId": "l_suppkey % 20",
        "slot": "(l_partkey * 7 + l_linenumber) % 10",
        "ban": "if(l_linenumber = 7, null, l_partkey % 21 - 1)",
        "o_championId": "if(l_linenumber = 5, null, (l_partkey * 3 + l_linenumber) % 20)",
        "p_statPerks": "array(5001 + l_partkey % 2, 5001 + l_suppkey % 2, "
        "cast(5001 + l_linenumber % 2 as bigint))",
        "p_primaryStyles": "array(8000 + l_partkey % 3, cast(8100 + l_linenumber % 2 as bigint))",
        "p_subStyles": "array(8200 + l_suppkey % 2)",
        "p_summoner1Id": "cast(4 + l_linenumber % 3 as bigint)",
        "p_summoner2Id": "10 + l_partkey % 2",
        "p_itemStart": "array(cast(l_partkey % 3 as string), cast(l_suppkey % 3 as string))",
        "p_itemMiddle": "array(cast(l_partkey % 4 as string), cast(l_linenumber % 2 as string))",
        "p_itemBuild": "slice(array(cast(l_partkey % 3 as string), cast(l_suppkey % 2 as string), "
        "cast(l_linenumber % 2 as string), '7'), 1, 2 + l_linenumber % 3)",
        "p_skillTree": f"slice({skills}, 1, 11 + l_linenumber % 5)",
        "p_physicalDamageDealtToChampions": "cast(floor(l_extendedprice) as bigint)",
        "p_magicDamageDealtToChampions": "cast(floor(l_quantity) as bigint) * 100",
        "p_trueDamageDealtToChampions": "cast(floor(l_tax * 1000) as bigint)",
        "p_teamDamagePercentage": "l_discount",
        "p_damageTakenOnTeamPercentage": "l_tax",
    }


def facts(spark: SparkSession, folder: str) -> DataFrame:
    """Flat facts: every line item is a participant of the match of its order.

    The join is on the order key, and adaptive execution splits a hot order's
    partition. Only table columns are shuffled; the rest is computed after it.
    """
    orders = table(spark, folder, "orders")
    lines = table(spark, folder, "lineitem")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    derived = {**order_columns(), **line_columns()}
    seated = joined.select("o_custkey", *[F.expr(e).alias(n) for n, e in derived.items()])
    return seated.withColumns(
        {
            "p_teamPosition": F.expr(f"{POSITIONS}[cast(slot div 2 as int)]"),
            "p_teamId": F.expr("100 + 100 * (slot % 2)"),
            "p_win": F.expr("o_custkey % 2 = slot % 2"),
        }
    ).drop("o_custkey", "slot")


SEGMENT_TIER = """
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'challenger' WHEN 'BUILDING' THEN 'master'
    WHEN 'FURNITURE' THEN 'diamond' WHEN 'HOUSEHOLD' THEN 'emerald'
    ELSE if(c_custkey % 11 = 0, 'gold', 'platinum') END
"""


def participant(i: int) -> str:
    """The i-th participant of a customer's match.

    Some matches lack a position or a rune style on purpose.
    """
    position = f"{POSITIONS}[cast(({i} + c_custkey) % 5 as int)]"
    if i == 7:
        position = f"if(c_custkey % 9 = 4, '', {position})"
    skills = ", ".join(f"{1 + (k + i % 2) % 3}L" for k in range(1, 15))
    selection = "named_struct('perk', {perk}, 'var1', 0L, 'var2', 0L, 'var3', 0L)"
    primary = ", ".join(
        selection.format(perk=perk) for perk in (f"8000 + (c_nationkey + {i}) % 5", f"{9100 + i % 3}L")
    )
    sub = selection.format(perk="8400 + c_custkey % 3")
    return f"""named_struct(
        'championId', (c_nationkey * 3 + {i * 7} + c_custkey) % 20,
        'teamId', {100 if i < 5 else 200}L,
        'summoner1Id', {4 + i % 3}L,
        'summoner2Id', 10 + c_custkey % 2,
        'teamPosition', {position},
        'win', c_nationkey % 2 = {0 if i < 5 else 1},
        'gameEndedInEarlySurrender', c_custkey % 20 = 0,
        'physicalDamageDealtToChampions', cast(floor(abs(c_acctbal)) as bigint) % {1000 + i},
        'magicDamageDealtToChampions', c_nationkey % {100 + i},
        'trueDamageDealtToChampions', {i * 10}L,
        'teamDamagePercentage', {i / 16}D,
        'damageTakenOnTeamPercentage', (c_custkey % 8) / 8,
        'perks', named_struct(
            'statPerks', named_struct('defense', {5001 + i % 2}L, 'flex', 5001 + c_nationkey % 3,
                'offense', 5005L),
            'styles', slice(array(
                named_struct('description', 'primaryStyle', 'selections', array({primary}),
                    'style', 8000 + 100 * (c_custkey % 4)),
                named_struct('description', 'subStyle', 'selections', array({sub}), 'style', 8300L)),
                1, if(c_custkey % 17 = 3, 1, 2))),
        'skillTree', slice(array({skills}), 1, 11 + cast(c_custkey % 4 as int)),
        'itemStart', array(cast(c_nationkey % 2 as string), '{i % 2}'),
        'itemMiddle', array(cast(c_custkey % 3 as string)),
        'itemBuild', slice(array('1', cast(c_nationkey % 2 as string), '{i % 2}', '4'),
            1, 2 + cast(c_custkey % 3 as int)))"""


def raw_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Nested matches: every customer is a match of ten participants.

    Customers are dealt out before their documents are made, evenly however often a key is repeated.
    """
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    tasks = -(-customers.count() // MATCHES_PER_TASK)
    if tasks > customers.rdd.getNumPartitions():
        customers = customers.repartition(tasks)
    ban = "named_struct('championId', (c_nationkey + {shift}) % 21 - 1, 'pickTurn', {turn}L)"
    bans = [ban.format(shift=turn * 3, turn=turn) for turn in range(1, 11)]
    team = "named_struct('teamId', {team}L, 'win', c_nationkey % 2 = {parity}, 'bans', {bans})"
    blue = team.format(team=100, parity=0, bans=f"array({', '.join(bans[:5])})")
    red = team.format(
        team=200,
        parity=1,
        bans=f"slice(array({', '.join(bans[5:])}), 1, if(c_custkey % 13 = 0, 4, 5))",
    )
    seats = ", ".join(participant(i) for i in range(10))
    return customers.select(
        F.expr(
            f"""named_struct('tier', {SEGMENT_TIER},
            'gameVersion', concat(9 + c_custkey % 5, '.', 8 + c_nationkey % 3, '.1'),
            'matchId', concat('R_', c_custkey), 'gameDuration', 600 + (c_custkey * 37) % 2000,
            'gameStartTimestamp', ((9500L + c_custkey % 2000) * 86400L
                + (c_custkey * 7919) % 86400) * 1000)"""
        ).alias("metadata"),
        F.expr("420L").alias("queueId"),
        F.expr(
            f"""CASE WHEN c_custkey % 50 = 8 THEN null
            ELSE slice(array({seats}), 1, if(c_custkey % 50 = 7, 0, 10)) END"""
        ).alias("participants"),
        F.expr(f"array({blue}, {red})").alias("teams"),
    )


EVENT_TYPE = """
    CASE event_type WHEN 'purchase' THEN 'ITEM_PURCHASED' WHEN 'click' THEN 'ITEM_PURCHASED'
    WHEN 'signup' THEN 'ITEM_SOLD' WHEN 'view' THEN 'SKILL_LEVEL_UP'
    ELSE CASE WHEN cast(floor(value) as bigint) % 4 = 0 THEN 'ITEM_UNDO' ELSE 'WARD_PLACED' END END
"""


def timelines(spark: SparkSession, folder: str, item: str = f"1000 + cast(floor(value) as bigint) % {CATALOGUE_SIZE}") -> DataFrame:
    """Event logs: every block of 200 event ids is a match, every 20 events a frame; ``item`` gives an event's item id."""
    events = table(spark, folder, "events").select(
        F.expr(f"event_id div {EVENTS_PER_MATCH}").alias("block"),
        F.struct(
            "ts",
            "event_id",
            F.struct(
                F.expr(EVENT_TYPE).alias("type"),
                F.expr("event_id % 9 + 1").alias("participantId"),
                F.expr("1 + cast(floor(value) as bigint) % 4").alias("skillSlot"),
                F.expr(item).alias("itemId"),
            ).alias("event"),
        ).alias("entry"),
    )
    logs = events.groupBy("block").agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    frames = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("entries") - 1) / EVENTS_PER_FRAME).cast("int")),
        lambda i: F.struct(
            F.slice(F.col("entries.event"), i * EVENTS_PER_FRAME + 1, F.lit(EVENTS_PER_FRAME)).alias(
                "events"
            )
        ),
    )
    return logs.select(F.concat(F.lit("T_"), "block").alias("matchId"), frames.alias("frames"))


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """Item catalogue of a fixed number of entries, each out of a share of all parts."""
    parts = table(spark, folder, "part")
    grouped = parts.groupBy(F.expr(f"p_partkey % {CATALOGUE_SIZE}").alias("k")).agg(
        F.expr("cast(sum(p_size) as bigint)").alias("s")
    )
    return grouped.select(
        F.expr("cast(1000 + k as string)").alias("itemId"),
        F.expr("if(s % 6 = 0, array('Boots'), array('Damage'))").alias("tags"),
        F.expr("if(s % 2 = 0, array('1001'), null)").alias("from"),
        F.expr("if(s % 3 = 0, array('3001'), null)").alias("into"),
        F.expr("if(s % 5 = 0, '<rarityMythic>', 'plain')").alias("description"),
        F.expr("named_struct('base', 50 + (s % 10) * 45)").alias("gold"),
    )


def part_items(spark: SparkSession, folder: str) -> DataFrame:
    """Catalogue with an item for every part, ids of one to many digits."""
    return table(spark, folder, "part").select(
        F.expr("cast(p_partkey * 97 as string)").alias("itemId"),
        F.expr("if(p_size % 6 = 0, array('Boots', p_brand), array(p_brand))").alias("tags"),
        F.expr("if(p_partkey % 2 = 0, array(p_type), null)").alias("from"),
        F.expr("if(p_partkey % 3 = 0, array(p_type), null)").alias("into"),
        F.expr("if(p_size % 5 = 0, concat(p_name, ' <rarityMythic>'), p_name)").alias("description"),
        F.expr("named_struct('base', cast(floor(p_retailprice) as bigint))").alias("gold"),
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.expr("cast(c_custkey as string)").alias("summonerid"),
        F.expr("if(c_custkey % 3 = 0, null, concat('P_', c_custkey))").alias("puuid"),
        F.expr("cast(c_custkey * 7 % 300 as smallint)").alias("match_num"),
        F.expr("cast(c_custkey * 3 % 200 as smallint)").alias("update_num"),
        F.expr(
            """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'CHALLENGER' WHEN 'BUILDING' THEN 'MASTER'
            WHEN 'FURNITURE' THEN 'DIAMOND' WHEN 'HOUSEHOLD' THEN 'EMERALD' ELSE 'GOLD' END"""
        ).alias("tier"),
    )


def user_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Ladder entries of known and new users."""
    return table(spark, folder, "supplier").select(
        F.expr("cast(s_suppkey * 20 as string)").alias("summonerid"),
        F.expr("s_suppkey % 70").alias("wins"),
        F.expr("s_nationkey % 25").alias("losses"),
        F.lit("PLATINUM").alias("tier"),
    )


def match_state(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.expr("cast(o_orderkey as string)").alias("matchid"),
        F.expr("upper(o_orderpriority)").alias("tier"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END").alias("status"),
    )


def match_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Matches of many users' lists, each many times and some known already."""
    return table(spark, folder, "lineitem").select(
        F.expr("cast(l_orderkey * 2 as string)").alias("matchid"),
        F.expr("concat(l_returnflag, l_linestatus)").alias("tier"),
        F.col("l_shipdate").alias("seen"),
    )


RANKING = """concat_ws('\n', p_partkey, p_size, p_name, p_type,
        cast(40 + (p_partkey * 37) % 200 / 10 as string), cast(p_size + 0.5D as string),
        concat(cast(44 + (p_partkey * 13) % 120 / 10 as string), '%'),
        concat(cast(0.5D + (p_partkey * 29) % 150 / 10 as string), '%'),
        concat(cast((p_partkey * 17) % 300 / 10 as string), '%'),
        concat(p_size, ',', p_partkey), '')"""


def ranking_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Ten lines for every part, in the order of the parts."""
    parts = table(spark, folder, "part").select("p_partkey", F.split(F.expr(RANKING), "\n").alias("lines"))
    rows = parts.select("p_partkey", F.posexplode(F.slice("lines", 1, 10)).alias("place", "value"))
    return rows.orderBy("p_partkey", "place").select("value")


def json_run(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON values run together, fifty in a row of text; some spread over lines, and strings hold brackets."""
    value = F.expr(
        """concat('{"event_id": ', event_id, if(event_id % 3 = 0, ',\n  ', ', '), '"note": "}{ \\\\\" [', event_type, '", "tags": [',
        user_id, ',', if(event_id % 7 = 0, '\n\n', ' '), '{"k": ', props, '}]}', if(event_id % 5 = 0, ' ', ''))"""
    )
    events = table(spark, folder, "events").select(F.expr("event_id div 50").alias("block"), F.struct("event_id", value.alias("text")).alias("entry"))
    texts = events.groupBy("block").agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    return texts.select(F.array_join("entries.text", "").alias("value"))


def rankings(spark: SparkSession, folder: str) -> DataFrame:
    """Ranking texts: every block of parts is a position, ten lines per part.

    The number of parts of a position is fixed, so is the length of a text.
    """
    parts = table(spark, folder, "part")
    entries = parts.select(
        F.expr(f"concat('POS_', p_partkey div {PARTS_PER_POSITION})").alias("position"),
        F.struct("p_partkey", F.expr(RANKING).alias("lines")).alias("entry"),
    )
    texts = entries.groupBy("position").agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    return texts.select("position", F.array_join(F.col("entries.lines"), "").alias("value"))


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Keyed messages as bytes, as a topic gives them."""
    return to_messages(table(spark, folder, "events"))


def to_messages(events: DataFrame, *more: str) -> DataFrame:
    return events.select(
        F.col("event_type").alias("topic"),
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        *more,
    )
