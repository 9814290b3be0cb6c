"""The registered queries as SQL on the same tables, written independently of the operators."""

from __future__ import annotations

from workloads.queries import ALL_DAYS, COUNTER_GAMES, SYNERGY_GAMES
from workloads.views import CATALOGUE_SIZE, EVENTS_PER_FRAME, EVENTS_PER_MATCH, PARTS_PER_POSITION

# --- the input shapes ---------------------------------------------------------

TIER = """CASE o_orderpriority WHEN '1-URGENT' THEN 'challenger'
    WHEN '2-HIGH' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'master' ELSE 'grandmaster' END
    WHEN '3-MEDIUM' THEN 'diamond' WHEN '4-NOT SPECIFIED' THEN 'emerald'
    ELSE CASE WHEN o_orderkey % 11 = 0 THEN 'gold' ELSE 'platinum' END END"""
VERSION = """(9 + (year(o_orderdate) - 1995) // 3) || '.' ||
    (9 + CASE WHEN month(o_orderdate) > 2 THEN 1 ELSE 0 END) || '.' || day(o_orderdate)"""
POSITION = "['TOP','JUNGLE','MIDDLE','BOTTOM','UTILITY']"

FACTS = f"""
facts AS (
SELECT 'M_' || l_orderkey AS "matchId", {TIER} AS tier, {VERSION} AS "gameVersion",
  CAST(o_orderdate AS DATE) AS date, 600 + (o_orderkey * 37) % 2000 AS "gameDuration",
  CASE WHEN l_linenumber = 7 THEN NULL ELSE l_partkey % 21 - 1 END AS ban,
  l_suppkey % 20 AS "p_championId",
  {POSITION}[CAST(((l_partkey * 7 + l_linenumber) % 10) // 2 AS INT) + 1] AS "p_teamPosition",
  100 + 100 * (((l_partkey * 7 + l_linenumber) % 10) % 2) AS "p_teamId",
  o_custkey % 2 = ((l_partkey * 7 + l_linenumber) % 10) % 2 AS p_win,
  o_orderkey % 20 = 0 AS early,
  CASE WHEN l_linenumber = 5 THEN NULL ELSE (l_partkey * 3 + l_linenumber) % 20 END AS "o_championId",
  [5001 + l_partkey % 2, 5001 + l_suppkey % 2, 5001 + l_linenumber % 2] AS st,
  [8000 + l_partkey % 3, 8100 + l_linenumber % 2] AS ps, [8200 + l_suppkey % 2] AS ss,
  CAST(4 + l_linenumber % 3 AS BIGINT) AS s1, 10 + l_partkey % 2 AS s2,
  [CAST(l_partkey % 3 AS VARCHAR), CAST(l_suppkey % 3 AS VARCHAR)] AS istart,
  [CAST(l_partkey % 4 AS VARCHAR), CAST(l_linenumber % 2 AS VARCHAR)] AS imid,
  [CAST(l_partkey % 3 AS VARCHAR), CAST(l_suppkey % 2 AS VARCHAR),
    CAST(l_linenumber % 2 AS VARCHAR), '7'][1:2 + l_linenumber % 3] AS ibuild,
  list_transform(range(1, 12 + l_linenumber % 5), lambda i: 1 + ((l_partkey % 3) * i + i // 3) % 4) AS skill,
  floor(l_extendedprice) AS dp, floor(l_quantity) * 100 AS dm, floor(l_tax * 1000) AS dt,
  l_discount AS shd, l_tax AS sht
FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

RAW_PARTICIPANTS = f"""
base AS (SELECT *, 'R_' || c_custkey AS "matchId",
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'challenger' WHEN 'BUILDING' THEN 'master'
    WHEN 'FURNITURE' THEN 'diamond' WHEN 'HOUSEHOLD' THEN 'emerald'
    ELSE CASE WHEN c_custkey % 11 = 0 THEN 'gold' ELSE 'platinum' END END AS tier,
  (9 + c_custkey % 5) || '.' || (8 + c_nationkey % 3) || '.1' AS "gameVersion",
  600 + (c_custkey * 37) % 2000 AS "gameDuration",
  CAST(date_trunc('day', DATE '1970-01-01' + INTERVAL 3 HOUR + to_days(CAST(9500 + c_custkey % 2000 AS INT))
    + to_seconds((c_custkey * 7919) % 86400)) AS DATE) AS date FROM customer),
seats AS (SELECT b.*, i, c_custkey % 50 IN (7, 8) AS empty_match FROM base b, range(10) r(i)),
players AS (SELECT *, (c_nationkey * 3 + i * 7 + c_custkey) % 20 AS champ,
  CAST(CASE WHEN i < 5 THEN 100 ELSE 200 END AS BIGINT) AS team,
  CASE WHEN c_custkey % 9 = 4 AND i = 7 THEN ''
    ELSE {POSITION}[CAST((i + c_custkey) % 5 AS INT) + 1] END AS pos,
  (c_nationkey % 2 = 0) = (i < 5) AS win,
  [CAST(5001 + i % 2 AS BIGINT), 5001 + c_nationkey % 3, 5005] AS st,
  8000 + 100 * (c_custkey % 4) AS pstyle,
  CASE WHEN c_custkey % 17 = 3 THEN NULL ELSE 8300 END AS sstyle,
  [8000 + (c_nationkey + i) % 5, 9100 + i % 3] AS ps,
  CASE WHEN c_custkey % 17 = 3 THEN NULL ELSE [8400 + c_custkey % 3] END AS ss,
  CAST(4 + i % 3 AS BIGINT) AS s1, 10 + c_custkey % 2 AS s2,
  [CAST(c_nationkey % 2 AS VARCHAR), CAST(i % 2 AS VARCHAR)] AS istart,
  [CAST(c_custkey % 3 AS VARCHAR)] AS imid,
  ['1', CAST(c_nationkey % 2 AS VARCHAR), CAST(i % 2 AS VARCHAR), '4'][1:2 + c_custkey % 3] AS ibuild,
  list_transform(range(1, 12 + c_custkey % 4), lambda k: 1 + (k + i % 2) % 3) AS skill,
  CAST(floor(abs(c_acctbal)) AS BIGINT) % (1000 + i) AS dp, c_nationkey % (100 + i) AS dm, i * 10 AS dt,
  i / 16 AS shd, (c_custkey % 8) / 8 AS sht,
  CASE WHEN i = 9 AND c_custkey % 13 = 0 THEN NULL
    ELSE (c_nationkey + (i + 1) * 3) % 21 - 1 END AS ban
  FROM seats WHERE NOT empty_match),
paired AS (SELECT p.*, q.i AS o_i, q.champ AS o_champ, q.win AS o_win, q.skill AS o_skill, q.pos AS o_pos,
  q.st AS o_st, q.pstyle AS o_pstyle, q.sstyle AS o_sstyle, q.ps AS o_ps, q.ss AS o_ss
  FROM players p LEFT JOIN players q
  ON p."matchId" = q."matchId" AND p.pos = q.pos AND p.team <> q.team
  QUALIFY row_number() OVER (PARTITION BY p."matchId", p.i ORDER BY q.i) = 1)"""

RAW_FACTS = f"""{RAW_PARTICIPANTS},
facts AS (
SELECT "matchId", tier, "gameVersion", date, "gameDuration", ban, champ AS "p_championId",
  pos AS "p_teamPosition", team AS "p_teamId", win AS p_win, c_custkey % 20 = 0 AS early,
  o_champ AS "o_championId", st, ps, ss, s1, s2, istart, imid, ibuild, skill, dp, dm, dt, shd, sht
FROM paired)"""

# Columns of a flat participant by their names in the views; lists are shown as text.
FLAT = {
    "championId": "champ", "teamId": "team", "summoner1Id": "s1", "summoner2Id": "s2", "teamPosition": "pos", "win": "win",
    "gameEndedInEarlySurrender": "early", "physicalDamageDealtToChampions": "dp", "magicDamageDealtToChampions": "dm",
    "trueDamageDealtToChampions": "dt", "teamDamagePercentage": "shd", "damageTakenOnTeamPercentage": "sht",
    "primaryStyle": "pstyle", "subStyle": "sstyle",
}
FLAT_LISTS = {
    "skillTree": "skill", "itemStart": "istart", "itemMiddle": "imid", "itemBuild": "ibuild", "statPerks": "st",
    "primaryStyles": "ps", "subStyles": "ss",
}


def flat_columns(side: str, alias: str) -> str:
    shown = {n: f"{alias}.{c}" for n, c in FLAT.items()} | {n: as_text(f"{alias}.{c}") for n, c in FLAT_LISTS.items()}
    return ", ".join(f'{value} AS "{side}_{name}"' for name, value in shown.items())


def flat_rows(lane: bool) -> str:
    """Every flattened column; a match without participants keeps one row in the lane queues."""
    with_early = "(SELECT *, c_custkey % 20 = 0 AS early FROM players)"
    match = ["tier", '"gameVersion"', '"matchId"', '"gameDuration"', "date", 'CAST(420 AS BIGINT) AS "queueId"']
    own = f"SELECT {', '.join(match)}, {flat_columns('p', 'p')}"
    if not lane:
        return f"{own} FROM {with_early} p"
    named = [c if " AS " in c else f"p.{c}" for c in match]
    empty = ", ".join("NULL" for _ in range(2 * (len(FLAT) + len(FLAT_LISTS)) + 1))
    return f"""SELECT {', '.join(named)}, {flat_columns('p', 'p')}, p.ban, {flat_columns('o', 'q')}
FROM {with_early} p JOIN paired r ON p."matchId" = r."matchId" AND p.i = r.i
LEFT JOIN {with_early} q ON q."matchId" = r."matchId" AND q.i = r.o_i
UNION ALL SELECT {', '.join(match)}, {empty} FROM base WHERE c_custkey % 50 IN (7, 8)"""


MINUTE = """(CASE WHEN ceil("gameDuration" / 300) <= 3 THEN '15'
  WHEN ceil("gameDuration" / 300) > 7 THEN '35+'
  ELSE CAST(CAST(ceil("gameDuration" / 300) * 5 AS INT) AS VARCHAR) END)"""

RULES = f"""
known AS (SELECT * REPLACE (
  CASE WHEN tier IN ('master', 'grandmaster', 'challenger') THEN 'master' ELSE tier END AS tier,
  split_part("gameVersion", '.', 1) || '.' || split_part("gameVersion", '.', 2) AS "gameVersion"),
  {MINUTE} AS minute FROM facts),
finished AS (SELECT * FROM known WHERE NOT early),
newest AS (SELECT "gameVersion" AS v FROM known ORDER BY CAST(split_part("gameVersion", '.', 1) AS INT) DESC,
  CAST(split_part("gameVersion", '.', 2) AS INT) DESC LIMIT 1),
ladder(cohort, low) AS (VALUES ('platinum', 1), ('emerald', 2), ('diamond', 3), ('master', 4)),
ranked AS (SELECT *, CASE tier WHEN 'platinum' THEN 1 WHEN 'emerald' THEN 2 WHEN 'diamond' THEN 3
  WHEN 'master' THEN 4 END AS rank FROM finished)"""

ALL_ROWS = "info AS (SELECT 'all' AS cohort, * FROM finished), recent AS (SELECT * FROM info)"
LADDER_ROWS = """info AS (SELECT cohort, r.* FROM ranked r JOIN ladder ON r.rank >= low),
recent AS (SELECT * FROM info)"""
LATEST = f"""current_rows AS (SELECT * FROM ranked WHERE "gameVersion" = (SELECT v FROM newest)),
recent_rows AS (SELECT * FROM ranked WHERE date >= DATE '2001-08-02' - INTERVAL {ALL_DAYS} DAY)"""
LATEST_LADDER = f"""{LATEST},
info AS (SELECT cohort, r.* FROM current_rows r JOIN ladder ON r.rank >= low),
recent AS (SELECT cohort, r.* FROM recent_rows r JOIN ladder ON r.rank >= low)"""
LATEST_ALL = f"""{LATEST},
info AS (SELECT 'all' AS cohort, * FROM current_rows),
recent AS (SELECT 'all' AS cohort, * FROM recent_rows)"""

KEYS = 'cohort, "p_championId", "p_teamPosition"'
SHOWN_KEYS = '"p_championId" AS "championId", "p_teamPosition" AS "teamPosition"'


def query(*parts: str) -> str:
    """CTEs and a final SELECT."""
    return "WITH " + ",\n".join(parts[:-1]) + "\n" + parts[-1]


def stats(shape: str, rows: str, *parts: str) -> str:
    return query(shape, RULES, rows, *parts)


def as_text(array: str) -> str:
    return f"array_to_string(CAST({array} AS VARCHAR[]), ',')"


# --- champion statistics ------------------------------------------------------------

MATCHES = 'matches AS (SELECT cohort, count(DISTINCT "matchId") AS total_cnt FROM info GROUP BY cohort)'


def picked(keys: str = KEYS) -> str:
    return f"""{MATCHES},
picked AS (SELECT * FROM (SELECT {keys}, count(*) FILTER (WHERE p_win) AS win_cnt, count(*) AS pick_cnt
  FROM info GROUP BY {keys}) JOIN matches USING (cohort) WHERE pick_cnt / total_cnt > 0.005)"""


BANNED = """banned AS (SELECT cohort, ban AS "championId", count(*) AS ban_cnt
  FROM (SELECT DISTINCT cohort, "matchId", ban FROM info WHERE ban <> -1) GROUP BY ALL)"""

# Family: grouped values, rows looked at, smallest share, shown values.
FAMILIES = {
    "statPerks": (["st"], "TRUE", 0.01, [as_text("g1")]),
    "perks": (["ps", "ss"], "TRUE", 0.01, [as_text("g1"), as_text("g2")]),
    "summonerSpell": (["s1", "s2"], "TRUE", 0.01, ["g1", "g2"]),
    "itemStart": (["istart"], "TRUE", 0.01, [as_text("list_sort(g1)")]),
    "itemMiddle": (["imid"], "TRUE", 0.01, [as_text("g1")]),
    "itemBuild": (["ibuild[1:3]"], "len(ibuild) >= 3", 0.01, [as_text("g1")]),
    "skillTree": (["skill[1:13]"], "len(skill) >= 13", 0.01, [as_text("g1")]),
    "powerCurve": (["minute"], "TRUE", 0.0, ["g1"]),
    "itemStartMerged": (["list_sort(istart)"], "TRUE", 0.01, [as_text("g1")]),
}


def family(name: str, keys: str = KEYS) -> str:
    """Option shares of a family as CTEs, the last one of the family's name."""
    grouped, where, least, _ = FAMILIES[name]
    columns = ", ".join(f"{value} AS g{i}" for i, value in enumerate(grouped, 1))
    names = ", ".join(f"g{i}" for i in range(1, len(grouped) + 1))
    return f"""{name}_n AS (SELECT {keys}, {names}, count(*) AS select_cnt,
  count(*) FILTER (WHERE p_win) AS win_cnt FROM (SELECT *, {columns} FROM info WHERE {where})
  GROUP BY {keys}, {names}),
{name}_t AS (SELECT *, sum(select_cnt) OVER (PARTITION BY {keys}) AS total_cnt FROM {name}_n),
{name} AS (SELECT {keys}, {names}, win_cnt, select_cnt, CAST(total_cnt AS BIGINT) AS total_cnt,
  win_cnt / select_cnt AS win_rate, select_cnt / total_cnt AS pick_rate
  FROM {name}_t WHERE select_cnt / total_cnt >= {least})"""


def family_rows(name: str, columns: list[str]) -> str:
    named = ", ".join(f'{s} AS "{c}"' for s, c in zip(FAMILIES[name][3], columns, strict=True))
    return stats(
        FACTS,
        ALL_ROWS,
        family(name),
        f"SELECT {SHOWN_KEYS}, {named}, win_cnt, select_cnt, total_cnt, win_rate, pick_rate FROM {name}",
    )


def shares_by_cohort() -> str:
    names = [name for name in FAMILIES if name != "itemStartMerged"]
    branches = []
    for name in names:
        option = " || ';' || ".join(f"CAST({s} AS VARCHAR)" for s in FAMILIES[name][3])
        branches.append(
            f"SELECT cohort, {SHOWN_KEYS}, '{name}' AS family, {option} AS option, "
            f"win_rate, pick_rate, select_cnt FROM {name}"
        )
    return stats(FACTS, LADDER_ROWS, *map(family, names), "\nUNION ALL ".join(branches))


COUNTER = """counter_n AS (SELECT {keys}, "o_championId", count(*) AS select_cnt,
  count(*) FILTER (WHERE p_win) AS win_cnt FROM recent WHERE "o_championId" IS NOT NULL
  GROUP BY {keys}, "o_championId"),
counter_t AS (SELECT *, sum(select_cnt) OVER (PARTITION BY {keys}) AS total_cnt FROM counter_n),
counter AS (SELECT *, win_cnt / select_cnt AS win_rate, select_cnt / total_cnt AS pick_rate,
  row_number() OVER (PARTITION BY {keys}
    ORDER BY win_cnt / select_cnt, select_cnt DESC, "o_championId") AS row_num
  FROM counter_t WHERE select_cnt / total_cnt >= 0.01 AND win_cnt / select_cnt < 0.5
  AND select_cnt >= {games} QUALIFY row_num <= 10)"""


def partners(
    name: str, keys: list[str], partner: dict[str, str], on: str, having: str, order: str, k: int
) -> str:
    own = ", ".join(f'a."{c}"' for c in keys)
    theirs = ", ".join(f'b."{c}" AS "{n}"' for n, c in partner.items())
    mine = ", ".join(f'"{c}"' for c in keys)
    other = ", ".join(f'"{n}"' for n in partner)
    return f"""{name}_own AS (SELECT cohort, {mine}, count(*) AS total_cnt FROM recent GROUP BY ALL),
{name}_n AS (SELECT a.cohort, {own}, {theirs}, count(*) AS select_cnt,
  count(*) FILTER (WHERE a.p_win) AS win_cnt
  FROM recent a JOIN recent b ON a.cohort = b.cohort AND a."matchId" = b."matchId" AND {on} GROUP BY ALL),
{name} AS (SELECT *, win_cnt / select_cnt AS win_rate, select_cnt / total_cnt AS pick_rate,
  row_number() OVER (PARTITION BY cohort, {mine}
    ORDER BY win_cnt / select_cnt {order}, select_cnt DESC, {other}) AS row_num
  FROM {name}_n JOIN {name}_own USING (cohort, {mine}) WHERE {having} QUALIFY row_num <= {k})"""


LANE = ["p_championId", "p_teamPosition"]


def synergy(games: int) -> str:
    return partners(
        "synergy",
        LANE,
        {"s_championId": "p_championId", "s_teamPosition": "p_teamPosition"},
        'a."p_teamId" = b."p_teamId" AND a."p_teamPosition" <> b."p_teamPosition"',
        f"win_cnt / select_cnt > 0.5 AND select_cnt / total_cnt > 0.01 AND select_cnt >= {games}",
        "DESC",
        40,
    )


def aram_synergy() -> str:
    return partners(
        "synergy",
        ["p_championId"],
        {"s_championId": "p_championId"},
        'a."p_teamId" = b."p_teamId" AND a."p_championId" <> b."p_championId"',
        "select_cnt / total_cnt >= 0.01",
        "DESC",
        10,
    )


def aram_counter() -> str:
    return partners(
        "counter",
        ["p_championId"],
        {"c_championId": "p_championId"},
        'a."p_teamId" <> b."p_teamId"',
        "select_cnt / total_cnt >= 0.01",
        "DESC",
        10,
    )


MATCHUP = "win_cnt, select_cnt, total_cnt, win_rate, pick_rate, row_num"


def documents(shape: str, lane: bool) -> str:
    """Scored document per key, with the size of each array and some first entries."""
    keys = KEYS if lane else 'cohort, "p_championId"'
    names = [name for name in FAMILIES if name != "itemStartMerged"]
    matchups = (
        [COUNTER.format(keys=keys, games=SYNERGY_GAMES), synergy(SYNERGY_GAMES)]
        if lane
        else [aram_counter(), aram_synergy()]
    )
    sizes = [f"{n}_c AS (SELECT {keys}, count(*) AS n_{n} FROM {n} GROUP BY ALL)" for n in [*names, "counter", "synergy"]]
    tops = [
        f"""{n}_top AS (SELECT {keys}, {FAMILIES[n][3][0]} AS top_{n} FROM {n}
  QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY select_cnt DESC, {shown}) = 1)"""
        for n, shown in (("statPerks", "g1"), ("itemStart", "list_sort(g1)"))
    ]
    joins = " ".join(f"LEFT JOIN {n}_c USING ({keys})" for n in [*names, "counter", "synergy"])
    counts = ", ".join(f'coalesce(n_{n}, 0) AS "n_{n}"' for n in [*names, "counter", "synergy"])
    ban_join = 'LEFT JOIN banned ON banned.cohort = picked.cohort AND "championId" = "p_championId"'
    position = 'count(*) OVER (PARTITION BY picked.cohort, "p_teamPosition")' if lane else "CAST(1 AS BIGINT)"
    ban_rate = "ban_cnt / total_cnt AS ban_rate," if lane else ""
    ban_term = "- CASE WHEN ban_rate < 1 THEN ln(1 - ban_rate) END" if lane else ""
    shown_ban = "ban_rate," if lane else ""
    shown_keys = f"cohort, {SHOWN_KEYS}" if lane else '"p_championId" AS "championId"'
    return stats(
        shape,
        LATEST_LADDER if lane else LATEST_ALL,
        picked(keys),
        BANNED,
        *map(lambda n: family(n, keys), names),
        *matchups,
        *sizes,
        *tops,
        f"damage AS (SELECT {keys}, avg(dm) + avg(dp) + avg(dt) AS total_damage FROM info GROUP BY ALL)",
        f"minutes AS (SELECT {keys}, min(g1) AS first_minute FROM \"powerCurve\" GROUP BY ALL)",
        f"""joined AS (SELECT picked.*, win_cnt / pick_cnt AS win_rate, pick_cnt / total_cnt AS pick_rate,
  {ban_rate} {position} AS position_cnt FROM picked {ban_join if lane else ""})""",
        f"""scored AS (SELECT *, 50 + 1.6::DOUBLE * (win_rate * 100 - 50) + 3.5::DOUBLE *
  (ln(pick_rate) {ban_term} - ln(2 / position_cnt)) / nullif(ln(200 / position_cnt), 0) AS score
  FROM joined)""",
        f"""SELECT {shown_keys}, pick_cnt, win_rate, pick_rate, {shown_ban} position_cnt,
  round(score, 6) AS score, CASE WHEN score >= 56 THEN 'OP' WHEN score >= 54.5 THEN '1'
  WHEN score >= 51.5 THEN '2' WHEN score >= 48.5 THEN '3' WHEN score >= 45.5 THEN '4' ELSE '5' END AS tier,
  round(total_damage, 6) AS "totalDamage", top_statPerks AS "top_statPerks",
  top_itemStart AS "top_itemStart", first_minute, {counts}
FROM scored {joins} LEFT JOIN damage USING ({keys}) LEFT JOIN minutes USING ({keys})
LEFT JOIN statPerks_top USING ({keys}) LEFT JOIN itemStart_top USING ({keys})""",
    )


def document_arrays() -> str:
    """Every entry of the arrays of the lane documents, with its place."""
    names = [name for name in FAMILIES if name != "itemStartMerged"]
    branches = []
    for name in names:
        grouped, _, _, shown = FAMILIES[name]
        values = ["list_sort(g1)"] if name == "itemStart" else [f"g{i}" for i in range(1, len(grouped) + 1)]
        order = ", ".join(values if name == "powerCurve" else ["select_cnt DESC", *values, "win_rate", "pick_rate"])
        option = " || ';' || ".join(f"CAST({s} AS VARCHAR)" for s in shown)
        branches.append(
            f"SELECT {KEYS}, '{name}' AS \"array\", row_number() OVER (PARTITION BY {KEYS} ORDER BY {order}) AS place, "
            f"{option} AS option, win_rate, pick_rate, select_cnt FROM {name}"
        )
    for name, option in (("counter", '"o_championId"'), ("synergy", "\"s_championId\" || ';' || \"s_teamPosition\"")):
        branches.append(
            f"SELECT {KEYS}, '{name}', row_num, CAST({option} AS VARCHAR), win_rate, pick_rate, select_cnt FROM {name}"
        )
    return stats(
        FACTS,
        LATEST_LADDER,
        picked(KEYS),
        *map(family, names),
        COUNTER.format(keys=KEYS, games=SYNERGY_GAMES),
        synergy(SYNERGY_GAMES),
        f"entries AS ({' UNION ALL '.join(branches)})",
        f"""SELECT cohort, {SHOWN_KEYS}, "array", CAST(place AS BIGINT) AS place, option, win_rate, pick_rate, select_cnt
FROM entries JOIN (SELECT {KEYS} FROM picked) USING ({KEYS})""",
    )


# --- timelines -------------------------------------------------------------------------

TIMELINE = f"""
moves AS (SELECT 'T_' || (event_id // {EVENTS_PER_MATCH}) AS "matchId", event_id % 9 + 1 AS who,
  row_number() OVER (PARTITION BY event_id // {EVENTS_PER_MATCH} ORDER BY ts, event_id) - 1 AS place,
  CASE event_type WHEN 'purchase' THEN 'ITEM_PURCHASED' WHEN 'click' THEN 'ITEM_PURCHASED'
    WHEN 'signup' THEN 'ITEM_SOLD' WHEN 'view' THEN 'SKILL_LEVEL_UP'
    ELSE CASE WHEN CAST(floor(value) AS BIGINT) % 4 = 0 THEN 'ITEM_UNDO' ELSE 'WARD_PLACED' END END AS type,
  1 + CAST(floor(value) AS BIGINT) % 4 AS skill,
  CAST(1000 + CAST(floor(value) AS BIGINT) % {CATALOGUE_SIZE} AS VARCHAR) AS item FROM events),
slots AS (SELECT "matchId", who FROM (SELECT DISTINCT "matchId" FROM moves), range(1, 11) r(who)),
deep AS (SELECT *, sum(CASE type WHEN 'ITEM_UNDO' THEN -1 ELSE 1 END) OVER (
  PARTITION BY "matchId", who ORDER BY place) AS depth FROM moves
  WHERE type IN ('ITEM_PURCHASED', 'ITEM_SOLD', 'ITEM_UNDO')),
ahead AS (SELECT *, min(depth) OVER (PARTITION BY "matchId", who ORDER BY place
  ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM deep),
kept AS (SELECT * FROM ahead WHERE type <> 'ITEM_UNDO' AND depth <= coalesce(later, depth)),
sound AS (SELECT s."matchId", s.who, coalesce(min(depth) >= 0, TRUE) AS valid
  FROM slots s LEFT JOIN deep d ON s."matchId" = d."matchId" AND s.who = d.who GROUP BY ALL),
sound_matches AS (SELECT "matchId" FROM sound GROUP BY ALL HAVING bool_and(valid)),
item_sizes AS (SELECT p_partkey % {CATALOGUE_SIZE} AS k, sum(p_size) AS s FROM part GROUP BY ALL),
catalogue AS (SELECT CAST(1000 + k AS VARCHAR) AS item, 50 + (s % 10) * 45 AS price, s % 6 = 0 AS boots,
  s % 6 <> 0 AND (s % 5 = 0 OR (s % 2 = 0 AND s % 3 <> 0)) AS completed,
  s % 6 <> 0 AND s % 5 = 0 AS mythic FROM item_sizes),
bought AS (SELECT k."matchId", who, place, c.*, sum(price) OVER (
  PARTITION BY k."matchId", who ORDER BY place) AS spent
  FROM kept k JOIN catalogue c USING (item) JOIN sound_matches USING ("matchId")
  WHERE type = 'ITEM_PURCHASED'),
seats AS (SELECT * FROM slots JOIN sound_matches USING ("matchId"))"""

SLOTS = f"""{TIMELINE},
skills AS (SELECT "matchId", who, list(skill ORDER BY place) AS tree FROM moves
  WHERE type = 'SKILL_LEVEL_UP' GROUP BY ALL),
starts AS (SELECT "matchId", who, coalesce(list(item ORDER BY place) FILTER (WHERE spent <= 500), []) AS items,
  max(spent) > 500 AS closed FROM bought GROUP BY ALL),
builds AS (SELECT "matchId", who, coalesce(list(item ORDER BY place) FILTER (WHERE completed), []) AS items,
  max_by(item, place) FILTER (WHERE boots) AS boots, max_by(item, place) FILTER (WHERE mythic) AS mythic
  FROM bought WHERE spent > 500 GROUP BY ALL),
folded AS (SELECT "matchId", who, coalesce({as_text("tree")}, '') AS skills,
  coalesce({as_text("CASE WHEN closed THEN list_sort(starts.items) ELSE starts.items END")}, '') AS start_items,
  coalesce({as_text("builds.items")}, '') AS build, builds.boots, builds.mythic
  FROM seats LEFT JOIN skills USING ("matchId", who) LEFT JOIN starts USING ("matchId", who)
  LEFT JOIN builds USING ("matchId", who))"""

PART_SLOTS = (
    SLOTS.replace(
        f"CAST(1000 + CAST(floor(value) AS BIGINT) % {CATALOGUE_SIZE} AS VARCHAR) AS item FROM events",
        "CAST(97 * (1 + event_id % (SELECT count(*) FROM part)) AS VARCHAR) AS item FROM events",
    )
    .replace(f"item_sizes AS (SELECT p_partkey % {CATALOGUE_SIZE} AS k, sum(p_size) AS s FROM part GROUP BY ALL),\n", "")
    .replace(SLOTS[SLOTS.index("catalogue AS (") : SLOTS.index("bought AS (")], """catalogue AS (SELECT CAST(p_partkey * 97 AS VARCHAR) AS item,
  CAST(floor(p_retailprice) AS BIGINT) AS price, length(CAST(p_partkey * 97 AS VARCHAR)) < 6 AND p_size % 6 = 0 AS boots,
  length(CAST(p_partkey * 97 AS VARCHAR)) < 6 AND p_size % 6 <> 0 AND (p_size % 5 = 0 OR (p_partkey % 2 = 0 AND p_partkey % 3 <> 0
  AND p_partkey * 97 NOT IN (4403, 2033, 7000, 2019))) OR p_partkey * 97 = 6693 AS completed,
  length(CAST(p_partkey * 97 AS VARCHAR)) < 6 AND p_size % 6 <> 0 AND p_size % 5 = 0 AS mythic FROM part),
""")
    .replace("spent <= 500", "spent <= 3000")
    .replace("spent) > 500", "spent) > 3000")
    .replace("spent > 500", "spent > 3000")
)

SLOT_KEYS = '"matchId", who AS "participantId"'

# --- users, matches, rankings ---------------------------------------------------------------

USERS = """
users AS (SELECT CAST(c_custkey AS VARCHAR) AS summonerid,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'P_' || c_custkey END AS puuid,
  CAST(c_custkey * 7 % 300 AS SMALLINT) AS match_num, CAST(c_custkey * 3 % 200 AS SMALLINT) AS update_num,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'CHALLENGER' WHEN 'BUILDING' THEN 'MASTER'
    WHEN 'FURNITURE' THEN 'DIAMOND' WHEN 'HOUSEHOLD' THEN 'EMERALD' ELSE 'GOLD' END AS tier FROM customer),
user_batch AS (SELECT CAST(s_suppkey * 20 AS VARCHAR) AS summonerid,
  CAST(s_suppkey % 70 + s_nationkey % 25 AS SMALLINT) AS match_num, 'PLATINUM' AS tier FROM supplier)"""
STATE = """
state AS (SELECT CAST(o_orderkey AS VARCHAR) AS matchid, upper(o_orderpriority) AS tier,
  CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS status FROM orders),
listed AS (SELECT CAST(l_orderkey * 2 AS VARCHAR) AS matchid, l_returnflag || l_linestatus AS tier,
  l_shipdate AS seen FROM lineitem)"""
LAST_LISTED = """last_listed AS (SELECT matchid, tier FROM listed
  QUALIFY row_number() OVER (PARTITION BY matchid ORDER BY seen DESC, tier DESC) = 1)"""
ORDER_ROWS = """SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS date, o_orderkey, o_orderpriority, o_orderstatus
  FROM orders"""

RECORDS = f"""
records AS (SELECT 'POS_' || (p_partkey // {PARTS_PER_POSITION}) AS position,
  row_number() OVER (PARTITION BY p_partkey // {PARTS_PER_POSITION} ORDER BY p_partkey) AS ordinal,
  p_name AS name, 40 + ((p_partkey * 37) % 200) / 10 AS score, p_size + 0.5::DOUBLE AS h_score,
  44 + ((p_partkey * 13) % 120) / 10 AS win_rate, 0.5::DOUBLE + ((p_partkey * 29) % 150) / 10 AS pick_rate,
  ((p_partkey * 17) % 300) / 10 AS ban_rate FROM part)"""


def features(version: int) -> str:
    scale = "nullif(ln(200 / n), 0)" if version == 1 else "sqrt(200 / n)"
    return f"""sized AS (SELECT *, count(*) OVER (PARTITION BY position) AS n FROM records),
features AS (SELECT *, win_rate - 50 AS x1,
  coalesce(ln(pick_rate / (1 - ban_rate / 100) / (200 / n)) / {scale}, 0) AS x2 FROM sized)"""


FITTED = """moments AS (SELECT position, var_pop(x1) AS v11, var_pop(x2) AS v22, covar_pop(x1, x2) AS v12,
  covar_pop(x1, score) AS c1, covar_pop(x2, score) AS c2, avg(x1) AS m1, avg(x2) AS m2, avg(score) AS my
  FROM features GROUP BY position),
fitted AS (SELECT position, b1, b2, my - b1 * m1 - b2 * m2 AS intercept FROM (SELECT *,
  (v22 * c1 - v12 * c2) / (v11 * v22 - v12 * v12) AS b1,
  (v11 * c2 - v12 * c1) / (v11 * v22 - v12 * v12) AS b2 FROM moments))"""


def predicted(version: int, w1: float, w2: float) -> str:
    return query(
        RECORDS,
        features(version),
        FITTED,
        f"""guessed AS (SELECT f.*, intercept + {w1}::DOUBLE * x1 + {w2}::DOUBLE * x2 AS predict
  FROM features f JOIN fitted USING (position))""",
        """SELECT position, name, score, round(predict, 6) AS predict,
  row_number() OVER (PARTITION BY position ORDER BY score DESC, ordinal) AS score_rank,
  row_number() OVER (PARTITION BY position ORDER BY predict DESC, ordinal) AS predict_rank FROM guessed""",
    )


def per_date(where: str, source: str = "facts") -> str:
    return query(FACTS, f"SELECT date, count(*) AS rows FROM {source} WHERE {where} GROUP BY date")


def raw(final: str) -> str:
    return query(RAW_PARTICIPANTS, final)


ORACLE: dict[str, str] = {
    "pick_win": stats(
        FACTS, ALL_ROWS, picked(), f"SELECT {SHOWN_KEYS}, pick_cnt, win_cnt, total_cnt FROM picked"
    ),
    "ban_count": stats(FACTS, ALL_ROWS, BANNED, 'SELECT "championId", ban_cnt FROM banned'),
    "match_count": stats(FACTS, LADDER_ROWS, MATCHES, "SELECT * FROM matches"),
    "tier_cohorts": stats(
        FACTS, LADDER_ROWS, picked(), f"SELECT cohort, {SHOWN_KEYS}, pick_cnt, win_cnt, total_cnt FROM picked"
    ),
    "tier_cohort_bans": stats(FACTS, LADDER_ROWS, BANNED, "SELECT * FROM banned"),
    "tier_filter": query(
        FACTS,
        """SELECT tier, count(*) AS rows FROM facts
  WHERE tier IN ('diamond', 'master', 'grandmaster', 'challenger') GROUP BY tier""",
    ),
    "option_share_array": family_rows("statPerks", ["statPerks"]),
    "option_share_two_arrays": family_rows("perks", ["primaryStyles", "subStyles"]),
    "option_share_pair": family_rows("summonerSpell", ["summoner1Id", "summoner2Id"]),
    "option_share_sorted_array": family_rows("itemStart", ["itemStart"]),
    "option_share_merged_array": family_rows("itemStartMerged", ["itemStart"]),
    "option_share_middle": family_rows("itemMiddle", ["itemMiddle"]),
    "option_share_prefix3": family_rows("itemBuild", ["itemBuild"]),
    "option_share_prefix13": family_rows("skillTree", ["skillTree"]),
    "option_shares_by_cohort": shares_by_cohort(),
    "power_curve": family_rows("powerCurve", ["minute"]),
    "damage_profile": stats(
        FACTS,
        ALL_ROWS,
        f"""SELECT {SHOWN_KEYS}, round(avg(dp), 6) AS "physicalDamage", round(avg(dm), 6) AS "magicDamage",
  round(avg(dt), 6) AS "trueDamage", round(avg(dm) + avg(dp) + avg(dt), 6) AS "totalDamage",
  round(avg(shd), 6) AS "teamDamagePercentage", round(avg(sht), 6) AS "damageTakenOnTeamPercentage"
  FROM info GROUP BY {KEYS}""",
    ),
    "counter": stats(
        FACTS,
        ALL_ROWS,
        COUNTER.format(keys=KEYS, games=COUNTER_GAMES),
        f'SELECT {SHOWN_KEYS}, "o_championId", {MATCHUP} FROM counter',
    ),
    "synergy": stats(
        FACTS,
        ALL_ROWS,
        synergy(SYNERGY_GAMES),
        f'SELECT {SHOWN_KEYS}, "s_championId", "s_teamPosition", {MATCHUP} FROM synergy',
    ),
    "synergy_by_cohort": stats(
        FACTS,
        LADDER_ROWS,
        synergy(SYNERGY_GAMES),
        f'SELECT cohort, {SHOWN_KEYS}, "s_championId", "s_teamPosition", {MATCHUP} FROM synergy',
    ),
    "aram_synergy": stats(
        FACTS,
        ALL_ROWS,
        aram_synergy(),
        f'SELECT "p_championId" AS "championId", "s_championId", {MATCHUP} FROM synergy',
    ),
    "aram_counter": stats(
        FACTS,
        ALL_ROWS,
        aram_counter(),
        f'SELECT "p_championId" AS "championId", "c_championId", {MATCHUP} FROM counter',
    ),
    "champion_document": documents(FACTS, lane=True),
    "document_arrays": document_arrays(),
    "nested_document": documents(RAW_FACTS, lane=True),
    "aram_document": documents(FACTS, lane=False),
    "latest_version": query(FACTS, RULES, 'SELECT v AS "gameVersion" FROM newest'),
    "current_version": query(
        FACTS,
        RULES,
        """SELECT "gameVersion", tier, count(*) AS rows FROM finished
  WHERE "gameVersion" = (SELECT v FROM newest) GROUP BY ALL""",
    ),
    "recent_days": per_date("NOT early AND date >= DATE '2001-08-02' - INTERVAL 365 DAY"),
    "recent_view": per_date("NOT early AND date >= DATE '2001-08-03' - INTERVAL 180 DAY"),
    "retained": per_date("date > DATE '2001-08-02' - INTERVAL 60 DAY"),
    "date_range": per_date("date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31'"),
    "daily_picks": query(
        FACTS,
        """SELECT date, tier, "p_championId", "p_teamPosition", count(*) AS pick,
  count(*) FILTER (WHERE p_win) AS win, sum(count(*)) OVER (PARTITION BY date, tier) / 10 AS total
  FROM facts WHERE NOT early GROUP BY date, tier, "p_championId", "p_teamPosition" """,
    ),
    "daily_bans": query(
        FACTS,
        """SELECT date, tier, ban AS "championId", count(*) AS bans FROM facts WHERE NOT early
  GROUP BY ALL""",
    ),
    "flatten_participants": raw(
        f"""SELECT "matchId", tier, "gameVersion", date, "gameDuration", CAST(420 AS BIGINT) AS "queueId",
  champ AS "p_championId", team AS "p_teamId", pos AS "p_teamPosition", win AS p_win,
  dp AS "p_physicalDamageDealtToChampions", {as_text("istart")} AS "p_itemStart",
  {as_text("skill")} AS "p_skillTree", ban, o_champ AS "o_championId", o_win,
  {as_text("o_skill")} AS "o_skillTree" FROM paired
  UNION ALL SELECT "matchId", tier, "gameVersion", date, "gameDuration", 420,
  NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM base WHERE c_custkey % 50 IN (7, 8)"""
    ),
    "flatten_every_column": raw(flat_rows(lane=True)),
    "flatten_aram": raw(flat_rows(lane=False)),
    "ban_lookup": raw(
        """SELECT ban, count(*) AS rows FROM (SELECT ban FROM players
  UNION ALL SELECT NULL FROM base WHERE c_custkey % 50 IN (7, 8)) GROUP BY ban"""
    ),
    "opponent_lookup": raw(
        """SELECT champ AS "p_championId", pos AS "p_teamPosition", o_champ AS "o_championId",
  o_pos AS "o_teamPosition", count(*) AS rows FROM (SELECT champ, pos, o_champ, o_pos FROM paired
  UNION ALL SELECT NULL, NULL, NULL, NULL FROM base WHERE c_custkey % 50 IN (7, 8)) GROUP BY ALL"""
    ),
    "rune_lists": raw(
        f"""SELECT "matchId", champ AS "p_championId", team AS "p_teamId", {as_text("st")} AS "p_statPerks",
  pstyle AS "p_primaryStyle", sstyle AS "p_subStyle", {as_text("ps")} AS "p_primaryStyles",
  {as_text("ss")} AS "p_subStyles", {as_text("o_st")} AS "o_statPerks", o_pstyle AS "o_primaryStyle",
  o_sstyle AS "o_subStyle", {as_text("o_ps")} AS "o_primaryStyles", {as_text("o_ss")} AS "o_subStyles"
  FROM paired UNION ALL SELECT "matchId", NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  NULL FROM base WHERE c_custkey % 50 IN (7, 8)"""
    ),
    "game_day": raw('SELECT "matchId", date FROM base'),
    "timeline_events": query(
        TIMELINE,
        f"""SELECT "matchId", place // {EVENTS_PER_FRAME} AS frame, place AS "eventOrder", type,
  who AS "participantId" FROM moves""",
    ),
    "skill_order": query(
        TIMELINE,
        f"""SELECT s."matchId", s.who AS "participantId",
  coalesce({as_text("list(skill ORDER BY place) FILTER (WHERE type = 'SKILL_LEVEL_UP')")}, '') AS "skillTree"
  FROM slots s LEFT JOIN moves m ON s."matchId" = m."matchId" AND s.who = m.who GROUP BY s."matchId", s.who""",
    ),
    "purchase_log_undo": query(
        TIMELINE,
        """SELECT s."matchId", s.who AS "participantId", valid, CASE WHEN valid THEN coalesce(string_agg(
  item || CASE type WHEN 'ITEM_PURCHASED' THEN '+' ELSE '-' END, ',' ORDER BY place), '') END AS entries
  FROM sound s LEFT JOIN kept k ON s."matchId" = k."matchId" AND s.who = k.who
  GROUP BY s."matchId", s.who, valid""",
    ),
    "timeline_slots": query(
        SLOTS,
        f"""SELECT {SLOT_KEYS}, skills AS "skillTree", start_items AS "itemStart", build AS "itemRarity",
  boots AS "itemBoots", mythic AS "itemMyth" FROM folded""",
    ),
    "starting_items": query(SLOTS, f'SELECT {SLOT_KEYS}, start_items AS "itemStart" FROM folded'),
    "completed_items": query(
        TIMELINE,
        f"""SELECT {SLOT_KEYS}, row_number() OVER (PARTITION BY "matchId", who ORDER BY place) - 1 AS place,
  item AS "itemId" FROM bought WHERE spent > 500 AND completed""",
    ),
    "last_items": query(SLOTS, f'SELECT {SLOT_KEYS}, boots AS "itemBoots", mythic AS "itemMyth" FROM folded'),
    "merged_matches": f"""WITH {SLOTS.replace("seats AS", "places AS").replace("FROM seats", "FROM places")},
{RAW_PARTICIPANTS}
SELECT f."matchId", champ AS "p_championId", team AS "p_teamId", skills AS "p_skillTree",
  build AS "p_itemBuild", boots AS "p_itemBoots" FROM players p JOIN folded f
  ON 'T_' || c_custkey = f."matchId" AND p.i + 1 = f.who""",
    "item_classes": """WITH parts AS (SELECT *, CAST(p_partkey * 97 AS VARCHAR) AS id FROM part),
marked AS (SELECT *, length(id) < 6 AND p_size % 6 = 0 AS boots, length(id) < 6 AND p_size % 6 <> 0 AS usual
  FROM parts)
SELECT id AS "itemId", boots AS is_boots, (usual AND (p_size % 5 = 0 OR (p_partkey % 2 = 0
  AND p_partkey % 3 <> 0 AND id NOT IN ('4403', '2033', '7000', '2019')))) OR id = '6693' AS is_completed,
  usual AND p_size % 5 = 0 AS is_mythic, CAST(floor(p_retailprice) AS BIGINT) AS price FROM marked""",
    "item_catalogue": """SELECT 'n' || p_partkey AS "itemId", p_brand AS tags, p_size > 20 AS has_from,
  p_name AS description, CAST(p_size AS BIGINT) AS base FROM part""",
    "champion_dimension": "SELECT CAST(p_partkey AS INT) AS id, p_name AS name FROM part",
    "upsert_users": query(
        USERS,
        """SELECT coalesce(u.summonerid, b.summonerid) AS summonerid, u.puuid,
  coalesce(b.match_num, u.match_num) AS match_num,
  CASE WHEN u.summonerid IS NULL THEN CAST(0 AS SMALLINT) ELSE u.update_num END AS update_num,
  coalesce(b.tier, u.tier) AS tier FROM users u FULL JOIN user_batch b ON u.summonerid = b.summonerid""",
    ),
    "insert_if_absent": query(
        STATE,
        """SELECT * FROM state UNION ALL SELECT matchid, tier, FALSE FROM listed
  WHERE matchid NOT IN (SELECT matchid FROM state)
  QUALIFY row_number() OVER (PARTITION BY matchid ORDER BY seen, tier) = 1""",
    ),
    "keyed_update": query(
        USERS,
        """SELECT u.summonerid, CASE WHEN b.summonerid IS NULL THEN puuid ELSE 'Q_' || b.summonerid END AS puuid,
  u.match_num, update_num, u.tier FROM users u LEFT JOIN user_batch b ON u.summonerid = b.summonerid""",
    ),
    "repeated_update": query(
        STATE,
        LAST_LISTED,
        """SELECT s.matchid, coalesce(l.tier, s.tier) AS tier, s.status
  FROM state s LEFT JOIN last_listed l ON s.matchid = l.matchid""",
    ),
    "repeated_upsert": query(
        STATE,
        LAST_LISTED,
        """SELECT coalesce(s.matchid, l.matchid) AS matchid, coalesce(l.tier, s.tier) AS tier,
  CASE WHEN s.matchid IS NULL THEN FALSE ELSE s.status END AS status
  FROM state s FULL JOIN last_listed l ON s.matchid = l.matchid""",
    ),
    "table_append": f"""SELECT * FROM ({ORDER_ROWS}) WHERE date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""",
    "table_refresh": f"""SELECT * FROM (SELECT * FROM ({ORDER_ROWS}) WHERE o_orderpriority <> '5-LOW'
  UNION ALL SELECT * FROM ({ORDER_ROWS}) WHERE o_orderpriority = '1-URGENT')
  WHERE date > DATE '2001-01-01' - INTERVAL 1500 DAY""",
    "raw_day_round_trip": raw('SELECT "matchId", date FROM base'),
    "json_table_round_trip": "SELECT c_custkey, '소환사 ' || c_name AS name, c_acctbal FROM customer",
    "mark_done": query(
        STATE,
        """SELECT matchid, tier, CASE WHEN matchid IN (SELECT matchid FROM listed) THEN TRUE ELSE status END
  AS status FROM state""",
    ),
    "mark_in_flight": query(
        STATE,
        "next AS (SELECT matchid FROM state WHERE status = FALSE ORDER BY matchid LIMIT 500)",
        """SELECT matchid, tier, CASE WHEN matchid NOT IN (SELECT matchid FROM next) THEN status END AS status
  FROM state""",
    ),
    "settle_update_numbers": query(
        USERS, "SELECT * REPLACE (CASE WHEN update_num = 0 THEN match_num ELSE update_num END AS update_num) FROM users"
    ),
    "reset_in_flight": query(STATE, "SELECT * REPLACE (coalesce(status, FALSE) AS status) FROM state"),
    "backlog": query(STATE, "SELECT matchid, tier FROM state WHERE status = FALSE ORDER BY matchid LIMIT 500"),
    "done_count": query(STATE, "SELECT count(*) AS done FROM state WHERE status"),
    "fetch_priority": query(
        USERS,
        """fresh AS (SELECT *, CAST(match_num AS INT) - update_num AS new FROM users)""",
        """SELECT summonerid, puuid, tier, update_num FROM fresh
  WHERE trunc(new / nullif(CAST(trunc((new + 99) / 100) AS INT) + CASE WHEN puuid IS NULL THEN 1 ELSE 0 END, 0))
    > 20""",
    ),
    "json_values": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "top_k": """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '3-MEDIUM'
  ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""",
    "mask_rows": """SELECT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END AS o_orderkey,
  CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS o_custkey,
  CASE WHEN o_orderstatus = 'F' THEN o_orderstatus END AS o_orderstatus FROM orders""",
    "rank_first": """SELECT o_orderkey, o_orderpriority, o_totalprice, row_number() OVER (
  PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders""",
    "rank_ties": """SELECT p_partkey, p_size, row_number() OVER (ORDER BY p_size DESC, p_partkey) AS place
  FROM part""",
    "element_means": """SELECT CAST(label AS BIGINT) AS label, CAST(idx AS BIGINT) AS idx,
  round(avg(CAST(embedding[idx + 1] AS DOUBLE)), 6) AS mean FROM embeddings,
  unnest(range(len(embedding))) r(idx) GROUP BY ALL""",
    "record_reshape": query(RECORDS, "SELECT * FROM records"),
    "features_v1": query(
        RECORDS, features(1), "SELECT position, ordinal, round(x1, 6) AS x1, round(x2, 6) AS x2 FROM features"
    ),
    "features_v2": query(
        RECORDS, features(2), "SELECT position, ordinal, round(x1, 6) AS x1, round(x2, 6) AS x2 FROM features"
    ),
    "ols_fit": query(
        RECORDS,
        features(1),
        FITTED,
        "SELECT position, round(intercept, 6) AS intercept, round(b1, 6) AS b1, round(b2, 6) AS b2 FROM fitted",
    ),
    "predict_rank": predicted(1, 1.5, 3.5),
    "predict_rank_v2": predicted(2, 1.6, 5.5),
    "mean_pick_rate": query(
        RECORDS,
        """SELECT position, round(avg(pick_rate), 6) AS mean_pick_rate, count(*) AS rows FROM records
  GROUP BY position""",
    ),
    "stream_decode": """SELECT event_type AS topic, CAST(user_id AS VARCHAR) AS key, props AS value,
  '[' || event_type || '] ' || rpad(CAST(user_id AS VARCHAR), 12, ' ') || ' -> ' || props AS line FROM events""",
    "stream_state": """SELECT CAST(user_id AS VARCHAR) AS "user", ts, event_id, event_type, props FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "keyed_files": """SELECT event_type AS topic, CAST(user_id AS VARCHAR) AS key, props AS value, event_id,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM events""",
    "keyed_parts": query(
        STATE,
        """dealt AS (SELECT *, CAST(CAST('0x' || substr(md5(matchid), 1, 7) AS BIGINT) % 16 AS INT) AS part FROM state)""",
        "done AS (SELECT matchid, part FROM dealt WHERE status = FALSE ORDER BY matchid LIMIT 5)",
        """SELECT matchid, tier, CASE WHEN matchid IN (SELECT matchid FROM done) THEN TRUE ELSE status END AS status, part,
  CAST(CASE WHEN part IN (SELECT part FROM done) THEN 2 ELSE 1 END AS BIGINT) AS version FROM dealt""",
    ),
    "landed_batches": query(
        STATE,
        """SELECT matchid, tier, CASE WHEN tier IN ('1-URGENT', '2-HIGH') THEN TRUE ELSE status END AS status,
  CASE tier WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 END AS batch FROM state""",
    ),
    "daily_facts_with_gaps": query(
        FACTS,
        """days(y, run_date) AS (VALUES (1996, DATE '2024-01-02'), (1997, DATE '2024-01-03'), (1998, DATE '2024-01-05'),
  (2000, DATE '2024-01-06'), (2001, DATE '2024-01-07'))""",
        """SELECT run_date, "p_championId", count(*) AS rows, count(*) FILTER (p_win) AS wins
  FROM facts JOIN days ON year(date) = y GROUP BY run_date, "p_championId\"""",
    ),
    "document_sinks": f"""SELECT cohort, row_number() OVER (PARTITION BY cohort ORDER BY score DESC NULLS LAST) AS place, score
  FROM ({documents(FACTS, lane=True)})""",
    "masked_first": """SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
  ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""",
    "record_files": query(
        RECORDS, "SELECT * EXCLUDE (position, ordinal), p AS ordinal FROM (SELECT *, row_number() OVER (ORDER BY position_number, ordinal) AS p FROM records)"
    ).replace("SELECT 'POS_' ||", f"SELECT p_partkey // {PARTS_PER_POSITION} AS position_number, 'POS_' ||").replace("(position, ordinal)", "(position, ordinal, position_number, p)"),
    "json_run": """SELECT event_id, '}{ "' || ' [' || event_type AS note, CAST(user_id AS VARCHAR) AS first,
  CAST(json_extract(props, '$.k') AS VARCHAR) AS k FROM events""",
    "match_sketches": stats(FACTS, LADDER_ROWS, 'counted AS (SELECT cohort, count(DISTINCT "matchId") AS total_cnt FROM recent GROUP BY cohort)', "SELECT *, TRUE AS close FROM counted"),
    "part_item_builds": query(
        PART_SLOTS, f'SELECT {SLOT_KEYS}, start_items AS "itemStart", build AS "itemRarity", boots AS "itemBoots", mythic AS "itemMyth" FROM folded'
    ),
}
