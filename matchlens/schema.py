"""Schemas of the nested inputs, and their JSON form."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import types as T

# Field names of the match documents.
_OBJECTIVES = ("baron", "champion", "dragon", "inhibitor", "riftHerald", "tower")
IDENTITY = ("championId", "teamId", "summoner1Id", "summoner2Id")
COUNTS = (
    "kills",
    "deaths",
    "assists",
    "champExperience",
    "goldEarned",
    "totalMinionsKilled",
    "wardsPlaced",
    "wardsKilled",
    "detectorWardsPlaced",
    "visionScore",
    "timeCCingOthers",
    "physicalDamageDealtToChampions",
    "magicDamageDealtToChampions",
    "trueDamageDealtToChampions",
    "damageDealtToBuildings",
    "damageDealtToObjectives",
    "totalDamageTaken",
    "totalHeal",
    "totalHealsOnTeammates",
)
EVENT_FLAGS = ("firstBloodKill", "firstTowerKill", "gameEndedInSurrender", "gameEndedInEarlySurrender")
SHARES = ("teamDamagePercentage", "damageTakenOnTeamPercentage")
_FLAGS = ("win", *EVENT_FLAGS)
_NUMBERS = (*IDENTITY, *COUNTS)

LONG, TEXT, FLAG, DOUBLE = T.LongType(), T.StringType(), T.BooleanType(), T.DoubleType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def array(element: T.DataType) -> T.ArrayType:
    return T.ArrayType(element)


def each(names: tuple[str, ...], kind: T.DataType) -> dict[str, T.DataType]:
    return dict.fromkeys(names, kind)


PERKS = struct(
    statPerks=struct(defense=LONG, flex=LONG, offense=LONG),
    styles=array(
        struct(
            description=TEXT,
            selections=array(struct(perk=LONG, var1=LONG, var2=LONG, var3=LONG)),
            style=LONG,
        )
    ),
)
_PLAYED = {**each(_NUMBERS, LONG), "teamPosition": TEXT, **each(_FLAGS, FLAG)}
PARTICIPANT = struct(
    **_PLAYED,
    **each(SHARES, DOUBLE),
    perks=PERKS,
    skillTree=array(LONG),
    **each(("itemStart", "itemMiddle", "itemBuild", "itemRarity"), array(TEXT)),
    itemBoots=TEXT,
    itemMyth=TEXT,
)
TEAM = struct(
    teamId=LONG,
    win=FLAG,
    bans=array(struct(championId=LONG, pickTurn=LONG)),
    objectives=struct(**each(_OBJECTIVES, struct(first=FLAG, kills=LONG))),
)

# One nested match as the flatten job reads it.
RAW_MATCH = struct(
    metadata=struct(
        tier=TEXT, gameVersion=TEXT, matchId=TEXT, gameDuration=LONG, gameStartTimestamp=LONG
    ),
    queueId=LONG,
    participants=array(PARTICIPANT),
    teams=array(TEAM),
)

# The same match as it is fetched: everything below ``info``, shares below ``challenges``.
FETCHED_MATCH = struct(
    metadata=struct(tier=TEXT, matchId=TEXT),
    info=struct(
        gameCreation=LONG,
        gameDuration=LONG,
        gameVersion=TEXT,
        queueId=LONG,
        participants=array(
            struct(**_PLAYED, challenges=struct(**each(SHARES, DOUBLE)), perks=PERKS)
        ),
        teams=array(TEAM),
    ),
)

# Per-match event log; an event carries the fields of its type only.
TIMELINE = struct(
    matchId=TEXT,
    frames=array(
        struct(events=array(struct(type=TEXT, participantId=LONG, skillSlot=LONG, itemId=LONG)))
    ),
)

# Catalogue entries keyed by item id, and champions keyed by name.
_ITEM = {
    "tags": array(TEXT),
    "from": array(TEXT),
    "into": array(TEXT),
    "description": TEXT,
    "gold": struct(base=LONG),
}
ITEM_MAP = struct(data=T.MapType(TEXT, struct(**_ITEM)))
CHAMPION_MAP = struct(data=T.MapType(TEXT, struct(key=TEXT, id=TEXT)))

USERS = struct(
    summonerid=TEXT, puuid=TEXT, match_num=T.ShortType(), update_num=T.ShortType(), tier=TEXT
)
MATCH_STATE = struct(matchid=TEXT, tier=TEXT, status=FLAG)


def save_schema(schema: T.StructType, path: str | Path) -> None:
    Path(path).write_text(json.dumps(schema.jsonValue(), indent=1), encoding="utf-8")


def load_schema(path: str | Path) -> T.StructType:
    """Schema from its JSON document."""
    return T.StructType.fromJson(json.loads(Path(path).read_text(encoding="utf-8")))
