"""Nested matches to one row per participant, without a shuffle.

Lambdas over arrays are interpreted, so there is only one of them: the place of
every participant's opponent, found once per match. All other lookups use array
positions, which Spark compiles together with the explode; the match arrays are
read in place there and not copied to the participants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlens.functions import game_day
from matchlens.schema import COUNTS, EVENT_FLAGS, IDENTITY, SHARES

# Descriptions of the two rune styles.
PRIMARY = "primaryStyle"
SUB = "subStyle"

# Fields kept from a fetched match.
KEPT_FIELDS = ("perks", *IDENTITY, "teamPosition", "win", *COUNTS, *EVENT_FLAGS)


def where_equal(array: Column, field: str, value: Column) -> Column:
    """First struct whose field has the value, NULL where there is none."""
    return F.get(array, F.array_position(array[field], value).cast("int") - 1)


def canonical_matches(fetched: DataFrame) -> DataFrame:
    """Fetched documents in the flatten job's shape, reduced to the fields in use."""

    def kept(p: Column) -> Column:
        fields = [p[name].alias(name) for name in KEPT_FIELDS]
        fields += [p["challenges"][name].alias(name) for name in SHARES]
        return F.struct(*fields)

    return fetched.select(
        F.struct(
            F.lower("metadata.tier").alias("tier"),
            F.col("info.gameVersion").alias("gameVersion"),
            F.col("metadata.matchId").alias("matchId"),
            F.col("info.gameDuration").alias("gameDuration"),
            F.col("info.gameCreation").alias("gameStartTimestamp"),
        ).alias("metadata"),
        F.col("info.queueId").alias("queueId"),
        F.transform("info.participants", kept).alias("participants"),
        F.col("info.teams").alias("teams"),
    )


def rune_columns(participant: Column, prefix: str) -> list[Column]:
    """Flat arrays and style ids out of a participant's rune tree."""
    perks = participant["perks"]
    stats = perks["statPerks"]
    primary = where_equal(perks["styles"], "description", F.lit(PRIMARY))
    sub = where_equal(perks["styles"], "description", F.lit(SUB))
    listed = F.array(stats["defense"], stats["flex"], stats["offense"])
    return [
        F.when(participant.isNotNull(), listed).alias(f"{prefix}statPerks"),
        primary["style"].alias(f"{prefix}primaryStyle"),
        sub["style"].alias(f"{prefix}subStyle"),
        primary["selections"]["perk"].alias(f"{prefix}primaryStyles"),
        sub["selections"]["perk"].alias(f"{prefix}subStyles"),
    ]


def ban_of(participant: Column, ordinal: Column, teams: Column) -> Column:
    """Champion banned by the participant's own team in the participant's pick turn."""
    own = where_equal(teams, "teamId", participant["teamId"])
    return where_equal(own["bans"], "pickTurn", (ordinal + 1).cast("bigint"))["championId"]


def rival_places(participants: Column) -> Column:
    """For each participant the place of the first one in its position on another team."""

    def place(p: Column) -> Column:
        faces = F.transform(
            participants,
            lambda q: (q["teamPosition"] == p["teamPosition"]) & (q["teamId"] != p["teamId"]),
        )
        return F.array_position(faces, F.lit(True)).cast("int") - 1

    return F.transform(participants, place)


def match_columns() -> list[Column]:
    return [
        F.col("metadata.tier").alias("tier"),
        F.col("metadata.gameVersion").alias("gameVersion"),
        F.col("metadata.matchId").alias("matchId"),
        F.col("metadata.gameDuration").alias("gameDuration"),
        game_day(F.col("metadata.gameStartTimestamp")).alias("date"),
        F.col("queueId"),
    ]


def unnested(df: DataFrame, drop: tuple[str, ...] = ()) -> list[Column]:
    """Columns with every struct one level up, named by its first letter; the rest as it is."""
    columns = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            columns += [
                F.col(f"{field.name}.{inner.name}").alias(f"{field.name[0]}_{inner.name}")
                for inner in field.dataType.fields
                if inner.name not in drop
            ]
        else:
            columns.append(F.col(field.name))
    return columns


def flatten_matches(raw: DataFrame, with_opponent: bool = True) -> DataFrame:
    """One row per participant with ``p_*``, and for lane queues ``ban`` and ``o_*``.

    Lane queues keep a match without participants as one row of NULLs; without
    opponents such a match gives no row.
    """
    if not with_opponent:
        seats = raw.select(*match_columns(), F.explode("participants").alias("participant"))
        return seats.select(
            *unnested(seats, ("perks",)), *rune_columns(F.col("participant"), "p_")
        )

    prepared = raw.select(
        *match_columns(), "teams", "participants", rival_places(F.col("participants")).alias("rivals")
    )
    arrays = ("teams", "participants", "rivals")
    scalars = [name for name in prepared.columns if name not in arrays]
    exploded = prepared.select(
        *scalars, *arrays, F.posexplode_outer("participants").alias("ordinal", "participant")
    )
    seats = exploded.select(
        *scalars,
        "participant",
        ban_of(F.col("participant"), F.col("ordinal"), F.col("teams")).alias("ban"),
        F.get("participants", F.get("rivals", F.col("ordinal"))).alias("opponent"),
    )
    return seats.select(
        *unnested(seats, ("perks",)),
        *rune_columns(F.col("participant"), "p_"),
        *rune_columns(F.col("opponent"), "o_"),
    )
