"""Keyed tables of the fetch state: users and matches.

Each change is a join on the table's key that gives the new table. ``status`` of
a match is False while to be fetched, NULL while in flight and True when done.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlens.functions import tier_priority

# Fixed value: games one request lists.
PAGE = 100


def last_changes(changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Of the changes of a key the last by ``order``, of equal ones the greatest.

    Combined before the shuffle, so a key with very many changes is no hot key.
    """
    brought = [name for name in changes.columns if name != key]
    last = F.max(F.struct(F.struct(*order).alias("order"), F.struct(*brought).alias("change"))).alias("last")
    return changes.groupBy(key).agg(last).select(key, "last.change.*")


def upsert(
    table: DataFrame,
    batch: DataFrame,
    key: str,
    columns: list[str],
    defaults: dict[str, Column] | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Insert new keys; overwrite ``columns`` of known keys and keep their rest.

    Of a key that the batch repeats the last row by ``order`` counts, without
    ``order`` the greatest. Columns a batch does not bring get ``defaults`` or NULL.
    """
    batch = last_changes(batch, key, order or [c for c in batch.columns if c != key])
    joined = table.alias("t").join(batch.alias("b"), F.col(f"t.{key}") == F.col(f"b.{key}"), "full")
    arrived = F.col(f"b.{key}").isNotNull()
    known = F.col(f"t.{key}").isNotNull()
    selected = []
    for field in table.schema.fields:
        name = field.name
        if name == key:
            value = F.coalesce(f"t.{key}", f"b.{key}")
        elif name in columns:
            value = F.when(arrived, F.col(f"b.{name}")).otherwise(F.col(f"t.{name}"))
        else:
            default = (defaults or {}).get(name, F.lit(None))
            value = F.when(known, F.col(f"t.{name}")).otherwise(default)
        selected.append(value.cast(field.dataType).alias(name))
    return joined.select(*selected)


def insert_if_absent(
    table: DataFrame,
    batch: DataFrame,
    key: str,
    order: list[str],
    defaults: dict[str, Column] | None = None,
) -> DataFrame:
    """Add keys the table lacks; of a key repeated in the batch the first by ``order`` stays."""
    brought = [name for name in batch.columns if name in table.columns and name != key]
    firsts = batch.groupBy(key).agg(
        F.min_by(F.struct(*brought), F.struct(*order)).alias("first")
    )
    new = firsts.join(table.select(key), key, "left_anti").select(key, "first.*")
    missing = {
        name: (defaults or {}).get(name, F.lit(None)).cast(table.schema[name].dataType)
        for name in table.columns
        if name not in new.columns
    }
    return table.unionByName(new.withColumns(missing).select(*table.columns))


def keyed_update(table: DataFrame, changes: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """Set the columns a change brings on the rows with its key.

    Of a key that changes more than once the last change by ``order`` counts,
    without ``order`` the greatest. The columns of ``order`` are set as well if the table has them.
    """
    changes = last_changes(changes, key, order or [c for c in changes.columns if c != key])
    joined = table.alias("t").join(changes.alias("c"), F.col(f"t.{key}") == F.col(f"c.{key}"), "left")
    changed = F.col(f"c.{key}").isNotNull()
    selected = []
    for field in table.schema.fields:
        value = F.col(f"t.{field.name}")
        if field.name in changes.columns and field.name != key:
            value = F.when(changed, F.col(f"c.{field.name}")).otherwise(value)
        selected.append(value.cast(field.dataType).alias(field.name))
    return joined.select(*selected)


def settle_update_numbers(users: DataFrame) -> DataFrame:
    """Users never fetched start from their current number of games."""
    fresh = F.col("update_num") == 0
    return users.withColumn("update_num", F.when(fresh, F.col("match_num")).otherwise(F.col("update_num")))


def reset_in_flight(matches: DataFrame) -> DataFrame:
    """Matches left in flight are to be fetched again."""
    return matches.withColumn("status", F.coalesce("status", F.lit(False)))


def backlog(matches: DataFrame, batch_size: int) -> DataFrame:
    """Next matches to fetch."""
    todo = matches.where(~F.col("status")).select("matchid", "tier")
    return todo.orderBy("matchid").limit(batch_size)


def mark_in_flight(matches: DataFrame, batch: DataFrame) -> DataFrame:
    marked = batch.select("matchid", F.lit(None).cast("boolean").alias("status"))
    return keyed_update(matches, marked, "matchid")


def take_batch(matches: DataFrame, batch_size: int) -> tuple[DataFrame, DataFrame]:
    """The next matches to fetch, and the state in which they are in flight."""
    batch = backlog(matches, batch_size)
    return batch, mark_in_flight(matches, batch)


def mark_done(matches: DataFrame, landed: DataFrame) -> DataFrame:
    done = landed.select("matchid").distinct().withColumn("status", F.lit(True))
    return keyed_update(matches, done, "matchid")


def done_count(matches: DataFrame) -> DataFrame:
    return matches.where("status").agg(F.count("*").alias("done"))


def with_match_number(entries: DataFrame) -> DataFrame:
    """Games played, from wins and losses."""
    return entries.withColumn("match_num", F.col("wins") + F.col("losses"))


def fetch_priority(users: DataFrame, min_games_per_request: int) -> DataFrame:
    """Users worth fetching: new games per request above a limit, high tiers first.

    A page holds 100 games, and a user without a ``puuid`` costs one request
    more. The division is of whole numbers; users that need no request are left
    out. The id breaks ties, which also spreads the sort over its partitions.
    """
    new = F.col("match_num").cast("int") - F.col("update_num").cast("int")
    priced = users.withColumns({"new_games": new, "lookup": F.col("puuid").isNull().cast("int")})
    per_request = F.expr(f"new_games div nullif((new_games + {PAGE - 1}) div {PAGE} + lookup, 0)")
    return (
        priced.where(per_request > min_games_per_request)
        .select("summonerid", "puuid", "tier", "update_num")
        .orderBy(tier_priority(F.col("tier")), "summonerid")
    )
