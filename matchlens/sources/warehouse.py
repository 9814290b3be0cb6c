"""Warehouse tables: schemas, refresh, retention."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlens.operators.cohorts import recent_days_in_zone
from matchlens.schema import COUNTS, EVENT_FLAGS

# Partition expiry of the tables, and days the landing folders are kept.
EXPIRY_DAYS = 60
RETENTION_DAYS = 14

_LANES = ("TOP", "JUG", "MID", "ADC", "SUP")
_GOALS = ("BARON", "DRAGON", "RIFT_HERALD")


def _sided(names: tuple[str, ...]) -> str:
    return ", ".join(f"{side}_{name} INT" for side in ("BLUE", "RED") for name in names)


# Columns of each warehouse table; all are partitioned by date.
TABLES = {
    "match": "matchId STRING, tier STRING, gameDuration INT, gameVersion STRING, date DATE, "
    f"BLUE_WIN BOOLEAN, {_sided(_LANES)}, BANS ARRAY<INT>, {_sided(_GOALS)}, execution_date DATE",
    "pick": "tier STRING, date DATE, championId INT, win INT, pick INT, total INT, "
    "execution_date DATE",
    "ban": "tier STRING, date DATE, championId INT, ban INT, total INT, execution_date DATE",
    "champion": "tier STRING, date DATE, gameVersion STRING, gameDuration INT, matchId STRING, "
    "championId INT, teamPosition STRING, win BOOLEAN, damageTakenOnTeamPercentage DOUBLE, "
    "teamDamagePercentage DOUBLE, "
    + ", ".join(f"{name} INT" for name in COUNTS)
    + ", "
    + ", ".join(f"{name} BOOLEAN" for name in EVENT_FLAGS)
    + ", execution_date DATE",
}


def create_table(spark: SparkSession, kind: str, name: str) -> None:
    """Empty table of a kind, partitioned by date."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({TABLES[kind]}) USING parquet PARTITIONED BY (date)")


def _stored(facts: DataFrame, table: str) -> bool:
    """Make the table, partitioned by date, with these rows if there is none yet."""
    if facts.sparkSession.catalog.tableExists(table):
        return False
    facts.write.format("parquet").partitionBy("date").saveAsTable(table)
    return True


def append_facts(facts: DataFrame, table: str) -> None:
    """Add rows to a table, by column name; a table that is missing is made."""
    if not _stored(facts, table):
        facts.select(facts.sparkSession.table(table).columns).write.insertInto(table)


def full_refresh(facts: DataFrame, table: str) -> bool:
    """Replace the rows of a table by a selection; an empty selection leaves it alone.

    The table stays, with its columns and its partitioning.
    """
    if facts.isEmpty():
        return False
    if not _stored(facts, table):
        facts.select(facts.sparkSession.table(table).columns).write.insertInto(table, overwrite=True)
    return True


def read_dates(table: DataFrame, start: datetime.date, end: datetime.date) -> DataFrame:
    """Rows of a date range. Reading without a range is not offered."""
    if start is None or end is None:
        raise ValueError("a date range is required")
    return table.where(F.col("date").between(F.lit(start), F.lit(end)))


def expired_dates(
    spark: SparkSession, table: str, as_of: datetime.date, days: int
) -> list[datetime.date]:
    """Partition dates that have outlived ``days``; read from the catalog, not from rows."""
    named = spark.sql(f"SHOW PARTITIONS {table}").select(
        F.to_date(F.regexp_extract("partition", r"date=([^/]+)", 1)).alias("date")
    )
    old = named.where(F.col("date") <= F.lit(as_of - datetime.timedelta(days=days)))
    return [row["date"] for row in old.distinct().orderBy("date").collect()]


def drop_expired(
    spark: SparkSession, table: str, as_of: datetime.date, days: int = EXPIRY_DAYS
) -> list[datetime.date]:
    """Drop the partitions that have outlived ``days``."""
    old = expired_dates(spark, table, as_of, days)
    for day in old:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (date = DATE '{day.isoformat()}')")
    return old


def create_recent_view(
    facts: DataFrame, as_of: datetime.datetime, name: str, zone: str = "Asia/Seoul", days: int = 14
) -> None:
    """View of the last days in a zone, without early surrenders."""
    moment = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    recent_days_in_zone(facts, moment, zone, days).createOrReplaceTempView(name)
