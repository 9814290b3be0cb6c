"""Raw matches, landing batches and flat facts by day."""

from __future__ import annotations

import datetime
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlens.operators.flatten import canonical_matches
from matchlens.operators.state import keyed_update, mark_done
from matchlens.operators.timeline import fold_timelines, merge_slots
from matchlens.schema import FETCHED_MATCH, MATCH_STATE, RAW_MATCH
from matchlens.session import work_folder
from matchlens.sources.committed import PARTS, Batch
from matchlens.sources.text_files import json_texts, numbered_lines

RUN_DATE = "run_date"

# Columns of facts that the documents of any queue read.
DOCUMENT_COLUMNS = (
    "matchId", "tier", "gameVersion", "gameDuration", "date", "ban", "o_championId", "p_championId", "p_teamPosition",
    "p_teamId", "p_win", "p_gameEndedInEarlySurrender", "p_physicalDamageDealtToChampions", "p_magicDamageDealtToChampions",
    "p_trueDamageDealtToChampions", "p_teamDamagePercentage", "p_damageTakenOnTeamPercentage", "p_summoner1Id", "p_summoner2Id",
    "p_statPerks", "p_primaryStyles", "p_subStyles", "p_itemStart", "p_itemMiddle", "p_itemBuild", "p_skillTree",
)


def day_folder(root: str, queue: str, day: datetime.date) -> str:
    return f"{root}/queue={queue}/{RUN_DATE}={day.isoformat()}"


def read_raw(
    spark: SparkSession, root: str, queue: str, day: datetime.date, schema: T.StructType = RAW_MATCH
) -> DataFrame:
    """One day of nested matches under an enforced schema."""
    return spark.read.schema(schema).parquet(f"{day_folder(root, queue, day)}/*.parquet")


def write_raw(raw: DataFrame, root: str, queue: str, day: datetime.date) -> None:
    raw.write.mode("overwrite").parquet(day_folder(root, queue, day))


def land_matches(documents: DataFrame, state: DataFrame, folder: str, state_folder: str) -> None:
    """Write a batch of fetched documents as JSON, then the state with its matches done.

    The new state goes to a folder of its own; a reader switches to it only
    after both writes are committed, so a failed batch changes nothing.
    """
    documents.write.mode("overwrite").json(folder)
    landed = read_landed(documents.sparkSession, folder).select(
        F.col("metadata.matchId").alias("matchid")
    )
    mark_done(state, landed).write.mode("overwrite").parquet(state_folder)


def land_day(
    fetched: DataFrame, timelines: DataFrame, items: DataFrame, state: DataFrame, root: str, queue: str, day: datetime.date, state_folder: str, rejected_folder: str
) -> None:
    """A day's fetched matches with their timelines as raw matches, the new state, and what was rejected.

    Matches whose log is missing, invalid, or short of ten seats are not
    written; ``rejected_folder`` lists them, and in the state they are to be
    fetched again. The state is written last, to a folder of its own.
    """
    folded = fold_timelines(timelines, items, keep_invalid=True)
    canonical = canonical_matches(fetched)
    write_raw(merge_slots(canonical, folded.where("valid")), root, queue, day)
    landed = read_raw(fetched.sparkSession, root, queue, day).select(F.col("metadata.matchId").alias("matchid"))
    asked = canonical.select(F.col("metadata.matchId").alias("matchid")).distinct()
    asked.join(landed, "matchid", "left_anti").write.mode("overwrite").parquet(rejected_folder)
    rejected = fetched.sparkSession.read.schema("matchid string").parquet(rejected_folder)
    again = keyed_update(mark_done(state, landed), rejected.withColumn("status", F.lit(False)), "matchid")
    again.write.mode("overwrite").parquet(state_folder)


def land_batch(spark: SparkSession, root: str, documents: DataFrame, number: int, match_id: Column, parts: int = PARTS) -> bool:
    """Land a batch and mark its matches done, visible together; False if it had been landed.

    ``matches`` is the keyed state below ``root``, ``documents`` what is landed, one part for each batch.
    A run that fails before the marker leaves both as they were, and can be repeated.
    """
    batch = Batch(spark, root)
    if number <= batch.done("landing"):
        return False
    landed = batch.land("documents", documents, number).select(match_id.alias("matchid"))
    batch.change("matches", MATCH_STATE, landed, "matchid", mark_done, parts)
    batch.record("landing", number)
    batch.commit()
    return True


def read_landed(spark: SparkSession, folder: str, schema: T.StructType = FETCHED_MATCH) -> DataFrame:
    return spark.read.schema(schema).json(folder)


def write_facts(facts: DataFrame, root: str, queue: str, day: datetime.date) -> None:
    """Replace one day of facts; running a day again gives the same dataset."""
    facts.write.mode("overwrite").parquet(day_folder(root, queue, day))


def read_recent(
    spark: SparkSession,
    root: str,
    queue: str,
    as_of: datetime.date,
    schema: T.StructType,
    days: int = 14,
    with_today: bool = False,
) -> DataFrame:
    """Facts of the last ``days`` daily datasets that exist, as one pruned scan.

    The day itself is left out unless ``with_today``. Without any dataset the
    frame is empty and typed.
    """
    start = as_of - datetime.timedelta(days=days)
    partitioned = T.StructType([*schema.fields, T.StructField(RUN_DATE, T.DateType())])
    try:
        facts = spark.read.schema(partitioned).parquet(f"{root}/queue={queue}")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], partitioned)
    chosen = facts.where(F.col(RUN_DATE) >= F.lit(start))
    return chosen if with_today else chosen.where(F.col(RUN_DATE) < F.lit(as_of))


def stored_facts(facts: DataFrame, columns: tuple[str, ...] = DOCUMENT_COLUMNS) -> DataFrame:
    """The columns that documents read, written to the shared work folder and read back.

    The daily jobs read the facts of the flatten job instead. This is for facts
    that are still to be computed, since a document reads them once per relation.
    Nothing is shuffled; the folder goes with the work folder.
    """
    spark = facts.sparkSession
    target = f"{work_folder(spark)}/facts-{uuid.uuid4()}"
    kept = facts.select(*[c for c in columns if c in facts.columns])
    kept.write.parquet(target)
    return spark.read.schema(kept.schema).parquet(target)


def read_json_values(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Rows from a file of JSON values, one per line."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def read_json_run(spark: SparkSession, path: str, schema: T.StructType, split_bytes: int | None = None) -> DataFrame:
    """Rows from files of JSON values run together: several on a line, or one over many lines."""
    texts = json_texts(numbered_lines(spark, path, split_bytes))
    return texts.select(F.from_json("json", schema).alias("value")).select("value.*")
