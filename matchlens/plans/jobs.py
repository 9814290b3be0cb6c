"""The jobs of a day.

``python -m matchlens.plans.jobs flatten --queue solo --execution-date 2024-01-02
--raw s3://…/raw --facts s3://…/facts``
"""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import DataFrame, SparkSession

from matchlens.operators.document import aram_documents, champion_documents
from matchlens.operators.flatten import flatten_matches
from matchlens.schema import ITEM_MAP, MATCH_STATE, RAW_MATCH, TIMELINE
from matchlens.session import build_session
from matchlens.sources.catalogues import items_of
from matchlens.sources.documents import write_documents
from matchlens.sources.matches import RUN_DATE, land_day, read_landed, read_raw, read_recent, write_facts
from matchlens.sources.warehouse import full_refresh

LANE_QUEUES = ("solo", "flex")
ARAM = "aram"
QUEUES = (*LANE_QUEUES, ARAM)


def fact_schema(spark: SparkSession, queue: str):
    """Schema of a queue's facts, as flattening the raw schema gives it."""
    empty = spark.createDataFrame([], RAW_MATCH)
    return flatten_matches(empty, queue != ARAM).schema


def land(
    spark: SparkSession, fetched: str, timelines: str, items: str, state: str, raw_root: str, out: str, queue: str, day: datetime.date
) -> None:
    """Fetched matches and timelines to a raw day; new state and rejected matches under ``out``."""
    land_day(
        read_landed(spark, fetched),
        spark.read.schema(TIMELINE).json(timelines),
        items_of(spark.read.schema(ITEM_MAP).json(items)),
        spark.read.schema(MATCH_STATE).parquet(state),
        raw_root,
        queue,
        day,
        f"{out}/state/{RUN_DATE}={day.isoformat()}",
        f"{out}/rejected/{RUN_DATE}={day.isoformat()}",
    )


def flatten_day(
    spark: SparkSession, raw_root: str, facts_root: str, queue: str, day: datetime.date
) -> None:
    """Flatten one day of raw matches."""
    facts = flatten_matches(read_raw(spark, raw_root, queue, day), queue != ARAM)
    write_facts(facts, facts_root, queue, day)


def recent_facts(
    spark: SparkSession, facts_root: str, queue: str, as_of: datetime.date, with_today: bool = False
) -> DataFrame:
    schema = fact_schema(spark, queue)
    return read_recent(spark, facts_root, queue, as_of, schema, with_today=with_today).drop(RUN_DATE)


def statistics(
    spark: SparkSession, facts_root: str, out: str, queue: str, as_of: datetime.date
) -> None:
    """Statistics documents of a queue from its last daily facts."""
    facts = recent_facts(spark, facts_root, queue, as_of)
    make = aram_documents if queue == ARAM else champion_documents
    write_documents(make(facts, as_of), out, queue)


def refresh(
    spark: SparkSession, facts_root: str, table: str, queue: str, as_of: datetime.date
) -> bool:
    """Reload the warehouse table with the last days, today included."""
    return full_refresh(recent_facts(spark, facts_root, queue, as_of, with_today=True), table)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("job", choices=("land", "flatten", "statistics", "refresh"))
    parser.add_argument("--queue", choices=QUEUES, required=True)
    parser.add_argument("--execution-date", type=datetime.date.fromisoformat, required=True)
    parser.add_argument("--raw")
    parser.add_argument("--facts")
    parser.add_argument("--fetched")
    parser.add_argument("--timelines")
    parser.add_argument("--items")
    parser.add_argument("--state")
    parser.add_argument("--out", help="document folder, warehouse table, or folder of state and rejected matches")
    args = parser.parse_args(arguments)

    spark = build_session(f"{args.queue}_{args.job}")
    if args.job == "land":
        land(spark, args.fetched, args.timelines, args.items, args.state, args.raw, args.out, args.queue, args.execution_date)
    elif args.job == "flatten":
        flatten_day(spark, args.raw, args.facts, args.queue, args.execution_date)
    elif args.job == "statistics":
        statistics(spark, args.facts, args.out, args.queue, args.execution_date)
    else:
        refresh(spark, args.facts, args.out, args.queue, args.execution_date)


if __name__ == "__main__":
    main()
