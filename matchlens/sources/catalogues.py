"""Item and champion dimensions from nested JSON maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlens.schema import CHAMPION_MAP, ITEM_MAP


def items_of(catalogue: DataFrame) -> DataFrame:
    """One row per item of a catalogue map."""
    entries = catalogue.select(F.explode("data").alias("itemId", "item"))
    return entries.select("itemId", "item.*")


def champions_of(catalogue: DataFrame) -> DataFrame:
    """Champion number and name."""
    entries = catalogue.select(F.explode("data").alias("entry", "champion"))
    return entries.select(
        F.col("champion.key").try_cast("int").alias("id"), F.col("champion.id").alias("name")
    )


def read_items(spark: SparkSession, path: str) -> DataFrame:
    return items_of(spark.read.schema(ITEM_MAP).json(path, multiLine=True))


def read_champions(spark: SparkSession, path: str) -> DataFrame:
    return champions_of(spark.read.schema(CHAMPION_MAP).json(path, multiLine=True))
