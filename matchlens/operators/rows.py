"""Row selections: top rows, masks, ranks in order of appearance."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from matchlens.operators.joins import join_null_safe
from matchlens.session import work_folder

# Rows that a part of a ranked frame holds about.
PART_ROWS = 1_000_000


def top_rows(df: DataFrame, by: str, k: int = 5, ties: tuple[str, ...] = ()) -> DataFrame:
    """First ``k`` rows by descending value."""
    return df.orderBy(F.desc(by), *ties).limit(k)


def mask_rows(df: DataFrame, condition: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """All rows, with NULL in every column of those that fail the condition."""
    return df.select(
        *[F.col(c) if c in keep else F.when(condition, F.col(c)).alias(c) for c in df.columns]
    )


def rank_first(df: DataFrame, value: str, ordinal: str, name: str, by: list[str] | None = None) -> DataFrame:
    """Rank by descending value, nulls last, equal values in order of the unique ``ordinal``.

    One plan for groups of any size and any orderable types. The rows are
    written once, range-partitioned and sorted by group, value and ordinal, with
    their place in their part; the number of parts follows the number of rows.
    A row's place in the whole is its place in its part and the rows of the
    parts before; its rank, the places since its group began. The ordinal cuts
    ties and frequent values like all others.
    """
    by = by or []
    order = [*map(F.asc_nulls_first, by), F.desc_nulls_last(value), F.asc_nulls_first(ordinal)]
    folder = f"{work_folder(df.sparkSession)}/ranks-{uuid4().hex}"
    df.write.parquet(f"{folder}/rows")
    df = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/rows")
    parts = max(1, -(-df.count() // PART_ROWS))
    # The id of a row is its partition's number, shifted by 33 bits, and its place there.
    place = F.monotonically_increasing_id()
    df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("rank_place", place).write.parquet(f"{folder}/placed")
    placed = df.sparkSession.read.schema(StructType([*df.schema.fields, StructField("rank_place", LongType())])).parquet(f"{folder}/placed")

    part = F.shiftright("rank_place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    offsets = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    inside = F.col("rank_place").bitwiseAND(F.lit((1 << 33) - 1))
    spread = placed.withColumn("part", part).join(offsets, "part").withColumn("rank_place", F.col("offset") + inside).drop("part", "offset")
    if not by:
        return spread.withColumn(name, F.col("rank_place") + 1).drop("rank_place")
    starts = placed.groupBy(*by).agg(F.min("rank_place").alias("rank_start"))
    starts = starts.withColumn("part", F.shiftright("rank_start", 33)).join(offsets, "part")
    starts = starts.select(*by, (F.col("offset") + F.col("rank_start").bitwiseAND(F.lit((1 << 33) - 1))).alias("rank_start"))
    ranked = join_null_safe(spread, starts, by)
    return ranked.withColumn(name, F.col("rank_place") - F.col("rank_start") + 1).drop("rank_place", "rank_start")


def element_means(df: DataFrame, vector: str, by: list[str] | None = None) -> DataFrame:
    """Mean of each element over vectors of one length."""
    spread = df.select(*(by or []), F.posexplode(vector).alias("idx", "value"))
    return spread.groupBy(*(by or []), "idx").agg(F.avg(F.col("value").cast("double")).alias("mean"))
