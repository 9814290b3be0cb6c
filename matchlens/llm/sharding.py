"""Shards of equal bytes: the leaves of a k-d tree over the rows' metadata.

A node with ``k`` shards is cut at the weighted quantile of its ``k // 2``
along the dimension in which its rows spread widest, relative to all rows,
until every leaf is one shard.

The tree is grown over cells, not rows. A cell is what agrees in all coordinates and in
as many leading bits of a tail as its weight asks for, so that a cell holds about
``1 / FINE`` of a shard, or one row. The tail is made of bits of the text's checksum, then of a hash of
the row, so rows of one value, such as a source with a third of all rows, are
cut like any others, and equal texts stay together unless a cut falls among them. Cells are
at most as many as rows, and some ``FINE`` for each shard where rows are many
and their coordinates few. A cut is exact to a cell.

Everything about a level stays in written tables: the histograms of all open
nodes in all dimensions, taken in one pass over the cells; the tails of the cells at the
crossing coordinates; the cuts, a row for each node. A cell carries its node as the first shard and the number
of shards. Windows run over the coordinates of a node, at most ``2 ** COORDINATE_BITS``, or over
half of the bits of a tail. Nothing grows in the plan with the number of shards,
and the driver sees the total, the spans of the dimensions and the rows of the largest shard only.

Slots are numbered in parts: rows are dealt by a hash to parts of about
``PART_ROWS``, numbered inside a part, and moved by the counts before it.

Defined cases: a null text has no bytes and checksum 0; null metadata counts as
0 or the empty text; rows that agree in id, size, checksum and metadata are
counted for each part of the input, in bunches of at most a cell, and given out last, so a repeated row is no hot key and
cuts fall among its copies; with fewer rows than shards some shards stay empty; an empty table gives an
empty one; other columns are not read, and those of the result cannot clash
with them.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlens.session import work_folder

OVERHEAD = 16
COORDINATE_BITS, CHECKSUM_BITS, ROW_BITS = 18, 16, 32
TAIL_BITS = CHECKSUM_BITS + ROW_BITS
#: Steps of a number for each time it doubles.
STEPS = 16
#: Cells that a shard is made of, at least, where rows allow it.
FINE = 1024
PART_ROWS = 20_000


def _coordinate(df: DataFrame, name: str) -> Column:
    """A metadata column as a number of ``COORDINATE_BITS``: numbers on a log scale, texts by hash."""
    if df.schema[name].dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal"):
        magnitude = F.log2(1 + F.abs(F.coalesce(F.col(f"`{name}`").cast("double"), F.lit(0.0)))) * STEPS
        return F.least(magnitude.cast("long"), F.lit((1 << COORDINATE_BITS) - 1))
    return F.pmod(F.xxhash64(F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))), F.lit(1 << COORDINATE_BITS)).cast("long")


class _Tables:
    """Tables of one run in the shared folder."""

    def __init__(self, df: DataFrame):
        self.spark = df.sparkSession
        self.folder = f"{work_folder(self.spark)}/shards-{uuid4().hex}"

    def written(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")


def _bits(weight: Column, grain: int, most: int) -> Column:
    """Bits that deal a weight to cells of ``grain``."""
    return F.least(F.lit(most), F.greatest(F.lit(0), F.ceil(F.log2(weight / F.lit(float(grain)))))).cast("int")


def _leading(number: Column, size: int, bits: Column) -> Column:
    """A number of ``size`` bits without all but its first ``bits``."""
    unit = F.pow(F.lit(2.0), F.lit(size) - bits).cast("long")
    return number - number % unit


def _cells(rows: DataFrame, tables: _Tables, places: list[str], grain: int) -> DataFrame:
    """Rows in bunches of at most a cell's weight, with the ``tail`` of their cell."""
    bunch = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(grain) / F.col("size")))
    dealt = (
        rows.withColumn("bunch", bunch)
        .withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / F.col("bunch")))))
        .withColumn("copies", F.least(F.col("bunch"), F.col("copies") - F.col("at") * F.col("bunch")))
        .withColumn("bytes", F.col("size") * F.col("copies"))
        .withColumn("checksum", F.shiftright(F.col("text_crc32"), 32 - CHECKSUM_BITS))
        .withColumn("row", F.pmod(F.xxhash64("row_id", "text_crc32", "part", "at"), F.lit(1 << ROW_BITS)))
    )
    sums = tables.written(dealt.groupBy(*places, "checksum").agg(F.sum("bytes").alias("bytes")), "sums")
    weights = sums.groupBy(places).agg(F.sum("bytes").alias("weight"))
    bits = weights.select(*places, _bits(F.col("weight"), grain, CHECKSUM_BITS).alias("bits"))
    led = sums.join(bits, places).withColumn("led", _leading(F.col("checksum"), CHECKSUM_BITS, F.col("bits")))
    # What some bits of the checksum leave heavy, such as one text of many rows, is dealt by the row's hash.
    finer = led.groupBy(*places, "led").agg(_bits(F.sum("bytes"), grain, ROW_BITS).alias("finer"))
    dealing = tables.written(led.join(finer, [*places, "led"]).select(*places, "checksum", "led", "finer"), "dealing")
    tail = F.col("led") * (1 << ROW_BITS) + _leading(F.col("row"), ROW_BITS, F.col("finer"))
    kept = ["row_id", "size", "text_crc32", "part", "at", "copies", "bytes", *places]
    return tables.written(dealt.join(dealing, [*places, "checksum"]).select(*kept, tail.alias("tail")), "rows")


def _crossing(sums: DataFrame, group: list[str], digit: str, need: Column) -> DataFrame:
    """The one row of every group by whose ``digit`` ``need`` bytes are reached, and as ``need`` what is needed within it."""
    so_far = F.sum("bytes").over(Window.partitionBy(group).orderBy(digit))
    summed = sums.withColumn("need", need).withColumn("so_far", so_far)
    is_first, before = F.col("so_far") == F.col("bytes"), F.col("so_far") - F.col("bytes")
    hit = summed.filter((F.col("so_far") >= F.col("need")) & (is_first | (before < F.col("need"))))
    return hit.withColumn("need", F.col("need") - before).drop("so_far", "bytes")


def _crossed_coordinates(sums: DataFrame, widest: list[int]) -> DataFrame:
    """Every node's widest dimension, the coordinate at which its low shards' part of the bytes ends, and the bytes needed there."""
    group = ["first", "shards", "dimension"]
    every = Window.partitionBy(group)
    spread = sums.withColumns({"span": F.max("coordinate").over(every) - F.min("coordinate").over(every), "total": F.sum("bytes").over(every)})
    half, rest = F.floor(F.col("shards") / 2), F.col("total") % F.col("shards")
    need = (F.col("total") - rest) / F.col("shards") * half + rest * half / F.col("shards")
    share = F.col("span") / F.get(F.array(*(F.lit(float(w)) for w in widest)), F.col("dimension"))
    found = _crossing(spread, group, "coordinate", F.floor(need)).select("first", share.alias("share"), (-F.col("dimension")).alias("rank"), "coordinate", "need")
    best = found.groupBy("first").agg(F.max(F.struct("share", "rank", "coordinate", "need")).alias("best"))
    return best.select("first", (-F.col("best.rank")).alias("dimension"), "best.coordinate", "best.need")


def _crossed_tails(tails: DataFrame) -> DataFrame:
    """The tail of the last cell on the low side of every node, digit by digit."""
    node = ["first", "dimension", "coordinate"]
    leading = tails.groupBy(*node, "need", "d0").agg(F.sum("bytes").alias("bytes"))
    found = _crossing(leading, ["first"], "d0", F.col("need"))
    last = _crossing(tails.drop("need").join(found, [*node, "d0"]), ["first"], "d1", F.col("need"))
    return last.select(*node, (F.col("d0") * (1 << TAIL_BITS // 2) + F.col("d1")).alias("cut_tail"))


def grow(cells: DataFrame, tables: _Tables, places: list[str], shards: int) -> DataFrame:
    """``first``, the shard, of every cell of ``places``, ``tail`` and ``bytes``."""
    cells = cells.withColumns({"first": F.lit(0), "shards": F.lit(shards)})
    own = F.get(F.array(*places), F.col("dimension"))
    widest = None
    for level in range((shards - 1).bit_length()):
        still = cells.filter(F.col("shards") > 1)
        in_each = still.select("first", "shards", "bytes", F.posexplode(F.array(*places)).alias("dimension", "coordinate"))
        sums = in_each.groupBy("first", "shards", "dimension", "coordinate").agg(F.sum("bytes").alias("bytes"))
        sums = tables.written(sums, f"{level}-sums")
        if widest is None:
            spans = sums.groupBy("dimension").agg((F.max("coordinate") - F.min("coordinate")).alias("span")).collect()
            widest = [max([1, *(s["span"] for s in spans if s["dimension"] == d)]) for d in range(len(places))]
        nodes = tables.written(_crossed_coordinates(sums, widest), f"{level}-nodes")

        size = 1 << TAIL_BITS // 2
        digits = [F.shiftright(F.col("tail"), TAIL_BITS // 2).alias("d0"), (F.col("tail") % size).alias("d1")]
        at_cut = still.join(nodes, "first").filter(own == F.col("coordinate"))
        tails = at_cut.select(*nodes.columns, *digits, "bytes").groupBy(*nodes.columns, "d0", "d1").agg(F.sum("bytes").alias("bytes"))
        cuts = tables.written(_crossed_tails(tables.written(tails, f"{level}-tails")), f"{level}-cuts")

        half = F.floor(F.col("shards") / 2).cast("int")
        high = (own > F.col("coordinate")) | ((own == F.col("coordinate")) & (F.col("tail") > F.col("cut_tail")))
        moved = cells.join(cuts, "first", "left").withColumn("high", F.coalesce((F.col("shards") > 1) & high, F.lit(False)))
        low = F.greatest(F.lit(1), half)
        cells = moved.select(
            F.when(F.col("high"), F.col("first") + half).otherwise(F.col("first")).alias("first"),
            F.when(F.col("high"), F.col("shards") - half).otherwise(low).alias("shards"),
            *places, "tail", "bytes",
        )
        cells = tables.written(cells, f"{level}-cells")
    return cells.select(*places, "tail", F.col("first").alias("shard"))


def shard(
    df: DataFrame, shards: int | None = None, target_bytes: int | None = None, key: str = "doc_id", text: str = "text", metadata: tuple[str, ...] = ("source", "lang", "n_chars")
) -> DataFrame:
    """``key``, size, text_crc32, shard and slot of every row.

    Give the number of shards, or the bytes that one should have.
    """
    source = F.col(f"`{text}`").cast("string")
    places = [f"c{d}" for d in range(len(metadata))]
    plain = df.select(
        F.col(f"`{key}`").alias("row_id"),
        (F.coalesce(F.octet_length(source), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.crc32(source), F.lit(0)).cast("long").alias("text_crc32"),
        *(_coordinate(df, name).alias(place) for place, name in zip(places, metadata)),
        F.spark_partition_id().alias("part"),
    )
    tables = _Tables(df)
    folded = tables.written(plain.groupBy(plain.columns).agg(F.count("*").alias("copies")), "folded")
    total = folded.agg(F.sum(F.col("size") * F.col("copies"))).first()[0] or 0
    if shards is None:
        shards = max(1, -(-total // target_bytes))

    rows = _cells(folded, tables, places, max(1, total // shards // FINE))
    cells = tables.written(rows.groupBy(*places, "tail").agg(F.sum("bytes").alias("bytes")), "cells")
    placed = tables.written(rows.join(grow(cells, tables, places, shards), [*places, "tail"]).drop(*places, "tail", "bytes"), "placed")
    return _with_slots(placed).select(F.col("row_id").alias(key), "size", "text_crc32", "shard", "slot")


def _with_slots(placed: DataFrame) -> DataFrame:
    """Number the rows of each shard from 0, without a task that holds a whole shard."""
    most = placed.groupBy("shard").agg(F.sum("copies").alias("n")).agg(F.max("n")).first()[0] or 0
    deals = -(-most // PART_ROWS) or 1
    dealt = placed.withColumn("deal", F.pmod(F.xxhash64("row_id", "text_crc32", "size", "part", "at"), F.lit(deals)).cast("long"))
    counts = dealt.groupBy("shard", "deal").agg(F.sum("copies").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("deal")) - F.col("n")
    starts = counts.select("shard", "deal", before.alias("start"))
    # Rows equal in all of these differ in their metadata alone and show the same result, whatever their order.
    inside = Window.partitionBy("shard", "deal").orderBy("row_id", "text_crc32", "size", "part", "at")
    numbered = dealt.withColumn("behind", F.sum("copies").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("copies"))
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    return numbered.join(starts, ["shard", "deal"]).withColumn("copy", copy).withColumn("slot", F.col("start") + F.col("behind") + F.col("copy"))
