"""Exact top-k by inner product: three phases with a uniform threshold.

The dimensions are cut into ``LISTS`` groups. A group's share of the inner product is a local
score, and the candidates by that score are the group's list; a total is the sum of a candidate's local scores.

1. Local score lists are gathered: of each list the first ``k`` candidates of a block, with their totals. The
   ``k``-th best of all totals gathered for a query is its cutoff. It is safe, as ``k`` real candidates reach it.
2. The cutoff goes back with the query to every block. A candidate that reaches it has a local score of at least
   ``cutoff / LISTS`` in some list, the uniform threshold; these entries are collected. Where a candidate's entry in
   a list is missing, its local score is below the threshold, which bounds the total from above.
3. Totals that may still reach the cutoff are resolved exactly, and the first ``k`` of them stay.

Vectors are written once, in blocks of rows with one matrix each. Queries, a stated share of all rows, are packed into
blocks as well, and each of them meets each block of candidates in an equi-join on a group number: the blocks of
queries are repeated for every group, candidates are not. Groups are so few that the repeats are no more than the
candidates, unless that leaves cores idle. Both sides are shuffled, so no vector passes through the driver. A pair of
blocks gives at most ``k`` rows for a query, so what is shuffled for the ranks is small, and ranks are cut in each task
before they are cut as a whole.

Defined cases: vectors that are null or hold null or non-finite components take no part; of vectors of different lengths
the shorter one counts as ended by zeros, and an empty one scores zero; a null key is no query, and a candidate that
comes last among ties; repeated keys are rows of their own, and a query meets the other rows of its key; ties beyond
the key are broken by the place of the row; fewer candidates than ``k`` give fewer rows; an empty table, or one without
queries, gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlens.llm.vectors import scaled
from matchlens.session import work_folder

#: Groups of dimensions.
LISTS = 4
#: Rows of a block of candidates and of a block of queries.
ROWS, QUERIES = 4096, 256
#: Blocks of candidates for which the queries are repeated once.
TOGETHER = 16
#: Groups for every core, where queries are many.
GROUPS_A_CORE = 4
#: Below every total that 64 bits hold exactly as a double.
NONE = -(1 << 62)

BLOCK = "ids array<long>, asks array<boolean>, width int, m binary"


def _padded(column: pa.ListArray) -> np.ndarray:
    """Rows of lists of any length, ended by zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype=np.int32)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _block_rows(size: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            x = _padded(part.column(1))
            columns = [pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([part.column(2).to_pylist()]), pa.array([x.shape[1]], pa.int32()), pa.array([x.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["ids", "asks", "width", "m"])


def _matrix(raw: bytes, rows: int, width: int) -> np.ndarray:
    return np.frombuffer(raw, np.int32).reshape(rows, width)


def _query_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a block that are queries, each with its place."""
    for batch in batches:
        for row in batch.to_pylist():
            places = np.flatnonzero(row["asks"])
            x = _matrix(row["m"], len(row["ids"]), row["width"])[places]
            columns = [pa.array(np.full(len(places), row["block"])), pa.array(places), pa.array([row["ids"][p] for p in places], pa.int64()), pa.array(list(x), pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "place", "id", "x"])


def _packed_rows(size: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            x = _padded(part.column(3))
            lists = [pa.array([part.column(i).to_pylist()], pa.list_(pa.int64())) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*lists, pa.array([x.shape[1]], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["q_blocks", "q_places", "q_ids", "q_width", "q_m"])


def local_scores(q: np.ndarray, c: np.ndarray, lists: int = LISTS) -> list[np.ndarray]:
    """Score of every query and candidate in each list, exact; doubles where they hold all sums exactly."""
    width = min(q.shape[1], c.shape[1])
    most = int(np.abs(q).max(initial=0)) * int(np.abs(c).max(initial=0)) * max(width, 1) * lists
    kind = np.float64 if most < 1 << 53 else np.int64
    q, c = q[:, :width].astype(kind), c[:, :width].astype(kind)
    cuts = [round(width * i / lists) for i in range(lists + 1)]
    return [q[:, a:b] @ c[:, a:b].T for a, b in zip(cuts, cuts[1:])]


def gather(scores: list[np.ndarray], k: int) -> np.ndarray:
    """Best totals among the first ``k`` of every list, ``NONE`` where there are fewer; a row for each query."""
    totals = sum(scores)
    k = min(k, totals.shape[1])
    firsts = np.concatenate([np.argpartition(-s, k - 1, axis=1)[:, :k] for s in scores], axis=1)
    firsts.sort(axis=1)
    found = np.take_along_axis(totals, firsts, axis=1)
    found[:, 1:][firsts[:, 1:] == firsts[:, :-1]] = NONE  # one candidate may lead several lists
    return -np.partition(-found, k - 1, axis=1)[:, :k]


def collect(scores: list[np.ndarray], cutoff: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Query and candidate places whose total may reach the query's cutoff."""
    cutoff = cutoff.astype(scores[0].dtype)[:, None]
    n = len(scores)
    seen = [s * n >= cutoff for s in scores]
    bound = sum(np.where(there, s * n, cutoff) for s, there in zip(scores, seen))  # n times the greatest total
    return np.nonzero(np.logical_or.reduce(seen) & (bound >= n * cutoff))


def _pair(row: dict) -> tuple[list[np.ndarray], np.ndarray]:
    """Local scores of a pair of blocks, and where a query meets its own row."""
    q = _matrix(row["q_m"], len(row["q_ids"]), row["q_width"])
    c = _matrix(row["m"], len(row["ids"]), row["width"])
    own = np.zeros((len(q), len(c)), dtype=bool)
    for number, (block, place) in enumerate(zip(row["q_blocks"], row["q_places"])):
        if block == row["block"]:
            own[number, place] = True
    return local_scores(q, c), own


def _one_by_one(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def _gathered_rows(k: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _one_by_one(batches):
        scores, own = _pair(row)
        for s in scores:
            s[own] = NONE // len(scores)
        best = gather(scores, k)
        number, place = np.nonzero(best > NONE // 2)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(number), row["pack"])), pa.array(number.astype(np.int32)), pa.array(best[number, place].astype(np.int64))], names=["pack", "number", "total"])


def _resolved_rows(k: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _one_by_one(batches):
        scores, own = _pair(row)
        cutoff = np.full(len(row["q_ids"]), NONE // LISTS, dtype=np.int64)
        for cut in row["cutoffs"] or []:
            cutoff[cut["number"]] = cut["cutoff"]
        number, place = collect(scores, cutoff)
        there = ~own[number, place]
        number, place = number[there], place[there]
        total = sum(s[number, place] for s in scores).astype(np.int64)
        reached = total >= cutoff[number]
        number, place, total = number[reached], place[reached], total[reached]
        last = np.iinfo(np.int64).max
        ids = np.array([last if i is None else i for i in row["ids"]], dtype=np.int64)
        unnamed = np.array([i is None for i in row["ids"]])
        order = np.lexsort((place, ids[place], unnamed[place], -total, number))
        number, place, total = number[order], place[order], total[order]
        rank = np.arange(len(number)) - np.searchsorted(number, number)
        kept = rank < k
        number, place, total = number[kept], place[kept], total[kept]
        columns = [
            pa.array(np.full(len(number), row["pack"])), pa.array(number.astype(np.int32)), pa.array([row["q_ids"][n] for n in number], pa.int64()),
            pa.array([row["ids"][p] for p in place], pa.int64()), pa.array(np.full(len(number), row["block"])), pa.array(place), pa.array(total),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["pack", "number", "query_id", "id", "block", "place", "score"])


def search(
    df: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = 10, scale: int = 1024, block_rows: int = ROWS, pack_rows: int = QUERIES
) -> DataFrame:
    """``query_id``, ``rank``, ``key`` and ``score``: the ``k`` best other rows of every row that ``queries`` is true for.

    Blocks hold ``block_rows`` candidates or ``pack_rows`` queries, each with its matrix.
    """
    spark = df.sparkSession
    folder = f"{work_folder(spark)}/search-{uuid4().hex}"
    whole = scaled(df, key, vector, scale, more={"asks": F.coalesce(queries & F.col(f"`{key}`").isNotNull(), F.lit(False))})
    made = whole.select(F.col("key").cast("long"), "x", "asks").mapInArrow(partial(_block_rows, block_rows), BLOCK)
    made.withColumn("block", F.monotonically_increasing_id()).write.parquet(f"{folder}/blocks")
    blocks = spark.read.schema(f"{BLOCK}, block long").parquet(f"{folder}/blocks")
    counts = {"rows": F.size("ids"), "queries": F.size(F.filter("asks", lambda a: a))}
    sizes = blocks.agg(F.count("*").alias("blocks"), *[F.coalesce(F.sum(n), F.lit(0)).alias(name) for name, n in counts.items()]).first()
    asking = blocks.where(F.exists("asks", lambda a: a)).mapInArrow(_query_rows, "block long, place long, id long, x array<int>")
    packed = asking.repartition(max(1, -(-sizes["queries"] // pack_rows))).mapInArrow(partial(_packed_rows, pack_rows), "q_blocks array<long>, q_places array<long>, q_ids array<long>, q_width int, q_m binary")
    packed.withColumn("pack", F.monotonically_increasing_id()).write.parquet(f"{folder}/queries")
    packs = spark.read.schema("q_blocks array<long>, q_places array<long>, q_ids array<long>, q_width int, q_m binary, pack long").parquet(f"{folder}/queries")

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    busy = GROUPS_A_CORE * spark.sparkContext.defaultParallelism
    repeats = max(busy, sizes["rows"] // max(1, sizes["queries"]))  # so often, queries are as many as candidates
    groups = max(1, min(sizes["blocks"], repeats, max(parts, sizes["blocks"] // TOGETHER)))
    grouped = blocks.drop("asks").withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))

    def pairs(asked: DataFrame) -> DataFrame:
        spread = asked.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        # Spark's estimate is that of the queries before they are repeated; by it the driver would gather all repeats for a broadcast.
        return grouped.join(spread.hint("merge"), "group").drop("group")

    own = Window.partitionBy("pack", "number")
    gathered = pairs(packs).mapInArrow(partial(_gathered_rows, k), "pack long, number int, total long")
    best = gathered.withColumn("rank", F.row_number().over(own.orderBy(F.desc("total")))).where(F.col("rank") <= k)
    cutoffs = best.groupBy("pack", "number").agg(F.min("total").alias("cutoff"), F.count("*").alias("n")).where(F.col("n") == k)
    cutoffs = cutoffs.groupBy("pack").agg(F.collect_list(F.struct("number", "cutoff")).alias("cutoffs"))  # at most pack_rows
    cutoffs.write.parquet(f"{folder}/cutoffs")
    known = packs.join(spark.read.schema(cutoffs.schema).parquet(f"{folder}/cutoffs"), "pack", "left")
    resolved = pairs(known).mapInArrow(partial(_resolved_rows, k), "pack long, number int, query_id long, id long, block long, place long, score long")
    order = own.orderBy(F.desc("score"), F.asc_nulls_last("id"), "block", "place")
    ranked = resolved.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(key), "score")
