"""Centroid clustering over a VA-file: vectors as few-bit cells, full vectors only where intervals overlap.

Each component becomes the number of its cell, ``BITS`` bits; cells are cut at
the normal quantiles of the dimension's mean and deviation and end at its least
and greatest value. For each centroid a lookup table gives, for every dimension and
cell, the least and greatest share of the distance; summed over the dimensions
they are the interval of the vector's distance to that centroid. What all centroids share
(the distance to their common middle) is left out of the tables, which
makes the intervals narrower by much. A centroid whose interval begins after
another one has ended cannot be the nearest. Where one is left, the cells decide; where
several are, their exact distances to the full vector do.

A round needs each cluster's sums. They are carried on: the cells are looked up
for the centroids of this round and of the one before, and only vectors that may have
moved are fetched, subtracted and added. Cells and full vectors are columns of one
written table; the cells alone go to Python for all rows, the vectors of the rows
that overlap or move follow. No row is shuffled: a task gives sums per cluster and
dimension, and the driver sees those and the centroids, whose number the parameters bound.
Rounds depend on the written table and the centroids alone, so lost executors cost their tasks.

Defined cases: vectors that are null, of another length or with null or non-finite components are in
no cluster and have no row; a null key takes part, and comes last among the
candidates for first centroids; of equal keys the lesser vector comes first; repeated rows
each give a row; fewer vectors than clusters give fewer clusters; an empty table gives an empty one; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import partial
from statistics import NormalDist
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from matchlens.llm.vectors import binaries, matrix, of_binaries, scaled
from matchlens.session import work_folder

#: Bits of a cell's number; one byte holds it.
BITS = 8
#: Rows whose tables are summed at a time.
STEP = 4096

Cells = tuple[np.ndarray, np.ndarray]


def cells(borders: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Number of the cell of each component."""
    return np.stack([np.searchsorted(borders[d], x[:, d], side="right") for d in range(len(borders))], axis=1).astype(np.uint8)


def tables(ends: Cells, centroids: np.ndarray, middle: np.ndarray) -> Cells:
    """Least and greatest of ``(x - c)² - (x - m)²`` in each dimension and cell, for each centroid.

    It is linear in ``x``, so its extremes are at the ends of the cell.
    """
    low, high = (e[:, :, None] for e in ends)
    c, m = centroids.T[:, None, :], middle[:, None, None]
    first, last = (m - c) * (2 * low - c - m), (m - c) * (2 * high - c - m)
    return np.minimum(first, last), np.maximum(first, last)


def candidates(found: np.ndarray, ends: Cells, centroids: np.ndarray) -> np.ndarray:
    """For every row of cells, which centroids may be the nearest."""
    least, most = tables(ends, centroids, centroids.sum(axis=0) // len(centroids))
    out = np.empty((len(found), len(centroids)), dtype=bool)
    for at in range(0, len(found), STEP):
        part = found[at : at + STEP]
        low, high = (np.zeros((len(part), len(centroids)), dtype=np.int64) for _ in range(2))
        for d in range(part.shape[1]):
            low += least[d][part[:, d]]
            high += most[d][part[:, d]]
        out[at : at + STEP] = low <= high.min(axis=1)[:, None]
    return out


def nearest(x: np.ndarray, near: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest of each row's candidates and the exact distance; ties to the smaller number."""
    best = np.full(len(x), np.iinfo(np.int64).max)
    chosen = np.full(len(x), -1, dtype=np.int32)
    for number, centroid in enumerate(centroids):
        rows = np.flatnonzero(near[:, number])
        distance = ((x[rows] - centroid) ** 2).sum(axis=1)
        closer = distance < best[rows]
        best[rows[closer]], chosen[rows[closer]] = distance[closer], number
    return chosen, best


def _moments(dims: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total, squares = 0, np.zeros(dims, dtype=np.int64), np.zeros(dims)
    low, high = np.full(dims, np.iinfo(np.int32).max), np.full(dims, np.iinfo(np.int32).min)
    for batch in batches:
        if batch.num_rows:
            x = matrix(batch.column(0), dims)
            n += len(x)
            total += x.sum(axis=0, dtype=np.int64)
            squares += (x.astype(np.float64) ** 2).sum(axis=0)
            low, high = np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))
    if n:
        columns = [np.arange(dims, dtype=np.int32), np.full(dims, n, dtype=np.int64), total, squares, low.astype(np.int64), high.astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["dim", "n", "total", "squares", "low", "high"])


def _cell_rows(borders: np.ndarray, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = cells(borders, matrix(batch.column(1), len(borders)))
        yield pa.RecordBatch.from_arrays([batch.column(0), binaries(found), batch.column(1)], names=["key", "cells", "x"])


def _moved(ends: Cells, was: np.ndarray | None, now: np.ndarray):
    """Of a column of cells: the candidates of both rounds, and whether the full vector is needed."""

    @F.arrow_udf("struct<needed: boolean, was: binary, now: binary>")
    def moved(column: pa.Array) -> pa.Array:
        found = of_binaries(column, np.uint8, len(ends[0]))
        new = candidates(found, ends, now)
        old = candidates(found, ends, was) if was is not None else np.zeros((len(found), 0), dtype=bool)
        needed = np.ones(len(found), dtype=bool)
        if was is not None:
            needed = (old != new).any(axis=1) | (new.sum(axis=1) > 1)
        return pa.StructArray.from_arrays([pa.array(needed), binaries(old), binaries(new)], names=["needed", "was", "now"])

    return moved.asNondeterministic()  # so that the filter does not evaluate it a second time


def _move_rows(was: np.ndarray | None, now: np.ndarray, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    k, dims = now.shape
    change = np.zeros((k, dims + 1), dtype=np.int64)  # and the number of vectors
    for batch in batches:
        if not batch.num_rows:
            continue
        x = matrix(batch.column(0), dims).astype(np.int64)
        new, _ = nearest(x, of_binaries(batch.column(2), bool, k), now)
        old = np.full(len(x), -1)
        if was is not None:
            old, _ = nearest(x, of_binaries(batch.column(1), bool, k), was)
        x = np.concatenate([x, np.ones((len(x), 1), dtype=np.int64)], axis=1)
        for cluster in range(k):
            change[cluster] += x[(new == cluster) & (old != cluster)].sum(axis=0) - x[(old == cluster) & (new != cluster)].sum(axis=0)
    cluster, dim = np.nonzero(change)
    yield pa.RecordBatch.from_arrays([pa.array(cluster.astype(np.int32)), pa.array(dim.astype(np.int32)), pa.array(change[cluster, dim])], names=["cluster", "dim", "change"])


def _near(ends: Cells, centroids: np.ndarray):
    @F.arrow_udf("binary")
    def near(column: pa.Array) -> pa.Array:
        return binaries(candidates(of_binaries(column, np.uint8, len(ends[0])), ends, centroids))

    return near


def _assigned_rows(centroids: np.ndarray, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    k, dims = centroids.shape
    for batch in batches:
        chosen, distance = nearest(matrix(batch.column(1), dims).astype(np.int64), of_binaries(batch.column(2), bool, k), centroids)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chosen), pa.array(distance)], names=["key", "cluster", "distance"])


def _empty(df: DataFrame, key: str) -> DataFrame:
    made = {"cluster": "int", "distance": "long", "cluster_inertia": "long", "inertia": "long", "centroid_sha256": "string"}
    return df.limit(0).select(F.col(f"`{key}`").alias(key), *[F.lit(None).cast(t).alias(n) for n, t in made.items()])


def approximate(df: DataFrame, key: str, vector: str, dims: int, scale: int) -> tuple[DataFrame, Cells] | None:
    """The written VA-file (key, cells, x) and the least and greatest value of each cell; None without vectors."""
    whole = scaled(df, key, vector, scale, dims)
    moments = whole.select("x").mapInArrow(partial(_moments, dims), "dim int, n long, total long, squares double, low long, high long")
    sums = [F.sum(c).alias(c) for c in ("n", "total", "squares")]
    found = moments.groupBy("dim").agg(*sums, F.min("low").alias("low"), F.max("high").alias("high")).orderBy("dim").collect()
    if not found:
        return None
    n, total, squares, low, high = (np.array([r[c] for r in found]) for c in ("n", "total", "squares", "low", "high"))
    mean = total / n
    deviation = np.sqrt(np.maximum(squares / n - mean**2, 0))
    quantiles = np.array([NormalDist().inv_cdf(i / (1 << BITS)) for i in range(1, 1 << BITS)])
    borders = np.floor(mean[:, None] + deviation[:, None] * quantiles).astype(np.int64)
    folder = f"{work_folder(df.sparkSession)}/va-{uuid4().hex}"
    schema = StructType([whole.schema["key"], *StructType.fromDDL("cells binary, x array<int>").fields])
    whole.mapInArrow(partial(_cell_rows, borders), schema).write.parquet(folder)
    ends = np.concatenate([low[:, None], borders], axis=1), np.concatenate([borders - 1, high[:, None]], axis=1)
    return df.sparkSession.read.schema(schema).parquet(folder), ends


def cluster(df: DataFrame, key: str = "vec_id", vector: str = "embedding", dims: int = 64, clusters: int = 8, rounds: int = 10, scale: int = 1024, seed: int = 3) -> DataFrame:
    """``key``, cluster, squared distance, inertias and the digest of the centroid, for every vector."""
    made = approximate(df, key, vector, dims, scale)
    if made is None:
        return _empty(df, key)
    stored, ends = made
    spark = df.sparkSession
    order: Column = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    firsts = stored.orderBy(F.asc_nulls_last(order), "x").select("x").limit(clusters).collect()
    now, was = np.array([r["x"] for r in firsts], dtype=np.int64), None
    sums = [[0] * (dims + 1) for _ in now]
    for _ in range(rounds):
        if was is not None and (was == now).all():
            break  # nothing moves any more
        needed = stored.select("x", _moved(ends, was, now)("cells").alias("near")).where("near.needed").select("x", "near.was", "near.now")
        changes = needed.mapInArrow(partial(_move_rows, was, now), "cluster int, dim int, change long")
        for row in changes.groupBy("cluster", "dim").agg(F.sum(F.col("change").cast("decimal(38,0)")).alias("change")).collect():
            sums[row["cluster"]][row["dim"]] += int(row["change"])
        was, now = now, np.array([[s // total[-1] for s in total[:-1]] if total[-1] else old for total, old in zip(sums, now.tolist())], dtype=np.int64)

    folder = f"{work_folder(spark)}/clusters-{uuid4().hex}"
    schema = StructType([stored.schema["key"], *StructType.fromDDL("cluster int, distance long").fields])
    stored.select("key", "x", _near(ends, now)("cells").alias("near")).mapInArrow(partial(_assigned_rows, now), schema).write.parquet(folder)
    assigned = spark.read.schema(schema).parquet(folder)
    inertias = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    whole = sum(inertias.values())
    shown = [(c, s, whole, hashlib.sha256(",".join(map(str, now[c].tolist())).encode()).hexdigest()) for c, s in inertias.items()]
    # One row for each cluster, whose number is a parameter.
    per_cluster = spark.createDataFrame(shown, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    named = StructField(key, df.schema[key].dataType)
    return assigned.withColumnRenamed("key", named.name).join(F.broadcast(per_cluster), "cluster").select(F.col(f"`{key}`"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
