"""Clustering and top-k search against brute force on vectors with nulls, ties, repeats and odd lengths."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlens.llm import threshold_search, va_file, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"
#: Names that the operators use inside or return.
CLASHING = ("key", "x", "cells", "near", "cluster", "distance", "rank", "score", "block", "pack", "group", "asks")


def made(seed, n, dims=64, spread=0.1):
    rng = random.Random(seed)
    return [[rng.gauss(0, spread) for _ in range(dims)] for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    plain = made(1, 300)
    out = [(i, v, i % 3) for i, v in enumerate(plain)]
    out += [(1000 + i, plain[7], 0) for i in range(150)]  # a third are one vector
    out += [(7, plain[7], 0), (7, plain[8], 0), (None, plain[9], 0), (None, plain[10], 1), (-100, plain[11], 1)]
    out += [(2000, None, 0), (2001, [], 0), (2002, plain[0][:40], 0), (2003, [*plain[0][:63], None], 0), (2004, [*plain[0][:63], float("nan")], 0)]
    out += [(2005, [*plain[0][:63], float("-inf")], 0), (2006, [0.0] * 64, 0), (2100, [*plain[0], 0.5], 0), (2007, [50.0] * 64, 0)]
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    made = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return made.withColumns({name: F.lit(name) for name in CLASHING}).cache()


def whole(vector):
    if vector is None or any(v is None or not math.isfinite(v) for v in vector):
        return None
    return [math.floor(1024 * float(np.float32(v))) for v in vector]


def brute_clusters(rows, k=8, rounds=10):
    kept = [(i, x) for i, v, _ in rows if (x := whole(v)) is not None and len(x) == 64]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [x for _, x in order[:k]]

    def assigned():
        out = []
        for _, x in kept:
            distances = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centroids]
            out.append((distances.index(min(distances)), min(distances)))
        return out

    for _ in range(rounds):
        found = assigned()
        for c in range(len(centroids)):
            own = [x for (_, x), (cluster, _) in zip(kept, found) if cluster == c]
            if own:
                centroids[c] = [sum(column) // len(own) for column in zip(*own)]
    found = assigned()
    inertia = [sum(d for cluster, d in found if cluster == c) for c in range(len(centroids))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((str(i), c, d, inertia[c], sum(inertia), digests[c]) for (i, _), (c, d) in zip(kept, found))


@pytest.mark.parametrize("k,rounds", [(8, 10), (3, 1), (5, 0)])
def test_clusters(frame, rows, k, rounds):
    found = va_file.cluster(frame, clusters=k, rounds=rounds)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((str(r[0]), *r[1:]) for r in found.collect()) == brute_clusters(rows, k, rounds)


def test_fewer_vectors_than_clusters_and_none(spark, frame):
    few = spark.createDataFrame([(1, [1.0] * 64, 0), (2, [1.0] * 64, 0), (3, [0.5] * 64, 0)], SCHEMA)
    found = va_file.cluster(few).collect()
    assert {r.vec_id for r in found} == {1, 2, 3} and len({r.cluster for r in found}) == 2 and all(r.distance == 0 for r in found)
    for none in (frame.limit(0), spark.createDataFrame([(1, None, 0), (2, [1.0], 0)], SCHEMA)):
        empty = va_file.cluster(none)
        assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and empty.count() == 0


def test_intervals_hold_the_distances():
    rng = np.random.default_rng(3)
    x, centroids = rng.integers(-300, 300, (500, 6)), rng.integers(-300, 300, (4, 6))
    borders = np.sort(rng.integers(-250, 250, (6, 255)), axis=1)
    ends = np.concatenate([x.min(axis=0)[:, None], borders], axis=1), np.concatenate([borders - 1, x.max(axis=0)[:, None]], axis=1)
    near = va_file.candidates(va_file.cells(borders, x), ends, centroids)
    exact = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert near[np.arange(len(x)), exact.argmin(axis=1)].all()
    assert (exact == exact.min(axis=1)[:, None])[~near].sum() == 0
    assert near.sum(axis=1).mean() < 2  # the cells decide most rows
    chosen, distance = va_file.nearest(x, near, centroids)
    assert (chosen == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()


def brute_top(rows, k=10):
    kept = [(i, x) for i, v, _ in rows if (x := whole(v)) is not None]
    out = []
    for at, (query, q) in enumerate(kept):
        if query is not None and query % 100 == 0:
            scores = [(-sum(a * b for a, b in zip(q, x)), i is None, i) for other, (i, x) in enumerate(kept) if other != at]
            out += [(query, rank, i, -score) for rank, (score, _, i) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block,queries", [(4096, 256), (7, 2)])
def test_top_k(frame, rows, block, queries):
    found = threshold_search.search(frame, F.col("vec_id") % 100 == 0, block_rows=block, pack_rows=queries)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_top(rows)


def test_fewer_candidates_than_k_and_none(spark, frame):
    few = spark.createDataFrame([(100, [1.0, 2.0], 0), (100, [3.0], 0), (5, [-1.0, 0.5, 9.0], 0)], SCHEMA)
    found = [tuple(r) for r in threshold_search.search(few, F.col("vec_id") % 100 == 0).orderBy("score").collect()]
    m = 1024 * 1024
    assert sorted(found) == sorted([(100, 1, 100, 3 * m), (100, 2, 5, 0), (100, 1, 100, 3 * m), (100, 2, 5, -3 * m)])
    assert threshold_search.search(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert threshold_search.search(few, F.lit(False)).count() == 0


def test_no_vector_passes_through_the_driver(frame, rows, monkeypatch):
    joined = []
    kind, plain = type(frame), type(frame).mapInArrow

    def seen(self, *args, **more):
        if {"m", "q_m"} <= set(self.columns):
            joined.append(self._jdf.queryExecution().executedPlan().toString())
        return plain(self, *args, **more)

    monkeypatch.setattr(kind, "mapInArrow", seen)
    found = threshold_search.search(frame, F.col("vec_id") % 100 == 0, block_rows=7, pack_rows=2)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_top(rows)
    ran = found._jdf.queryExecution().executedPlan().toString()  # as adaptive execution has left it
    assert len(joined) == 2 and all("SortMergeJoin [group" in plan for plan in [*joined, ran])
    assert not any(f"{join} [group" in plan for plan in [*joined, ran] for join in ("BroadcastHashJoin", "ShuffledHashJoin"))


def test_threshold_loses_no_total():
    rng = np.random.default_rng(5)
    for lists in (1, 2, 4, 7):
        q, c = rng.integers(-50, 50, (6, 20)), rng.integers(-50, 50, (300, 20))
        scores = threshold_search.local_scores(q, c, lists)
        totals = sum(scores).astype(np.int64)
        assert (totals == q @ c.T).all()
        cutoff = threshold_search.gather([s.copy() for s in scores], 10).min(axis=1).astype(np.int64)
        best = np.sort(totals, axis=1)[:, -10]
        assert (cutoff <= best).all()
        collected = set(zip(*threshold_search.collect(scores, cutoff)))
        assert all((i, j) in collected for i, j in zip(*np.nonzero(totals >= cutoff[:, None])))
        if lists > 1:
            assert len(collected) < totals.size


def test_large_products_stay_exact():
    q = np.array([[1 << 26, (1 << 26) - 1, 3]] * 2, dtype=np.int32)
    scores = threshold_search.local_scores(q, q)
    assert int(sum(scores)[0, 1]) == (1 << 52) + ((1 << 26) - 1) ** 2 + 9


def test_a_component_beyond_exact_results_stops_the_job(spark):
    frame = spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="beyond"):
        vectors.scaled(frame, "vec_id", "embedding").collect()
