"""Near copies by SimHash: fingerprints within a few bits, found with pivot distance tables.

A fingerprint is 64 majority bits over the XXH64 of a text's word shingles.
Fingerprints link at ``MOST`` (3) or fewer differing bits, and linked
fingerprints form components.

``PIVOTS`` reference fingerprints (rows of a Hadamard matrix, far from each
other) give each fingerprint a table of distances. Distances of two
fingerprints to a reference differ by at most their own distance, so pairs
whose greatest coordinate difference exceeds ``MOST`` are discarded; survivors
are verified bit by bit. The tables alone cannot tell where to look, since
almost all distances are near 32. Pairs therefore meet in buckets: of
``BLOCKS`` (6) blocks of bits at least three are free of the 3 differences, so each
fingerprint enters the 20 buckets of its choices of three blocks. Inside a
bucket, sorted by the first coordinate, only pairs close in it are looked at.

Buckets of more than ``DENSE`` fingerprints are not compared pairwise. There, for each
word ``z`` within 1 bit (in the blocks not shared) of some fingerprint, all
fingerprints within 2 bits of ``z`` belong together, since any of them is
within 3 of that one; they are linked to the least one through ``z``. A pair within
3 bits has such a ``z``, so no link is lost. This takes 529 rows for each
fingerprint at most, never the square of the bucket.

Only distinct fingerprints are compared: exact copies, a third of all rows or
more, are one fingerprint from the first aggregation on. A bucket gives the
links of a spanning forest, not all pairs.

Defined cases: a null or empty text has fingerprint zero, linked like any
other; a text of fewer words than a shingle is one shingle; a null id
never names a component, so one of null ids alone has a null component id;
repeated ids and rows each give a row; an empty table gives an empty one; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import partial
from itertools import combinations
from uuid import uuid4

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from matchlens.llm.components import components
from matchlens.llm.rowwise import map_texts
from matchlens.session import work_folder

MOST = 3
SHINGLE = 3
SEED = 42
BLOCKS = 6
PIVOTS = 16
#: Fingerprints in a bucket up to which its pairs are compared in place.
DENSE = 8192
#: Pairs, and fingerprints of several buckets, that are in memory at a time.
PAIRS = 1 << 20

_BOUNDS = [round(64 * i / BLOCKS) for i in range(BLOCKS + 1)]
_MASKS = [((1 << (b - a)) - 1) << a for a, b in zip(_BOUNDS, _BOUNDS[1:])]
#: The bits that each kind of bucket shares.
SHARED = [sum(_MASKS[i] for i in chosen) for chosen in combinations(range(BLOCKS), BLOCKS - MOST)]


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """SimHash of one text as an unsigned number."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, ASCII white space
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())], dtype="<u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _maker(width: int) -> Callable:
    return lambda text: (_signed(fingerprint(text, width)),)


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE) -> DataFrame:
    """``key`` and ``fp`` (the fingerprint's bits as a signed long) for every row."""
    return map_texts(df, key, text, StructType([StructField("fp", LongType())]), partial(_maker, width))


def pivots() -> np.ndarray:
    """The reference fingerprints: rows of a 64 x 64 Hadamard matrix, any two 32 bits apart."""
    parity = np.array([[bin(i & j).count("1") & 1 for j in range(64)] for i in range(1, PIVOTS + 1)], dtype=np.uint8)
    return np.packbits(parity, axis=1, bitorder="little").view("<u8").ravel()


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Distances of each fingerprint to each pivot."""
    return np.bitwise_count(fps[:, None] ^ pivots()[None, :]).astype(np.int8)


def close_pairs(fps: np.ndarray, bucket: np.ndarray, most: int = MOST) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs in one bucket within ``most`` bits, some at a time.

    Rows are sorted by bucket and first coordinate, so the partners of a row
    that the first pivot leaves are the rows up to a place found by search.
    """
    table = pivot_table(fps)
    place = bucket.astype(np.int64) * 128 + table[:, 0]
    order = np.argsort(place, kind="stable")
    fps, table, place = fps[order], table[order], place[order]
    until = np.searchsorted(place, place + most, side="right")
    counts = until - np.arange(len(fps)) - 1
    done = np.concatenate([[0], np.cumsum(counts)])
    at = 0
    while at < len(fps):
        end = max(at + 1, int(np.searchsorted(done, done[at] + PAIRS, side="right")) - 1)
        n = counts[at:end]
        left = np.repeat(np.arange(at, end), n)
        right = left + 1 + np.arange(n.sum()) - np.repeat(done[at:end] - done[at], n)
        near = np.ones(len(left), dtype=bool)
        for p in range(1, PIVOTS):
            left, right = left[near], right[near]
            near = np.abs(table[left, p] - table[right, p]) <= most
        left, right = left[near], right[near]
        same = np.bitwise_count(fps[left] ^ fps[right]) <= most
        yield order[left[same]], order[right[same]]
        at = end


def forest(n: int, pairs: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least position reachable from each of ``n`` positions."""
    roots = np.arange(n)
    for a, b in pairs:
        while True:
            low = np.minimum(roots[a], roots[b])
            if (roots[a] == low).all() and (roots[b] == low).all():
                break
            np.minimum.at(roots, roots[a], low)
            np.minimum.at(roots, roots[b], low)
            np.minimum.at(roots, a, low)
            np.minimum.at(roots, b, low)
            while (roots[roots] != roots).any():
                roots = roots[roots]
    return roots


def _bucket_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = batch.column(0).value_lengths().to_numpy(zero_copy_only=False)
        so_far = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            end = max(at + 1, int(np.searchsorted(so_far, so_far[at] - sizes[at] + PAIRS, side="right")))
            fps = batch.column(0).slice(at, end - at).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            roots = forest(len(fps), close_pairs(fps, np.repeat(np.arange(end - at), sizes[at:end])))
            linked = roots != np.arange(len(fps))
            yield pa.RecordBatch.from_arrays([pa.array(fps[linked].view(np.int64)), pa.array(fps[roots[linked]].view(np.int64))], names=["a", "b"])
            at = end


def _flips(within: int, most: int) -> list[int]:
    """All words with up to ``most`` bits set inside ``within``."""
    bits = [1 << i for i in range(64) if within >> i & 1]
    return [sum(c) for n in range(most + 1) for c in combinations(bits, n)]


def _star_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each (fp, kind): every word within 2 bits outside the shared blocks, and whether within 1."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1 << 10):
            part = batch.slice(at, 1 << 10)
            fps = part.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            kinds = part.column(1).to_numpy(zero_copy_only=False)
            for kind in np.unique(kinds):
                flips = np.array(_flips(~SHARED[kind] & ((1 << 64) - 1), 2), dtype=np.uint64)
                own = fps[kinds == kind]
                z = (own[:, None] ^ flips[None, :]).ravel()
                near = np.tile(np.bitwise_count(flips) <= 1, len(own))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(own, len(flips)).view(np.int64)), pa.array(z.view(np.int64)), pa.array(near), pa.array(np.full(len(z), kind, np.int32))],
                    names=["fp", "z", "near", "kind"],
                )


def _dense_links(members: DataFrame) -> DataFrame:
    """Links of the members (fp, kind) of dense buckets, through the words around them."""
    around = members.mapInArrow(_star_rows, "fp long, z long, near boolean, kind int")
    # The shared blocks are part of z, so kind and z tell the bucket; at most
    # 529 fingerprints are within 2 bits of a z.
    centre = around.groupBy("kind", "z").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("root"), F.count("*").alias("n"))
    centre = centre.filter("root is not null and n > 1").drop("n")
    return around.join(centre, ["kind", "z"]).select(F.col("fp").alias("a"), F.col("root").alias("b")).filter("a != b").distinct()


def links(distinct: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` that span the components of the distinct fingerprints ``fp``."""
    kinds = F.array(*(F.struct(F.lit(kind).alias("kind"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("part")) for kind, mask in enumerate(SHARED)))
    members = distinct.select("fp", F.inline(kinds))
    folder = _folder(distinct)
    members.groupBy("kind", "part").agg(F.count("*").alias("n")).filter("n > 1").write.parquet(folder)
    sizes = distinct.sparkSession.read.parquet(folder)
    # Groups of bounded size, and a join alone for the others: adaptive execution can split that.
    small = members.join(sizes.filter(F.col("n") <= DENSE), ["kind", "part"]).groupBy("kind", "part").agg(F.collect_list("fp").alias("fps"))
    dense = members.join(sizes.filter(F.col("n") > DENSE), ["kind", "part"]).select("fp", "kind")
    return small.select("fps").mapInArrow(_bucket_links, "a long, b long").union(_dense_links(dense))


def _folder(df: DataFrame) -> str:
    return f"{work_folder(df.sparkSession)}/simhash-{uuid4().hex}"


def _kept(df: DataFrame) -> DataFrame:
    folder = _folder(df)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def grouped(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """Rows (key, digest of the text, fp), and the class of each fp (fp, component, the least fp reachable)."""
    source = df.select(F.struct(F.col(f"`{key}`").alias("key"), F.md5(F.col(f"`{text}`").cast("string")).alias("digest")).alias("row"), F.col(f"`{text}`").alias("text"))
    rows = _kept(fingerprints(source, "row", "text", width).select("row.key", "row.digest", "fp"))
    distinct = _kept(rows.select("fp").distinct())
    found = components(links(distinct)).withColumnRenamed("node", "fp")
    return rows, _kept(distinct.join(found, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component")))


def near_copies(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id``, the least key reachable, for every row."""
    rows, classes = grouped(df, key, text, width)
    by_fp = _kept(rows.groupBy("fp").agg(F.min("key").alias("least")))
    least = _kept(classes.join(by_fp, "fp").groupBy("component").agg(F.min("least").alias("component_id")))
    named = _kept(classes.join(least, "component").select("fp", "component_id"))
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(named, "fp").select(F.col("key").alias(key), shown.alias("fingerprint"), "component_id")


def first_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE) -> DataFrame:
    """The rows of ``df`` that stay: one of each group of near copies, with all its columns.

    The row with the least key stays, nulls last, of equal keys the one with
    the least digest of its text. Only rows that agree in both are compared
    further, and one of them stays.
    """
    return keep_first(df, *grouped(df, key, text, width), key, text)


def keep_first(df: DataFrame, rows: DataFrame, classes: DataFrame, key: str, text: str) -> DataFrame:
    """The first row of each component, given rows (key, digest, fp) and classes (fp, component)."""
    by_text = _kept(rows.groupBy("fp", "key", "digest").agg(F.count("*").alias("n_rows")))
    order = F.struct(F.col("key").isNull().alias("none"), "key", "digest", "n_rows")
    first = by_text.groupBy("fp").agg(F.min(order).alias("first"))
    winners = classes.join(first, "fp").groupBy("component").agg(F.min("first").alias("first")).select("first.key", "first.digest", "first.n_rows")
    names = [f"{name}_{uuid4().hex}" for name in ("winner", "digest", "rows")]  # cannot clash with the columns of df
    winner, digest, n_rows = names
    winners = _kept(winners.toDF(*names))
    own = F.md5(F.col(f"`{text}`").cast("string"))
    joined = df.join(winners, df[key].eqNullSafe(winners[winner]) & own.eqNullSafe(winners[digest]))
    single = joined.filter(F.col(n_rows) == 1).select(df.columns)
    repeated = joined.filter(F.col(n_rows) > 1).dropDuplicates([winner, digest]).select(df.columns)
    return single.unionByName(repeated)
