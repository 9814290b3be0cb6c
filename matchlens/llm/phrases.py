"""Phrase collocations by SON partitioning: shards mined whole at a local support of one, longer candidates counted exactly.

A phrase that occurs ``support`` times occurs in some shard, a stretch of rows of about ``SHARD_BYTES`` that one task holds. A local
support that follows a shard's share of the table falls as shards get more, and lists grow with the square of the
table until it is one. So it is one from the start, at any size, and what a shard lists depends on the shard alone; the lists are kept short by what they are about:

* first each shard is mined for its words and pairs. Their counts, united, are exact, and those at ``support`` are kept;
* then each shard is mined, level by level, for longer phrases, whose words and pairs were all kept: a phrase is no more frequent
  than a pair in it. These candidates are counted in every shard exactly, and kept at ``support``.

So nothing is counted twice, and a frequent phrase needs no second list of its counts in all shards.

In the second pass a task knows what was kept by a bitmap of hashes, of a fixed size whatever their number. A word or pair that was not
kept and shares a bit leads to candidates that are counted too, exactly, and fall at ``support``. Counts are combined in each shard, so a very
frequent phrase is one row of each shard and no hot key.

Scores are whole numbers: a phrase is cut in two at every place, and the cut with the lowest ``1000 * a * n / (l * r)``,
rounded down, counts. Products are decimals of 38 digits.

Defined cases: a null or empty text has no words and a null language is ``und``; words are divided by spaces and tabs, pieces by the
delimiters; a phrase of one word is no candidate; ties end in the phrase in the order of its bytes; repeated rows
count each time; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from itertools import count
from string import ascii_lowercase, ascii_uppercase
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlens.session import work_folder

#: Fixed value: what ends a piece.
DELIMITERS = b".,;:!?\x0a\x0b\x0c\x0d"
#: A byte that no UTF-8 text has stands for a delimiter.
BORDER = b"\xff"
#: Bytes of text of a shard; with its last texts it has up to half as many more.
SHARD_BYTES = 24_000_000
#: Rows that are handed on at a time.
STEP = 1 << 16
#: Tasks that a table is given at least, if it has as many partitions.
LEAST_TASKS = 8
#: The bitmap has a bit for every hash of so many bits: 8 MB.
HASH_BITS = 26

PLAIN = bytes.maketrans(ascii_uppercase.encode() + DELIMITERS, ascii_lowercase.encode() + BORDER * len(DELIMITERS))
MULTIPLIER, MIXER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)

Keep = Callable[[int, np.ndarray], np.ndarray]


class Shard:
    """Word numbers of the texts of one language, and their vocabulary; number 0 is a border."""

    def __init__(self) -> None:
        self.n = 0
        self.numbers: defaultdict[bytes, int] = defaultdict(count(1).__next__)
        self.numbers[BORDER] = 0
        self.parts: list[np.ndarray] = []

    def add(self, texts: list[bytes]) -> None:
        words = BORDER.join(texts).translate(PLAIN).replace(BORDER, b" " + BORDER + b" ").split()
        words.append(BORDER)
        found = np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))
        self.n += int(np.count_nonzero(found))
        self.parts.append(found)


def _codes(words: Iterable[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)


def _longer(states: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Rolling states of phrases with another word."""
    return states * MULTIPLIER + codes + np.uint64(1)


def _mixed(state: np.ndarray) -> np.ndarray:
    """Hashes out of rolling states."""
    out = (state ^ (state >> np.uint64(32))) * MIXER
    return out ^ (out >> np.uint64(29))


def mine(shard: Shard, longest: int, keep: Keep) -> Iterator[tuple[int, Callable[[slice], pa.Array], np.ndarray]]:
    """Per length: the phrases that ``keep`` (length, hashes) takes, a stretch of them spelled when asked for, and their counts.

    A phrase is looked at if what it begins and ends with, a word less, was taken.
    """
    words = np.concatenate(shard.parts)
    codes = _codes(shard.numbers)
    spelled = pa.array([b"", *list(shard.numbers)[1:]], pa.binary()).cast(pa.string())
    starts = np.flatnonzero(words).astype(np.int32)
    keys = words[starts].astype(np.int64)
    states = None
    for length in range(1, longest + 1):
        if not len(starts):
            return
        order = np.argsort(keys)
        ordered = keys[order]
        begins = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        counts = np.diff(np.append(begins, len(ordered)))
        ends = starts[order[begins]] + (length - 1)  # a place where each phrase ends
        before = states[ordered[begins] // len(codes)] if length > 1 else np.zeros(len(begins), dtype=np.uint64)
        states = _longer(before, codes[words[ends]])
        taken = keep(length, _mixed(states))
        which = np.full(len(begins), -1, dtype=np.int32)
        which[taken] = np.arange(np.count_nonzero(taken), dtype=np.int32)
        states, ends = states[taken], ends[taken]

        def phrases(part: slice, length: int = length, ends: np.ndarray = ends) -> pa.Array:
            return pc.binary_join_element_wise(*(spelled.take(pa.array(words[ends[part] - back])) for back in range(length - 1, -1, -1)), " ")

        yield length, phrases, counts[taken]
        if length == longest:
            return
        classes = np.full(len(words) + 1, -1, dtype=np.int32)
        classes[starts[order]] = np.repeat(which, counts)
        starts = np.flatnonzero((classes[:-1] >= 0) & (classes[1:] >= 0)).astype(np.int32)
        # The next word is not 0: what begins one place on was taken.
        keys = classes[starts].astype(np.int64) * len(codes) + words[starts + length] if len(starts) else np.empty(0, dtype=np.int64)


def _shards(shard_bytes: int, batches: Iterable[pa.RecordBatch]) -> Iterator[dict[str, Shard]]:
    """Texts (lang, text) as shards of bounded size, one for each language met.

    What is left at the end of a task goes to the shard before, unless it is half a shard: small
    shards would list the same phrases over again.
    """
    held: dict[str, Shard] = {}
    waiting: dict[str, list[bytes]] = {}
    sizes = [0, 0]  # of what is held and of what waits

    def add() -> None:
        for lang, texts in waiting.items():
            if lang not in held:
                held[lang] = Shard()
            held[lang].add(texts)
        waiting.clear()
        sizes[:] = [sum(sizes), 0]

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256).to_pydict()
            for lang, text in zip(part["lang"], part["text"]):
                waiting.setdefault(lang, []).append(text)
                sizes[1] += len(text)
            if sizes[0] < shard_bytes:
                add()
            elif sizes[1] >= shard_bytes // 2:
                yield held
                held, sizes[0] = {}, 0
                add()
    add()
    if held:
        yield held


def _listed_rows(bitmap: bytes | None, shortest: int, longest: int, shard_bytes: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every phrase of ``shortest`` to ``longest`` words of a shard with its count; words and pairs in it are in the bitmap, if there is one.

    A row with no phrase and size 0 has the number of words of the shard.
    """
    bits = None if bitmap is None else np.frombuffer(bitmap, np.uint8)

    def marked(length: int, hashes: np.ndarray) -> np.ndarray:
        if bits is None or length > 2:
            return np.ones(len(hashes), dtype=bool)
        at = hashes >> np.uint64(64 - HASH_BITS)
        return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

    def rows(lang: str, size: int, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
        n = len(counts)
        columns = [pa.array([lang] * n, pa.string()), phrases, pa.array(np.full(n, size, np.int32)), pa.array(counts.astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "size", "n"])

    for shards in _shards(shard_bytes, batches):
        for lang, shard in shards.items():
            if shortest == 1:
                yield rows(lang, 0, pa.nulls(1, pa.string()), np.array([shard.n]))
            for length, phrases, counts in mine(shard, longest, marked):
                for at in range(0, len(counts) if length >= shortest else 0, STEP):
                    part = slice(at, at + STEP)
                    yield rows(lang, length, phrases(part), counts[part])


def _hashed_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of phrases, as in ``mine``."""
    for batch in batches:
        hashes = np.zeros(batch.num_rows, dtype=np.uint64)
        words = [phrase.encode().split(b" ") for phrase in batch.column("phrase").to_pylist()]
        for at in range(max(map(len, words), default=0)):
            has = np.array([len(w) > at for w in words])
            hashes[has] = _longer(hashes[has], _codes(w[at] for w in words if len(w) > at))
        yield pa.RecordBatch.from_arrays([pa.array(_mixed(hashes).view(np.int64))], names=["hash"])


def _bitmap(candidates: DataFrame) -> bytes:
    """Bits of the hashes of the candidates: at most 2 ** (HASH_BITS - 15) rows of 4 kB reach the driver."""
    bit = F.shiftrightunsigned("hash", 64 - HASH_BITS)
    # Spark numbers buckets from 1 for values from 1 on.
    marked = candidates.select((bit + 1).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out = bytearray(1 << (HASH_BITS - 3))
    for row in marked.collect():
        at = (row["bucket"] - 1) * 4096
        out[at : at + 4096] = row["bits"]
    return bytes(out)


def frequent_phrases(df: DataFrame, text: str = "text", lang: str = "lang", support: int = 100, longest: int = 5, unknown: str = "und", shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """Written tables: phrases of 1 to ``longest`` words (lang, phrase, size, n) with their exact counts, and languages (lang, n)."""
    spark = df.sparkSession
    folder = f"{work_folder(spark)}/phrases-{uuid4().hex}"

    def kept(made: DataFrame, name: str) -> DataFrame:
        made.write.parquet(f"{folder}/{name}")
        return spark.read.schema(made.schema).parquet(f"{folder}/{name}")

    texts = df.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(unknown)).alias("lang"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    texts = texts.where(F.octet_length("text") > 0)
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("bytes")).first()["bytes"]
    # Tasks of small parts are put together, so that shards are full and list a phrase once where they can.
    tasks = max(LEAST_TASKS, -(-total // shard_bytes))
    whole = texts.coalesce(tasks)

    def listed(bitmap: bytes | None, first: int, last: int, name: str) -> DataFrame:
        rows = whole.mapInArrow(partial(_listed_rows, bitmap, first, last, shard_bytes), "lang string, phrase string, size int, n long")
        # A shard has listed a phrase once: nothing is gained by summing before the shuffle. Partitions grow in number, not in size.
        counted = rows.repartition(2 * tasks, "lang", "phrase").groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))
        return kept(counted.where((F.col("n") >= support) | (F.col("size") == 0)), name)

    short = listed(None, 1, min(2, longest), "short")
    languages, frequent = short.where("size = 0").select("lang", "n"), short.where("size > 0")
    if longest > 2:
        bitmap = _bitmap(frequent.select("phrase").mapInArrow(_hashed_rows, "hash long"))
        frequent = frequent.unionByName(listed(bitmap, 3, longest, "longer"))
    return frequent, languages


def scored(frequent: DataFrame, languages: DataFrame) -> DataFrame:
    """Candidates (lang, phrase, a, l, r, n, score) by their lowest-scoring cut."""
    words = F.split("phrase", " ")
    candidates = frequent.where(F.col("size") > 1).select("lang", "phrase", F.col("n").alias("a"), words.alias("words"), "size")
    cuts = candidates.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    rest = F.array_join(F.expr("slice(words, k + 1, size(words) - k)"), " ")
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"), rest.alias("rest"))
    known = frequent.select("lang", "phrase", "n")
    cuts = cuts.join(known.toDF("lang", "first", "l"), ["lang", "first"]).join(known.toDF("lang", "rest", "r"), ["lang", "rest"])
    cuts = cuts.join(languages, "lang")
    score = F.expr("(1000BD * cast(a as decimal(19, 0)) * cast(n as decimal(19, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "a", "n").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def not_absorbed(candidates: DataFrame, frequent: DataFrame, absorb: int = 100) -> DataFrame:
    """Candidates without a longer one around them that has at least ``absorb`` per cent of their count."""
    longer = frequent.where(F.col("size") > 2).select("lang", F.split("phrase", " ").alias("words"), "size", F.col("n").alias("longer"))
    spread = longer.select("lang", "longer", "words", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length"))
    spread = spread.select("lang", "longer", "words", "length", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)).alias("at"))
    inside = spread.groupBy("lang", F.array_join(F.slice("words", F.col("at"), F.col("length")), " ").alias("phrase")).agg(F.max("longer").alias("longer"))
    joined = candidates.join(inside, ["lang", "phrase"], "left")
    return joined.where(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(absorb) * F.col("a"))).drop("longer")


def collocations(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    support: int = 100,
    longest: int = 5,
    absorb: int = 100,
    top: int = 2000,
    unknown: str = "und",
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The best ``top`` phrases of every language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    frequent, languages = frequent_phrases(df, text, lang, support, longest, unknown, shard_bytes)
    kept = not_absorbed(scored(frequent, languages), frequent, absorb)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
