"""Benchmark passages in documents, by winnowed fingerprints.

Both sides hash every ``GRAM`` words; of each ``WINDOW`` successive hashes the
least is kept. Equal stretches of ``GRAM + WINDOW - 1`` = ``SPAN`` words keep
equal hashes, so every span that a document shares with an item meets at least
one of the item's fingerprints. A hit is extended to the document's windows of
``SPAN`` words around it, and these are compared as text. An item of fewer
words is one window of its length, and its own fingerprint.

Plan: the places of a text are gone through by ``explode`` and hashed in
compiled code, and only those that are left are ever written. A
bitmap of the benchmark's fingerprint hashes, of ``MOST_BITS`` bits at the
most, drops those that the benchmark cannot have before least hashes are looked for;
with more fingerprints than it has bits it drops fewer, and nothing else
changes. What is left carries the words of its windows, is joined with the
distinct fingerprints, and its windows with the distinct windows of the
benchmark. Texts themselves are never moved. Equal texts are one from
there on (by digest), so a group of copies costs as much as one; a passage that many
items share is one window, and one that many documents share is a skewed join
key that adaptive execution splits.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are put in lower case.
Defined cases: a null or empty text has no words, no hits and is not
contaminated; an item without words has no window; null item ids are neither
counted nor listed; repeated ids count once, with the windows of all their
texts; repeated documents each give a row; an empty benchmark hits nothing;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlens.llm.text_columns import lower_ascii
from matchlens.session import work_folder

SPAN = 10
GRAM = 5
WINDOW = SPAN - GRAM + 1
#: Bits of the bitmap for each fingerprint of the benchmark, and in all (8 MB).
BITS_EACH, MOST_BITS = 64, 1 << 26

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BREAK_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text, null for a null text."""
    return F.array_remove(F.split(lower_ascii(text), _BREAK), "")


def _hash(words: Column, at: Column, n: int) -> Column:
    """Hash of the ``n`` words from ``at`` on, null where there are fewer."""
    return F.when(at + n <= F.size(words), F.xxhash64(F.slice(words, at + 1, n)))


def _fingerprints(texts: DataFrame, lengths: list[int], maybe: Callable[[Column], Column] | None = None) -> DataFrame:
    """Rows with ``found``: at most one struct of a hash, its length of window, the windows (from, until) that it stands for, and their words.

    ``texts`` has ``words``; only hashes that ``maybe`` holds for are kept. Every
    place in a text is hashed and tested in compiled code, so lambdas, which are
    not compiled, see only the words around a place that is left. A window
    belongs to its first place of the least hash.
    Callers explode with ``explode_outer``, for which no filter on the whole
    expression is derived and pushed down.
    """
    words, at = F.col("words"), F.col("at")
    places = texts.withColumn("at", F.explode_outer(F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1))))
    hashes = [F.struct(F.lit(n).alias("n"), _hash(words, at, GRAM if n == SPAN else n).alias("h")) for n in (SPAN, *lengths)]
    # Exploded even if it is one, so that the filter does not hash once more for each of its references.
    hashed = places.withColumn("print", F.explode_outer(F.array(*hashes))).filter("print.h is not null")
    if maybe:
        hashed = hashed.filter(maybe(F.col("print.h")))
    first = F.when(F.col("print.n") == SPAN, F.greatest(at - (WINDOW - 1), F.lit(0))).otherwise(at)
    near = hashed.withColumn("first", first).withColumn("around", F.slice(words, first + 1, at - first + F.col("print.n"))).drop("words")

    around = F.col("around")
    grams = F.array(*(_hash(around, F.lit(i), GRAM) for i in range(2 * WINDOW - 1)))
    near = near.withColumn("grams", F.when((F.col("print.n") == SPAN) & (F.size(around) >= SPAN), F.slice(grams, 1, F.size(around) - GRAM + 1)))
    g = F.col("grams")

    def owned(i: Column) -> Column:
        window = F.slice(g, i + 1, WINDOW)
        return i + F.array_position(window, F.array_min(window)) - 1 == at - F.col("first")

    mine = F.filter(F.sequence(F.lit(0), F.size(g) - WINDOW), owned)
    near = near.withColumn("mine", F.when(g.isNotNull(), mine).when(F.col("print.n") < SPAN, F.array(F.lit(0))))
    m, n = F.col("mine"), F.col("print.n")
    a, size = F.get(m, F.lit(0)), F.size(m)
    found = F.struct(
        F.col("print.h").alias("h"),
        n.alias("n"),
        (F.col("first") + a).alias("a"),
        (F.col("first") + a + size).alias("b"),
        F.slice(around, a + 1, size - 1 + n).alias("around"),
    )
    return near.withColumn("found", F.when(size > 0, F.array(found)))


def _bitmap(hashes: DataFrame) -> Callable[[Column], Column]:
    """Whether a hash may be among the ``h`` of a frame: false only if it is not."""
    bits = 64
    while bits < min(MOST_BITS, BITS_EACH * hashes.count()):
        bits *= 2

    def place(h: Column) -> Column:
        return F.pmod(h, F.lit(bits).cast("long"))

    words = hashes.select(place(F.col("h")).alias("at")).groupBy(F.shiftright("at", 6).alias("word"))
    flags = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("flags"))
    filled = [0] * (bits // 64)
    for row in flags.collect():  # MOST_BITS / 64 rows at the most
        filled[row["word"]] = row["flags"]
    # A constant that the optimizer folds into one array.
    table = F.split(F.lit(",".join(map(str, filled))), ",").cast("array<long>")
    return lambda h: F.getbit(F.get(table, F.shiftright(place(h), 6).cast("int")), place(h).bitwiseAND(F.lit(63)).cast("int")) == 1


def _window(words: Column, at: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, at + 1, n), " ")


def leaks_by_text(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``digest`` (MD5 of a text), ``n_hit`` and ``item_ids`` for every text with a hit."""
    spark = docs.sparkSession
    folder = f"{work_folder(spark)}/leaks-{uuid4().hex}"
    benchmark = items.select(F.col(f"`{item_key}`").cast("string").alias("item_id"), words_of(F.col(f"`{item_text}`").cast("string")).alias("words")).filter("size(words) > 0")
    # At most SPAN - 1 numbers: the lengths that short items have.
    sizes = benchmark.filter(F.size("words") < SPAN).agg(F.sort_array(F.collect_set(F.size("words"))).alias("n")).first()["n"]

    n = F.least(F.size("words"), F.lit(SPAN))
    at = F.explode(F.sequence(F.lit(0), F.size("words") - n))
    windows = benchmark.select("item_id", "words", n.alias("n"), at.alias("at")).select("item_id", "n", _window(F.col("words"), F.col("at"), F.col("n")).alias("window"))
    windows = windows.distinct()
    known = windows.select("n", "window").distinct().withColumn("words", F.split("window", " "))
    prints = _fingerprints(known, sizes).select(F.explode_outer("found").alias("f"), F.col("n").alias("item_n")).filter("f.n = item_n").select("f.h", "f.n").distinct()
    prints.write.parquet(f"{folder}/prints")
    prints = spark.read.parquet(f"{folder}/prints")

    texts = docs.select(F.md5(F.col(f"`{text}`").cast("string")).alias("digest"), words_of(F.col(f"`{text}`").cast("string")).alias("words"))
    found = _fingerprints(texts, sizes, _bitmap(prints)).select("digest", F.explode_outer("found").alias("f")).select("digest", "f.*").filter("h is not null")
    hits = found.join(prints, ["h", "n"])
    at = F.sequence(F.lit(0), F.col("b") - F.col("a") - 1)
    around = F.col("around")
    places = F.transform(at, lambda i: F.struct((F.col("a") + i).alias("at"), F.when(F.size(around) > 0, _window(around, i, F.col("n"))).alias("window")))
    candidates = hits.select("digest", "n", F.explode_outer(places).alias("p")).select("digest", "n", "p.*")
    confirmed = candidates.join(known.select("n", "window"), ["n", "window"]).distinct()
    confirmed.write.parquet(f"{folder}/windows")
    confirmed = spark.read.parquet(f"{folder}/windows")

    spans = F.sort_array(F.collect_set(F.struct(F.col("at").alias("a"), (F.col("at") + F.col("n")).alias("b"))))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(s["a"], acc["end"]))).alias("n"), F.greatest(acc["end"], s["b"]).alias("end")),
        lambda acc: acc["n"],
    )
    covers = confirmed.groupBy("digest").agg(spans.alias("spans")).select("digest", covered.cast("long").alias("n_hit"))
    named = confirmed.select("digest", "n", "window").distinct().join(windows, ["n", "window"]).filter("item_id is not null")
    listed = named.groupBy("digest").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    covers.join(listed, "digest", "left").write.parquet(f"{folder}/texts")
    return spark.read.parquet(f"{folder}/texts")


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``key``, n_words, n_hit, n_items, item_ids and contaminated for every document."""
    results = leaks_by_text(docs, items, text, item_key, item_text)
    source = F.col(f"`{text}`").cast("string")
    # Split, as a regexp_count makes a result of its own for every match, at ten times the CPU time.
    words = F.greatest(F.size(F.array_remove(F.split(source, _BREAK_ANY_CASE), "")), F.lit(0)).cast("long")
    counted = docs.select(F.col(f"`{key}`").alias("key"), F.md5(source).alias("digest"), words.alias("n_words"))
    return counted.join(results, "digest", "left").select(
        F.col("key").alias(key),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` without any hit, with all their columns.

    A bitmap of the hit texts' digests lets most rows pass where they are; only
    rows that it cannot tell are moved to an anti-join.
    """
    hit = leaks_by_text(docs, items, text, item_key, item_text).select("digest")
    own = F.md5(docs[text].cast("string"))
    maybe = F.coalesce(_bitmap(hit.select(F.xxhash64("digest").alias("h")))(F.xxhash64(own)), F.lit(False))
    return docs.filter(~maybe).unionByName(docs.filter(maybe).join(hit, own == hit["digest"], "left_anti"))
