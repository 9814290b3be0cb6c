"""Quality rules: repetition counts, and the distance of a text's histograms to its language's.

A language's references are mean histograms over all texts that carry it: of
character classes, and of its commonest words (the rest is one more cell).
Every text counts once, whatever its length, and a source counts as the mean
source of its language at most. The median of each class comes first, and only texts within
``MAX_CHARACTERS`` of the medians make the means, so a hot source, few very
long texts, or a third of rows of numbers do not move them.
Texts in no listed language, or in none, share one reference. A text's
verdict compares its own histograms with them by the Jensen-Shannon distance
(square root of the divergence in bits, 0 to 1). Short texts have histograms
too coarse to judge, so each comparison needs a number of words; without it
the distance is null and the text is not rejected for it. Bars and symbols
against all other characters is a comparison that few words suffice for.

Defined cases: a null or empty text has no words, so ``base_failed`` is true;
an unknown or null language takes the shared reference; without a reference
no distance is taken; repeated ids and rows
each give a row; a null id stays null; an empty table gives an empty one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from unicodedata import category
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from matchlens.llm.rowwise import STEP, bound_batches
from matchlens.session import work_folder

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Words that the comparison of character classes needs, and the greatest distance kept.
MIN_WORDS_CHARACTERS, MAX_CHARACTERS = 30, 0.32
#: From so many words on, the greatest sum of both distances kept.
MAX_SUMS = ((100, 0.46), (50, 0.58))
#: From so many words on, the greatest distance kept of bars and symbols against all other characters that are not blank.
MAX_SYMBOLS = ((30, 0.10), (10, 0.13))

#: Common words by language.
COMMON_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not he i this are or his from at which but have an had".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont la avec ou son".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si".split(),
}
SHARED = "other"
#: Bins of a class's share, the whole number that stands for 1, and the (language, source) groups that a task adds up at a time.
BINS, UNIT, GROUPS = 256, 1 << 20, 512

#: The character classes. A letter outside ASCII counts as a small one: a passage in another
#: language is no reason to reject a text. Other characters outside ASCII count by their kind.
CLASSES = ("lower", "upper", "digit", "space", "newline", "stop", "mark", "bar", "symbol", "control")
SYMBOLS = "#*$%&|<>"


#: Classes of characters outside ASCII by the first letter of their Unicode category.
_KINDS = {"L": "lower", "M": "lower", "N": "digit", "P": "mark", "Z": "space", "S": "symbol"}


def _class_of(code: int) -> int:
    char = chr(code)
    if code > 127:
        return CLASSES.index(_KINDS.get(category(char)[0], "control"))
    tests = (char.islower(), char.isupper(), char.isdigit(), char == " ", char == "\n", char in ".,", char in "!?;:'\"()-/", char in "|<>", char in SYMBOLS + "@+=^~_`\\[]{}")
    return next((i for i, hit in enumerate(tests) if hit), CLASSES.index("control"))


_CLASS = np.array([_class_of(c) for c in range(0x110000)], dtype=np.uint8)


def classes_of(raw: bytes) -> np.ndarray:
    """Counts of the character classes of a text in UTF-8."""
    codes = np.frombuffer(raw, np.uint8) if raw.isascii() else np.frombuffer(raw.decode().encode("utf-32-le"), "<u4")
    return np.bincount(_CLASS[codes], minlength=len(CLASSES))


def _cells(language: str) -> list[tuple[bytes, bytes]]:
    return [(w.encode(), w.capitalize().encode()) for w in dict.fromkeys(COMMON_WORDS.get(language, ()))]


_CELLS = {language: _cells(language) for language in (*COMMON_WORDS, SHARED)}
_CELLS[SHARED] = [c for c in dict.fromkeys(c for cells in _CELLS.values() for c in cells)]
WIDTH = {language: len(CLASSES) + len(cells) + 1 for language, cells in _CELLS.items()}


def language_of(value: str | None) -> str:
    """The listed language, else the shared one."""
    return value if value in COMMON_WORDS else SHARED


def histogram(raw: bytes, words: list[bytes], language: str) -> np.ndarray:
    """Counts of the character classes, then of the language's common words and of all other words."""
    classes = classes_of(raw)
    seen = Counter(words)
    common = [seen[small] + (seen[big] if big != small else 0) for small, big in _CELLS[language]]
    return np.concatenate([classes, common, [len(words) - sum(common)]]).astype(np.int64)


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two count vectors, 0 if either is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        terms = np.where(p > 0, p * np.log2(p / m), 0.0) + np.where(q > 0, q * np.log2(q / m), 0.0)
    return float(np.sqrt(max(0.0, terms.sum() / 2)))


def _marked(classes: np.ndarray) -> np.ndarray:
    """Bars and symbols, and all other characters that are not blank."""
    marked = classes[CLASSES.index("bar")] + classes[CLASSES.index("symbol")]
    return np.array([marked, classes.sum() - marked - classes[CLASSES.index("space")] - classes[CLASSES.index("newline")]])


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words inside windows that the text holds twice or more, the first one included."""
    windows = list(zip(*(words[i:] for i in range(width))))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    covered, end = 0, 0
    for at, window in enumerate(windows):
        if seen[window] > 1:
            covered += at + width - max(at, end)
            end = at + width
    return covered


def counts_of(text: str, raw: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    blanks = sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    return len(words), len(text) - blanks, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated_words(words)


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, str | None, bytes]]:
    """Language, source and bytes of the texts with words enough to be learned from."""
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            for text, value, source in zip(*(column.to_pylist() for column in batch.slice(at, STEP).columns)):
                raw = (text or "").encode()
                if len(raw.split(None, MIN_WORDS)) >= MIN_WORDS:
                    yield language_of(value), source, raw


def _rows_of(totals: dict[tuple[str, str | None], np.ndarray]) -> pa.RecordBatch:
    rows = [(*group, cell, int(n)) for group, total in totals.items() for cell, n in enumerate(total.tolist()) if n]
    kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["language", "source", "cell", "n"])


def _summed(add: Callable, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What ``add`` makes of each text, summed by language and source, for some groups at a time."""
    totals: dict[tuple[str, str | None], np.ndarray] = {}
    for language, source, raw in _texts(batches):
        got = add(language, raw)
        if got is None:
            continue
        group = (language, source)
        totals[group] = totals[group] + got if group in totals else got
        if len(totals) >= GROUPS:
            yield _rows_of(totals)
            totals = {}
    yield _rows_of(totals)


def _class_bins(language: str, raw: bytes) -> np.ndarray:
    """One for the bin of the text's share of each class, then one for the text."""
    share = classes_of(raw) / max(1, len(raw.decode()))
    out = np.zeros(len(CLASSES) * BINS + 1, dtype=np.int64)
    out[np.arange(len(CLASSES)) * BINS + np.minimum((share * BINS).astype(int), BINS - 1)] = 1
    out[-1] = 1
    return out


def _shares(medians: dict[str, np.ndarray], language: str, raw: bytes) -> np.ndarray | None:
    """Shares of classes and words in ``UNIT``, then one for the text; None for a text far from its language's classes."""
    got, split = histogram(raw, raw.split(), language), len(CLASSES)
    if distance(got[:split], medians[language]) > MAX_CHARACTERS:
        return None
    return np.concatenate([np.rint(part / max(1, part.sum()) * UNIT) for part in (got[:split], got[split:])] + [[1]]).astype(np.int64)


def _by_language(source: DataFrame, add: Callable, last: dict[str, int]) -> dict[str, dict[int, int]]:
    """Sums by language and cell, where no source weighs more than the mean source; cell ``last`` counts texts."""
    sums = source.mapInArrow(partial(_summed, add), "language string, source string, cell int, n long").groupBy("language", "source", "cell").agg(F.sum("n").alias("n"))
    sums = kept_rows(sums)
    of_texts = F.create_map(*(F.lit(x) for pair in last.items() for x in pair))[F.col("language")]
    sizes = sums.filter(F.col("cell") == of_texts).select("language", "source", F.col("n").alias("size"))
    mean = sizes.groupBy("language").agg(F.avg("size").alias("mean"))
    weights = sizes.join(mean, "language").select(F.col("language").alias("l"), F.col("source").alias("s"), F.least(F.lit(1.0), F.col("mean") / F.col("size")).alias("weight"))
    weighed = sums.join(weights, (F.col("language") == F.col("l")) & F.col("source").eqNullSafe(F.col("s")))
    # Whole numbers, so that the sum does not depend on its order.
    found: dict[str, dict[int, int]] = {}
    for row in weighed.groupBy("language", "cell").agg(F.sum((F.col("n") * F.col("weight") * 1024).cast("long")).alias("n")).collect():
        found.setdefault(row["language"], {})[row["cell"]] = row["n"]
    return found


def kept_rows(df: DataFrame) -> DataFrame:
    """``df`` written to the work folder and read again."""
    folder = f"{work_folder(df.sparkSession)}/quality-{uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def references(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> dict[str, list[int]]:
    """Histogram of each language over all rows of ``df``; without a column ``source`` all rows are of one.

    Every task adds up its rows; what reaches the driver is some thousand
    counts for each listed language, however large the table.
    """
    bound_batches(df.sparkSession)
    origin = F.col(f"`{source}`").cast("string") if source in df.columns else F.lit(None).cast("string")
    rows = df.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"), origin.alias("source"))
    binned = _by_language(rows, _class_bins, dict.fromkeys(WIDTH, len(CLASSES) * BINS))
    medians = {}
    for language, cells in binned.items():
        counts = np.array([cells.get(i, 0) for i in range(len(CLASSES) * BINS)]).reshape(len(CLASSES), BINS).cumsum(axis=1)
        medians[language] = (2 * counts >= counts[:, -1:]).argmax(axis=1) + 0.5 * (counts[:, 0] * 2 < counts[:, -1])
    if not medians:
        return {}
    means = _by_language(rows, partial(_shares, medians), WIDTH)
    return {language: [cells.get(i, 0) for i in range(WIDTH[language])] for language, cells in means.items()}


RESULT = StructType(
    [StructField(n, LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [StructField(n, BooleanType()) for n in ("base_failed", "kept")]
    + [StructField(n, DoubleType()) for n in ("character_distance", "word_distance")]
)


def judged(text: str | None, value: str | None, known: dict[str, np.ndarray]) -> tuple:
    """The values of ``RESULT`` for one text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    counts = counts_of(text, raw, words)
    n = counts[0]
    failed = n < MIN_WORDS or 100 * counts[4] > MAX_REPEAT_PERCENT * n
    language, split = language_of(value), len(CLASSES)
    own, reference = histogram(raw, words, language), known.get(language_of(value))
    characters = distance(own[:split], reference[:split]) if reference is not None and n >= MIN_WORDS_CHARACTERS else None
    most = next((limit for least, limit in MAX_SUMS if n >= least), None) if reference is not None else None
    common = None if most is None else distance(own[split:], reference[split:])
    far = characters is not None and (characters > MAX_CHARACTERS or (common is not None and characters + common > most))
    symbols = next((limit for least, limit in MAX_SYMBOLS if n >= least), None) if reference is not None else None
    far = far or (symbols is not None and distance(_marked(own[:split]), _marked(reference[:split])) > symbols)
    return *counts, failed, not failed and not far, characters, common


def _judge_rows(known: dict[str, list[int]], names: list[str], types: list, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vectors = {language: np.array(cells) for language, cells in known.items()}
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            part = batch.slice(at, STEP)
            made = [judged(t, v, vectors) for t, v in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
            columns = [pa.array([row[i] for row in made], kind) for i, kind in enumerate(types)]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=names)


def judge(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", known: dict[str, list[int]] | None = None) -> DataFrame:
    """``key`` and ``RESULT`` for every row, against ``known`` references or those of ``df`` itself."""
    known = references(df, text, lang) if known is None else known
    schema = StructType([StructField(key, df.schema[key].dataType), *RESULT.fields])
    source = df.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang")
    )
    types = [to_arrow_type(f.dataType) for f in RESULT.fields]
    return source.mapInArrow(partial(_judge_rows, known, [f.name for f in schema.fields], types), schema)


def kept(known: dict[str, list[int]], text: Column | str = "text", lang: Column | str = "lang") -> Column:
    """The verdict as a column, for filters that keep whole rows."""

    def verdicts(texts: pd.Series, values: pd.Series) -> pd.Series:
        vectors = {language: np.array(cells) for language, cells in known.items()}
        return pd.Series([judged(t, v, vectors)[6] for t, v in zip(texts, values)], dtype=bool)

    return F.pandas_udf(verdicts, BooleanType())(text, lang)
