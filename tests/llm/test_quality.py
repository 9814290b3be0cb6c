"""Quality references that other rows cannot move, and junk of few words."""

import random

import pytest

from matchlens.llm import quality

WORDS = "the of and to in a is that for it as stone river window market letter garden winter paper".split()


def prose(seed, n=120):
    return " ".join(random.Random(seed).choices(WORDS, k=n)) + "."


def numbers(seed, n=120):
    rng = random.Random(seed)
    return " ".join(str(rng.randrange(10**6)) for _ in range(n))


def kept_of(spark, rows, schema="doc_id long, text string, lang string, source string"):
    return {r.doc_id for r in quality.judge(spark.createDataFrame(rows, schema)).filter("kept").collect()}


CLEAN = [(i, prose(i), "en", f"s{i % 7}") for i in range(60)]
THIRD = [(1000 + i, numbers(i, 400), "en", "hot") for i in range(30)]


@pytest.mark.parametrize(
    "junk",
    [THIRD, [(1000 + i, numbers(i), "en", "hot") for i in range(200)], [(1000, numbers(1, 40_000), "en", "s1")]],
    ids=["a third of rows", "most rows of the language", "one long text"],
)
def test_numbers_do_not_move_references(spark, junk):
    assert kept_of(spark, CLEAN + junk) == {r[0] for r in CLEAN}


def test_without_a_source(spark):
    assert kept_of(spark, [r[:3] for r in CLEAN + THIRD], "doc_id long, text string, lang string") == {r[0] for r in CLEAN}


def test_short_junk(spark):
    junk = []
    for n in (12, 25, 40, 60, 90):
        words = prose(n, n).split()
        junk += [" | ".join(words), " ".join(w + "###" for w in words), " ".join(w + "\U0001f600" for w in words), " ".join(w + "\u2500\u2502" for w in words)]
    short = [prose(500 + n, n) for n in (12, 25, 40, 60, 90)] + ["\u00e9t\u00e9 " * 2 + "\u00e0 la fen\u00eatre du march\u00e9 d\u2019hiver, \u00ab o\u00f9 \u00bb l\u2019on \u00e9crit une lettre"]
    rows = CLEAN + [(200 + i, t, "en", "s1") for i, t in enumerate(short)] + [(300 + i, t, "en", "s2") for i, t in enumerate(junk)]
    assert kept_of(spark, rows) == {r[0] for r in CLEAN} | {200 + i for i in range(len(short))}
