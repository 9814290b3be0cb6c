"""Phrase collocations against brute force, for shards of any size."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from matchlens.llm import phrases

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("phrase", "size", "n", "less", "hash", "whole", "k", "first", "rest", "score", "rank")


def brute(rows, support, longest=5, absorb=100, top=2000):
    grams, sizes = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    grams.setdefault(lang, Counter())[tuple(words[i : i + size])] += 1
    out = []
    for lang, counted in grams.items():
        frequent = {g: c for g, c in counted.items() if c >= support}
        kept = []
        for g, a in frequent.items():
            if len(g) < 2:
                continue
            cuts = [(1000 * a * sizes[lang] // (frequent[g[:k]] * frequent[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            inside = [c for h, c in frequent.items() if len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))]
            if not any(100 * c >= absorb * a for c in inside):
                kept.append((-score, -a, " ".join(g).encode(), frequent[g[:k]], frequent[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    words = ["Stone", "river", "the", "of", "été", "Ünder", "x\x1cy", "a", " ", "ÀB"]
    weights = [10, 8, 20, 15, 3, 2, 1, 9, 1, 2]
    out = []
    for i in range(400):
        text = ""
        for word in rng.choices(words, weights, k=rng.randint(0, 40)):
            text += word + rng.choice([" ", " ", " ", " ", "\t", "  ", ", ", ".", "\n", " ! ", "\x0b"])
        out.append((text, rng.choice(["en", "en", "de", None])))
    out += [("hot line of copies, the same", "en")] * 200 + [(None, "en"), ("", "fr"), (" ,. ", "fr"), ("a a a a a a a", "und"), ("of the river " * 20000, "de")]
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    made = spark.createDataFrame([(i, t, lang, "s", 1) for i, (t, lang) in enumerate(rows)], DOCS).repartition(6)
    return made.withColumns({name: F.lit(name) for name in CLASHING}).cache()


@pytest.mark.parametrize("support,size,absorb,top", [(10, 24_000_000, 100, 2000), (10, 1500, 100, 2000), (60, 10_000, 80, 5), (3, 250, 100, 2000)])
def test_collocations(frame, rows, support, size, absorb, top):
    found = phrases.collocations(frame, support=support, absorb=absorb, top=top, shard_bytes=size)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    expected = brute(rows, support, absorb=absorb, top=top)
    assert expected and sorted(tuple(r) for r in found.collect()) == expected


def test_a_full_bitmap_changes_nothing(frame, rows, monkeypatch):
    monkeypatch.setattr(phrases, "_bitmap", lambda candidates: b"\xff" * (1 << (phrases.HASH_BITS - 3)))
    assert sorted(tuple(r) for r in phrases.collocations(frame, support=20).collect()) == brute(rows, 20)


def test_scores_beyond_64_bits(spark):
    one, two, both = 3_000_000_000, 2_999_999_999, 2_999_999_998
    known = [("en", "a", 1, one), ("en", "b", 1, two), ("en", "a b", 2, both)]
    frequent = spark.createDataFrame(known, "lang string, phrase string, size int, n long")
    n = 10**17 + 7
    found = phrases.scored(frequent, spark.createDataFrame([("en", n)], "lang string, n long")).collect()
    assert [(r.l, r.r, r.score) for r in found] == [(one, two, 1000 * both * n // (one * two))]


def test_empty_tables(spark, frame):
    found = phrases.collocations(frame.limit(0))
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and found.count() == 0
    assert phrases.collocations(spark.createDataFrame([(None, None)], "text string, lang string")).count() == 0


def test_rows_listed_grow_with_the_table(spark, monkeypatch):
    words = [f"w{i}" for i in range(300)]

    def texts(n):
        rng = random.Random(7)
        return [(" ".join(rng.choices(words, [1 / (i + 1) for i in range(300)], k=60)), "en") for _ in range(20 * n)]

    made, frame_type = [], type(spark.range(0))
    original = frame_type.mapInArrow

    def counting(self, *args, **kwargs):
        out = original(self, *args, **kwargs)
        made.append(out.count())
        return out

    monkeypatch.setattr(frame_type, "mapInArrow", counting)
    listed = {}
    for shards in (8, 40):
        rows, made[:] = texts(shards), []
        table = spark.createDataFrame(rows, "text string, lang string").repartition(shards)
        size = sum(len(text) for text, _ in rows) // shards + 1
        assert sorted(tuple(r) for r in phrases.collocations(table, shard_bytes=size).collect()) == brute(rows, 100)
        listed[shards] = sum(made)
    assert listed[40] <= 1.5 * (40 / 8) * listed[8]
