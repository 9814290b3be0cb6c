"""Numbered lines, records and JSON values of files in many splits, against plain Python."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlens.operators.calibrate import parse_records, records_of_lines
from matchlens.operators.cohorts import LADDER_COHORTS, daily_match_sketches, match_totals, merged_match_totals
from matchlens.sources import text_files
from matchlens.sources.matches import read_json_run
from matchlens.sources.text_files import json_texts, numbered_lines, occurrences


def test_lines_of_many_splits(spark, tmp_path):
    rng = random.Random(3)
    texts = {n: "".join(rng.choice(["a", "b\n", "\n", "ü\r", "long " * 40 + "\n"]) for _ in range(3000)) for n in "xy"}
    for name, text in texts.items():
        (tmp_path / f"{name}.txt").write_bytes(text.encode())
    found = {n: {} for n in texts}
    lines = numbered_lines(spark, str(tmp_path), split_bytes=1000)
    for r in lines.collect():
        assert found[r.file[-5]].setdefault(r.line, r.value) is r.value
    for name, text in texts.items():
        expected = text.split("\n")
        expected = expected[:-1] if expected[-1] == "" else expected
        assert [found[name][i] for i in range(len(found[name]))] == expected
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "134217728b"


def record(i):
    return "\n".join([str(i), "x", f"name {i}", "y", f"{i}.5", "n/a" if i % 3 else "7", f"{40 + i % 9}%", f"{i % 5}.25%", "3%", "last"])


@pytest.mark.parametrize("n,tail", [(500, ""), (500, "\nonly\ntwo"), (0, "short")])
def test_records_of_a_file_equal_those_of_its_text(spark, tmp_path, n, tail):
    text = "\n".join(record(i) for i in range(n)) + tail
    (tmp_path / "records.txt").write_text(text)
    whole = parse_records(spark.createDataFrame([(text,)], "value string"))
    found = records_of_lines(numbered_lines(spark, str(tmp_path), split_bytes=700)).select(whole.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect())) and found.count() == n


def python_values(content):
    values, decoder = [], json.JSONDecoder()
    content = content.strip()
    while content:
        value, end = decoder.raw_decode(content)
        content = content[end:].strip()
        values.append(value)
    return values


def value(rng, depth=0):
    kind = rng.randrange(6 if depth < 3 else 4)
    if kind == 0:
        return rng.choice(["", "}{", "][", 'a "quoted" \\ one', "\\", "é\n\t{", 'x\\"', "a b  c"])
    if kind == 1:
        return rng.choice([0, -1.5, 1e9, 12345678901])
    if kind == 2:
        return rng.choice([True, False, None])
    if kind in (3, 4):
        return {rng.choice(["k", "}", '"', "a b"]) + str(i): value(rng, depth + 1) for i in range(rng.randrange(4))}
    return [value(rng, depth + 1) for _ in range(rng.randrange(4))]


@pytest.mark.parametrize("stretch", [1024, 3])
def test_values_run_together(spark, tmp_path, monkeypatch, stretch):
    monkeypatch.setattr(text_files, "STRETCH", stretch)
    rng = random.Random(stretch)
    contents = {}
    for name in "xy":
        text = ""
        for _ in range(300):
            made = value(rng)
            shown = json.dumps(made, indent=rng.choice([None, None, 1, 2]), ensure_ascii=rng.random() < 0.5)
            # Only a bracket or a quote ends a value without white space after it.
            text += shown + (rng.choice([" ", "\n", "\n\n \t", "\r\n"]) if shown[-1] not in '}]"' else rng.choice(["", "", " ", "\n"]))
        contents[name] = text
        (tmp_path / f"{name}.json").write_bytes(text.encode())
    found = {"x": {}, "y": {}}
    for r in json_texts(numbered_lines(spark, str(tmp_path), split_bytes=500)).collect():
        assert r.number not in found[r.file[-6]]
        found[r.file[-6]][r.number] = json.loads(r.json)
    for name, text in contents.items():
        expected = python_values(text)
        assert [found[name][i] for i in range(len(found[name]))] == expected


def test_run_together_rows_and_an_unfinished_value(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"k": 1, "v": [1, 2]}{"k": 2}\n{\n"k":\n3, "v":\n[]}{"k": 4, "v": [')
    schema = T.StructType().add("k", "long").add("v", T.ArrayType(T.LongType()))
    assert sorted(map(tuple, read_json_run(spark, str(tmp_path), schema).collect())) == [(1, [1, 2]), (2, None), (3, [])]
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "b.json").write_text(" \n\n")
    assert read_json_run(spark, str(tmp_path / "empty"), schema).count() == 0


def test_sketches_of_days_are_merged(spark):
    from pyspark.sql import functions as F

    tiers = ["platinum", "gold", "master", "emerald"]
    facts = spark.range(60_000).select(
        F.concat(F.lit("m"), F.col("id") % 20_000).alias("matchId"),
        F.element_at(F.array(*map(F.lit, tiers)), (F.col("id") % 4 + 1).cast("int")).alias("tier"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 14).cast("int")).alias("date"),
    )
    exact = {r.cohort: r.total_cnt for r in match_totals(facts, LADDER_COHORTS).collect()}
    merged = {r.cohort: r.total_cnt for r in merged_match_totals(daily_match_sketches(facts), LADDER_COHORTS).collect()}
    assert exact.keys() == merged.keys() and all(abs(merged[c] - exact[c]) <= 0.05 * exact[c] for c in exact)
    assert daily_match_sketches(facts).count() <= 14 * 4


def test_small_splits_share_tasks(spark, tmp_path):
    path = tmp_path / "text"
    path.mkdir()
    (path / "a.txt").write_text("".join(f"line {i}\n" for i in range(20_000)))
    lines = numbered_lines(spark, str(path), split_bytes=512)
    assert lines.where(F.concat(F.lit("line "), "line") != F.col("value")).count() == 0 and lines.count() == 20_000
    assert lines.inputFiles() and len([f for f in lines.inputFiles() if "/lines-" in f]) <= spark.sparkContext.defaultParallelism


def test_occurrences(spark):
    rows = spark.sql("SELECT array('{', '[', '{', 'a') AS t UNION ALL SELECT array()").select(occurrences("t", "{").alias("n"))
    assert sorted(r["n"] for r in rows.collect()) == [0, 2]
