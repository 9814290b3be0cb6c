"""Committed tables: untouched files stay, failed batches leave nothing, repeats are harmless."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlens.operators.state import mark_done
from matchlens.sources import committed
from matchlens.sources.committed import Batch, Committed, part_of
from matchlens.sources.matches import land_batch
from matchlens.streaming import KeyedState, send_to_keyed_files, write_keyed_files

SCHEMA = T.StructType().add("matchid", "string").add("tier", "string").add("status", "boolean")
PARTS = 8


def state(spark, root, n=100):
    batch = Batch(spark, root)
    rows = [(f"m{i}", "x", False) for i in range(n)] + [(None, "none", None)]
    batch.replace("matches", spark.createDataFrame(rows, SCHEMA), "matchid", PARTS)
    batch.commit()


def files(root):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}


def rows(spark, root, name="matches", schema=SCHEMA):
    return sorted(tuple(map(str, r)) for r in Committed(spark, root).read(name, schema).drop("part", "version").collect())


def test_a_change_leaves_other_parts_alone(spark, tmp_path):
    root = str(tmp_path)
    state(spark, root)
    before, old = files(root), rows(spark, root)
    batch = Batch(spark, root)
    changes = spark.createDataFrame([("m3",), ("m5",), ("m3",)], "matchid string")
    touched = batch.change("matches", SCHEMA, changes, "matchid", mark_done, PARTS)
    assert rows(spark, root) == old  # nothing is seen before the marker
    batch.commit()
    after = files(root)
    assert before.items() <= after.items()
    new = [f for f in after if f not in before and "data/" in f]
    assert len(touched) <= 2 and {f"part={p}" for p in touched} == {f.split("/")[3] for f in new}
    expected = [(m, t, "True" if m in ("m3", "m5") else s) for m, t, s in old]
    assert rows(spark, root) == sorted(expected)
    held = Committed(spark, root).parts("matches")
    assert {v for p, v in held.items() if p not in touched} == {1} and {held[p] for p in touched} == {2}
    plan = Committed(spark, root).read("matches", SCHEMA, touched).inputFiles()
    assert all(any(f"part={p}/" in f for p in touched) for f in plan)


def test_a_batch_killed_between_its_writes_is_repeated(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    state(spark, root)
    old = rows(spark, root)
    documents = spark.createDataFrame([("m1", "body"), ("m2", "body")], "id string, body string")

    def killed(*_):
        raise RuntimeError("killed")

    for method in ("change", "commit"):
        with monkeypatch.context() as patched:
            patched.setattr(committed.Batch, method, killed)
            with pytest.raises(RuntimeError, match="killed"):
                land_batch(spark, root, documents.unionAll(documents), 0, F.col("id"), PARTS)
        assert rows(spark, root) == old and rows(spark, root, "documents", documents.schema) == []
    assert land_batch(spark, root, documents, 0, F.col("id"), PARTS)
    assert rows(spark, root, "documents", documents.schema) == [("m1", "body"), ("m2", "body")]
    assert [r for r in rows(spark, root) if r[2] == "True"] == [("m1", "x", "True"), ("m2", "x", "True")]
    again = files(root)
    assert not land_batch(spark, root, documents, 0, F.col("id"), PARTS) and files(root) == again


def test_empty_changes_and_unknown_roots(spark, tmp_path):
    root = str(tmp_path)
    assert Committed(spark, root).version == 0 and rows(spark, root) == []
    state(spark, root, 3)
    batch = Batch(spark, root)
    assert batch.change("matches", SCHEMA, spark.createDataFrame([], "matchid string"), "matchid", mark_done, PARTS) == []
    none = spark.createDataFrame([], "id string")
    assert land_batch(spark, root, none, 0, F.col("id"), PARTS) and rows(spark, root, "documents", none.schema) == []


def test_parts_of_keys(spark):
    import hashlib

    found = {r.k: r.part for r in spark.createDataFrame([("a",), ("é",), (None,)], "k string").select("k", part_of("k", 16)).collect()}
    assert found == {k: int(hashlib.md5(k.encode()).hexdigest()[:7], 16) % 16 for k in ("a", "é")} | {None: 0}


USERS = T.StructType().add("user", "string").add("at", "long").add("value", "string")


def users(messages):
    return messages


def drained(spark, root, source):
    kept = KeyedState(spark, root, USERS, "user", ["at"], 4)
    kept.start(spark.readStream.schema(USERS).parquet(source), users, once=True).awaitTermination()
    return kept


def test_state_of_a_stream_resumes_repeats_and_resets(spark, tmp_path):
    root, source = str(tmp_path / "state"), str(tmp_path / "in")

    def send(*sent):
        spark.createDataFrame(list(sent), USERS).coalesce(1).write.mode("append").parquet(source)

    def table(kept):
        return sorted(tuple(r) for r in kept.rows().collect())

    send(("a", 1, "one"), ("b", 5, "five"), ("a", 3, "three"))
    assert table(drained(spark, root, source)) == [("a", 3, "three"), ("b", 5, "five")]
    send(("a", 2, "late"), ("b", 6, "six"), ("c", 1, "new"))
    kept = drained(spark, root, source)
    expected = [("a", 3, "three"), ("b", 6, "six"), ("c", 1, "new")]
    assert table(kept) == expected
    before = files(root)
    assert table(drained(spark, root, source)) == expected and files(root) == before  # nothing new: nothing written
    assert not kept.apply(spark.createDataFrame([("a", 9, "repeat")], USERS), 1)
    assert table(kept) == expected
    kept.reset()
    kept = drained(spark, root, source)
    assert kept.run_number() == 1 and table(kept) == expected
    assert len(list(Path(root, "checkpoints").iterdir())) == 2


def test_a_batch_that_fails_before_its_marker_comes_again(spark, tmp_path, monkeypatch):
    root, source = str(tmp_path / "state"), str(tmp_path / "in")
    spark.createDataFrame([("a", 1, "one")], USERS).write.parquet(source)

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patched:
        patched.setattr(committed.Batch, "commit", killed)
        with pytest.raises(Exception, match="killed"):
            drained(spark, root, source)
    assert KeyedState(spark, root, USERS, "user", ["at"], 4).rows().count() == 0
    assert [tuple(r) for r in drained(spark, root, source).rows().collect()] == [("a", 1, "one")]


def test_keyed_files_keep_the_order_of_a_key(spark, tmp_path):
    sent = spark.createDataFrame([("t", f"k{i % 7}" if i % 7 else None, f"v{i}", i) for i in range(200)], "topic string, key string, value string, at long")
    path = str(tmp_path / "files")
    write_keyed_files(sent.repartition(5), path, 3, ["at"])
    keys = {}
    for folder in Path(path).glob("partition=*"):
        (file,) = folder.glob("*.parquet")
        found = spark.read.parquet(str(file)).collect()
        assert [r.at for r in found] == sorted(r.at for r in found)
        for r in found:
            assert keys.setdefault(r.key, folder.name) == folder.name
    assert len(keys) == 7
    with pytest.raises(Exception, match="already exists"):
        write_keyed_files(sent, path, 3, ["at"])

    source = str(tmp_path / "in")
    sent.write.parquet(source)
    for _ in range(2):
        stream = spark.readStream.schema(sent.schema).parquet(source)
        send_to_keyed_files(stream, str(tmp_path / "out"), str(tmp_path / "check"), 3, ["at"], once=True).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200
