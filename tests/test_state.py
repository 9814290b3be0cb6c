import pytest
from pyspark.sql import functions as F

from matchlens.operators import state
from matchlens.schema import MATCH_STATE, USERS


@pytest.fixture(scope="module")
def users(spark):
    rows = [("a", "P_a", 10, 4, "GOLD"), ("b", None, 7, 0, "MASTER")]
    return spark.createDataFrame(rows, USERS)


@pytest.fixture(scope="module")
def matches(spark):
    rows = [("1", "GOLD", False), ("2", "GOLD", None), ("3", "GOLD", True), ("4", "GOLD", False)]
    return spark.createDataFrame(rows, MATCH_STATE)


def values(df):
    return sorted(map(tuple, df.collect()))


def test_upsert_keeps_what_the_batch_does_not_bring(spark, users):
    batch = spark.createDataFrame([("a", 12, "MASTER"), ("c", 3, "GOLD")], "summonerid string, match_num int, tier string")
    made = state.upsert(users, batch, "summonerid", ["match_num", "tier"], {"update_num": F.lit(0)})
    assert made.schema == USERS
    assert values(made) == [
        ("a", "P_a", 12, 4, "MASTER"),
        ("b", None, 7, 0, "MASTER"),
        ("c", None, 3, 0, "GOLD"),
    ]


def test_insert_if_absent_keeps_the_first(spark, matches):
    batch = spark.createDataFrame(
        [("3", "X", 1), ("9", "LATE", 5), ("9", "FIRST", 2)], "matchid string, tier string, seen int"
    )
    made = state.insert_if_absent(matches, batch, "matchid", ["seen"], {"status": F.lit(False)})
    assert made.count() == 5
    assert tuple(made.where("matchid = '9'").collect()[0]) == ("9", "FIRST", False)
    assert tuple(made.where("matchid = '3'").collect()[0]) == ("3", "GOLD", True)


def test_keyed_update_can_set_null(spark, matches):
    batch = state.backlog(matches, 1)
    assert values(batch) == [("1", "GOLD")]
    marked = state.mark_in_flight(matches, batch)
    assert marked.where("matchid = '1'").collect()[0].status is None
    assert marked.where("matchid = '4'").collect()[0].status is False


def test_done_and_reset(spark, matches):
    landed = spark.createDataFrame([("1",), ("1",), ("8",)], "matchid string")
    done = state.mark_done(matches, landed)
    assert done.count() == 4 and state.done_count(done).collect()[0].done == 2
    assert {r.matchid for r in state.reset_in_flight(matches).where("not status").collect()} == {"1", "2", "4"}


def test_settle_update_numbers(users):
    assert {r.summonerid: r.update_num for r in state.settle_update_numbers(users).collect()} == {"a": 4, "b": 7}


def test_fetch_priority(spark):
    rows = [
        ("no games", "P", 5, 5, "MASTER"),
        ("one page", "P", 100, 0, "GOLD"),
        ("two pages", "P", 101, 0, "CHALLENGER"),
        ("lookup", None, 100, 0, "MASTER"),
        ("lost games", None, 0, 150, "MASTER"),
        ("full", "P", 200, 0, "CHALLENGER"),
    ]
    found = state.fetch_priority(spark.createDataFrame(rows, USERS), 49).collect()
    assert [r.summonerid for r in found] == ["full", "two pages", "lookup", "one page"]
    assert [r.summonerid for r in state.fetch_priority(spark.createDataFrame(rows, USERS), 50).collect()] == [
        "full",
        "one page",
    ]


def test_of_repeated_changes_the_last_counts(spark):
    table = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    changes = spark.createDataFrame([("a", 5, 1), ("a", 4, 2), ("c", 7, 1), ("c", 6, 3)], "k string, v int, at int")
    updated = state.keyed_update(table, changes, "k", order=["at"])
    assert sorted(map(tuple, updated.collect())) == [("a", 4), ("b", 2)]
    merged = state.upsert(table, changes, "k", ["v"], order=["at"])
    assert sorted(map(tuple, merged.collect())) == [("a", 4), ("b", 2), ("c", 6)]


def test_taking_a_batch_marks_it(spark):
    matches = spark.createDataFrame([("m1", "t", False), ("m2", "t", False), ("m3", "t", True)], "matchid string, tier string, status boolean")
    batch, marked = state.take_batch(matches, 1)
    assert [r.matchid for r in batch.collect()] == ["m1"]
    assert sorted(map(tuple, marked.collect())) == [("m1", "t", None), ("m2", "t", False), ("m3", "t", True)]
