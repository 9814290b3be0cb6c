import random
import time

import pytest
from pyspark.sql import functions as F

from matchlens.operators.timeline import (
    classify_items,
    fold_timelines,
    merge_slots,
    ordered_events,
    slot_logs,
    slot_rows,
)
from matchlens.schema import ITEM_MAP, RAW_MATCH, TIMELINE
from matchlens.sources.catalogues import items_of

ITEMS = {
    "1001": {"tags": ["Boots"], "description": "", "gold": {"base": 300}},
    "1055": {"tags": [], "description": "", "into": ["3031"], "gold": {"base": 450}},
    "2003": {"tags": [], "description": "", "gold": {"base": 50}},
    "3006": {"tags": ["Boots"], "from": ["1001"], "description": "", "gold": {"base": 500}},
    "3031": {"tags": [], "from": ["1055"], "description": "", "gold": {"base": 3400}},
    "6671": {"tags": [], "from": ["1055"], "into": ["7000"], "description": "<rarityMythic>", "gold": {"base": 3400}},
    "6693": {"tags": [], "description": "", "gold": {"base": 3100}},
    "2033": {"tags": [], "from": ["2003"], "description": "", "gold": {"base": 500}},
    "223031": {"tags": [], "from": ["1055"], "description": "<rarityMythic>", "gold": {"base": 3400}},
}


def buy(item, who=1):
    return {"type": "ITEM_PURCHASED", "participantId": who, "itemId": item}


def sell(item, who=1):
    return {"type": "ITEM_SOLD", "participantId": who, "itemId": item}


def undo(who=1):
    return {"type": "ITEM_UNDO", "participantId": who}


def skill(slot, who=1):
    return {"type": "SKILL_LEVEL_UP", "participantId": who, "skillSlot": slot}


@pytest.fixture(scope="module")
def items(spark):
    return items_of(spark.createDataFrame([{"data": ITEMS}], ITEM_MAP)).cache()


def folded(spark, items, *frames, **options):
    rows = [{"matchId": "m", "frames": [{"events": list(f)} for f in frames]}]
    return fold_timelines(spark.createDataFrame(rows, TIMELINE), items, **options)


def first_slot(frame):
    return slot_rows(frame).where("participantId = 1").collect()[0]


def test_item_classes(items):
    rows = {r.itemId: r for r in classify_items(items).collect()}
    assert {i for i, r in rows.items() if r.is_boots} == {"1001", "3006"}
    assert {i for i, r in rows.items() if r.is_completed} == {"3031", "6671", "6693"}
    assert {i for i, r in rows.items() if r.is_mythic} == {"6671"}


def test_ten_slots_and_skills_across_frames(spark, items):
    made = folded(spark, items, [skill(1), skill(3, who=2)], [skill(2)], [skill(1)])
    rows = {r.participantId: r for r in slot_rows(made).collect()}
    assert set(rows) == set(range(1, 11))
    assert rows[1].skillTree == [1, 2, 1] and rows[2].skillTree == [3] and rows[3].skillTree == []
    assert rows[3].itemStart == [] and rows[3].itemBoots is None


def test_start_closed_by_overspend_is_sorted(spark, items):
    slot = first_slot(folded(spark, items, [buy(2003), buy(1055), buy(3031), buy(2003)]))
    assert slot.itemStart == ["1055", "2003"]
    assert slot.itemRarity == ["3031"]


def test_open_start_keeps_its_order(spark, items):
    slot = first_slot(folded(spark, items, [buy(2003), buy(1055)]))
    assert slot.itemStart == ["2003", "1055"]


def test_sales_do_not_refund(spark, items):
    slot = first_slot(folded(spark, items, [buy(1055), sell(1055), buy(1001)]))
    assert slot.itemStart == ["1055"] and slot.itemBoots == "1001"


def test_starting_boots_are_not_last_boots(spark, items):
    slot = first_slot(folded(spark, items, [buy(1001)]))
    assert slot.itemStart == ["1001"] and slot.itemBoots is None


def test_last_boots_and_mythic(spark, items):
    log = [buy(3031), buy(1001), buy(6671), buy(3006), buy(6693), buy(3031)]
    slot = first_slot(folded(spark, items, log))
    assert slot.itemStart == []
    assert slot.itemRarity == ["3031", "6671", "6693", "3031"]
    assert (slot.itemBoots, slot.itemMyth) == ("3006", "6671")


def test_undo_takes_back_a_purchase_or_a_sale(spark, items):
    slot = first_slot(folded(spark, items, [buy(1055), buy(3031), undo()], [sell(1055), undo(), buy(6693)]))
    assert slot.itemStart == ["1055"] and slot.itemRarity == ["6693"]


def test_undo_on_an_empty_log_drops_the_match(spark, items):
    assert folded(spark, items, [undo(), buy(1055)]).count() == 0
    kept = folded(spark, items, [undo(), buy(1055)], keep_invalid=True).collect()
    assert [r.valid for r in kept] == [False]


def test_unknown_price_matters_only_at_the_start(spark, items):
    assert folded(spark, items, [buy(9999)]).count() == 0
    slot = first_slot(folded(spark, items, [buy(3031), buy(9999)]))
    assert slot.itemRarity == ["3031"]


def test_events_keep_their_order(spark):
    rows = [{"matchId": "m", "frames": [{"events": [skill(1), skill(2)]}, {"events": [skill(3)]}]}]
    found = ordered_events(spark.createDataFrame(rows, TIMELINE)).orderBy("eventOrder").collect()
    assert [(r.frame, r.eventOrder, r.skillSlot) for r in found] == [(0, 0, 1), (0, 1, 2), (1, 2, 3)]


def test_slots_merge_by_place(spark, items):
    match = {
        "metadata": {"matchId": "m"},
        "participants": [{"championId": 1}, {"championId": 2}],
        "teams": [],
    }
    made = folded(spark, items, [skill(4, who=2), buy(3031, who=2)])
    merged = merge_slots(spark.createDataFrame([match], RAW_MATCH), made, seats=None)
    players = merged.select(F.inline("participants")).collect()
    assert [p.skillTree for p in players] == [[], [4]]
    assert players[1].itemBuild == ["3031"]


def test_matches_without_ten_seats_are_dropped(spark, items):
    made = folded(spark, items, [skill(4)])
    matches = [{"metadata": {"matchId": "m"}, "participants": [{"championId": i} for i in range(n)], "teams": []} for n in (9, 10, 11)]
    frame = spark.createDataFrame(matches, RAW_MATCH)
    assert [len(r.participants) for r in merge_slots(frame, made).collect()] == [10]


def test_a_large_catalogue_with_a_repeated_item(spark):
    ids = spark.range(30_000).selectExpr(
        "CAST(id AS STRING) AS itemId", "CAST(array() AS array<string>) AS tags", "CAST(NULL AS array<string>) AS `from`",
        "CAST(NULL AS array<string>) AS `into`", "'' AS description", "named_struct('base', CAST(100 AS BIGINT)) AS gold",
    )
    twice = ids.where("itemId = '29999'").withColumn("gold", F.expr("named_struct('base', CAST(450 AS BIGINT))"))
    slot = first_slot(folded(spark, ids.unionByName(twice), [buy(29999), buy(7)]))
    # The greatest price counts: after 450 the gold does not pay for 100 more.
    assert slot.itemStart == ["29999"]


def test_one_fold_moves_the_log_once(spark, items):
    rows = spark.createDataFrame([{"matchId": "m", "frames": []}], TIMELINE)
    plan = fold_timelines(rows, items)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Limit" not in plan


def folded_log(events):
    """The plain fold: an undo takes back the entry before it."""
    valid, entries = True, []
    for e in events:
        if e["type"] == "ITEM_UNDO":
            valid &= bool(entries)
            entries = entries[:-1]
        elif e["type"] in ("ITEM_PURCHASED", "ITEM_SOLD"):
            entries.append((str(e["itemId"]), e["type"] == "ITEM_PURCHASED"))
    return valid, entries


def test_undo_equals_the_fold(spark):
    rng = random.Random(8)
    logs = {}
    for m in range(60):
        share = rng.choice((0.1, 0.4, 0.5, 0.6))
        logs[f"m{m}"] = [
            undo(rng.randint(1, 3)) if rng.random() < share else rng.choice((buy, sell))(rng.randint(1, 5), rng.randint(1, 3)) for _ in range(rng.randint(0, 60))
        ]
    rows = [{"matchId": m, "frames": [{"events": events[:7]}, {"events": events[7:]}]} for m, events in logs.items()]
    found = {}
    for r in slot_logs(spark.createDataFrame(rows, TIMELINE)).collect():
        assert [s.participantId for s in r.slots] == list(range(1, 11))
        found[r.matchId] = [(s.log.valid, [tuple(e) for e in s.log.entries]) for s in r.slots[:3]]
    assert found == {m: [folded_log([e for e in events if e["participantId"] == who]) for who in (1, 2, 3)] for m, events in logs.items()}


def test_time_of_long_logs_follows_their_length(spark):
    def seconds(n):
        rng = random.Random(9)
        events = [undo() if rng.random() < 0.45 else buy(i % 7) for i in range(n)]
        frame = spark.createDataFrame([{"matchId": "m", "frames": [{"events": events}]}], TIMELINE).cache()
        frame.count()
        start = time.perf_counter()
        (row,) = slot_logs(frame).collect()
        took = time.perf_counter() - start
        valid, entries = folded_log(events)
        assert (row.slots[0].log.valid, [tuple(e) for e in row.slots[0].log.entries]) == (valid, entries)
        return took

    seconds(1000)  # compiled
    assert seconds(100_000) < 10 * max(seconds(20_000), 0.5)


def test_logs_without_events_keep_their_slots(spark):
    rows = [{"matchId": "empty", "frames": []}, {"matchId": "none", "frames": None}, {"matchId": "other", "frames": [{"events": [{"type": "WARD_PLACED", "participantId": 1}]}]}]
    found = slot_logs(spark.createDataFrame(rows, TIMELINE)).collect()
    assert {r.matchId for r in found} == {"empty", "none", "other"}
    assert all(len(r.slots) == 10 and all(s.log.valid and not s.log.entries and not s.skillTree for s in r.slots) for r in found)
