"""Event logs of matches folded into skill and item sequences.

Events are dealt by match once; undos are matched to entries by windows, in time that
follows the number of events, and a match's sequences are gathered into one row. What the catalogue knows of an item comes by an equi-join on its id, for
catalogues of any size: the purchases that are left are exploded, looked up and
gathered by match again, a bounded number for each match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlens.functions import item_flags
from matchlens.functions.items import ALWAYS_COMPLETED

# Slots of a match, starting gold, event types.
SLOTS = 10
START_GOLD = 500

PURCHASED = "ITEM_PURCHASED"
SOLD = "ITEM_SOLD"
UNDO = "ITEM_UNDO"
SKILL_UP = "SKILL_LEVEL_UP"

ITEM_FLAGS = ("is_completed", "is_mythic", "is_boots")

ROWS = "array<struct<order:int,participantId:bigint,type:string,itemId:string,skillSlot:bigint>>"


def classify_items(items: DataFrame) -> DataFrame:
    """Catalogue with the classes an item belongs to and its base price."""
    flags = item_flags(
        F.col("itemId"), F.col("tags"), F.col("from"), F.col("into"), F.col("description")
    )
    return items.withColumns({**flags, "price": F.col("gold.base")})


def item_facts(items: DataFrame) -> DataFrame:
    """Per item id its price and classes.

    Of an id listed more than once the greatest price counts, and a class that
    any of its entries is in. Entries without an id are left out.
    """
    classified = classify_items(items).where(F.col("itemId").isNotNull())
    flags = [F.coalesce(F.bool_or(f), F.lit(False)).alias(f) for f in ITEM_FLAGS]
    return classified.groupBy("itemId").agg(F.max(F.col("price").cast("bigint")).alias("price"), *flags)


def ordered_events(timelines: DataFrame) -> DataFrame:
    """One row per event with its frame and its place in the whole log."""
    located = timelines.select(
        "matchId", F.posexplode(F.flatten(framed_events())).alias("eventOrder", "located")
    )
    return located.select("matchId", "located.frame", "eventOrder", "located.event.*")


def framed_events() -> Column:
    return F.transform(
        "frames",
        lambda frame, i: F.transform(
            frame["events"], lambda e: F.struct(i.alias("frame"), e.alias("event"))
        ),
    )


def slot_events(timelines: DataFrame) -> DataFrame:
    """One row per skill, purchase, sale and undo of the ten slots, dealt by match.

    Each slot has one row more, without a type, so that it stays where it has no events.
    """
    kept = F.filter(
        F.transform(F.flatten(F.transform("frames", lambda frame: frame["events"])), lambda e, i: F.struct(i.alias("order"), e.alias("event"))),
        lambda e: e["event"]["type"].isin(SKILL_UP, PURCHASED, SOLD, UNDO),
    )
    rows = F.transform(
        kept,
        lambda e: F.struct(
            e["order"].alias("order"),
            e["event"]["participantId"].cast("bigint").alias("participantId"),
            e["event"]["type"].alias("type"),
            e["event"]["itemId"].cast("string").alias("itemId"),
            e["event"]["skillSlot"].cast("bigint").alias("skillSlot"),
        ),
    )
    slots = F.transform(
        F.sequence(F.lit(1), F.lit(SLOTS)),
        lambda slot: F.struct(
            F.lit(-1).alias("order"),
            slot.cast("bigint").alias("participantId"),
            F.lit(None).cast("string").alias("type"),
            F.lit(None).cast("string").alias("itemId"),
            F.lit(None).cast("bigint").alias("skillSlot"),
        ),
    )
    events = timelines.select("matchId", F.inline(F.concat(slots, F.coalesce(rows, F.array().cast(ROWS)))))
    return events.where(F.col("participantId").between(1, SLOTS)).repartition("matchId")


def with_undone(events: DataFrame) -> DataFrame:
    """Events with ``undone``, whether an undo takes an entry back, and ``valid``, whether all undos of the slot find one.

    Entries and undos raise and lower a running depth. An undo takes back the last entry left, which is the one
    that raised the depth to where the undo finds it; at one depth, entries and their undos take turns, so an entry
    is undone if the next event of its depth is an undo. An undo that finds nothing lowers what counts as the ground.
    Each step is a sort of the slot's events, so time follows their number.
    """
    entry = F.col("type").isin(PURCHASED, SOLD)
    undo = F.col("type") == UNDO
    slot = Window.partitionBy("matchId", "participantId").orderBy("order")
    step = F.when(entry, 1).when(undo, -1).otherwise(0)
    summed = events.withColumn("sum", F.sum(step).over(slot))
    ground = F.least(F.lit(0), F.coalesce(F.min("sum").over(slot.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    height = F.col("sum") - ground
    levelled = summed.withColumn("level", F.when(entry, height).when(undo, height + 1))
    turns = Window.partitionBy("matchId", "participantId", "level").orderBy("order")
    undone = entry & F.coalesce(F.lead("type").over(turns) == UNDO, F.lit(False))
    return levelled.withColumn("undone", F.coalesce(undone, F.lit(False)))


def slot_logs(timelines: DataFrame) -> DataFrame:
    """Per match: skills, and purchases and sales that no undo took back, of all slots.

    A slot's log is invalid if an undo has nothing to take back. Events move once, by match.
    """
    events = with_undone(slot_events(timelines))
    is_skill, is_entry = F.col("type") == SKILL_UP, F.col("type").isin(PURCHASED, SOLD) & ~F.col("undone")
    skill = F.struct("order", "skillSlot")
    entry = F.struct("order", "itemId", (F.col("type") == PURCHASED).alias("bought"))
    slots = events.groupBy("matchId", "participantId").agg(
        F.transform(F.sort_array(F.collect_list(F.when(is_skill, skill))), lambda e: e["skillSlot"]).alias("skillTree"),
        F.struct(
            (F.min("sum") >= 0).alias("valid"),
            F.transform(
                F.sort_array(F.collect_list(F.when(is_entry, entry))), lambda e: F.struct(e["itemId"].alias("itemId"), e["bought"].alias("bought"))
            ).alias("entries"),
        ).alias("log"),
    )
    return slots.groupBy("matchId").agg(F.sort_array(F.collect_list(F.struct("participantId", "skillTree", "log"))).alias("slots"))


def start_length(bought: Column, gold: int) -> Column:
    """Number of leading purchases the starting gold pays for; NULL for an unknown price.

    The first purchase beyond the gold ends the set, whatever is sold.
    """
    kind = "struct<left:bigint,count:int>"
    start = F.struct(F.lit(gold).alias("left"), F.lit(0).alias("count")).cast(kind)

    def step(state: Column, item: Column) -> Column:
        left = state["left"] - item["price"]
        paid = F.struct(left.alias("left"), (state["count"] + F.when(left >= 0, 1).otherwise(0)).alias("count"))
        return F.when(state["left"] < 0, state).otherwise(paid.cast(kind))

    return F.aggregate(
        bought, start, step, lambda s: F.when(s["left"].isNotNull(), s["count"])
    )


def known_purchases(logs: DataFrame, items: DataFrame) -> DataFrame:
    """Logs with every purchase as a struct of its item id and the item's facts, in order.

    Each match gives one row without purchase, which keeps its slots, and one
    for every purchase; both meet again in one aggregation.
    """

    def bought(slot: Column) -> Column:
        kept = F.filter(slot["log"]["entries"], lambda e: e["bought"])
        return F.transform(kept, lambda e, i: F.struct(slot["participantId"].alias("slot"), i.alias("place"), e["itemId"].alias("itemId")))

    none = F.array(F.struct(F.lit(None).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("place"), F.lit(None).cast("string").alias("itemId")))
    slots = F.transform(
        "slots",
        lambda s: F.struct(s["participantId"].alias("participantId"), s["skillTree"].alias("skillTree"), s["log"]["valid"].alias("valid")),
    )
    purchases = logs.select("matchId", slots.alias("slots"), F.explode(F.concat(none, F.flatten(F.transform("slots", bought)))).alias("purchase"))
    rows = purchases.select(
        "matchId", F.when(F.col("purchase.slot").isNull(), F.col("slots")).alias("slots"), "purchase.*"
    )
    facts = item_facts(items)
    looked_up = rows.join(facts, "itemId", "left")
    flags = [F.coalesce(F.col(f), F.lit(f == "is_completed") & (F.col("itemId") == ALWAYS_COMPLETED)).alias(f) for f in ITEM_FLAGS]
    entry = F.struct("slot", "place", "itemId", "price", *flags)
    gathered = looked_up.groupBy("matchId").agg(
        F.first("slots", ignorenulls=True).alias("slots"),
        F.sort_array(F.collect_list(F.when(F.col("slot").isNotNull(), entry))).alias("purchases"),
    )
    own = F.transform("slots", lambda s: s.withField("bought", F.filter("purchases", lambda e: e["slot"] == s["participantId"])))
    return gathered.select("matchId", own.alias("slots"))


def last_of(items: Column, flag: str) -> Column:
    """Last item of a class, NULL without one."""
    return F.try_element_at(F.filter(items, lambda i: i[flag]), F.lit(-1))["itemId"]


def fold_timelines(
    timelines: DataFrame, items: DataFrame, gold: int = START_GOLD, keep_invalid: bool = False
) -> DataFrame:
    """Per match an array of ten slots with skills, starting items and builds.

    Starting items are sorted only when a further purchase closed the set.
    Completed items are in purchase order with repeats and leave out the
    starting ones. A match with an undo on an empty log, or with a starting
    purchase the catalogue does not know, is not valid and is dropped;
    ``keep_invalid`` keeps it, marked, to be fetched again.
    """
    staged = known_purchases(slot_logs(timelines), items)

    def with_start(slot: Column) -> Column:
        return slot.withField("startCount", start_length(slot["bought"], gold))

    def ids(entries: Column) -> Column:
        return F.transform(entries, lambda e: e["itemId"])

    def result(slot: Column) -> Column:
        bought, count = slot["bought"], slot["startCount"]
        start = ids(F.slice(bought, F.lit(1), count))
        later = F.slice(bought, count + 1, F.size(bought))
        completed = F.filter(later, lambda i: i["is_completed"])
        return F.struct(
            slot["participantId"].alias("participantId"),
            slot["skillTree"].alias("skillTree"),
            F.when(count < F.size(bought), F.array_sort(start)).otherwise(start).alias("itemStart"),
            ids(completed).alias("itemRarity"),
            last_of(later, "is_boots").alias("itemBoots"),
            last_of(completed, "is_mythic").alias("itemMyth"),
        )

    staged = staged.withColumn("slots", F.transform("slots", with_start))
    valid = F.forall("slots", lambda s: s["valid"] & s["startCount"].isNotNull())
    folded = staged.select(
        "matchId", valid.alias("valid"), F.transform("slots", result).alias("slots")
    )
    return folded if keep_invalid else folded.where("valid")


def slot_rows(folded: DataFrame) -> DataFrame:
    """One row per slot."""
    return folded.select("matchId", F.inline("slots"))


def merge_slots(matches: DataFrame, folded: DataFrame, seats: int | None = SLOTS) -> DataFrame:
    """Matches whose i-th participant carries the i-th slot's sequences.

    Both sides have one row per match; matches without a valid log, or with
    other than ``seats`` participants, are dropped; with None any number up to
    ten is merged. ``itemBuild`` is the list of completed items.
    """
    if seats is not None:
        matches = matches.where(F.size("participants") == seats)
    slots = folded.select(F.col("matchId").alias("foldedId"), "slots")
    joined = matches.join(slots, F.col("metadata.matchId") == F.col("foldedId"))

    def merged(p: Column, slot: Column) -> Column:
        together = p
        for name in ("skillTree", "itemStart", "itemRarity", "itemBoots", "itemMyth"):
            together = together.withField(name, slot[name])
        return together.withField("itemBuild", slot["itemRarity"])

    own = F.slice("slots", F.lit(1), F.size("participants"))
    zipped = F.zip_with("participants", own, merged)
    return joined.withColumn("participants", zipped).drop("foldedId", "slots")
