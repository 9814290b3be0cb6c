"""Registered queries: every operator over the views of the whole test tables."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlens.functions import game_day
from matchlens.operators import (
    calibrate,
    cohorts,
    daily,
    document,
    flatten,
    matchups,
    options,
    picks,
    rows,
    state,
    timeline,
)
from matchlens.operators.cohorts import COHORT, LADDER_COHORTS, STORED_COHORTS
from matchlens.schema import CHAMPION_MAP, ITEM_MAP
from matchlens.session import work_folder
from matchlens.sources.catalogues import champions_of, items_of
from matchlens.sources.committed import Batch, Committed
from matchlens.sources.documents import write_documents, write_table_json
from matchlens.sources.fact_tables import bucketed_facts
from matchlens.sources.matches import DOCUMENT_COLUMNS, land_batch, read_json_run, read_json_values, read_raw, read_recent, stored_facts, write_facts, write_raw
from matchlens.sources.text_files import numbered_lines
from matchlens.sources.warehouse import append_facts, create_recent_view, drop_expired, full_refresh, read_dates
from matchlens.streaming import KeyedState, decode_messages, land_messages, write_keyed_files
from workloads import views

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime.date(2001, 8, 2)
ALL_DAYS = 3000
COUNTER_GAMES = 3
SYNERGY_GAMES = 3


def text(array: Column | str) -> Column:
    """Array as text, so that any engine compares it; a cast of the whole array is compiled, a lambda is not."""
    return F.array_join((F.col(array) if isinstance(array, str) else array).cast("array<string>"), ",")


def with_text(df: DataFrame) -> DataFrame:
    """Every array column as text."""
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({name: text(F.col(name)) for name in arrays}) if arrays else df


def finished(spark: SparkSession, folder: str) -> DataFrame:
    return cohorts.finished_games(cohorts.with_canonical_values(views.facts(spark, folder)))


# --- champion statistics ---------------------------------------------------


def pick_win(spark, folder):
    return picks.picks(finished(spark, folder)).drop(COHORT)


def ban_count(spark, folder):
    return picks.bans(finished(spark, folder)).drop(COHORT)


def match_count(spark, folder):
    return cohorts.match_totals(finished(spark, folder), LADDER_COHORTS)


def match_sketches(spark, folder):
    """Different matches of the last days by merged daily sketches, and whether they are within 5 per cent of the exact count."""
    recent = cohorts.recent_days(finished(spark, folder), AS_OF, ALL_DAYS)
    exact = cohorts.match_totals(recent, LADDER_COHORTS)
    merged = cohorts.merged_match_totals(cohorts.daily_match_sketches(recent), LADDER_COHORTS)
    close = F.abs(F.col("estimate") - F.col("total_cnt")) <= 0.05 * F.col("total_cnt")
    return exact.join(merged.withColumnRenamed("total_cnt", "estimate"), COHORT).select(COHORT, "total_cnt", close.alias("close"))


def tier_cohorts(spark, folder):
    return picks.picks(finished(spark, folder), cohorts=LADDER_COHORTS)


def tier_cohort_bans(spark, folder):
    return picks.bans(finished(spark, folder), LADDER_COHORTS)


def tier_filtered(spark, folder):
    rows_of = cohorts.tier_filter(views.facts(spark, folder), "diamond")
    return rows_of.groupBy("tier").agg(F.count("*").alias("rows"))


def _option(name: str) -> Query:
    def run(spark, folder):
        family = next(f for f in options.families() if f.name == name)
        shares = options.option_share(finished(spark, folder), family)
        return with_text(shares.drop(COHORT))

    return run


def option_share_merged(spark, folder):
    family = next(f for f in options.families(normalize_start=True) if f.name == "itemStart")
    return with_text(options.option_share(finished(spark, folder), family).drop(COHORT))


def option_shares_by_cohort(spark, folder):
    chosen = options.families()
    shares = options.option_shares(finished(spark, folder), chosen, cohorts=LADDER_COHORTS)
    shown = F.coalesce(
        *[
            F.when(
                F.col("family") == f.name,
                F.concat_ws(";", *[F.col(c) for c in f.columns]),
            )
            for f in chosen
        ]
    )
    rendered = with_text(shares)
    return rendered.select(
        COHORT,
        "championId",
        "teamPosition",
        "family",
        shown.alias("option"),
        "win_rate",
        "pick_rate",
        "select_cnt",
    )


def power_curve(spark, folder):
    return options.power_curve(finished(spark, folder)).drop(COHORT)


def damage_profile(spark, folder):
    profile = picks.damage_profile(finished(spark, folder))
    return _round(profile.select("championId", "teamPosition", "damage.*"), 6)


def _round(df: DataFrame, digits: int) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({name: F.round(name, digits) for name in doubles})


def counter(spark, folder):
    recent = cohorts.recent_days(finished(spark, folder), AS_OF, ALL_DAYS)
    return matchups.counter(recent, min_games=COUNTER_GAMES).drop(COHORT)


def synergy(spark, folder):
    recent = cohorts.recent_days(finished(spark, folder), AS_OF, ALL_DAYS)
    return matchups.synergy(recent, min_games=SYNERGY_GAMES).drop(COHORT)


def synergy_by_cohort(spark, folder):
    recent = cohorts.recent_days(finished(spark, folder), AS_OF, ALL_DAYS)
    return matchups.synergy(recent, LADDER_COHORTS, min_games=SYNERGY_GAMES)


def aram_synergy(spark, folder):
    return matchups.aram_synergy(finished(spark, folder)).drop(COHORT)


def aram_counter(spark, folder):
    return matchups.aram_counter(finished(spark, folder)).drop(COHORT)


def _document_rows(documents: DataFrame, arrays: list[str]) -> DataFrame:
    keys = [c for c in (COHORT, "championId", "teamPosition") if c in documents.columns]
    ban = ["ban_rate"] if "ban_rate" in documents.columns else []
    sizes = [F.when(F.col(a).isNull(), F.lit(0)).otherwise(F.size(a)).cast("bigint").alias(f"n_{a}") for a in arrays]
    return documents.select(
        *keys,
        "pick_cnt",
        "win_rate",
        "pick_rate",
        *ban,
        "position_cnt",
        F.round("score", 6).alias("score"),
        "tier",
        F.round("damage.totalDamage", 6).alias("totalDamage"),
        text(F.get("statPerks.statPerks", F.lit(0))).alias("top_statPerks"),
        text(F.get("itemStart.itemStart", F.lit(0))).alias("top_itemStart"),
        F.get("powerCurve.minute", F.lit(0)).alias("first_minute"),
        *sizes,
    )


LANE_ARRAYS = [
    "statPerks",
    "perks",
    "summonerSpell",
    "itemStart",
    "itemMiddle",
    "itemBuild",
    "skillTree",
    "powerCurve",
    "counter",
    "synergy",
]


def champion_document(spark, folder):
    """Documents from a table of facts with versions, tiers and matches stored apart."""
    facts = bucketed_facts(views.facts(spark, folder), DOCUMENT_COLUMNS)
    made = document.champion_documents(facts, AS_OF, ALL_DAYS, STORED_COHORTS, SYNERGY_GAMES)
    return _document_rows(made, LANE_ARRAYS)


def document_arrays(spark, folder):
    """Every entry of every array of the documents, with its place."""
    facts = bucketed_facts(views.facts(spark, folder), DOCUMENT_COLUMNS)
    made = document.champion_documents(facts, AS_OF, ALL_DAYS, STORED_COHORTS, SYNERGY_GAMES)
    measures = ("win_rate", "pick_rate", "select_cnt")

    def entries(name: str) -> Column:
        kinds = {f.name: f.dataType for f in made.schema[name].dataType.elementType.fields if f.name not in measures}

        def entry(e: Column, i: Column) -> Column:
            parts = [text(e[f]) if isinstance(kind, T.ArrayType) else e[f].cast("string") for f, kind in kinds.items()]
            return F.struct(
                F.lit(name).alias("array"), (i + 1).cast("bigint").alias("place"), F.concat_ws(";", *parts).alias("option"), *[e[m].alias(m) for m in measures]
            )

        return F.coalesce(F.transform(name, entry), F.array())

    shown = made.select(COHORT, "championId", "teamPosition", F.flatten(F.array(*map(entries, LANE_ARRAYS))).alias("entries"))
    return shown.select(COHORT, "championId", "teamPosition", F.inline("entries"))


def nested_document(spark, folder):
    """Documents from nested matches: flatten, store, statistics."""
    facts = stored_facts(flatten.flatten_matches(views.raw_matches(spark, folder)))
    made = document.champion_documents(facts, AS_OF, ALL_DAYS, min_games=SYNERGY_GAMES)
    return _document_rows(made, LANE_ARRAYS)


def aram_document(spark, folder):
    made = document.aram_documents(stored_facts(views.facts(spark, folder)), AS_OF, ALL_DAYS)
    return _document_rows(made, LANE_ARRAYS)


# --- selections and daily tables --------------------------------------------


def latest_version(spark, folder):
    known = cohorts.with_canonical_values(views.facts(spark, folder))
    return cohorts.latest_version(known)


def current_version(spark, folder):
    known = cohorts.with_canonical_values(views.facts(spark, folder))
    current = cohorts.current_version(known)
    return current.groupBy("gameVersion", "tier").agg(F.count("*").alias("rows"))


def recent_days(spark, folder):
    recent = cohorts.recent_days(views.facts(spark, folder), AS_OF, 365)
    return recent.groupBy("date").agg(F.count("*").alias("rows"))


def recent_view(spark, folder):
    moment = datetime.datetime(2001, 8, 2, 20, 30)
    create_recent_view(views.facts(spark, folder), moment, "recent_solo", days=180)
    return spark.sql("SELECT date, count(*) AS rows FROM recent_solo GROUP BY date")


def retained(spark, folder):
    kept = cohorts.retained(views.facts(spark, folder), AS_OF, 60)
    return kept.groupBy("date").agg(F.count("*").alias("rows"))


def date_range(spark, folder):
    chosen = read_dates(
        views.facts(spark, folder), datetime.date(1999, 1, 1), datetime.date(1999, 12, 31)
    )
    return chosen.groupBy("date").agg(F.count("*").alias("rows"))


def daily_picks(spark, folder):
    return daily.daily_picks(cohorts.finished_games(views.facts(spark, folder)))


def daily_bans(spark, folder):
    return daily.daily_bans(cohorts.finished_games(views.facts(spark, folder)))


# --- flattening --------------------------------------------------------------


def flatten_participants(spark, folder):
    flat = flatten.flatten_matches(views.raw_matches(spark, folder))
    shown = [
        "matchId",
        "tier",
        "gameVersion",
        "date",
        "gameDuration",
        "queueId",
        "p_championId",
        "p_teamId",
        "p_teamPosition",
        "p_win",
        "p_physicalDamageDealtToChampions",
        "p_itemStart",
        "p_skillTree",
        "ban",
        "o_championId",
        "o_win",
        "o_skillTree",
    ]
    return with_text(flat.select(*shown))


def flatten_every_column(spark, folder):
    """All columns of the flat rows, the opponent's included."""
    return with_text(flatten.flatten_matches(views.raw_matches(spark, folder)))


def flatten_aram(spark, folder):
    """All columns of the flat rows without opponents and bans."""
    return with_text(flatten.flatten_matches(views.raw_matches(spark, folder), with_opponent=False))


def ban_lookup(spark, folder):
    flat = flatten.flatten_matches(views.raw_matches(spark, folder))
    return flat.groupBy("ban").agg(F.count("*").alias("rows"))


def opponent_lookup(spark, folder):
    flat = flatten.flatten_matches(views.raw_matches(spark, folder))
    return flat.groupBy("p_championId", "p_teamPosition", "o_championId", "o_teamPosition").agg(
        F.count("*").alias("rows")
    )


def rune_lists(spark, folder):
    flat = flatten.flatten_matches(views.raw_matches(spark, folder))
    runes = ["statPerks", "primaryStyle", "subStyle", "primaryStyles", "subStyles"]
    own = [f"p_{r}" for r in runes]
    other = [f"o_{r}" for r in runes]
    return with_text(flat.select("matchId", "p_championId", "p_teamId", *own, *other))


def day_of_play(spark, folder):
    raw = views.raw_matches(spark, folder)
    return raw.select(
        F.col("metadata.matchId").alias("matchId"),
        game_day(F.col("metadata.gameStartTimestamp")).alias("date"),
    )


# --- timelines ---------------------------------------------------------------


def _folded(spark, folder):
    return timeline.fold_timelines(views.timelines(spark, folder), views.catalogue(spark, folder))


def timeline_events(spark, folder):
    return timeline.ordered_events(views.timelines(spark, folder)).select(
        "matchId",
        F.col("frame").cast("bigint").alias("frame"),
        F.col("eventOrder").cast("bigint").alias("eventOrder"),
        "type",
        "participantId",
    )


def skill_order(spark, folder):
    logs = timeline.slot_logs(views.timelines(spark, folder))
    return with_text(logs.select("matchId", F.inline("slots")).drop("log"))


def purchase_log_undo(spark, folder):
    logs = timeline.slot_logs(views.timelines(spark, folder)).select("matchId", F.inline("slots"))
    entries = F.transform(
        "log.entries", lambda e: F.concat(e["itemId"], F.when(e["bought"], "+").otherwise("-"))
    )
    valid = F.col("log.valid")
    return logs.select(
        "matchId",
        "participantId",
        valid.alias("valid"),
        F.when(valid, F.array_join(entries, ",")).alias("entries"),
    )


def timeline_slots(spark, folder):
    return with_text(timeline.slot_rows(_folded(spark, folder)))


def starting_items(spark, folder):
    slots = timeline.slot_rows(_folded(spark, folder))
    return with_text(slots.select("matchId", "participantId", "itemStart"))


def completed_items(spark, folder):
    slots = timeline.slot_rows(_folded(spark, folder))
    spread = slots.select("matchId", "participantId", F.posexplode("itemRarity"))
    return spread.select(
        "matchId",
        "participantId",
        F.col("pos").cast("bigint").alias("place"),
        F.col("col").alias("itemId"),
    )


def last_items(spark, folder):
    slots = timeline.slot_rows(_folded(spark, folder))
    return slots.select("matchId", "participantId", "itemBoots", "itemMyth")


def merged_matches(spark, folder):
    raw = views.raw_matches(spark, folder)
    number = F.regexp_replace("metadata.matchId", "R_", "T_")
    named = raw.withColumn("metadata", F.col("metadata").withField("matchId", number))
    merged = timeline.merge_slots(named, _folded(spark, folder))
    flat = flatten.flatten_matches(merged, with_opponent=False)
    return with_text(
        flat.select("matchId", "p_championId", "p_teamId", "p_skillTree", "p_itemBuild", "p_itemBoots")
    )


def part_item_builds(spark, folder):
    """Timelines folded with a catalogue that has an item for every part."""
    parts = views.table(spark, folder, "part").count()
    found = views.timelines(spark, folder, f"97 * (1 + event_id % {parts})")
    folded = timeline.fold_timelines(found, views.part_items(spark, folder), gold=3000)
    return with_text(timeline.slot_rows(folded).drop("skillTree"))


def item_classes(spark, folder):
    return timeline.classify_items(views.part_items(spark, folder)).select(
        "itemId", "is_boots", "is_completed", "is_mythic", "price"
    )


def _catalogue_documents(spark, folder, value: Column, schema: T.StructType) -> DataFrame:
    """Parts as JSON documents, each a map of one block of parts."""
    parts = views.table(spark, folder, "part").select(
        F.expr(f"p_partkey div {views.PARTS_PER_POSITION}").alias("block"),
        F.struct(F.concat(F.lit("n"), "p_partkey").alias("key"), value.alias("value")).alias("entry"),
    )
    maps = parts.groupBy("block").agg(F.map_from_entries(F.collect_list("entry")).alias("data"))
    documents = maps.select(F.to_json(F.struct("data")).alias("json"))
    return documents.select(F.from_json("json", schema).alias("doc")).select("doc.*")


def champion_dimension(spark, folder):
    value = F.struct(F.col("p_partkey").cast("string").alias("key"), F.col("p_name").alias("id"))
    return champions_of(_catalogue_documents(spark, folder, value, CHAMPION_MAP))


def item_catalogue(spark, folder):
    value = F.struct(
        F.array("p_brand").alias("tags"),
        F.when(F.col("p_size") > 20, F.array("p_type")).alias("from"),
        F.col("p_name").alias("description"),
        F.struct(F.col("p_size").cast("bigint").alias("base")).alias("gold"),
    )
    items = items_of(_catalogue_documents(spark, folder, value, ITEM_MAP))
    return items.select(
        "itemId",
        text("tags").alias("tags"),
        F.col("from").isNotNull().alias("has_from"),
        "description",
        F.col("gold.base").alias("base"),
    )


# --- tables and files -----------------------------------------------------------


def _order_rows(spark, folder) -> DataFrame:
    """Orders with the first day of their year, so that a table has few partitions."""
    orders = views.table(spark, folder, "orders")
    return orders.select(F.trunc("o_orderdate", "year").alias("date"), "o_orderkey", "o_orderpriority", "o_orderstatus")


def table_append(spark, folder):
    """A table made by its first rows, added to in another column order, read by date."""
    name = f"orders_{uuid.uuid4().hex}"
    found = _order_rows(spark, folder)
    append_facts(found.where("o_orderstatus = 'O'"), name)
    append_facts(found.where("o_orderstatus <> 'O'").select(*reversed(found.columns)), name)
    return read_dates(spark.table(name), datetime.date(1996, 1, 1), datetime.date(1999, 12, 31))


def table_refresh(spark, folder):
    """One table refreshed, added to and rid of its oldest dates."""
    name = f"orders_{uuid.uuid4().hex}"
    found = _order_rows(spark, folder)
    append_facts(found, name)
    full_refresh(found.where("o_orderpriority <> '5-LOW'"), name)
    append_facts(found.where("o_orderpriority = '1-URGENT'"), name)
    drop_expired(spark, name, datetime.date(2001, 1, 1), 1500)
    return spark.table(name)


def raw_day_round_trip(spark, folder):
    """Nested matches written as two days, the second one replaced, and one day read."""
    root = f"{work_folder(spark)}/raw-{uuid.uuid4().hex}"
    raw = views.raw_matches(spark, folder)
    for day, rows_of_day in ((1, raw), (2, raw.limit(0)), (2, raw)):
        write_raw(rows_of_day, root, "solo", datetime.date(2024, 1, day))
    kept = read_raw(spark, root, "solo", datetime.date(2024, 1, 2), raw.schema)
    return kept.select(F.col("metadata.matchId").alias("matchId"), game_day(F.col("metadata.gameStartTimestamp")).alias("date"))


def json_table_round_trip(spark, folder):
    path = f"{work_folder(spark)}/table-{uuid.uuid4().hex}"
    customers = views.table(spark, folder, "customer").select("c_custkey", F.concat(F.lit("소환사 "), "c_name").alias("name"), "c_acctbal")
    write_table_json(customers, path)
    return read_json_values(spark, path, customers.schema)


def daily_facts_with_gaps(spark, folder):
    """Facts of each year stored as a day, one day missing and one written twice, and the last six days read."""
    root = f"{work_folder(spark)}/daily-{uuid.uuid4().hex}"
    facts = stored_facts(views.facts(spark, folder), ("matchId", "date", "p_championId", "p_win"))
    for year, day in ((1995, 1), (1996, 2), (1997, 3), (1999, 5), (1998, 5), (2000, 6), (2001, 7), (1999, 8)):
        write_facts(facts.where(F.year("date") == year), root, "solo", datetime.date(2024, 1, day))
    found = read_recent(spark, root, "solo", datetime.date(2024, 1, 8), facts.schema, days=6)
    return found.groupBy("run_date", "p_championId").agg(F.count("*").alias("rows"), F.count_if("p_win").alias("wins"))


def document_sinks(spark, folder):
    """Documents written per queue and cohort, and read again in the order of their score."""
    root = f"{work_folder(spark)}/documents-{uuid.uuid4().hex}"
    facts = bucketed_facts(views.facts(spark, folder), DOCUMENT_COLUMNS)
    made = document.champion_documents(facts, AS_OF, ALL_DAYS, STORED_COHORTS, SYNERGY_GAMES).select(COHORT, "championId", "teamPosition", "score", "tier")
    write_documents(made, root, "solo")
    stored = spark.read.schema(made.schema).parquet(f"{root}/queue=solo").withColumn("place", F.monotonically_increasing_id())
    place = F.row_number().over(Window.partitionBy(COHORT).orderBy("place"))
    return stored.select(COHORT, place.cast("bigint").alias("place"), F.round("score", 6).alias("score"))


# --- fetch state ---------------------------------------------------------------


def upsert_users(spark, folder):
    batch = state.with_match_number(views.user_batch(spark, folder))
    return state.upsert(
        views.users(spark, folder), batch, "summonerid", ["match_num", "tier"], {"update_num": F.lit(0)}
    )


def insert_if_absent(spark, folder):
    return state.insert_if_absent(
        views.match_state(spark, folder),
        views.match_batch(spark, folder),
        "matchid",
        ["seen", "tier"],
        {"status": F.lit(False)},
    )


def keyed_update(spark, folder):
    found = views.user_batch(spark, folder).select(
        "summonerid", F.concat(F.lit("Q_"), "summonerid").alias("puuid")
    )
    return state.keyed_update(views.users(spark, folder), found, "summonerid")


def repeated_update(spark, folder):
    """Line items as changes of matches; most matches change many times."""
    changes = views.match_batch(spark, folder)
    return state.keyed_update(views.match_state(spark, folder), changes, "matchid", ["seen", "tier"])


def repeated_upsert(spark, folder):
    return state.upsert(
        views.match_state(spark, folder),
        views.match_batch(spark, folder),
        "matchid",
        ["tier"],
        {"status": F.lit(False)},
        ["seen", "tier"],
    )


STATE_PARTS = 16


def keyed_parts(spark, folder):
    """State dealt into parts, of which a change replaces those that its keys are in; each row with its part's version."""
    root = f"{work_folder(spark)}/state-{uuid.uuid4().hex}"
    matches = views.match_state(spark, folder)
    first = Batch(spark, root)
    first.replace("matches", matches, "matchid", STATE_PARTS)
    first.commit()
    second = Batch(spark, root)
    done = state.backlog(matches, 5).select("matchid")
    second.change("matches", matches.schema, done, "matchid", state.mark_done, STATE_PARTS)
    second.commit()
    return Committed(spark, root).read("matches", matches.schema)


def landed_batches(spark, folder):
    """Two batches landed with their state; the second one fails half-way and is run again."""
    root = f"{work_folder(spark)}/landing-{uuid.uuid4().hex}"
    first = Batch(spark, root)
    first.replace("matches", views.match_state(spark, folder), "matchid", STATE_PARTS)
    first.commit()
    orders = views.table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("id"), "o_orderpriority")
    batches = [orders.where(F.col("o_orderpriority") == p) for p in ("1-URGENT", "2-HIGH")]
    for number, documents in enumerate(batches):
        Batch(spark, root).land("documents", documents.unionAll(documents), number)  # written, never committed
        land_batch(spark, root, documents, number, F.col("id"), STATE_PARTS)
        land_batch(spark, root, documents, number, F.col("id"), STATE_PARTS)  # a repeat
    tables = Committed(spark, root)
    landed = tables.read("documents", orders.schema).select(F.col("id").alias("matchid"), F.col("part").alias("batch"))
    return tables.read("matches", views.match_state(spark, folder).schema).drop("part", "version").join(landed, "matchid", "left")


def mark_done(spark, folder):
    landed = views.match_batch(spark, folder).select("matchid")
    return state.mark_done(views.match_state(spark, folder), landed)


def mark_in_flight(spark, folder):
    matches = views.match_state(spark, folder)
    return state.mark_in_flight(matches, state.backlog(matches, 500))


def settle_update_numbers(spark, folder):
    return state.settle_update_numbers(views.users(spark, folder))


def reset_in_flight(spark, folder):
    return state.reset_in_flight(views.match_state(spark, folder))


def backlog(spark, folder):
    return state.backlog(views.match_state(spark, folder), 500)


def done_count(spark, folder):
    return state.done_count(views.match_state(spark, folder))


def fetch_priority(spark, folder):
    return state.fetch_priority(views.users(spark, folder), 20)


# --- row selections and calibration ---------------------------------------------


def json_values(spark, folder):
    events = views.table(spark, folder, "events")
    return events.select("event_id", F.from_json("props", "k bigint").alias("value")).select(
        "event_id", "value.k"
    )


def top_k(spark, folder):
    orders = views.table(spark, folder, "orders").where(F.col("o_orderpriority") == "3-MEDIUM")
    top = rows.top_rows(orders, "o_totalprice", 5, ("o_orderkey",))
    return top.select("o_orderkey", "o_totalprice")


def mask_rows(spark, folder):
    orders = views.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return rows.mask_rows(orders, F.col("o_orderstatus") == "F")


def masked_first(spark, folder):
    """First rows by price after a mask: masked rows have no price and come last."""
    orders = views.table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    masked = rows.mask_rows(orders, F.col("o_orderstatus") == "F", keep=("o_orderkey",))
    return rows.top_rows(masked, "o_totalprice", 5, ("o_orderkey",))


def rank_first(spark, folder):
    lines = views.table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return rows.rank_first(lines, "o_totalprice", "o_orderkey", "place", ["o_orderpriority"])


def rank_ties(spark, folder):
    parts = views.table(spark, folder, "part").select("p_partkey", "p_size")
    return rows.rank_first(parts, "p_size", "p_partkey", "place")


def element_means(spark, folder):
    vectors = views.table(spark, folder, "embeddings")
    means = rows.element_means(vectors, "embedding", ["label"])
    return means.select(
        F.col("label").cast("bigint").alias("label"),
        F.col("idx").cast("bigint").alias("idx"),
        F.round("mean", 6).alias("mean"),
    )


def _records(spark, folder):
    return calibrate.parse_records(views.rankings(spark, folder), by=["position"])


def record_reshape(spark, folder):
    return _records(spark, folder)


def record_files(spark, folder):
    """Records of one large text file, read in splits that cut lines and records."""
    path = f"{work_folder(spark)}/records-{uuid.uuid4().hex}"
    views.ranking_lines(spark, folder).coalesce(1).write.text(path)
    lines = numbered_lines(spark, path, split_bytes=65_536)
    return calibrate.records_of_lines(lines).drop("file")


def json_run(spark, folder):
    """Values of JSON files in which they follow each other without line ends."""
    path = f"{work_folder(spark)}/json-run-{uuid.uuid4().hex}"
    views.json_run(spark, folder).write.text(path)
    schema = T.StructType().add("event_id", "long").add("note", "string").add("tags", T.ArrayType(T.StringType()))
    found = read_json_run(spark, path, schema, split_bytes=65_536)
    return found.select("event_id", "note", F.get("tags", F.lit(0)).alias("first"), F.get_json_object(F.get("tags", F.lit(1)), "$.k.k").alias("k"))


def _features(version: int) -> Query:
    def run(spark, folder):
        made = calibrate.features(_records(spark, folder), ["position"], version)
        return made.select(
            "position", "ordinal", F.round("x1", 6).alias("x1"), F.round("x2", 6).alias("x2")
        )

    return run


def ols_fit(spark, folder):
    made = calibrate.features(_records(spark, folder), ["position"])
    return _round(calibrate.fit(made, ["position"]), 6)


def _predict(version: int) -> Query:
    def run(spark, folder):
        compared = calibrate.compare_ranks(_records(spark, folder), ["position"], version)
        return compared.select(
            "position",
            "name",
            "score",
            F.round("predict", 6).alias("predict"),
            F.col("score_rank").cast("bigint").alias("score_rank"),
            F.col("predict_rank").cast("bigint").alias("predict_rank"),
        )

    return run


def mean_pick_rate(spark, folder):
    records = _records(spark, folder)
    return records.groupBy("position").agg(
        F.round(F.avg("pick_rate"), 6).alias("mean_pick_rate"), F.count("*").alias("rows")
    )


# --- streaming ---------------------------------------------------------------------


def stream_decode(spark, folder):
    """Events as a stream of keyed messages, decoded and landed until the stream is drained."""
    schema = views.table(spark, folder, "events").schema
    source = spark.readStream.schema(schema).parquet(f"{folder}/events*.parquet")
    target = f"{work_folder(spark)}/stream-{uuid.uuid4()}"
    decoded = decode_messages(views.to_messages(source))
    query = land_messages(decoded, f"{target}/rows", f"{target}/checkpoint", once=True)
    query.awaitTermination()
    return spark.read.schema(decoded.schema).parquet(f"{target}/rows")


LAST_EVENT = T.StructType().add("user", "string").add("ts", "timestamp_ntz").add("event_id", "long").add("event_type", "string").add("props", "string")


def stream_state(spark, folder):
    """Last event of each user, kept from a stream in two drains with a restart, a repeated batch and a reset."""
    root = f"{work_folder(spark)}/keyed-{uuid.uuid4().hex}"
    events = views.table(spark, folder, "events")
    event_schema = events.schema
    split = events.agg(F.expr("percentile_approx(event_id, 0.5)")).scalar()

    def users(messages: DataFrame) -> DataFrame:
        return messages.select(F.col("user_id").cast("string").alias("user"), F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id", "event_type", "props")

    def drain() -> KeyedState:
        kept = KeyedState(spark, f"{root}/table", LAST_EVENT, "user", ["ts", "event_id"], STATE_PARTS)
        kept.start(spark.readStream.schema(event_schema).parquet(f"{root}/in"), users, once=True).awaitTermination()
        return kept

    events.where(F.col("event_id") > split).write.mode("append").parquet(f"{root}/in")
    drain()
    events.where(F.col("event_id") <= split).write.mode("append").parquet(f"{root}/in")  # late ones
    kept = drain()
    late = users(events).withColumn("event_type", F.lit("repeat")).withColumn("ts", F.col("ts") + F.expr("interval 1 day"))
    kept.apply(late, 1)  # a batch that is recorded already
    kept.reset()
    return drain().rows()


def keyed_files(spark, folder):
    """Messages sent to files by key and decoded again, with the place of each among its key's."""
    path = f"{work_folder(spark)}/topic-{uuid.uuid4().hex}"
    events = views.table(spark, folder, "events")
    ordered = views.to_messages(events, "ts", "event_id")
    write_keyed_files(ordered, path, STATE_PARTS, ["ts", "event_id"])
    # A part is one file, read by as many tasks as it has splits; file and row group order is that of the rows.
    sent = spark.read.schema(ordered.schema).parquet(path).withColumn("at", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("id")))
    place = F.row_number().over(Window.partitionBy("key").orderBy("at")).cast("bigint")
    return decode_messages(sent.withColumn("place", place), "event_id", "place").drop("line")


QUERIES: dict[str, Query] = {
    "pick_win": pick_win,
    "ban_count": ban_count,
    "match_count": match_count,
    "tier_cohorts": tier_cohorts,
    "tier_cohort_bans": tier_cohort_bans,
    "tier_filter": tier_filtered,
    "option_share_array": _option("statPerks"),
    "option_share_two_arrays": _option("perks"),
    "option_share_pair": _option("summonerSpell"),
    "option_share_sorted_array": _option("itemStart"),
    "option_share_merged_array": option_share_merged,
    "option_share_middle": _option("itemMiddle"),
    "option_share_prefix3": _option("itemBuild"),
    "option_share_prefix13": _option("skillTree"),
    "option_shares_by_cohort": option_shares_by_cohort,
    "power_curve": power_curve,
    "damage_profile": damage_profile,
    "counter": counter,
    "synergy": synergy,
    "synergy_by_cohort": synergy_by_cohort,
    "aram_synergy": aram_synergy,
    "aram_counter": aram_counter,
    "champion_document": champion_document,
    "document_arrays": document_arrays,
    "nested_document": nested_document,
    "aram_document": aram_document,
    "latest_version": latest_version,
    "current_version": current_version,
    "recent_days": recent_days,
    "recent_view": recent_view,
    "retained": retained,
    "date_range": date_range,
    "daily_picks": daily_picks,
    "daily_bans": daily_bans,
    "flatten_participants": flatten_participants,
    "flatten_every_column": flatten_every_column,
    "flatten_aram": flatten_aram,
    "ban_lookup": ban_lookup,
    "opponent_lookup": opponent_lookup,
    "rune_lists": rune_lists,
    "game_day": day_of_play,
    "timeline_events": timeline_events,
    "skill_order": skill_order,
    "purchase_log_undo": purchase_log_undo,
    "timeline_slots": timeline_slots,
    "starting_items": starting_items,
    "completed_items": completed_items,
    "last_items": last_items,
    "merged_matches": merged_matches,
    "item_classes": item_classes,
    "item_catalogue": item_catalogue,
    "champion_dimension": champion_dimension,
    "upsert_users": upsert_users,
    "insert_if_absent": insert_if_absent,
    "keyed_update": keyed_update,
    "repeated_update": repeated_update,
    "repeated_upsert": repeated_upsert,
    "table_append": table_append,
    "table_refresh": table_refresh,
    "raw_day_round_trip": raw_day_round_trip,
    "json_table_round_trip": json_table_round_trip,
    "mark_done": mark_done,
    "mark_in_flight": mark_in_flight,
    "settle_update_numbers": settle_update_numbers,
    "reset_in_flight": reset_in_flight,
    "backlog": backlog,
    "done_count": done_count,
    "fetch_priority": fetch_priority,
    "json_values": json_values,
    "top_k": top_k,
    "mask_rows": mask_rows,
    "rank_first": rank_first,
    "rank_ties": rank_ties,
    "element_means": element_means,
    "record_reshape": record_reshape,
    "features_v1": _features(1),
    "features_v2": _features(2),
    "ols_fit": ols_fit,
    "predict_rank": _predict(1),
    "predict_rank_v2": _predict(2),
    "mean_pick_rate": mean_pick_rate,
    "stream_decode": stream_decode,
    "stream_state": stream_state,
    "keyed_files": keyed_files,
    "keyed_parts": keyed_parts,
    "landed_batches": landed_batches,
    "daily_facts_with_gaps": daily_facts_with_gaps,
    "document_sinks": document_sinks,
    "part_item_builds": part_item_builds,
    "masked_first": masked_first,
    "record_files": record_files,
    "json_run": json_run,
    "match_sketches": match_sketches,
}
