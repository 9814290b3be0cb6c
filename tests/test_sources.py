import datetime
import json

import pytest
from pyspark.sql import functions as F

from matchlens.operators.daily import daily_bans, daily_picks
from matchlens.plans import jobs
from matchlens.schema import FETCHED_MATCH, MATCH_STATE, RAW_MATCH, load_schema, save_schema
from matchlens.session import work_folder
from matchlens.sources import catalogues, documents, matches, warehouse
from tests.test_flatten import match, player, team

DAY = datetime.date(2024, 1, 10)


def raw_day(day, count=6):
    ms = (day - datetime.date(1970, 1, 1)).days * 86_400_000
    made = []
    for i in range(count):
        seats = [player(c, 100 if c < 5 else 200, p) for c, p in zip(range(10), ["TOP", "JUNGLE", "MIDDLE", "BOTTOM", "UTILITY"] * 2, strict=True)]
        document = match(f"{day}-{i}", seats, [team(100, {1: 7}), team(200, {6: -1})])
        document["metadata"] |= {"tier": "master", "gameStartTimestamp": ms, "gameDuration": 1000}
        made.append(document)
    return made


def test_schema_document(tmp_path):
    save_schema(RAW_MATCH, tmp_path / "raw.json")
    assert load_schema(tmp_path / "raw.json") == RAW_MATCH


def test_jobs_from_raw_to_documents(spark, tmp_path):
    raw, facts, out = (str(tmp_path / name) for name in ("raw", "facts", "out"))
    days = [DAY - datetime.timedelta(days=n) for n in (20, 14, 3, 1, 0)]
    for day in days:
        matches.write_raw(spark.createDataFrame(raw_day(day), RAW_MATCH), raw, "solo", day)
        jobs.flatten_day(spark, raw, facts, "solo", day)
    jobs.flatten_day(spark, raw, facts, "solo", days[2])

    recent = jobs.recent_facts(spark, facts, "solo", DAY)
    assert recent.count() == 3 * 60
    assert recent.select("date").distinct().count() == 3
    assert jobs.recent_facts(spark, facts, "solo", DAY, with_today=True).count() == 4 * 60

    jobs.statistics(spark, facts, out, "solo", DAY)
    found = spark.read.parquet(f"{out}/queue=solo")
    assert found.where("cohort = 'master'").count() == 10
    row = found.where("cohort = 'master' and championId = 0").collect()[0]
    assert (row.pick_cnt, row.position_cnt, row.tier) == (18, 2, "5")


def test_aram_job(spark, tmp_path):
    raw, facts, out = (str(tmp_path / name) for name in ("raw", "facts", "out"))
    day = DAY - datetime.timedelta(days=1)
    matches.write_raw(spark.createDataFrame(raw_day(day), RAW_MATCH), raw, "aram", day)
    jobs.flatten_day(spark, raw, facts, "aram", day)
    jobs.statistics(spark, facts, out, "aram", DAY)
    assert spark.read.parquet(f"{out}/queue=aram").count() == 10


def test_no_daily_dataset_gives_an_empty_typed_frame(spark, tmp_path):
    schema = jobs.fact_schema(spark, "solo")
    found = matches.read_recent(spark, str(tmp_path), "solo", DAY, schema)
    assert found.count() == 0 and set(schema.names) < set(found.columns)


def test_recent_days_prune_partitions(spark, tmp_path):
    schema = jobs.fact_schema(spark, "solo")
    empty = spark.createDataFrame([], schema)
    for n in (1, 30):
        matches.write_facts(empty, str(tmp_path), "solo", DAY - datetime.timedelta(days=n))
    found = matches.read_recent(spark, str(tmp_path), "solo", DAY, schema)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan


def test_landing_marks_matches_done(spark, tmp_path):
    fetched = [{"metadata": {"tier": "GOLD", "matchId": m}, "info": {"teams": []}} for m in ("1", "2")]
    state = spark.createDataFrame([("1", "GOLD", None), ("5", "GOLD", False)], MATCH_STATE)
    folders = str(tmp_path / "batch"), str(tmp_path / "state")
    matches.land_matches(spark.createDataFrame(fetched, FETCHED_MATCH), state, *folders)
    assert matches.read_landed(spark, folders[0]).count() == 2
    after = {r.matchid: r.status for r in spark.read.parquet(folders[1]).collect()}
    assert after == {"1": True, "5": False}


def test_catalogue_files(spark, tmp_path):
    items = {"data": {"1001": {"tags": ["Boots"], "description": "x", "gold": {"base": 300}}}, "type": "item"}
    (tmp_path / "items.json").write_text(json.dumps(items, indent=2), encoding="utf-8")
    champions = {"data": {"Ahri": {"key": "103", "id": "Ahri"}, "Zed": {"key": "238", "id": "Zed"}}}
    (tmp_path / "champions.json").write_text(json.dumps(champions, indent=2), encoding="utf-8")
    item = catalogues.read_items(spark, str(tmp_path / "items.json")).collect()[0]
    assert (item.itemId, item.gold.base, item["from"]) == ("1001", 300, None)
    rows = catalogues.read_champions(spark, str(tmp_path / "champions.json")).collect()
    assert sorted(map(tuple, rows)) == [(103, "Ahri"), (238, "Zed")]


def test_json_values_and_utf8_tables(spark, tmp_path):
    frame = spark.createDataFrame([("아리", 1)], "name string, n int")
    documents.write_table_json(frame, str(tmp_path / "table"))
    parts = (tmp_path / "table").glob("part-*")
    assert "아리" in "".join(part.read_text(encoding="utf-8") for part in parts)
    assert [r.name for r in matches.read_json_values(spark, str(tmp_path / "table")).collect()] == ["아리"]


@pytest.mark.parametrize("kind", list(warehouse.TABLES))
def test_warehouse_tables(spark, kind):
    warehouse.create_table(spark, kind, f"made_{kind}")
    assert "date" in spark.table(f"made_{kind}").columns
    spark.sql(f"DROP TABLE made_{kind}")


def test_one_table_from_creation_to_retention(spark):
    warehouse.create_table(spark, "pick", "life_t")
    facts = spark.sql(
        "SELECT 'GOLD' AS tier, explode(sequence(DATE '2024-01-01', DATE '2024-01-10')) AS date, 1 AS championId, "
        "1 AS win, 2 AS pick, 2 AS total, DATE '2024-01-11' AS execution_date"
    )
    assert warehouse.full_refresh(facts, "life_t")
    warehouse.append_facts(facts.select(*reversed(facts.columns)), "life_t")
    assert spark.table("life_t").count() == 20
    assert spark.table("life_t").select("pick", "championId").distinct().collect() == [(2, 1)]
    assert not warehouse.full_refresh(facts.where("pick = 9"), "life_t")
    assert spark.table("life_t").count() == 20
    assert warehouse.full_refresh(facts.where("date > '2024-01-03'"), "life_t")

    days = warehouse.read_dates(spark.table("life_t"), datetime.date(2024, 1, 5), datetime.date(2024, 1, 6))
    assert days.count() == 2
    assert "PartitionFilters: [isnotnull(date" in days._jdf.queryExecution().toString()
    dropped = warehouse.drop_expired(spark, "life_t", datetime.date(2024, 1, 12), 5)
    assert dropped == [datetime.date(2024, 1, d) for d in range(4, 8)]
    assert spark.table("life_t").count() == 3
    with pytest.raises(ValueError):
        warehouse.read_dates(spark.table("life_t"), None, None)
    spark.sql("DROP TABLE life_t")


def test_a_missing_table_is_made_partitioned(spark):
    facts = spark.sql("SELECT DATE '2024-01-01' AS date, 1 AS n")
    warehouse.append_facts(facts, "made_t")
    assert warehouse.drop_expired(spark, "made_t", datetime.date(2024, 3, 12)) == [datetime.date(2024, 1, 1)]
    spark.sql("DROP TABLE made_t")


def test_one_collection_per_cohort(spark, tmp_path):
    frame = spark.createDataFrame([("master", 1, 50.0), ("diamond", 1, None)], "cohort string, championId int, score double")
    documents.write_collections(frame, "db", "solo", ("master", "diamond"), {"path": str(tmp_path)}, form="json")
    assert spark.read.json(f"{tmp_path}/db/solo_master").select("championId", "score").collect() == [(1, 50.0)]
    assert spark.read.json(f"{tmp_path}/db/solo_diamond").count() == 1


def test_recent_view_uses_the_day_of_the_zone(spark):
    facts = spark.sql(
        "SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-10')) AS date, "
        "false AS p_gameEndedInEarlySurrender"
    )
    warehouse.create_recent_view(facts, datetime.datetime(2024, 1, 10, 14, 59), "view_t", days=2)
    assert spark.table("view_t").count() == 3
    warehouse.create_recent_view(facts, datetime.datetime(2024, 1, 10, 15, 0), "view_t", days=2)
    assert spark.table("view_t").count() == 2


def test_daily_tables(spark):
    rows = [("d", "t", 1, "TOP", True, -1)] * 3 + [("d", "t", 2, "TOP", False, None)] * 7
    facts = spark.createDataFrame(
        rows, "date string, tier string, p_championId int, p_teamPosition string, p_win boolean, ban int"
    )
    found = {r.p_championId: (r.pick, r.win, r.total) for r in daily_picks(facts).collect()}
    assert found == {1: (3, 3, 1.0), 2: (7, 0, 1.0)}
    assert {r.championId: r.bans for r in daily_bans(facts).collect()} == {-1: 3, None: 7}


def test_work_folder_is_the_sessions(spark):
    assert work_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_documents_by_cohort(spark, tmp_path):
    rows = [("master", 1, 50.0), ("master", 2, 60.0), ("diamond", 1, None)]
    frame = spark.createDataFrame(rows, "cohort string, championId int, score double")
    documents.write_documents(frame, str(tmp_path), "solo", "json")
    assert spark.read.json(f"{tmp_path}/queue=solo").where(F.col("cohort") == "master").count() == 2


def test_landing_job_from_fetched_to_raw(spark, tmp_path):
    from tests.test_timeline import ITEMS, buy, undo

    def fetched(name, seats):
        return {"metadata": {"matchId": name, "tier": "MASTER"}, "info": {"participants": [{"championId": i} for i in range(seats)], "teams": [], "queueId": 420}}

    names = {key: str(tmp_path / key) for key in ("fetched", "timelines", "items", "state", "raw", "out")}
    documents_ = [fetched("m1", 10), fetched("m2", 9), fetched("m3", 10), fetched("m4", 10)]
    spark.createDataFrame(documents_, FETCHED_MATCH).write.json(names["fetched"])
    logs = [{"matchId": m, "frames": [{"events": e}]} for m, e in (("m1", [buy(1055)]), ("m2", []), ("m3", [undo()]))]
    spark.createDataFrame(logs, jobs.TIMELINE).write.json(names["timelines"])
    spark.createDataFrame([{"data": ITEMS}], jobs.ITEM_MAP).write.json(names["items"])
    spark.createDataFrame([(m, "MASTER", None) for m in ("m1", "m2", "m3", "m4", "m5")], MATCH_STATE).write.parquet(names["state"])
    jobs.land(spark, names["fetched"], names["timelines"], names["items"], names["state"], names["raw"], names["out"], "solo", DAY)

    raw = matches.read_raw(spark, names["raw"], "solo", DAY).collect()
    assert [(r.metadata.matchId, r.participants[0].itemStart) for r in raw] == [("m1", ["1055"])]
    rejected = spark.read.parquet(f"{names['out']}/rejected/run_date={DAY}").collect()
    assert sorted(r.matchid for r in rejected) == ["m2", "m3", "m4"]
    state = spark.read.parquet(f"{names['out']}/state/run_date={DAY}").collect()
    assert {r.matchid: r.status for r in state} == {"m1": True, "m2": False, "m3": False, "m4": False, "m5": None}
