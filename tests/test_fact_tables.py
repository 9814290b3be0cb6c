"""Plans over stored facts: filters that reach the files, and no exchange of facts by match."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from matchlens.operators.cohorts import LADDER_COHORTS, STORED_COHORTS, current_version, match_totals
from matchlens.operators.document import champion_documents
from matchlens.operators.matchups import synergy
from matchlens.operators.picks import bans
from matchlens.sources.fact_tables import append_day, bucketed_facts, write_fact_table
from matchlens.sources.matches import DOCUMENT_COLUMNS
from workloads import views

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return [line for line in df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")).split("\n\n") if "Scan parquet" in line and "Filters: [" in line]


def exchanges(df):
    """Rows that each exchange is dealt by."""
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(df))


@pytest.fixture(scope="module")
def raw(spark):
    return views.facts(spark, FOLDER).select(*[c for c in DOCUMENT_COLUMNS])


@pytest.fixture(scope="module")
def facts(raw):
    return bucketed_facts(raw, DOCUMENT_COLUMNS)


def test_filters_of_documents_reach_the_files(facts):
    found = scans(champion_documents(facts, datetime.date(2001, 8, 2), 3000, STORED_COHORTS))
    assert len(found) >= 5
    by_version = [s for s in found if re.search(r"PartitionFilters: \[.*gameVersion#\d+ = .*Subquery", s)]
    by_tier = [s for s in found if re.search(r"PushedFilters: \[.*In\(tier, \[", s)]
    of_days = [s for s in found if "GreaterThanOrEqual(date" in s]
    assert len(by_version) >= 3 and len(of_days) >= 3
    assert all(s in by_tier for s in (*by_version, *of_days))


def test_only_the_version_is_read(spark, facts):
    current = current_version(facts)
    files = {row[0] for row in current.select(F.input_file_name()).distinct().collect()}
    assert files and {re.search("gameVersion=([^/]*)", f)[1] for f in files} == {r[0] for r in current.select("gameVersion").distinct().collect()}
    assert facts.select("gameVersion").distinct().count() > 1


@pytest.mark.parametrize("cohorts", [STORED_COHORTS, LADDER_COHORTS])
def test_no_exchange_of_facts_by_match(facts, cohorts):
    assert exchanges(match_totals(facts, cohorts)) == []
    assert [e for e in exchanges(bans(facts, cohorts)) if "matchId" in e] == []
    assert [e for e in exchanges(synergy(facts, cohorts)) if "matchId" in e] == []
    assert "Bucketed: true" in plan(match_totals(facts, cohorts))


def test_stored_facts_give_the_same_results(raw, facts):
    def rows(df):
        return sorted(map(str, df.collect()))

    assert rows(match_totals(raw, LADDER_COHORTS)) == rows(match_totals(facts, STORED_COHORTS))
    assert rows(bans(raw, LADDER_COHORTS)) == rows(bans(facts, STORED_COHORTS))
    assert rows(synergy(raw, LADDER_COHORTS, min_games=2)) == rows(synergy(facts, STORED_COHORTS, min_games=2))


def test_days_are_added_in_their_buckets(spark, raw, tmp_path):
    first, second = raw.where("date < '1998-01-01'"), raw.where("date >= '1998-01-01'")
    write_fact_table(first, "facts_by_day", str(tmp_path / "facts"), 4)
    append_day(second, "facts_by_day")
    whole = spark.table("facts_by_day")
    assert whole.count() == raw.count() and exchanges(match_totals(whole, STORED_COHORTS)) == []
    assert sorted(map(str, match_totals(whole, STORED_COHORTS).collect())) == sorted(map(str, match_totals(raw, LADDER_COHORTS).collect()))
    spark.sql("DROP TABLE facts_by_day")
