"""Invariants of the cascade on the driver data (sf0.001) and the oracle check."""

import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tierwise.plans.cascade import build
from tierwise.sources.binding import LINES, load_sources, stage_sources

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver data not present")


@pytest.fixture(scope="module")
def refresh(spark):
    return build(load_sources(spark, SF), E.AS_OF, "refresh")


def test_tier_counts_and_invariants(spark, refresh):
    calls, topics = refresh["calls"], refresh["topics"]
    assert calls.count() == 200
    assert calls.select("ACCOUNT", "CALL_DATE").distinct().count() == 200
    tiers = {r[0]: r[1] for r in topics.groupBy("TOPIC_SOURCE").count().collect()}
    assert tiers == {"Tier 1: Date Match (LM)": 106, "Tier 1: Date Match (DM)": 22,
                     "Tier 1.5: Text Inference": 14, "Tier 2: Call Type": 37,
                     "Tier 3: Prior Topic": 21}
    assert sum(tiers.values()) == topics.count()
    assert topics.filter(F.col("REPORT_TOPIC").isNull() | F.col("TOPIC_SOURCE").isNull()).count() == 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["ACCOUNT", "GUID", "CURRENTGUID", "CUSTOMERID", "CALL_DATE", "CALL_TYPE",
                          "RAW_TOPIC", "REPORT_TOPIC", "TOPIC_SOURCE", "PROGRAM_TYPE"]
    assert df.count() > 0


def test_every_key_has_an_oracle():
    # keys of the optional part are tested with it
    own = {k for k in E.queries() if k != "pipeline" and not re.match(r"op\d+_", k)}
    assert own == {k for k in E.oracle_sql() if k in own}


def test_staged_folders_of_equal_names_stay_apart(spark, tmp_path):
    for name in ("a", "b"):
        os.makedirs(tmp_path / name)
    os.symlink(SF, tmp_path / "a" / "sf")
    os.symlink("/root/testdata/sf0.01", tmp_path / "b" / "sf")
    key = E.queries()["goals_classified"]
    first = key(spark, str(tmp_path / "a" / "sf"))
    small = first.count()
    assert key(spark, str(tmp_path / "b" / "sf")).count() > small
    assert first.count() == small


def test_every_driver_row_reaches_its_table(spark):
    got = load_sources(spark, SF)
    size = {t: spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("customer", "orders", "lineitem")}
    for table, source in (("ELIGMEMBER", "customer"), ("COACHING_ENROLLMENT_MODEL", "customer"),
                          ("MEMBER_CALL_DATA", "orders"), ("COACH_NOTES_WORKFLOW", "lineitem"),
                          ("COACH_NOTES_WORKFLOW_DM", "lineitem"), ("AH_MEMBER_ACTION", "lineitem")):
        assert got[table].count() == size[source], table
    goals = got["AH_MEMBER_ACTION"].where("ActionType_ID in (2, 3)")
    assert goals.select("MemberAction_ID").distinct().count() == goals.count()


KEYS = ["coaching_topics", "goals_numbered", "out_tobacco_summary", "out_validation_counts",
        "dash_engagement_by_topic", "period_goal_distribution", "cmp_engagement", "kpi_headlines",
        "enrolled_members_by_period"]


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, key):
    from tools.compare import rows_of  # noqa: PLC0415
    con = duckdb.connect()
    for t in ("customer", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = E.queries()[key](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_tier_percentages_sum_to_100(spark):
    pct = [r["PCT"] for r in E.queries()["out_tier_breakdown"](spark, SF).collect()]
    assert abs(sum(pct) - 100.0) <= 0.005 * len(pct) + 1e-9


def test_staged_tables_hold_the_bound_rows_and_lines_are_joined_once(spark, tmp_path):
    staged, bound = stage_sources(spark, SF, str(tmp_path)), load_sources(spark, SF)
    assert set(staged) == set(bound)
    for name, df in bound.items():
        assert staged[name].dtypes == df.dtypes
        assert staged[name].exceptAll(df).count() == 0 == df.exceptAll(staged[name]).count()
    # one table for all that is made from lines
    assert LINES in os.listdir(tmp_path) and "AH_MEMBER_ACTION" not in os.listdir(tmp_path)


def test_joins_of_whole_tables_move_rows_at_every_size(spark):
    bound = load_sources(spark, SF)
    for name in ("MEMBER_CALL_DATA", "COACH_NOTES_WORKFLOW", "AH_MEMBER_ACTION"):
        plan = bound[name]._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
