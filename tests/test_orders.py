"""Display order of every report, as a row sequence, also through files."""

import os

import pytest

import __spark_entry__ as E
from tierwise.functions import rules as R
from tierwise.plans import monthly as M
from tierwise.plans import periods as P
from tierwise.sources import snapshots as S
from tierwise.sources.binding import LINES, load_sources, stage_sources

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver data not present")

FALLING = {"out_topics_summary": "CALLS", "out_tier_breakdown": "CALLS", "dash_engagement_by_topic": "MEMBERS",
           "dash_goal_status_by_topic": "COMPLETED", "period_topics_classic": "CALLS", "cmp_engagement": "MONTH"}
RANKED = {"out_tobacco_summary": ("TOBACCO_DISCUSSED", ["Yes", "No", "Total"]),
          "out_validation_counts": ("SECTION", M.VALIDATION_ORDER),
          "dash_goal_status_distribution": ("GOAL_STATUS", R.STATUS_ORDER),
          "cmp_goal_status": ("GOAL_STATUS", R.STATUS_ORDER),
          "dash_tobacco_focus": ("METRIC", R.TOBACCO_METRICS), "cmp_tobacco": ("METRIC", R.TOBACCO_METRICS),
          "period_tobacco_classic": ("TOBACCO_DISCUSSED", ["Yes", "No", "Total"]),
          "kpi_headlines": ("KPI", P.KPI_LABELS), "enrolled_members_by_period": ("PERIOD", P.PERIOD_NAMES)}
RISING = {"out_goal_number_status": "GOAL_NUMBER", "out_goal_type_status": "GOAL_TYPE"}
BY_PERIOD = ["period_tobacco", "period_engagement", "period_goal_distribution",
             "period_goal_distribution_goals", "period_goal_progression"]
BY_DOMAIN = ["out_goal_type_domain", "out_goal_domain_status", "dash_goal_progression",
             "period_goal_domain_status", "cmp_goal_progression", "period_goal_progression"]


def column(spark, key, name):
    return [r[name] for r in E.queries()[key](spark, SF).collect()]


@pytest.mark.parametrize("key", FALLING)
def test_sorted_by_measure(spark, key):
    values = column(spark, key, FALLING[key])
    assert values == sorted(values, reverse=True) and values


@pytest.mark.parametrize("key", RISING)
def test_sorted_by_key(spark, key):
    values = column(spark, key, RISING[key])
    assert values == sorted(values) and values


@pytest.mark.parametrize("key", RANKED)
def test_sorted_by_rank(spark, key):
    name, ranks = RANKED[key]
    values = column(spark, key, name)
    places = [ranks.index(v) for v in values if v in ranks]
    assert places == sorted(places) and places


@pytest.mark.parametrize("key", BY_PERIOD)
def test_periods_come_in_their_order(spark, key):
    places = [P.PERIOD_NAMES.index(v) for v in column(spark, key, "PERIOD")]
    assert places == sorted(places) and places


@pytest.mark.parametrize("key", BY_DOMAIN)
def test_domains_come_by_rank_then_name(spark, key):
    ranks = R.DOMAIN_ORDER_SHORT if key == "period_goal_domain_status" else R.DOMAIN_ORDER
    rows = E.queries()[key](spark, SF).collect()
    places = [((P.PERIOD_NAMES.index(r["PERIOD"]) if "PERIOD" in r.asDict() else 0),
               ranks.index(r["GOAL_DOMAIN"]) if r["GOAL_DOMAIN"] in ranks else len(ranks),
               r["GOAL_DOMAIN"]) for r in rows]
    assert places == sorted(places) and places


def test_every_ordered_report_is_covered():
    assert set(M.ORDERS) == {*FALLING, *RANKED, *RISING, *BY_PERIOD, *BY_DOMAIN}


def test_files_keep_the_order(spark, tmp_path):
    df = E.queries()["out_tobacco_summary"](spark, SF)
    S.write_report({"t": df}, str(tmp_path))
    back = spark.read.parquet(f"{tmp_path}/t").collect()
    assert [r[0] for r in back] == [r[0] for r in df.collect()]


def test_workbook_sections_build_only_what_they_read(spark, monkeypatch):
    built = []
    monkeypatch.setattr(E, "_MEMO", {})
    run = M.run_adhoc
    monkeypatch.setattr(M, "run_adhoc", lambda *a, tables, **k: built.append(tables) or run(*a, tables=tables, **k))
    monkeypatch.setattr(E, "stage_sources", lambda *a: pytest.fail("goals need no staged sources"))
    E.queries()["out_goal_domain_status"](spark, "/root/testdata/sf0.001")
    E.queries()["out_goal_number_status"](spark, "/root/testdata/sf0.001")
    assert built == [("goals_numbered",)]


def test_staging_writes_the_named_tables_only(spark, tmp_path):
    wanted = {"MEMBER_CALL_DATA", "COACH_NOTES_WORKFLOW"}
    got = stage_sources(spark, "/root/testdata/sf0.001", str(tmp_path), wanted)
    assert set(got) == wanted and {p.name for p in tmp_path.iterdir()} == {"MEMBER_CALL_DATA", LINES}
    bound = load_sources(spark, "/root/testdata/sf0.001")
    for name, df in got.items():
        assert df.exceptAll(bound[name]).count() == 0 == bound[name].exceptAll(df).count()
    assert "MemberAction_ID" not in spark.read.parquet(f"{tmp_path}/{LINES}").columns
