"""Hazard cases of the cascade on literal source rows (FIXTURES.md §4)."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import D, action, call, note, rows, sources
from tierwise.functions import rules as R
from tierwise.plans.cascade import build
from tierwise.plans import periods as P
from tierwise.plans import reports as RP

AS_OF = D(1998, 7, 15)
DAY = D(1998, 6, 10)
LM_Q, DM_Q = R.LM_TOPIC_QUESTIONS[0], R.DM_TOPIC_QUESTION


def topics(spark, variant="adhoc", **tables):
    return build(sources(spark, **tables), AS_OF, variant)["topics"]


def test_unmapped_lm_answer_falls_through_but_keeps_tier1(spark):
    t = topics(spark,
               calls=[call("A1", DAY, "Lifestyle"), call("A2", DAY, "Tobacco")],
               notes=[note("A1", DAY, LM_Q, "Unmapped answer"), note("A2", DAY, LM_Q, "Unmapped answer")])
    assert rows(t, "ACCOUNT", "REPORT_TOPIC", "TOPIC_SOURCE", "PROGRAM_TYPE") == [
        ("A1", "General", R.TIER_LM, "LM"), ("A2", "Tobacco Cessation", R.TIER_LM, "LM")]


def test_unmapped_lm_answer_ignores_dm_same_day(spark):
    t = topics(spark, calls=[call("A1", DAY)],
               notes=[note("A1", DAY, LM_Q, "Unmapped answer")],
               dm=[note("A1", DAY, DM_Q, "Diabetes")])
    assert rows(t, "REPORT_TOPIC", "TOPIC_SOURCE", "PROGRAM_TYPE", "RAW_TOPIC") == [
        ("General", R.TIER_LM, "LM", "Unmapped answer")]


def test_dm_answer_alone(spark):
    t = topics(spark, calls=[call("A1", DAY)], dm=[note("A1", DAY, DM_Q, "Asthma")])
    assert rows(t, "REPORT_TOPIC", "TOPIC_SOURCE", "PROGRAM_TYPE") == [
        ("Chronic Disease State", R.TIER_DM, "DM")]


def test_lookback_edges(spark):
    calls = [call("A1", DAY), call("A2", DAY), call("A3", DAY)]
    notes = [note("A1", DAY - dt.timedelta(days=180), LM_Q, "Weight"),
             note("A2", DAY - dt.timedelta(days=181), LM_Q, "Weight"),
             note("A3", DAY, LM_Q + "x", "Weight")]  # same day, other question: not a prior
    t = topics(spark, calls=calls, notes=notes)
    assert rows(t, "ACCOUNT", "REPORT_TOPIC", "TOPIC_SOURCE") == [
        ("A1", "Weight Management", R.TIER_PRIOR), ("A2", "General", R.TIER_NONE),
        ("A3", "General", R.TIER_NONE)]


def test_latest_prior_wins_and_null_text_counts(spark):
    calls = [call("A1", DAY), call("A2", DAY)]
    notes = [note("A1", DAY - dt.timedelta(days=30), LM_Q, "Weight"),
             note("A1", DAY - dt.timedelta(days=3), LM_Q, "Stress"),
             note("A2", DAY - dt.timedelta(days=30), LM_Q, "Weight"),
             note("A2", DAY - dt.timedelta(days=3), LM_Q, None)]
    out = build(sources(spark, calls=calls, notes=notes), AS_OF, "adhoc")
    assert rows(out["prior"], "ACCOUNT", "PRIOR_RESPONSE_TEXT") == [("A1", "Stress"), ("A2", None)]
    assert rows(out["topics"], "ACCOUNT", "REPORT_TOPIC", "TOPIC_SOURCE") == [
        ("A1", "Stress Management", R.TIER_PRIOR), ("A2", "General", R.TIER_NONE)]


def test_enrollment_edges(spark):
    enr = [("A1", "M1", "G1", "CUST_A", "X", "ENROLLED", "enrolled", D(1998, 6, 1), D(1998, 6, 30))]
    calls = [call("A1", D(1998, 6, 1)), call("A1", D(1998, 6, 30)), call("A1", D(1998, 7, 1))]
    out = build(sources(spark, calls=calls, enrollment=enr), AS_OF, "adhoc")
    assert rows(out["calls"], "CALL_DATE") == [(D(1998, 6, 1),), (D(1998, 6, 30),)]


def test_latest_call_of_day_and_filters(spark):
    calls = [call("A1", DAY, "Lifestyle", hour=9), call("A1", DAY, "Tobacco ", hour=15),
             call("A2", DAY, "Engagement"), call("A3", DAY, "Survey - Follow Up")]
    out = build(sources(spark, calls=calls), AS_OF, "adhoc")
    assert rows(out["calls"], "ACCOUNT", "CALL_TYPE") == [("A1", "Tobacco")]


def test_frequency_tiebreak_alphabetical(spark):
    other = DAY - dt.timedelta(days=40)
    notes = [note("A1", DAY, LM_Q, "Weight"), note("A1", DAY, LM_Q, "Exercise"),
             note("A2", DAY, LM_Q, "Weight"), note("A2", DAY, LM_Q, "Exercise"),
             note("A2", other, LM_Q, "Weight")]
    out = build(sources(spark, calls=[call("A1", DAY), call("A2", DAY)], notes=notes), AS_OF, "adhoc")
    assert rows(out["lm"].filter(F.col("TOPIC_DATE") == DAY), "ACCOUNT", "RESPONSE_TEXT") == [
        ("A1", "Exercise"), ("A2", "Weight")]


def test_text_priority(spark):
    notes = [note("A1", DAY, R.DETAIL_QUESTION, "call back later"),
             note("A1", DAY, R.LONG_TERM_GOAL_QUESTION, "quit smoking"),
             note("A2", DAY, R.DETAIL_QUESTION, "sleep 8 hours"),
             note("A2", DAY, R.LONG_TERM_GOAL_QUESTION, "lower A1C")]
    dm = [note("A3", DAY, R.DM_GOAL_QUESTION, "N/A"), note("A3", DAY, R.DM_GOAL_QUESTION, "keep walking")]
    t = topics(spark, calls=[call("A1", DAY), call("A2", DAY), call("A3", DAY)], notes=notes, dm=dm)
    assert rows(t, "ACCOUNT", "REPORT_TOPIC", "TOPIC_SOURCE") == [
        ("A1", "Tobacco Cessation", R.TIER_TEXT), ("A2", "Sleep Management", R.TIER_TEXT),
        ("A3", "Chronic Disease State", R.TIER_TEXT)]


def test_call_type_beats_text_tier(spark):
    t = topics(spark, calls=[call("A1", DAY, "Clinical ")],
               notes=[note("A1", DAY, R.DETAIL_QUESTION, "sleep 8 hours")])
    assert rows(t, "REPORT_TOPIC", "TOPIC_SOURCE") == [("Chronic Disease State", R.TIER_CALL_TYPE)]


def test_bridge_fan_out(spark):
    elig = [("G1", "M1", "ORG", "CUST_A"), ("G1", "M9", "ORG", "CUST_A")]
    t = topics(spark, "refresh", calls=[call("A1", DAY)], elig=elig)
    assert rows(t, "ACCOUNT", "CURRENTGUID") == [("A1", "M1"), ("A1", "M9")]


def test_fep_members_excluded_in_refresh_only(spark):
    elig = [("G1", "M1", "xFep01", "CUST_A"), ("G2", "M2", "ORG", "CUST_A")]
    src = sources(spark, calls=[call("A1", DAY), call("A2", DAY)], elig=elig)
    assert rows(build(src, AS_OF, "refresh")["calls"], "ACCOUNT") == [("A2",)]
    assert rows(build(src, AS_OF, "adhoc")["calls"], "ACCOUNT") == [("A1",), ("A2",)]


def test_goal_numbering_and_description(spark):
    acts = [action("A1", 3, "Weight: lose 5: slowly", day=D(1998, 3, 2)),
            action("A1", 1, "Tobacco: quit", day=D(1998, 3, 1)),
            action("A1", 2, "Exercise", day=D(1998, 3, 1)),
            action("A1", 4, "Survey: intake"), action("A1", 5, "RED/ y"), action("A1", 6, None),
            action("A1", 7, "Sleep: 8h", status=1)]
    g = build(sources(spark, actions=acts), AS_OF, "refresh")["goals_numbered"]
    assert rows(g, "MEMBERACTION_ID", "GOAL_NUMBER", "GOAL_DOMAIN", "GOAL_DESCRIPTION", "GUID") == [
        (1, 2, "Tobacco Cessation", "quit", "G1"), (2, 1, "Exercise", "Exercise", "G1"),
        (3, 3, "Weight Management", "lose 5: slowly", "G1")]


def test_goals_joined_to_calls_count_per_call(spark):
    calls = [call("A1", D(1998, 6, d)) for d in (2, 9, 16)]
    acts = [action("A1", 1, "Exercise: walk"), action("A1", 2, "Tobacco: quit")]
    src = sources(spark, calls=calls, actions=acts)
    out = build(src, AS_OF, "refresh")
    days = P.period_days(out["topics"], "cust_a", D(1998, 6, 1), D(1998, 6, 30))
    counts = P.goal_counts(P.member_days(days), out["goals_numbered"])
    dist = P.goal_distribution(counts).filter(F.col("PERIOD") == "month")
    assert rows(dist, "GOAL_STATUS", "COUNT") == [("Completed", 6)]
    once = P.goal_distribution(counts, mode="goals").filter(F.col("PERIOD") == "month")
    assert rows(once, "GOAL_STATUS", "COUNT") == [("Completed", 2)]
    dash = RP.goal_status_distribution(out["goals_numbered"])
    assert rows(dash, "GOAL_STATUS", "COUNT") == [("Completed", 2)]


def test_tobacco_summary_null_guid(spark):
    t = spark.createDataFrame(
        [("A1", "G1", "C", DAY, "Tobacco", None, "x", "s", None),
         ("A2", None, "C", DAY, "Lifestyle", None, "x", "s", None),
         ("A3", "G3", "C", DAY, "Lifestyle", None, "x", "s", None)],
        "ACCOUNT string, GUID string, CUSTOMERID string, CALL_DATE date, CALL_TYPE string, "
        "RAW_TOPIC string, REPORT_TOPIC string, TOPIC_SOURCE string, PROGRAM_TYPE string")
    tob = spark.createDataFrame([("A1", "G1", "Yes"), ("A9", None, "Yes")],
                                "ACCOUNT string, GUID string, TOBACCO_DISCUSSED string")
    got = {r["TOBACCO_DISCUSSED"]: (r["MEMBERS"], r["CALLS"])
           for r in RP.tobacco_summary(t, tob).collect()}
    assert got == {"Yes": (1, 1), "No": (1, 1), "Grand Total": (2, 3)}


def test_period_reports_for_customer_without_calls(spark):
    from tierwise.plans import monthly as M
    src = sources(spark, calls=[call("A1", DAY)], actions=[action("A1", 1, "Tobacco: quit")])
    out = build(src, AS_OF, "refresh")
    rep = M.period_report(spark, src, out, "NOBODY", AS_OF, D(1998, 6, 1), D(1998, 6, 30))
    tob = rows(rep["period_tobacco"], "PERIOD", "METRIC", "VALUE")
    assert len(tob) == 25
    assert {v for _, m, v in tob if m != "Completion Rate"} == {"0"}
    assert {v for _, m, v in tob if m == "Completion Rate"} == {None}
    assert rep["period_engagement"].count() == 0
    assert rows(rep["kpi_headlines"], "KPI", "MONTH", "L12M") == [
        ("Distinct Members Coached", 0, 0), ("Goals Completed", 0, 0), ("Members Coached", 0, 0),
        ("Tobacco Participants", 0, 0)]
    assert rows(rep["tobacco_goal_gap"], "PARTICIPANTS", "GAP", "GAP_PCT") == [(0, 0, 0.0)]
    assert rows(rep["enrolled_members_by_period"], "PERIOD", "ENROLLED_MEMBERS") == [
        (p, 0) for p in sorted(["month", "prior_month", "l12m", "r90", "p90"])]
    assert rows(rep["cmp_tobacco"], "METRIC", "MONTH", "MOM_CHANGE")[0] == (
        "Active Tobacco Participants", "0", "0")


def test_period_tobacco_classic_null_flag_member(spark):
    t = spark.createDataFrame(
        [("A1", "G1", "M1", "CUST_A", DAY, "Tobacco", None, "x", "s", None, "l12m"),
         ("A2", "G2", "M2", "CUST_A", DAY, "Lifestyle", None, "x", "s", None, "l12m"),
         ("A3", "G3", None, "CUST_A", DAY, "Lifestyle", None, "x", "s", None, "l12m")],
        "ACCOUNT string, GUID string, CURRENTGUID string, CUSTOMERID string, CALL_DATE date, "
        "CALL_TYPE string, RAW_TOPIC string, REPORT_TOPIC string, TOPIC_SOURCE string, "
        "PROGRAM_TYPE string, PERIOD string")
    tob = spark.createDataFrame([("A1", "G1", "M1", "Yes"), ("A9", "G9", None, "Yes")],
                                "ACCOUNT string, GUID string, CURRENTGUID string, TOBACCO_DISCUSSED string")
    got = {r["TOBACCO_DISCUSSED"]: (r["MEMBERS"], r["CALLS"]) for r in P.tobacco_classic(t, tob).collect()}
    assert got == {"Yes": (1, 1), "No": (1, 1)}
