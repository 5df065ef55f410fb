"""Plan-shape guards for the scale properties the design relies on."""

import contextlib
import io
import os
import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver data not present")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


KEYS = ["calls_one_per_day_adhoc", "lm_topics_dedup", "prior_topic_180d", "coaching_topics",
        "goals_numbered_active", "out_topics_summary", "out_tobacco_summary",
        "dash_engagement_by_topic", "period_engagement", "period_tobacco", "cmp_engagement",
        "enrolled_members_by_period"]


@pytest.fixture(scope="module")
def plans(spark):
    qs = E.queries()
    return {k: plan(qs[k](spark, SF)) for k in KEYS}


def test_no_cartesian_or_python(plans):
    for key, text in plans.items():
        assert "CartesianProduct" not in text, key
        assert not re.search(r"(BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas)",
                             text), key


def test_top1_is_partial_before_the_shuffle(plans):
    text = plans["calls_one_per_day_adhoc"]
    # formatted plans list operators bottom-up: the Partial limit comes before
    # the hash exchange on (ACCOUNT, CALL_DATE), the Final one after it.
    partial = re.search(r"^\(\d+\) WindowGroupLimit\n.*\n.*Partial", text, re.M)
    exchange = re.search(r"^\(\d+\) Exchange\n.*\n.*hashpartitioning\(ACCOUNT#\d+, CALL_DATE", text, re.M)
    final = re.search(r"^\(\d+\) WindowGroupLimit\n.*\n.*Final", text, re.M)
    assert partial and exchange and final
    assert partial.start() < exchange.start() < final.start()


def test_question_filters_reach_the_scan(plans):
    text = plans["lm_topics_dedup"]
    assert re.search(r"PushedFilters: \[.*In\(QUESTION_ID, \[502533,502758\]\)", text)
    assert re.search(r"ReadSchema: struct<ACCOUNT:string,QUESTION_ID:string,RESPONSE_DATE:timestamp_ntz,"
                     r"RESPONSE_TEXT:string>", text)


def test_lookback_is_a_running_window_not_a_band_join(plans):
    text = plans["prior_topic_180d"]
    assert "specifiedwindowframe(RowFrame, unboundedpreceding$(), -1)" in text
    assert "BroadcastNestedLoopJoin" not in text


def test_reports_do_not_rerun_the_cascade(plans):
    for key in ("dash_engagement_by_topic", "period_engagement", "cmp_engagement", "out_topics_summary"):
        assert "MEMBER_CALL_DATA" not in plans[key], key
