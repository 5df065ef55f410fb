"""Bit masks against plain sets."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tierwise.operators import masks
from tierwise.plans import periods as P
from tierwise.plans import reports as RP

BASE = dt.date(1998, 1, 1)


def brute(topics, goals, slot):
    members, done, opened, seen = {}, {}, {}, set()
    for topic, member, day in topics:
        if not slot(day):
            continue
        seen.add(topic)
        if member is not None:
            members.setdefault(topic, set()).add(member)
    everyone = set().union(*members.values()) if members else set()
    with_goals = set()
    for topic, who in members.items():
        for member, status, ident in goals:
            if member in who:
                with_goals.add(topic)
                if ident is not None and status in ("Completed", "In Progress"):
                    (done if status == "Completed" else opened).setdefault(topic, set()).add(ident)
    size = lambda d, t: len(d.get(t, ()))
    return {t: (size(members, t), size(done, t), size(opened, t)) for t in seen}, len(everyone), with_goals


@pytest.mark.parametrize("n_topics", [9, 150])
def test_engagement_by_topic(spark, n_topics):
    rnd = random.Random(n_topics)
    who = [None, *(f"M{i}" for i in range(40))]
    topics = [(f"T{rnd.randrange(n_topics)}", rnd.choice(who), BASE + dt.timedelta(days=rnd.randrange(60)))
              for _ in range(600)] + [("only unknown", None, BASE)]
    goals = [(rnd.choice(who + ["stranger"]), rnd.choice(["Completed", "In Progress", "Withdrawn", None]),
              rnd.choice([None, *range(50)])) for _ in range(300)]
    t = spark.createDataFrame(topics, "REPORT_TOPIC string, CURRENTGUID string, CALL_DATE date")
    g = spark.createDataFrame(goals, "CURRENTGUID string, GOAL_STATUS string, MEMBERACTION_ID long")
    want, total, with_goals = brute(topics, goals, lambda d: True)
    got = {r["WELLBEING_TOPIC"]: r for r in RP.engagement_by_topic(t, g).collect()}
    assert {k: (r["MEMBERS"], r["COMPLETED_GOALS"], r["OPEN_IN_PROGRESS_GOALS"]) for k, r in got.items()} == want
    assert all(abs(r["PCT_OF_MEMBERS"] - 100 * r["MEMBERS"] / total) <= 0.05 for r in got.values())
    by_status = {r["WELLBEING_TOPIC"]: (r["COMPLETED"], r["IN_PROGRESS"])
                 for r in RP.goal_status_by_topic(t, g).collect()}
    assert by_status == {k: want[k][1:] for k in with_goals}

    bounds = {"early": (BASE, BASE + dt.timedelta(days=20)), "late": (BASE + dt.timedelta(days=15), BASE + dt.timedelta(days=70)),
              "never": (BASE - dt.timedelta(days=9), BASE - dt.timedelta(days=2))}
    columns = {n: (F.lit(a), F.lit(b)) for n, (a, b) in bounds.items()}
    days = t.withColumn("p", masks.period_mask(F.col("CALL_DATE"), columns))
    slots = {n: masks.has_bit(F.col("p"), i) for i, n in enumerate(bounds)}
    got = {(r["PERIOD"], r["WELLBEING_TOPIC"]): (r["MEMBERS"], r["COMPLETED_GOALS"], r["OPEN"])
           for r in RP.engagement_by_topic(days, g, slots, "PERIOD", "OPEN").collect()}
    assert got == {(n, k): v for n, (a, b) in bounds.items()
                   for k, v in brute(topics, goals, lambda d, a=a, b=b: a <= d <= b)[0].items()}


def test_goals_meet_one_row_a_member(spark):
    """A goal's row isn't multiplied by the topics or periods of its member."""
    topics = [(f"T{i % 12}", f"M{i % 5}", BASE) for i in range(300)]
    t = spark.createDataFrame(topics, "REPORT_TOPIC string, CURRENTGUID string, CALL_DATE date")
    rows = RP.topic_masks(t, masks.labels_of(t, "REPORT_TOPIC"))
    assert rows.count() == 5
    days = t.select("CURRENTGUID", "REPORT_TOPIC", F.lit("g").alias("GUID"), F.lit(31).alias("__periods"))
    members = P.member_days(days)
    assert members.count() == 5 and members.first()["l12m"] == 60


def test_overlap_and_bits(spark):
    bounds = {n: (F.lit(BASE + dt.timedelta(days=a)), F.lit(BASE + dt.timedelta(days=b)))
              for n, a, b in (("x", 0, 9), ("y", 5, 20))}
    spans = [(1, -3, 0), (2, 21, 40), (3, 9, 5), (4, 7, 30), (5, None, 3)]
    df = spark.createDataFrame([(i, None if a is None else BASE + dt.timedelta(days=a), BASE + dt.timedelta(days=b))
                                for i, a, b in spans], "i int, s date, e date")
    got = {r["i"]: r["m"] for r in df.select("i", masks.overlap_mask(F.col("s"), F.col("e"), bounds).alias("m")).collect()}
    assert got == {1: 1, 2: 0, 3: 3, 4: 3, 5: 0}
