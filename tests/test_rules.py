"""Rule lists and column builders on literal values."""

import datetime as dt

from pyspark.sql import functions as F

from tierwise.functions.columns import pct, rank_by, signed_thousands
from tierwise.functions import rules as R
from tierwise.plans.cascade import goal_domain, note_topic, usable_text
from tierwise.plans.periods import periods


def one_col(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_note_keyword_order(spark):
    got = one_col(spark, ["quit eating junk food", "walking to lose weight", "quit smoking",
                          "go for a run daily", "likes to run", "feels great",
                          "inactive lately", "lower A1C", "call back later"], note_topic)
    assert got == ["Nutrition", "Weight Management", "Tobacco Cessation", "Exercise", None,
                   "Nutrition", "Exercise", "Chronic Disease State", None]


def test_usable_text(spark):
    got = one_col(spark, ["N/A", " - ", "ok", None, "na ", "none", "lower A1C", "N/A."],
                  usable_text)
    assert got == [False, False, False, None, False, False, True, False] or \
        got == [False, False, False, False, False, False, True, False]


def test_goal_domain_prefix_and_keywords(spark):
    names = ["Weight: lose 5: slowly", "NUTRITION: more greens", "Nutrition", "[Nutrition]: greens",
             "Eat less sugar", "Get cholesterol screening annually", "exericse: typo",
             "Take statin daily", "Lower your BMI", "Read a book", "Social Wellness: club"]
    assert one_col(spark, names, goal_domain) == [
        "Weight Management", "Other", "Nutrition", "Nutrition", "Nutrition", "Gaps in Care",
        "Exercise", "Condition Management", "Weight Management", "Other", "Social"]


def test_pct_exact_half_up(spark):
    df = spark.createDataFrame([(201, 20000), (1, 0), (1, 3), (2, 3), (5, 8)], "n long, d long")
    got = [r[0] for r in df.select(pct(F.col("n"), F.col("d"), 2)).collect()]
    assert got == [1.01, None, 33.33, 66.67, 62.5]
    got1 = [r[0] for r in df.select(pct(F.col("n"), F.col("d"), 1)).collect()]
    assert got1 == [1.0, None, 33.3, 66.7, 62.5]


def test_rank_and_signed_text(spark):
    df = spark.createDataFrame([("Exercise", 1234), ("Spiritual", -5), ("Zzz", 0)], "d string, n long")
    got = df.select(rank_by(F.col("d"), R.DOMAIN_ORDER), signed_thousands(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [(2, "+1,234"), (11, "-5"), (12, "0")]


def test_periods_month_end_clamp(spark):
    got = {r["PERIOD"]: (r["START_DATE"], r["END_DATE"])
           for r in periods(spark, "2024-03-31", "2024-04-30").collect()}
    assert got["prior_month"] == (dt.date(2024, 2, 29), dt.date(2024, 3, 30))
    assert got["l12m"] == (dt.date(2023, 4, 30), dt.date(2024, 4, 30))
    assert got["r90"] == (dt.date(2024, 2, 1), dt.date(2024, 4, 30))
    assert got["p90"] == (dt.date(2023, 11, 3), dt.date(2024, 1, 31))
