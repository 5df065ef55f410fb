"""Generic operators against brute-force forms on random data."""

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from tierwise.operators.grouping import frequency_tiebreak, latest_per_group, number_in_group
from tierwise.operators.joins import asof_within, not_in, within_interval

BASE = dt.date(1998, 1, 1)


def random_answers(n, seed=7, accounts=4, days=400, texts=("a", "b", "c", None)):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        day = BASE + dt.timedelta(days=rnd.randrange(days))
        ts = dt.datetime.combine(day, dt.time(rnd.randrange(24), rnd.randrange(60)))
        out.append((f"A{rnd.randrange(accounts)}", day, ts, rnd.choice(texts)))
    return out


def test_asof_within_matches_band_join(spark):
    answers = random_answers(600)
    calls = [(f"A{a}", BASE + dt.timedelta(days=d)) for a in range(4) for d in range(0, 420, 7)]
    right = spark.createDataFrame(answers, "ACCOUNT string, DAY date, TS timestamp_ntz, TEXT string")
    left = spark.createDataFrame(calls, "ACCOUNT string, CALL_DATE date")
    got = {(r[0], r[1]): r[2] for r in asof_within(left, right, "ACCOUNT", "CALL_DATE", "DAY", "TS",
                                                   "TEXT", 180, "PRIOR").collect()}
    want = {}
    for acct, cday in calls:
        cands = [(ts, t) for a, d, ts, t in answers
                 if a == acct and cday - dt.timedelta(days=180) <= d < cday]
        if cands:
            best_ts = max(ts for ts, _ in cands)
            texts = sorted((t for ts, t in cands if ts == best_ts), key=lambda t: (t is None, t))
            want[(acct, cday)] = texts[0]
    assert got == want


def test_frequency_tiebreak_matches_pandas(spark):
    answers = [r for r in random_answers(500, seed=3) if r[3] is not None]
    df = spark.createDataFrame(answers, "ACCOUNT string, DAY date, TS timestamp_ntz, TEXT string")
    got = {(r[0], r[1]): r[2] for r in frequency_tiebreak(df, "ACCOUNT", "DAY", "TEXT").collect()}
    p = pd.DataFrame(answers, columns=["ACCOUNT", "DAY", "TS", "TEXT"])
    p["FREQ"] = p.groupby(["ACCOUNT", "TEXT"])["TEXT"].transform("size")
    p = p.sort_values(["ACCOUNT", "DAY", "FREQ", "TEXT"], ascending=[True, True, False, True])
    want = {(a, d): t for (a, d), t in p.groupby(["ACCOUNT", "DAY"])["TEXT"].first().items()}
    assert got == want


def test_latest_and_numbering(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 3, "b"), ("b", 2, "z")],
                               "k string, v int, s string")
    top = latest_per_group(df, ["k"], [F.desc("v"), F.asc("s")])
    assert sorted(tuple(r) for r in top.collect()) == [("a", 3, "b"), ("b", 2, "z")]
    num = number_in_group(df, ["k"], [F.asc("v"), F.asc("s")], "N")
    assert sorted(tuple(r) for r in num.collect()) == [
        ("a", 1, "x", 1), ("a", 3, "b", 2), ("a", 3, "y", 3), ("b", 2, "z", 1)]


def test_not_in_null_rules(spark):
    left = spark.createDataFrame([("x",), ("y",), (None,)], "k string")
    with_null = spark.createDataFrame([("x",), (None,)], "m string")
    no_null = spark.createDataFrame([("x",)], "m string")
    assert [r[0] for r in not_in(left, "k", no_null, "m", False).collect()] == ["y"]
    assert not_in(left, "k", with_null, "m", False).count() == 0
    assert [r[0] for r in not_in(left, "k", with_null, "m", True).collect()] == ["y"]


def test_within_interval_semi(spark):
    left = spark.createDataFrame([("a", BASE), ("a", BASE + dt.timedelta(days=5)), ("b", BASE)],
                                 "ACCOUNT string, D date")
    right = spark.createDataFrame([("a", BASE, BASE + dt.timedelta(days=1)),
                                   ("a", BASE - dt.timedelta(days=3), BASE)],
                                  "ACCOUNT string, S date, E date")
    got = within_interval(left, right, "ACCOUNT", "D", "S", "E").collect()
    assert [tuple(r) for r in got] == [("a", BASE)]


def test_overlapping_intervals_are_merged(spark):
    from tierwise.operators.joins import merge_intervals
    rnd = random.Random(9)
    spans = []
    for _ in range(400):
        a = BASE + dt.timedelta(days=rnd.randrange(500))
        b = a + dt.timedelta(days=rnd.randrange(-3, 12))
        spans.append((rnd.choice(["hot", "hot", "A1", "A2", None]), a if rnd.random() > .03 else None,
                      b if rnd.random() > .03 else None))
    days = [(e, BASE + dt.timedelta(days=d), f"{e}{d}") for e in ("hot", "A1", "A2", "A3") for d in range(-2, 515, 3)]
    days += [days[5], ("hot", None, "null day"), (None, BASE, "null entity")]
    right = spark.createDataFrame(spans, "ACCOUNT string, S date, E date")
    left = spark.createDataFrame(days, "ACCOUNT string, D date, X string")
    got = sorted(r["X"] for r in within_interval(left, right, "ACCOUNT", "D", "S", "E").collect())
    want = sorted(x for e, d, x in days if e is not None and d is not None
                  and any(e == f and a and b and a <= d <= b for f, a, b in spans))
    assert got == want
    merged = [tuple(r) for r in merge_intervals(right, "ACCOUNT", "S", "E").collect()]
    covered = {(e, a + dt.timedelta(days=k)) for e, a, b in spans if e and a and b for k in range((b - a).days + 1)}
    assert {(e, a + dt.timedelta(days=k)) for e, a, b in merged for k in range((b - a).days + 1)} == covered
    for e in ("hot", "A1", "A2"):
        own = sorted((a, b) for f, a, b in merged if f == e)
        assert all(y[0] > x[1] + dt.timedelta(days=1) for x, y in zip(own, own[1:]))


def test_lookback_windows_hold_a_month_at_most(spark):
    """A hot account's answers spread over its months; answers reach over empty months."""
    answers = random_answers(900, seed=2, accounts=1, days=900) + [
        ("A1", BASE, dt.datetime.combine(BASE, dt.time(9)), "x")]
    right = spark.createDataFrame(answers, "ACCOUNT string, DAY date, TS timestamp_ntz, TEXT string")
    left = spark.createDataFrame([("A1", BASE + dt.timedelta(days=d)) for d in (0, 1, 179, 180, 181, 400)]
                                 + [("A0", BASE), ("A0", None), (None, BASE)], "ACCOUNT string, CALL_DATE date")
    df = asof_within(left, right, "ACCOUNT", "CALL_DATE", "DAY", "TS", "TEXT", 180, "PRIOR")
    assert sorted((r[1] - BASE).days for r in df.collect() if r[0] == "A1") == [1, 179, 180]
    import contextlib
    import io
    import re
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    windows = re.findall(r"^\(\d+\) Window\b.*?Arguments: \[(\w+)\(.*?\], \[(.*?)\], ", out.getvalue(), re.S | re.M)
    keys = {(f, re.sub(r"#\d+", "", by)) for f, by in windows}
    # only the look at the next month with answers sees an account alone: a row a month
    assert keys == {("row_number", "__e, __m"), ("lead", "__e"), ("last", "__e, __m")}


def test_bucketed_numbering_matches_window(spark):
    rnd = random.Random(11)
    data = [("hot" if rnd.random() < 0.6 else f"k{rnd.randrange(20)}",
             None if rnd.random() < 0.1 else rnd.randrange(50), i) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, d int, id long")
    order = [F.asc_nulls_last("d"), F.asc("id")]
    bucket = F.coalesce(F.col("d") - F.col("d") % 7, F.lit(999))
    plain = {r["id"]: r["N"] for r in number_in_group(df, ["k"], order, "N").collect()}
    cut = number_in_group(df, ["k"], order, "N", bucket=bucket)
    assert {r["id"]: r["N"] for r in cut.collect()} == plain and len(plain) == 3000
    groups = spark.createDataFrame([("hot", "x"), ("k3", "y"), ("none", "z")], "k string, g string")
    kept = number_in_group(df, ["k"], order, "N", bucket=bucket, groups=groups).collect()
    assert {r["id"]: (r["N"], r["g"]) for r in kept} == {
        i: (plain[i], {"hot": "x", "k3": "y"}[k]) for k, _, i in data if k in ("hot", "k3")}


def test_one_crowded_bucket_spreads_over_slices(spark):
    from tierwise.operators.grouping import order_slices
    rnd = random.Random(5)
    # one account with all its goals on one day, null names and repeated rows among them
    data = [("hot", BASE, rnd.choice([None, "n%d" % rnd.randrange(400)]), i if i % 50 else 7, i)
            for i in range(4000)]
    data += [(f"k{i % 9}", None if i % 4 == 0 else BASE, "x", i, 5000 + i) for i in range(200)]
    df = spark.createDataFrame(data, "k string, d date, name string, id long, row long").repartition(5)
    order = ["d", "name", "id"]
    columns = [F.asc_nulls_last(c) for c in order]
    bucket = F.coalesce(F.date_format("d", "yyyyMM"), F.lit("999999"))
    sliced = order_slices(df.withColumn("b", bucket), ["k", "b"], order, "s", rows=256)
    sizes = {(r["k"], r["s"]): r["count"] for r in sliced.groupBy("k", "s").count().collect()}
    hot = [n for (k, _), n in sizes.items() if k == "hot"]
    assert len(hot) >= 8 and max(hot) < 3 * 256 and sum(hot) == 4000
    assert {s for k, s in sizes if k != "hot"} == {0}
    rising = sliced.where("k = 'hot'").orderBy(*columns).select("s").collect()
    assert [r[0] for r in rising] == sorted(r[0] for r in rising)

    def numbers(frame):
        return sorted((r["k"], r["N"], str(r["d"]), str(r["name"]), r["id"]) for r in frame.collect())

    plain = numbers(number_in_group(df, ["k"], columns, "N"))
    cut = number_in_group(df, ["k"], columns, "N", bucket=bucket, slice_by=order, slice_rows=256)
    assert numbers(cut) == plain and set(cut.columns) == {*df.columns, "N"}


def test_sketch_bounds_the_cuts(spark):
    from tierwise.operators.grouping import order_slices
    df = spark.range(20000).select(F.lit("a").alias("k"), F.col("id").alias("v"))
    got = order_slices(df, ["k"], ["v"], "s", rows=16, sketch=64).groupBy("s").count().collect()
    assert len(got) == 64 // 16 + 1 and max(r["count"] for r in got) < 12000


def test_text_of_a_change_takes_its_sign_from_the_raw_difference(spark):
    from tierwise.functions.columns import signed_thousands, thirds
    rows = spark.createDataFrame([(1,), (0,), (-1,), (2,), (-2,), (4500,)], "raw long")
    got = {r[0]: r[1] for r in rows.select("raw", signed_thousands(thirds(F.col("raw")), F.col("raw"))).collect()}
    assert got == {1: "+0", 0: "0", -1: "0", 2: "+1", -2: "-1", 4500: "+1,500"}


def test_period_joins(spark):
    from tierwise.operators.joins import in_periods, overlap_periods
    periods = spark.createDataFrame([("p1", BASE, BASE + dt.timedelta(days=9)),
                                     ("p2", BASE + dt.timedelta(days=5), BASE + dt.timedelta(days=20))],
                                    "PERIOD string, START_DATE date, END_DATE date")
    days = spark.createDataFrame([(1, BASE + dt.timedelta(days=7)), (2, BASE + dt.timedelta(days=15)),
                                  (3, BASE + dt.timedelta(days=30))], "id int, D date")
    got = sorted((r["id"], r["PERIOD"]) for r in in_periods(days, "D", periods).collect())
    assert got == [(1, "p1"), (1, "p2"), (2, "p2")]
    spans = spark.createDataFrame([(1, BASE - dt.timedelta(days=3), BASE),
                                   (2, BASE + dt.timedelta(days=21), BASE + dt.timedelta(days=40))],
                                  "id int, S date, E date")
    got = sorted((r["id"], r["PERIOD"]) for r in overlap_periods(spans, "S", "E", periods).collect())
    assert got == [(1, "p1")]


def test_joined_count_modes(spark):
    from tierwise.operators.joins import joined_count
    facts = spark.createDataFrame([("m1", "C"), ("m1", "C"), ("m1", "W"), ("m2", "C"), (None, "C")],
                                  "M string, S string")
    events = spark.createDataFrame([("p", "m1"), ("p", "m1"), ("p", "m1"), ("q", "m2"), ("p", None)],
                                   "P string, M string")
    joined = {(r["P"], r["S"]): r["N"] for r in
              joined_count(facts, events, "M", ["S"], ["P"], "joined", "N").collect()}
    once = {(r["P"], r["S"]): r["N"] for r in
            joined_count(facts, events, "M", ["S"], ["P"], "goals", "N").collect()}
    assert joined == {("p", "C"): 6, ("p", "W"): 3, ("q", "C"): 1}
    assert once == {("p", "C"): 2, ("p", "W"): 1, ("q", "C"): 1}


def test_crosstab_and_distinct(spark):
    from tierwise.operators.grouping import distinct_members, status_crosstab
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 1), ("a", "x", 2), ("b", "y", None)],
                               "g string, s string, m int")
    got = {r["g"]: (r["X"], r["X_PCT"], r["Y"]) for r in
           status_crosstab(df, ["g"], "s", [("x", "X", "X_PCT"), ("y", "Y", None)], 1).collect()}
    assert got == {"a": (2, 66.7, 1), "b": (0, 0.0, 1)}
    assert {r["g"]: r["MEMBERS"] for r in distinct_members(df, ["g"], "m").collect()} == {"a": 2, "b": 0}
