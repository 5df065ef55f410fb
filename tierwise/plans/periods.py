"""Period reports (R14-R28): one customer over five periods - the report
month, the prior month, the last twelve months, the last 90 days and the
90 days before them - and the comparisons built from them.

The source job runs every period as its own query (25 round trips). Here a
call-day carries a mask of the periods that contain it, and a member has one row
with its call-days and topics in every period. The reports sum over these rows,
so nothing is multiplied by the periods; the comparisons pivot the period
results with a fixed value list, so no step collects anything to the driver.

Goal counts keep the source job's semantics: a goal counts once per
call-day its member has in the period (goals joined to calls). That number
is formed as ``sum(calls of member in period x goals of member in group)``
from one row a member instead of the many-to-many join.
"""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.columns import (pct, percent_text, report_filter, signed_thousands,
                                 thirds)
from ..operators.joins import not_in
from ..operators.masks import has_bit, overlap_mask, period_mask
from .cascade import fep_members, is_enrolled
from .reports import engagement_by_topic, metric_rows, topics_summary

PERIOD_NAMES = ["month", "prior_month", "l12m", "r90", "p90"]
MONTH, PRIOR, L12M, R90, P90 = PERIOD_NAMES


def default_range(as_of: dt.date, start: dt.date | None = None,
                  end: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """No dates: the full month before ``as_of``; only a start: up to ``as_of``."""
    if start is None:
        end_ = as_of.replace(day=1) - dt.timedelta(days=1)
        return end_.replace(day=1), end_
    return start, end or as_of


#: Call-day columns that the period reports read.
PERIOD_TOPIC_COLUMNS = ["GUID", "CURRENTGUID", "REPORT_TOPIC"]


def period_bounds(start: dt.date | str, end: dt.date | str) -> dict[str, tuple[Column, Column]]:
    """First and last day of the five report periods, with month
    arithmetic done by Spark (``add_months`` clamps to month end)."""
    s = F.lit(str(start)).cast("date")
    e = F.lit(str(end)).cast("date")
    return {
        MONTH: (s, e),
        PRIOR: (F.add_months(s, -1), F.date_sub(s, 1)),
        L12M: (F.add_months(s, -11), e),
        R90: (F.date_sub(e, 89), e),
        P90: (F.date_sub(e, 179), F.date_sub(e, 90)),
    }


def periods(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """(PERIOD, START_DATE, END_DATE) for the five report periods."""
    rows = F.array(*[F.struct(F.lit(n).alias("PERIOD"), a.alias("START_DATE"), b.alias("END_DATE"))
                     for n, (a, b) in period_bounds(start, end).items()])
    return spark.range(1).select(F.inline(rows))


def all_periods(start: dt.date, end: dt.date) -> tuple[dt.date, dt.date]:
    """First and last day that any of the five periods covers."""
    months = start.year * 12 + start.month - 1 - 11
    # a day at or before the twelve months' start, whatever the month's length
    return min(dt.date(months // 12, months % 12 + 1, 1), end - dt.timedelta(days=179)), max(start, end)


def in_period(name: str) -> Column:
    """Whether a call-day of ``period_days`` lies in the period."""
    return has_bit(F.col("__periods"), PERIOD_NAMES.index(name))


def period_days(topics: DataFrame, customer: str, start: dt.date, end: dt.date) -> DataFrame:
    """Call-days of one customer (case-insensitive) in any period, with the mask ``__periods``.

    The first and last day of all periods are literals, so the scan gets them
    as pushed filters. One row a call-day, however many periods contain it."""
    first, last = (F.lit(str(d)).cast("date") for d in all_periods(start, end))
    scoped = topics.filter(report_filter(customer) & F.col("CALL_DATE").between(first, last))
    return (scoped.select(*PERIOD_TOPIC_COLUMNS,
                          period_mask(F.col("CALL_DATE"), period_bounds(start, end)).alias("__periods"))
            .filter(F.col("__periods") != 0))


def member_days(days: DataFrame) -> DataFrame:
    """One row a known member: its number of call-days in each period, by the period's name."""
    return (days.filter(F.col("CURRENTGUID").isNotNull()).groupBy("CURRENTGUID")
            .agg(*[F.count(F.when(in_period(name), 1)).alias(name) for name in PERIOD_NAMES]))


def _by_period(totals: DataFrame, columns: dict[str, dict[str, str]], keys: list[str] | None = None) -> DataFrame:
    """One row of totals as a row a period; ``columns``: output name -> period -> column of ``totals``."""
    each = F.array(*[F.struct(F.lit(name).alias("PERIOD"), *[F.col(of[name]).alias(out) for out, of in columns.items()])
                     for name in PERIOD_NAMES])
    return totals.select(*(keys or []), F.inline(each))


def goal_counts(members: DataFrame, goals: DataFrame) -> DataFrame:
    """(PERIOD, GOAL_DOMAIN, GOAL_STATUS, JOINED, GOALS): goal rows of the members with call-days in a
    period, counted once per call-day (the source report's join) and once per goal.

    All goal reports of the periods are sums over this table of a few rows."""
    per_member = (goals.filter(F.col("CURRENTGUID").isNotNull())
                  .groupBy("CURRENTGUID", "GOAL_DOMAIN", "GOAL_STATUS").agg(F.count(F.lit(1)).alias("__goals")))
    goals_of = F.col("__goals")
    sums = per_member.join(members, "CURRENTGUID").groupBy("GOAL_DOMAIN", "GOAL_STATUS").agg(*[
        agg for name in PERIOD_NAMES for agg in (
            F.sum(goals_of * F.col(name)).alias(f"j_{name}"),
            F.sum(F.when(F.col(name) > 0, goals_of).otherwise(0)).alias(f"g_{name}"))])
    return _by_period(sums, {"JOINED": {n: f"j_{n}" for n in PERIOD_NAMES},
                             "GOALS": {n: f"g_{n}" for n in PERIOD_NAMES}},
                      ["GOAL_DOMAIN", "GOAL_STATUS"]).filter(F.col("GOALS") > 0)


#: Column of ``goal_counts`` for each way of counting.
COUNTED = {"joined": "JOINED", "goals": "GOALS"}


def engagement(days: DataFrame, goals: DataFrame) -> DataFrame:
    """Engagement by topic per period (as R9, 'OPEN_GOALS')."""
    return engagement_by_topic(days, goals, {name: in_period(name) for name in PERIOD_NAMES}, "PERIOD",
                               open_name="OPEN_GOALS")


def goal_distribution(counts: DataFrame, mode: str = "joined") -> DataFrame:
    """Per period, goal rows by reported status (joined to call-days, or
    each goal once with ``mode="goals"``) and their share of the period's rows
    (1 dp)."""
    n = (counts.filter(F.col("GOAL_STATUS").isin(*R.REPORTED_STATUSES))
         .groupBy("PERIOD", "GOAL_STATUS").agg(F.sum(COUNTED[mode]).alias("COUNT")))
    total = F.sum("COUNT").over(Window.partitionBy("PERIOD"))
    return n.select("PERIOD", "GOAL_STATUS", "COUNT", pct(F.col("COUNT"), total, 1).alias("GOAL_PCT"))


def goal_progression(counts: DataFrame) -> DataFrame:
    """Per period and domain, goal rows, completed rows and the rate (1 dp)."""
    per = counts.groupBy("PERIOD", "GOAL_DOMAIN").agg(
        F.sum("JOINED").cast("long").alias("TOTAL_GOALS"),
        F.sum(F.when(F.col("GOAL_STATUS") == R.COMPLETED, F.col("JOINED")).otherwise(0))
        .cast("long").alias("COMPLETED"))
    return per.withColumn("COMPLETION_RATE", pct(F.col("COMPLETED"), F.col("TOTAL_GOALS"), 1))


def _tobacco_numbers(members: DataFrame, tobacco: DataFrame, goals: DataFrame,
                     counts: DataFrame) -> DataFrame:
    """Per period: P participants, A active participants, C / I tobacco goal
    rows completed / in progress (joined to call-days)."""
    is_tobacco = F.col("GOAL_DOMAIN") == R.TOBACCO_DOMAIN
    active = (goals.filter(is_tobacco & (F.col("GOAL_STATUS") == R.IN_PROGRESS))
              .select("CURRENTGUID").distinct().withColumn("__active", F.lit(True)))
    flagged = (members.join(tobacco.select("CURRENTGUID").distinct(), "CURRENTGUID", "left_semi")
               .join(active, "CURRENTGUID", "left"))
    totals = flagged.agg(*[agg for name in PERIOD_NAMES for agg in (
        F.count(F.when(F.col(name) > 0, 1)).alias(f"p_{name}"),
        F.count(F.when((F.col(name) > 0) & F.col("__active"), 1)).alias(f"a_{name}"))])
    people = _by_period(totals, {"P": {n: f"p_{n}" for n in PERIOD_NAMES},
                                 "A": {n: f"a_{n}" for n in PERIOD_NAMES}})
    goal_rows = counts.filter(is_tobacco).groupBy("PERIOD").agg(
        F.sum(F.when(F.col("GOAL_STATUS") == R.COMPLETED, F.col("JOINED")).otherwise(0)).alias("C"),
        F.sum(F.when(F.col("GOAL_STATUS") == R.IN_PROGRESS, F.col("JOINED")).otherwise(0)).alias("I"))
    return people.join(goal_rows, "PERIOD", "left").select(
        "PERIOD", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("P", "A", "C", "I")])


def tobacco_from_numbers(nums: DataFrame) -> DataFrame:
    """The five tobacco metrics per period as text, from the numbers (P, A, C, I)."""
    return metric_rows(nums, [
        (R.TOBACCO_METRICS[0], F.col("P")), (R.TOBACCO_METRICS[1], F.col("A")),
        (R.TOBACCO_METRICS[2], F.col("C")), (R.TOBACCO_METRICS[3], F.col("I")),
        (R.TOBACCO_METRICS[4], percent_text(pct(F.col("C"), F.col("C") + F.col("I"), 1)))],
        ["PERIOD"])


def enrolled_members(sources: dict[str, DataFrame], bounds: dict[str, tuple[Column, Column]], customer: str,
                     exclude_fep: bool = True) -> DataFrame:
    """Distinct enrolled members of the customer whose enrollment overlaps
    each period; FEP members removed with SQL ``NOT IN`` semantics. For the
    90-day periods MONTHLY_AVG is the count / 3.

    Enrollment rows become one mask of periods a member, and one row of sums."""
    ce = sources["COACHING_ENROLLMENT_MODEL"]
    rows = ce.filter(is_enrolled(ce) & (F.upper("CUSTOMERID") == F.upper(F.lit(customer))))
    if exclude_fep:
        rows = not_in(rows, "CURRENTGUID", fep_members(sources["ELIGMEMBER"], customer),
                      "CURRENTGUID", drop_null_members=False)
    mask = overlap_mask(F.col("BIEFFECTIVEDATE"), F.col("BIENDDATE"), bounds)
    members = (rows.filter(F.col("CURRENTGUID").isNotNull()).groupBy("CURRENTGUID")
               .agg(F.bit_or(mask).alias("__periods")))
    totals = members.agg(*[F.count(F.when(in_period(name), 1)).alias(name) for name in PERIOD_NAMES])
    n = F.col("ENROLLED_MEMBERS")
    return _by_period(totals, {"ENROLLED_MEMBERS": {n: n for n in PERIOD_NAMES}}).select(
        "PERIOD", n, F.when(F.col("PERIOD").isin(R90, P90), thirds(n)).alias("MONTHLY_AVG"))


def topics_classic(t: DataFrame) -> DataFrame:
    """Topics summary of the twelve months' call-days by CURRENTGUID (2 dp)."""
    return topics_summary(t, "CURRENTGUID", 2)


def tobacco_classic(t: DataFrame, tobacco_df: DataFrame) -> DataFrame:
    """Yes / No over the twelve months' call-days. Yes counts call-days joined
    to flag rows on CURRENTGUID (a member with two flag rows counts twice); No
    counts call-days of members not in the flag set (nulls removed from the set; a
    null CURRENTGUID never qualifies). A group with no rows gives no row."""
    totals = F.broadcast(t.agg(F.countDistinct("CURRENTGUID").alias("__m"),
                               F.count(F.lit(1)).alias("__c")))
    flag_rows = (tobacco_df.filter(F.col("CURRENTGUID").isNotNull())
                 .groupBy("CURRENTGUID").agg(F.count(F.lit(1)).alias("__k")))
    yes = (t.join(flag_rows, "CURRENTGUID").groupBy(F.lit("Yes").alias("TOBACCO_DISCUSSED"))
           .agg(F.countDistinct("CURRENTGUID").alias("MEMBERS"),
                F.sum("__k").cast("long").alias("CALLS")))
    no = (not_in(t, "CURRENTGUID", tobacco_df, "CURRENTGUID", drop_null_members=True)
          .groupBy(F.lit("No").alias("TOBACCO_DISCUSSED"))
          .agg(F.countDistinct("CURRENTGUID").alias("MEMBERS"),
               F.count(F.lit(1)).alias("CALLS")))
    return yes.unionByName(no).crossJoin(totals).select(
        "TOBACCO_DISCUSSED", "MEMBERS", pct(F.col("MEMBERS"), F.col("__m"), 2).alias("PCT_MEMBERS"),
        "CALLS", pct(F.col("CALLS"), F.col("__c"), 2).alias("PCT_OF_CALLS"))


def goal_domain_status(counts: DataFrame) -> DataFrame:
    """Twelve-month goal rows per domain by status (1 dp)."""
    def of(status: str) -> Column:
        return F.sum(F.when(F.col("GOAL_STATUS") == status, F.col("JOINED")).otherwise(0)).cast("long")
    per = counts.filter(F.col("PERIOD") == L12M).groupBy("GOAL_DOMAIN").agg(
        F.sum("JOINED").alias("__rows"), of(R.COMPLETED).alias("COMPLETED"),
        of(R.IN_PROGRESS).alias("IN_PROGRESS"), of(R.WITHDRAWN).alias("WITHDRAWN"))
    return per.select("GOAL_DOMAIN",
                      "COMPLETED", pct(F.col("COMPLETED"), F.col("__rows"), 1).alias("COMP_PCT"),
                      "IN_PROGRESS", pct(F.col("IN_PROGRESS"), F.col("__rows"), 1).alias("IP_PCT"),
                      "WITHDRAWN", pct(F.col("WITHDRAWN"), F.col("__rows"), 1).alias("WD_PCT"))


# ---------------------------------------------------------------------------
# Comparisons
# ---------------------------------------------------------------------------


def by_period(df: DataFrame, label: str, value: str, periods_: list[str] = PERIOD_NAMES
              ) -> DataFrame:
    """One row per label with one column per period (missing -> 0)."""
    wide = df.groupBy(label).pivot("PERIOD", periods_).agg(F.first(value))
    return wide.select(label, *[F.coalesce(F.col(p), F.lit(0)).alias(p) for p in periods_])


def compare_goal_status(dist: DataFrame) -> DataFrame:
    """Per reported status: L12M rows and share, month, prior, MoM change."""
    spark = dist.sparkSession
    labels = spark.createDataFrame([(s,) for s in R.REPORTED_STATUSES], "GOAL_STATUS string")
    counts = by_period(dist, "GOAL_STATUS", "COUNT", [MONTH, PRIOR, L12M])
    shares = by_period(dist, "GOAL_STATUS", "GOAL_PCT", [L12M]).withColumnRenamed(L12M, "__pct")
    t = F.broadcast(labels).join(counts, "GOAL_STATUS", "left").join(shares, "GOAL_STATUS", "left")
    c = {p: F.coalesce(F.col(p), F.lit(0)).cast("long") for p in (MONTH, PRIOR, L12M)}
    mom = c[MONTH] - c[PRIOR]
    return t.select("GOAL_STATUS", c[L12M].alias("L12M"),
                    F.coalesce(F.col("__pct"), F.lit(0.0)).cast("double").alias("L12M_PCT"),
                    c[MONTH].alias("MONTH"), c[PRIOR].alias("PRIOR"), mom.alias("MOM_CHANGE"),
                    signed_thousands(mom).alias("MOM_CHANGE_TEXT"))


def compare_engagement(eng: DataFrame) -> DataFrame:
    """Per topic of the report month: members by period, MoM change and
    90-day monthly averages (count / 3) with their change."""
    m = by_period(eng, "WELLBEING_TOPIC", "MEMBERS")
    current = eng.filter(F.col("PERIOD") == MONTH).select("WELLBEING_TOPIC").distinct()
    t = m.join(current, "WELLBEING_TOPIC", "left_semi")
    c = {p: F.col(p).cast("long") for p in PERIOD_NAMES}
    mom = c[MONTH] - c[PRIOR]
    raw90 = c[R90] - c[P90]
    d90 = thirds(raw90)
    return t.select("WELLBEING_TOPIC", c[L12M].alias("L12M"), c[MONTH].alias("MONTH"),
                    c[PRIOR].alias("PRIOR"), mom.alias("MOM_DELTA"),
                    thirds(c[R90]).alias("AVG_90D"), thirds(c[P90]).alias("PRIOR_AVG_90D"),
                    d90.alias("DELTA_90D"), signed_thousands(mom).alias("MOM_DELTA_TEXT"),
                    signed_thousands(d90, raw90).alias("DELTA_90D_TEXT"))


def compare_goal_progression(prog: DataFrame) -> DataFrame:
    """Per domain of the report month: twelve-month goals, completed and
    rate, 90-day monthly averages of goals and their change."""
    totals = by_period(prog, "GOAL_DOMAIN", "TOTAL_GOALS", [L12M, R90, P90])
    done = by_period(prog, "GOAL_DOMAIN", "COMPLETED", [L12M]).withColumnRenamed(L12M, "__done")
    rate = by_period(prog, "GOAL_DOMAIN", "COMPLETION_RATE", [L12M]).withColumnRenamed(L12M, "__rate")
    current = prog.filter(F.col("PERIOD") == MONTH).select("GOAL_DOMAIN").distinct()
    t = (totals.join(current, "GOAL_DOMAIN", "left_semi").join(done, "GOAL_DOMAIN", "left")
         .join(rate, "GOAL_DOMAIN", "left"))
    avg, prior_avg = thirds(F.col(R90)), thirds(F.col(P90))
    return t.select("GOAL_DOMAIN", F.col(L12M).cast("long").alias("L12M_GOALS"),
                    F.coalesce(F.col("__done"), F.lit(0)).cast("long").alias("L12M_COMPLETED"),
                    F.coalesce(F.col("__rate"), F.lit(0.0)).cast("double").alias("L12M_RATE"),
                    avg.alias("AVG_90D"), prior_avg.alias("PRIOR_AVG_90D"),
                    (avg - prior_avg).alias("DELTA_90D"),
                    signed_thousands(avg - prior_avg).alias("DELTA_90D_TEXT"))


def compare_tobacco(tob: DataFrame) -> DataFrame:
    """Per tobacco metric: value text per period (missing -> '0'), and for
    the counts the MoM change; the '90-day' columns repeat the month and prior
    values, as in the source report. Completion Rate has no changes."""
    wide = tob.groupBy("METRIC").pivot("PERIOD", [MONTH, PRIOR, L12M]).agg(F.first("VALUE"))
    v = {p: F.coalesce(F.col(p), F.lit("0")) for p in (MONTH, PRIOR, L12M)}
    is_rate = F.col("METRIC") == R.TOBACCO_METRICS[4]
    cur, prev = v[MONTH].try_cast("long"), v[PRIOR].try_cast("long")
    change = cur - prev
    change_text = F.when(change > 0, F.concat(F.lit("+"), change.cast("string"))) \
        .otherwise(change.cast("string"))
    dash = F.lit("—")
    return wide.select(
        "METRIC", v[L12M].alias("L12M"), v[MONTH].alias("MONTH"), v[PRIOR].alias("PRIOR"),
        F.when(is_rate, dash).otherwise(change_text).alias("MOM_CHANGE"),
        F.when(is_rate, dash).otherwise(cur.cast("string")).alias("AVG_90D"),
        F.when(is_rate, dash).otherwise(prev.cast("string")).alias("PRIOR_AVG_90D"),
        F.when(is_rate, dash).otherwise(change_text).alias("DELTA_90D"))


KPI_LABELS = ["Members Coached", "Distinct Members Coached", "Goals Completed",
              "Tobacco Participants"]


def kpi_headlines(eng: DataFrame, dist: DataFrame, tob: DataFrame,
                  member_rows: DataFrame) -> DataFrame:
    """Headline KPIs per period. 'Members Coached' sums the per-topic
    member counts (a member in three topics counts three times), as the
    source report does; 'Distinct Members Coached' counts each member once;
    tobacco's 90-day figures are the month's values."""
    members = eng.groupBy("PERIOD").agg(F.sum("MEMBERS").alias("__v")) \
        .withColumn("KPI", F.lit("Members Coached"))
    coached = member_rows.agg(*[F.count(F.when(F.col(name) > 0, 1)).alias(name) for name in PERIOD_NAMES])
    distinct = _by_period(coached, {"__v": {n: n for n in PERIOD_NAMES}}) \
        .withColumn("KPI", F.lit("Distinct Members Coached"))
    completed = (dist.filter(F.col("GOAL_STATUS") == R.COMPLETED)
                 .groupBy("PERIOD").agg(F.sum("COUNT").alias("__v"))
                 .withColumn("KPI", F.lit("Goals Completed")))
    participants = (tob.filter(F.col("METRIC") == R.TOBACCO_METRICS[0])
                    .select("PERIOD", F.col("VALUE").try_cast("long").alias("__v"))
                    .withColumn("KPI", F.lit("Tobacco Participants")))
    allv = members.unionByName(distinct).unionByName(completed).unionByName(participants)
    spark = eng.sparkSession
    labels = spark.createDataFrame([(k,) for k in KPI_LABELS], "KPI string")
    wide = F.broadcast(labels).join(by_period(allv, "KPI", "__v"), "KPI", "left")
    c = {p: F.coalesce(F.col(p), F.lit(0)).cast("long") for p in PERIOD_NAMES}
    is_tob = F.col("KPI") == "Tobacco Participants"
    avg = F.when(is_tob, c[MONTH]).otherwise(thirds(c[R90]))
    prior_avg = F.when(is_tob, c[PRIOR]).otherwise(thirds(c[P90]))
    return wide.select("KPI", c[L12M].alias("L12M"), c[MONTH].alias("MONTH"),
                       c[PRIOR].alias("PRIOR"), (c[MONTH] - c[PRIOR]).alias("MOM_DELTA"),
                       avg.alias("AVG_90D"), prior_avg.alias("PRIOR_AVG_90D"),
                       (avg - prior_avg).alias("DELTA_90D"))


def tobacco_goal_gap(tob_numbers: DataFrame) -> DataFrame:
    """month's tobacco participants without an in-progress tobacco goal."""
    t = tob_numbers.filter(F.col("PERIOD") == MONTH)
    gap = F.col("P") - F.col("A")
    return t.select(F.col("P").alias("PARTICIPANTS"), F.col("A").alias("ACTIVE"),
                    gap.alias("GAP"), pct(gap, F.greatest(F.col("P"), F.lit(1)), 1).alias("GAP_PCT"))


def build_periods(spark: SparkSession, sources: dict[str, DataFrame], out: dict[str, DataFrame],
                  customer: str, start: dt.date, end: dt.date,
                  exclude_fep: bool = True) -> dict[str, DataFrame]:
    """All period reports over one refresh build ``out``.

    The customer's call-days in the periods, its members' rows and the small
    tables made from them feed every report and comparison, so they are
    persisted once per bundle."""
    cached: list[DataFrame] = []

    def shared(df: DataFrame) -> DataFrame:
        cached.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return cached[-1]

    days = shared(period_days(out["topics"], customer, start, end))
    members = shared(member_days(days))
    goals = out["goals_numbered"]
    counts = shared(goal_counts(members, goals))
    l12m = days.filter(in_period(L12M))
    res = {"periods": periods(spark, start, end)}
    res["engagement"] = shared(engagement(days, goals))
    res["goal_distribution"] = goal_distribution(counts)
    res["goal_distribution_goals"] = goal_distribution(counts, mode="goals")
    res["goal_progression"] = goal_progression(counts)
    res["tobacco_numbers"] = shared(_tobacco_numbers(members, out["tobacco"], goals, counts))
    res["tobacco"] = tobacco_from_numbers(res["tobacco_numbers"])
    res["enrolled"] = enrolled_members(sources, period_bounds(start, end), customer, exclude_fep)
    res["topics_classic"] = topics_classic(l12m)
    res["tobacco_classic"] = tobacco_classic(l12m, out["tobacco"])
    res["goal_domain_status"] = goal_domain_status(counts)
    res["cmp_goal_status"] = compare_goal_status(res["goal_distribution"])
    res["cmp_engagement"] = compare_engagement(res["engagement"])
    res["cmp_goal_progression"] = compare_goal_progression(res["goal_progression"])
    res["cmp_tobacco"] = compare_tobacco(res["tobacco"])
    res["kpi_headlines"] = kpi_headlines(res["engagement"], res["goal_distribution"], res["tobacco"],
                                         members)
    res["tobacco_goal_gap"] = tobacco_goal_gap(res["tobacco_numbers"])
    res["_cached"] = cached  # type: ignore[assignment]
    return res
