"""Report tables over one build: the workbook outputs (R1-R8, ad-hoc variant)
and the dashboard sections (R9-R13, over the month snapshot tables).

All reports aggregate first and only then combine: totals are one-row
aggregates (broadcast by construction), and members and goals per topic go
through one row a member that holds its topics as a bit mask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.columns import pct, percent_text, rank_by
from ..operators.grouping import one_row_totals, share_of_total, status_crosstab
from ..operators.masks import by_label, counted, label_masks, labels_of

STATUS_COLUMNS_2DP = [
    (R.NOT_STARTED, "NOT_STARTED", "NS_PCT"),
    (R.IN_PROGRESS, "IN_PROGRESS", "IP_PCT"),
    (R.COMPLETED, "COMPLETED", "COMP_PCT"),
    (R.WITHDRAWN, "WITHDRAWN", "WD_PCT"),
]


def _count() -> Column:
    return F.count(F.lit(1))


def topics_summary(topics: DataFrame, member: str, scale: int = 2) -> DataFrame:
    """Per topic, distinct members and call-days, each with its share
    of all members / all call-days."""
    totals = one_row_totals(topics, __m=F.countDistinct(member), __c=_count())
    per = topics.groupBy(F.col("REPORT_TOPIC").alias("CALL_TOPIC")).agg(
        F.countDistinct(member).alias("MEMBERS"), _count().alias("CALLS"))
    return per.crossJoin(totals).select(
        "CALL_TOPIC", "MEMBERS", pct(F.col("MEMBERS"), F.col("__m"), scale).alias("PCT_MEMBERS"),
        "CALLS", pct(F.col("CALLS"), F.col("__c"), scale).alias("PCT_OF_CALLS"))


def tier_breakdown(topics: DataFrame) -> DataFrame:
    """R2: call-days per topic source with their share."""
    per = topics.groupBy("TOPIC_SOURCE").agg(_count().alias("CALLS"))
    return share_of_total(per, "CALLS", 2, "PCT")


def _is_tobacco(df: DataFrame) -> Column:
    return ((F.upper(df["RAW_TOPIC"]) == R.TOBACCO_WORD)
            | (F.upper(df["CALL_TYPE"]) == R.TOBACCO_WORD))


def tobacco_summary(topics: DataFrame, tobacco: DataFrame) -> DataFrame:
    """Yes (tobacco call-days), No (all call-days of never-flagged GUIDs; a
    null GUID never qualifies) and Grand Total, each with shares of the
    total. Yes + No need not add up to the total (kept as specified).

    One pass: call-days are cut to one row per GUID (rows, tobacco rows),
    marked with the flag set, then one global aggregate yields all three
    lines; ``stack`` turns them into rows."""
    per_guid = topics.groupBy("GUID").agg(
        _count().alias("__rows"),
        F.sum(F.when(_is_tobacco(topics), 1).otherwise(0)).alias("__yes"))
    flagged = (tobacco.filter(F.col("GUID").isNotNull()).select("GUID").distinct()
               .withColumn("__flagged", F.lit(True)))
    m = per_guid.join(flagged, "GUID", "left")
    known = F.col("GUID").isNotNull()
    never = known & F.col("__flagged").isNull()
    totals = m.agg(
        F.count(F.when(known & (F.col("__yes") > 0), 1)).alias("yes_m"),
        F.coalesce(F.sum("__yes"), F.lit(0)).alias("yes_c"),
        F.count(F.when(never, 1)).alias("no_m"),
        F.coalesce(F.sum(F.when(never, F.col("__rows"))), F.lit(0)).alias("no_c"),
        F.count(F.when(known, 1)).alias("all_m"),
        F.coalesce(F.sum("__rows"), F.lit(0)).alias("all_c"))
    lines = F.array(*[F.struct(F.lit(label).alias("TOBACCO_DISCUSSED"),
                               F.col(m_).cast("long").alias("MEMBERS"),
                               F.col(c_).cast("long").alias("CALLS"))
                      for label, m_, c_ in (("Yes", "yes_m", "yes_c"), ("No", "no_m", "no_c"),
                                            ("Grand Total", "all_m", "all_c"))])
    return totals.select(F.inline(lines), "all_m", "all_c").select(
        "TOBACCO_DISCUSSED", "MEMBERS", pct(F.col("MEMBERS"), F.col("all_m"), 2).alias("PCT_MEMBERS"),
        "CALLS", pct(F.col("CALLS"), F.col("all_c"), 2).alias("PCT_OF_CALLS"))


def goal_type_domain(goals: DataFrame) -> DataFrame:
    """Per domain, coach-created vs system-recommended goals (2 dp)."""
    return status_crosstab(goals, ["GOAL_DOMAIN"], "GOAL_TYPE", [
        ("Coach-Created", "COACH_CREATED", "CC_PCT"),
        ("System-Recommended", "SYS_RECOMMENDED", "SR_PCT")], 2)


def goal_domain_status(goals: DataFrame) -> DataFrame:
    """Per domain, goals by status (2 dp)."""
    return status_crosstab(goals, ["GOAL_DOMAIN"], "GOAL_STATUS", STATUS_COLUMNS_2DP, 2)


def goal_number_status(goals: DataFrame) -> DataFrame:
    """Per goal number (first six), goals by status (2 dp)."""
    capped = goals.filter(F.col("GOAL_NUMBER") <= R.GOAL_NUMBER_CAP)
    return status_crosstab(capped, ["GOAL_NUMBER"], "GOAL_STATUS", STATUS_COLUMNS_2DP, 2)


def goal_type_status(goals: DataFrame) -> DataFrame:
    """Per goal type, goals by status (2 dp)."""
    return status_crosstab(goals, ["GOAL_TYPE"], "GOAL_STATUS", STATUS_COLUMNS_2DP, 2)


# Section label -> test on TOPIC_SOURCE (None: every call-day).
VALIDATION_SECTIONS = [
    ("ALL CALLS", None),
    ("Tier 1: Date Match", lambda c: c.like("Tier 1:%")),
    ("Tier 1.5: Text", lambda c: c == R.TIER_TEXT),
    ("Tier 2: Call Type", lambda c: c == R.TIER_CALL_TYPE),
    ("Tier 3: Prior", lambda c: c == R.TIER_PRIOR),
    ("Tier 4: General", lambda c: c == R.TIER_NONE),
]


def validation_counts(topics: DataFrame, tobacco: DataFrame, goals: DataFrame) -> DataFrame:
    """Rows and distinct members per tier section, tobacco and goals.

    One pass over the call-days: per GUID, the rows of each section; then
    one global aggregate (rows = sum, members = GUIDs with rows > 0)."""
    source = F.col("TOPIC_SOURCE")
    per_guid = topics.groupBy("GUID").agg(*[
        F.sum(F.when(F.lit(True) if test is None else test(source), 1).otherwise(0)).alias(f"__s{i}")
        for i, (_, test) in enumerate(VALIDATION_SECTIONS)])
    known = F.col("GUID").isNotNull()
    sums = per_guid.agg(*[agg for i in range(len(VALIDATION_SECTIONS)) for agg in (
        F.coalesce(F.sum(f"__s{i}"), F.lit(0)).cast("long").alias(f"r{i}"),
        F.count(F.when(known & (F.col(f"__s{i}") > 0), 1)).alias(f"m{i}"))])
    lines = F.array(*[F.struct(F.lit(label).alias("SECTION"), F.col(f"r{i}").alias("ROWS"),
                               F.col(f"m{i}").alias("MEMBERS"))
                      for i, (label, _) in enumerate(VALIDATION_SECTIONS)])
    tiers = sums.select(F.inline(lines))
    tob = tobacco.agg(F.lit("TOBACCO").alias("SECTION"), _count().alias("ROWS"),
                      F.countDistinct("GUID").alias("MEMBERS"))
    gl = goals.agg(F.lit("GOALS").alias("SECTION"), _count().alias("ROWS"),
                   F.countDistinct("CURRENTGUID").alias("MEMBERS"))
    return tiers.unionByName(tob).unionByName(gl)


#: The one slot of reports without periods.
ALL_DAYS = "all"


def topic_masks(topics: DataFrame, labels: DataFrame, slots: dict[str, Column] | None = None) -> DataFrame:
    """One row a member: a mask of the topics of its call-days in each slot."""
    known = topics.filter(F.col("CURRENTGUID").isNotNull())
    return label_masks(known, ["CURRENTGUID"], "REPORT_TOPIC", labels, slots or {ALL_DAYS: F.lit(True)})


def _goals_by_topic(masks: DataFrame, labels: DataFrame, goals: DataFrame, slots: list[str],
                    completed: str, open_: str) -> DataFrame:
    """(slot, REPORT_TOPIC) with distinct completed and in-progress goals of the topic's members.

    Each goal meets one row, that of its member. Goals of one id are then put
    together with the topics of all their members, and equal topic masks are
    counted before they are taken apart. A topic whose goals all have other
    statuses stays, with zeros."""
    is_counted = F.col("GOAL_STATUS").isin(R.COMPLETED, R.IN_PROGRESS)
    g = goals.select("CURRENTGUID", F.when(is_counted, F.col("GOAL_STATUS")).alias("__s"),
                     F.when(is_counted, F.col("MEMBERACTION_ID")).alias("__id"))
    each = (g.join(masks, "CURRENTGUID").groupBy("__word", "__s", "__id")
            .agg(*[F.bit_or(slot).alias(slot) for slot in slots])
            .withColumn("__known", F.col("__id").isNotNull()))

    def goals_in(status: str) -> Column:
        return F.sum(F.when((F.col("__s") == status) & F.col("__known"), F.col("__n")).otherwise(0)).cast("long")

    taken = by_label(counted(each, slots, ["__s", "__known"]), labels, slots, "REPORT_TOPIC")
    return taken.groupBy("__slot", "REPORT_TOPIC").agg(goals_in(R.COMPLETED).alias(completed),
                                                       goals_in(R.IN_PROGRESS).alias(open_))


def engagement_by_topic(topics: DataFrame, goals: DataFrame, slots: dict[str, Column] | None = None,
                        slot_name: str | None = None, open_name: str = "OPEN_IN_PROGRESS_GOALS") -> DataFrame:
    """Members per topic (share of all members, 1 dp) with the
    distinct completed / in-progress goals of those members.

    Equivalent to the left join of call-days to goals on CURRENTGUID. Call-days
    are reduced to one row a member, with a mask of its topics in each slot (a
    period; ``slot_name`` is its column), which gives the members and meets
    the goals."""
    slots = slots or {ALL_DAYS: F.lit(True)}
    names = list(slots)
    labels = labels_of(topics, "REPORT_TOPIC")
    masks = topic_masks(topics, labels, slots)
    # topics without any known member have zero members, and stay
    seen = topics.select("REPORT_TOPIC", *[test.alias(name) for name, test in slots.items()]).groupBy(
        "REPORT_TOPIC").agg(*[F.max(name).alias(name) for name in names])
    base = seen.select("REPORT_TOPIC", F.inline(F.array(*[
        F.struct(F.lit(name).alias("__slot"), F.col(name).alias("__seen")) for name in names]))).filter("__seen")
    members = by_label(counted(masks, names), labels, names, "REPORT_TOPIC").groupBy(
        "__slot", "REPORT_TOPIC").agg(F.sum("__n").alias("MEMBERS"))
    once = masks.groupBy("CURRENTGUID").agg(*[F.max(F.col(name) != 0).alias(name) for name in names])
    totals = one_row_totals(once, **{f"__m_{name}": F.count(F.when(F.col(name), 1)) for name in names})
    total = F.element_at(F.create_map(*[c for name in names
                                        for c in (F.lit(name), F.col(f"__m_{name}"))]), F.col("__slot"))
    goal_counts = _goals_by_topic(masks, labels, goals, names, "COMPLETED_GOALS", open_name)
    on = ["__slot", "REPORT_TOPIC"]
    out = base.join(members, on, "left").join(goal_counts, on, "left").crossJoin(totals)
    count = F.coalesce("MEMBERS", F.lit(0))
    return out.select(
        *([F.col("__slot").alias(slot_name)] if slot_name else []),
        F.col("REPORT_TOPIC").alias("WELLBEING_TOPIC"), count.alias("MEMBERS"),
        pct(count, total, 1).alias("PCT_OF_MEMBERS"),
        F.coalesce(F.col("COMPLETED_GOALS"), F.lit(0)).alias("COMPLETED_GOALS"),
        F.coalesce(F.col(open_name), F.lit(0)).alias(open_name))


def goal_status_by_topic(topics: DataFrame, goals: DataFrame) -> DataFrame:
    """Per topic with at least one goal of its members, the distinct
    completed and in-progress goals."""
    labels = labels_of(topics, "REPORT_TOPIC")
    return _goals_by_topic(topic_masks(topics, labels), labels, goals, [ALL_DAYS], "COMPLETED",
                           "IN_PROGRESS").select(
        F.col("REPORT_TOPIC").alias("WELLBEING_TOPIC"), "COMPLETED", "IN_PROGRESS")


def goal_status_distribution(goals: DataFrame) -> DataFrame:
    """Goals per reported status and share (1 dp)."""
    per = (goals.filter(F.col("GOAL_STATUS").isin(*R.REPORTED_STATUSES))
           .groupBy("GOAL_STATUS").agg(_count().alias("COUNT")))
    return share_of_total(per, "COUNT", 1, "GOAL_PCT")


def goal_progression(goals: DataFrame) -> DataFrame:
    """Per domain, goals, completed goals and completion rate (1 dp)."""
    per = goals.groupBy("GOAL_DOMAIN").agg(
        _count().alias("TOTAL_GOALS"),
        F.sum(F.when(F.col("GOAL_STATUS") == R.COMPLETED, 1).otherwise(0)).cast("long")
        .alias("COMPLETED"))
    return per.withColumn("COMPLETION_RATE", pct(F.col("COMPLETED"), F.col("TOTAL_GOALS"), 1))


def metric_rows(row: DataFrame, metrics: list[tuple[str, Column]], keys: list[str] | None = None
                ) -> DataFrame:
    """Turns one row of metric columns into (METRIC, VALUE) rows."""
    keys = keys or []
    pairs = F.array(*[F.struct(F.lit(label).alias("METRIC"), value.cast("string").alias("VALUE"))
                      for label, value in metrics])
    return row.select(*keys, F.inline(pairs))


def tobacco_focus(tobacco: DataFrame, goals: DataFrame) -> DataFrame:
    """Five tobacco metrics as text (counts; completion rate as 'x.y%')."""
    tob_goals = goals.filter(F.col("GOAL_DOMAIN") == R.TOBACCO_DOMAIN)
    participants = one_row_totals(tobacco, P=F.countDistinct("CURRENTGUID"))
    active_members = (tob_goals.filter(F.col("GOAL_STATUS") == R.IN_PROGRESS)
                      .select("CURRENTGUID").distinct())
    active = one_row_totals(tobacco.select("CURRENTGUID").distinct()
                            .join(active_members, "CURRENTGUID"), A=_count())
    status = F.col("GOAL_STATUS")
    counts = one_row_totals(
        tob_goals,
        C=F.count(F.when(status == R.COMPLETED, 1)),
        I=F.count(F.when(status == R.IN_PROGRESS, 1)))
    row = participants.crossJoin(active).crossJoin(counts)
    return metric_rows(row, [
        (R.TOBACCO_METRICS[0], F.col("P")), (R.TOBACCO_METRICS[1], F.col("A")),
        (R.TOBACCO_METRICS[2], F.col("C")), (R.TOBACCO_METRICS[3], F.col("I")),
        (R.TOBACCO_METRICS[4], percent_text(pct(F.col("C"), F.col("C") + F.col("I"), 1)))])


def domain_order(col: str = "GOAL_DOMAIN", short: bool = False) -> Column:
    """O2 / O2b display rank of a goal domain."""
    return rank_by(F.col(col), R.DOMAIN_ORDER_SHORT if short else R.DOMAIN_ORDER)


def status_order(col: str = "GOAL_STATUS") -> Column:
    """O3 display rank of a goal status."""
    return rank_by(F.col(col), R.STATUS_ORDER)


def yes_no_order(col: str = "TOBACCO_DISCUSSED") -> Column:
    """O4 display rank: Yes, No, then anything else."""
    return rank_by(F.col(col), R.YES_NO_ORDER)
