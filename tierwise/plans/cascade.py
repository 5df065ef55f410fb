"""The topic cascade (steps P1-P12): from calls, enrollment, eligibility,
coach notes and member actions to call-day topics, tobacco flags and
numbered goals.

Two variants exist. ``refresh`` is the production monthly job: enrollment
excludes FEP members, topics carry CURRENTGUID through the GUID bridge and
goals attach to the latest enrolled row. ``adhoc`` is the workbook form:
calls need any enrolled row (FEP kept), topics have no CURRENTGUID and
goals attach to the latest row still active on ``as_of`` (any status).

Plan shape. Everything is keyed by the call-day (ACCOUNT, CALL_DATE). Each
tier is reduced to at most one row per call-day *before* the assembly, which
stacks the tiers and takes one aggregate per call-day, and no step ever
holds more than a bounded number of rows per key: calls and notes are cut
to one row per (account, day) by partial top-1 or partial aggregation
before their first shuffle.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.columns import (by_code, by_equality, by_keywords, first_match, norm,
                                  prefix_before, text_after)
from ..operators.grouping import (daily_counts, frequency_tiebreak, latest_per_group,
                                  number_in_group)
from ..operators.joins import asof_within, unresolved, within_interval  # noqa: F401

DAY_KEY = ["ACCOUNT", "CALL_DATE"]
CALL_DAY_COLUMNS = ["ACCOUNT", "GUID", "CUSTOMERID", "CALL_TYPE", "CALL_DATE"]
TOPIC_COLUMNS = ["ACCOUNT", "GUID", "CURRENTGUID", "CUSTOMERID", "CALL_DATE", "CALL_TYPE",
                 "RAW_TOPIC", "REPORT_TOPIC", "TOPIC_SOURCE", "PROGRAM_TYPE"]
GOAL_COLUMNS = ["ACCOUNT", "GOAL_TYPE", "GOAL_DOMAIN", "GOAL_STATUS", "GOAL_DESCRIPTION",
                "RAW_ACTION_NAME", "MEMBERACTION_ID", "ACTIONTYPE_ID", "ACTIONSTATUS_ID",
                "FOCUSAREA_ID", "GOAL_SET_DATE", "GOAL_CLOSE_DATE"]
ENROLLED_COLUMNS = ["ACCOUNT", "CURRENTGUID", "GUID", "CUSTOMERID", "OFFERING_NAME",
                    "BIEFFECTIVEDATE", "BIENDDATE"]


def is_enrolled(df: DataFrame) -> Column:
    return ((F.upper(df["OFFERING_STATUS"]) == R.ENROLLED)
            & (F.upper(df["LEVEL_NAME"]) == R.ENROLLED))


def fep_members(elig: DataFrame, customer: str | None = None) -> DataFrame:
    """CURRENTGUIDs of members in an FEP org unit (optionally one customer's)."""
    test = F.upper(F.col("ORGUNITID")).ilike(R.FEP_PATTERN)
    if customer is not None:
        test = test & (F.upper(F.col("CUSTOMERID")) == F.upper(F.lit(customer)))
    return elig.filter(test).select("CURRENTGUID").distinct()


def enrolled_population(sources: dict[str, DataFrame]) -> DataFrame:
    """Enrolled rows (status and level both ENROLLED), FEP members removed.
    A row with a null CURRENTGUID is kept (it cannot match an FEP member)."""
    ce = sources["COACHING_ENROLLMENT_MODEL"]
    enrolled = ce.filter(is_enrolled(ce))
    kept = enrolled.join(fep_members(sources["ELIGMEMBER"]), "CURRENTGUID", "left_anti")
    return kept.select(*ENROLLED_COLUMNS).distinct()


def calls_one_per_day(sources: dict[str, DataFrame], enrollment: DataFrame,
                      call_filter: Column | None = None) -> DataFrame:
    """The latest qualifying call of each (ACCOUNT, day) during enrollment.

    The enrollment test depends on (ACCOUNT, CALL_DATE) only, so it is applied
    after the per-day top-1: the interval join then sees one row per
    call-day instead of every call, which also bounds a hot account.
    ``call_filter`` (customer / date scoping) is applied to single calls,
    before the top-1."""
    mc = sources["MEMBER_CALL_DATA"]
    xref = sources["CALLTYPE_XREF_VW"]
    eligible_types = (xref.filter((F.col("PPPY_BILL_ELIG") == "Y") | (F.col("INTERACTION_ELIG") == "Y"))
                      .select(norm(F.col("CALL_DESCRIPTIONS")).alias("__type")).distinct())
    calls = (mc.filter((F.upper("CALL_STATUS") == R.SUCCESSFUL_STATUS)
                       & F.upper("DIRECTION").isin(*R.CALL_DIRECTIONS)
                       & ~norm(F.col("DESCRIPTION")).isin(*R.EXCLUDED_CALL_TYPES))
             .select("ACCOUNT",
                     F.coalesce("DERIVED_GUID", "GUID").alias("GUID"),
                     "CUSTOMERID",
                     F.trim("DESCRIPTION").alias("CALL_TYPE"),
                     F.to_date("ENCOUNTERDATETIME").alias("CALL_DATE"),
                     "ENCOUNTERDATETIME",
                     norm(F.col("DESCRIPTION")).alias("__type")))
    if call_filter is not None:
        calls = calls.filter(call_filter)
    calls = calls.join(eligible_types, "__type", "left_semi")
    latest = latest_per_group(
        calls, DAY_KEY,
        [F.desc_nulls_last("ENCOUNTERDATETIME"), F.asc_nulls_last("CALL_TYPE"),
         F.asc_nulls_last("GUID"), F.asc_nulls_last("CUSTOMERID")])
    enrolled = within_interval(latest, enrollment, "ACCOUNT", "CALL_DATE",
                               "BIEFFECTIVEDATE", "BIENDDATE")
    return enrolled.select(*CALL_DAY_COLUMNS)


def guid_bridge(calls: DataFrame, elig: DataFrame) -> DataFrame:
    """Distinct (GUID, CURRENTGUID) pairs for the GUIDs that have calls."""
    call_guids = calls.select("GUID").distinct()
    return (elig.join(call_guids, "GUID", "left_semi")
            .select("GUID", "CURRENTGUID").distinct())


def _answers(notes: DataFrame, questions: list[str]) -> DataFrame:
    return (notes.filter(F.col("QUESTION_ID").isin(*questions))
            .withColumn("TOPIC_DATE", F.to_date("RESPONSE_DATE")))


def lm_daily(sources: dict[str, DataFrame]) -> DataFrame:
    """Topic-form answers cut to (ACCOUNT, day, text) with count and latest time."""
    answers = _answers(sources["COACH_NOTES_WORKFLOW"], R.LM_TOPIC_QUESTIONS)
    return daily_counts(answers, "ACCOUNT", "TOPIC_DATE", "RESPONSE_TEXT", "RESPONSE_DATE")


def lm_topics(daily: DataFrame) -> DataFrame:
    """One topic-form answer per account-day, most frequent answer wins."""
    return frequency_tiebreak(daily, "ACCOUNT", "TOPIC_DATE", "RESPONSE_TEXT", count_col="__n")


def dm_topics(sources: dict[str, DataFrame]) -> DataFrame:
    """P5: the same for the DM focus question."""
    answers = _answers(sources["COACH_NOTES_WORKFLOW_DM"], [R.DM_TOPIC_QUESTION])
    return frequency_tiebreak(answers, "ACCOUNT", "TOPIC_DATE", "RESPONSE_TEXT")


def _as_call_day(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("TOPIC_DATE", "CALL_DATE")


def stack_by_day(tables: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """One row per call-day with the given columns of all tables, each of which holds
    at most one row per call-day: the tables are stacked and brought together once,
    where a chain of joins would bring each together with all before it. Columns of
    a table without that day are null."""
    kinds = {c: df.schema[c].dataType for df, columns in tables for c in columns}
    stacked = [df.select(*DAY_KEY, *[(F.col(c) if c in columns else F.lit(None).cast(kind)).alias(c)
                                     for c, kind in kinds.items()]) for df, columns in tables]
    return (reduce(DataFrame.unionByName, stacked).repartition(*DAY_KEY).groupBy(*DAY_KEY)
            .agg(*[F.first(c, ignorenulls=True).alias(c) for c in kinds]))


def direct_answers(calls: DataFrame, lm: DataFrame, dm: DataFrame) -> DataFrame:
    """Call-days (``__call`` holds the call's columns) with the day's LM and DM answers."""
    rest = [c for c in CALL_DAY_COLUMNS if c not in DAY_KEY]
    return stack_by_day([
        (calls.select(*DAY_KEY, F.struct(*rest).alias("__call")), ["__call"]),
        (_as_call_day(lm).withColumnRenamed("RESPONSE_TEXT", "__lm"), ["__lm"]),
        (_as_call_day(dm).withColumnRenamed("RESPONSE_TEXT", "__dm0"), ["__dm0"]),
    ]).filter(F.col("__call").isNotNull())


def calls_without_direct_topic(days: DataFrame) -> DataFrame:
    """Call-days with neither an LM nor a DM answer on that day."""
    return (days.filter(F.col("__lm").isNull() & F.col("__dm0").isNull())
            .select(*DAY_KEY, "__call.*").select(*CALL_DAY_COLUMNS))


def usable_text(col: Column) -> Column:
    """not null, more than two characters once trimmed, not a filler."""
    return (col.isNotNull() & (F.length(F.trim(col)) > R.MIN_TEXT_LENGTH)
            & ~norm(col).isin(*R.JUNK_TEXTS))


def note_topic(text: Column) -> Column:
    """Keyword topic of a free-text note, null when nothing matches."""
    return first_match(by_keywords(F.upper(text), R.NOTE_KEYWORDS), None)


def _fallback_days(no_tier1: DataFrame) -> DataFrame:
    """Unresolved call-days whose call type does not decide the topic."""
    return (no_tier1.filter(~norm(F.col("CALL_TYPE")).isin(*R.TIER2_CALL_TYPES))
            .select(*DAY_KEY))


def inferred_text_topics(sources: dict[str, DataFrame], no_tier1: DataFrame) -> DataFrame:
    """P7 (tier 1.5): keyword topic from detail / goal notes on the call-day.

    Candidates are ranked per (ACCOUNT, day) first (detail text, then long-term
    goal, then DM goal; ties by topic), then kept for the fallback days only.
    Ranking first lets the partial top-1 shrink the notes before the shuffle."""
    lm = sources["COACH_NOTES_WORKFLOW"]
    dm = sources["COACH_NOTES_WORKFLOW_DM"]
    text = F.col("RESPONSE_TEXT")
    from_lm = (lm.filter(F.col("QUESTION_ID").isin(R.DETAIL_QUESTION, R.LONG_TERM_GOAL_QUESTION)
                         & usable_text(text))
               .select("ACCOUNT", F.to_date("RESPONSE_DATE").alias("TOPIC_DATE"),
                       note_topic(text).alias("INFERRED_TOPIC"),
                       F.when(F.col("QUESTION_ID") == R.DETAIL_QUESTION,
                              R.TEXT_SOURCE_PRIORITY[R.DETAIL_QUESTION])
                       .otherwise(R.TEXT_SOURCE_PRIORITY[R.LONG_TERM_GOAL_QUESTION])
                       .alias("SRC_PRI")))
    from_dm = (dm.filter((F.col("QUESTION_ID") == R.DM_GOAL_QUESTION) & usable_text(text))
               .select("ACCOUNT", F.to_date("RESPONSE_DATE").alias("TOPIC_DATE"),
                       F.lit(R.DM_TOPIC).alias("INFERRED_TOPIC"),
                       F.lit(R.TEXT_SOURCE_PRIORITY[R.DM_GOAL_QUESTION]).alias("SRC_PRI")))
    candidates = from_lm.unionByName(from_dm).filter(F.col("INFERRED_TOPIC").isNotNull())
    best = latest_per_group(candidates, ["ACCOUNT", "TOPIC_DATE"],
                            [F.asc("SRC_PRI"), F.asc("INFERRED_TOPIC")])
    days = _fallback_days(no_tier1).withColumnRenamed("CALL_DATE", "TOPIC_DATE")
    return (best.join(days, ["ACCOUNT", "TOPIC_DATE"], "left_semi")
            .select("ACCOUNT", "TOPIC_DATE", "INFERRED_TOPIC"))


def prior_topics(daily: DataFrame, no_tier1: DataFrame, text_topics: DataFrame) -> DataFrame:
    """P8 (tier 3): the latest topic-form answer (null text included) within the
    180 days before the call-day, for fallback days without a tier-1.5 topic.
    ``daily`` is ``lm_daily``: its latest time per (day, text) yields the
    same latest answer as the raw rows."""
    days = unresolved(_fallback_days(no_tier1), _as_call_day(text_topics), on=DAY_KEY)
    return asof_within(days, daily, "ACCOUNT", "CALL_DATE", "TOPIC_DATE", "__last",
                       "RESPONSE_TEXT", R.PRIOR_LOOKBACK_DAYS, "PRIOR_RESPONSE_TEXT")


def answer_category(col: Column, default: str | None) -> Column:
    """Topic-form answer (upper case, untrimmed) to category."""
    return first_match(by_equality(F.upper(col), R.ANSWER_CATEGORIES), default)


def assemble_topics(days: DataFrame, text_topics: DataFrame, prior: DataFrame,
                    bridge: DataFrame | None) -> DataFrame:
    """One topic per call-day through the ordered cascade.

    ``days`` is ``direct_answers``; the other tiers, each with at most one row
    per call-day, are stacked on it, so one aggregate per call-day holds what
    every tier says. Only the GUID bridge can fan out (several CURRENTGUIDs for
    one GUID)."""
    j = stack_by_day([
        (days, ["__call", "__lm", "__dm0"]),
        (_as_call_day(text_topics).withColumnRenamed("INFERRED_TOPIC", "__gt0"), ["__gt0"]),
        (prior.withColumnRenamed("PRIOR_RESPONSE_TEXT", "__pt0"), ["__pt0"]),
    ]).filter(F.col("__call").isNotNull()).select(*DAY_KEY, "__call.*", "__lm", "__dm0", "__gt0", "__pt0")
    lm_, has_lm = F.col("__lm"), F.col("__lm").isNotNull()
    # The DM answer only counts when there is no LM answer that day, even an
    # unmapped one; text and prior tiers only when neither exists.
    dm_ = F.when(~has_lm, F.col("__dm0"))
    gt_ = F.when(~has_lm & dm_.isNull(), F.col("__gt0"))
    pt_ = F.when(~has_lm & dm_.isNull() & gt_.isNull(), F.col("__pt0"))
    call_type = norm(F.col("CALL_TYPE"))

    report_topic = first_match(
        by_equality(F.upper(lm_), R.ANSWER_CATEGORIES)
        + [(dm_.isNotNull(), R.DM_TOPIC), (gt_.isNotNull(), gt_)]
        + by_equality(call_type, R.CALL_TYPE_TOPICS)
        + [(pt_.isNotNull(), answer_category(pt_, R.DEFAULT_TOPIC))],
        R.DEFAULT_TOPIC)
    topic_source = first_match([
        (has_lm, R.TIER_LM), (dm_.isNotNull(), R.TIER_DM), (gt_.isNotNull(), R.TIER_TEXT),
        (call_type.isin(*R.TIER2_CALL_TYPES), R.TIER_CALL_TYPE),
        (pt_.isNotNull(), R.TIER_PRIOR)], R.TIER_NONE)
    program = first_match([(has_lm, R.PROGRAM_LM), (dm_.isNotNull(), R.PROGRAM_DM)], None)

    topics = j.select(*CALL_DAY_COLUMNS,
                      F.coalesce(lm_, dm_).alias("RAW_TOPIC"),
                      report_topic.alias("REPORT_TOPIC"),
                      topic_source.alias("TOPIC_SOURCE"),
                      program.alias("PROGRAM_TYPE"))
    if bridge is None:
        return topics.select(*[c for c in TOPIC_COLUMNS if c != "CURRENTGUID"])
    return topics.join(bridge, "GUID", "left").select(*TOPIC_COLUMNS)


def tobacco_flag(topics: DataFrame) -> DataFrame:
    """P10 (C9): distinct members whose call-day answer or call type is tobacco."""
    member = [c for c in ("ACCOUNT", "GUID", "CURRENTGUID") if c in topics.columns]
    return (topics.filter((F.upper("RAW_TOPIC") == R.TOBACCO_WORD)
                          | (F.upper("CALL_TYPE") == R.TOBACCO_WORD))
            .select(*member, F.lit("Yes").alias("TOBACCO_DISCUSSED")).distinct())


def goal_domain(name: Column) -> Column:
    """C11 + C12: domain from the prefix before ':', else (colon-less names
    only) from keywords, else Other."""
    prefix = F.upper(prefix_before(name, R.GOAL_SEPARATOR))
    keyword_domain = first_match(by_keywords(F.upper(name), R.GOAL_KEYWORDS), R.OTHER_DOMAIN)
    return first_match(by_equality(prefix, R.GOAL_PREFIXES)
                       + [(~name.contains(R.GOAL_SEPARATOR), keyword_domain)],
                       R.OTHER_DOMAIN)


def goals_classified(sources: dict[str, DataFrame]) -> DataFrame:
    """Kept member actions with type, domain, status and description."""
    ma = sources["AH_MEMBER_ACTION"]
    name = F.col("Action_Name")
    kept = ma.filter(F.col("ActionType_ID").isin(*[c for c, _ in R.GOAL_TYPES])
                     & F.col("ActionStatus_ID").isin(*R.KEPT_GOAL_STATUS_IDS))
    for pattern in R.EXCLUDED_GOAL_PATTERNS:
        kept = kept.filter(~name.like(pattern))
    return kept.select(
        "ACCOUNT",
        by_code(F.col("ActionType_ID"), R.GOAL_TYPES).alias("GOAL_TYPE"),
        goal_domain(name).alias("GOAL_DOMAIN"),
        by_code(F.col("ActionStatus_ID"), R.GOAL_STATUSES).alias("GOAL_STATUS"),
        F.when(name.contains(R.GOAL_SEPARATOR), text_after(name, R.GOAL_SEPARATOR))
        .otherwise(name).alias("GOAL_DESCRIPTION"),
        name.alias("RAW_ACTION_NAME"),
        F.col("MemberAction_ID").cast("long").alias("MEMBERACTION_ID"),
        F.col("ActionType_ID").cast("long").alias("ACTIONTYPE_ID"),
        F.col("ActionStatus_ID").cast("long").alias("ACTIONSTATUS_ID"),
        F.col("FocusArea_ID").cast("long").alias("FOCUSAREA_ID"),
        F.col("Action_Date").alias("GOAL_SET_DATE"),
        F.col("Close_Date").alias("GOAL_CLOSE_DATE"),
    )


def goals_numbered(goals: DataFrame, enrollment_rows: DataFrame) -> DataFrame:
    """Goals of accounts with an enrollment row, bridged to the latest
    row's members and numbered per account by set date, then name.

    An account's goals are numbered by months of their set date, and a crowded
    month by slices of it: goals are counted per slice, the counts (a few rows
    an account) are summed up to each slice and joined with the latest
    enrollment row, and the goals meet that by slice. So the goals are shuffled
    once, accounts without enrollment drop out there, and a hot account is
    spread over tasks even where all its goals were set on one day."""
    latest = latest_per_group(
        enrollment_rows.select("ACCOUNT", "CURRENTGUID", "GUID", "BIENDDATE"), ["ACCOUNT"],
        [F.desc_nulls_last("BIENDDATE"), F.asc_nulls_last("GUID"),
         F.asc_nulls_last("CURRENTGUID")]).select("ACCOUNT", "CURRENTGUID", "GUID")
    month = F.coalesce(F.date_format("GOAL_SET_DATE", "yyyyMM"), F.lit("999999"))  # null dates last
    order = ["GOAL_SET_DATE", "RAW_ACTION_NAME", "MEMBERACTION_ID"]
    numbered = number_in_group(goals, ["ACCOUNT"], [F.asc_nulls_last(c) for c in order], "GOAL_NUMBER",
                               bucket=month, groups=latest, slice_by=order)
    return numbered.select(*GOAL_COLUMNS, "CURRENTGUID", "GUID", "GOAL_NUMBER")


def active_enrollment(sources: dict[str, DataFrame], as_of: dt.date | str) -> DataFrame:
    """Ad-hoc goal bridge rows: any status, still active on ``as_of``."""
    ce = sources["COACHING_ENROLLMENT_MODEL"]
    return ce.filter(F.col("BIENDDATE") >= F.lit(str(as_of)).cast("date"))


def build(sources: dict[str, DataFrame], as_of: dt.date | str, variant: str = "refresh",
          call_filter: Column | None = None, reuse: bool = True) -> dict[str, DataFrame]:
    """All steps of one variant, as lazy DataFrames keyed by step name.

    Steps read by several later steps (call-days, daily answers, tier
    tables) are persisted (memory, spilling to disk) when ``reuse`` is set:
    otherwise each branch of the plan would recompute them, because column
    pruning makes the branches' sub-plans differ and defeats exchange reuse.
    All of them hold at most one row per account-day (or per account-day-
    answer), a small fraction of the raw calls and notes. Cached blocks lost
    with an executor are recomputed from lineage. ``release(out)`` frees them.
    """
    if variant not in ("refresh", "adhoc"):
        raise ValueError(f"unknown variant {variant!r}")
    out: dict[str, DataFrame] = {}
    cached: list[DataFrame] = []

    def shared(df: DataFrame) -> DataFrame:
        if not reuse:
            return df
        cached.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    if variant == "refresh":
        out["enrolled"] = enrolled_population(sources)
        call_enrollment = out["enrolled"]
    else:
        ce = sources["COACHING_ENROLLMENT_MODEL"]
        call_enrollment = ce.filter(is_enrolled(ce))
    # Cached: the reductions that sit directly on a raw-table scan. Cheap
    # derivations of them (LM top-1, unresolved days) are recomputed.
    out["calls"] = shared(calls_one_per_day(sources, call_enrollment, call_filter))
    daily = shared(lm_daily(sources))
    out["lm"] = shared(lm_topics(daily))
    out["dm"] = shared(dm_topics(sources))
    days = shared(direct_answers(out["calls"], out["lm"], out["dm"]))
    out["no_tier1"] = calls_without_direct_topic(days)
    out["text_topics"] = shared(inferred_text_topics(sources, out["no_tier1"]))
    out["prior"] = prior_topics(daily, out["no_tier1"], out["text_topics"])
    bridge = None
    if variant == "refresh":
        bridge = out["bridge"] = guid_bridge(out["calls"], sources["ELIGMEMBER"])
    out["topics"] = assemble_topics(days, out["text_topics"], out["prior"], bridge)
    out["tobacco"] = tobacco_flag(out["topics"])
    out["goals"] = goals_classified(sources)
    goal_rows = out["enrolled"] if variant == "refresh" else active_enrollment(sources, as_of)
    out["goals_numbered"] = goals_numbered(out["goals"], goal_rows)
    out["_cached"] = cached  # type: ignore[assignment]
    return out


def release(out: dict[str, DataFrame]) -> None:
    """Unpersist the intermediates a ``build`` cached."""
    for df in out.get("_cached", []):  # type: ignore[union-attr]
        df.unpersist()
