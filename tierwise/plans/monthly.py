"""Job entry points: the monthly refresh (cascade -> month snapshots), the
ad-hoc workbook build, and the report bundles that read their results.

Reports never re-run the cascade: the refresh writes the three snapshot
tables once and the dashboard / period reports read them back (with
partition pruning on the month), as the source job's reports read its
persistent tables. The ad-hoc build is written once as session tables in
the cluster's shared folder and read back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import snapshots as S
from ..sources.ledger import RunFolders
from . import periods as P
from . import reports as RP
from .cascade import TOPIC_COLUMNS, active_enrollment, build, goals_classified, goals_numbered, release, tobacco_flag


def run_refresh(spark: SparkSession, sources: dict[str, DataFrame], root: str,
                as_of: dt.date, refreshed: dt.datetime | None = None,
                keep_runs: int | None = None) -> dict[str, DataFrame]:
    """The monthly job: build, load this month's snapshots, return them read back.

    Tobacco flags are derived from the topics just written, so the cascade
    runs once for both tables. ``keep_runs`` removes older runs of every month
    but the last so many."""
    refreshed = refreshed or dt.datetime.combine(as_of, dt.time())
    out = build(sources, as_of, "refresh")
    run = S.new_run(as_of)
    try:
        done = S.write_run({S.TOPICS: out["topics"], S.GOALS: out["goals_numbered"]}, root, as_of, run, refreshed)
        topics = S.read_run(spark, root, run, S.TOPICS)
        done |= S.write_run({S.TOBACCO: tobacco_flag(topics.select(*TOPIC_COLUMNS))}, root, as_of, run, refreshed)
    finally:
        release(out)
    S.publish(spark, root, as_of, run, done)
    if keep_runs is not None:
        S.prune(spark, root, keep_runs)
    return snapshot(spark, root, S.report_month(as_of))


def snapshot(spark: SparkSession, root: str, month: str | None = "latest",
             customer: str | None = None) -> dict[str, DataFrame]:
    """The three snapshot tables of a month (or of every month) by step name;
    with ``customer``, its topics only."""
    got = S.read_snapshots(spark, root, month, customer=customer)
    return {"topics": got[S.TOPICS], "tobacco": got[S.TOBACCO], "goals_numbered": got[S.GOALS]}


#: The tables of the ad-hoc build that share steps, and so are built together.
ADHOC_TOPICS, ADHOC_GOALS = ("topics", "tobacco"), ("goals_numbered",)


def run_adhoc(sources: dict[str, DataFrame], as_of: dt.date,
              call_filter: Column | None = None, root: str | None = None,
              tables: Sequence[str] = ADHOC_TOPICS + ADHOC_GOALS) -> dict[str, DataFrame]:
    """The workbook build (ad-hoc variant), written once as session tables
    and read back, so the eight sections never re-run the cascade.

    ``tables`` names those wanted; topics and goals share no step, so either is
    built without the other. Goals are written before they are numbered, which
    reads them three times.

    The tables lie under ``root``, or in a folder of the run's own, which
    ``close_adhoc`` removes once the sections are written (the end of the
    application does otherwise)."""
    spark = next(iter(sources.values())).sparkSession
    folders = None if root else RunFolders(spark, "adhoc")
    root = root or folders.root
    res = {}
    if set(ADHOC_TOPICS) & set(tables):
        out = build(sources, as_of, "adhoc", call_filter)
        res["topics"] = S.materialize(out["topics"], f"{root}/topics")
        res["tobacco"] = S.materialize(tobacco_flag(res["topics"]), f"{root}/tobacco")
        release(out)
    if set(ADHOC_GOALS) & set(tables):
        goals = S.materialize(goals_classified(sources), f"{root}/goals-classified")
        res["goals_numbered"] = S.materialize(
            goals_numbered(goals, active_enrollment(sources, as_of)), f"{root}/goals")
    return res | {"_folders": folders}


def close_adhoc(out: dict[str, DataFrame]) -> None:
    """Removes the tables of an ad-hoc build that lie in a folder of its own."""
    if out.get("_folders") is not None:
        out["_folders"].close()


def _desc(col: str) -> Column:
    return F.desc(col)


def _metric_rank() -> Column:
    return RP.rank_by(F.col("METRIC"), RP.R.TOBACCO_METRICS)


VALIDATION_ORDER = [label for label, _ in RP.VALIDATION_SECTIONS] + ["TOBACCO", "GOALS"]


def _period_rank() -> Column:
    return RP.rank_by(F.col("PERIOD"), P.PERIOD_NAMES)


# Display order of every report (O1-O5): the source job's ORDER BY, plus the
# label as a final tie-break. Applied by ``present``; the comparisons and
# checks are order-insensitive.
ORDERS: dict[str, list] = {
    "out_topics_summary": [lambda: _desc("CALLS"), "CALL_TOPIC"],
    "out_tier_breakdown": [lambda: _desc("CALLS"), "TOPIC_SOURCE"],
    "out_tobacco_summary": [lambda: RP.yes_no_order()],
    "out_goal_type_domain": [lambda: RP.domain_order(), "GOAL_DOMAIN"],
    "out_goal_domain_status": [lambda: RP.domain_order(), "GOAL_DOMAIN"],
    "out_goal_number_status": ["GOAL_NUMBER"],
    "out_goal_type_status": ["GOAL_TYPE"],
    "out_validation_counts": [lambda: RP.rank_by(F.col("SECTION"), VALIDATION_ORDER)],
    "dash_engagement_by_topic": [lambda: _desc("MEMBERS"), "WELLBEING_TOPIC"],
    "dash_goal_status_by_topic": [lambda: _desc("COMPLETED"), "WELLBEING_TOPIC"],
    "dash_goal_status_distribution": [lambda: RP.status_order()],
    "dash_goal_progression": [lambda: RP.domain_order(), "GOAL_DOMAIN"],
    "dash_tobacco_focus": [lambda: _metric_rank()],
    "period_tobacco": [_period_rank, lambda: _metric_rank()],
    "period_tobacco_classic": [lambda: RP.yes_no_order()],
    "cmp_tobacco": [lambda: _metric_rank()],
    "kpi_headlines": [lambda: RP.rank_by(F.col("KPI"), P.KPI_LABELS)],
    "period_engagement": [_period_rank, lambda: _desc("MEMBERS"), "WELLBEING_TOPIC"],
    "period_goal_distribution": [_period_rank, lambda: RP.status_order()],
    "period_goal_distribution_goals": [_period_rank, lambda: RP.status_order()],
    "period_goal_progression": [_period_rank, lambda: RP.domain_order(), "GOAL_DOMAIN"],
    "enrolled_members_by_period": [_period_rank],
    "period_topics_classic": [lambda: _desc("CALLS"), "CALL_TOPIC"],
    "period_goal_domain_status": [lambda: RP.domain_order(short=True), "GOAL_DOMAIN"],
    "cmp_goal_status": [lambda: RP.status_order()],
    "cmp_engagement": [lambda: _desc("MONTH"), "WELLBEING_TOPIC"],
    "cmp_goal_progression": [lambda: RP.domain_order(), "GOAL_DOMAIN"],
}


def present(key: str, df: DataFrame) -> DataFrame:
    """``df`` sorted in the report's display order (unchanged when it has none)."""
    order = ORDERS.get(key)
    if not order:
        return df
    return df.orderBy(*[o() if callable(o) else F.col(o) for o in order])


#: The workbook's sections (R1-R8): the tables each reads, and what it makes of them.
WORKBOOK: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "out_topics_summary": (("topics",), lambda t: RP.topics_summary(t, "GUID", 2)),
    "out_tier_breakdown": (("topics",), RP.tier_breakdown),
    "out_tobacco_summary": (("topics", "tobacco"), RP.tobacco_summary),
    "out_goal_type_domain": (("goals_numbered",), RP.goal_type_domain),
    "out_goal_domain_status": (("goals_numbered",), RP.goal_domain_status),
    "out_goal_number_status": (("goals_numbered",), RP.goal_number_status),
    "out_goal_type_status": (("goals_numbered",), RP.goal_type_status),
    "out_validation_counts": (("topics", "tobacco", "goals_numbered"), RP.validation_counts),
}


def workbook(out: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The workbook sections (R1-R8) whose tables an ad-hoc build holds."""
    return _presented({key: section(*[out[t] for t in tables])
                       for key, (tables, section) in WORKBOOK.items() if set(tables) <= set(out)})


def dashboard(snap: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The five dashboard sections (R9-R13) over one month's snapshots."""
    t, tob, g = snap["topics"], snap["tobacco"], snap["goals_numbered"]
    return _presented({
        "dash_engagement_by_topic": RP.engagement_by_topic(t, g),
        "dash_goal_status_by_topic": RP.goal_status_by_topic(t, g),
        "dash_goal_status_distribution": RP.goal_status_distribution(g),
        "dash_goal_progression": RP.goal_progression(g),
        "dash_tobacco_focus": RP.tobacco_focus(tob, g),
    })


PERIOD_KEYS = {
    "period_engagement": "engagement", "period_goal_distribution": "goal_distribution",
    "period_goal_distribution_goals": "goal_distribution_goals",
    "period_goal_progression": "goal_progression", "period_tobacco": "tobacco",
    "enrolled_members_by_period": "enrolled", "period_topics_classic": "topics_classic",
    "period_tobacco_classic": "tobacco_classic", "period_goal_domain_status": "goal_domain_status",
    "cmp_goal_status": "cmp_goal_status", "cmp_engagement": "cmp_engagement",
    "cmp_goal_progression": "cmp_goal_progression", "cmp_tobacco": "cmp_tobacco",
    "kpi_headlines": "kpi_headlines", "tobacco_goal_gap": "tobacco_goal_gap",
}


def period_report(spark: SparkSession, sources: dict[str, DataFrame], snap: dict[str, DataFrame],
                  customer: str, as_of: dt.date, start: dt.date | None = None,
                  end: dt.date | None = None, exclude_fep: bool = True) -> dict[str, DataFrame]:
    """The period report (R14-R28) for one customer over the snapshots.

    ``exclude_fep`` takes FEP members out of the enrollment counts. The frames
    share persisted pieces, which ``P.release`` (given the "_cached" entry's
    frames) frees once they are written."""
    start, end = P.default_range(as_of, start, end)
    res = P.build_periods(spark, sources, snap, customer, start, end, exclude_fep)
    return _presented({key: res[name] for key, name in PERIOD_KEYS.items()}) | {"_cached": res["_cached"]}


def _presented(sections: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {key: present(key, df) for key, df in sections.items()}
