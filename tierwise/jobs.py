"""Command-line jobs (run with spark-submit or ``python -m tierwise.jobs``).

    refresh        build the month and load the three snapshot tables
    workbook       ad-hoc build (optionally one customer / date range) -> 8 sections
    dashboard      5 dashboard sections over one month's snapshots
    period-report  period reports and comparisons for one customer
    sweep          remove folders that killed runs left in the shared folder

Sources are catalog tables (``--table NAME=catalog.table``, default: the
source names) or, with ``--sf-dir``, the test binding over the driver's
parquet files. The session comes from the platform (``getOrCreate``); its
``spark.checkpoint.dir`` must name shared storage.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from .functions.columns import report_filter
from .plans import monthly as M
from .plans.cascade import release
from .session import shared_dir
from .sources import snapshots as S
from .sources.binding import load_sources, read_warehouse
from .sources.ledger import sweep


def _date(text: str | None) -> dt.date | None:
    return dt.date.fromisoformat(text) if text else None


def _sources(spark: SparkSession, args: argparse.Namespace):
    if args.sf_dir:
        return load_sources(spark, args.sf_dir)
    names = dict(item.split("=", 1) for item in args.table or [])
    return read_warehouse(spark, names or None)


def _snapshots(spark: SparkSession, root: str, month: str | None, customer: str | None = None):
    return M.snapshot(spark, root, None if month == "all" else month or "latest", customer)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tierwise.jobs")
    ap.add_argument("job", choices=["refresh", "workbook", "dashboard", "period-report", "sweep"])
    ap.add_argument("--as-of", help="run date (replaces the clock)")
    ap.add_argument("--root", help="snapshot tables folder (shared storage)")
    ap.add_argument("--out", help="report output folder")
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--customer")
    ap.add_argument("--start")
    ap.add_argument("--end")
    ap.add_argument("--month", help="snapshot month yyyyMM, or all (default: latest)")
    ap.add_argument("--keep-fep", action="store_true",
                    help="count FEP members as enrolled (customers outside that programme)")
    ap.add_argument("--keep-runs", type=int, help="refresh: remove all but the last N runs of every month")
    ap.add_argument("--older-than-hours", type=float, default=72, help="sweep: least age of a folder")
    ap.add_argument("--sf-dir", help="test binding over the driver's parquet files")
    ap.add_argument("--table", action="append", help="NAME=catalog.table for a source")
    args = ap.parse_args(argv)

    if args.job != "sweep" and not (args.as_of and args.root):
        ap.error("--as-of and --root are required")

    spark = SparkSession.builder.getOrCreate()
    shared_dir(spark)
    if args.job == "sweep":
        print("\n".join(sweep(spark, args.older_than_hours)))
        return
    as_of = dt.date.fromisoformat(args.as_of)
    if args.job == "refresh":
        M.run_refresh(spark, _sources(spark, args), args.root, as_of, keep_runs=args.keep_runs)
        return
    if not args.out:
        ap.error("--out is required for report jobs")
    adhoc: dict = {}
    if args.job == "workbook":
        scope = None
        if args.customer or args.start or args.end:
            scope = report_filter(args.customer, args.start, args.end, case_sensitive=True)
        adhoc = M.run_adhoc(_sources(spark, args), as_of, scope)
        sections = M.workbook(adhoc)
    elif args.job == "dashboard":
        sections = M.dashboard(_snapshots(spark, args.root, args.month))
    else:
        if not args.customer:
            ap.error("--customer is required for period-report")
        snap = _snapshots(spark, args.root, args.month, args.customer)
        sections = M.period_report(spark, _sources(spark, args), snap, args.customer, as_of,
                                   _date(args.start), _date(args.end), not args.keep_fep)
    cached = sections.pop("_cached", [])
    try:
        S.write_report(sections, args.out, args.format)
    finally:
        release({"_cached": cached})
        M.close_adhoc(adhoc)


if __name__ == "__main__":
    main()
