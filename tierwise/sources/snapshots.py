"""Month-keyed snapshot tables (S2, S4-S6) and report export.

A refresh writes its three tables into a folder of its own run and then adds one
record to the store's log. Records are numbered: a run takes the number after the
last one, and the number is taken by creating its file, which fails if another run
was faster. Readers take each month's tables from the record with the highest
number, so no clock decides, the three tables of a month are always from one run, a
failed run changes nothing, a re-run replaces the month, and an empty table reads as
empty, as does a store that was never loaded. ``prune`` removes superseded runs.

Topics are laid out by customer and day (range partitions, sorted), with the upper
case customer as a column of its own, so a report of one customer skips the files
and pages of all others.

Tables live under a folder the whole cluster can reach. The log rests on exclusive
creation of files, which HDFS and local file systems give.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from . import files
from .schemas import OUTPUT_SCHEMAS, conform

TOPICS, TOBACCO, GOALS = "COACHING_CALL_TOPICS", "COACHING_CALL_TOBACCO", "COACHING_CALL_GOALS"
MONTH_COL = "REPORT_MONTH"
RUNS, LOG = "runs", "log"
RECORD_SCHEMA = (f"VERSION long, {MONTH_COL} string, RUN string, AS_OF string, "
                 "TABLES map<string, struct<ROWS: long, SECONDS: double>>")
#: Stored beside the columns of a clustered table: what reports of one customer filter by.
CUSTOMER_KEY = "CUSTOMER_KEY"
CLUSTERED = {TOPICS: [CUSTOMER_KEY, "CALL_DATE", "ACCOUNT"]}


def report_month(as_of: dt.date) -> str:
    return as_of.strftime("%Y%m")


def stamp(df: DataFrame, as_of: dt.date, refreshed: dt.datetime | None = None) -> DataFrame:
    """REFRESH_DATE (one value per run) and REPORT_MONTH columns."""
    ts = refreshed or dt.datetime.combine(as_of, dt.time())
    # From text: a Python datetime literal is an instant and would move with
    # the session time zone; the column is a wall-clock time.
    return (df.withColumn("REFRESH_DATE", F.lit(ts.isoformat(" ")).cast("timestamp_ntz"))
            .withColumn(MONTH_COL, F.date_format(F.lit(as_of), "yyyyMM")))


def _clustered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Range partitions of the customer key and what follows it, so that a customer
    with many rows spans several, each sorted."""
    keyed = rows.withColumn(CUSTOMER_KEY, F.upper("CUSTOMERID"))
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order)


def write_run(tables: dict[str, DataFrame], root: str, as_of: dt.date, run: str,
              refreshed: dt.datetime | None = None) -> dict[str, dict[str, float]]:
    """This month's rows of some tables, into the folder of ``run``; rows and seconds of each.

    Nothing reads them before the run is published."""
    done = {}
    for table, df in tables.items():
        began, seen = time.monotonic(), Observation()
        rows = conform(stamp(df, as_of, refreshed), OUTPUT_SCHEMAS[table])
        if table in CLUSTERED:
            rows = _clustered(rows, CLUSTERED[table])
        (rows.observe(seen, F.count(F.lit(1)).alias("rows"))
         .write.mode("errorifexists").parquet(_run_path(root, run, table)))
        done[table] = {"ROWS": seen.get["rows"], "SECONDS": round(time.monotonic() - began, 3)}
    return done


def publish(spark: SparkSession, root: str, as_of: dt.date, run: str,
            tables: dict[str, dict[str, float]] | None = None) -> int:
    """One small record, written last, makes a run's tables the month's tables; returns its number.

    All tables of a month are read through the same record, so they are from
    one run; a run that fails before this leaves the month as it was."""
    while True:
        version = max((int(name.partition(".")[0]) for name in files.listed(spark, f"{root}/{LOG}")),
                      default=0) + 1
        record = json.dumps({"VERSION": version, MONTH_COL: report_month(as_of), "RUN": run,
                             "AS_OF": as_of.isoformat(), "TABLES": tables or {}})
        if files.create_new(spark, f"{root}/{LOG}/{version:012d}.json", record + "\n"):
            return version


def new_run(as_of: dt.date) -> str:
    return f"{report_month(as_of)}-{uuid.uuid4().hex}"


def load_month(spark: SparkSession, tables: dict[str, DataFrame], root: str, as_of: dt.date,
               refreshed: dt.datetime | None = None) -> str:
    """Replace the month's rows of the given tables, all at once; returns the run."""
    run = new_run(as_of)
    publish(spark, root, as_of, run, write_run(tables, root, as_of, run, refreshed))
    return run


def run_log(spark: SparkSession, root: str) -> DataFrame:
    """Every published run: number, month, folder, and rows and seconds of each table."""
    if not files.listed(spark, f"{root}/{LOG}"):
        return spark.createDataFrame([], RECORD_SCHEMA)
    # a record that is still being written has no run yet
    return spark.read.schema(RECORD_SCHEMA).json(f"{root}/{LOG}").filter(F.col("RUN").isNotNull())


def published_runs(spark: SparkSession, root: str) -> dict[str, str]:
    """Month -> the run published last for it, from the log alone (one row a load)."""
    rows = run_log(spark, root).groupBy(MONTH_COL).agg(F.max_by("RUN", "VERSION").alias("RUN")).collect()
    return {r[MONTH_COL]: r["RUN"] for r in sorted(rows)}


def prune(spark: SparkSession, root: str, keep: int = 1, unfinished_hours: float | None = None) -> list[str]:
    """Removes the tables of runs that ``keep`` later runs of their month supersede.

    With ``unfinished_hours`` also those of runs that were never published and
    began so long ago. Records stay in the log. Returns the runs removed."""
    if keep < 1:
        raise ValueError("the last run of a month is always kept")
    months: dict[str, list[tuple[int, str]]] = {}
    for r in run_log(spark, root).select(MONTH_COL, "VERSION", "RUN").collect():
        months.setdefault(r[MONTH_COL], []).append((r["VERSION"], r["RUN"]))
    kept = {run for runs in months.values() for _, run in sorted(runs)[-keep:]}
    known = {run for runs in months.values() for _, run in runs}
    there = files.listed(spark, f"{root}/{RUNS}")
    gone = [run for run, changed in there.items() if run not in kept and (
        run in known or unfinished_hours is not None and time.time() - changed >= 3600 * unfinished_hours)]
    for run in gone:
        files.delete(spark, f"{root}/{RUNS}/{run}")
    return sorted(gone)


def _run_path(root: str, run: str, table: str) -> str:
    return f"{root}/{RUNS}/{run}/{table}"


def _read(spark: SparkSession, table: str, paths: list[str], customer: str | None = None) -> DataFrame:
    schema = OUTPUT_SCHEMAS[table]
    if not paths:
        return spark.createDataFrame([], schema)
    if customer is None or table not in CLUSTERED:
        return spark.read.schema(schema).parquet(*paths)
    stored = StructType([*schema.fields, StructField(CUSTOMER_KEY, StringType())])
    return (spark.read.schema(stored).parquet(*paths)
            .filter(F.col(CUSTOMER_KEY) == F.upper(F.lit(customer))).select(*schema.names))


def read_run(spark: SparkSession, root: str, run: str, table: str) -> DataFrame:
    return _read(spark, table, [_run_path(root, run, table)])


def read_snapshots(spark: SparkSession, root: str, month: str | None = "latest",
                   tables: Sequence[str] = (TOPICS, TOBACCO, GOALS),
                   customer: str | None = None) -> dict[str, DataFrame]:
    """The snapshot tables of one month, or of every month (``month=None``).

    The month is resolved once for all tables: ``'latest'`` is the newest month
    that was loaded, also where a table of it is empty. A month that was never
    loaded reads as empty. ``customer`` (in any case) cuts clustered tables to
    its rows, by a filter that reaches their files' statistics."""
    runs = published_runs(spark, root)
    if month == "latest":
        month = max(runs, default="")
    chosen = [run for m, run in runs.items() if month is None or m == month]
    return {table: _read(spark, table, [_run_path(root, run, table) for run in chosen], customer)
            for table in tables}


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Writes ``df`` once as parquet under ``path`` (shared storage) and returns
    it read back: cuts the lineage with a single computation (an eager
    reliable ``checkpoint()`` of an uncached plan computes it twice)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_report(sections: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> None:
    """One named result set per report section."""
    for name, df in sections.items():
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer = writer.option("header", "true")
        writer.format(fmt).save(f"{out_dir}/{name}")
