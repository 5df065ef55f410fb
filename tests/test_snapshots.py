"""Month-keyed snapshot tables: idempotent loads, empty months, typed reads."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from tierwise.sources import snapshots as S
from tierwise.sources.schemas import OUTPUT_SCHEMAS

JUNE, JULY = dt.date(1998, 6, 15), dt.date(1998, 7, 15)


def topics(spark, n):
    return spark.createDataFrame(
        [(f"A{i}", f"G{i}", f"M{i % 2}", "C", dt.date(1998, 6, 1), "Lifestyle", None, "General",
          "Tier 4: None", None) for i in range(n)],
        "ACCOUNT string, GUID string, CURRENTGUID string, CUSTOMERID string, CALL_DATE date, "
        "CALL_TYPE string, RAW_TOPIC string, REPORT_TOPIC string, TOPIC_SOURCE string, "
        "PROGRAM_TYPE string")


def load(spark, root, n, as_of, tobacco=0):
    t = topics(spark, n)
    flags = spark.createDataFrame([("G", "Yes")] * tobacco, "GUID string, TOBACCO_FLAG string")
    return S.load_month(spark, {S.TOPICS: t, S.TOBACCO: conform_like(spark, flags, S.TOBACCO),
                                S.GOALS: conform_like(spark, None, S.GOALS)}, root, as_of)


def conform_like(spark, df, table):
    schema = OUTPUT_SCHEMAS[table]
    if df is None:
        return spark.createDataFrame([], schema)
    n = df.count()
    return spark.createDataFrame([tuple(None for _ in schema.fields)] * n, schema)


def months(df):
    return sorted((r[0], r[1]) for r in df.groupBy("REPORT_MONTH").count().collect())


def test_month_reload_is_idempotent_and_typed(spark):
    root = tempfile.mkdtemp(prefix="tw-snap-")
    load(spark, root, 3, JUNE)
    load(spark, root, 3, JULY)
    load(spark, root, 3, JULY)
    df = S.read_snapshots(spark, root, None)[S.TOPICS]
    assert df.schema == OUTPUT_SCHEMAS[S.TOPICS]
    assert months(df) == [("199806", 3), ("199807", 3)]
    # month=None reads every month: counts double, distinct members do not.
    agg = df.agg(F.count(F.lit(1)), F.countDistinct("CURRENTGUID")).first()
    assert tuple(agg) == (6, 2)
    assert S.read_snapshots(spark, root)[S.TOPICS].count() == 3          # latest month only
    assert S.read_snapshots(spark, root, "199806")[S.TOPICS].count() == 3
    assert S.read_snapshots(spark, root, "199901")[S.TOPICS].count() == 0
    refreshed = S.read_snapshots(spark, root)[S.TOPICS].first()["REFRESH_DATE"]
    assert refreshed == dt.datetime(1998, 7, 15)


def test_empty_tables_belong_to_their_month(spark):
    root = tempfile.mkdtemp(prefix="tw-snap-")
    load(spark, root, 2, JUNE, tobacco=1)
    load(spark, root, 4, JULY, tobacco=0)
    got = S.read_snapshots(spark, root)
    assert (got[S.TOPICS].count(), got[S.TOBACCO].count()) == (4, 0)
    load(spark, root, 0, JULY)
    assert S.read_snapshots(spark, root)[S.TOPICS].count() == 0
    assert months(S.read_snapshots(spark, root, None)[S.TOPICS]) == [("199806", 2)]


def test_a_run_that_fails_between_tables_changes_nothing(spark):
    root = tempfile.mkdtemp(prefix="tw-snap-")
    load(spark, root, 2, JULY)
    S.write_run({S.TOPICS: topics(spark, 9)}, root, JULY, S.new_run(JULY))  # never published
    assert S.read_snapshots(spark, root)[S.TOPICS].count() == 2


def test_a_store_never_loaded_reads_as_empty(spark):
    root = tempfile.mkdtemp(prefix="tw-snap-") + "/none"
    for month in ("latest", "199806", None):
        got = S.read_snapshots(spark, root, month, customer=None)
        assert {t: (df.schema, df.count()) for t, df in got.items()} == {
            t: (schema, 0) for t, schema in OUTPUT_SCHEMAS.items()}
    assert S.run_log(spark, root).count() == 0 and S.prune(spark, root) == []


def test_a_clock_that_runs_back_cannot_win(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="tw-snap-")
    for n, clock in ((2, 2e9), (5, 1e9), (4, 1.5e9)):
        monkeypatch.setattr(S.time, "time", lambda c=clock: c)
        monkeypatch.setattr(S.time, "time_ns", lambda c=clock: int(c * 1e9))
        load(spark, root, n, JULY)
        assert S.read_snapshots(spark, root)[S.TOPICS].count() == n
    log = {r["VERSION"]: r["TABLES"][S.TOPICS]["ROWS"] for r in S.run_log(spark, root).collect()}
    assert log == {1: 2, 2: 5, 3: 4}


def test_a_number_is_taken_once(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="tw-snap-")
    load(spark, root, 1, JULY)
    listed, calls = S.files.listed, []

    def late(spark, path):  # two runs that both saw an empty log
        calls.append(path)
        return {} if len(calls) == 1 else listed(spark, path)
    monkeypatch.setattr(S.files, "listed", late)
    assert S.publish(spark, root, JULY, "other") == 2
    monkeypatch.undo()
    assert sorted(r["VERSION"] for r in S.run_log(spark, root).collect()) == [1, 2]


def test_a_record_half_written_is_not_published(spark):
    root = tempfile.mkdtemp(prefix="tw-snap-")
    load(spark, root, 3, JULY)
    assert S.files.create_new(spark, f"{root}/{S.LOG}/{2:012d}.json", '{"VERSION": 2, "REPORT')
    assert S.read_snapshots(spark, root)[S.TOPICS].count() == 3
    load(spark, root, 4, JULY)
    assert S.read_snapshots(spark, root)[S.TOPICS].count() == 4


def test_superseded_runs_are_removed(spark):
    root = tempfile.mkdtemp(prefix="tw-snap-")
    runs = [load(spark, root, n, day) for n, day in ((1, JUNE), (2, JULY), (3, JULY), (4, JULY))]
    left = S.new_run(JULY)
    S.write_run({S.TOPICS: topics(spark, 9)}, root, JULY, left)
    assert S.prune(spark, root, keep=2) == [runs[1]]
    assert S.prune(spark, root) == [runs[2]] and S.prune(spark, root) == []
    assert months(S.read_snapshots(spark, root, None)[S.TOPICS]) == [("199806", 1), ("199807", 4)]
    assert S.prune(spark, root, unfinished_hours=1) == []
    assert S.prune(spark, root, unfinished_hours=0) == [left]
    assert set(S.files.listed(spark, f"{root}/{S.RUNS}")) == {runs[0], runs[3]}


def rows_read(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


def test_a_report_of_one_customer_reads_its_rows_only(spark):
    root = tempfile.mkdtemp(prefix="tw-snap-")
    n, customers = 40000, 20
    t = (spark.range(n).repartition(8)
         .selectExpr("cast(id as string) as ACCOUNT", "'g' as GUID", "'m' as CURRENTGUID",
                     f"if(id % 3 = 0, 'Cust_0', concat('CUST_', id % {customers})) as CUSTOMERID",
                     "date_add(date'1998-01-01', cast(id % 180 as int)) as CALL_DATE", "'Lifestyle' as CALL_TYPE",
                     "'r' as RAW_TOPIC", "'General' as REPORT_TOPIC", "'s' as TOPIC_SOURCE", "'p' as PROGRAM_TYPE"))
    with_conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in with_conf}
    try:
        for k, v in with_conf.items():
            spark.conf.set(k, v)
        S.load_month(spark, {S.TOPICS: t}, root, JULY)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for customer in ("cust_7", "CUST_0"):
        got = S.read_snapshots(spark, root, tables=[S.TOPICS], customer=customer)[S.TOPICS]
        assert got.schema == OUTPUT_SCHEMAS[S.TOPICS]
        want = t.filter(F.upper("CUSTOMERID") == customer.upper()).count()
        read = rows_read(got)
        assert got.count() == want and want <= read <= want + 2 * n / 8
    hot_month = S.read_snapshots(spark, root, tables=[S.TOPICS], customer="cust_0")[S.TOPICS].filter(
        F.col("CALL_DATE") < dt.date(1998, 1, 20))
    assert rows_read(hot_month) < want  # the large customer spans files, by day
    assert rows_read(S.read_snapshots(spark, root, tables=[S.TOPICS])[S.TOPICS].filter("upper(CUSTOMERID) = 'CUST_7'")) == n


def test_write_report_sections(spark):
    out = tempfile.mkdtemp(prefix="tw-report-")
    sections = {"a": topics(spark, 2), "b": topics(spark, 1).select("ACCOUNT", "GUID")}
    S.write_report(sections, out)
    S.write_report(sections, out + "/csv", fmt="csv")
    assert spark.read.parquet(f"{out}/a").count() == 2
    assert spark.read.option("header", "true").csv(f"{out}/csv/b").columns == ["ACCOUNT", "GUID"]


def test_read_warehouse_conforms(spark):
    from tierwise.sources.binding import read_warehouse
    from tierwise.sources.schemas import SOURCE_SCHEMAS
    for name, schema in SOURCE_SCHEMAS.items():
        spark.createDataFrame([], schema).createOrReplaceTempView(f"wh_{name}")
    got = read_warehouse(spark, {n: f"wh_{n}" for n in SOURCE_SCHEMAS})
    assert {n: df.schema for n, df in got.items()} == SOURCE_SCHEMAS


def test_refresh_date_ignores_session_time_zone(spark):
    root = tempfile.mkdtemp(prefix="tw-snap-")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        load(spark, root, 1, JULY)
        got = S.read_snapshots(spark, root)[S.TOPICS].first()["REFRESH_DATE"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == dt.datetime(1998, 7, 15)
