"""Source loading.

``load_sources`` returns the seven source tables as DataFrames. In
production they are warehouse tables read by name; for tests and the bench
they are derived from the driver's TPC-H-like parquet files by a fixed,
deterministic mapping (described in FIXTURES.md). Every expression is a
built-in column function, so the derivation is one scan + projection per
table, with the join to ``orders`` planned by Catalyst.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import SOURCE_SCHEMAS, conform

# ---------------------------------------------------------------------------
# Fixed values of the test binding (FIXTURES.md §2). Index i is picked by a
# modulo of a key column.
# ---------------------------------------------------------------------------
CALL_DESCRIPTIONS = ["Tobacco", "Dietary Referral", "Specialty", "Clinical ",
                     "Engagement", "Survey - Follow Up"]
CALL_DESCRIPTION_OTHER = " Lifestyle"
CALLTYPE_XREF_ROWS = [
    ("Tobacco ", "Y", "N"), ("Dietary Referral", "Y", "Y"), ("specialty", "N", "Y"),
    ("Clinical", "Y", "N"), ("Lifestyle", "Y", "Y"), ("LIFESTYLE", "Y", "Y"),
    ("Engagement", "Y", "Y"), ("Survey - Follow Up", "N", "N"),
]
LM_QUESTION_BY_SUPP6 = ["502533", "502758", "502534", "502833", "502534", "999999"]
FORM_V1_ANSWERS = ["Exercise", "Healthy Eating", "Weight", "Stress", "Tobacco",
                   "Other", "Other - physical/social", "Unmapped answer"]
FORM_V2_ANSWERS = ["Physical activity", "Nutrition/Weight management",
                   "Mental well-being", "Restorative sleep",
                   "Positive social connections", "Avoidance of risky substances"]
NOTE_TEXTS = ["wants to lose 10 lbs", "go for a run daily", "likes to run",
              "less anxiety", "sleep 8 hours", "quit eating junk food", "lower A1C",
              "quit smoking", "N/A", " - ", "ok", None, "call back later",
              "feels great", "walking to lose weight", "inactive lately"]
DM_QUESTION_BY_SUPP2 = ["502599", "502616"]
DM_FOCUS_ANSWERS = ["Diabetes", "Asthma", "CAD", "COPD"]
ACTION_NAMES = [
    "Exercise: walk 3x", "NUTRITION: more greens", "[Nutrition]: greens",
    "Weight: lose 5: slowly", "Tobacco: quit", "STRESS: breathe", "Sleep: 8h",
    "[*CARE GAPS]: pcp", "Diabetes: check", "BP: monitor", "Work Item: call",
    "SAVINGS: plan", "Social Wellness: club", "Spiritual Health: rest",
    "WATER: 8 cups", "Get cholesterol screening annually", "Do strengthening twice",
    "Eat less sugar", "Lower your BMI", "Stop smoking", "Limit alcohol",
    "Improve sleep habits", "Take statin daily", "Attend the academy", "Read a book",
    "Exercise", "Survey: intake", "RED: x", "RED/ y", "exericse: typo", None,
]
ENROLLMENT_EPOCH = "1995-01-01"
ENROLLMENT_SPAN_DAYS = 900
# ---------------------------------------------------------------------------


def pick(index: Column, values: Sequence[str | None]) -> Column:
    """``values[index]`` for a 0-based integer column (null past the end)."""
    return F.try_element_at(F.array(*[F.lit(v).cast("string") for v in values]),
                            (index + 1).cast("int"))


#: The staged table that holds all tables made from order lines.
LINES = "LINES"
#: A question that no step of the cascade reads.
OTHER_QUESTION = "777777"


def _member(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), (key - key % 5).cast("string"))


def _customer(segment: Column) -> Column:
    return F.when(segment.isin("BUILDING", "MACHINERY"), "CUST_A").otherwise("cust_b")


def _plus_minutes(ts: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes, ts)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The seven source tables, bound to the driver's parquet files."""
    return _member_sources(spark, sf_dir) | _line_sources(_lines(spark, sf_dir))


def _conformed(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: conform(df, SOURCE_SCHEMAS[name]) for name, df in tables.items()}


def _member_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Calls, call types, enrollment and eligibility.

    Joins of whole tables here and in ``_lines`` name the merge join, so they move
    the same share of their rows at every size, small tables included."""
    customer = _read(spark, sf_dir, "customer")
    orders = _read(spark, sf_dir, "orders")

    ck, ok = F.col("c_custkey"), F.col("o_custkey")
    cust = _customer(F.col("c_mktsegment"))

    calls = orders.join(customer.hint("merge"), ok == ck).select(
        _member("A", ok).alias("ACCOUNT"),
        F.concat(F.lit("G"), ok.cast("string")).alias("GUID"),
        F.when(ok % 10 == 7, F.concat(F.lit("G"), (ok - 1).cast("string")))
        .alias("DERIVED_GUID"),
        cust.alias("CUSTOMERID"),
        F.coalesce(pick(F.col("o_orderkey") % 11, CALL_DESCRIPTIONS),
                   F.lit(CALL_DESCRIPTION_OTHER)).alias("DESCRIPTION"),
        _plus_minutes(F.col("o_orderdate"), F.col("o_orderkey") % 1440)
        .alias("ENCOUNTERDATETIME"),
        F.when(F.col("o_orderstatus") == "P", "Unsuccessful").otherwise("Successful")
        .alias("CALL_STATUS"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Inbound")
        .when(F.col("o_orderpriority") == "2-HIGH", "Internal")
        .otherwise("outbound").alias("DIRECTION"),
    )

    xref = spark.createDataFrame(CALLTYPE_XREF_ROWS, SOURCE_SCHEMAS["CALLTYPE_XREF_VW"])

    start = F.date_add(F.lit(ENROLLMENT_EPOCH).cast("date"), (ck % 1500).cast("int"))
    enrollment = customer.select(
        _member("A", ck).alias("ACCOUNT"),
        _member("M", ck).alias("CURRENTGUID"),
        F.concat(F.lit("G"), ck.cast("string")).alias("GUID"),
        cust.alias("CUSTOMERID"),
        F.col("c_mktsegment").alias("OFFERING_NAME"),
        F.when(ck % 6 == 5, "Engaged").otherwise("Enrolled").alias("LEVEL_NAME"),
        F.when(ck % 9 == 8, "Closed").otherwise("Enrolled").alias("OFFERING_STATUS"),
        start.alias("BIEFFECTIVEDATE"),
        F.date_add(start, ENROLLMENT_SPAN_DAYS).alias("BIENDDATE"),
    )

    # Every 23rd customer has a GUID that no call carries, so its calls miss the bridge.
    elig = customer.select(
        F.concat(F.when(ck % 23 == 22, "N").otherwise("G"), ck.cast("string")).alias("GUID"),
        _member("M", ck).alias("CURRENTGUID"),
        F.when(ck % 50 == 10, "xFep01").otherwise("ORG").alias("ORGUNITID"),
        cust.alias("CUSTOMERID"),
    )

    return _conformed({"MEMBER_CALL_DATA": calls, "CALLTYPE_XREF_VW": xref,
                       "COACHING_ENROLLMENT_MODEL": enrollment, "ELIGMEMBER": elig})


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their order's customer and date: what notes and actions are made from."""
    orders = _read(spark, sf_dir, "orders").hint("merge")
    return _read(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def _line_columns() -> dict[str, list[Column]]:
    """Coach notes and member actions as columns of ``_lines``, one row a line each."""
    ok = F.col("o_custkey")
    pk, sk, ln = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    supp6 = sk % 6
    # Lines beyond those that answer a question of the cascade answer another one.
    lm_notes = [
        _member("A", ok).alias("ACCOUNT"),
        F.when((pk % 4 != 3) | (ln == 1), pick(supp6, LM_QUESTION_BY_SUPP6))
        .otherwise(OTHER_QUESTION).alias("QUESTION_ID"),
        _plus_minutes(F.when(ln % 2 == 1, F.col("o_orderdate"))
                      .otherwise(F.col("l_shipdate")), pk % 1440).alias("RESPONSE_DATE"),
        F.when(supp6 == 0, pick(pk % 8, FORM_V1_ANSWERS))
        .when(supp6 == 1, pick(pk % 6, FORM_V2_ANSWERS))
        .otherwise(pick(pk % 16, NOTE_TEXTS)).alias("RESPONSE_TEXT"),
    ]

    dm_question = pick(sk % 2, DM_QUESTION_BY_SUPP2)
    dm_notes = [
        _member("A", ok).alias("ACCOUNT"),
        F.when(pk % 9 == 0, dm_question).otherwise(OTHER_QUESTION).alias("QUESTION_ID"),
        _plus_minutes(F.col("o_orderdate"), pk % 1440).alias("RESPONSE_DATE"),
        F.when(sk % 2 == 0, pick(pk % 4, DM_FOCUS_ANSWERS))
        .otherwise(pick(pk % 16, NOTE_TEXTS)).alias("RESPONSE_TEXT"),
    ]

    ship = F.col("l_shipdate").cast("date")
    # Lines after an order's second are actions of types that are no goals.
    actions = [
        _member("A", ok).alias("ACCOUNT"),
        ((((F.col("l_orderkey") * 10 + ln) * 100000 + pk) * 10000) + sk)
        .alias("MemberAction_ID"),
        F.when(ln <= 2, 1 + sk % 4).otherwise(4 + sk % 4).alias("ActionType_ID"),
        (1 + pk % 5).alias("ActionStatus_ID"),
        (sk % 12).alias("FocusArea_ID"),
        pick(pk % 31, ACTION_NAMES).alias("Action_Name"),
        ship.alias("Action_Date"),
        F.when(pk % 5 >= 2, F.date_add(ship, 30)).alias("Close_Date"),
    ]

    return {"COACH_NOTES_WORKFLOW": lm_notes, "COACH_NOTES_WORKFLOW_DM": dm_notes, "AH_MEMBER_ACTION": actions}


def _line_sources(lines: DataFrame) -> dict[str, DataFrame]:
    return _conformed({name: lines.select(*columns) for name, columns in _line_columns().items()})


def _staged_name(table: str, column: str) -> str:
    """A line has one account in all tables; the DM notes share their other names with the LM notes."""
    return f"DM__{column}" if table == "COACH_NOTES_WORKFLOW_DM" and column != "ACCOUNT" else column


def _line_tables(tables: Iterable[str]) -> dict[str, list[Column]]:
    return {name: columns for name, columns in _line_columns().items() if name in tables}


def _staged_lines(lines: DataFrame, tables: Iterable[str]) -> DataFrame:
    """The named tables made from ``lines`` side by side."""
    made = _line_tables(tables)
    wide = lines.select(*[F.struct(*columns).alias(table) for table, columns in made.items()])
    stored = {_staged_name(table, f.name): F.col(table)[f.name].cast(f.dataType)
              for table in made for f in SOURCE_SCHEMAS[table].fields}
    return wide.select(*[column.alias(name) for name, column in stored.items()])


def stage_sources(spark: SparkSession, sf_dir: str, root: str,
                  tables: Iterable[str] = tuple(SOURCE_SCHEMAS)) -> dict[str, DataFrame]:
    """Writes the bound sources (all or the named ones) once as parquet under ``root``
    (a shared folder) and returns them read back: every later scan is a plain parquet
    scan with pushed filters and pruned columns, as with warehouse tables.

    Notes and actions are made from the same joined lines, so they are written side
    by side by one job, where three tables would take three joins of every line."""
    for name, df in _member_sources(spark, sf_dir).items():
        if name in tables:
            df.write.mode("overwrite").parquet(f"{root}/{name}")
    if _line_tables(tables):
        _staged_lines(_lines(spark, sf_dir), tables).write.mode("overwrite").parquet(f"{root}/{LINES}")
    return read_staged(spark, root, tables)


def read_staged(spark: SparkSession, root: str,
                tables: Iterable[str] = tuple(SOURCE_SCHEMAS)) -> dict[str, DataFrame]:
    beside = {}
    if made := _line_tables(tables):
        lines = spark.read.parquet(f"{root}/{LINES}")
        beside = {table: lines.select(*[F.col(_staged_name(table, c)).alias(c) for c in SOURCE_SCHEMAS[table].names])
                  for table in made}
    return beside | {name: spark.read.schema(schema).parquet(f"{root}/{name}")
                     for name, schema in SOURCE_SCHEMAS.items() if name in tables and name not in beside}


def read_warehouse(spark: SparkSession, names: dict[str, str] | None = None
                   ) -> dict[str, DataFrame]:
    """Production form: the seven sources as catalog tables (name -> table)."""
    names = names or {n: n for n in SOURCE_SCHEMAS}
    return {n: conform(spark.table(t), SOURCE_SCHEMAS[n]) for n, t in names.items()}
