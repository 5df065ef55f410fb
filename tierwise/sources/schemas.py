"""Source and output schemas.

Sources carry only the columns the job reads. Outputs are the three
month-keyed snapshot tables; REPORT_MONTH is the partition column and is a
'yyyyMM' string, so snapshots are always read back with these schemas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


S, D, L, I = StringType(), DateType(), LongType(), IntegerType()

SOURCE_SCHEMAS: dict[str, StructType] = {
    "MEMBER_CALL_DATA": _schema(
        ("ACCOUNT", S), ("GUID", S), ("DERIVED_GUID", S), ("CUSTOMERID", S),
        ("DESCRIPTION", S), ("ENCOUNTERDATETIME", TimestampNTZType()),
        ("CALL_STATUS", S), ("DIRECTION", S)),
    "CALLTYPE_XREF_VW": _schema(
        ("CALL_DESCRIPTIONS", S), ("PPPY_BILL_ELIG", S), ("INTERACTION_ELIG", S)),
    "COACHING_ENROLLMENT_MODEL": _schema(
        ("ACCOUNT", S), ("CURRENTGUID", S), ("GUID", S), ("CUSTOMERID", S),
        ("OFFERING_NAME", S), ("LEVEL_NAME", S), ("OFFERING_STATUS", S),
        ("BIEFFECTIVEDATE", D), ("BIENDDATE", D)),
    "ELIGMEMBER": _schema(
        ("GUID", S), ("CURRENTGUID", S), ("ORGUNITID", S), ("CUSTOMERID", S)),
    "COACH_NOTES_WORKFLOW": _schema(
        ("ACCOUNT", S), ("QUESTION_ID", S), ("RESPONSE_DATE", TimestampNTZType()),
        ("RESPONSE_TEXT", S)),
    "COACH_NOTES_WORKFLOW_DM": _schema(
        ("ACCOUNT", S), ("QUESTION_ID", S), ("RESPONSE_DATE", TimestampNTZType()),
        ("RESPONSE_TEXT", S)),
    "AH_MEMBER_ACTION": _schema(
        ("ACCOUNT", S), ("MemberAction_ID", L), ("ActionType_ID", I),
        ("ActionStatus_ID", I), ("FocusArea_ID", I), ("Action_Name", S),
        ("Action_Date", D), ("Close_Date", D)),
}

OUTPUT_SCHEMAS: dict[str, StructType] = {
    "COACHING_CALL_TOPICS": _schema(
        ("ACCOUNT", S), ("GUID", S), ("CURRENTGUID", S), ("CUSTOMERID", S),
        ("CALL_DATE", D), ("CALL_TYPE", S), ("RAW_TOPIC", S), ("REPORT_TOPIC", S),
        ("TOPIC_SOURCE", S), ("PROGRAM_TYPE", S), ("REFRESH_DATE", TimestampNTZType()),
        ("REPORT_MONTH", S)),
    "COACHING_CALL_TOBACCO": _schema(
        ("ACCOUNT", S), ("GUID", S), ("CURRENTGUID", S), ("TOBACCO_DISCUSSED", S),
        ("REFRESH_DATE", TimestampNTZType()), ("REPORT_MONTH", S)),
    "COACHING_CALL_GOALS": _schema(
        ("ACCOUNT", S), ("GOAL_TYPE", S), ("GOAL_DOMAIN", S), ("GOAL_STATUS", S),
        ("GOAL_DESCRIPTION", S), ("RAW_ACTION_NAME", S), ("MEMBERACTION_ID", L),
        ("ACTIONTYPE_ID", L), ("ACTIONSTATUS_ID", L), ("FOCUSAREA_ID", L),
        ("GOAL_SET_DATE", D), ("GOAL_CLOSE_DATE", D), ("CURRENTGUID", S),
        ("GUID", S), ("GOAL_NUMBER", L), ("REFRESH_DATE", TimestampNTZType()),
        ("REPORT_MONTH", S)),
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast ``df`` to ``schema`` (missing columns become null)."""
    cols = []
    for field in schema.fields:
        src = F.col(field.name) if field.name in df.columns else F.lit(None)
        cols.append(src.cast(field.dataType).alias(field.name))
    return df.select(*cols)
