"""Small literal source tables for case tests."""

from __future__ import annotations

import datetime as dt

from tierwise.sources.binding import CALLTYPE_XREF_ROWS
from tierwise.sources.schemas import SOURCE_SCHEMAS

D = dt.date
T = dt.datetime


def sources(spark, calls=(), notes=(), dm=(), enrollment=None, elig=None, actions=(),
            xref=CALLTYPE_XREF_ROWS):
    """Source tables from tuples in schema order. Default enrollment: accounts
    A1..A3 enrolled 1998-01-01..1998-12-31 (member Mn, GUID Gn); default elig
    maps Gn -> Mn."""
    if enrollment is None:
        enrollment = [(f"A{i}", f"M{i}", f"G{i}", "CUST_A", "X", "Enrolled", "Enrolled",
                       D(1998, 1, 1), D(1998, 12, 31)) for i in (1, 2, 3)]
    if elig is None:
        elig = [(f"G{i}", f"M{i}", "ORG", "CUST_A") for i in (1, 2, 3)]
    rows = {"MEMBER_CALL_DATA": calls, "CALLTYPE_XREF_VW": xref,
            "COACHING_ENROLLMENT_MODEL": enrollment, "ELIGMEMBER": elig,
            "COACH_NOTES_WORKFLOW": notes, "COACH_NOTES_WORKFLOW_DM": dm,
            "AH_MEMBER_ACTION": actions}
    return {name: spark.createDataFrame(list(r), SOURCE_SCHEMAS[name]) for name, r in rows.items()}


def call(account, day, desc="Lifestyle", guid=None, hour=10, customer="CUST_A"):
    """A successful outbound call of ``account`` on ``day``."""
    guid = guid or "G" + account[1:]
    return (account, guid, None, customer, desc, T(day.year, day.month, day.day, hour),
            "Successful", "Outbound")


def note(account, day, question, text, hour=9):
    return (account, question, T(day.year, day.month, day.day, hour), text)


def action(account, ident, name, status=3, type_=2, day=D(1998, 3, 1)):
    return (account, ident, type_, status, 0, name, day, None)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
