"""Column builders: rule lists -> Catalyst expressions, exact percentages,
ranks for display orders, report filters and report text formats.

Everything returns a ``Column`` built from ``pyspark.sql.functions`` only, so
it stays inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrValue = Column | str | int | float | None


def _lit(value: ColumnOrValue) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def first_match(rules: Iterable[tuple[Column, ColumnOrValue]],
                default: ColumnOrValue = None) -> Column:
    """Ordered ``CASE WHEN``: the value of the first rule whose test is true."""
    expr = None
    for test, value in rules:
        expr = F.when(test, _lit(value)) if expr is None else expr.when(test, _lit(value))
    if expr is None:
        return _lit(default)
    return expr.otherwise(_lit(default))


def contains_any(col: Column, words: Sequence[str]) -> Column:
    """True when ``col`` contains any of ``words`` (``LIKE '%w%'`` each)."""
    test = None
    for w in words:
        hit = col.contains(w)
        test = hit if test is None else (test | hit)
    return test if test is not None else F.lit(False)


def by_equality(col: Column, groups: Sequence[tuple[str, Sequence[str]]]
                ) -> list[tuple[Column, str]]:
    """Rules ``col IN (values) -> label`` for each (label, values) group."""
    return [(col.isin(*values), label) for label, values in groups]


def by_keywords(col: Column, groups: Sequence[tuple[str, Sequence[str]]]
                ) -> list[tuple[Column, str]]:
    """Rules ``col contains any keyword -> label`` for each group."""
    return [(contains_any(col, words), label) for label, words in groups]


def by_code(col: Column, pairs: Sequence[tuple[int, str]]) -> Column:
    """Code -> label; unknown codes give null."""
    return first_match([(col == code, label) for code, label in pairs])


def prefix_before(col: Column, sep: str) -> Column:
    """Text before the first ``sep`` (the whole text when there is none)."""
    return F.split_part(col, F.lit(sep), F.lit(1))


def text_after(col: Column, sep: str) -> Column:
    """Trimmed text after the first ``sep``; later separators are kept."""
    return F.trim(F.substr(col, F.instr(col, sep) + 1))


def norm(col: Column) -> Column:
    """Upper case of the trimmed text, the job's comparison form."""
    return F.upper(F.trim(col))


def pct(n: ColumnOrValue, d: ColumnOrValue, scale: int) -> Column:
    """``ROUND(n * 100 / d, scale)`` computed exactly, half up; null when d = 0.

    Counts are integers and never negative, so the quotient is formed in
    integer arithmetic: ``floor((200 * 10^s * n + d) / (2 d)) / 10^s``.
    """
    n_, d_ = _lit(n).cast("long"), F.nullif(_lit(d).cast("long"), F.lit(0))
    unit = 10 ** scale
    num = n_ * (200 * unit) + d_
    den = d_ * 2
    return ((num - num % den) / den) / F.lit(float(unit))


def rank_by(col: Column, order: Sequence[str]) -> Column:
    """Position (1-based) of ``col`` in ``order``; len(order)+1 otherwise."""
    return first_match([(col == v, i + 1) for i, v in enumerate(order)], len(order) + 1)


def between_dates(col: Column, start: str | dt.date | None,
                  end: str | dt.date | None) -> Column:
    test = F.lit(True)
    if start is not None:
        test = test & (col >= F.lit(str(start)).cast("date"))
    if end is not None:
        test = test & (col <= F.lit(str(end)).cast("date"))
    return test


def report_filter(customer: str | None = None, start: str | dt.date | None = None,
                  end: str | dt.date | None = None, *, date_col: str = "CALL_DATE",
                  customer_col: str = "CUSTOMERID", case_sensitive: bool = False
                  ) -> Column:
    """Customer and inclusive date-range predicate, built from literals."""
    test = between_dates(F.col(date_col), start, end)
    if customer is not None:
        if case_sensitive:
            test = test & (F.col(customer_col) == F.lit(customer))
        else:
            test = test & (F.upper(F.col(customer_col)) == F.upper(F.lit(customer)))
    return test


def thousands(col: Column) -> Column:
    """Integer text with thousands separators, e.g. 12,345."""
    return F.format_number(col, 0)


def signed_thousands(col: Column, sign_of: Column | None = None) -> Column:
    """``+n`` for a positive change, ``n`` otherwise, with separators.

    ``sign_of`` gives the change the sign is taken from where ``col`` is a
    rounded form of it: a change of +1 shown in thirds reads ``+0``."""
    raw = col if sign_of is None else sign_of
    return F.when(raw > 0, F.concat(F.lit("+"), thousands(col))).otherwise(thousands(col))


def percent_text(col: Column) -> Column:
    """One-decimal percentage text, e.g. 45.5%; null stays null."""
    return F.when(col.isNotNull(), F.format_string("%.1f%%", col))


def thirds(col: Column) -> Column:
    """Monthly average of a 90-day count: round(x / 3) (thirds never tie)."""
    return F.round(col / 3).cast("long")
