"""Fixed report parameters of the checks (FIXTURES.md §2): the tables run
1995-2001, so ``today`` is pinned instead of read from the clock."""

from __future__ import annotations

import datetime as dt

from dateutil.relativedelta import relativedelta

AS_OF = dt.date(1998, 7, 15)
REPORT_START = dt.date(1998, 6, 1)
REPORT_END = dt.date(1998, 6, 30)
CUSTOMER = "CUST_A"
CALLS_FILTER_START = dt.date(1998, 1, 1)
CALLS_FILTER_END = dt.date(1998, 12, 31)


def period_bounds(start: dt.date = REPORT_START, end: dt.date = REPORT_END
                  ) -> dict[str, tuple[dt.date, dt.date]]:
    """The five report periods, computed with calendar arithmetic in Python
    (the Spark side computes them with Spark date functions)."""
    return {
        "month": (start, end),
        "prior_month": (start - relativedelta(months=1), start - relativedelta(days=1)),
        "l12m": (start - relativedelta(months=11), end),
        "r90": (end - relativedelta(days=89), end),
        "p90": (end - relativedelta(days=179), end - relativedelta(days=90)),
    }
