"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def add_months_clamped(d, months: int) -> Column:
    """Add whole months, day clamped to 28 (X15); unlike ``add_months``, the 31st -> 28th."""
    d = _c(d)
    idx = F.month(d) - 1 + F.lit(months)
    m = F.pmod(idx, F.lit(12))  # floor semantics, also for a negative offset
    year = (F.year(d) + F.call_function("div", idx - m, F.lit(12))).cast("int")
    month = (m + 1).cast("int")
    return F.make_date(year, month, F.least(F.dayofmonth(d), F.lit(28)))


def day_diff(end, start) -> Column:
    """DATE - DATE in whole days as INT (X13); ``-`` on dates would give an interval."""
    return F.datediff(_c(end), _c(start)).cast("int")


def month_start(d) -> Column:
    """DATE_TRUNC('month', d)::DATE."""
    return F.trunc(_c(d), "month")


def quarter_start(d) -> Column:
    """DATE_TRUNC('quarter', d)::DATE."""
    return F.trunc(_c(d), "quarter")
