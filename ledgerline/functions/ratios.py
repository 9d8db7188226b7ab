"""Exact ratios with half-away-from-zero rounding, as the reference's NUMERIC math.

Every helper works on integers only (counts, day sums, money in cents held as
DECIMAL(38,0)), so the result does not depend on floating point and equals the
DuckDB oracle bit for bit: ``q = (2*|num|*scale + |den|) div (2*|den|)`` with
the sign restored, then ``q / 10^digits`` in DOUBLE (one correctly rounded
division). A zero denominator gives null, like ``NULLIF(den, 0)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _idiv(a: Column, b: Column) -> Column:
    """Integral division of non-negative DECIMAL(38,0) values, as DECIMAL(38,0).

    ``div`` would return a BIGINT and wrap beyond 2^63. The remainder is taken
    off first, so the decimal division is exact (up to 10^32; beyond that ANSI
    mode raises).
    """
    return ((a - a % b) / b).cast(_WIDE)


def scaled_half_up(num, den, factor: int) -> Column:
    """round_half_up(num * factor / den) as an integer (DECIMAL(38,0)); null if den = 0 or null."""
    n = _col(num).cast(_WIDE)
    d = _col(den).cast(_WIDE)
    an, ad = F.abs(n), F.abs(d)
    q = _idiv((an * F.lit(2 * factor)).cast(_WIDE) + ad, F.when(ad != 0, (ad * F.lit(2)).cast(_WIDE)))
    negative = (n < 0) != (d < 0)
    signed = F.when(negative, -q).otherwise(q)
    return F.when(d != 0, signed)


def ratio_half_up(num, den, digits: int = 1, factor: int = 1) -> Column:
    """round_half_up(factor * num / den, digits) as DOUBLE."""
    scale = 10 ** digits
    return (scaled_half_up(num, den, factor * scale).cast("double") / F.lit(float(scale)))


def pct_half_up(num, den, digits: int = 1) -> Column:
    """ROUND(100.0 * num / NULLIF(den, 0), digits) as DOUBLE."""
    return ratio_half_up(num, den, digits, factor=100)


def cents(money) -> Column:
    """A DECIMAL(p,2) amount as an exact integer number of cents (DECIMAL(38,0))."""
    return (_col(money).cast("decimal(38,2)") * F.lit(100)).cast(_WIDE)


def from_cents(c) -> Column:
    """Integer cents back to DECIMAL(38,2)."""
    return (_col(c).cast("decimal(38,2)") / F.lit(100)).cast("decimal(38,2)")


def money_avg_half_up(sum_cents, count) -> Column:
    """ROUND(AVG(money), 2) from a cent sum and a count, as DECIMAL(38,2)."""
    return from_cents(scaled_half_up(sum_cents, count, 1))


def avg_half_up(total, count, digits: int = 1) -> Column:
    """ROUND(AVG(x), digits) of an integer column from its sum and count, as DOUBLE."""
    return ratio_half_up(total, count, digits)


def money(c) -> Column:
    """Money output type used by every job: DECIMAL(38,2)."""
    return _col(c).cast("decimal(38,2)")
