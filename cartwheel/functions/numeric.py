"""Numeric helpers: engine-independent rounding, safe ratios, money text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(c) -> Column:
    """Cast to DOUBLE (money is summed as DECIMAL and converted once, at the end)."""
    return _col(c).cast("double")


def round_half_up(c, digits: int = 2) -> Column:
    """ROUND(x, n) as ``floor(x * 10^n + 0.5) / 10^n`` on a DOUBLE.

    Built-in ROUND rounds the decimal representation in one engine and the
    binary value in another, so results drift apart on ties such as 1.005;
    this form is plain IEEE arithmetic and gives the same bits everywhere.
    It rounds the binary value half toward +infinity (1.005 is stored as
    1.00499999... and gives 1.0; 0.125 gives 0.13; -0.125 gives -0.12).
    From 2^52 on a DOUBLE scaled this way has no fraction left, and the value
    is returned as it is: FLOOR gives a BIGINT, which such values may exceed.
    """
    scale = float(10 ** digits)
    x = as_double(c)
    return F.when(F.abs(x * F.lit(scale)) >= F.lit(2.0 ** 52), x).otherwise(
        F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale))


def ratio(num, den) -> Column:
    """num / den in DOUBLE, NULL when den is 0 or NULL (MySQL semantics, no ANSI error)."""
    return as_double(num) / F.nullif(as_double(den), F.lit(0.0))


def pct_of(part, whole, digits: int = 2) -> Column:
    """ROUND(part / whole * 100, digits) with a NULL for a zero whole."""
    return round_half_up(ratio(part, whole) * F.lit(100.0), digits)


def money_text(c, digits: int = 2) -> Column:
    """'$1,234,567.89'-style text for display tables."""
    return F.concat(F.lit("$"), F.format_number(as_double(c), digits))
