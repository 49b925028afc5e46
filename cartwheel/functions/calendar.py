"""Calendar helpers matching the MySQL / pandas functions the questions use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_key(ts) -> Column:
    """DATE_FORMAT(ts, '%Y-%m') / pandas ``to_period('M')`` as text: '2011-03'."""
    return F.date_format(_col(ts), "yyyy-MM")


def month_index(ts) -> Column:
    """Months since year 0 (year*12 + month-1); differences give PERIOD_DIFF."""
    c = _col(ts)
    return (F.year(c) * F.lit(12) + F.month(c) - F.lit(1)).cast("bigint")


def period_diff(later_ts, earlier_ts) -> Column:
    """PERIOD_DIFF(yyyymm(later), yyyymm(earlier)): whole calendar months between."""
    return month_index(later_ts) - month_index(earlier_ts)


def calendar_days(end, start) -> Column:
    """MySQL DATEDIFF(end, start): midnights crossed, as BIGINT."""
    return F.datediff(_col(end), _col(start)).cast("bigint")


def elapsed_days(end, start) -> Column:
    """pandas ``(end - start).days``: whole 24-hour periods elapsed (floored)."""
    return F.timestamp_diff("DAY", _col(start), _col(end)).cast("bigint")


def day_name(ts) -> Column:
    """DAYNAME(ts): full English weekday name ('Wednesday')."""
    return F.date_format(_col(ts), "EEEE")
