"""Timestamps from text cells (P03): the order of day and month is found once for a whole column.

Cells that read as ISO (``2010-12-01 08:26:00``, also with ``/`` or ``.`` and with a ``T``), with the year last
(``12/1/2010 8:26``, ``1.12.10``, ``12/1/2010 8:26:00 PM``) and with a month's name (``1-Dec-2010``, ``Dec 1, 2010``) may be
mixed in one column.  Only cells of two numbers and a final year leave open which number is the month.
``find_order`` decides that from all cells in one aggregate: a number over 12 in the first place means day first,
in the second place month first.  Where the whole column gives no such evidence, or contradicts itself, and the readings differ,
it raises ``AmbiguousDates`` unless the caller names the order.

Two-digit years are 1969 to 2068.  A cell that is no date in the found order, or no date at all (30 February), is
NULL; blank and NULL cells are NULL.  Times are as written, without a time zone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.sources.once import read_once

# Three fields, of which one may be a month's name, then an optional time with optional seconds and AM or PM.
_CELL = (r"^\s*(\d{1,2}|\d{4}|[A-Za-z]{3,9})[-/.,\s]+(\d{1,2}|[A-Za-z]{3,9})[-/.,\s]+(\d{4}|\d{1,2})"
         r"(?:[T\s]+(\d{1,2}):(\d{2})(?::(\d{2}(?:\.\d{1,6})?))?\s*(?:([AaPp])[.]?[Mm][.]?)?)?\s*$")
_NUMBERS = r"^\s*(\d{1,2})[-/.](\d{1,2})[-/.](?:\d{4}|\d{2})(?!\d)"

# English month names.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

ORDERS = ("month", "day", "each")  # and "none": cells with two numbers and a final year are not read


class AmbiguousDates(ValueError):
    """A column whose cells do not tell the day from the month."""


@dataclass(frozen=True)
class DateEvidence:
    """Counts over a column's cells."""

    cells: int
    year_last: int       # two numbers and a year
    first_over_12: int   # the first number can only be a day
    second_over_12: int  # the second number can only be a day
    open: int            # both readings are possible and differ

    def order(self, column: str = "dates") -> str:
        """``month`` or ``day``, whichever comes first; ``each`` where every cell decides for itself."""
        if self.first_over_12 and not self.second_over_12:
            return "day"
        if self.second_over_12 and not self.first_over_12:
            return "month"
        if not self.open:
            return "each"
        why = "contradict each other" if self.first_over_12 else "give no hint"
        raise AmbiguousDates(
            f"{column}: {self.open} of {self.cells} cells can be read day first or month first, and the others {why} "
            f"({self.first_over_12} need day first, {self.second_over_12} month first); name the order with date_order")


def evidence(df: DataFrame, column: str) -> DateEvidence:
    """Counts from one aggregate over the column alone; cells that are a date in neither reading say nothing."""
    c = F.col("cell")
    # Only what is a number is cast: a cast that fails costs many times one that does not.
    a, b = (F.when(c.rlike(_NUMBERS), F.regexp_extract(c, _NUMBERS, k).try_cast("int")) for k in (1, 2))
    cells = read_once(df, [F.col(column).cast("string").alias("cell")])
    cells = read_once(cells, [c.isNotNull().alias("c"), a.alias("a"), b.alias("b")])
    a, b = F.col("a"), F.col("b")
    r = cells.agg(F.count_if("c").alias("cells"), F.count(a).alias("year_last"), F.count_if(a.between(13, 31) & (b <= 12)).alias("first"),
                  F.count_if(b.between(13, 31) & (a <= 12)).alias("second"), F.count_if((a <= 12) & (b <= 12) & (a != b)).alias("open")).first()
    return DateEvidence(r.cells, r.year_last, r["first"], r.second, r.open)


def find_order(df: DataFrame, column: str, date_order: str | None = None) -> str:
    """The order of a column: the caller's, or the one its cells show."""
    if date_order is not None:
        if date_order not in ORDERS:
            raise ValueError(f"date_order is one of {', '.join(ORDERS)}")
        return date_order
    return evidence(df, column).order(column)


def _read(p: Column, order: str) -> Column:
    """A timestamp from a cell's parts: three fields, hours, minutes, seconds and A or P; NULL where the calendar has none."""
    # Fields that are left out are empty: no cast is tried, as one that fails costs many times one that does not.
    number = lambda k: F.when(p[k].rlike("^[0-9]+$"), p[k].try_cast("int"))
    name = lambda k: F.nullif(F.array_position(F.array(*[F.lit(x) for x in MONTHS]), F.lower(F.substring(p[k], 1, 3))).cast("int"), F.lit(0))
    year = F.when(F.length(p[2]) == 4, number(2)).when(F.length(p[2]) == 2, number(2) + F.when(number(2) < 69, 2000).otherwise(1900))
    hour, half = F.coalesce(number(3), F.lit(0)), F.lower(p[6])
    # With AM or PM the hours are 1 to 12.
    hour = (F.when(half == "", hour).when(~hour.between(1, 12), F.lit(99))
            .when(half == "p", hour % 12 + 12).otherwise(hour % 12))
    seconds = F.coalesce(F.when(p[5] != "", p[5].try_cast("decimal(16,6)")), F.lit(0).cast("decimal(16,6)"))
    at = lambda y, m, d: F.try_make_timestamp_ntz(y, m, d, hour, F.coalesce(number(4), F.lit(0)), seconds)
    month_first, day_first = at(year, number(0), number(1)), at(year, number(1), number(0))
    year_last = {"month": month_first, "day": day_first, "each": F.coalesce(month_first, day_first),
                 "none": F.lit(None).cast("timestamp_ntz")}[order]
    return (F.when(F.length(p[0]) == 4, F.when(p[0].rlike("^[0-9]"), at(number(0), number(1), number(2))))
            .when(p[1].rlike("^[A-Za-z]"), at(year, name(1), number(0))).otherwise(year_last))


def timestamp_of(c: Column, order: str = "month") -> Column:
    """Text cells as TIMESTAMP_NTZ; ``order`` as from ``find_order``.

    Plain ISO cells take one test and one cast; any other cell is taken apart once.
    """
    iso = F.when(c.rlike(r"^\s*\d{4}-"), F.trim(c).try_cast("timestamp_ntz"))  # a bare number or a time of day alone is no date
    # The parts are bound by a lambda, so that the pattern is applied once however often they are used.
    parts = F.when(c.rlike(_CELL), F.split(F.regexp_replace(c, _CELL, r"$1|$2|$3|$4|$5|$6|$7"), r"\|"))
    other = F.transform(F.array(parts), lambda p: F.when(
        p[0].rlike("^[A-Za-z]"), _read(F.concat(F.array(p[1], p[0]), F.slice(p, 3, 5)), order)).otherwise(_read(p, order)))
    return F.coalesce(iso, F.element_at(other, 1))
