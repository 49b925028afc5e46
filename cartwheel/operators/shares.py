"""Share-of-total and top-k-with-rank operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.numeric import pct_of


def with_share_of_total(df: DataFrame, value: str, out: str, digits: int = 2,
                        total_of: DataFrame | None = None, total_value: str | None = None) -> DataFrame:
    """Add ROUND(value / total * 100, digits) for a frame of any size.

    ``SUM(..) OVER ()`` would move every row to one partition; instead the
    total is a scalar subquery over a global aggregate (partial sums per input
    partition, evaluated once).  ``total_of``/``total_value`` let the total
    come from another frame, e.g. the input lines themselves, which costs one
    partial-sum pass instead of re-aggregating the grain.
    """
    src = df if total_of is None else total_of
    total = src.agg(F.sum(total_value or value)).scalar()
    return df.withColumn(out, pct_of(F.col(value), total, digits))


def with_share_small(df: DataFrame, value: str, out: str, digits: int = 2) -> DataFrame:
    """ROUND(value / SUM(value) OVER () * 100, digits) for a frame whose size is
    bounded by a code list or a calendar (segments, countries, deciles, months).

    The window moves those few aggregated rows to one partition, and the
    frame is computed once, so nothing upstream is re-derived for the total.
    """
    total = F.sum(F.col(value)).over(Window.partitionBy())
    return df.withColumn(out, pct_of(F.col(value), total, digits))


def top_k_with_rank(df: DataFrame, k: int, value: str, tiebreak: list[str],
                    rank_col: str, dense: bool = False) -> DataFrame:
    """ORDER BY value DESC LIMIT k plus RANK()/DENSE_RANK() OVER (ORDER BY value DESC).

    The rank of a row depends only on rows with a larger value, and all of
    those are inside the top k, so ranking after the limit gives the same
    numbers as ranking everything first.  The limit runs as a per-partition
    top-k followed by a k x partitions merge (TakeOrderedAndProject); the
    window then sees k rows.  ``tiebreak`` makes the cut deterministic.
    """
    order: list[Column] = [F.col(value).desc()] + [F.col(c).asc() for c in tiebreak]
    top = df.orderBy(*order).limit(k)
    fn = F.dense_rank() if dense else F.rank()
    return top.withColumn(rank_col, fn.over(Window.orderBy(F.col(value).desc())).cast("bigint"))


def rank_small(df: DataFrame, value: str, rank_col: str, dense: bool = False) -> DataFrame:
    """RANK over a frame whose size is bounded by a calendar or a code list
    (months, weekday-hours, countries, segments): a plain window is fine there."""
    fn = F.dense_rank() if dense else F.rank()
    return df.withColumn(rank_col, fn.over(Window.orderBy(F.col(value).desc())).cast("bigint"))
