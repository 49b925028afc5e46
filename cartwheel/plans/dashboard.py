"""The dashboard's datasets, each one function of the ``app_rfm`` table or the
dashboard fact table (descriptions not trimmed).

In an application, compute ``app_rfm`` once, write it (or checkpoint it),
and derive every tab from the stored table; each function here is a small
aggregate, filter or top-k on top of it.  KPI sums of DOUBLE CLV values are
reported to the cent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.calendar import month_key
from cartwheel.functions.numeric import money_text, ratio, round_half_up
from cartwheel.operators.histogram import equal_width_histogram
from cartwheel.operators.shares import with_share_small
from cartwheel.plans.common import finalize

CHURNED = ["At Risk", "Hibernating", "Lost"]
REACTIVATE = ["Hibernating", "Lost"]
DETAIL_COLS = ["customer_id", "segment", "recency", "frequency", "monetary", "clv_12month"]
EXPLORER_COLS = ["customer_id", "segment", "recency", "frequency", "monetary",
                 "r_score", "f_score", "m_score", "rfm_score", "clv_12month"]


def app_kpis(rfm: DataFrame) -> DataFrame:
    """Six headline tiles in one aggregate pass."""
    k = rfm.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.sum("monetary").alias("total_revenue"),
        F.sum("clv_12month").alias("__clv"),
        F.count_if(F.col("segment") == "Champions").alias("champions_count"),
        F.count_if(F.col("segment").isin(CHURNED)).alias("at_risk_count"))
    return finalize(k.select(
        "total_customers", "total_revenue",
        round_half_up(F.col("__clv")).alias("total_clv"),
        round_half_up(ratio("__clv", "total_customers")).alias("avg_clv"),
        "champions_count", "at_risk_count"))


def app_segment_counts(rfm: DataFrame) -> DataFrame:
    """Segment mix with the pie chart's one-decimal percentages."""
    seg = rfm.groupBy("segment").agg(F.count(F.lit(1)).alias("n"))
    return with_share_small(seg, "n", "pct", 1).orderBy(F.col("n").desc(), "segment")


def app_segment_revenue(rfm: DataFrame) -> DataFrame:
    return finalize(rfm.groupBy("segment").agg(F.sum("monetary").alias("revenue"))).orderBy("revenue", "segment")


def app_clv_by_segment(rfm: DataFrame) -> DataFrame:
    return (rfm.groupBy("segment").agg(round_half_up(F.sum("clv_12month")).alias("clv"))
               .orderBy(F.col("clv").desc(), "segment"))


def app_recency_hist(rfm: DataFrame) -> DataFrame:
    return equal_width_histogram(rfm, "recency", 40).orderBy("bin")


def app_frequency_hist(rfm: DataFrame) -> DataFrame:
    capped = rfm.select(F.least(F.col("frequency"), F.lit(50)).alias("frequency"))
    return equal_width_histogram(capped, "frequency", 40).orderBy("bin")


def app_frequency_vs_clv(rfm: DataFrame) -> DataFrame:
    """Scatter data: every customer, frequency clipped at 60."""
    return rfm.select("segment", "customer_id",
                      F.least(F.col("frequency"), F.lit(60)).cast("bigint").alias("frequency"),
                      F.col("clv_12month").alias("clv"))


def _nlargest(df: DataFrame, k: int, value: str) -> DataFrame:
    """pandas ``nlargest(k, value)`` (keep='first': ties go to the lower customer_id)."""
    return df.orderBy(F.col(value).desc(), F.col("customer_id").asc()).limit(k)


def app_top20_clv(rfm: DataFrame, k: int = 20) -> DataFrame:
    return finalize(_nlargest(rfm, k, "clv_12month").select(*DETAIL_COLS))


def app_reactivation(rfm: DataFrame, k: int = 15) -> DataFrame:
    """Hibernating / Lost customers with the largest historical spend."""
    return finalize(_nlargest(rfm.filter(F.col("segment").isin(REACTIVATE)), k, "monetary").select(*DETAIL_COLS))


def with_money_text(table: DataFrame) -> DataFrame:
    """A detail table as displayed: money columns as '$1,234.56' text."""
    return table.withColumns({c: money_text(c) for c in ("monetary", "clv_12month")})


def clv_bound(rfm: DataFrame) -> DataFrame:
    """Upper end of the explorer's slider: the largest CLV without its fraction."""
    return rfm.agg(F.max("clv_12month").cast("decimal(38,6)").cast("bigint").alias("max_clv"))


def _explore(rfm: DataFrame, segments: list[str] | None, min_clv: float) -> DataFrame:
    cond = F.col("clv_12month") >= F.lit(float(min_clv))
    if segments is not None:
        cond = F.col("segment").isin(segments) & cond
    return rfm.filter(cond)


def app_segment_options(rfm: DataFrame) -> DataFrame:
    """Distinct segments (the explorer's default filter value)."""
    return rfm.select("segment").distinct().orderBy("segment")


def app_explorer(rfm: DataFrame, segments: list[str] | None = None, min_clv: float = 0.0,
                 k: int = 200) -> DataFrame:
    """Customers in the chosen segments with CLV >= min_clv, largest CLV first, first k."""
    return finalize(_explore(rfm, segments, min_clv)
                    .orderBy(F.col("clv_12month").desc(), F.col("customer_id").asc())
                    .limit(k).select(*EXPLORER_COLS))


def app_explorer_kpis(rfm: DataFrame, segments: list[str] | None = None, min_clv: float = 0.0) -> DataFrame:
    k = _explore(rfm, segments, min_clv).agg(
        F.count(F.lit(1)).alias("n"), F.sum("monetary").alias("revenue"),
        round_half_up(F.sum("clv_12month")).alias("clv"))
    return finalize(k)


def app_monthly_revenue(app_fact: DataFrame) -> DataFrame:
    return finalize(app_fact.groupBy(month_key("invoice_date").alias("year_month"))
                    .agg(F.sum("total_line_revenue").alias("revenue"))).orderBy("year_month")


def _top_revenue(app_fact: DataFrame, key: str, k: int) -> DataFrame:
    g = app_fact.groupBy(key).agg(F.sum("total_line_revenue").alias("revenue"))
    return finalize(g.orderBy(F.col("revenue").desc(), F.col(key).asc()).limit(k))


def app_top_countries(app_fact: DataFrame, k: int = 10) -> DataFrame:
    return _top_revenue(app_fact, "country", k)


def app_top_products(app_fact: DataFrame, k: int = 10) -> DataFrame:
    """Top products by description alone (a different grain from Q6)."""
    return _top_revenue(app_fact, "description", k)
