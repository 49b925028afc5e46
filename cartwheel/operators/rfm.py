"""Recency / frequency / monetary scoring and customer segments.

Two variants exist side by side because the original work has two:

* the SQL view (``rfm_scores``): recency in calendar days to the last invoice
  in the data, NTILE(5) on recency (desc), frequency and monetary (asc);
* the dashboard (``app_rfm``): recency in whole elapsed days to the last
  invoice + 1 day, qcut quintiles on recency values and on first-ranks of
  frequency and monetary, the 7-segment rule, and a heuristic 12-month CLV
  capped at its 97th percentile.

Ties in every ordering are broken by ``customer_id`` (ascending).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.calendar import calendar_days, elapsed_days
from cartwheel.functions.numeric import ratio
from cartwheel.operators.ranking import exact_quantiles_bounded, qcut_values
from cartwheel.operators.selection import (
    Ordering, bucket, positions_of, qcut_ends, quantile_positions, with_buckets,
)
from cartwheel.session import ensure_checkpoint_dir

REV = "total_line_revenue"


def segment_expr(rfm_score: Column, r_score: Column) -> Column:
    """The 7-way first-match segment rule on (R+F+M, R)."""
    return (F.when(rfm_score >= 13, "Champions")
             .when(rfm_score >= 10, "Loyal Customers")
             .when((r_score >= 4) & (rfm_score >= 8), "Potential Loyalists")
             .when((r_score >= 4) & (rfm_score < 8), "New Customers")
             .when(r_score == 3, "At Risk")
             .when(r_score == 2, "Hibernating")
             .otherwise("Lost"))


def rfm_base(fact: DataFrame) -> DataFrame:
    """Per customer: recency (calendar days from the customer's last invoice to the
    last invoice in the data), distinct invoices, DECIMAL revenue.

    The dataset maximum is, as in the original, an uncorrelated scalar
    subquery: a one-column global aggregate over the lines (partial maxima per
    partition), evaluated once; no second pass of the per-customer aggregation.
    """
    per = fact.groupBy("customer_id").agg(
        F.max("invoice_date").alias("__last"),
        F.count_distinct("invoice_no").alias("frequency"),
        F.sum(REV).alias("monetary"))
    max_all = fact.agg(F.max("invoice_date")).scalar()
    return per.select("customer_id", calendar_days(max_all, "__last").alias("recency"), "frequency", "monetary")


def _stored(per_customer: DataFrame) -> DataFrame:
    """The customers' figures in the reliable checkpoint folder: the bucket edges are found by a few scans of them."""
    ensure_checkpoint_dir(per_customer.sparkSession)
    return per_customer.checkpoint(eager=True)


def rfm_scores(fact: DataFrame) -> DataFrame:
    """The RFM view: base metrics, three NTILE(5) scores and the 'rfm' cell string.

    No ordering is sorted: the four edges of each of the three are selected together (``operators.selection``)."""
    s = with_buckets(_stored(rfm_base(fact)), {
        "r_score": (Ordering("recency", "customer_id", down=True), 5, "ntile"),
        "f_score": (Ordering("frequency", "customer_id"), 5, "ntile"),
        "m_score": (Ordering("monetary", "customer_id"), 5, "ntile")})
    return s.select(
        "customer_id", "recency", "frequency", "monetary", "r_score", "f_score", "m_score",
        F.concat(F.col("r_score").cast("string"), F.col("f_score").cast("string"),
                 F.col("m_score").cast("string")).alias("rfm_cell_string"))


def customer_rfm(fact: DataFrame) -> DataFrame:
    """``customer_rfm`` (customer_id, rfm_segment, recency_days, frequency, monetary):
    the view's NTILE scores run through the segment rule."""
    return segments(rfm_scores(fact))


def segments(s: DataFrame) -> DataFrame:
    """``customer_rfm`` from stored ``rfm_scores``."""
    score = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return s.select("customer_id", segment_expr(score, F.col("r_score")).alias("rfm_segment"),
                    F.col("recency").alias("recency_days"), "frequency", "monetary")


QUINTILES = [(0, 5), (1, 5), (2, 5), (3, 5), (4, 5), (5, 5)]


def app_rfm(app_fact: DataFrame, clv_cap_quantile: tuple[int, int] = (97, 100)) -> DataFrame:
    """The dashboard's customer table.

    recency       whole days elapsed from the last invoice to (data max + 1 day)
    frequency     distinct invoices;  monetary  DECIMAL revenue
    r/f/m_score   qcut quintiles: recency values (labels 5..1), first-ranks of
                  frequency and monetary (labels 1..5)
    segment       7-way rule on rfm_score = r+f+m and r
    avg_order_value  mean line revenue (a line, not an order, as in the original)
    clv_12month   avg_order_value * frequency * 12 / max(1, span_days/30),
                  capped at its exact 97th percentile
    """
    # The lines are read once: they may be the cleaning's output, not yet a table.
    per = _stored(app_fact.groupBy("customer_id").agg(
        F.max("invoice_date").alias("__last"),
        F.min("invoice_date").alias("__first"),
        F.count_distinct("invoice_no").alias("frequency"),
        F.sum(REV).alias("monetary"),
        F.count(F.lit(1)).alias("__lines")))
    # Dataset-wide scalars: one scalar subquery (a one-row aggregate of the customers), evaluated once.
    span = per.agg(F.struct(F.max("__last").alias("hi"), F.min("__first").alias("lo"))).scalar()
    span_days = elapsed_days(span["hi"], span["lo"]).cast("double")
    factor = F.lit(12.0) / F.greatest(F.lit(1.0), span_days / F.lit(30.0))
    snapshot = span["hi"] + F.expr("INTERVAL 1 DAY")
    base = per.select("customer_id",
                      elapsed_days(snapshot, F.col("__last")).alias("recency"),
                      "frequency", "monetary",
                      ratio("monetary", "__lines").alias("avg_order_value"),
                      factor.alias("__factor"))
    clv_raw = (F.col("avg_order_value") * F.col("frequency").cast("double")) * F.col("__factor")
    base = _stored(base.withColumn("__clv", clv_raw).drop("__factor"))

    # F and M: qcut on first-ranks (ties by customer_id, the frame's order in the original).  Their edges and
    # the two customers around the CLV quantile are selected together, without a sort.
    n = base.count()
    orders = {c: Ordering(c, "customer_id") for c in ("frequency", "monetary", "__clv")}
    ends = qcut_ends(n, 5)
    caps = quantile_positions(n, [clv_cap_quantile]) if n else []
    rows = positions_of(base, {"frequency": (orders["frequency"], ends), "monetary": (orders["monetary"], ends),
                               "__clv": (orders["__clv"], [p for lo, hi, _ in caps for p in (lo, hi)])}, n)
    scored = base.withColumns({"f_score": bucket(orders["frequency"], ends, rows["frequency"]),
                               "m_score": bucket(orders["monetary"], ends, rows["monetary"])})
    cap = F.lit(None).cast("double")
    for lo, hi, weight in caps:
        low, high = rows["__clv"][lo][0], rows["__clv"][hi][0]
        cap = F.lit(low + (high - low) * weight)
    # R: qcut on the recency values (edges are exact quantiles), labels reversed.  Recency is
    # whole days inside the data's span, so its distinct values are bounded by the calendar.
    names = [f"e{i}" for i in range(6)]
    edges = exact_quantiles_bounded(scored, "recency", QUINTILES, names)
    e = edges.select(F.struct(*names)).scalar()
    scored = scored.withColumn("__edges", e)  # one reference to the subquery
    scored = scored.withColumn(
        "r_score", qcut_values(F.col("recency"), [F.col("__edges")[n] for n in names], [5, 4, 3, 2, 1])
    ).drop("__edges")

    rfm_score = (F.col("r_score") + F.col("f_score") + F.col("m_score")).cast("bigint")
    scored = scored.withColumn("rfm_score", rfm_score) \
                   .withColumn("segment", segment_expr(F.col("rfm_score"), F.col("r_score")))
    return scored.select("customer_id", "recency", "frequency", "monetary", "r_score", "f_score",
                         "m_score", "rfm_score", "segment", "avg_order_value",
                         F.least(F.col("__clv"), cap).alias("clv_12month"))
