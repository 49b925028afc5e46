"""The approximate flags of A05 and A17 held against the exact results.

Each plan answers a question from stored sketches and sets the exact figure of every count beside it: ``..._near`` says whether
the estimate is within the stated error.  Money and line counts of the sketch tables are exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.operators import sketches
from cartwheel.operators.rfm import QUINTILES
from cartwheel.operators.sketches import DISTINCT_ERROR, RANK_ERROR, approx_quantiles, rank_share
from cartwheel.plans import questions
from cartwheel.plans.common import finalize, valid_lines


def near(estimate: Column, exact: Column) -> Column:
    """Within the stated error of a distinct count; small counts may be off by the rounding to a whole number."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(DISTINCT_ERROR) * exact, F.lit(1.0))


def _beside(exact: DataFrame, rough: DataFrame, key: list[str], counts: list[str], money: list[str]) -> DataFrame:
    """Exact counts, whether the estimates are near, the money columns of the sketch table, and whether those equal the exact ones."""
    other = finalize(rough.select(*key, *[F.col(c).alias(f"__{c}") for c in counts], *money))
    base = finalize(exact.select(*key, *counts, *[F.col(c).alias(f"__exact_{c}") for c in money]))
    joined = base.join(other, key) if key else base.join(other)  # without a key both have one row
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__exact_{c}")) for c in money])
    return joined.select(*key, *counts, *[near(F.col(f"__{c}"), F.col(c)).alias(f"{c}_near") for c in counts], *money,
                         same.alias("money_same"))


def monthly(fact: DataFrame, cube: DataFrame) -> DataFrame:
    """Q1."""
    return _beside(questions.q01_monthly_revenue(fact), sketches.monthly_revenue(cube), ["month"], ["total_orders", "unique_customers"],
                   ["total_revenue", "avg_order_value", "mom_revenue_growth_pct"])


def countries(fact: DataFrame, cube: DataFrame) -> DataFrame:
    """Q5."""
    return _beside(questions.q05_country_revenue(fact), sketches.country_revenue(cube), ["country"], ["unique_customers", "total_orders"],
                   ["total_revenue", "avg_order_value", "revenue_share_pct", "revenue_rank"])


def kpis(fact: DataFrame, cube: DataFrame) -> DataFrame:
    """Q12."""
    return _beside(questions.q12_kpi(fact), sketches.kpi(cube), [], ["total_customers", "total_orders", "unique_products"],
                   ["total_gross_revenue", "avg_order_value", "countries_served", "data_from", "data_to"])


def segments(fact: DataFrame, customer_rfm: DataFrame) -> DataFrame:
    """Customers, invoices and products per segment."""
    lines = valid_lines(fact)
    per = lines.groupBy("customer_id", "invoice_no", "stock_code").agg(F.sum(sketches.REV).alias("amount"))
    joined = per.join(customer_rfm.select("customer_id", "rfm_segment"), "customer_id")
    exact = joined.groupBy("rfm_segment").agg(*[F.count_distinct(c).alias(k) for k, c in sketches.COUNTED.items()], F.sum("amount").alias("revenue"))
    return _beside(exact, sketches.segment_sketches(lines, customer_rfm), ["rfm_segment"], list(sketches.COUNTED), ["revenue"])


def quantiles(app_rfm: DataFrame) -> DataFrame:
    """The quintile edges of recency and spend and the 97 % point of the heuristic CLV: is the share of customers around each
    estimate within the stated rank error?"""
    out = None
    for value, probs in (("recency", QUINTILES), ("monetary", QUINTILES), ("clv_12month", [(97, 100)])):
        names = [f"p{100 * num // den}" for num, den in probs]
        shares = rank_share(app_rfm, value, approx_quantiles(app_rfm, value, probs, names), names)
        wanted = F.create_map(*[F.lit(x) for name, (num, den) in zip(names, probs) for x in (name, num / den)])[F.col("name")]
        one = shares.select(F.lit(value).alias("value"), "name",
                            ((F.col("below") - RANK_ERROR <= wanted) & (wanted <= F.col("upto") + RANK_ERROR)).alias("near"))
        out = one if out is None else out.unionByName(one)
    return out
