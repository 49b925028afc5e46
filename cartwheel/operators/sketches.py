"""Approximate distinct counts and quantiles from mergeable sketches (the approximate flags of A05 and A17).

``distinct_cube`` reduces the fact lines once to one row per day and country (or any other keys): exact revenue and line
counts beside HyperLogLog sketches of invoices, customers and products.  Rows merge, so any month, country or
the whole period is answered from the stored cube by a union of sketches, without another scan of the
lines; new days are appended to it.  A sketch's size is fixed by ``LG_K``, whatever it counts.

``quantile_sketch`` does the same for quantiles with KLL sketches: one partial aggregation, no sort, no shuffle of rows.

Errors: the relative standard error of a distinct count is about 1.04 / sqrt(2^LG_K) (small counts are exact);
``DISTINCT_ERROR`` is three of them.  A quantile's rank is off by at most ``RANK_ERROR`` of the rows, with 99 % probability.
The exact forms stay the default everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.calendar import month_key
from cartwheel.functions.numeric import pct_of, ratio, round_half_up
from cartwheel.operators.shares import rank_small, with_share_small

LG_K = 12
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)
KLL_K = 1024
RANK_ERROR = 0.005  # of KLL_K, doubled

REV = "total_line_revenue"
#: Counted columns of the cube, and the lines' columns behind them.
COUNTED = {"orders": "invoice_no", "customers": "customer_id", "products": "stock_code"}


def distinct_cube(lines: DataFrame, keys: dict[str, Column] | None = None) -> DataFrame:
    """One row per ``keys`` (default: day and country) with ``revenue``, ``n_lines``, the first and last
    time, and a sketch for each of ``COUNTED``.

    NULLs are not counted, as in COUNT(DISTINCT); an empty input gives no rows.  A customer or country that holds a third of all
    lines is collapsed to one sketch per task before the shuffle.
    """
    keys = {"day": F.to_date("invoice_date"), "country": F.col("country")} if keys is None else keys
    return lines.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(
        F.sum(REV).alias("revenue"), F.count(F.lit(1)).alias("n_lines"),
        F.min("invoice_date").alias("first_date"), F.max("invoice_date").alias("last_date"),
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LG_K)).alias(f"{k}_sketch") for k, c in COUNTED.items()])


def roll_up(cube: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """The cube at a coarser grain: sums, and unions of its sketches."""
    return cube.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(
        F.sum("revenue").alias("revenue"), F.sum("n_lines").alias("n_lines"),
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
        *[F.hll_union_agg(f"{k}_sketch").alias(f"{k}_sketch") for k in COUNTED])


def estimate(counted: str) -> Column:
    """The distinct count of one of ``COUNTED``."""
    return F.hll_sketch_estimate(f"{counted}_sketch").cast("bigint")


def monthly_revenue(cube: DataFrame) -> DataFrame:
    """Q1 from the cube: orders and customers are estimates, money and lines are exact."""
    months = roll_up(cube, {"month": month_key("day")})
    prev = F.lag("revenue").over(Window.orderBy("month"))  # month grain: bounded by the calendar
    return months.select(
        "month", estimate("orders").alias("total_orders"), estimate("customers").alias("unique_customers"),
        F.col("revenue").cast("double").alias("total_revenue"), round_half_up(ratio("revenue", "n_lines")).alias("avg_order_value"),
        round_half_up(ratio(F.col("revenue") - prev, prev) * F.lit(100.0)).alias("mom_revenue_growth_pct"))


def country_revenue(cube: DataFrame) -> DataFrame:
    """Q5 from the cube."""
    countries = roll_up(cube, {"country": F.col("country")})
    out = with_share_small(countries, "revenue", "revenue_share_pct")
    out = rank_small(out, "revenue", "revenue_rank")
    return out.select(
        "country", estimate("customers").alias("unique_customers"), estimate("orders").alias("total_orders"),
        F.col("revenue").cast("double").alias("total_revenue"), round_half_up(ratio("revenue", "n_lines")).alias("avg_order_value"),
        "revenue_share_pct", F.col("revenue_rank").cast("bigint").alias("revenue_rank"))


def kpi(cube: DataFrame) -> DataFrame:
    """Q12 from the cube, one row."""
    k = roll_up(cube, {}).join(cube.agg(F.count_distinct("country").alias("countries_served")))  # one row each
    return k.select(
        estimate("customers").alias("total_customers"), estimate("orders").alias("total_orders"),
        F.col("revenue").cast("double").alias("total_gross_revenue"), round_half_up(ratio("revenue", "n_lines")).alias("avg_order_value"),
        round_half_up(ratio(F.col("revenue"), estimate("customers"))).alias("revenue_per_customer"),
        estimate("products").alias("unique_products"), "countries_served",
        F.col("first_date").alias("data_from"), F.col("last_date").alias("data_to"))


def segment_sketches(lines: DataFrame, customer_rfm: DataFrame) -> DataFrame:
    """Distinct invoices, customers and products per customer segment, estimated: a cube by customer segment.

    Lines meet their customer's segment before they are sketched, so a task holds a few sketches for each segment; a
    sketch per customer would be kilobytes wide for some bytes of lines, and most of a task's memory."""
    joined = lines.join(customer_rfm.select("customer_id", "rfm_segment"), "customer_id")
    cube = distinct_cube(joined, {"rfm_segment": F.col("rfm_segment")})
    return roll_up(cube, {"rfm_segment": F.col("rfm_segment")}).select(
        "rfm_segment", *[estimate(k).alias(k) for k in COUNTED], F.col("revenue").cast("double").alias("revenue"))


def quantile_sketch(df: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """A KLL sketch of ``value`` (``sketch``) per ``keys``, or one row for all; NULLs are left out."""
    return df.groupBy(*(keys or [])).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(KLL_K)).alias("sketch"))


def approx_quantiles(df: DataFrame, value: str, probs: list[tuple[int, int]], names: list[str]) -> DataFrame:
    """One-row frame of approximate quantiles; ``probs`` are fractions (num, den).  One pass: tasks send a
    sketch each.  A value of the data is returned, not an interpolation."""
    one = quantile_sketch(df, value)
    return one.select(*[F.kll_sketch_get_quantile_double("sketch", F.lit(num / den)).alias(name) for (num, den), name in zip(probs, names)])


def rank_share(df: DataFrame, value: str, points: DataFrame, names: list[str]) -> DataFrame:
    """The share of rows below and up to each point of a one-row frame, exactly: what the sketch's error is
    measured by.  ``name, below, upto``."""
    v = F.col(value).cast("double")
    p = points.select(F.struct(*names)).scalar()
    n = F.count(v)
    got = df.withColumn("__p", p).agg(F.array(*[F.struct(
        F.lit(k).alias("name"), (F.count_if(v < F.col("__p")[k]) / n).alias("below"), (F.count_if(v <= F.col("__p")[k]) / n).alias("upto"))
        for k in names]).alias("x"))
    return got.select(F.inline("x"))
