"""The twelve business questions as DataFrame plans.

Every question takes the cleaned fact table (and, where the question needs
them, the ``customer_rfm`` and ``pred_customer_clv`` tables) and returns a
typed result.  Money is summed as DECIMAL and converted to DOUBLE once;
ROUND is the engine-independent half-up form (functions.numeric).
Windows over aggregated grains that are bounded by a calendar or a code
list (months, countries, weekday-hours, segments, deciles) use plain
windows; windows over customer or product grains never do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.calendar import day_name, month_key
from cartwheel.functions.numeric import pct_of, ratio, round_half_up
from cartwheel.operators.cohort import cohort_retention
from cartwheel.operators.gaps import customer_gap_stats
from cartwheel.operators.selection import Ordering, with_buckets
from cartwheel.operators.shares import rank_small, top_k_with_rank, with_share_of_total, with_share_small
from cartwheel.plans.common import finalize, valid_lines
from cartwheel.session import ensure_checkpoint_dir

REV = "total_line_revenue"


def _by_invoice(lines: DataFrame, **keys: Column) -> DataFrame:
    """Lines reduced to (keys, invoice, customer) with revenue and line count.

    Several COUNT(DISTINCT ..) in one aggregate make Spark write every input row once per distinct
    column (Expand).  Taken at this grain they cost that on invoices, not on lines.
    """
    return (lines.groupBy(*[c.alias(k) for k, c in keys.items()], "invoice_no", "customer_id")
            .agg(F.sum(REV).alias("rev"), F.count(F.lit(1)).alias("n_lines"),
                 F.min("invoice_date").alias("first_date"), F.max("invoice_date").alias("last_date")))


def q01_monthly_revenue(fact: DataFrame) -> DataFrame:
    """Q1: orders, customers, revenue, mean line value and month-over-month growth per month."""
    months = (_by_invoice(valid_lines(fact, require_customer=True), month=month_key("invoice_date"))
              .groupBy("month")
              .agg(F.count_distinct("invoice_no").alias("total_orders"),
                   F.count_distinct("customer_id").alias("unique_customers"),
                   F.sum("rev").alias("rev"),
                   F.sum("n_lines").alias("n_lines")))
    prev = F.lag("rev").over(Window.orderBy("month"))  # month grain: bounded by the calendar
    return finalize(months.select(
        "month", "total_orders", "unique_customers",
        F.col("rev").alias("total_revenue"),
        round_half_up(ratio("rev", "n_lines")).alias("avg_order_value"),
        round_half_up(ratio(F.col("rev") - prev, prev) * F.lit(100.0)).alias("mom_revenue_growth_pct"),
    )).orderBy("month")


def q02_segment_revenue(fact: DataFrame, customer_rfm: DataFrame) -> DataFrame:
    """Q2: customers, revenue, mean/max customer revenue and shares per segment.

    Revenue is aggregated to the customer first and then joined to the
    segment table (customer grain on both sides, N:1), instead of joining
    every line to the segment table.
    """
    cust = valid_lines(fact).groupBy("customer_id").agg(F.sum(REV).alias("customer_revenue"))
    joined = cust.join(customer_rfm.select("customer_id", "rfm_segment"), "customer_id")
    seg = joined.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("num_customers"),  # one row per customer after the pre-aggregation
        F.sum("customer_revenue").alias("segment_revenue"),
        F.max("customer_revenue").alias("top_customer_revenue"))
    seg = with_share_small(seg, "segment_revenue", "pct_of_total_revenue")
    seg = with_share_small(seg, "num_customers", "pct_of_total_customers")
    return finalize(seg.select(
        "rfm_segment", "num_customers", "segment_revenue",
        round_half_up(ratio("segment_revenue", "num_customers")).alias("avg_revenue_per_customer"),
        "top_customer_revenue", "pct_of_total_revenue", "pct_of_total_customers",
    )).orderBy(F.col("segment_revenue").desc(), "rfm_segment")


def q03_top_customers(fact: DataFrame, customer_rfm: DataFrame, pred: DataFrame, k: int = 10) -> DataFrame:
    """Q3: top-k customers by revenue with segment, RFM figures and predicted CLV.

    Customer totals first, then two customer-grain joins on the same key;
    customers without a prediction drop out, as with the original inner join.
    """
    cust = valid_lines(fact).groupBy("customer_id").agg(
        F.sum(REV).alias("total_revenue"), F.count_distinct("invoice_no").alias("total_orders"))
    j = (cust.join(customer_rfm, "customer_id")
             .join(pred.select("customer_id", "predicted_clv_12m"), "customer_id"))
    top = top_k_with_rank(j, k, "total_revenue", ["customer_id"], "revenue_rank")
    return finalize(top.select(
        "customer_id", "rfm_segment", "recency_days", "frequency",
        F.col("monetary").alias("historical_spend"),
        round_half_up(F.col("predicted_clv_12m")).alias("predicted_clv_12m"),
        "total_revenue", "total_orders", "revenue_rank",
    )).orderBy(F.col("total_revenue").desc(), "customer_id")


def q04_churn_risk(fact: DataFrame, customer_rfm: DataFrame, pred: DataFrame, as_of: str | None = None,
                   min_orders: int = 3, silent_days: int = 90) -> DataFrame:
    """Q4: customers with >= min_orders invoices silent for more than silent_days.

    ``as_of`` is the reference date: None = today, 'data_max' = the last
    invoice date in the data (a scalar subquery), or a literal date.
    Predicted CLV is returned as predicted.
    """
    lines = valid_lines(fact)
    stats = (lines.groupBy("customer_id")
                  .agg(F.max("invoice_date").alias("last_purchase_date"),
                       F.count_distinct("invoice_no").alias("total_orders"),
                       F.sum(REV).alias("total_spend"))
                  .filter(F.col("total_orders") >= min_orders))
    if as_of == "data_max":
        ref = lines.agg(F.to_date(F.max("invoice_date"))).scalar()
    elif as_of is None:
        ref = F.current_date()
    else:
        ref = F.to_date(F.lit(as_of))
    days = F.datediff(ref, F.col("last_purchase_date")).cast("bigint")
    silent = (stats.withColumn("days_since_last_purchase", days)
                   .filter(F.col("days_since_last_purchase") > silent_days))
    j = (silent.join(customer_rfm.select("customer_id", "rfm_segment"), "customer_id")
               .join(pred.select("customer_id", "predicted_clv_12m"), "customer_id"))
    return finalize(j.select(
        "customer_id", "last_purchase_date", "days_since_last_purchase", "total_orders", "total_spend",
        "rfm_segment", "predicted_clv_12m",
    )).orderBy(F.col("total_spend").desc(), "customer_id")


def q05_country_revenue(fact: DataFrame) -> DataFrame:
    """Q5: revenue contribution and rank per country."""
    countries = (_by_invoice(valid_lines(fact, require_customer=True), country=F.col("country"))
                 .groupBy("country")
                 .agg(F.count_distinct("customer_id").alias("unique_customers"),
                      F.count_distinct("invoice_no").alias("total_orders"),
                      F.sum("rev").alias("total_revenue"),
                      F.sum("n_lines").alias("n_lines")))
    out = with_share_small(countries, "total_revenue", "revenue_share_pct")
    out = rank_small(out, "total_revenue", "revenue_rank")
    return finalize(out.select(
        "country", "unique_customers", "total_orders", "total_revenue",
        round_half_up(ratio("total_revenue", "n_lines")).alias("avg_order_value"),
        "revenue_share_pct", "revenue_rank",
    )).orderBy(F.col("total_revenue").desc(), "country")


def q06_top_products(fact: DataFrame, k: int = 10) -> DataFrame:
    """Q6: top-k products by revenue; the share is of all products' revenue."""
    lines = valid_lines(fact)
    products = (lines
                .groupBy("stock_code", "description")
                .agg(F.sum("quantity").cast("bigint").alias("units_sold"),
                     F.count_distinct("invoice_no").alias("times_ordered"),
                     F.sum(REV).alias("product_revenue")))
    top = top_k_with_rank(products, k, "product_revenue", ["stock_code", "description"],
                          "revenue_rank", dense=True)
    top = with_share_of_total(top, "product_revenue", "pct_of_total_revenue", total_of=lines, total_value=REV)
    return finalize(top.select(
        "stock_code", "description", "units_sold", "times_ordered", "product_revenue",
        "pct_of_total_revenue", "revenue_rank",
    )).orderBy(F.col("product_revenue").desc(), "stock_code", "description")


def q08_cohort_retention(fact: DataFrame) -> DataFrame:
    """Q8: cohort size and customers active 0, 1, 2 and 5 months after the first purchase."""
    return finalize(cohort_retention(valid_lines(fact))).orderBy("cohort_month")


def q07_purchase_gaps(fact: DataFrame, customer_rfm: DataFrame) -> DataFrame:
    """Q7: customers with a repeat purchase and mean/min/max days between purchases per segment."""
    per = customer_gap_stats(valid_lines(fact))
    joined = per.join(customer_rfm.select("customer_id", "rfm_segment"), "customer_id")
    seg = joined.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("num_customers"),
        F.sum("sum_gaps").alias("sum_gaps"),
        F.sum("n_gaps").alias("n_gaps"),
        F.min("min_gap").alias("min_gap"),
        F.max("max_gap").alias("max_gap"))
    return finalize(seg.select(
        "rfm_segment", "num_customers",
        round_half_up(ratio("sum_gaps", "n_gaps"), 1).alias("avg_days_between_purchases"),
        round_half_up(F.col("min_gap"), 1).alias("min_days"),
        round_half_up(F.col("max_gap"), 1).alias("max_days"),
    )).orderBy("avg_days_between_purchases", "rfm_segment")


def _customer_revenue(fact: DataFrame, name: str) -> DataFrame:
    """Revenue per customer in the reliable checkpoint folder: bucket edges are found by a few scans of it."""
    ensure_checkpoint_dir(fact.sparkSession)
    return valid_lines(fact).groupBy("customer_id").agg(F.sum(REV).alias(name)).checkpoint(eager=True)


def q09_revenue_deciles(fact: DataFrame) -> DataFrame:
    """Q9: NTILE(10) of customer revenue and the size/range/share of each decile."""
    dec = with_buckets(_customer_revenue(fact, "total_revenue"),
                       {"revenue_decile": (Ordering("total_revenue", "customer_id"), 10, "ntile")})
    agg = dec.groupBy("revenue_decile").agg(
        F.count("customer_id").alias("num_customers"),
        F.min("total_revenue").alias("min_revenue"),
        F.max("total_revenue").alias("max_revenue"),
        F.sum("total_revenue").alias("decile_total_revenue"))
    agg = with_share_small(agg, "decile_total_revenue", "pct_of_total_revenue")
    return finalize(agg.select(
        "revenue_decile", "num_customers", "min_revenue", "max_revenue",
        round_half_up(ratio("decile_total_revenue", "num_customers")).alias("avg_revenue"),
        "decile_total_revenue", "pct_of_total_revenue",
    )).orderBy("revenue_decile")


def q10_day_hour(fact: DataFrame, k: int = 20) -> DataFrame:
    """Q10: best weekday x hour slots by revenue (168 groups at most)."""
    slots = (valid_lines(fact)
             .groupBy(day_name("invoice_date").alias("day_of_week"),
                      F.hour("invoice_date").cast("bigint").alias("hour_of_day"))
             .agg(F.count_distinct("invoice_no").alias("total_orders"),
                  F.sum(REV).alias("total_revenue"),
                  F.count(F.lit(1)).alias("n_lines")))
    top = top_k_with_rank(slots, k, "total_revenue", ["day_of_week", "hour_of_day"], "revenue_rank")
    return finalize(top.select(
        "day_of_week", "hour_of_day", "total_orders", "total_revenue",
        round_half_up(ratio("total_revenue", "n_lines")).alias("avg_order_value"),
        "revenue_rank",
    )).orderBy(F.col("total_revenue").desc(), "day_of_week", "hour_of_day")


def q11_clv_by_segment(customer_rfm: DataFrame, pred: DataFrame) -> DataFrame:
    """Q11: predicted 12-month CLV and RFM averages per segment, with CLV share."""
    j = customer_rfm.join(pred.select("customer_id", "predicted_clv_12m"), "customer_id")
    seg = j.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("num_customers"),
        F.sum("predicted_clv_12m").alias("clv"),
        F.sum("recency_days").alias("rec"),
        F.sum("frequency").alias("freq"),
        F.sum("monetary").alias("mon"))
    seg = seg.withColumn("__clv_all", F.sum("clv").over(Window.partitionBy()))  # seven segments
    return finalize(seg.select(
        "rfm_segment", "num_customers",
        round_half_up(ratio("clv", "num_customers")).alias("avg_predicted_clv"),
        round_half_up(F.col("clv")).alias("total_clv_opportunity"),
        round_half_up(ratio("rec", "num_customers"), 1).alias("avg_recency_days"),
        round_half_up(ratio("freq", "num_customers"), 1).alias("avg_purchase_frequency"),
        round_half_up(ratio("mon", "num_customers")).alias("avg_historical_spend"),
        pct_of(F.col("clv"), F.col("__clv_all")).alias("clv_share_pct"),
    )).orderBy(F.col("total_clv_opportunity").desc(), "rfm_segment")


def q12_kpi(fact: DataFrame) -> DataFrame:
    """Q12: one-row executive summary."""
    f = valid_lines(fact, require_customer=True)
    products = f.agg(F.count_distinct("stock_code")).scalar()  # one distinct column: no Expand
    k = _by_invoice(f, country=F.col("country")).agg(
        F.count_distinct("customer_id").alias("total_customers"),
        F.count_distinct("invoice_no").alias("total_orders"),
        F.sum("rev").alias("total_gross_revenue"),
        F.sum("n_lines").alias("n_lines"),
        F.count_distinct("country").alias("countries_served"),
        F.min("first_date").alias("data_from"),
        F.max("last_date").alias("data_to")).withColumn("unique_products", products)
    return finalize(k.select(
        "total_customers", "total_orders", "total_gross_revenue",
        round_half_up(ratio("total_gross_revenue", "n_lines")).alias("avg_order_value"),
        round_half_up(ratio("total_gross_revenue", "total_customers")).alias("revenue_per_customer"),
        "unique_products", "countries_served", "data_from", "data_to",
    ))



def pareto_share(fact: DataFrame, parts: int = 5) -> DataFrame:
    """Share of revenue from the top 1/parts of customers (top quintile by default):
    the customers in NTILE(parts) bucket 1 when ordered by revenue descending
    (ties by customer_id), i.e. the first ceil(n/parts) customers."""
    ranked = with_buckets(_customer_revenue(fact, "rev"), {"part": (Ordering("rev", "customer_id", down=True), parts, "ntile")})
    top = F.col("part") == 1
    k = ranked.agg(F.count(F.lit(1)).alias("total_customers"),
                   F.count_if(top).alias("top_customers"),
                   F.sum("rev").alias("total_revenue"),
                   F.sum(F.when(top, F.col("rev"))).alias("top_revenue"))
    return finalize(k.select("total_customers", "top_customers", "total_revenue", "top_revenue",
                             pct_of(F.col("top_revenue"), F.col("total_revenue")).alias("top_revenue_share_pct")))


def country_yoy_growth(fact: DataFrame) -> DataFrame:
    """Revenue per country and calendar year with growth over the country's previous
    active year (a window per country over its years: bounded by the calendar)."""
    yearly = (valid_lines(fact, require_customer=True)
              .groupBy("country", F.year("invoice_date").cast("bigint").alias("year"))
              .agg(F.sum(REV).alias("revenue")))
    prev = F.lag("revenue").over(Window.partitionBy("country").orderBy("year"))
    return finalize(yearly.select(
        "country", "year", "revenue",
        round_half_up(ratio(F.col("revenue") - prev, prev) * F.lit(100.0)).alias("yoy_growth_pct"),
    )).orderBy("country", "year")


# The business action proposed for each segment.
SEGMENT_ACTIONS = {
    "Champions": "Reward & upsell",
    "Loyal Customers": "Loyalty programme",
    "At Risk": "Win-back campaign",
    "Lost": "Re-engagement or drop",
    "New Customers": "Onboarding sequence",
}


def segment_action(customer_rfm: DataFrame) -> DataFrame:
    """Customers per segment with the proposed business action (NULL for segments without one)."""
    action = F.create_map(*[F.lit(x) for kv in SEGMENT_ACTIONS.items() for x in kv])
    return (customer_rfm.groupBy("rfm_segment").agg(F.count(F.lit(1)).alias("num_customers"))
            .withColumn("business_action", F.try_element_at(action, F.col("rfm_segment"))).orderBy("rfm_segment"))


def orders_per_year_by_segment(fact: DataFrame, customer_rfm: DataFrame) -> DataFrame:
    """Mean invoices per customer and year in each segment; the year count is the span of the data
    in days over 365.25."""
    span = valid_lines(fact).agg(F.datediff(F.max("invoice_date"), F.min("invoice_date"))).scalar()
    seg = customer_rfm.groupBy("rfm_segment").agg(F.count(F.lit(1)).alias("num_customers"), F.sum("frequency").alias("orders"))
    per_year = ratio(ratio("orders", "num_customers") * F.lit(365.25), span)
    return finalize(seg.select("rfm_segment", "num_customers", round_half_up(per_year).alias("orders_per_year"))).orderBy("rfm_segment")
