"""Monthly cohort retention (Q8: J05, J09, A06, F05)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.calendar import month_index


def cohort_retention(lines: DataFrame, offsets: tuple[int, ...] = (0, 1, 2, 5)) -> DataFrame:
    """Customers per first-purchase month, and how many were active k months later.

    1. distinct (customer, activity month) - partial aggregation before the shuffle;
    2. cohort month = the customer's first active month, a window per customer
       whose size is bounded by the number of calendar months, not by row count
       (a customer with a third of all lines still has at most a few hundred rows);
    3. one aggregate per cohort.  (customer, month) rows are unique, so
       COUNT(DISTINCT CASE WHEN offset = k THEN customer END) is a plain
       conditional count, and cohort_size is the count at offset 0 because the
       first month is itself an activity month.
    """
    cm = lines.select("customer_id", month_index("invoice_date").alias("m")).distinct()
    cm = cm.withColumn("cohort", F.min("m").over(Window.partitionBy("customer_id")))
    off = F.col("m") - F.col("cohort")
    agg = cm.groupBy("cohort").agg(
        F.count_if(off == 0).alias("cohort_size"),
        *[F.count_if(off == k).alias(f"month_{k}") for k in offsets],
    )
    cohort_month = F.date_format(
        F.make_date(F.floor(F.col("cohort") / 12).cast("int"),
                    (F.col("cohort") % 12 + 1).cast("int"), F.lit(1)), "yyyy-MM")
    return agg.select(cohort_month.alias("cohort_month"), "cohort_size",
                      *[f"month_{k}" for k in offsets])
