"""Days between consecutive purchases (Q7: A11, W02, P14, F03).

The question orders each customer's distinct purchase timestamps, takes
DATEDIFF(ts, previous ts) and summarises the gaps per segment.  A window
over a customer's timestamps would put a customer holding a third of all
lines into one task, so the work is split by what DATEDIFF depends on:
the calendar day.

* Within one day, k distinct timestamps give k-1 gaps of 0 days.
* Between active days the gap is the day difference of consecutive days;
  a per-customer window over *active days* is bounded by the calendar span
  (a few thousand rows at most), whatever the row count.
* The gaps of a customer sum to last day - first day, and there are
  (distinct timestamps - 1) of them, so the mean needs no pairs at all.

This yields exactly the per-gap count, sum, min and max of the original.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def customer_gap_stats(lines: DataFrame) -> DataFrame:
    """Per customer with at least one gap: n_gaps, sum_gaps, min_gap, max_gap (days)."""
    days = (lines.groupBy("customer_id", F.to_date("invoice_date").alias("d"))
                 .agg(F.count_distinct("invoice_date").alias("k")))
    prev = F.lag("d").over(Window.partitionBy("customer_id").orderBy("d"))
    days = days.withColumn("between", F.datediff(F.col("d"), prev).cast("bigint"))
    per = days.groupBy("customer_id").agg(
        (F.sum("k") - F.lit(1)).alias("n_gaps"),
        F.datediff(F.max("d"), F.min("d")).cast("bigint").alias("sum_gaps"),
        F.max("k").alias("max_k"),
        F.min("between").alias("min_between"),
        F.max("between").alias("max_between"))
    return per.filter(F.col("n_gaps") > 0).select(
        "customer_id", "n_gaps", "sum_gaps",
        F.when(F.col("max_k") >= 2, F.lit(0).cast("bigint")).otherwise(F.col("min_between")).alias("min_gap"),
        F.coalesce(F.col("max_between"), F.lit(0).cast("bigint")).alias("max_gap"))
