"""A third of all rows on one key: results stay right and no task gets the hot group."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.operators.cohort import cohort_retention
from cartwheel.operators.gaps import customer_gap_stats
from cartwheel.operators.ranking import global_row_number, ntile


def test_ranking_splits_a_hot_value(spark):
    n, parts = 30000, 8
    df = spark.range(n).select(F.col("id").alias("k"),
                               F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("v"))
    ranked = global_row_number(df, [F.col("v").asc(), F.col("k").asc()], partitions=parts)
    sizes = [r["count"] for r in ranked.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == n and max(sizes) <= 2 * n / parts, sizes  # the 10,000 zeros are spread out
    w = Window.orderBy(F.col("v").asc(), F.col("k").asc())
    want = {r.k: r.t for r in df.select("k", F.ntile(10).over(w).alias("t")).collect()}
    got = {r.k: r.t for r in ranked.select("k", ntile(F.col("rn"), F.col("n"), 10).alias("t")).collect()}
    assert got == want


def test_hot_customer_in_gaps_and_cohorts(spark):
    base = dt.datetime(2010, 1, 1)
    hot = spark.range(20000).select(F.lit(1).cast("bigint").alias("customer_id"),
                                    (F.lit(base) + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") * 37) % 1440)
                                     + F.make_dt_interval((F.col("id") % 400).cast("int"))).cast("timestamp_ntz")
                                    .alias("invoice_date"))
    cold = spark.range(40000).select((F.col("id") % 500 + 2).alias("customer_id"),
                                     (F.lit(base) + F.make_dt_interval((F.col("id") % 97).cast("int")))
                                     .cast("timestamp_ntz").alias("invoice_date"))
    lines = hot.unionByName(cold)
    g = {r.customer_id: r for r in customer_gap_stats(lines).collect()}
    pdf = lines.filter("customer_id = 1").select("invoice_date").distinct().toPandas()
    stamps = sorted(pdf.invoice_date)
    gaps = [(b.date() - a.date()).days for a, b in zip(stamps, stamps[1:])]
    assert (g[1].n_gaps, g[1].sum_gaps, g[1].min_gap, g[1].max_gap) == (len(gaps), sum(gaps), min(gaps), max(gaps))
    cohorts = cohort_retention(lines).collect()
    assert sum(r.cohort_size for r in cohorts) == 501
