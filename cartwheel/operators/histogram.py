"""Equal-width histogram with numpy ``histogram(x, bins=k)`` semantics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def equal_width_histogram(df: DataFrame, value: str, bins: int = 40) -> DataFrame:
    """Counts per bin over [min, max] split into ``bins`` equal widths; all bins returned.

    Edges are ``lo + i * ((hi - lo) / bins)`` in DOUBLE (the last edge is hi
    itself); a value goes to the bin with edge[i] <= x < edge[i+1], the last
    bin is closed.  As in numpy, an estimate floor((x-lo)/(hi-lo)*bins) is
    corrected by comparing against the edges, and a constant column uses
    [x-0.5, x+0.5].  Min/max is a scalar subquery (one global aggregate), the
    counts one aggregate with partial counts; output has exactly ``bins`` rows.
    """
    x = F.col(value).cast("double")
    mm = df.agg(F.min(x).alias("a"), F.max(x).alias("b"))
    stats = mm.select(F.struct(
        F.when(F.col("a") == F.col("b"), F.col("a") - F.lit(0.5)).otherwise(F.col("a")).alias("lo"),
        F.when(F.col("a") == F.col("b"), F.col("b") + F.lit(0.5)).otherwise(F.col("b")).alias("hi"))).scalar()
    lo_c, hi_c = F.col("__lo"), F.col("__hi")
    step = (hi_c - lo_c) / F.lit(float(bins))

    def edge(i):
        return F.when(i >= F.lit(bins), hi_c).otherwise(i.cast("double") * step + lo_c)

    # the bounds are projected once per side, so each side references the subquery once
    j = (df.select(x.alias("__x")).filter(F.col("__x").isNotNull())
           .select("__x", stats["lo"].alias("__lo"), stats["hi"].alias("__hi")))
    est = F.floor((F.col("__x") - lo_c) / (hi_c - lo_c) * F.lit(float(bins))).cast("bigint")
    j = j.withColumn("__i", F.least(est, F.lit(bins - 1).cast("bigint")))
    j = j.withColumn("__i", F.when(F.col("__x") < edge(F.col("__i")), F.col("__i") - F.lit(1)).otherwise(F.col("__i")))
    j = j.withColumn("__i", F.when((F.col("__x") >= edge(F.col("__i") + F.lit(1))) & (F.col("__i") != F.lit(bins - 1)),
                                   F.col("__i") + F.lit(1)).otherwise(F.col("__i")))
    counts = j.groupBy(F.col("__i").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    all_bins = df.sparkSession.range(bins).select(F.col("id").alias("bin"), stats["lo"].alias("__lo"),
                                                  stats["hi"].alias("__hi"))
    b = F.col("bin")
    return (all_bins.join(counts, "bin", "left")
                    .select(b.alias("bin"), edge(b).alias("lo"), edge(b + F.lit(1)).alias("hi"),
                            F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("n")))
