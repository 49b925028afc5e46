"""Global ranking without a single-partition window.

``NTILE(k) OVER (ORDER BY x)`` with no PARTITION BY plans as an exchange to
one partition: every customer on one task.  ``global_row_number`` gives the
same row numbers with a range-partitioned sort instead:

1. range-partition on the ordering (plus a unique key, so a value shared by
   a third of all rows is still split across partitions), sort inside each
   partition, number rows within the partition;
2. write that numbered frame to the reliable checkpoint folder, so partition
   ids and local numbers stay fixed if an executor is lost and a stage is
   recomputed (range bounds come from sampling, which is not replayable);
3. count rows per partition (one row per partition), turn the counts into
   running offsets, and broadcast them (size = number of partitions);
4. row number = offset of the partition + local number + 1.

NTILE, pandas ``qcut`` on first-ranks and exact linear-interpolated
quantiles are then plain column arithmetic on (row number, n).  Integer
quotients are taken as the floor of a DOUBLE quotient, which is exact for
row counts below 2^52.  The local numbering relies on the documented layout
of ``monotonically_increasing_id`` (partition id in the upper 31 bits, record
number within the partition in the lower 33).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.session import ensure_checkpoint_dir

_LOCAL_BITS = 33  # monotonically_increasing_id = partition id << 33 | row number in partition


def global_row_number(df: DataFrame, order: list[Column], rn: str = "rn", n: str = "n",
                      partitions: int | None = None) -> DataFrame:
    """Add ``rn`` (1-based ROW_NUMBER over ``order``) and ``n`` (row count).

    ``order`` must be a total order (end it with a unique key) for the
    numbering to be deterministic.
    """
    ensure_checkpoint_dir(df.sparkSession)
    # Without an explicit count AQE sizes the range partitions from the map
    # output (coalescing keeps them contiguous and sorted, so numbering holds).
    shuffled = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    indexed = (shuffled
                 .sortWithinPartitions(*order)
                 .withColumn("__gr_pid", F.spark_partition_id())
                 .withColumn("__gr_local", F.monotonically_increasing_id()
                             - F.shiftleft(F.col("__gr_pid").cast("bigint"), _LOCAL_BITS))
                 .checkpoint(eager=True))
    counts = indexed.groupBy("__gr_pid").agg(F.count(F.lit(1)).alias("__gr_cnt"))
    before = Window.orderBy("__gr_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "__gr_pid",
        F.coalesce(F.sum("__gr_cnt").over(before), F.lit(0)).alias("__gr_off"),
        F.sum("__gr_cnt").over(Window.partitionBy()).alias("__gr_n"))
    return (indexed.join(F.broadcast(offsets), "__gr_pid")
                   .withColumn(rn, F.col("__gr_local") + F.col("__gr_off") + F.lit(1))
                   .withColumn(n, F.col("__gr_n"))
                   .drop("__gr_pid", "__gr_local", "__gr_off", "__gr_n"))


def ntile(rn: Column, n: Column, k: int) -> Column:
    """NTILE(k) for row ``rn`` of ``n``: the first n mod k buckets get one extra row."""
    kk = F.lit(k).cast("bigint")
    q = F.floor(n / kk).cast("bigint")
    m = n - q * kk
    big = q + F.lit(1)
    head = m * big
    first = F.floor((rn - F.lit(1)) / big).cast("bigint") + F.lit(1)
    rest = m + F.floor((rn - head - F.lit(1)) / F.nullif(q, F.lit(0))).cast("bigint") + F.lit(1)
    return F.when(rn <= head, first).otherwise(rest).cast("bigint")


def qcut_first(rn: Column, n: Column, k: int) -> Column:
    """pandas ``qcut(x.rank(method='first'), k, labels=1..k)``.

    Edges of the ranks are 1 + (n-1)i/k; a rank goes to the first bin whose
    edge it does not exceed: max(1, ceil(k(rn-1)/(n-1))), an exact rational
    formula (checked against pandas for every n <= 300).  A single row (all
    edges equal, where pandas raises) gets label 1.
    """
    a = F.lit(k).cast("bigint") * (rn - F.lit(1))
    b = n - F.lit(1)
    up = F.floor((a + b - F.lit(1)) / F.nullif(b, F.lit(0))).cast("bigint")
    return F.when(n <= 1, F.lit(1).cast("bigint")).otherwise(F.greatest(F.lit(1).cast("bigint"), up))


def exact_quantiles(df: DataFrame, value: str, key: str, probs: list[tuple[int, int]],
                    names: list[str]) -> DataFrame:
    """One-row frame of exact quantiles (linear interpolation, pandas/numpy default).

    ``probs`` are exact fractions (num, den).  For p = num/den the position is
    h = (n-1)p; the quantile is x[floor h] + (x[floor h + 1] - x[floor h]) * frac(h)
    on the 0-based sorted values.  Only the 2 * len(probs) rows at those
    positions leave the ranked frame; nothing is collected.
    """
    ranked = global_row_number(df.select(value, key), [F.col(value).asc(), F.col(key).asc()])
    nm1 = F.col("n") - F.lit(1)
    picks, parts = [], []
    for (num, den), name in zip(probs, names):
        scaled = nm1 * F.lit(num)
        lo = F.floor(scaled / F.lit(den)).cast("bigint") + F.lit(1)
        hi = F.least(lo + F.lit(1), F.col("n"))
        frac = (scaled - (lo - F.lit(1)) * F.lit(den)).cast("double") / F.lit(float(den))
        picks += [F.col("rn") == lo, F.col("rn") == hi]
        parts.append((name, lo, hi, frac))
    keep = picks[0]
    for p in picks[1:]:
        keep = keep | p
    v = F.col(value).cast("double")
    aggs = []
    for name, lo, hi, frac in parts:
        aggs += [F.max(F.when(F.col("rn") == lo, v)).alias(f"__{name}_lo"),
                 F.max(F.when(F.col("rn") == hi, v)).alias(f"__{name}_hi"),
                 F.max(frac).alias(f"__{name}_f")]
    one = ranked.filter(keep).agg(*aggs)
    return one.select(*[
        (F.col(f"__{name}_lo") + (F.col(f"__{name}_hi") - F.col(f"__{name}_lo")) * F.col(f"__{name}_f")).alias(name)
        for name, *_ in parts])


def exact_quantiles_bounded(df: DataFrame, value: str, probs: list[tuple[int, int]],
                            names: list[str]) -> DataFrame:
    """``exact_quantiles`` for a column whose number of distinct values is bounded
    by the calendar or a code list (e.g. whole days since an event).

    Value counts (partial aggregation, so a value held by a third of the rows is
    one row per partition before the shuffle), then running counts over the
    distinct values in one small window, and the values covering the needed
    positions.  No ranking of the rows and no checkpoint.
    """
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("__c"))
    upto = Window.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = counts.select(value, F.sum("__c").over(upto).alias("__end"),
                          F.sum("__c").over(Window.partitionBy()).alias("__n"))
    prev = Window.orderBy(value)
    spans = spans.withColumn("__start", F.coalesce(F.lag("__end").over(prev), F.lit(0)) + F.lit(1))
    nm1 = F.col("__n") - F.lit(1)
    v = F.col(value).cast("double")
    aggs = []
    for (num, den), name in zip(probs, names):
        scaled = nm1 * F.lit(num)
        lo = F.floor(scaled / F.lit(den)).cast("bigint") + F.lit(1)
        hi = F.least(lo + F.lit(1), F.col("__n"))
        frac = (scaled - (lo - F.lit(1)) * F.lit(den)).cast("double") / F.lit(float(den))
        covers = lambda pos: (F.col("__start") <= pos) & (pos <= F.col("__end"))
        aggs += [F.max(F.when(covers(lo), v)).alias(f"__{name}_lo"),
                 F.max(F.when(covers(hi), v)).alias(f"__{name}_hi"),
                 F.max(frac).alias(f"__{name}_f")]
    one = spans.agg(*aggs)
    return one.select(*[
        (F.col(f"__{name}_lo") + (F.col(f"__{name}_hi") - F.col(f"__{name}_lo")) * F.col(f"__{name}_f")).alias(name)
        for name in names])


def qcut_values(x: Column, edges: list[Column], labels: list[int]) -> Column:
    """pandas ``qcut`` given its edges e0..ek: bin i holds (e[i-1], e[i]], the first bin
    also e0.  Duplicate edges raise, as pandas does ('Bin edges must be unique')."""
    dup = None
    for a, b in zip(edges, edges[1:]):
        c = a >= b
        dup = c if dup is None else (dup | c)
    out = None
    for e, lab in zip(edges[1:], labels):
        out = F.when(x <= e, F.lit(lab)) if out is None else out.when(x <= e, F.lit(lab))
    out = out.otherwise(F.lit(None))
    return F.when(dup, F.raise_error(F.lit("qcut: bin edges must be unique"))).otherwise(out).cast("bigint")
