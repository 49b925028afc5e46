"""Distributed ranking against Spark's single-partition windows, pandas and numpy."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.operators.ranking import (
    exact_quantiles, global_row_number, ntile, qcut_first, qcut_values,
)


def _frame(spark, n, distinct, seed):
    rnd = random.Random(seed)
    rows = [(i, rnd.randrange(distinct)) for i in range(n)]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "k long, v long")


@pytest.mark.parametrize("parts", [1, 2, 8])
@pytest.mark.parametrize("n,distinct", [(1, 1), (7, 2), (500, 3), (1000, 1000)])
def test_row_number_and_ntile_match_window(spark, parts, n, distinct):
    df = _frame(spark, n, distinct, seed=n * 31 + parts)
    order = [F.col("v").desc(), F.col("k").asc()]
    ours = global_row_number(df, order, partitions=parts)
    ours = ours.select("k", "rn", "n", ntile(F.col("rn"), F.col("n"), 5).alias("t5"),
                       ntile(F.col("rn"), F.col("n"), 10).alias("t10"))
    w = Window.orderBy(*order)
    ref = df.select("k", F.row_number().over(w).alias("rn"), F.ntile(5).over(w).alias("t5"),
                    F.ntile(10).over(w).alias("t10"))
    got = {r.k: (r.rn, r.t5, r.t10, r.n) for r in ours.collect()}
    want = {r.k: (r.rn, r.t5, r.t10, n) for r in ref.collect()}
    assert got == want


def test_ntile_sizes_n12_k5(spark):
    df = spark.range(12).withColumnRenamed("id", "k")
    r = global_row_number(df, [F.col("k").asc()]).select(ntile(F.col("rn"), F.col("n"), 5).alias("b"))
    sizes = sorted(r.groupBy("b").count().collect())
    assert [c for _, c in sizes] == [3, 3, 2, 2, 2]


@pytest.mark.parametrize("n", [1, 2, 4, 5, 6, 12, 37, 100, 251])
def test_qcut_first_matches_pandas(spark, n):
    rnd = random.Random(n)
    vals = [rnd.randrange(7) for _ in range(n)]
    pdf = pd.DataFrame({"k": range(n), "v": vals})
    df = spark.createDataFrame(pdf)
    got = (global_row_number(df, [F.col("v").asc(), F.col("k").asc()])
           .select("k", qcut_first(F.col("rn"), F.col("n"), 5).alias("q")).toPandas()
           .sort_values("k")["q"].tolist())
    if n == 1:
        assert got == [1]
        return
    want = pd.qcut(pdf["v"].rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
    assert got == want


def test_qcut_first_n12_sizes(spark):
    df = spark.range(12).withColumnRenamed("id", "k")
    r = global_row_number(df, [F.col("k").asc()]).select(qcut_first(F.col("rn"), F.col("n"), 5).alias("b"))
    assert [c for _, c in sorted(r.groupBy("b").count().collect())] == [3, 2, 2, 2, 3]


@pytest.mark.parametrize("n", [1, 2, 10, 333])
def test_exact_quantiles_match_numpy(spark, n):
    rnd = random.Random(7 + n)
    vals = [rnd.random() * 1000 for _ in range(n)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k long, v double")
    probs = [(0, 5), (1, 5), (97, 100), (5, 5)]
    got = exact_quantiles(df, "v", "k", probs, ["a", "b", "c", "d"]).first()
    want = np.percentile(vals, [0, 20, 97, 100])
    assert np.allclose(list(got), want, rtol=1e-12, atol=1e-9)


def test_qcut_values_matches_pandas_and_rejects_duplicate_edges(spark):
    vals = [1, 5, 9, 30, 31, 40, 44, 90, 120, 300, 301, 302]
    pdf = pd.DataFrame({"k": range(len(vals)), "v": vals})
    df = spark.createDataFrame(pdf)
    edges = exact_quantiles(df, "v", "k", [(i, 5) for i in range(6)], [f"e{i}" for i in range(6)])
    out = df.crossJoin(edges).select(
        "k", qcut_values(F.col("v"), [F.col(f"e{i}") for i in range(6)], [5, 4, 3, 2, 1]).alias("s"))
    got = out.toPandas().sort_values("k")["s"].tolist()
    assert got == pd.qcut(pdf["v"], 5, labels=[5, 4, 3, 2, 1]).astype(int).tolist()

    dup = spark.createDataFrame([(i, 1) for i in range(10)], "k long, v long")
    e2 = exact_quantiles(dup, "v", "k", [(i, 5) for i in range(6)], [f"e{i}" for i in range(6)])
    bad = dup.crossJoin(e2).select(qcut_values(F.col("v"), [F.col(f"e{i}") for i in range(6)], [5, 4, 3, 2, 1]))
    with pytest.raises(Exception, match="unique"):
        bad.collect()


def test_ntile_and_qcut_formulas_exhaustive(spark):
    """Every (rn, n) with n <= 300: NTILE against Spark's window, qcut-first against pandas."""
    pairs = spark.range(1, 301).select(F.col("id").alias("n")) \
        .select("n", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("rn"))
    w = Window.partitionBy("n").orderBy("rn")
    got = pairs.select("n", "rn", ntile(F.col("rn"), F.col("n"), 5).alias("a5"), F.ntile(5).over(w).alias("b5"),
                       ntile(F.col("rn"), F.col("n"), 10).alias("a10"), F.ntile(10).over(w).alias("b10"),
                       qcut_first(F.col("rn"), F.col("n"), 5).alias("q")).toPandas()
    assert (got.a5 == got.b5).all() and (got.a10 == got.b10).all()
    for n, grp in got.groupby("n"):
        if n < 2:
            continue
        want = pd.qcut(pd.Series(range(1, n + 1), dtype=float), 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
        assert grp.sort_values("rn").q.tolist() == want, n


@pytest.mark.parametrize("n,distinct", [(1, 1), (2, 2), (50, 3), (777, 400)])
def test_bounded_quantiles_match_numpy(spark, n, distinct):
    from cartwheel.operators.ranking import exact_quantiles_bounded
    rnd = random.Random(n + distinct)
    vals = [rnd.randrange(distinct) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in vals], "v long")
    probs = [(0, 5), (1, 5), (2, 5), (3, 5), (4, 5), (5, 5), (97, 100)]
    got = exact_quantiles_bounded(df, "v", probs, [f"e{i}" for i in range(len(probs))]).first()
    want = np.percentile(vals, [0, 20, 40, 60, 80, 100, 97])
    assert np.allclose(list(got), want, rtol=1e-12, atol=1e-9)
