"""Selection of positions against sorted lists, Spark's windows and pandas."""

import random
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwheel.operators import selection
from cartwheel.operators.selection import Ordering, ntile_ends, positions_of, qcut_ends, quantile_positions, with_buckets


def _rows(n, distinct, seed):
    rnd = random.Random(seed)
    rows = [(i, rnd.randrange(distinct) - distinct // 2) for i in range(n)]
    rnd.shuffle(rows)
    return rows


@pytest.fixture
def few(monkeypatch):
    """Small limits, so that a few hundred rows take several rounds."""
    monkeypatch.setattr(selection, "SMALL", 7)
    monkeypatch.setattr(selection, "SPLITS", 8)


@pytest.mark.parametrize("n,distinct", [(1, 1), (6, 2), (7, 1), (300, 2), (500, 500), (400, 1)])
def test_positions_match_sorted_lists(spark, few, n, distinct):
    rows = _rows(n, distinct, n + distinct)
    df = spark.createDataFrame(rows, "k long, v long").repartition(3)
    places = sorted({1, n, n // 2, n // 3, 0, n + 1})
    got = positions_of(df, {"up": (Ordering("v", "k"), places), "down": (Ordering("v", "k", True), places)}, n)
    for name, key in (("up", lambda r: (r[1], r[0])), ("down", lambda r: (-r[1], r[0]))):
        ordered = sorted(rows, key=key)
        assert got[name] == {p: (ordered[p - 1][1], ordered[p - 1][0]) for p in places if 1 <= p <= n}


@pytest.mark.parametrize("n,distinct", [(1, 1), (3, 3), (12, 4), (333, 3), (401, 400)])
def test_buckets_match_windows_and_pandas(spark, few, n, distinct):
    rows = _rows(n, distinct, n)
    df = spark.createDataFrame(rows, "k long, v long").repartition(3)
    got = with_buckets(df, {"a": (Ordering("v", "k"), 5, "ntile"), "b": (Ordering("v", "k", True), 10, "ntile"),
                            "q": (Ordering("v", "k"), 5, "qcut")}).toPandas().sort_values("k")
    want = df.select("k", F.ntile(5).over(Window.orderBy("v", "k")).alias("a"),
                     F.ntile(10).over(Window.orderBy(F.desc("v"), "k")).alias("b")).toPandas().sort_values("k")
    assert got.a.tolist() == want.a.tolist() and got.b.tolist() == want.b.tolist()
    if n > 1:
        ranks = pd.DataFrame(rows, columns=["k", "v"]).sort_values("k").v.rank(method="first")
        assert got.q.tolist() == pd.qcut(ranks, 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
    else:
        assert got.q.tolist() == [1]


def test_no_rows(spark):
    df = spark.createDataFrame([], "k long, v long")
    assert with_buckets(df, {"a": (Ordering("v", "k"), 5, "ntile"), "q": (Ordering("v", "k"), 5, "qcut")}).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 99, 100, 101])
def test_ends_cut_as_the_formulas_do(n):
    for k in (5, 10):
        bucket = [1 + sum(p > e for e in ntile_ends(n, k)) for p in range(1, n + 1)]
        size = [n // k + (i < n % k) for i in range(k)]
        assert bucket == [i + 1 for i, s in enumerate(size) for _ in range(s)]
        label = [1 + sum(p > e for e in qcut_ends(n, k)) for p in range(1, n + 1)]
        assert label == [max(1, -(-k * (p - 1) // (n - 1))) if n > 1 else 1 for p in range(1, n + 1)]


def test_quantiles_of_decimals_and_doubles(spark, few):
    rnd = random.Random(3)
    values = [Decimal(rnd.randrange(10**9)) / 100 for _ in range(250)]
    df = spark.createDataFrame([(i, v, float(v) / 7) for i, v in enumerate(values)], "k long, d decimal(38,8), x double")
    for column, data in (("d", sorted(map(float, values))), ("x", sorted(float(v) / 7 for v in values))):
        (lo, hi, w), = quantile_positions(250, [(97, 100)])
        rows = positions_of(df, {"q": (Ordering(column, "k"), [lo, hi])}, 250)["q"]
        a, b = float(rows[lo][0]), float(rows[hi][0])
        assert a + (b - a) * w == pytest.approx(pd.Series(data).quantile(0.97), rel=1e-12)


def test_rounds_divide_what_is_left(spark, monkeypatch):
    """200,000 rows of two values: two narrowing rounds, and never more than the bound fetched."""
    monkeypatch.setattr(selection, "SMALL", 200)
    rounds, narrow = [], selection._narrow
    monkeypatch.setattr(selection, "_narrow", lambda *a: (rounds.append(1), narrow(*a))[1])
    df = spark.range(200_000).select(F.col("id").alias("k"), (F.col("id") % 2).alias("v"))
    got = positions_of(df, {"a": (Ordering("v", "k"), [1, 50_000, 100_000, 100_001, 200_000])}, 200_000)["a"]
    assert got == {1: (0, 0), 50_000: (0, 99_998), 100_000: (0, 199_998), 100_001: (1, 1), 200_000: (1, 199_999)}
    assert 1 <= len(rounds) <= 4
