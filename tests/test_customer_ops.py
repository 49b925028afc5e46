"""Segment rule, purchase gaps, cohorts and histograms against brute force."""

import datetime as dt
import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from cartwheel.operators.cohort import cohort_retention
from cartwheel.operators.gaps import customer_gap_stats
from cartwheel.operators.histogram import equal_width_histogram
from cartwheel.operators.rfm import segment_expr


# Expected segments by R score (rows 1..5) and R+F+M total (columns 3..15), from the rule's two thresholds on the
# total and the cases of R below them.
_LOW = {1: "Lost", 2: "Hibernating", 3: "At Risk"}
EXPECTED = {r: ([_LOW[r]] * 7 if r <= 3 else ["New Customers"] * 5 + ["Potential Loyalists"] * 2)
            + ["Loyal Customers"] * 3 + ["Champions"] * 3 for r in range(1, 6)}


def test_segment_rule_all_125_triples(spark):
    triples = list(itertools.product(range(1, 6), repeat=3))
    df = spark.createDataFrame(triples, "r long, f long, m long")
    out = df.select("r", "f", "m", segment_expr(F.col("r") + F.col("f") + F.col("m"), F.col("r")).alias("s"))
    got = {(x.r, x.f, x.m): x.s for x in out.collect()}
    assert got == {(r, f, m): EXPECTED[r][r + f + m - 3] for r, f, m in triples}


def _gaps_brute(rows):
    by = {}
    for c, ts in rows:
        by.setdefault(c, set()).add(ts)
    out = {}
    for c, stamps in by.items():
        s = sorted(stamps)
        gaps = [(b.date() - a.date()).days for a, b in zip(s, s[1:])]
        if gaps:
            out[c] = (len(gaps), sum(gaps), min(gaps), max(gaps))
    return out


def test_gap_stats_match_consecutive_pairs(spark):
    rnd = random.Random(3)
    base = dt.datetime(2011, 1, 1)
    rows = []
    for c in range(40):
        for _ in range(rnd.randrange(1, 12)):
            rows.append((c, base + dt.timedelta(days=rnd.randrange(60), minutes=rnd.choice([0, 5, 600, 1439]))))
    rows += [(99, base), (99, base)]  # same timestamp twice: one purchase, no gap
    rows += [(98, base), (98, base + dt.timedelta(hours=2))]  # same day: gap 0
    df = spark.createDataFrame(rows, "customer_id long, invoice_date timestamp_ntz")
    got = {r.customer_id: (r.n_gaps, r.sum_gaps, r.min_gap, r.max_gap) for r in customer_gap_stats(df).collect()}
    assert got == _gaps_brute(rows)
    assert 99 not in got and got[98] == (1, 0, 0, 0)


def test_cohort_offsets(spark):
    d = dt.datetime
    rows = [(1, d(2011, 1, 5)), (1, d(2011, 2, 5)), (1, d(2011, 6, 1)),   # offsets 0,1,5
            (2, d(2011, 1, 20)), (2, d(2011, 3, 2)),                      # offsets 0,2
            (3, d(2011, 2, 1)), (3, d(2011, 2, 28))]                      # Feb cohort, offset 0 only
    df = spark.createDataFrame(rows, "customer_id long, invoice_date timestamp_ntz")
    got = {r.cohort_month: tuple(r)[1:] for r in cohort_retention(df).collect()}
    assert got == {"2011-01": (2, 2, 1, 1, 1), "2011-02": (1, 1, 0, 0, 0)}


def test_histogram_matches_numpy(spark):
    rnd = random.Random(11)
    for vals in ([rnd.randrange(0, 1253) for _ in range(700)], [rnd.randrange(1, 51) for _ in range(300)], [7] * 5):
        df = spark.createDataFrame([(v,) for v in vals], "x long")
        got = equal_width_histogram(df, "x", 40).orderBy("bin").collect()
        counts, edges = np.histogram(vals, bins=40)
        assert [r.n for r in got] == counts.tolist()
        assert np.allclose([r.lo for r in got], edges[:-1]) and np.allclose([r.hi for r in got], edges[1:])
