"""Invariants of the registered queries on the smallest driver tables."""

import math

import pytest

import __spark_entry__ as E
from tests.conftest import SF001


@pytest.fixture(scope="module")
def run(spark):
    qs = E.queries()
    cache = {}

    def get(name):
        if name not in cache:
            cache[name] = qs[name](spark, SF001).toPandas()
        return cache[name]
    return get


def test_shares_sum_to_100(run):
    assert abs(run("q02_segment_revenue").pct_of_total_revenue.sum() - 100) < 0.05
    assert abs(run("q02_segment_revenue").pct_of_total_customers.sum() - 100) < 0.05
    assert abs(run("q05_country_revenue").revenue_share_pct.sum() - 100) < 0.2
    assert abs(run("q09_revenue_deciles").pct_of_total_revenue.sum() - 100) < 0.05
    assert abs(run("q11_clv_by_segment").clv_share_pct.sum() - 100) < 0.05
    assert abs(run("app_segment_counts").pct.sum() - 100) < 0.5


def test_deciles_and_cohorts(run):
    sizes = run("q09_revenue_deciles").num_customers
    assert len(sizes) == 10 and sizes.max() - sizes.min() <= 1 and sizes.sum() == 150
    c = run("q08_cohort_retention")
    assert (c.cohort_size == c.month_0).all() and c.cohort_size.sum() == 150


def test_segments_and_scores(run):
    rfm = run("rfm_scores")
    for col in ("r_score", "f_score", "m_score"):
        assert rfm[col].between(1, 5).all()
    assert run("customer_rfm").rfm_segment.value_counts().sum() == len(rfm) == 150
    app = run("app_rfm")
    assert app.rfm_score.between(3, 15).all() and (app.clv_12month >= 0).all()
    assert run("app_segment_counts").n.sum() == 150
    k = run("app_kpis").iloc[0]
    assert k.total_customers == 150 and math.isclose(k.total_revenue, 7298876454.36, rel_tol=1e-12)


def test_clv_fit_predict_rows(run):
    fixed, fitted = run("clv_predict_fixed"), run("clv_fit_predict")
    assert len(fitted) == len(fixed) == len(run("clv_summary"))
    assert set(fitted.customer_id) == set(fixed.customer_id)
    assert fitted.predicted_clv_12m.map(math.isfinite).all()
    assert (fixed.predicted_clv_12m >= 0).all() and (fixed.expected_avg_spend > 0).all()
