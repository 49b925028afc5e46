"""Model maths: log-gamma, the transformed 2F1 series, likelihoods, spend weights."""

import math

import numpy as np
from pyspark.sql import functions as F

from cartwheel.functions.special import lgamma
from cartwheel.operators.clv import (
    BGNBD_CDNOW, GAMMA_GAMMA_CDNOW, bgnbd_terms, clv_summary, expected_avg_spend, expected_purchases,
    gamma_gamma_terms,
)


def _hyp2f1_direct(a, b, c, z, terms=200000):
    """Plain series; all terms positive for the cases used, so summation is accurate."""
    s, t = 1.0, 1.0
    for j in range(1, terms):
        t *= (a + j - 1) * (b + j - 1) / ((c + j - 1) * j) * z
        s += t
        if t < 1e-18 * s:
            break
    return s


def _expected_direct(t, x, tx, T, r, alpha, a, b):
    """The paper's closed form with the untransformed hypergeometric term."""
    z = t / (alpha + T + t)
    hyp = _hyp2f1_direct(r + x, b + x, a + b + x - 1, z)
    first = (a + b + x - 1) / (a - 1)
    second = 1 - ((alpha + T) / (alpha + T + t)) ** (r + x) * hyp
    den = 1 + (x > 0) * (a / (b + x - 1)) * ((alpha + T) / (alpha + tx)) ** (r + x)
    return first * second / den


def test_lgamma_matches_math(spark):
    zs = [1e-6, 0.01, 0.243, 0.5, 1.0, 1.5, 2.426, 7.99, 8.0, 8.01, 30.0, 1234.5, 1e6]
    got = lgamma(zs)
    for z, g in zip(zs, got):
        assert abs(g - math.lgamma(z)) < 1e-10 * max(1.0, abs(math.lgamma(z))), (z, g, math.lgamma(z))


def _check_expected(spark, p, cases, horizons):
    df = spark.createDataFrame(cases, "x long, tx double, T double")
    got = [r[0] for r in df.select(expected_purchases(horizons, F.col("x"), F.col("tx"), F.col("T"),
                                                      p["r"], p["alpha"], p["a"], p["b"])).collect()]
    for (x, tx, T), e in zip(cases, got):
        for t, g in zip(horizons, e):
            want = _expected_direct(t, x, tx, T, p["r"], p["alpha"], p["a"], p["b"])
            assert math.isclose(g, want, rel_tol=1e-9, abs_tol=1e-12), (t, x, tx, T, g, want)


def test_expected_purchases_matches_untransformed_formula(spark):
    cases = [(1, 10.0, 30.0), (2, 5.0, 400.0), (5, 300.0, 800.0), (12, 900.0, 1000.0), (20, 2000.0, 2400.0)]
    _check_expected(spark, BGNBD_CDNOW, cases, [30.0, 180.0, 360.0])


def test_expected_purchases_far_from_published_parameters(spark):
    """alpha = 1 day and T = 1: z near 1, where a fixed number of terms is far off."""
    _check_expected(spark, {"r": 0.2, "alpha": 1.0, "a": 3.0, "b": 2.4}, [(1, 1.0, 1.0), (3, 2.0, 5.0)], [30.0, 360.0])


def test_expected_purchases_at_a_equal_one(spark):
    p = {"r": 0.5, "alpha": 10.0, "b": 2.0}
    at = {}
    for a in (1.0 - 1e-7, 1.0, 1.0 + 1e-7):
        df = spark.createDataFrame([(2, 20.0, 60.0), (0, 0.0, 10.0)], "x long, tx double, T double")
        at[a] = [r[0] for r in df.select(expected_purchases([30.0, 360.0], F.col("x"), F.col("tx"), F.col("T"),
                                                            p["r"], p["alpha"], a, p["b"])).collect()]
    low, mid, high = at.values()
    for x, y, z in zip(low, mid, high):
        for u, v, w in zip(x, y, z):
            assert math.isclose(v, (u + w) / 2, rel_tol=1e-9)


def test_series_says_when_it_does_not_converge(monkeypatch):
    import pytest
    from cartwheel.functions import special
    monkeypatch.setattr(special, "MAX_TERMS", 50)
    with pytest.raises(ArithmeticError):
        special.series_sum(2.0, 0.5, np.array([3.0]), np.array([0.999]))


def test_integral_agrees_with_the_series_where_both_hold():
    from cartwheel.functions import special
    x = np.array([1.0, 2.0, 30.0, 1e4])
    for a in (1e-9, 0.3, 0.793, 1.0, 1.0001, 3.0):
        for b in (0.1, 2.426, 80.0):
            for z in (0.5, 0.9, 0.999):
                w = np.full(len(x), z / (1 - z))
                want = special._numerator_series(x, w, np.ones(len(x)), 0.243, a, b)
                assert np.allclose(special.purchases_integral(x, w, 0.243, a, b), want, rtol=1e-9, atol=0), (a, b, z)


def test_integral_near_z_one(monkeypatch):
    """A fixed number of points up to z = 1 - 1e-6, where the series takes millions of terms: ten times as
    many points and a wider range give the same."""
    from cartwheel.functions import special
    x = np.array([1.0, 5.0, 300.0])
    cases = [(a, b, w) for a in (1e-3, 0.793, 1.0, 30.0, 3000.0) for b in (0.5, 8000.0) for w in (1e2, 1e6)]
    got = [special.purchases_integral(x, np.full(3, w), 0.3, a, b) for a, b, w in cases]
    monkeypatch.setattr(special, "NODES", 2000)
    monkeypatch.setattr(special, "DROP", 40.0)
    for (a, b, w), g in zip(cases, got):
        assert np.allclose(g, special.purchases_integral(x, np.full(3, w), 0.3, a, b), rtol=1e-9, atol=0), (a, b, w)


def test_expected_purchases_never_need_many_terms(monkeypatch):
    """T = 0 and a tiny alpha among usual customers: the series is cut at 250 terms and still ends."""
    from cartwheel.functions import special
    monkeypatch.setattr(special, "MAX_TERMS", 250)
    out = special.expectations([1, 2, 50], [0.0, 3.0, 300.0], [0.0, 10.0, 700.0], [30.0 * k for k in range(1, 13)],
                               0.25, 1e-4, 0.8, 2.4)
    assert np.isfinite(out).all() and (np.diff(out, axis=1) > 0).all()


def test_end_day_belongs_to_the_observation(spark):
    rows = [(1, "2011-01-01 09:00:00", 5.0), (1, "2011-02-01 12:00:00", 7.0), (1, "2011-02-02 00:00:00", 9.0)]
    fact = (spark.createDataFrame(rows, "customer_id long, t string, total_line_revenue double")
            .withColumn("invoice_date", F.col("t").cast("timestamp_ntz")))
    r = clv_summary(fact, "2011-02-01").first()
    assert (r.frequency, r.recency, r["T"], r.monetary_value) == (1, 31.0, 31.0, 7.0)


def test_spend_at_q_equal_one(spark):
    df = spark.createDataFrame([(2, 10.0)], "x long, m double")
    assert math.isclose(df.select(expected_avg_spend(F.col("x"), F.col("m"), 3.0, 1.0, 4.0)).first()[0], (4 + 20) / 2)


def test_bgnbd_loglik_matches_lgamma_form(spark):
    r, al, a, b = 0.5, 3.0, 0.8, 2.0
    rows = [(0, 0.0, 5.0), (1, 2.0, 5.0), (7, 4.5, 6.0)]
    got, _ = bgnbd_terms(dict(zip(("x", "tx", "tt"), np.array(rows, float).T)), r, al, a, b)
    lg = math.lgamma
    for (x, tx, T), g in zip(rows, got):
        a1 = lg(r + x) - lg(r) + r * math.log(al)
        a2 = lg(a + b) + lg(b + x) - lg(b) - lg(a + b + x)
        a3 = -(r + x) * math.log(al + T)
        a4 = math.log(a) - math.log(b + max(x, 1) - 1) - (r + x) * math.log(tx + al)
        want = a1 + a2 + math.log(math.exp(a3) + (x > 0) * math.exp(a4))
        assert math.isclose(g, want, rel_tol=1e-10), (x, g, want)


def test_gamma_gamma_pieces(spark):
    p, q, v = GAMMA_GAMMA_CDNOW["p"], GAMMA_GAMMA_CDNOW["q"], GAMMA_GAMMA_CDNOW["v"]
    df = spark.createDataFrame([(1, 20.0), (4, 35.5), (1000000, 12.0)], "x long, m double")
    spend = [r[0] for r in df.select(expected_avg_spend(F.col("x"), F.col("m"), p, q, v)).collect()]
    assert math.isclose(spend[0], p * (v + 1 * 20.0) / (p * 1 + q - 1), rel_tol=1e-12)
    assert math.isclose(spend[1], p * (v + 4 * 35.5) / (p * 4 + q - 1), rel_tol=1e-12)
    assert abs(spend[2] - 12.0) < 1e-3  # many transactions: the customer's own mean dominates
    ll, _ = gamma_gamma_terms({"x": np.array([1.0, 4.0]), "m": np.array([20.0, 35.5])}, p, q, v)
    lg = math.lgamma
    for (x, m), g in zip([(1, 20.0), (4, 35.5)], ll[:2]):
        want = (lg(p * x + q) - lg(p * x) - lg(q) + q * math.log(v) + (p * x - 1) * math.log(m)
                + p * x * math.log(x) - (p * x + q) * math.log(x * m + v))
        assert math.isclose(g, want, rel_tol=1e-10)


def test_digamma_matches_lgamma_derivative(spark):
    from cartwheel.functions.special import digamma
    zs = [1e-3, 0.2, 0.9, 3.0, 7.99, 8.0, 25.0, 1e4]
    got = digamma(zs)
    for z, g in zip(zs, got):
        h = 1e-5 * z
        want = (math.lgamma(z + h) - math.lgamma(z - h)) / (2 * h)
        assert abs(g - want) < 1e-6 * max(1.0, abs(want)), (z, g, want)


def test_scores_match_finite_differences():
    rows = dict(zip(("x", "tx", "tt"), np.array([(0, 0.0, 0.7), (1, 0.2, 0.9), (6, 0.55, 1.0), (15, 0.9, 0.95)]).T))
    spend = {"x": np.array([1.0, 3.0, 12.0]), "m": np.array([20.0, 55.5, 9.0])}
    for terms, data, base in ((bgnbd_terms, rows, {"r": 0.6, "alpha": 0.3, "a": 0.8, "b": 2.2}),
                              (gamma_gamma_terms, spend, {"p": 2.0, "q": 3.5, "v": 12.0})):
        _, grads = terms(data, **base)
        for name, g in zip(base, grads):
            h = 1e-6
            up, _ = terms(data, **{**base, name: base[name] * math.exp(h)})
            down, _ = terms(data, **{**base, name: base[name] * math.exp(-h)})
            assert np.allclose(g, (up - down) / (2 * h), rtol=1e-5, atol=1e-7), name


def test_fitters_recover_known_parameters(spark):
    """Gamma-Gamma parameter recovery on seeded draws from the model itself."""
    from cartwheel.operators.fit import fit_gamma_gamma
    rng = np.random.default_rng(5)
    p, q, v = 6.0, 4.0, 15.0
    n = 4000
    x = rng.integers(1, 15, n)
    nu = rng.gamma(q, 1.0 / v, n)                     # per-customer rate
    m = np.array([rng.gamma(p * xi, 1.0 / (nui * xi)) for xi, nui in zip(x, nu)])  # mean of x draws
    df = spark.createDataFrame([(int(i), int(a), float(b)) for i, (a, b) in enumerate(zip(x, m))],
                               "customer_id long, frequency long, monetary_value double")
    fit = fit_gamma_gamma(df, penalizer=0.0)
    assert abs(fit["p"] - p) / p < 0.15 and abs(fit["q"] - q) / q < 0.25 and abs(fit["v"] - v) / v < 0.3, fit


def test_bgnbd_recovery_on_model_draws(spark):
    """BG/NBD parameters from seeded draws of the model; the gradient at the result is zero."""
    from cartwheel.operators.fit import fit_bgnbd
    rng = np.random.default_rng(3)
    r, alpha, a, b, n, end = 0.8, 30.0, 0.8, 2.4, 6000, 700.0
    rows = []
    for i in range(n):
        rate, drop, t, x, last = rng.gamma(r, 1 / alpha), rng.beta(a, b), 0.0, 0, 0.0
        while True:
            t += rng.exponential(1 / rate)
            if t > end:
                break
            x, last = x + 1, t
            if rng.random() < drop:
                break
        rows.append((i, x, float(last), end))
    df = spark.createDataFrame(rows, "customer_id long, frequency long, recency double, T double")
    fit = fit_bgnbd(df, penalizer=0.0)
    assert fit["converged"] and fit["gradient_norm"] < 1e-4 and not fit["at_bound"]
    assert abs(fit["r"] / r - 1) < 0.15 and abs(fit["alpha"] / alpha - 1) < 0.15, fit
    assert abs(fit["a"] / (fit["a"] + fit["b"]) / (a / (a + b)) - 1) < 0.15, fit


def test_fit_reports_bounds_and_missing_convergence(spark):
    import pytest
    from cartwheel.operators.fit import fit_gamma_gamma
    df = spark.createDataFrame([(i, 1 + i % 5, float(10 ** (i % 7))) for i in range(200)],
                               "customer_id long, frequency long, monetary_value double")
    with pytest.warns(UserWarning, match="at the bound of q"):
        held = fit_gamma_gamma(df, penalizer=0.0, q_min=0.5)
    assert abs(held["q"] - 0.5) < 1e-9 and held["at_bound"] == ["q"] and held["converged"]
    with pytest.warns(UserWarning, match="not converged"):
        assert not fit_gamma_gamma(df, penalizer=0.0, max_iter=1)["converged"]
    scaled = fit_gamma_gamma(df, penalizer=0.0, q_min=0.5, monetary_scale=1000.0)
    assert abs(held["v"] / scaled["v"] - 1) < 1e-4


def test_certificate_tells_an_optimum_from_a_saddle_or_a_slope():
    from cartwheel.operators.fit import certificate, minimize_newton

    def surface(signs):
        def evaluate(points):
            return [(float((signs * t * t).sum()), 2.0 * signs * t) for t in points]
        return evaluate

    wide = np.full(2, -9.0), np.full(2, 9.0)
    bowl, saddle = surface(np.array([1.0, 3.0])), surface(np.array([1.0, -1.0]))
    here = certificate(bowl, np.zeros(2), *wide)
    assert here["certified"] and abs(here["curvature"] - 2.0) < 1e-6 and here["gradient_norm"] == 0
    assert not certificate(bowl, np.array([0.1, 0.0]), *wide)["certified"]
    at_saddle = certificate(saddle, np.zeros(2), *wide)
    assert at_saddle["gradient_norm"] == 0 and at_saddle["curvature"] < -1.9 and not at_saddle["certified"]
    held = minimize_newton(bowl, [3.0, 3.0], lower=np.array([1.0, -9.0]), upper=wide[1])  # pushed against its bound
    assert held["certified"] and held["at_bound"] == [True, False] and np.allclose(held["theta"], [1.0, 0.0], atol=1e-5)


def test_fitted_parameters_as_a_table(spark):
    from cartwheel.plans import models
    rng = np.random.default_rng(11)
    rows = [(c, f"2011-{m:02d}-{d:02d} 10:00:00", float(rng.gamma(6.0, 5.0)))
            for c in range(150) for m, d in sorted({(int(m), int(d)) for m, d in rng.integers(1, 13, (1 + c % 6, 2))})]
    fact = (spark.createDataFrame(rows, "customer_id long, t string, total_line_revenue double")
            .withColumn("invoice_date", F.col("t").cast("timestamp_ntz")))
    table = models.fitted_parameters(fact).cache()
    found = {r.model: r for r in models.fit_optimum(table).collect()}
    assert set(found) == {"bg_nbd", "gamma_gamma"} and found["gamma_gamma"].r is None and found["bg_nbd"].p is None
    assert all(r.converged and r.optimal for r in found.values())
    summary, bg, gg = models.fit_models(fact)
    want = {r.customer_id: r.predicted_clv_12m for r in models.predict_clv(summary, bg, gg).collect()}
    got = {r.customer_id: r.predicted_clv_12m for r in models.predict_fitted(fact, table).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[c], want[c], rel_tol=1e-6) for c in want)
