"""Special functions for the CLV model, vectorised over Arrow batches.

Spark SQL has neither a log-gamma nor a digamma or hypergeometric function;
the model operators need all three.  As column expressions log-gamma and
digamma make plans so large that planning and compiling them took about a
second per optimiser step, whatever the data; in numpy a step plans at once.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

_HALF_LN_2PI = 0.5 * math.log(2.0 * math.pi)
_SHIFT = 8


def _shifted(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    small = z < _SHIFT
    return small, np.where(small, z + _SHIFT, z)


def lgamma(z) -> np.ndarray:
    """ln Gamma(z) for z > 0.

    Stirling's series with terms up to z^-9 at w = z (or w = z + 8 for
    z < 8, undoing the shift with ln(z (z+1) ... (z+7))).  Truncation error
    of the series at w >= 8 is about 2e-13; tests compare with math.lgamma
    to 1e-10 relative from z = 1e-6 to 1e6.
    """
    z = np.asarray(z, float)
    small, w = _shifted(z)
    inv2 = 1.0 / (w * w)
    series = (1.0 / 12 - inv2 * (1.0 / 360 - inv2 * (1.0 / 1260 - inv2 * (1.0 / 1680 - inv2 / 1188)))) / w
    out = (w - 0.5) * np.log(w) - w + _HALF_LN_2PI + series
    low = z[small]
    out[small] -= np.log(np.prod([low + i for i in range(_SHIFT)], axis=0))
    return out


def digamma(z) -> np.ndarray:
    """psi(z) = d/dz ln Gamma(z) for z > 0: asymptotic series at w = z (or z + 8,
    undoing the shift with sum 1/(z+i)).  Series truncation error at w >= 8 is
    about 3e-13; tests compare with a finite difference of math.lgamma."""
    z = np.asarray(z, float)
    small, w = _shifted(z)
    inv2 = 1.0 / (w * w)
    series = inv2 * (1.0 / 12 - inv2 * (1.0 / 120 - inv2 * (1.0 / 252 - inv2 * (1.0 / 240 - inv2 / 132))))
    out = np.log(w) - 0.5 / w - series
    low = z[small]
    out[small] -= sum(1.0 / (low + i) for i in range(_SHIFT))
    return out


MAX_TERMS = 2_000_000


def series_sum(big_a: float, e: float, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """sum over j >= 1 of (A)_j (1+e)_(j-1) / ((c)_j j!) z^j for 0 <= z < 1, each element summed
    until it does not change any more; raises if that takes more than ``MAX_TERMS`` terms."""
    out = np.zeros(z.shape)
    left = np.arange(z.size)
    c, z = np.ravel(c), np.ravel(z)
    t = (big_a / c) * z
    s = t.copy()
    for j in range(1, MAX_TERMS):
        t = t * (((big_a + j) * (e + j)) / ((c + j) * (j + 1.0))) * z
        new = s + t
        # Terms may grow until e + j < j + 1 in effect; after that they only shrink.
        done = (new == s) & ((j > e) | (t == 0))
        s = new
        if done.any():
            out.flat[left[done]] = s[done]
            left, c, z, t, s = (v[~done] for v in (left, c, z, t, s))
            if not left.size:
                return out
    raise ArithmeticError(f"series not converged after {MAX_TERMS} terms (z up to {float(z.max())})")


SERIES_Z = 0.8  # the series takes some 160 terms up to here
SERIES_A = 4.0  # beyond it the series' terms cancel
NODES = 200
DROP = 26.0  # the integrand is left off where it is below e^-26 of its peak
BLOCK = 4096  # elements integrated together, so the nodes take about 7 MB


def _reach(side: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How far from its mode p^side (1-p)^other, in log-odds of p, has fallen by ``DROP`` towards p = 0:
    there it falls as exp(-side d) in the end, and near the mode with the curvature of both exponents."""
    return DROP / side + np.sqrt(2.0 * DROP * (side + other) / (side * other))


def purchases_integral(x: np.ndarray, w: np.ndarray, r: float, a: float, b: float) -> np.ndarray:
    """Mean over p ~ Beta(a, b + x) of g(p) = (1 - (1 + p w)^-(r+x)) / p: the numerator of the
    expected purchases, for b + x >= 1 and any w = t / (alpha + T) > 0.

    The trapezoid rule in the log-odds of p, over ``NODES`` points between which the integrand
    lies: it converges geometrically there, whatever w is.  Both integrals of the mean use the same
    nodes, so no gamma function is needed.  For a < 1 the mean is g(0) plus that of g(p) - g(0), which
    vanishes at p = 0 and so has no long tail there.
    """
    shape, right, left = r + x, b + x, a if a >= 1 else a + 1.0  # exponents of 1 + pw, 1 - p and p
    inner = left - 1.0
    turn = -np.log(w * shape)  # below it the power is linear in p
    mode = np.log(left / right)
    lo = np.minimum(turn, mode) - _reach(left, right)
    if inner > 0:  # what lies below may be negligible before the turn
        lo = np.maximum(lo, np.log(inner / right) - _reach(inner, right))
    hi = mode + _reach(right, left)
    y = lo[:, None] + (hi - lo)[:, None] * (np.arange(NODES) + 0.5)[None, :] / NODES
    log_p, log_q = -np.logaddexp(0.0, -y), -np.logaddexp(0.0, y)
    weight = left * log_p + right[:, None] * log_q
    weight = np.exp(weight - weight.max(axis=1, keepdims=True))
    p = np.exp(log_p)
    power = -np.expm1(-shape[:, None] * np.log1p(p * w[:, None]))
    if a >= 1:
        return (weight * power / p).sum(axis=1) / weight.sum(axis=1)
    first = w * shape
    below = (weight / p * (power / p - first[:, None])).sum(axis=1) / weight.sum(axis=1)
    return first + a / (a + right) * below


def _numerator_series(x, t, base, r: float, a: float, b: float) -> np.ndarray:
    e = a - 1.0
    c = ((a + b) + x) - 1.0
    z = t / (base + t)
    s = series_sum(((a + b) - 1.0) - r, e, c, z)
    log_rest = np.log1p(-z)
    u = np.expm1(e * log_rest) / e if e else log_rest
    return c * (-(u * (1.0 + e * s)) - s)


def expectations(x, t_x, t_obs, horizons, r: float, alpha: float, a: float, b: float) -> np.ndarray:
    """Expected purchases (rows by horizons) in numpy; see ``operators.clv.expected_purchases``."""
    x, t_x, t_obs = (np.asarray(v, float)[:, None] for v in (x, t_x, t_obs))
    t = np.asarray(horizons, float)[None, :]
    base = alpha + t_obs
    xs, ts, bases = (np.ravel(np.broadcast_to(v, (len(x), t.shape[1]))) for v in (x, t, base))
    numerator = np.zeros(len(xs))
    near = ((ts / (bases + ts) > SERIES_Z) | (a > SERIES_A)) & (b + xs >= 1.0) & (ts > 0)
    far = np.flatnonzero(~near)
    if far.size:
        numerator[far] = _numerator_series(xs[far], ts[far], bases[far], r, a, b)
    near = np.flatnonzero(near)
    for i in range(0, near.size, BLOCK):
        part = near[i:i + BLOCK]
        numerator[part] = purchases_integral(xs[part], ts[part] / bases[part], r, a, b)
    # x = 0 has no drop-out term (b - 1 may be zero there).
    repeat = x > 0
    drop = np.where(repeat, a / np.where(repeat, (b + x) - 1.0, 1.0) * (base / (alpha + t_x)) ** (r + x), 0.0)
    return numerator.reshape(len(x), t.shape[1]) / (1.0 + drop)


@functools.lru_cache(maxsize=32)
def hyp_expectations(horizons: tuple, r: float, alpha: float, a: float, b: float):
    """Arrow-batched column function (x, t_x, T) -> array of expected purchases.

    The sum has no closed form in Spark's functions; as a higher-order fold it
    runs interpreted at about 5 microseconds a term (22.6 s for 15k customers
    x 12 horizons at sf0.1 on 8 cores, 1.8 s batched)."""
    @F.pandas_udf("array<double>")
    def expected(x: pd.Series, t_x: pd.Series, t_obs: pd.Series) -> pd.Series:
        return pd.Series(list(expectations(x, t_x, t_obs, horizons, r, alpha, a, b)))

    return expected
