"""Probabilistic customer-lifetime value: BG/NBD purchase counts with
Gamma-Gamma spend (Fader, Hardie & Lee 2005; Fader & Hardie 2013).

Summary and prediction are column expressions over the customer summary; the
likelihoods are numpy over Arrow batches, of which only sums leave a task; the
fitters (operators/fit.py) move parameter vectors and those sums.
Time is measured in days.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.numeric import ratio
from cartwheel.functions.special import digamma, hyp_expectations, lgamma

# Published CDNOW estimates (BG/NBD in weeks, converted to days
# for alpha; Gamma-Gamma in dollars), used as literal parameters.
BGNBD_CDNOW = {"r": 0.243, "alpha": 4.414 * 7, "a": 0.793, "b": 2.426}
GAMMA_GAMMA_CDNOW = {"p": 6.25, "q": 3.74, "v": 15.44}

REV = "total_line_revenue"


def clv_summary(fact: DataFrame, observation_end: str | None = None, repeat_only: bool = True) -> DataFrame:
    """Per customer, on day periods: frequency (active days - 1), recency (days
    first -> last active day), T (days first active day -> end) and
    monetary_value (mean daily spend over the repeat days, 0 without any).

    The end defaults to the last invoice date in the data; later lines are
    ignored.  Two aggregations: to (customer, day) and to customer; both
    combine map-side, so one customer with a third of all lines is spread
    over (customer, day) keys first and arrives pre-summed.
    """
    f = fact
    if observation_end is not None:
        # The model counts whole days: the end day belongs to the observation.
        f = f.filter(F.col("invoice_date") < F.date_add(F.to_date(F.lit(observation_end)), 1).cast("timestamp_ntz"))
    daily = f.groupBy("customer_id", F.to_date("invoice_date").alias("d")).agg(F.sum(REV).alias("spend"))
    per = daily.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_days"),
        F.min("d").alias("first_d"),
        F.max("d").alias("last_d"),
        F.sum("spend").alias("total"),
        F.min_by("spend", "d").alias("first_spend"))
    if observation_end is not None:
        end = F.to_date(F.lit(observation_end))
    else:
        # Scalar subquery: a one-column partial aggregate over the lines (no
        # shuffle), not a second pass of the per-customer aggregation.
        end = f.agg(F.to_date(F.max("invoice_date"))).scalar()
    freq = F.col("n_days") - F.lit(1)
    out = per.select(
        "customer_id",
        freq.cast("bigint").alias("frequency"),
        F.datediff("last_d", "first_d").cast("double").alias("recency"),
        F.datediff(end, F.col("first_d")).cast("double").alias("T"),
        F.when(freq > 0, ratio(F.col("total") - F.col("first_spend"), freq)).otherwise(F.lit(0.0))
         .alias("monetary_value"))
    return out.filter(F.col("frequency") > 0) if repeat_only else out


def bgnbd_terms(rows: dict[str, np.ndarray], r: float, alpha: float, a: float, b: float):
    """BG/NBD log-likelihood per customer (eq. 6 of the 2005 paper, log-sum-exp form) and its
    gradient by (log r, log alpha, log a, log b); ``rows`` has x, tx, tt."""
    x, tx, tt = rows["x"], rows["tx"], rows["tt"]
    one = np.ones_like(x)
    a3 = -(r + x) * np.log(alpha + tt)
    past = b + np.maximum(x, 1.0) - 1.0
    a4 = math.log(a) - np.log(past) - (r + x) * np.log(alpha + tx)
    # Without a repeat purchase only the first term counts, so it alone sets the scale.
    top = np.where(x > 0, np.maximum(a3, a4), a3)
    e3, e4 = np.exp(a3 - top), np.where(x > 0, np.exp(np.minimum(a4 - top, 0.0)), 0.0)
    ll = (lgamma(r + x) - lgamma(r * one) + r * math.log(alpha) + lgamma((a + b) * one) + lgamma(b + x)
          - lgamma(b * one) - lgamma(a + b + x) + np.log(e3 + e4) + top)
    w3 = e3 / (e3 + e4)
    w4 = 1.0 - w3
    d_ab, d_abx = digamma((a + b) * one), digamma(a + b + x)
    d_r = digamma(r + x) - digamma(r * one) + math.log(alpha) - w3 * np.log(alpha + tt) - w4 * np.log(alpha + tx)
    d_alpha = r / alpha - (r + x) * (w3 / (alpha + tt) + w4 / (alpha + tx))
    d_a = d_ab - d_abx + w4 / a
    d_b = d_ab + digamma(b + x) - digamma(b * one) - d_abx - w4 / past
    return ll, [r * d_r, alpha * d_alpha, a * d_a, b * d_b]


def gamma_gamma_terms(rows: dict[str, np.ndarray], p: float, q: float, v: float):
    """Gamma-Gamma log-likelihood of the mean spend m over x transactions, and its gradient by
    (log p, log q, log v); ``rows`` has x, m."""
    x, m = rows["x"], rows["m"]
    one = np.ones_like(x)
    px, lx = p * x, np.log(x * m + v)
    ll = (lgamma(px + q) - lgamma(px) - lgamma(q * one) + q * math.log(v) + (px - 1.0) * np.log(m) + px * np.log(x)
          - (px + q) * lx)
    d_pxq = digamma(px + q)
    d_p = x * (d_pxq - digamma(px) + np.log(m) + np.log(x) - lx)
    d_q = d_pxq - digamma(q * one) + math.log(v) - lx
    d_v = q / v - (px + q) / (x * m + v)
    return ll, [p * d_p, q * d_q, v * d_v]


def likelihood_sums(data: DataFrame, terms, points: list[dict[str, float]], d: int) -> DataFrame:
    """``id, W, S, G0..``: per point, the summed weights (column ``w``), weighted log-likelihoods and gradients
    over ``data``.  Tasks sum their rows; only one row per task and point is shuffled."""
    names = ["id", "W", "S", *[f"G{i}" for i in range(d)]]

    def run(batches):
        total = np.zeros((len(points), 2 + d))
        for batch in batches:
            rows = {n: batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i, n in enumerate(batch.schema.names)}
            for k, point in enumerate(points):
                with np.errstate(all="ignore"):  # a point far off gives infinities, which the search refuses
                    ll, grads = terms(rows, **point)
                    total[k] += [rows["w"].sum(), (rows["w"] * ll).sum(), *[(rows["w"] * g).sum() for g in grads]]
        cols = [pa.array(np.arange(len(points)), pa.int32()), *[pa.array(c) for c in total.T]]
        yield pa.RecordBatch.from_arrays(cols, names)

    sums = data.mapInArrow(run, "id int, " + ", ".join(f"{n} double" for n in names[1:]))
    return sums.groupBy("id").agg(*[F.sum(n).alias(n) for n in names[1:]])


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


def expected_avg_spend(x: Column, m: Column, p, q, v) -> Column:
    """E[spend | x, m] = p (v + x m) / (p x + q - 1): the customer's own mean and
    the population mean v p / (q - 1), weighted by p x and q - 1.  In this form
    q = 1 needs no special case."""
    p, q, v = _lit(p), _lit(q), _lit(v)
    xd = x.cast("double")
    return (p * (v + xd * m)) / (p * xd + q - F.lit(1.0))


def expected_purchases(horizons: list[float], x: Column, t_x: Column, t_obs: Column, r: float, alpha: float,
                       a: float, b: float) -> Column:
    """BG/NBD expected purchases in (T, T + t] given (x, t_x, T), as an array over the horizons t.

    The paper's 2F1(r+x, b+x; a+b+x-1; z) with z = t/(alpha+T+t) converges
    slowly for z near 1.  With Euler's transformation and e = a - 1 the
    numerator is

        c (-(u/e) (1 + e S) - S),  u = (1-z)^e - 1,
        S = sum_j (a+b-1-r)_j (1+e)_(j-1) / ((c)_j j!) z^j,  c = a+b+x-1,

    where u/e tends to log(1-z) as a tends to 1, so no parameter is singular.
    S is summed until no term changes it.  Beyond z = 0.8, where that takes many
    terms, and for a > 4, where they cancel, the numerator is integrated as a mean
    over the drop-out probability at a fixed number of points
    (``functions.special.purchases_integral``); a customer without a repeat
    purchase stays with the series if b < 1.
    """
    return hyp_expectations(tuple(float(t) for t in horizons), float(r), float(alpha), float(a), float(b))(
        x.cast("double"), t_x.cast("double"), t_obs.cast("double"))


def discounted_clv(spend: Column, cumulative: list[Column], discount_rate: float = 0.01) -> Column:
    """sum_k spend * (E_k - E_{k-1}) / (1 + d)^k over the cumulative expected
    purchases E_1..E_n at the end of each month (E_0 = 0), summed in k order."""
    prev = F.lit(0.0)
    total = None
    for k, cur in enumerate(cumulative, start=1):
        step = (spend * (cur - prev)) / F.pow(F.lit(1.0 + discount_rate), F.lit(float(k)))
        total = step if total is None else total + step
        prev = cur
    return total


def predict_clv(summary: DataFrame, bg: dict, gg: dict, months: int = 12,
                discount_rate: float = 0.01, days_per_month: int = 30) -> DataFrame:
    """``pred_customer_clv``: customer_id, expected_avg_spend, predicted_clv_12m.

    Narrow (no shuffle): parameters are literals, every customer row is
    scored independently, all horizons in one Arrow-batched call.
    """
    x, m = F.col("frequency"), F.col("monetary_value")
    horizons = [float(k * days_per_month) for k in range(1, months + 1)]
    s = summary.select("customer_id",
                       expected_avg_spend(x, m, gg["p"], gg["q"], gg["v"]).alias("expected_avg_spend"),
                       expected_purchases(horizons, x, F.col("recency"), F.col("T"),
                                          bg["r"], bg["alpha"], bg["a"], bg["b"]).alias("__e"))
    clv = discounted_clv(F.col("expected_avg_spend"), [F.col("__e")[k] for k in range(months)], discount_rate)
    return s.select("customer_id", "expected_avg_spend", clv.alias("predicted_clv_12m"))


def mean_loglik(summary: DataFrame, bg: dict, gg: dict) -> DataFrame:
    """Per model: mean log-likelihood of the repeat customers at given parameters, and its gradient with
    respect to the log-parameters (NULL for the fourth of Gamma-Gamma's three), by the fitter's terms."""
    def one(name: str, data: DataFrame, terms, point: dict, d: int) -> DataFrame:
        return likelihood_sums(data, terms, [point], d).select(
            F.lit(name).alias("model"), F.col("W").cast("bigint").alias("customers"), (F.col("S") / F.col("W")).alias("loglik"),
            *[(F.col(f"G{i}") / F.col("W") if i < d else F.lit(None).cast("double")).alias(f"grad_{i}") for i in range(4)])

    x, w = F.col("frequency").cast("double").alias("x"), F.lit(1.0).alias("w")
    return one("bg_nbd", summary.select(x, F.col("recency").alias("tx"), F.col("T").alias("tt"), w), bgnbd_terms, bg, 4).unionByName(
        one("gamma_gamma", summary.select(x, F.col("monetary_value").alias("m"), w), gamma_gamma_terms, gg, 3))
