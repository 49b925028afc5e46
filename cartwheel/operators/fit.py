"""Maximum-likelihood fitting of the CLV models as Spark jobs.

The objective is mean(-loglik) over customers plus an L2 penalty on the
parameters, minimised over log-parameters by a damped Newton method.  The
customer summary is first compressed to distinct model inputs with a count
(customers sharing (x, t_x, T) contribute identically) and checkpointed.
Every optimiser step is ONE Spark job: the next point and one point beside it
per parameter (5 for BG/NBD, 4 for Gamma-Gamma) go to the tasks, which return
the summed objective and its analytic gradient at each; gradient differences
give the Hessian.  Only parameters and those sums cross the driver.

The result says how the search ended (``converged``, ``at_bound``) and carries a
certificate of the optimum, computed at the returned parameters by a job of its
own: ``gradient_norm`` (zero at an optimum) and ``curvature``, the least
eigenvalue of the Hessian (negative at a saddle), both over the parameters not
at a bound.  A search that did not converge, stopped at a bound or at a point
that the certificate refuses, or gave an infinite population mean (q <= 1) warns.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.operators.clv import bgnbd_terms, gamma_gamma_terms, likelihood_sums
from cartwheel.session import ensure_checkpoint_dir

Evaluate = Callable[[list[np.ndarray]], list[tuple[float, np.ndarray]]]

LOG_BOUND = 30.0  # parameters stay within exp(+-30)
ROWS_PER_PARTITION = 20_000
GRADIENT_ZERO = 1e-5  # largest gradient of a certified optimum (objectives are means per customer)
CURVATURE_ZERO = 1e-6  # a flat direction may be measured as falling by so much


def batch_gradients(data: DataFrame, terms, names: list[str], penalizer: float = 0.0) -> Evaluate:
    """(objective, gradient) in log-parameters for a few points, one job.

    ``terms(rows, **params)`` gives the per-row log-likelihood and its score with respect
    to the log-parameters; ``w`` is a row's count.
    """
    d = len(names)

    def evaluate(thetas: list[np.ndarray]) -> list[tuple[float, np.ndarray]]:
        points = [{n: float(math.exp(v)) for n, v in zip(names, t)} for t in thetas]
        out = [(math.inf, np.zeros(d))] * len(thetas)
        for r in likelihood_sums(data, terms, points, d).collect():  # one row per point
            values = [r["S"], *[r[f"G{i}"] for i in range(d)]]
            if not r["W"] or any(v is None or not math.isfinite(v) for v in values):
                continue
            p = np.exp(thetas[r["id"]])
            out[r["id"]] = (-r["S"] / r["W"] + penalizer * float(np.sum(p ** 2)),
                            -np.array(values[1:]) / r["W"] + 2.0 * penalizer * p ** 2)
        return out

    return evaluate


def minimize_newton(evaluate: Evaluate, theta0, max_iter: int = 100, h: float = 1e-5, tol: float = 1e-9,
                    gtol: float = 1e-6, max_step: float = 10.0, lower=None, upper=None) -> dict:
    """Damped Newton with analytic gradients; the Hessian is their forward differences.

    A job evaluates the trial point and the d points beside it, so an accepted step costs one job
    and a refused one (the step is then cut) another.  A coordinate at a bound whose gradient
    pushes outwards is held there, and the step is solved on the others.  ``converged`` means that the
    free gradient is below ``gtol`` or a full step gained less than ``tol``.
    """
    d = len(theta0)
    lo = np.full(d, -LOG_BOUND) if lower is None else np.asarray(lower, float)
    hi = np.full(d, LOG_BOUND) if upper is None else np.asarray(upper, float)

    def around(t):
        return [t + np.where(np.arange(d) == i, h if t[i] + h <= hi[i] else -h, 0.0) for i in range(d)]

    def look(t):
        points = around(t)
        (f, g), *beside = evaluate([t, *points])
        hess = np.column_stack([(gi - g) / (p - t)[i] for i, (p, (_, gi)) in enumerate(zip(points, beside))])
        return f, g, 0.5 * (hess + hess.T)

    theta = np.clip(np.asarray(theta0, float), lo, hi)
    f, g, hess = look(theta)
    converged, it, scale = False, 0, 1.0
    for it in range(1, max_iter + 1):
        free = ~(((theta <= lo + 1e-9) & (g > 0)) | ((theta >= hi - 1e-9) & (g < 0)))
        if not math.isfinite(f) or not np.isfinite(hess).all():
            break
        if not free.any() or float(np.abs(g[free]).max()) < gtol:
            converged = True
            break
        w, vecs = np.linalg.eigh(hess[np.ix_(free, free)])
        w = np.maximum(np.abs(w), 1e-8 * max(1.0, float(np.abs(w).max())))
        step = np.zeros(d)
        step[free] = -(vecs @ ((vecs.T @ g[free]) / w))
        step *= scale * min(1.0, max_step / float(np.abs(step).max()))
        trial = np.clip(theta + step, lo, hi)
        new = look(trial)
        if new[0] < f:
            gain, full = f - new[0], scale == 1.0
            theta, (f, g, hess), scale = trial, new, 1.0
            if full and gain < tol * (1.0 + abs(f)):
                converged = True
                break
        else:
            scale *= 0.25
            if scale < 1e-6:  # no descent within rounding
                converged = float(np.abs(g[free]).max()) < 1e3 * gtol
                break
    return {"theta": theta, "objective": f, "iterations": it, "converged": converged,
            **certificate(evaluate, theta, lo, hi)}


def certificate(evaluate: Evaluate, theta: np.ndarray, lo: np.ndarray, hi: np.ndarray, h: float = 1e-4) -> dict:
    """Gradient and least curvature at ``theta``, by one job and central differences of the gradient:
    independent of the path that led there.  ``certified`` means that no free parameter can lower the
    objective to second order, and that those at a bound are pushed against it."""
    d = len(theta)
    sides = [theta + s * h * np.eye(d)[i] for i in range(d) for s in (1.0, -1.0)]
    (_, g), *beside = evaluate([theta, *sides])
    free = ~(((theta <= lo + 1e-9) & (g > 0)) | ((theta >= hi - 1e-9) & (g < 0)))
    hess = np.column_stack([(beside[2 * i][1] - beside[2 * i + 1][1]) / (2.0 * h) for i in range(d)])
    part = (0.5 * (hess + hess.T))[np.ix_(free, free)]
    slope = float(np.abs(g[free]).max(initial=0.0))
    least = float(np.linalg.eigvalsh(part).min()) if free.any() else 0.0
    return {"gradient_norm": slope, "curvature": least, "at_bound": (~free).tolist(),
            "certified": slope < GRADIENT_ZERO and least > -CURVATURE_ZERO}


def _stable(df: DataFrame) -> DataFrame:
    """The compressed model inputs, spread by their number and written to the reliable checkpoint
    folder: each optimiser pass then reads a fixed, short lineage."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    df = df.checkpoint(eager=True)
    parts = max(1, min(df.count() // ROWS_PER_PARTITION + 1, 100_000))
    return df.repartition(parts).checkpoint(eager=True)


def _report(model: str, names: list[str], res: dict, params: dict) -> dict:
    at_bound = [n for n, b in zip(names, res["at_bound"]) if b]
    if not res["converged"]:
        warnings.warn(f"{model}: not converged after {res['iterations']} steps, gradient {res['gradient_norm']:.3g}", stacklevel=3)
    if at_bound:
        warnings.warn(f"{model}: at the bound of {', '.join(at_bound)}", stacklevel=3)
    if res["converged"] and not res["certified"]:
        warnings.warn(f"{model}: no optimum, gradient {res['gradient_norm']:.3g}, curvature {res['curvature']:.3g}", stacklevel=3)
    return {**params, "at_bound": at_bound,
            **{k: res[k] for k in ("objective", "iterations", "converged", "gradient_norm", "curvature", "certified")}}


def fit_bgnbd(summary: DataFrame, penalizer: float = 0.01, max_iter: int = 100) -> dict:
    """BG/NBD (r, alpha, a, b) by penalised maximum likelihood; alpha in days.

    Time is scaled so the longest T is 1 while fitting (the penalty applies
    on that scale); alpha is scaled back afterwards.
    """
    tmax_df = summary.agg(F.max("T").alias("tmax"))
    tmax_c = tmax_df.scalar()
    data = _stable(summary.groupBy("frequency", "recency", "T").agg(F.count(F.lit(1)).alias("w"))
                   .select(F.col("frequency").alias("x"), (F.col("recency") / tmax_c).alias("tx"),
                           (F.col("T") / tmax_c).alias("tt"), F.col("w").cast("double").alias("w")))
    names = ["r", "alpha", "a", "b"]
    res = minimize_newton(batch_gradients(data, bgnbd_terms, names, penalizer), np.zeros(4), max_iter)
    r, alpha, a, b = (float(v) for v in np.exp(res["theta"]))
    return _report("BG/NBD", names, res, {"r": r, "alpha": alpha * float(tmax_df.first()["tmax"]), "a": a, "b": b})


def fit_gamma_gamma(summary: DataFrame, penalizer: float = 0.01, max_iter: int = 100, q_min: float | None = None,
                    monetary_scale: float = 1.0) -> dict:
    """Gamma-Gamma (p, q, v) by penalised maximum likelihood on repeat customers.

    ``q_min`` bounds q from below (above 1 the population mean v p / (q - 1) is
    finite).  Spend is divided by ``monetary_scale`` while fitting, and the
    penalty applies on that scale; v is scaled back.
    """
    data = _stable(summary.filter(F.col("frequency") > 0)
                   .groupBy("frequency", "monetary_value").agg(F.count(F.lit(1)).cast("double").alias("w"))
                   .select(F.col("frequency").alias("x"), (F.col("monetary_value") / F.lit(float(monetary_scale))).alias("m"), "w"))
    names = ["p", "q", "v"]
    lower = np.array([-LOG_BOUND, -LOG_BOUND if q_min is None else math.log(q_min), -LOG_BOUND])
    res = minimize_newton(batch_gradients(data, gamma_gamma_terms, names, penalizer), np.zeros(3), max_iter, lower=lower)
    p, q, v = (float(x) for x in np.exp(res["theta"]))
    if q <= 1:
        warnings.warn(f"Gamma-Gamma: q = {q:.4g} <= 1, the population mean is not finite; set q_min", stacklevel=2)
    return _report("Gamma-Gamma", names, res, {"p": p, "q": q, "v": v * monetary_scale})
