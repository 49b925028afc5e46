"""CLV model plans: summary -> (fit) -> predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.numeric import round_half_up
from cartwheel.operators.clv import BGNBD_CDNOW, GAMMA_GAMMA_CDNOW, clv_summary, mean_loglik, predict_clv
from cartwheel.operators.fit import fit_bgnbd, fit_gamma_gamma
from cartwheel.plans.common import finalize
from cartwheel.session import ensure_checkpoint_dir


def clv_summary_table(fact: DataFrame) -> DataFrame:
    """Repeat customers' (frequency, recency, T, monetary_value)."""
    return finalize(clv_summary(fact))


def pred_customer_clv_fixed(fact: DataFrame, bg: dict | None = None, gg: dict | None = None) -> DataFrame:
    """``pred_customer_clv`` from literal model parameters (default: published CDNOW values)."""
    return predict_clv(clv_summary(fact), bg or BGNBD_CDNOW, gg or GAMMA_GAMMA_CDNOW)


def to_cents(pred: DataFrame) -> DataFrame:
    """Money columns of a prediction table reported to the cent."""
    return pred.select("customer_id", round_half_up(F.col("expected_avg_spend")).alias("expected_avg_spend"),
                       round_half_up(F.col("predicted_clv_12m")).alias("predicted_clv_12m"))


def fit_models(fact: DataFrame, penalizer: float = 0.01) -> tuple[DataFrame, dict, dict]:
    """The checkpointed summary of the repeat customers, and both models fitted on it; each fitter
    compresses and checkpoints its own inputs, so every optimiser pass reads short lineage."""
    ensure_checkpoint_dir(fact.sparkSession)
    summary = clv_summary(fact).checkpoint(eager=True)
    return summary, fit_bgnbd(summary, penalizer), fit_gamma_gamma(summary, penalizer)


def fit_and_predict(fact: DataFrame, penalizer: float = 0.01) -> tuple[DataFrame, dict, dict]:
    """Fit BG/NBD and Gamma-Gamma on the repeat customers and score them."""
    summary, bg, gg = fit_models(fact, penalizer)
    return predict_clv(summary, bg, gg), bg, gg


PARAMETERS = {"bg_nbd": ("r", "alpha", "a", "b"), "gamma_gamma": ("p", "q", "v")}


def fitted_parameters(fact: DataFrame, penalizer: float = 0.01) -> DataFrame:
    """One row per model: parameters, how the search ended and its certificate, to be stored as a table."""
    spark = fact.sparkSession
    summary, *fits = fit_models(fact, penalizer)
    rows = [(model, summary.count(), {n: fit[n] for n in names}, fit["at_bound"], fit["objective"], fit["converged"],
             fit["gradient_norm"], fit["curvature"], fit["certified"]) for (model, names), fit in zip(PARAMETERS.items(), fits)]
    return spark.createDataFrame(rows, "model string, customers long, parameters map<string,double>, at_bound array<string>, "
                                       "objective double, converged boolean, gradient_norm double, curvature double, certified boolean")


def predict_fitted(fact: DataFrame, parameters: DataFrame) -> DataFrame:
    """``pred_customer_clv`` from a table of ``fitted_parameters`` (two rows)."""
    known = {r["model"]: r["parameters"] for r in parameters.select("model", "parameters").collect()}
    return predict_clv(clv_summary(fact), known["bg_nbd"], known["gamma_gamma"])


def fit_optimum(parameters: DataFrame) -> DataFrame:
    """The fitted models and their certificates: penalised mean negative log-likelihood to four digits and the
    parameters that the data determine (BG/NBD's a and b run along a flat direction when nobody drops out)."""
    value = F.col("parameters")
    return parameters.select(
        "model", "customers", round_half_up(F.col("objective"), 4).alias("objective"),
        *[round_half_up(value[n], d).alias(n) for n, d in (("r", 4), ("alpha", 1), ("p", 4), ("q", 4), ("v", 4))],
        "converged", (F.col("certified") & (F.size("at_bound") == 0)).alias("optimal"))


def loglik_fixed(fact: DataFrame) -> DataFrame:
    """Mean log-likelihood and gradient of both models at the published parameters, to six digits
    after the point (the engines' logarithms differ in the last bits)."""
    out = mean_loglik(clv_summary(fact), BGNBD_CDNOW, GAMMA_GAMMA_CDNOW)
    return out.select("model", "customers", *[round_half_up(F.col(c), 6).alias(c)
                                              for c in ("loglik", "grad_0", "grad_1", "grad_2", "grad_3")])
