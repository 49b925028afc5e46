"""Name -> query callable ``(spark, sf_dir) -> DataFrame`` for the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartwheel.functions.numeric import round_half_up
from cartwheel.operators.clean import clean_transactions, quality_counts, rejected_rows, split_counts, split_transactions
from cartwheel.operators import rfm
from cartwheel.plans import dashboard as app
from cartwheel.plans import approximate, models
from cartwheel.plans import questions as q
from cartwheel.operators.sketches import distinct_cube
from cartwheel.plans.common import dashboard_view, fact_from_testdata, fact_view, finalize, valid_lines
from cartwheel.plans.tables import materialize, stored_or
from cartwheel.sources import testdata
from cartwheel.sources.retail import conform_raw

Query = Callable[[SparkSession, str], DataFrame]


# Shared tables: written once per session and input folder (see plans.tables).

def _stored_fact(spark: SparkSession, sf_dir: str, store=materialize) -> DataFrame:
    """fact_transactions as stored: the ETL output plus the unstripped description,
    so the ETL runs once for the questions and the dashboard."""
    return store(spark, "fact_transactions", sf_dir,
                 lambda: fact_from_testdata(spark, sf_dir, keep_raw_description=True))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact_transactions: the ETL output."""
    return fact_view(_stored_fact(spark, sf_dir))


def _app_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard loader's frame (descriptions not trimmed)."""
    return dashboard_view(_stored_fact(spark, sf_dir))


def _rfm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(spark, "rfm_scores", sf_dir, lambda: rfm.rfm_scores(_fact(spark, sf_dir)))


def _customer_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_rfm is a projection of the stored scores."""
    return rfm.segments(_rfm_scores(spark, sf_dir))


def _pred_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pred_customer_clv from the published CDNOW parameters."""
    return materialize(spark, "pred_customer_clv", sf_dir,
                       lambda: models.pred_customer_clv_fixed(_fact(spark, sf_dir)))


def _app_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard's customers.  They take one pass over four of the fact's columns: if it is not stored, the ETL's
    output goes into that pass and only these columns are made."""
    return materialize(spark, "app_rfm", sf_dir,
                       lambda: rfm.app_rfm(dashboard_view(_stored_fact(spark, sf_dir, stored_or))))


def _clv_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters fitted on the data, with their certificates."""
    return materialize(spark, "clv_parameters", sf_dir, lambda: models.fitted_parameters(_fact(spark, sf_dir)))


def _clv_fit_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.to_cents(models.predict_fitted(_fact(spark, sf_dir), _clv_parameters(spark, sf_dir)))


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept and rejected rows of the text cells, from one job."""
    return materialize(spark, "etl_split", sf_dir, lambda: split_transactions(conform_raw(testdata.raw_text(spark, sf_dir), keep_cells=True)))


def _cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored cube of sketches per day and country."""
    return materialize(spark, "distinct_cube", sf_dir, lambda: distinct_cube(valid_lines(_fact(spark, sf_dir), require_customer=True)))


# The explorer with a real filter: some segments, and a CLV that part of their customers reach.
EXPLORED, EXPLORED_CLV = ["Champions", "At Risk", "Lost"], 1_000_000.0

QUERIES: dict[str, Query] = {
    "clean_transactions": lambda s, d: finalize(_fact(s, d)),
    "clean_raw_text": lambda s, d: finalize(clean_transactions(conform_raw(testdata.raw_text(s, d)))),
    "clean_export_text": lambda s, d: finalize(clean_transactions(conform_raw(testdata.export_text(s, d)))),
    "etl_rejected_rows": lambda s, d: rejected_rows(_split(s, d)),
    "etl_split_counts": lambda s, d: split_counts(_split(s, d)),
    "etl_quality_counts": lambda s, d: quality_counts(testdata.raw_transactions(s, d)),
    "etl_quality_counts_text": lambda s, d: quality_counts(conform_raw(testdata.raw_text(s, d))),
    "q01_monthly_revenue": lambda s, d: q.q01_monthly_revenue(_fact(s, d)),
    "rfm_scores": lambda s, d: finalize(_rfm_scores(s, d)),
    "customer_rfm": lambda s, d: finalize(_customer_rfm(s, d)),
    "q02_segment_revenue": lambda s, d: q.q02_segment_revenue(_fact(s, d), _customer_rfm(s, d)),
    "q03_top_customers": lambda s, d: q.q03_top_customers(_fact(s, d), _customer_rfm(s, d),
                                                          _pred_fixed(s, d)),
    # reported to the cent here: engines differ in the last bits of the prediction
    "q04_churn_risk": lambda s, d: q.q04_churn_risk(_fact(s, d), _customer_rfm(s, d), _pred_fixed(s, d), as_of="data_max")
    .withColumn("predicted_clv_12m", round_half_up("predicted_clv_12m")),
    "q05_country_revenue": lambda s, d: q.q05_country_revenue(_fact(s, d)),
    "q06_top_products": lambda s, d: q.q06_top_products(_fact(s, d)),
    "q08_cohort_retention": lambda s, d: q.q08_cohort_retention(_fact(s, d)),
    "q07_purchase_gaps": lambda s, d: q.q07_purchase_gaps(_fact(s, d), _customer_rfm(s, d)),
    "q09_revenue_deciles": lambda s, d: q.q09_revenue_deciles(_fact(s, d)),
    "q10_day_hour": lambda s, d: q.q10_day_hour(_fact(s, d)),
    "q11_clv_by_segment": lambda s, d: q.q11_clv_by_segment(_customer_rfm(s, d), _pred_fixed(s, d)),
    "q12_kpi": lambda s, d: q.q12_kpi(_fact(s, d)),
    "pareto_share": lambda s, d: q.pareto_share(_fact(s, d)),
    "country_yoy_growth": lambda s, d: q.country_yoy_growth(_fact(s, d)),
    "segment_action": lambda s, d: q.segment_action(_customer_rfm(s, d)),
    "orders_per_year_by_segment": lambda s, d: q.orders_per_year_by_segment(_fact(s, d), _customer_rfm(s, d)),
    "sketch_monthly": lambda s, d: approximate.monthly(_fact(s, d), _cube(s, d)),
    "sketch_countries": lambda s, d: approximate.countries(_fact(s, d), _cube(s, d)),
    "sketch_kpi": lambda s, d: approximate.kpis(_fact(s, d), _cube(s, d)),
    "sketch_segments": lambda s, d: approximate.segments(_fact(s, d), _customer_rfm(s, d)),
    "sketch_quantiles": lambda s, d: approximate.quantiles(_app_rfm(s, d)),
    "clv_summary": lambda s, d: models.clv_summary_table(_fact(s, d)),
    "clv_predict_fixed": lambda s, d: models.to_cents(_pred_fixed(s, d)),
    "clv_loglik_fixed": lambda s, d: models.loglik_fixed(_fact(s, d)),
    "clv_fit_optimum": lambda s, d: models.fit_optimum(_clv_parameters(s, d)),
    "clv_fit_predict": _clv_fit_predict,
    "app_rfm": lambda s, d: finalize(_app_rfm(s, d)),
    "app_kpis": lambda s, d: app.app_kpis(_app_rfm(s, d)),
    "app_segment_counts": lambda s, d: app.app_segment_counts(_app_rfm(s, d)),
    "app_segment_revenue": lambda s, d: app.app_segment_revenue(_app_rfm(s, d)),
    "app_recency_hist": lambda s, d: app.app_recency_hist(_app_rfm(s, d)),
    "app_frequency_hist": lambda s, d: app.app_frequency_hist(_app_rfm(s, d)),
    "app_clv_by_segment": lambda s, d: app.app_clv_by_segment(_app_rfm(s, d)),
    "app_frequency_vs_clv": lambda s, d: app.app_frequency_vs_clv(_app_rfm(s, d)),
    "app_top20_clv": lambda s, d: app.app_top20_clv(_app_rfm(s, d)),
    "app_reactivation": lambda s, d: app.app_reactivation(_app_rfm(s, d)),
    "app_top20_clv_text": lambda s, d: app.with_money_text(app.app_top20_clv(_app_rfm(s, d))),
    "app_reactivation_text": lambda s, d: app.with_money_text(app.app_reactivation(_app_rfm(s, d))),
    "app_segment_options": lambda s, d: app.app_segment_options(_app_rfm(s, d)),
    "app_explorer": lambda s, d: app.app_explorer(_app_rfm(s, d)),
    "app_explorer_kpis": lambda s, d: app.app_explorer_kpis(_app_rfm(s, d)),
    "app_clv_bound": lambda s, d: app.clv_bound(_app_rfm(s, d)),
    "app_explorer_filtered": lambda s, d: app.app_explorer(_app_rfm(s, d), EXPLORED, EXPLORED_CLV),
    "app_explorer_filtered_kpis": lambda s, d: app.app_explorer_kpis(_app_rfm(s, d), EXPLORED, EXPLORED_CLV),
    "app_monthly_revenue": lambda s, d: app.app_monthly_revenue(_app_fact(s, d)),
    "app_top_countries": lambda s, d: app.app_top_countries(_app_fact(s, d)),
    "app_top_products": lambda s, d: app.app_top_products(_app_fact(s, d)),
}
