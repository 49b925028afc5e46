"""Command line for running the workload on your own invoice data.

    python -m cartwheel.cli etl --input raw/ --format csv --output warehouse/fact_transactions
    python -m cartwheel.cli rfm --fact warehouse/fact_transactions --output warehouse/customer_rfm
    python -m cartwheel.cli predict --fact warehouse/fact_transactions --output warehouse/pred_customer_clv
    python -m cartwheel.cli question q03_top_customers --fact ... --rfm ... --pred ... [--output DIR] [--show 20]
    python -m cartwheel.cli dashboard --fact warehouse/fact_transactions --output warehouse/dashboard

``--master`` defaults to whatever spark-submit provides; set ``spark.checkpoint.dir``
to a shared folder on a cluster.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from cartwheel.operators import rfm as rfm_ops
from cartwheel.operators.clean import clean_with_metrics, write_split
from cartwheel.plans import dashboard, models, questions
from cartwheel.session import build_session
from cartwheel.sources import read_raw_transactions, read_table, write_table

FACT_ONLY = {"q01_monthly_revenue", "q05_country_revenue", "q06_top_products", "q08_cohort_retention",
             "q09_revenue_deciles", "q10_day_hour", "q12_kpi", "pareto_share", "country_yoy_growth"}
WITH_RFM = {"q02_segment_revenue", "q07_purchase_gaps", "orders_per_year_by_segment"}
RFM_ONLY = {"segment_action"}
WITH_RFM_PRED = {"q03_top_customers", "q04_churn_risk"}
WITH_PRED = WITH_RFM_PRED | {"q11_clv_by_segment"}


def _question(name: str, spark: SparkSession, a) -> DataFrame:
    if name not in FACT_ONLY | WITH_RFM | RFM_ONLY | WITH_PRED:
        raise SystemExit(f"unknown question {name}")
    if name in WITH_PRED and not a.pred:
        raise SystemExit(f"{name} needs --pred, a table written by the predict command")
    fact = read_table(spark, a.fact)
    fn = getattr(questions, name)
    if name in FACT_ONLY:
        return fn(fact)
    rfm = read_table(spark, a.rfm) if a.rfm else rfm_ops.customer_rfm(fact)
    if name in WITH_RFM:
        return fn(fact, rfm)
    if name in RFM_ONLY:
        return fn(rfm)
    pred = read_table(spark, a.pred)
    if name in WITH_RFM_PRED:
        return fn(fact, rfm, pred, as_of=a.as_of) if name == "q04_churn_risk" else fn(fact, rfm, pred)
    return fn(rfm, pred)


def _emit(df: DataFrame, a) -> None:
    if a.output:
        write_table(df, a.output)
    if a.show or not a.output:
        df.show(a.show or 20, truncate=False)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="cartwheel")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)

    e = sub.add_parser("etl", help="raw invoice lines -> fact_transactions")
    e.add_argument("--input", required=True)
    e.add_argument("--format", default="parquet", choices=["parquet", "csv", "orc", "json"])
    e.add_argument("--output", required=True)
    e.add_argument("--rejected", help="also write the rejected rows, with reasons and original cells, by the same job")
    e.add_argument("--date-order", choices=["month", "day", "each"], help="which of two numbers in a text date comes first (default: found from the column)")
    e.add_argument("--keep-padding", action="store_true", help="do not strip descriptions")

    r = sub.add_parser("rfm", help="fact -> customer_rfm")
    r.add_argument("--fact", required=True)
    r.add_argument("--output", required=True)

    p = sub.add_parser("predict", help="fact -> pred_customer_clv (fit, or --fixed CDNOW parameters)")
    p.add_argument("--fact", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--fixed", action="store_true")
    p.add_argument("--penalizer", type=float, default=0.01)

    q = sub.add_parser("question", help="one business question")
    q.add_argument("name")
    q.add_argument("--fact", required=True)
    q.add_argument("--rfm")
    q.add_argument("--pred")
    q.add_argument("--as-of", dest="as_of", default=None)
    q.add_argument("--output")
    q.add_argument("--show", type=int, default=0)

    d = sub.add_parser("dashboard", help="all dashboard datasets")
    d.add_argument("--fact", required=True, help="a fact table written with --keep-padding matches the dashboard")
    d.add_argument("--output", required=True)

    a = ap.parse_args(argv)
    spark = build_session(master=a.master, app=f"cartwheel-{a.cmd}")

    if a.cmd == "etl":
        raw = read_raw_transactions(spark, a.input, fmt=a.format, date_order=a.date_order, keep_cells=bool(a.rejected))
        if a.rejected:
            obs = write_split(raw, a.output, a.rejected, trim_description=not a.keep_padding)
        else:
            fact, obs = clean_with_metrics(raw, trim_description=not a.keep_padding)
            write_table(fact, a.output)
        print(json.dumps(obs.get))
    elif a.cmd == "rfm":
        write_table(rfm_ops.customer_rfm(read_table(spark, a.fact)), a.output)
    elif a.cmd == "predict":
        fact = read_table(spark, a.fact)
        if a.fixed:
            pred = models.pred_customer_clv_fixed(fact)
        else:
            pred, bg, gg = models.fit_and_predict(fact, a.penalizer)
            print(json.dumps({"bgnbd": bg, "gamma_gamma": gg}))
        write_table(pred, a.output)
    elif a.cmd == "question":
        _emit(_question(a.name, spark, a), a)
    elif a.cmd == "dashboard":
        app_fact = read_table(spark, a.fact)
        table = rfm_ops.app_rfm(app_fact)
        write_table(table, f"{a.output}/app_rfm")
        table = read_table(spark, f"{a.output}/app_rfm")
        for name in ("app_kpis", "app_segment_counts", "app_segment_revenue", "app_recency_hist",
                     "app_frequency_hist", "app_clv_by_segment", "app_frequency_vs_clv", "app_top20_clv",
                     "app_reactivation", "app_segment_options", "app_explorer", "app_explorer_kpis"):
            write_table(getattr(dashboard, name)(table), f"{a.output}/{name}")
        for name in ("app_monthly_revenue", "app_top_countries", "app_top_products"):
            write_table(getattr(dashboard, name)(app_fact), f"{a.output}/{name}")


if __name__ == "__main__":
    main(sys.argv[1:])
