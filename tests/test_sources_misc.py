"""Sinks, stored-table reads, views, USE, money text and the CURDATE default."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cartwheel.functions.numeric import money_text, round_half_up
from cartwheel.operators.clean import clean_transactions
from cartwheel.plans.questions import q04_churn_risk
from cartwheel.schema import RAW_SCHEMA
from cartwheel.sources import read_raw_transactions, read_table, register_view, use_database, write_table

T0 = dt.datetime(2011, 3, 1, 10, 0)


def _raw(spark):
    rows = [("1", "A", "x", 2, T0, Decimal("1.50"), 7, "UK"),
            ("2", "A", "x", 1, T0 + dt.timedelta(days=40), Decimal("2.00"), 7, "UK"),
            ("3", "B", "y", 4, T0 + dt.timedelta(days=80), Decimal("0.50"), 7, "UK"),
            ("4", "B", "y", 1, T0, Decimal("9.99"), 8, "FR")]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_replace_write_read_view_and_use(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="cartwheel-sink-"), "fact")
    fact = clean_transactions(_raw(spark))
    write_table(fact, out)
    write_table(fact.limit(1), out)  # replace, not append
    assert read_table(spark, out).count() == 1
    write_table(fact, out)
    back = read_table(spark, out)
    assert back.count() == 4 and back.dtypes == fact.dtypes
    use_database(spark, "default")
    register_view(back, "fact_transactions_test")
    assert spark.sql("SELECT COUNT(DISTINCT customer_id) AS c FROM fact_transactions_test").first().c == 2


def test_raw_reader_csv_and_missing_path(spark):
    d = tempfile.mkdtemp(prefix="cartwheel-csv-")
    p = os.path.join(d, "raw.csv")
    with open(p, "w") as fh:
        fh.write("InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n")
        fh.write("536365,85123A, WHITE HEART ,6,2010-12-01 08:26:00,2.55,17850.0,United Kingdom\n")
        fh.write("C536379,D,Discount,-1,2010-12-01 09:41:00,27.50,14527.0,United Kingdom\n")
        fh.write("536366,22633,HAND WARMER,6,2010-12-01 08:28:00,1.85,,United Kingdom\n")
    raw = read_raw_transactions(spark, p, fmt="csv")
    assert [f.dataType for f in raw.schema] == [f.dataType for f in RAW_SCHEMA]
    kept = clean_transactions(raw).collect()
    assert len(kept) == 1 and kept[0].customer_id == 17850 and kept[0].description == "WHITE HEART"
    with pytest.raises(AnalysisException):
        read_raw_transactions(spark, os.path.join(d, "missing.parquet"))


def test_money_text_and_rounding(spark):
    df = spark.createDataFrame([(1234567.891,), (0.125,), (1.005,), (-0.125,)], "v double")
    r = df.select(money_text(F.col("v")).alias("t"), round_half_up(F.col("v")).alias("r")).collect()
    assert r[0].t == "$1,234,567.89"
    # exact binary ties go up (toward +inf); 1.005 is 1.00499999... as a double, so it goes down
    assert [x.r for x in r[1:]] == [0.13, 1.0, -0.12]


def test_churn_defaults_to_today(spark):
    fact = clean_transactions(_raw(spark))
    rfm = spark.createDataFrame([(7, "Lost"), (8, "Lost")], "customer_id long, rfm_segment string")
    pred = spark.createDataFrame([(7, 10.0), (8, 1.0)], "customer_id long, predicted_clv_12m double")
    today = q04_churn_risk(fact, rfm, pred).collect()  # as_of = current_date()
    assert [r.customer_id for r in today] == [7] and today[0].days_since_last_purchase > 90
    fixed = q04_churn_risk(fact, rfm, pred, as_of="2011-06-01").collect()
    assert fixed == []  # last purchase 2011-05-20 is only 12 days before
