"""Streaming ingest, the driver contract, and plan guards."""

import os
import re
import subprocess
import sys
import tempfile

from pyspark.sql import functions as F

from cartwheel.operators.clean import clean_transactions, quality_counts
from cartwheel.sources.testdata import raw_transactions
from cartwheel.streaming.ingest import start_fact_ingest, start_quality_monitor
from tests.conftest import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_stream_ingest_matches_batch_cleaning(spark):
    work = tempfile.mkdtemp(prefix="cartwheel-stream-")
    src, fact, ckpt = (os.path.join(work, d) for d in ("raw", "fact", "ckpt"))
    raw = raw_transactions(spark, SF001)
    # two landed files, then a third after the first run: progress must resume, not repeat
    raw.filter(F.col("invoice_date") < "1998-01-01").write.parquet(os.path.join(src, "a"))
    q = start_fact_ingest(spark, src + "/*", fact, checkpoint_location=ckpt)
    q.awaitTermination()
    raw.filter(F.col("invoice_date") >= "1998-01-01").write.parquet(os.path.join(src, "b"))
    q = start_fact_ingest(spark, src + "/*", fact, checkpoint_location=ckpt)
    q.awaitTermination()
    got = spark.read.parquet(fact)
    want = clean_transactions(raw)
    assert got.count() == want.count() == 5456
    assert got.exceptAll(want).count() == 0

    m = start_quality_monitor(spark, src + "/*", name="q_monitor_test")
    m.awaitTermination()
    assert spark.table("q_monitor_test").first().asDict() == quality_counts(raw).first().asDict()


def test_two_applications_share_one_stream():
    """The default progress folder is found again by another application: every row lands once."""
    work = tempfile.mkdtemp(prefix="cartwheel-stream2-")
    os.mkdir(os.path.join(work, "raw"))
    code = f"""
from cartwheel.session import build_session
from cartwheel.streaming.ingest import start_fact_ingest
s = build_session("local[1]", extra={{"spark.checkpoint.dir": "file://{work}/ckpt"}})
start_fact_ingest(s, "file://{work}/raw", "file://{work}/fact", fmt="csv").awaitTermination()
print("ROWS", s.read.parquet("file://{work}/fact").count())
"""
    head = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
    rows = []
    for k, n in enumerate((3, 5)):
        with open(os.path.join(work, "raw", f"{k}.csv"), "w") as fh:
            fh.write(head + "".join(f"{k}{i},a,b,6.0,2011-01-0{i + 1} 10:00:00,0.125,17850.0,UK\n" for i in range(n)))
        out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=180).stdout
        rows.append(out.split("ROWS")[1].strip())
    assert rows == ["3", "8"]


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["month", "total_orders", "unique_customers", "total_revenue",
                          "avg_order_value", "mom_revenue_growth_pct"]
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    own = {n for n in qs if not re.match(r"op\d+_|pipeline$", n)}  # the corpus queries have tests of their own
    assert own - set(sql) == {"clv_fit_predict"}


def test_plans_have_no_row_python_and_push_filters(spark):
    import __spark_entry__ as E
    qs = E.queries()
    for name in ("q01_monthly_revenue", "q06_top_products", "q09_revenue_deciles", "clv_predict_fixed"):
        df = qs[name](spark, SF001)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan, name
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = qs["q01_monthly_revenue"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    for f in ("IsNotNull(customer_id)", "GreaterThan(quantity,0)", "GreaterThan(unit_price,0.0"):
        assert f in pushed, pushed
    schema = plan.split("ReadSchema: struct<", 1)[1].split(">", 1)[0]
    assert sorted(re.findall(r"(\w+):", schema)) == sorted(
        ["invoice_no", "quantity", "invoice_date", "unit_price", "customer_id", "total_line_revenue"])


def test_plan_guards_over_every_query(spark):
    """No row-at-a-time Python anywhere, Arrow only in the CLV model, no Expand right on a scan, and
    nothing sorted or gathered in one partition but results and bounded grains."""
    import __spark_entry__ as E
    for name, query in E.queries().items():
        if re.match(r"op\d+_|pipeline$", name) or name == "clv_fit_predict":
            continue
        df = query(spark, SF001)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("BatchEvalPython|FlatMapGroups", plan), name
        assert ("MapInArrow" in plan) == (name == "clv_loglik_fixed"), name  # the likelihood's sums per task
        assert "ArrowEvalPython" not in plan, name  # predictions are read from their stored table
        assert not re.search(r"Expand[^\n]*\n[ :+\-]*(\*\(\d+\) )?(Project[^\n]*\n[ :+\-]*(\*\(\d+\) )?)?(Filter[^\n]*\n[ :+\-]*(\*\(\d+\) )?)?(ColumnarToRow[^\n]*\n[ :+\-]*)?FileScan", plan), name
        sorts = re.findall(r"Window [^\n]*\n(?:[^\n]*Sort[^\n]*\n)?[^\n]*Exchange SinglePartition[^\n]*\n[^\n]*", plan)
        assert not any(re.search(r"keys=\[[^\]]*customer_id", s.split("\n")[-1]) for s in sorts), name


def test_oracle_parity_sf0001(spark, duck):
    import __spark_entry__ as E
    from tools.parity import canon
    qs, sql = E.queries(), E.oracle_sql()
    for name in ("q01_monthly_revenue", "q07_purchase_gaps", "q09_revenue_deciles", "app_rfm",
                 "clv_predict_fixed", "q03_top_customers"):
        s = qs[name](spark, SF001).toPandas()
        d = duck.sql(sql[name]).df()
        assert canon(s) == canon(d), name
