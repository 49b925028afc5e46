"""The command line on user data: raw file -> fact -> rfm / predictions -> questions / dashboard."""

import os
import tempfile

from pyspark.sql import functions as F

from cartwheel.cli import main
from cartwheel.sources.testdata import raw_transactions
from tests.conftest import SF001


def test_cli_end_to_end(spark, capsys):
    work = tempfile.mkdtemp(prefix="cartwheel-cli-")
    raw_path = os.path.join(work, "raw.parquet")
    # a user's spreadsheet export, PascalCase headers
    names = {"invoice_no": "InvoiceNo", "stock_code": "StockCode", "description": "Description",
             "quantity": "Quantity", "invoice_date": "InvoiceDate", "unit_price": "UnitPrice",
             "customer_id": "CustomerID", "country": "Country"}
    raw = raw_transactions(spark, SF001)
    raw.select(*[F.col(k).alias(v) for k, v in names.items()]).write.parquet(raw_path)
    fact, rfm, pred = (os.path.join(work, n) for n in ("fact", "rfm", "pred"))
    main(["etl", "--input", raw_path, "--output", fact])
    assert '"rows_kept": 5456' in capsys.readouterr().out
    both, rejected = os.path.join(work, "fact2"), os.path.join(work, "rejected")
    main(["etl", "--input", raw_path, "--output", both, "--rejected", rejected])
    assert '"rows_kept": 5456' in capsys.readouterr().out
    assert spark.read.parquet(both).count() == 5456 and spark.read.parquet(rejected).count() == 6000 - 5456
    main(["rfm", "--fact", fact, "--output", rfm])
    main(["predict", "--fact", fact, "--output", pred, "--fixed"])
    out = os.path.join(work, "q03")
    main(["question", "q03_top_customers", "--fact", fact, "--rfm", rfm, "--pred", pred, "--output", out])
    q3 = spark.read.parquet(out)
    assert q3.count() == 10 and q3.agg(F.min("revenue_rank")).first()[0] == 1
    for name, extra in (("q11_clv_by_segment", ["--rfm", rfm, "--pred", pred]),
                        ("q04_churn_risk", ["--rfm", rfm, "--pred", pred, "--as-of", "2001-12-31"]),
                        ("q07_purchase_gaps", ["--rfm", rfm])):
        dest = os.path.join(work, name)
        main(["question", name, "--fact", fact, *extra, "--output", dest])
        assert spark.read.parquet(dest).count() > 0, name
    main(["question", "q01_monthly_revenue", "--fact", fact, "--show", "3"])
    assert "mom_revenue_growth_pct" in capsys.readouterr().out
    dash = os.path.join(work, "dash")
    main(["dashboard", "--fact", fact, "--output", dash])
    assert spark.read.parquet(os.path.join(dash, "app_kpis")).first().total_customers == 150
    assert spark.read.parquet(os.path.join(dash, "app_recency_hist")).count() == 40
