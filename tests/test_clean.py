"""Cleaning rules, quality counts, raw-input conforming, adapter golden numbers."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from cartwheel.operators.clean import clean_transactions, clean_with_metrics, quality_counts
from cartwheel.schema import RAW_SCHEMA
from cartwheel.sources import conform_raw
from cartwheel.sources.testdata import raw_transactions

T0 = dt.datetime(2011, 1, 31, 23, 59)


def _raw(spark):
    rows = [
        ("536365", "85123A", " WHITE HANGING HEART ", 6, T0, Decimal("2.55"), 17850, "United Kingdom"),  # kept
        ("536366", "22423", "\tREGENCY CAKESTAND\t ", 2, T0, Decimal("12.75"), 13047, "France"),   # kept, tabs
        ("536367", "22423", "CAKESTAND", 2, T0, Decimal("12.75"), None, "France"),               # no customer
        ("536368", "22423", "CAKESTAND", 2, T0, Decimal("0.00"), 13047, "France"),               # zero price
        ("536369", "22423", "CAKESTAND", 0, T0, Decimal("1.00"), 13047, "France"),               # zero qty
        ("C536379", "22423", "CAKESTAND", -1, T0, Decimal("1.00"), 13047, "France"),             # cancelled + neg qty
        ("536370", "22423", None, 3, T0, Decimal("-1.00"), 13047, "France"),                     # negative price
        ("536371", "22423", "X", -5, T0, Decimal("1.00"), None, "France"),                       # two reasons
    ]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_clean_keeps_valid_rows_and_strips(spark):
    out = clean_transactions(_raw(spark)).orderBy("invoice_no").collect()
    assert [r.invoice_no for r in out] == ["536365", "536366"]
    assert out[0].description == "WHITE HANGING HEART"
    assert out[1].description == "REGENCY CAKESTAND"
    assert out[0].total_line_revenue == Decimal("15.30")
    assert all(r.is_cancelled is False for r in out)


def test_dashboard_loader_keeps_padding(spark):
    out = clean_transactions(_raw(spark), trim_description=False).orderBy("invoice_no").first()
    assert out.description == " WHITE HANGING HEART "


def test_quality_counts_overlap(spark):
    r = quality_counts(_raw(spark)).first().asDict()
    assert r == {"rows_in": 8, "null_customer": 2, "bad_price": 2, "bad_qty": 3, "bad_date": 0, "cancelled": 1, "rows_kept": 2}


def test_observed_metrics_match_one_pass(spark):
    df, obs = clean_with_metrics(_raw(spark))
    assert df.count() == 2
    assert obs.get["rows_kept"] == 2 and obs.get["null_customer"] == 2


def test_conform_pascal_case_text_input(spark):
    rows = [("536365", "85123A", "A", "6", "2010-12-01 08:26:00", "2.55", "17850.0", "United Kingdom")]
    cols = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]
    df = conform_raw(spark.createDataFrame(rows, cols))
    r = df.first()
    assert df.schema == RAW_SCHEMA or [f.dataType for f in df.schema] == [f.dataType for f in RAW_SCHEMA]
    assert r.customer_id == 17850 and r.quantity == 6 and r.unit_price == Decimal("2.55")
    assert r.invoice_date == dt.datetime(2010, 12, 1, 8, 26)


def test_adapter_golden_numbers_sf0001(spark):
    from tests.conftest import SF001
    raw = raw_transactions(spark, SF001)
    q = quality_counts(raw).first()
    assert (q.rows_in, q.null_customer, q.cancelled, q.rows_kept) == (6000, 116, 276, 5456)
    fact = clean_transactions(raw)
    k = fact.agg(F.count_distinct("customer_id").alias("c"), F.count_distinct("invoice_no").alias("i"),
                 F.sum("total_line_revenue").alias("rev")).first()
    assert (k.c, k.i, k.rev) == (150, 1437, Decimal("7298876454.36"))


def test_no_cell_is_lost_or_rounded(spark):
    """Sub-cent prices, whole numbers with a fraction, missing invoices and malformed cells: kept exactly, or counted."""
    good = ("1", "A", "\u00a0x\u3000", "6.0", "2010-12-01 08:26:00", "0.001", "17850.0", "UK")
    rows = [good, (None, *good[1:]), (*good[:5], "0.125", *good[6:]), (*good[:3], "1e1", *good[4:]), (*good[:3], "2.5", *good[4:]),
            (*good[:4], "soon", *good[5:]), (*good[:5], "x", *good[6:]), (*good[:6], "n/a", "UK")]
    cols = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]
    raw = conform_raw(spark.createDataFrame(rows, cols))
    kept = clean_transactions(raw).collect()
    assert sorted((r.invoice_no, r.quantity, r.unit_price, r.total_line_revenue) for r in kept) == sorted([
        ("1", 6, Decimal("0.001"), Decimal("0.006")), ("nan", 6, Decimal("0.001"), Decimal("0.006")),
        ("1", 6, Decimal("0.125"), Decimal("0.75")), ("1", 10, Decimal("0.001"), Decimal("0.01"))])
    assert all(r.description == "x" for r in kept)
    assert quality_counts(raw).first().asDict() == {"rows_in": 8, "null_customer": 1, "bad_price": 1, "bad_qty": 1, "bad_date": 1,
                                                    "cancelled": 0, "rows_kept": 4}
    numbers = spark.createDataFrame([(6.0, 2.55, 17850.0), (2.5, 1.0, 1.0)], "quantity double, unit_price double, customer_id double")
    other = numbers.selectExpr("'1' invoice_no", "'A' stock_code", "'x' description", "quantity", "timestamp_ntz'2010-12-01' invoice_date",
                               "unit_price", "customer_id", "'UK' country")
    assert [(r.quantity, r.unit_price, r.customer_id) for r in conform_raw(other).collect()] == [
        (6, Decimal("2.55"), 17850), (None, Decimal("1"), 1)]


def test_strip_is_pythons(spark):
    from cartwheel.operators.clean import strip_whitespace
    chars = [chr(c) for c in range(0x3100)] + [chr(c) for c in (0xFEFF, 0x180E)]
    df = spark.createDataFrame([(i, f"{c}x{c}") for i, c in enumerate(chars)], "i int, s string")
    got = {r.i: r.t for r in df.select("i", strip_whitespace(F.col("s")).alias("t")).collect()}
    assert [got[i] for i in range(len(chars))] == [f"{c}x{c}".strip() for c in chars]


def test_round_of_large_values(spark):
    from cartwheel.functions.numeric import round_half_up
    values = [1e17, 5e18, 9.3e250, 0.125, -0.125, 4503599627370497.5, 123456789012.345]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(round_half_up("v")).collect()]
    assert got[:6] == [1e17, 5e18, 9.3e250, 0.13, -0.12, 4503599627370497.5] and abs(got[6] - 123456789012.35) < 1e-4


def test_cells_are_read_once(spark):
    """Filters and reasons use the parsed columns; they do not read the cells again (clean_export_text, etl_split_counts)."""
    from cartwheel.operators.clean import clean_transactions, split_counts, split_transactions
    from cartwheel.sources.retail import conform_raw

    cells = spark.createDataFrame(
        [("1", "a", "x", "6.0", "12/1/2010 8:26", "2.5", "7.0", "F"), ("C2", "b", "y", "1e1", "no date", "1", None, "F")],
        "InvoiceNo string, StockCode string, Description string, Quantity string, InvoiceDate string, UnitPrice string, "
        "CustomerID string, Country string")
    raw = conform_raw(cells.repartition(2), "month", keep_cells=True)
    once = raw._jdf.queryExecution().optimizedPlan().toString()
    marks = ("[AaPp]", "[+-]?[0-9]{1,18}")  # of the patterns of dates and whole numbers
    for df in (clean_transactions(raw), split_counts(split_transactions(raw))):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert [plan.count(m) for m in marks] == [once.count(m) for m in marks]
    assert clean_transactions(raw).select("quantity", "customer_id").collect() == [(6, 7)]
    assert split_counts(split_transactions(raw)).first().several_reasons == 1


def test_no_cast_of_what_is_no_number(spark):
    """Cells that are no dates of numbers cost no failing cast in the evidence."""
    from cartwheel.sources.dates import evidence

    df = spark.createDataFrame([("2010-12-01 08:26:00",), ("13/1/2010",), (None,), ("x",), ("1/2/2010",)], "d string")
    e = evidence(df, "d")
    assert (e.cells, e.year_last, e.first_over_12, e.second_over_12, e.open) == (4, 2, 1, 0, 1)
