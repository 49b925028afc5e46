"""Dates in text: the order of day and month is found from the whole column."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cartwheel.sources import conform_raw
from cartwheel.sources.dates import AmbiguousDates, evidence, find_order, timestamp_of


def _column(spark, cells):
    return spark.createDataFrame([(c,) for c in cells], "d string")


def _read(spark, cells, order=None):
    df = _column(spark, cells).coalesce(1)
    return [r[0] for r in df.select(timestamp_of(F.col("d"), find_order(df, "d", order))).collect()]


def test_the_public_datasets_form(spark):
    cells = [f"{t.month}/{t.day}/{t.year} {t.hour}:{t.minute:02d}" for t in pd.date_range("2010-12-01 08:26", periods=400, freq="17h")]
    assert _read(spark, cells) == [t.to_pydatetime() for t in pd.to_datetime(pd.Series(cells), format="%m/%d/%Y %H:%M")]


@pytest.mark.parametrize("cells,order", [
    (["12/1/2010", "12/13/2010"], "month"), (["1/12/2010", "13/12/2010"], "day"), (["2010-12-01", "x", None, ""], "each"),
    (["1/1/2010", "2/2/2010"], "each"), (["1/13/2010", "13/1/2010"], "each"), (["40/1/2010", "13/13/2010", "1/13/2010"], "month")])
def test_order_from_the_whole_column(spark, cells, order):
    assert find_order(_column(spark, cells), "d") == order


def test_undecidable_columns_raise_unless_the_order_is_named(spark):
    for cells in (["1/2/2010"], ["1/2/2010", "1/13/2010", "13/1/2010"]):
        with pytest.raises(AmbiguousDates, match="date_order"):
            find_order(_column(spark, cells), "d")
    assert _read(spark, ["1/2/2010"], "day") == [dt.datetime(2010, 2, 1)]
    assert _read(spark, ["1/2/2010"], "month") == [dt.datetime(2010, 1, 2)]
    with pytest.raises(ValueError):
        find_order(_column(spark, ["1/2/2010"]), "d", "year")


def test_a_mixed_column(spark):
    day = dt.datetime(2010, 12, 13, 8, 26)
    cells = ["12/13/2010 8:26", "2010-12-13 08:26:00", "2010-12-13T08:26", "13-Dec-2010 08:26", "Dec 13, 2010 8:26 AM", " 12.13.10 8:26 ",
             "2010/12/13 08:26:00", "12/13/2010 08:26:00 am", "13 December 2010 8:26"]
    assert _read(spark, cells) == [day] * len(cells)
    assert _read(spark, ["12/31/2010 12:00 AM", "12/31/2010 12:00 PM", "12/31/2010 11:59:59.5 PM"]) == [
        dt.datetime(2010, 12, 31), dt.datetime(2010, 12, 31, 12), dt.datetime(2010, 12, 31, 23, 59, 59, 500000)]
    assert _read(spark, ["12/31/68", "12/31/69"]) == [dt.datetime(2068, 12, 31), dt.datetime(1969, 12, 31)]


def test_no_dates_are_null(spark):
    cells = ["no date", "", None, "2/30/2010", "13/32/2010", "2010-13-01", "8:26", "2010", "12", "12/31/2010 25:00", "12/31/2010 0:30 PM",
             "1-Foo-2010", "12/31/201", "12/31/2010 8:26 then"]
    assert _read(spark, cells, "month") == [None] * len(cells)


def test_a_whole_row_is_conformed(spark):
    rows = [("1", "A", "x", "6", d, "2.5", "7", "UK") for d in ("12/1/2010 8:26", "1/31/2011 23:59", "2011-01-01 00:00:00")]
    df = spark.createDataFrame(rows, ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"])
    assert [r.invoice_date for r in conform_raw(df).collect()] == [
        dt.datetime(2010, 12, 1, 8, 26), dt.datetime(2011, 1, 31, 23, 59), dt.datetime(2011, 1, 1)]
    with pytest.raises(AmbiguousDates):
        conform_raw(df.limit(1))
    assert conform_raw(df.limit(1), date_order="day").first().invoice_date == dt.datetime(2010, 1, 12, 8, 26)


def test_evidence_is_one_aggregate(spark):
    e = evidence(_column(spark, ["1/13/2010", "1/2/2010", "3/3/2010", "2010-01-01", None]), "d")
    assert (e.cells, e.year_last, e.first_over_12, e.second_over_12, e.open) == (4, 3, 0, 1, 1)
