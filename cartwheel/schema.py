"""Table schemas and canonical column names."""

from __future__ import annotations

from pyspark.sql import types as T

# Prices keep eight decimals; with a 64-bit quantity the line revenue is exact in DECIMAL(38,8).
PRICE = T.DecimalType(17, 8)
MONEY = T.DecimalType(38, 8)

# Fixed value: the text that the original ETL's string conversion gives a missing invoice number.
NO_INVOICE = "nan"

RAW_SCHEMA = T.StructType([
    T.StructField("invoice_no", T.StringType(), True),
    T.StructField("stock_code", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("quantity", T.LongType(), True),
    T.StructField("invoice_date", T.TimestampNTZType(), True),
    T.StructField("unit_price", PRICE, True),
    T.StructField("customer_id", T.LongType(), True),
    T.StructField("country", T.StringType(), True),
])

FACT_COLUMNS = [f.name for f in RAW_SCHEMA.fields] + ["total_line_revenue", "is_cancelled"]

# The spreadsheet header names used by the original ETL and
# dashboard, mapped to the canonical snake_case names.
PASCAL_TO_SNAKE = {
    "InvoiceNo": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "UnitPrice": "unit_price",
    "CustomerID": "customer_id",
    "Country": "country",
    "TotalLineRevenue": "total_line_revenue",
    "IsCancelled": "is_cancelled",
}

# The seven customer segments, in rule order.
SEGMENTS = [
    "Champions",
    "Loyal Customers",
    "Potential Loyalists",
    "New Customers",
    "At Risk",
    "Hibernating",
    "Lost",
]
