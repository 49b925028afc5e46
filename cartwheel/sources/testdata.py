"""Adapter: the driver's TPC-H-style tables -> ``raw_transactions`` rows.

This only produces rows in the raw invoice-line schema (with some rows made
dirty so that every cleaning rule has work to do); it computes nothing the
analytics need.  The rules (fixed by the fixture spec):

  invoice_no    l_orderkey as text, 'C' prefix when l_returnflag='R' and l_linenumber=1
  quantity      l_quantity as bigint, negated for those same rows
  stock_code    l_partkey as text;  description ' ' + p_name + ' '
  invoice_date  o_orderdate + (8 + o_orderkey % 12) hours + (o_orderkey*7 % 60) minutes
  unit_price    0 when l_partkey % 40 = 0, else l_extendedprice as decimal(12,2)
  customer_id   NULL when l_orderkey % 50 = 0, else o_custkey
  country       n_name
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.sources.once import read_once


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines as a spreadsheet export might hold them: PascalCase headers, every cell text, with
    sub-cent prices, whole numbers written '6.0', padded descriptions, missing invoice numbers and
    malformed dates."""
    r = _with_order(spark, sf_dir)
    order = F.col("order")
    return r.select(
        F.when(order % 97 != 0, F.col("invoice_no")).alias("InvoiceNo"),
        F.col("stock_code").alias("StockCode"),
        F.concat(F.lit("\u00a0\t"), F.col("description"), F.lit("\u3000")).alias("Description"),
        F.concat(F.col("quantity").cast("string"), F.when(order % 2 == 0, F.lit(".0")).otherwise("")).alias("Quantity"),
        F.when(order % 83 == 0, F.lit("no date")).otherwise(F.col("invoice_date").cast("string")).alias("InvoiceDate"),
        F.concat(F.col("unit_price").cast("string"), F.when(order % 5 == 0, F.lit("125")).otherwise("")).alias("UnitPrice"),
        F.concat(F.col("customer_id").cast("string"), F.lit(".0")).alias("CustomerID"),
        F.col("country").alias("Country"))


def export_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines as the public dataset's CSV form has them: dates like ``12/1/2010 8:26``, mixed here with ISO cells and with
    a 12-hour clock; else as ``raw_text``."""
    at = _with_order(spark, sf_dir)
    order, date = F.col("order"), F.col("invoice_date")
    return at.select(
        F.col("invoice_no").alias("InvoiceNo"), F.col("stock_code").alias("StockCode"), F.col("description").alias("Description"),
        F.concat(F.col("quantity").cast("string"), F.when(order % 2 == 0, F.lit(".0")).otherwise("")).alias("Quantity"),
        F.when(order % 83 == 0, F.lit("13/32/2010")).when(order % 3 == 0, date.cast("string"))
        .when(order % 3 == 1, F.date_format(date, "M/d/yyyy H:mm")).otherwise(F.date_format(date, "M/d/yyyy h:mm:ss a")).alias("InvoiceDate"),
        F.col("unit_price").cast("string").alias("UnitPrice"), F.concat(F.col("customer_id").cast("string"), F.lit(".0")).alias("CustomerID"),
        F.col("country").alias("Country"))


def _with_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines and the number of their order, made once a row for all text cells."""
    r = raw_transactions(spark, sf_dir)
    return read_once(r, [*[F.col(c) for c in r.columns], F.regexp_replace("invoice_no", "C", "").cast("bigint").alias("order")])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")

    # Enrich orders (order grain) before touching line grain: one line-grain
    # shuffle for the order join, one for the part join.
    order_country = (orders
                     .join(cust, orders.o_custkey == cust.c_custkey)
                     .join(nation, F.col("c_nationkey") == nation.n_nationkey)
                     .select("o_orderkey", "o_custkey", "o_orderdate", "n_name"))
    lines = (li.join(order_country, li.l_orderkey == order_country.o_orderkey)
               .join(part, li.l_partkey == part.p_partkey))

    returned_first = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    qty = F.col("l_quantity").cast("bigint")
    hours = (F.lit(8) + F.col("o_orderkey") % 12).cast("int")
    minutes = ((F.col("o_orderkey") * 7) % 60).cast("int")
    return lines.select(
        F.concat(F.when(returned_first, F.lit("C")).otherwise(F.lit("")),
                 F.col("l_orderkey").cast("string")).alias("invoice_no"),
        F.col("l_partkey").cast("string").alias("stock_code"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")).alias("description"),
        F.when(returned_first, -qty).otherwise(qty).alias("quantity"),
        F.timestamp_add("MINUTE", minutes,
                        F.timestamp_add("HOUR", hours, F.col("o_orderdate"))).alias("invoice_date"),
        F.when(F.col("l_partkey") % 40 == 0, F.lit(0).cast("decimal(12,2)"))
         .otherwise(F.col("l_extendedprice").cast("decimal(12,2)")).alias("unit_price"),
        F.when(F.col("l_orderkey") % 50 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.col("o_custkey")).alias("customer_id"),
        F.col("n_name").alias("country"),
    )


# DuckDB text of the same adapter, used by the SQL oracle.
RAW_TRANSACTIONS_SQL = """
raw_transactions AS (
    SELECT
        CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber = 1 THEN 'C' ELSE '' END
            || CAST(l.l_orderkey AS VARCHAR)                                   AS invoice_no,
        CAST(l.l_partkey AS VARCHAR)                                           AS stock_code,
        ' ' || p.p_name || ' '                                                 AS description,
        CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber = 1
             THEN -CAST(l.l_quantity AS BIGINT) ELSE CAST(l.l_quantity AS BIGINT) END AS quantity,
        o.o_orderdate + to_hours(CAST(8 + o.o_orderkey % 12 AS INTEGER))
                      + to_minutes(CAST((o.o_orderkey * 7) % 60 AS INTEGER))    AS invoice_date,
        CASE WHEN l.l_partkey % 40 = 0 THEN CAST(0 AS DECIMAL(12,2))
             ELSE CAST(l.l_extendedprice AS DECIMAL(12,2)) END                  AS unit_price,
        CASE WHEN l.l_orderkey % 50 = 0 THEN NULL ELSE o.o_custkey END          AS customer_id,
        n.n_name                                                               AS country
    FROM lineitem l
    JOIN orders o   ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n   ON c.c_nationkey = n.n_nationkey
    JOIN part p     ON l.l_partkey = p.p_partkey
)"""
