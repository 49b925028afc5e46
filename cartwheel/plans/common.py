"""Shared plan helpers: output typing and the standard fact-table inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.operators.clean import clean_transactions
from cartwheel.sources import testdata


def finalize(df: DataFrame) -> DataFrame:
    """Output typing: DECIMAL money -> DOUBLE, 32/16-bit ints -> BIGINT.

    Money is exact (DECIMAL) through every sum and converted once here.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def valid_lines(fact: DataFrame, require_customer: bool = False) -> DataFrame:
    """The questions' own WHERE quantity > 0 AND unit_price > 0 [AND customer_id IS NOT NULL].

    Redundant on a cleaned fact table (Catalyst folds it into the scan
    filters), kept so each question is also right on an uncleaned table.
    """
    cond = (F.col("quantity") > 0) & (F.col("unit_price") > 0)
    if require_customer:
        cond = cond & F.col("customer_id").isNotNull()
    return fact.filter(cond)


def fact_from_testdata(spark: SparkSession, sf_dir: str, trim_description: bool = True,
                       keep_raw_description: bool = False) -> DataFrame:
    return clean_transactions(testdata.raw_transactions(spark, sf_dir), trim_description, keep_raw_description)


def dashboard_view(fact: DataFrame) -> DataFrame:
    """The dashboard loader's frame from a fact table stored with ``description_raw``."""
    return fact.withColumn("description", F.col("description_raw")).drop("description_raw")


def fact_view(fact: DataFrame) -> DataFrame:
    """The ETL's fact columns only."""
    return fact.drop("description_raw")
