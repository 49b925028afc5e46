"""Columns computed once for each row, however often later steps use them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def read_once(df: DataFrame, columns: list[Column]) -> DataFrame:
    """``df.select(*columns)``, each row's columns computed once: filters on them stay above, where Spark would else put
    a copy of every expression in place of each use, and copies of what those are made of in turn."""
    return df.select(F.inline(F.array(F.struct(*columns))))
