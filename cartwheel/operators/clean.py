"""Cleaning raw invoice lines into the fact table."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cartwheel.schema import MONEY, NO_INVOICE
from cartwheel.sources.replace import exists, move, remove, switch


def strip_whitespace(c: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace and U+001C..U+001F."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def _reasons() -> dict[str, Column]:
    """Why a row is rejected.  The cleaner keeps exactly the rows that have none of these."""
    return {
        "null_customer": F.col("customer_id").isNull(),
        "bad_price": ~F.coalesce(F.col("unit_price") > 0, F.lit(False)),
        "bad_qty": ~F.coalesce(F.col("quantity") > 0, F.lit(False)),
        "bad_date": F.col("invoice_date").isNull(),
        "cancelled": F.coalesce(F.col("invoice_no").startswith("C"), F.lit(False)),
    }


def _kept() -> Column:
    r = _reasons()
    return ~(r["null_customer"] | r["bad_price"] | r["bad_qty"] | r["bad_date"] | r["cancelled"])


def clean_transactions(raw: DataFrame, trim_description: bool = True,
                       keep_raw_description: bool = False) -> DataFrame:
    """Valid purchases with derived revenue.

    Keeps rows with a customer, a date, ``unit_price > 0``, ``quantity > 0``
    and an invoice number not starting with 'C'; a missing invoice number is
    kept under the name ``NO_INVOICE``.  The predicates are on base columns
    so they reach the file scan (PushedFilters).  ``trim_description=False``
    reproduces the dashboard's loader, which does not strip descriptions;
    ``keep_raw_description=True`` adds the unstripped text as
    ``description_raw`` so one stored table serves both (scans that do not
    reference it prune it).
    """
    kept = raw.filter(
        F.col("customer_id").isNotNull()
        & (F.col("unit_price") > 0)
        & (F.col("quantity") > 0)
        & F.col("invoice_date").isNotNull()
        & (F.col("invoice_no").isNull() | ~F.col("invoice_no").startswith("C")))
    return kept.select(*_fact_columns(trim_description),
                       *([F.col("description").alias("description_raw")] if keep_raw_description else []))


def _fact_columns(trim_description: bool) -> list[Column]:
    desc = strip_whitespace(F.col("description")) if trim_description else F.col("description")
    return [
        F.coalesce(F.col("invoice_no").cast("string"), F.lit(NO_INVOICE)).alias("invoice_no"),
        F.col("stock_code"),
        desc.alias("description"),
        F.col("quantity").cast("bigint").alias("quantity"),
        F.col("invoice_date").cast("timestamp_ntz").alias("invoice_date"),
        F.col("unit_price"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        F.col("country"),
        (F.col("quantity") * F.col("unit_price")).cast(MONEY).alias("total_line_revenue"),
        F.coalesce(F.col("invoice_no").startswith("C"), F.lit(False)).alias("is_cancelled"),
    ]


def split_transactions(raw: DataFrame, trim_description: bool = True) -> DataFrame:
    """Every input row once: the fact columns, ``rejected`` and, for rejected rows, ``reject_reasons`` (all that hold, as a
    list) and ``cells`` (the row as it came, as JSON, if ``raw`` has it: ``conform_raw(keep_cells=True)``).

    Kept rows are those of ``clean_transactions``.  A rejected row's fact columns are what could be read of it.
    """
    reasons = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in _reasons().items()]))
    rejected = ~_kept()
    revenue = "total_line_revenue"  # of a rejected row it may not fit
    columns = [c if name != revenue else F.when(_kept(), c).alias(revenue)
               for name, c in zip(_FACT_NAMES, _fact_columns(trim_description))]
    cells = F.to_json("cells", {"ignoreNullFields": "false"}) if "cells" in raw.columns else F.lit(None).cast("string")
    return raw.select(*columns, rejected.alias("rejected"), F.when(rejected, reasons).alias("reject_reasons"),
                      F.when(rejected, cells).alias("cells"))


def rejected_rows(split: DataFrame) -> DataFrame:
    """The rejected rows of a split: what could be read, why they were rejected, and the cells that could not be read."""
    cell = lambda name: F.get_json_object("cells", f"$.{name}")
    return split.where("rejected").select(
        "invoice_no", "stock_code", "quantity", "customer_id", F.array_join("reject_reasons", ",").alias("reject_reasons"),
        cell("Quantity").alias("quantity_cell"), cell("InvoiceDate").alias("date_cell"), cell("UnitPrice").alias("price_cell"))


def split_counts(split: DataFrame) -> DataFrame:
    """Rows kept and rejected, and of the rejected those with more than one reason."""
    return split.agg(F.count(F.lit(1)).alias("rows_in"), F.count_if(~F.col("rejected")).alias("rows_kept"),
                     F.count_if("rejected").alias("rows_rejected"),
                     F.count_if(F.size("reject_reasons") > 1).alias("several_reasons"))


_FACT_NAMES = ("invoice_no", "stock_code", "description", "quantity", "invoice_date", "unit_price", "customer_id", "country",
               "total_line_revenue", "is_cancelled")


def write_split(raw: DataFrame, fact_target: str, rejected_target: str, trim_description: bool = True) -> Observation:
    """Write the fact table and the rejected rows to two paths by one job, which reads the input once.

    Returns the quality counts of that job.  Both tables are complete before either is put in place of an
    older one (``sources.replace``).  The columns that only rejected rows use are NULL in the fact table.
    """
    spark, obs = raw.sparkSession, Observation("etl_split")
    rows = split_transactions(_observed(raw, obs), trim_description)
    staged = f"{rejected_target.rstrip('/')}.split-{uuid.uuid4().hex}"
    rows.write.partitionBy("rejected").parquet(staged)
    for side, target in (("true", rejected_target), ("false", fact_target)):
        one = f"{staged}/rejected={side}"
        if not exists(spark, one):
            spark.createDataFrame([], rows.drop("rejected").schema).write.parquet(one)
        whole = f"{target.rstrip('/')}.new-{uuid.uuid4().hex}"
        move(spark, one, whole)
        switch(spark, whole, target)
    remove(spark, staged)
    return obs


def _observed(raw: DataFrame, obs: Observation) -> DataFrame:
    return raw.observe(obs, F.count(F.lit(1)).alias("rows_in"), *[F.count_if(cond).alias(name) for name, cond in _reasons().items()],
                       F.count_if(_kept()).alias("rows_kept"))


def quality_counts(raw: DataFrame) -> DataFrame:
    """One-row data-quality report: rows in, rows failing each rule, rows kept.

    Each reason is evaluated on every input row, so a row failing two rules
    is counted under both.  One aggregate pass with partial aggregation.
    """
    r = _reasons()
    return raw.agg(
        F.count(F.lit(1)).alias("rows_in"),
        *[F.count_if(cond).alias(name) for name, cond in r.items()],
        F.count_if(_kept()).alias("rows_kept"),
    )


def clean_with_metrics(raw: DataFrame, trim_description: bool = True) -> tuple[DataFrame, Observation]:
    """Cleaning plus the quality counts collected while the data flows (no second pass).

    The observation is filled when an action runs on the returned frame
    (typically the fact-table write).
    """
    obs = Observation("etl_quality")
    return clean_transactions(_observed(raw, obs), trim_description), obs
