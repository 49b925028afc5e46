"""Reading raw invoice lines and reading/writing stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.schema import PASCAL_TO_SNAKE, RAW_SCHEMA
from cartwheel.sources.dates import find_order, timestamp_of
from cartwheel.sources.once import read_once
from cartwheel.sources.replace import exists, recover, recover_table, replace_path, replace_table


def to_canonical_names(df: DataFrame) -> DataFrame:
    """Rename spreadsheet-style PascalCase headers to snake_case."""
    for src, dst in PASCAL_TO_SNAKE.items():
        if src in df.columns and dst not in df.columns:
            df = df.withColumnRenamed(src, dst)
    return df


def conform_raw(df: DataFrame, date_order: str | None = None, keep_cells: bool = False) -> DataFrame:
    """Project a raw frame onto ``RAW_SCHEMA`` (names, order, types).

    Whole numbers may come as '6', '6.0', '1e3' or a DOUBLE column, as
    spreadsheets write them.  A cell that is no such number, price or date
    becomes NULL, and the cleaning rules reject and count the row
    (``bad_qty``, ``null_customer``, ``bad_price``, ``bad_date``) instead of
    failing the job or losing it.

    Dates in text may be ISO, have the year last or a month's name (``sources.dates``).
    Which of two numbers is the month is found from the whole column, by one aggregate over it,
    unless ``date_order`` says so (a stream must, as its column is never whole: else only
    forms that leave no doubt are read).  ``keep_cells`` adds the input row as it came, as struct ``cells``.
    """
    cells = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("cells")
    df = to_canonical_names(df.select("*", cells) if keep_cells else df)
    types = dict(df.dtypes)
    out = []
    for f in RAW_SCHEMA.fields:
        c = F.col(f.name)
        if f.dataType.typeName() == "long":
            c = c if types[f.name] in ("bigint", "int", "smallint", "tinyint") else _whole(c)
        elif f.name == "invoice_date" and types[f.name] == "string":
            order = (date_order or "none") if df.isStreaming else find_order(df, f.name, date_order)
            c = timestamp_of(c, order)
        elif types[f.name] == "string":
            c = F.trim(c).try_cast(f.dataType) if f.dataType.typeName() != "string" else c
        else:
            c = c.try_cast(f.dataType)
        out.append(c.cast(f.dataType).alias(f.name))
    # A stream may not hold the generator; typed columns need no cell read and keep their filters at the scan.
    if df.isStreaming or all(t != "string" or f.dataType.typeName() == "string" for f, t in
                             ((f, types[f.name]) for f in RAW_SCHEMA.fields)):
        return df.select(*out, *(["cells"] if keep_cells else []))
    return read_once(df, [*out, *([F.col("cells")] if keep_cells else [])])


def _whole(c):
    """A number without a fraction as BIGINT, else NULL.  The usual '6' and '6.0' take a test and a cast; all
    other forms go through an exact decimal."""
    text = F.trim(c.cast("string"))
    exact = F.coalesce(text.try_cast("decimal(38,10)"), text.try_cast("double").try_cast("decimal(38,10)"))
    return F.when(text.rlike(r"^[+-]?[0-9]{1,18}([.]0*)?$"), F.substring_index(text, ".", 1).try_cast("bigint")).otherwise(
        F.when(exact == F.floor(exact), exact.try_cast("bigint")))


def read_raw_transactions(spark: SparkSession, path: str, fmt: str = "parquet", date_order: str | None = None,
                          keep_cells: bool = False, **options) -> DataFrame:
    """Scan raw invoice lines (S01); parquet/orc keep their types, CSV is read as text.

    No schema inference: CSV columns are read as strings and converted by
    ``conform_raw``.  A missing path raises Spark's PATH_NOT_FOUND analysis
    error (S02).
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").option("inferSchema", "false")
    for k, v in options.items():
        reader = reader.option(k, v)
    return conform_raw(reader.load(path), date_order, keep_cells)


def write_table(df: DataFrame, target: str, fmt: str = "parquet",
                partition_by: list[str] | None = None, only_partitions: bool = False) -> None:
    """Replace-write a table (S04/S05): a path ('/...' or 'scheme://...') or a catalog name.

    The new table is complete before the old one goes (``sources.replace``).  ``only_partitions`` replaces the
    partitions that ``df`` holds and leaves the others (paths only).
    """
    if "/" in target or "://" in target:
        replace_path(df, target, fmt, partition_by, only_partitions)
    elif only_partitions:
        raise ValueError("only_partitions is for tables at a path")
    else:
        replace_table(df, target, fmt, partition_by)


def read_table(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    """Scan a stored table (S03) by path or catalog name; downstream pruning keeps it narrow."""
    if "/" in target or "://" in target:
        if not exists(spark, target):  # a writer may have died between its two moves
            recover(spark, target)
        return spark.read.format(fmt).load(target)
    if not spark.catalog.tableExists(target):
        recover_table(spark, target)
    return spark.table(target)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """CREATE OR REPLACE (temp) VIEW."""
    df.createOrReplaceTempView(name)
    return df


def use_database(spark: SparkSession, name: str) -> None:
    """USE db (S07)."""
    spark.catalog.setCurrentDatabase(name)
