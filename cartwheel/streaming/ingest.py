"""The ETL in incremental form: new raw invoice files -> cleaned fact rows.

Structured Streaming runs the same ``clean_transactions`` operator (a
stateless select/filter, so no watermark or state store is involved) over a
file source and appends to the fact table's parquet folder.  Progress lives
beside the data, in ``<fact_path>/_checkpoints/<name>`` (readers skip
folders with an underscore), so it is found again by any later application
and a restarted query picks up exactly the files it has not committed yet
(exactly-once for the file sink).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cartwheel.operators.clean import clean_transactions, quality_counts
from cartwheel.sources.retail import conform_raw


def raw_stream(spark: SparkSession, source_dir: str, fmt: str = "parquet",
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of raw invoice-line files, conformed like a batch read.

    Column names and types are those of the files already there (CSV cells
    are text), so the folder must hold a file when the stream starts.
    """
    header = {"header": "true", "inferSchema": "false"} if fmt == "csv" else {}
    schema = spark.read.format(fmt).options(**header).load(source_dir).schema
    reader = spark.readStream.schema(schema).format(fmt).options(**header)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return conform_raw(reader.load(source_dir))


def start_fact_ingest(spark: SparkSession, source_dir: str, fact_path: str, name: str = "fact_ingest",
                      checkpoint_location: str | None = None, fmt: str = "parquet",
                      available_now: bool = True, trim_description: bool = True) -> StreamingQuery:
    """Start appending cleaned lines from ``source_dir`` to ``fact_path``.

    ``available_now=True`` processes everything present and stops (a
    scheduled incremental batch); otherwise it runs until stopped.
    """
    ckpt = checkpoint_location or f"{fact_path.rstrip('/')}/_checkpoints/{name}"
    cleaned = clean_transactions(raw_stream(spark, source_dir, fmt), trim_description)
    writer = (cleaned.writeStream.format("parquet")
                     .option("path", fact_path)
                     .option("checkpointLocation", ckpt)
                     .outputMode("append")
                     .queryName(name))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def start_quality_monitor(spark: SparkSession, source_dir: str, name: str = "etl_quality",
                          fmt: str = "parquet") -> StreamingQuery:
    """Running data-quality counts over all raw files seen so far (in-memory table ``name``)."""
    counts = quality_counts(raw_stream(spark, source_dir, fmt))
    return (counts.writeStream.format("memory").queryName(name).outputMode("complete")
                  .trigger(availableNow=True).start())
