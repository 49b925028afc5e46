"""Shared tables, written once per input, then read by the questions.

The original work stores ``fact_transactions`` (ETL), ``customer_rfm`` and
``pred_customer_clv`` as tables and the dashboard memoises its customer
frame; the questions only read them.  ``materialize`` does the same on
Spark: the first use writes the table as parquet below the shared folder
``spark.checkpoint.dir`` (reliable storage that survives executor loss) and
every use, by this or a later application, reads it back.

A table's path holds a digest of the library's table version, the table's
name and the input's files with their sizes and modification times, taken
from the file system that Spark reads them with.  Changed input therefore
means another path; ``forget`` removes tables.  A table is written beside its
path and renamed when it is complete, so a half-written one is never read.

Tables are not bucketed by customer: a bucketed scan reads each bucket in
one task, so a customer holding a third of all lines would put a third of
the data through one task in every customer-grain aggregation.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartwheel.session import ensure_checkpoint_dir

TABLE_VERSION = 3  # raise when a stored table's definition changes
_LOCK = threading.RLock()  # one build per table even if queries run from several threads


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def input_signature(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, modification time) of every file below ``path``, on any file system."""
    fs, p = _fs(spark, path)
    top, out = fs.getFileStatus(p).getPath().toString(), []
    files = fs.listFiles(p, True)
    while files.hasNext():
        st = files.next()
        out.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
    return [(top, 0, 0), *sorted(out)]


def tables_root(spark: SparkSession) -> str:
    """The folder of the shared tables: stable if ``spark.checkpoint.dir`` is set, else (local
    mode) inside the application's own temporary checkpoint folder."""
    own = ensure_checkpoint_dir(spark)
    root = spark.conf.get("spark.checkpoint.dir", None) or own
    return f"{root.rstrip('/')}/cartwheel-tables"


def _table_path(spark: SparkSession, name: str, sf_dir: str) -> str:
    key = repr((TABLE_VERSION, name, input_signature(spark, sf_dir)))
    return f"{tables_root(spark)}/{name}-{hashlib.sha256(key.encode()).hexdigest()[:24]}"


def stored_or(spark: SparkSession, name: str, sf_dir: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A scan of the table if it is stored, else ``build()`` unstored: for one pass that needs few of its columns."""
    path = _table_path(spark, name, sf_dir)
    fs, done = _fs(spark, path)
    return spark.read.parquet(path) if fs.exists(done) else build()


def materialize(spark: SparkSession, name: str, sf_dir: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Write ``build()`` once per name and input, and return a scan of it."""
    path = _table_path(spark, name, sf_dir)
    with _LOCK:
        fs, done = _fs(spark, path)
        if not fs.exists(done):
            part = f"{path}.{uuid.uuid4().hex}"
            build().write.parquet(part)
            # Another application may have finished first: its table holds the same rows.
            if not fs.exists(done) and not fs.rename(_fs(spark, part)[1], done) and not fs.exists(done):
                raise OSError(f"could not put the table in place: {path}")
    return spark.read.parquet(path)


def forget(spark: SparkSession) -> None:
    """Remove all shared tables."""
    with _LOCK:
        fs, root = _fs(spark, tables_root(spark))
        fs.delete(root, True)
