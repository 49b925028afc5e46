"""Helpers shared by the corpus operators."""

from __future__ import annotations

import atexit
import contextlib
import sys
import types
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.session import ensure_checkpoint_dir


# Names that no input column has: a row's id and the hash of its text, as the other side of a join.
ROW_ID, ROW_KEY = "_cartwheel_row_id", "_cartwheel_row_key"


BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Bound the bytes of a batch that goes to Python, unless the session sets a bound: texts vary from words to
    megabytes, and the default bounds rows only."""
    now = spark.conf.get(_BATCH_CONF, None)
    if now is None or int(now if now.isdigit() else -1) > 1 << 40:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def gathered(batches, size: int):
    """Batches joined until they hold ``size`` bytes."""
    held, total = [], 0
    for b in batches:
        held.append(b)
        total += b.nbytes
        if total >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, total = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the application's shared checkpoint folder."""
    bounded_batches(spark)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not _MADE:
        atexit.register(_remove_made, spark._jvm)
    _MADE.append(path)
    return path


_MADE: list[str] = []


def _remove_made(jvm) -> None:
    """Remove this application's intermediate tables when the driver ends."""
    with contextlib.suppress(Exception):  # the JVM may have gone first; results never depend on this
        conf = jvm.org.apache.hadoop.conf.Configuration()
        for path in _MADE:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def stored(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """``df`` written once (with the writer's ``options``) to the shared folder and read back: cuts the lineage,
    survives lost executors, and is computed once however often it is used afterwards."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def worker_state(key: str, make):
    """Value kept by a Python worker between tasks (``make()`` on first use).  It holds only
    read-only tables and bounded caches, so results never depend on it.  The two values used last are
    kept; those of earlier stages go."""
    home = sys.modules.setdefault("_cartwheel_worker_state", types.ModuleType("_cartwheel_worker_state"))
    kept = home.__dict__.setdefault("kept", {})
    if key not in kept:
        for old in list(kept)[:-1]:
            del kept[old]
        kept[key] = make()
    return kept[key]


def map_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(columns: dict[str, list]) -> dict[str, list | array]`` over Arrow batches of ``df``."""
    out = _arrow_schema(df.sparkSession, schema)

    def run(batches):
        for b in batches:
            cols = fn({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)})
            yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], type=f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = StructType.fromDDL(ddl)
    return to_arrow_schema(kind)


def text_column(name: str = "text"):
    """A text column with null read as the empty string."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def row_id():
    """``doc_id`` as a join key that is never null."""
    return F.coalesce(F.col("doc_id").cast("string"), F.lit(""))


def with_row_name(docs: DataFrame) -> DataFrame:
    """``docs`` with the name of each row: its id and the hash of its text."""
    return docs.withColumns({ROW_ID: row_id(), ROW_KEY: F.xxhash64("text")})


def row_names(rows: DataFrame) -> DataFrame:
    """The names of rows given by ``doc_id`` and ``row_key``."""
    return rows.select(row_id().alias(ROW_ID), F.col("row_key").alias(ROW_KEY))


def whitespace_pieces(text: str, size: int = 1 << 20):
    """Cut ``text`` just before ASCII white space into pieces of about ``size`` characters.
    A run without white space stays whole, so no token is cut."""
    start, n = 0, len(text)
    while n - start > size:
        cut = min((i for i in (text.find(c, start + size) for c in " \n\t\r") if i >= 0), default=-1)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def cut_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The runs of other characters than ASCII white space of all texts one after the other, and how many each text has."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.string()))
    words, ends = lists.flatten(), lists.offsets.to_numpy()
    some = pc.greater(pc.binary_length(words), 0)  # white space at an end of a text leaves empty words there
    upto = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    return words.filter(some), np.diff(upto[ends - ends[0]])


def lowered_runs(runs: pa.Array) -> pa.Array:
    """Runs as bytes, for a tokenizer that lower-cases all but special-token strings.  Done beforehand it saves runs; not
    where a combining mark (U+0300 on, first byte 0xCC) could join a small letter but not its capital."""
    ends = np.frombuffer(runs.buffers()[1], np.int32)[runs.offset:runs.offset + len(runs) + 1]
    beyond = np.concatenate([[0], np.cumsum(np.frombuffer(runs.buffers()[2] or b"", np.uint8) >= 0xCC)])[ends]
    kept = pc.or_(pa.array(np.diff(beyond) > 0), pc.match_substring(runs, "<|"))
    return pc.if_else(kept, runs, pc.ascii_lower(runs)).cast(pa.binary())


def ended(numbers: np.ndarray, n: np.ndarray, end: int) -> np.ndarray:
    """The numbers of all texts' words one text after the other, with ``end`` after each text of ``n`` words."""
    out, ends = np.empty(len(numbers) + len(n), np.int32), np.zeros(len(numbers) + len(n), bool)
    ends[np.cumsum(n + 1) - 1] = True
    out[ends] = end
    out[~ends] = numbers
    return out
