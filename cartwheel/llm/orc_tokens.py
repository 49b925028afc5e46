"""Token ids in ORC files.

One ORC row per document: ``part`` (file's place in the order), ``place`` (row's place in the file), ``doc_id``,
``n_tokens`` (with the end id) and ``ids``.  Documents are range-partitioned and sorted by ``doc_id``, so every file, stripe
and row group holds a narrow range of ids: readers skip them by their min/max statistics and by the
Bloom filter on ``doc_id``, and stripes are read in parallel.  Integer run-length encoding is ORC's
own for the id lists.

The encoder is the public tokenizers library.  A tokenizer that drops white space never looks across
it, so each distinct run of other characters is encoded once by the library and remembered (bounded
caches), and a document's ids are those of its runs in order.  The texts of a batch are cut and their distinct runs found as Arrow
columns; ids are then taken by run number.

Null and empty texts hold the end id alone; repeated rows are all kept (rows of one ``doc_id`` are ordered by their
text's hash, and their starts follow the files' order); a very long text costs memory in proportion to its own length; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cartwheel.llm.common import cut_words, ended, lowered_runs, text_column, worker_state

CACHED = 800_000  # runs and parts of runs that a Python worker remembers (about 160 MB); only speed depends on it
STRIPE_BYTES = 64 << 20
ROW_GROUP = 10_000
FILE_SCHEMA = "part int, place long, doc_id long, n_tokens long, ids array<int>"


#: A byte's letter in the tokenizer's vocabulary: itself if it can be seen in Latin-1, else the next from U+0100 on.
SEEN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LETTERS = dict(zip((b for b in range(256) if b not in SEEN), range(0x100, 0x200)))


class Remembered(dict):
    """A bounded cache: once full it keeps what it has, and starts afresh after four times as many misses."""

    missed = 0

    def add(self, key, value) -> None:
        if len(self) < CACHED:
            self[key] = value
        else:
            self.missed += 1
            if self.missed > 4 * CACHED:
                self.clear()
                self.missed = 0


class RunEncoder:
    """The library's encoder for a tokenizer that ignores white space, run by run.

    A run of other characters that is not remembered is first cut into words, an apostrophe with the
    letters after it, and other signs, as the tokenizer itself cuts it, if it has only characters up to
    U+024F (and not U+0130, which lower-cases to two) and no special-token string.  Parts that are
    remembered need no further work; small letters up to U+00FF, which the normaliser and the pre-tokenizer
    leave as they are, go straight to the library's model (bytes as its byte-level letters), all others through its
    whole pipeline."""

    def __init__(self, spec: str):
        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.parts = re.compile(r"'[^\W_]+|[^\W_]+|(?:[^\w\s]|[_\x1c-\x1f])+").findall
        self.plain = re.compile("[a-zß-öø-ÿ]+").fullmatch
        self.latin = re.compile("[\x00-\xff]+").fullmatch
        self.beyond = re.compile("[\u0130\u0250-\U0010ffff]|<\\|").search
        self.runs = Remembered()
        self.stops = {}
        self.stops = {s.encode(): self._part(s) for s in ".,;:!?"}

    def _part(self, part: str) -> bytes:
        raw = part.encode()
        out = self.runs.get(raw)
        if out is None:
            if self.plain(part):
                ids = [t.id for t in self.model.tokenize(part if part.isascii() else raw.decode("latin-1").translate(BYTE_LETTERS))]
            else:
                ids = self.library.encode(part, add_special_tokens=False).ids
            out = array("I", ids).tobytes()
            self.runs.add(raw, out)
        return out

    def _run(self, raw: bytes) -> bytes:
        if raw[-1:] in self.stops and raw[-2:-1].isalpha():  # a sign after a letter is a part of its own
            word = raw[:-1]
            return (self.runs.get(word) or self._run(word)) + self.stops[raw[-1:]]
        run = raw.decode()
        if self.plain(run):
            return self._part(run)
        parts = [run] if self.beyond(run) else self.parts(run.lower() if self.latin(run) else run)
        if len(parts) == 1:
            return self._part(parts[0])
        out = b"".join([self._part(p) for p in parts])
        self.runs.add(raw, out)
        return out

    def encode(self, text: str, end_id: int) -> np.ndarray:
        return self.encode_all(pa.array([text], pa.string()), end_id)[0]

    def encode_all(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has.  A run that they hold many times is looked
        up once."""
        runs, n = cut_words(texts)
        found = runs.dictionary_encode()
        get, make = self.runs.get, self._run
        ids = [get(r) or make(r) for r in lowered_runs(found.dictionary).to_pylist()]
        ids.append(array("I", [end_id]).tobytes())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, first = np.frombuffer(b"".join(ids), "<i4"), np.cumsum(sizes) - sizes
        which = ended(found.indices.to_numpy(), n, len(ids) - 1)
        size = sizes[which]
        upto = np.cumsum(size)
        at = np.repeat(first[which] - (upto - size), size)
        at += np.arange(len(at))
        last = upto[np.cumsum(n + 1) - 1]
        return flat.take(at), np.diff(last, prepend=0)


def encode(docs: DataFrame, spec_path: str, end_id: int) -> DataFrame:
    """``place long`` (of the row in its partition), ``doc_id long, n_tokens long, ids array<int>``, one row per input row."""
    with open(spec_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        key = "runs-" + hashlib.md5(spec.value.encode()).hexdigest()
        enc = worker_state(key, lambda: RunEncoder(spec.value))
        place = 0
        for b in batches:
            ids, sizes = enc.encode_all(b.column(1), end_id)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(place, place + len(b))), b.column(0), pa.array(sizes), lists],
                                             ["place", "doc_id", "n_tokens", "ids"])
            place += len(b)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    return rows.mapInArrow(run, "place long, doc_id long, n_tokens long, ids array<int>")


def write(docs: DataFrame, path: str, spec_path: str, end_id: int = 2) -> None:
    """Write the documents' ids below ``path`` in ascending ``doc_id`` order."""
    # Texts are put in order before they are encoded: looking for the range bounds then costs one more
    # scan and no second encoding.  The second key lets many rows of one doc_id go to several files.
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
            .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie"))
    ordered = encode(rows, spec_path, end_id).select(F.spark_partition_id().alias("part"), "place", "doc_id", "n_tokens", "ids")
    (ordered.write.option("orc.compress", "ZSTD").option("orc.stripe.size", STRIPE_BYTES)
     .option("orc.row.index.stride", ROW_GROUP).option("orc.create.index", "true")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", 0.01)
     .orc(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMA).orc(path)


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens``, ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers).

    Offsets come from one total per file (a metadata-size table) and a running sum inside each
    file, so no task sees more than one file's rows and id lists are read once."""

    def digest(batches):
        for b in batches:
            lists = b.column(4)
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False).astype("<i4"), lists.offsets.to_numpy()
            ends = ends - ends[0]
            raw = memoryview(flat.tobytes())
            crc = [zlib.crc32(raw[4 * a:4 * z]) for a, z in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(crc, pa.int64())],
                                             ["part", "place", "doc_id", "n_tokens", "ids_crc32"])

    rows = read(spark, path).mapInArrow(digest, "part int, place long, doc_id long, n_tokens long, ids_crc32 long")
    totals = read(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(before, "part")
            .select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"))


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The stored documents with these ids; stripes and row groups without them are skipped."""
    return read(spark, path).where(F.col("doc_id").isin([int(i) for i in doc_ids]))
