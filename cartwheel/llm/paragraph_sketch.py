"""Document fingerprints that subtract: invertible Bloom lookup sketches of hashed paragraphs.

A text is cut into paragraphs: at line ends and sentence ends, and paragraphs of over ``LONG`` characters also after
words chosen by their own hash, so that a change moves only the cuts beside it.  The pieces joined are the text.  A
piece's digest is 64 bits; equal pieces of one text are told apart by their number.  A sketch has three
rows of cells; each digest goes to one cell of each row, which holds the number of its digests, their XOR and the XOR
of their check values.  Sketches of two versions subtract cell by cell, which leaves the digests of only one
of them.  Peeling takes a cell with a single digest, records it and removes it from its other cells, until none is
left.  If cells remain, both versions are sketched again with twice the cells, up to ``MOST`` times
the digests, where the digests themselves are compared; so the count of differing paragraphs is always exact.

``fingerprint`` is the sketch of ``CELLS`` cells with the number of digests in front: equal texts have equal
fingerprints, however they were reached.  The likeness of two texts is the share of their pieces that both hold,
2 * common / (all of one + all of the other), 1 for two empty texts.

The next document is that of the next larger ``doc_id``, that of the last row is the first.  Rows without
``doc_id`` come first, rows of one id are ordered by their text's hash, and repeated rows follow each other.  Texts are
sorted once, in ranges of that order; a task holds one batch and the row before it, and the rows at the edges of ranges
meet in a second step.  Null texts are empty; an empty table gives an empty result; a very long text costs memory in
proportion to its own length.  Only ``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cartwheel.llm.common import stored, text_column

CELLS, ROWS, MOST, LONG, CUT = 12, 3, 16, 240, 8
TOGETHER = 1 << 22  # characters of the texts that are sketched together

_PIECE = re.compile(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+")
_WORD = re.compile(r"\s*\S+\s*|\s+")


def pieces(text: str) -> list[str]:
    """The paragraphs of a text; joined they are the text."""
    out = _PIECE.findall(text)
    if len(text) <= LONG or all(len(x) <= LONG for x in out):
        return out
    return [y for x in out for y in (_cut(x) if len(x) > LONG else (x,))]


def _cut(piece: str) -> list[str]:
    out, held = [], []
    for w in _WORD.findall(piece):
        held.append(w)
        if zlib.crc32(w.strip().encode()) % CUT == 0:
            out.append("".join(held))
            held = []
    return out + ["".join(held)] * bool(held)


def digests(text: str) -> np.ndarray:
    """64 bits for each paragraph; the n-th equal one has a digest of its own."""
    own = pieces(text)
    hashed = xxhash.xxh3_64_intdigest
    if len(set(own)) == len(own):
        return np.array([hashed(x.encode()) for x in own], np.uint64)
    return np.array([hashed(x.encode(), k) for x, n in Counter(own).items() for k in range(n)], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sketch:
    """Sketches of ``n`` texts with ``cells`` cells each, one after the other."""

    def __init__(self, n: int, cells: int):
        self.n, self.cells = n, cells
        self.count = np.zeros(n * cells, np.int64)
        self.keys = np.zeros(n * cells, np.uint64)
        self.checks = np.zeros(n * cells, np.uint64)

    def change(self, owner: np.ndarray, keys: np.ndarray, times) -> None:
        """Add (``times`` 1) or take away (-1) digests of the texts numbered ``owner``."""
        wide, check = self.cells // ROWS, _mix(keys)
        for row in range(ROWS):
            place = (_mix(keys + np.uint64(0x9E3779B97F4A7C15 * (row + 1) & (1 << 64) - 1)) % np.uint64(wide)).astype(np.int64)
            at = owner * self.cells + row * wide + place
            np.add.at(self.count, at, times)
            np.bitwise_xor.at(self.keys, at, keys)
            np.bitwise_xor.at(self.checks, at, check)

    def __sub__(self, other: "Sketch") -> "Sketch":
        out = Sketch(0, self.cells)
        out.n, out.count = self.n, self.count - other.count
        out.keys, out.checks = self.keys ^ other.keys, self.checks ^ other.checks
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Owners, digests and signs of what the cells hold, and whether each text's cells came out empty."""
        found = []
        for _ in range(len(self.count) + 1):
            at = np.flatnonzero(np.abs(self.count) == 1)
            at = at[_mix(self.keys[at]) == self.checks[at]]
            if not len(at):
                break
            owner, keys, sign = at // self.cells, self.keys[at], self.count[at]
            order = np.lexsort((keys, owner))
            owner, keys, sign = owner[order], keys[order], sign[order]
            new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1])])
            owner, keys, sign = owner[new], keys[new], sign[new]
            self.change(owner, keys, -sign)
            found.append((owner, keys, sign))
        full = (self.count != 0) | (self.keys != 0) | (self.checks != 0)
        empty = ~full.reshape(self.n, self.cells).any(axis=1)
        owner, keys, sign = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
        return owner, keys, sign, empty


def _laid(items: list[np.ndarray], which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    chosen = [items[k] for k in which.tolist()]
    return np.repeat(np.arange(len(which)), [len(x) for x in chosen]), np.concatenate([np.zeros(0, np.uint64), *chosen])


def sketches(items: list[np.ndarray], cells: int, which: np.ndarray | None = None) -> Sketch:
    which = np.arange(len(items)) if which is None else which
    out = Sketch(len(which), cells)
    out.change(*_laid(items, which), 1)
    return out


def differences(a: list[np.ndarray], b: list[np.ndarray], cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each pair of texts, by their digests: how many only the first holds, only the second, and the cells that
    sufficed to find them (0: the digests were compared)."""
    n = len(a)
    only_a, only_b, used = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    left = np.arange(n)
    sizes = np.array([len(x) + len(y) for x, y in zip(a, b)], np.int64).reshape(-1)
    while len(left):
        beyond = cells > np.maximum(MOST * sizes[left], CELLS)
        for k in left[beyond].tolist():
            only_a[k], only_b[k] = len(np.setdiff1d(a[k], b[k])), len(np.setdiff1d(b[k], a[k]))
        left = left[~beyond]
        again = []
        wide = max(1, (1 << 20) // cells)  # texts whose cells are held at a time
        for s in range(0, len(left), wide):
            part = left[s:s + wide]
            owner, _, sign, empty = (sketches(a, cells, part) - sketches(b, cells, part)).peel()
            more, less = (np.bincount(owner[sign == x], minlength=len(part)) for x in (1, -1))
            only_a[part[empty]], only_b[part[empty]], used[part[empty]] = more[empty], less[empty], cells
            again.append(part[~empty])
        left = np.concatenate([np.zeros(0, np.int64), *again])
        cells *= 2
    return only_a, only_b, used


def written(items: list[np.ndarray]) -> list[str]:
    """Fingerprints: the number of digests, and the cells in base 64."""
    s = sketches(items, CELLS)
    cells = np.zeros((len(items), CELLS), np.dtype([("n", "<i4"), ("key", "<u8"), ("check", "<u4")]))
    cells["n"], cells["key"] = s.count.reshape(-1, CELLS), s.keys.reshape(-1, CELLS)
    cells["check"] = (s.checks & np.uint64(0xFFFFFFFF)).reshape(-1, CELLS)
    return [f"{len(x)}:{base64.b64encode(c.tobytes()).decode()}" for x, c in zip(items, cells)]


def likeness(a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Share of the pieces that both texts hold, and the cells used."""
    only_a, only_b, used = differences(a, b)
    total = np.array([len(x) + len(y) for x, y in zip(a, b)], np.float64).reshape(-1)
    return np.where(total > 0, (total - only_a - only_b) / np.maximum(total, 1), 1.0), used


_RESULT = {"n_chars": "long", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string",
           "near_edited": "double", "near_next": "double", "cells_edited": "long", "cells_next": "long"}


def compared(texts: list[str], following: list[str]) -> list:
    """The result's columns for texts and the documents after them."""
    edited = [t[:len(t) - len(t) // 2] + f[:len(t) // 2] for t, f in zip(texts, following)]
    seen: dict[str, np.ndarray] = {}

    def of(t: str) -> np.ndarray:  # a document is also the next one of the row before it
        if t not in seen:
            seen[t] = digests(t)
        return seen[t]

    own, after, changed = [of(t) for t in texts], [of(t) for t in following], [digests(t) for t in edited]
    near_edited, cells_edited = likeness(own, changed)
    near_next, cells_next = likeness(own, after)
    return [pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
            pa.array(written(own), pa.string()), pa.array(written(changed), pa.string()),
            pa.array(near_edited), pa.array(near_next), pa.array(cells_edited), pa.array(cells_next)]


def _parts(ids: list, texts: list[str], following: list[str], names: list[str], id_type):
    start, size = 0, 0
    for k in range(len(texts) + 1):
        if k == len(texts) or size > TOGETHER:
            if k > start:
                cols = compared(texts[start:k], following[start:k])
                yield pa.RecordBatch.from_arrays([pa.array(ids[start:k], id_type), *cols], names)
            start, size = k, 0
        if k < len(texts):
            size += len(texts[k])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` and the numbers of
    cells that the two comparisons took (``cells_edited, cells_next``)."""
    kind = docs.schema["doc_id"].dataType
    id_type, names = to_arrow_type(kind), ["doc_id", *_RESULT]
    schema = f"doc_id {kind.simpleString()}, " + ", ".join(f"{k} {v}" for k, v in _RESULT.items())
    # The last key spreads repeated rows over ranges; their order among themselves changes nothing.
    keys = ["doc_id", "row_hash", "row_number"]
    rows = docs.select("doc_id", text_column().alias("text")).withColumns(
        {"row_hash": F.xxhash64("text"), "row_number": F.monotonically_increasing_id()})

    def within(batches):
        """Results of all rows but the last; the first and the last row as they are."""
        part, ids, texts, first = TaskContext.get().partitionId(), [], [], True

        def edge(k, which):
            cols = [pa.array([ids[k]], id_type), *(pa.nulls(1, t) for t in (
                pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64()))]
            return pa.RecordBatch.from_arrays([*cols, pa.array([part], pa.int64()), pa.array([which], pa.string()), pa.array([texts[k]], pa.string())],
                                              [*names, "part", "edge", "text"])

        for b in batches:
            ids += b.column(0).to_pylist()
            texts += b.column(1).to_pylist()
            if texts and first:
                yield edge(0, "first")
                first = False
            for out in _parts(ids[:-1], texts[:-1], texts[1:], names, id_type):
                n = out.num_rows
                yield pa.RecordBatch.from_arrays([*out.columns, pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())],
                                                 [*names, "part", "edge", "text"])
            ids, texts = ids[-1:], texts[-1:]
        if texts:
            yield edge(0, "last")

    def across(batches):
        for b in batches:
            yield from _parts(*(c.to_pylist() for c in b.columns), names, id_type)

    done = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
                  .mapInArrow(within, schema + ", part long, edge string, text string"), "fingerprints")
    last = done.where(F.col("edge") == "last").select("doc_id", "part", "text")
    first = done.where(F.col("edge") == "first").select(F.col("part").alias("next"), F.col("text").alias("following"))
    # One number for each range, so this order is bounded by the number of ranges.
    by_part = Window.orderBy("part")
    after = last.select("part").withColumn("next", F.coalesce(F.lead("part").over(by_part), F.first("part").over(by_part)))
    edges = last.join(after, "part").join(first, "next").select("doc_id", "text", "following").mapInArrow(across, schema)
    return done.where(F.col("edge").isNull()).select(*names).unionByName(edges)
