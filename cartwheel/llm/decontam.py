"""Benchmark decontamination by spaced seeds.

A text is a sequence of words (letters and digits, lower-cased).  Each mask of ``MASKS`` selects some of
the next few words and ignores the others, so a hash of the selected words survives a substitution at an
ignored place.  The masks fit somewhere in every stretch of ``LEAST_MATCHES`` equal words with four fifths equal, and
with ``SHORT_MASKS``, used for items of less than ``FEW_BELOW`` words, in every shorter item of which four
fifths are equal.  Hashes of the benchmark's items are joined with those of the documents; every hit gives
an alignment of an item with a document, on which the best stretch is found: the one with the most equal
words among those of which at least four fifths are equal (then the shortest, then the first).  An overlap counts
if it has ``LEAST_MATCHES`` equal words (or, for shorter items, four fifths of them).  Items of 5 to 7 words must occur whole and
unchanged; shorter ones are no evidence and never match.

The seed table of a benchmark of at most ``BROADCAST_WORDS`` words (its size is counted first) goes to every
task and hits are found and verified while the documents are read once.  A larger benchmark is joined by
shuffle: seeds of both sides meet on their hash, and only the aligned texts are brought together.

Null and empty texts and items never match.  Repeated rows are reported once; repeated items each under
their own id.  Empty tables give an empty result.  Texts are tokenized piecewise; no other columns
are read.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import ROW_ID, ROW_KEY, row_id, row_names, stored, text_column, whitespace_pieces, with_row_name, worker_state
from cartwheel.llm.minhash import WordHashes, mix

MASKS = ("111111", "110110011", "1101001011", "10110100011", "1110111")
SHORT_MASKS = ("11111", "1101011")
LEAST_WORDS, EXACT_BELOW, FEW_BELOW, LEAST_MATCHES = 5, 8, 12, 12
BROADCAST_WORDS = 500_000  # about 30 MB of seeds; larger benchmarks are joined by shuffle
BITMAP = 22

_words = re.compile(r"[^\W_]+").findall
HIT = "doc_id long, row_key long, item_id long, n_matched int, n_aligned int, first_word int"


def words(text: str | None) -> np.ndarray:
    """Hashes of a text's words, in order."""
    known = worker_state("seed-words", WordHashes)
    parts = [np.empty(0, np.uint64)]
    for piece in whitespace_pieces(text or ""):
        found = _words(piece.lower())
        parts.append(np.fromiter([known[w] for w in found], np.uint64, len(found)))
    return np.concatenate(parts)


def seeds(w: np.ndarray, mask: str, number: int) -> np.ndarray:
    """Hash of the selected words at every place where the mask fits."""
    n = len(w) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, number + 1, np.uint64)
    for j, bit in enumerate(mask):
        if bit == "1":
            h = (h ^ w[j:j + n]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return mix(h)


def all_seeds(w: np.ndarray):
    """The seeds of every mask."""
    for k, mask in enumerate(MASKS):
        yield seeds(w, mask, k)


def short_seed(w: np.ndarray, size: int) -> np.ndarray:
    return seeds(w, "1" * size, len(MASKS) + size)


def few_seeds(w: np.ndarray):
    """The seeds of the masks for items of few words."""
    for k, mask in enumerate(SHORT_MASKS):
        yield seeds(w, mask, 100 + k)


def item_seeds(w: np.ndarray) -> list[np.ndarray]:
    if len(w) < LEAST_WORDS:
        return []
    if len(w) < len(MASKS[0]):
        return [short_seed(w, len(w))]
    return [*all_seeds(w), *(few_seeds(w) if EXACT_BELOW <= len(w) < FEW_BELOW else [])]


def doc_seeds(w: np.ndarray, sizes: list[int]):
    """The seeds of a document that items need whose numbers of words below ``FEW_BELOW`` are ``sizes``."""
    yield from all_seeds(w)
    for n in sizes:
        if n < len(MASKS[0]):
            yield short_seed(w, n)
    if any(n >= EXACT_BELOW for n in sizes):
        yield from few_seeds(w)


def overlap(w: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int] | None:
    """Best stretch of ``item`` laid on ``w`` at ``shift``: (equal words, words, first word), if it counts."""
    a, z = max(0, -shift), min(len(item), len(w) - shift)
    equal = w[a + shift:z + shift] == item[a:z]
    if len(item) < EXACT_BELOW:
        return (len(item), len(item), shift) if z - a == len(item) and equal.all() else None
    at = np.flatnonzero(equal)  # the stretch begins and ends with an equal word
    if not len(at):
        return None
    # From the i-th to the j-th equal word four fifths are equal if level[i] <= level[j] + 1.
    level = 5 * np.arange(len(at)) - 4 * at
    begin = np.searchsorted(-np.minimum.accumulate(level), -(level + 1))
    matched, size = np.arange(len(at)) - begin + 1, at - at[begin] + 1
    end = int(np.lexsort((size, -matched))[0])
    if matched[end] >= min(LEAST_MATCHES, -(-len(item) * 4 // 5)):
        return int(matched[end]), int(size[end]), int(a + at[begin[end]] + shift)
    return None


class SeedTable:
    """Seeds of a benchmark held in memory."""

    def __init__(self, items: list[tuple[int, str | None]]):
        self.ids = [i for i, _ in items]
        self.items = [words(t) for _, t in items]
        hashes, which, place = [], [], []
        for k, w in enumerate(self.items):
            for h in item_seeds(w):
                hashes.append(h)
                which.append(np.full(len(h), k))
                place.append(np.arange(len(h)))
        cat = lambda x, kind: np.concatenate([np.empty(0, kind), *x]).astype(kind)
        h = cat(hashes, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hash, self.which, self.place = h[order], cat(which, np.int64)[order], cat(place, np.int64)[order]
        self.short = sorted({len(w) for w in self.items if LEAST_WORDS <= len(w) < FEW_BELOW})
        self.seen = np.zeros(1 << BITMAP, bool)
        self.seen[self.hash >> np.uint64(64 - BITMAP)] = True

    def hits(self, w: np.ndarray) -> set[tuple[int, int]]:
        """(item, shift) of every seed that a document shares with the benchmark."""
        found: set[tuple[int, int]] = set()
        for h in doc_seeds(w, self.short):
            at = np.flatnonzero(self.seen[h >> np.uint64(64 - BITMAP)])
            if not len(at):
                continue
            lo, hi = np.searchsorted(self.hash, h[at], "left"), np.searchsorted(self.hash, h[at], "right")
            for p, a, z in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                found.update(zip(self.which[a:z].tolist(), (p - self.place[a:z]).tolist()))
        return found

    def overlaps(self, w: np.ndarray) -> dict[int, tuple[int, int, int]]:
        """Best overlap with each item."""
        best: dict[int, tuple[int, int, int]] = {}
        for k, shift in self.hits(w):
            got = overlap(w, self.items[k], shift)
            if got and (k not in best or (got[0], -got[2]) > (best[k][0], -best[k][2])):
                best[k] = got
        return best


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row_key"),
                       text_column().alias("text"))


def _hit_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 6
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      ["doc_id", "row_key", "item_id", "n_matched", "n_aligned", "first_word"])


def _by_broadcast(docs: DataFrame, items: list[tuple[int, str | None]]) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(items)
    key = f"seed-table-{uuid.uuid4().hex}"

    def run(batches):
        found = worker_state(key, lambda: SeedTable(held.value))
        for b in batches:
            rows = []
            for i, r, t in zip(*[c.to_pylist() for c in b.columns]):
                rows += [(i, r, found.ids[k], *got) for k, got in found.overlaps(words(t)).items()]
            if rows:
                yield _hit_batch(rows)

    return _rows(docs).mapInArrow(run, HIT)


def _by_shuffle(docs: DataFrame, bench: DataFrame) -> DataFrame:
    bench = stored(bench.select(F.col("item_id").cast("long").alias("item_id"), text_column().alias("item")), "benchmark")

    def of_items(batches):
        for b in batches:
            out = [(i, h.view(np.int64), p, len(w)) for i, t in zip(*[c.to_pylist() for c in b.columns])
                   for w in [words(t)] for h in item_seeds(w) for p in [np.arange(len(h), dtype=np.int32)]]
            for i, h, p, n in out:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), i)), pa.array(h), pa.array(p),
                                                  pa.array(np.full(len(h), n, np.int32))], ["item_id", "h", "q", "n"])

    item_side = stored(bench.mapInArrow(of_items, "item_id long, h long, q int, n int"), "item-seeds")
    short = [r.n for r in item_side.where(F.col("n") < FEW_BELOW).select("n").distinct().collect()]  # at most seven

    def of_docs(batches):
        for b in batches:
            for i, r, t in zip(*[c.to_pylist() for c in b.columns]):
                w = words(t)
                for h in doc_seeds(w, short):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i] * len(h), pa.int64()), pa.array(np.full(len(h), r)), pa.array(h.view(np.int64)),
                         pa.array(np.arange(len(h), dtype=np.int32))], ["doc_id", "row_key", "h", "p"])

    doc_side = _rows(docs).mapInArrow(of_docs, "doc_id long, row_key long, h long, p int")
    shifts = (doc_side.join(item_side, "h")
              .select("doc_id", "row_key", "item_id", (F.col("p") - F.col("q")).alias("shift")).distinct())
    texts = with_row_name(docs.select(text_column().alias("text"), "doc_id")).drop("doc_id")
    named = shifts.join(bench, "item_id").withColumns({ROW_ID: row_id(), ROW_KEY: F.col("row_key")})
    aligned = named.join(texts, [ROW_ID, ROW_KEY])

    def check(batches):
        for b in batches:
            rows = []
            for i, r, k, s, item, t in zip(*[c.to_pylist() for c in b.columns]):
                got = overlap(words(t), words(item), s)
                if got:
                    rows.append((i, r, k, *got))
            if rows:
                yield _hit_batch(rows)

    return aligned.select("doc_id", "row_key", "item_id", "shift", "item", "text").mapInArrow(check, HIT)


def leaks(docs: DataFrame, bench: DataFrame, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """Per document (row) and benchmark item that overlap: ``doc_id, row_key, item_id``, equal and aligned
    words of the best stretch, and its first word's place in the document."""
    size = bench.select(F.sum(F.length(text_column()))).first()[0] or 0
    if size <= 6 * broadcast_words:
        items = [(r.item_id, r.text) for r in bench.where("item_id is not null").select("item_id", "text").collect()]
        found = _by_broadcast(docs, items)
    else:
        found = _by_shuffle(docs, bench.where("item_id is not null"))
    best = F.max(F.struct("n_matched", (-F.col("first_word")).alias("before"), "n_aligned")).alias("best")
    return (found.groupBy("doc_id", "row_key", "item_id").agg(best)
            .select("doc_id", "row_key", "item_id", "best.n_matched", "best.n_aligned",
                    (-F.col("best.before")).alias("first_word")))


def clean(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item."""
    hit = stored(leaks(docs, bench).select("doc_id", "row_key").distinct(), "leaks")
    return with_row_name(docs).join(row_names(hit), [ROW_ID, ROW_KEY], "left_anti").select(docs.columns)
