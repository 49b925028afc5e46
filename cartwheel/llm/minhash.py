"""Near-duplicates by b-bit MinHash.

A document's set is its distinct word shingles, hashed to 64 bits.  ``MINIMA`` minima are taken over the
set; bands of ``ROWS`` minima generate candidates, and of every minimum only ``BITS`` low bits are kept,
packed into bit planes.  The similarity of two candidates is estimated by counting the positions where
all bits agree and correcting for chance agreement (2^-BITS).  Pairs whose estimate could still reach the
threshold (five standard deviations) are confirmed on the full sets.

Nothing is emitted for all pairs of a group:

1. Documents with equal sets form a class; only classes go on.
2. In each band bucket, estimates of all pairs are computed in memory and a spanning forest of the pairs
   that may link is kept.  Components of these forests hold every true link.
3. Each such component's full sets are brought together once, links are confirmed from the highest
   estimate down, pairs that are already connected are skipped, and again a spanning forest is kept.

Buckets and components beyond a block's size are cut into blocks by a hash, and every pair of blocks is a
cell of bounded memory, so no link between different texts is lost however large the group.

A band set of 25 x 5 misses a link of similarity 0.85 with probability 4e-7.  Documents without words
(null or empty texts) have an empty set and are linked with nothing; those with fewer words than a shingle
have one shingle, the whole sequence.  Repeated rows are copies of each other; a row without ``doc_id`` stays unless a
document with one is near it.  Texts are handled
piecewise.  An empty table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import ROW_ID, ROW_KEY, row_id, row_names, stored, text_column, whitespace_pieces, with_row_name, worker_state
from cartwheel.llm.components import components

SHINGLE = 5
BANDS, ROWS, BITS = 25, 5, 4
MINIMA = BANDS * ROWS
WORDS = 2  # 64-bit words of a bit plane
BLOCK_MEMBERS = 256        # members of a bucket in one block
BLOCK_SHINGLES = 100_000   # shingles of a component in one block
SALTS = 64  # keys that the members of one component are dealt to
CACHE_WORDS = 250_000

_M1, _M2, _STEP = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h
        return h


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_M1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_M2)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the lower-cased (A-Z) words of a text, in order."""
    known = worker_state("word-hashes", WordHashes)
    parts = []
    for piece in whitespace_pieces(text):
        words = piece.encode().lower().split()
        parts.append(np.fromiter([known[w] for w in words], np.uint64, len(words)))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def shingles(text: str, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles."""
    w = word_hashes(text)
    if not len(w):
        return w
    n = max(len(w) - k + 1, 1)
    h = np.full(n, min(k, len(w)), np.uint64)
    for j in range(min(k, len(w))):
        h = mix(h * np.uint64(_STEP) + w[j:j + n])
    return np.unique(h)


def _seeds() -> np.ndarray:
    return mix(np.arange(1, MINIMA + 1, dtype=np.uint64) * np.uint64(_STEP)) | np.uint64(1)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """One row of minima per set (none empty), in runs of bounded size."""
    seeds = _seeds()
    out = np.full((len(sets), MINIMA), np.iinfo(np.uint64).max, np.uint64)
    run: list[tuple[int, np.ndarray]] = []
    held = 0

    def flush():
        if run:
            x = np.concatenate([s for _, s in run])
            starts = np.cumsum([0, *[len(s) for _, s in run[:-1]]])
            rows = [i for i, _ in run]
            for p, a in enumerate(seeds):
                got = np.minimum.reduceat(x * a, starts)
                for_rows = out[rows, p]
                out[rows, p] = np.minimum(for_rows, got)
            run.clear()

    for i, s in enumerate(sets):
        for c in range(0, len(s), 200_000):
            if held + len(s[c:c + 200_000]) > 300_000 or (run and run[-1][0] == i):
                flush()
                held = 0
            run.append((i, s[c:c + 200_000]))
            held += len(run[-1][1])
    flush()
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    keys = np.empty((len(m), BANDS), np.uint64)
    for b in range(BANDS):
        h = np.full(len(m), b + 1, np.uint64)
        for r in range(ROWS):
            h = mix(h * np.uint64(_STEP) + m[:, b * ROWS + r])
        keys[:, b] = h
    return keys


def pack(m: np.ndarray) -> np.ndarray:
    """Low bits of the (mixed) minima as BITS planes of WORDS 64-bit words."""
    low = mix(m)
    planes = np.zeros((len(m), BITS, WORDS * 64), np.uint8)
    for b in range(BITS):
        planes[:, b, :MINIMA] = (low >> np.uint64(b)) & np.uint64(1)
    return np.packbits(planes, axis=2, bitorder="little").view(np.uint64).reshape(len(m), BITS * WORDS)


def estimate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Collision-corrected similarity of packed signatures (broadcasting over leading axes)."""
    d = (x ^ y).reshape(*np.broadcast_shapes(x.shape, y.shape)[:-1], BITS, WORDS)
    differ = np.bitwise_count(np.bitwise_or.reduce(d, axis=-2)).sum(axis=-1, dtype=np.int64)
    chance = 2.0 ** -BITS
    return ((MINIMA - differ) / MINIMA - chance) / (1 - chance)


def slack(threshold: float) -> float:
    """Least estimate of a pair that may reach the threshold: five standard deviations below it."""
    chance = 2.0 ** -BITS
    e = threshold * (1 - chance) + chance
    return threshold - 5 * (e * (1 - e) / MINIMA) ** 0.5 / (1 - chance)


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, row_key, n_shingles, node, sig, bands`` per row; ``node`` names the set (null if empty)."""

    def run(batches):
        for b in batches:
            sets = [shingles(t) for t in b.column(2).to_pylist()]
            full = [i for i, s in enumerate(sets) if len(s)]
            m = minima([sets[i] for i in full])
            node, sig, bands = [None] * len(sets), [None] * len(sets), [None] * len(sets)
            for i, s, k in zip(full, pack(m), band_keys(m).view(np.int64)):
                node[i], sig[i], bands[i] = hashlib.md5(sets[i].tobytes()).digest(), s.tobytes(), k
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(node, pa.binary()),
                 pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "row_key", "n_shingles", "node", "sig", "bands"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("row_key"), text_column().alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, row_key long, n_shingles long, node binary, sig binary, bands array<long>")


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def grouped(batches, n_key: int):
    """Whole groups of an input sorted by its first ``n_key`` columns, as Arrow tables."""
    held: list[pa.Table] = []
    last = None
    for b in batches:
        t = pa.Table.from_batches([b])
        keys = [t.column(i).to_numpy() for i in range(n_key)]
        if not len(t):
            continue
        change = np.zeros(len(t), bool)
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), len(t)]
        for s, e in zip(starts[:-1], starts[1:]):
            key = tuple(k[s] for k in keys)
            if key != last and held:
                yield pa.concat_tables(held)
                held = []
            held.append(t.slice(s, e - s))
            last = key
    if held:
        yield pa.concat_tables(held)


def _cells(members: DataFrame, blocks: str) -> DataFrame:
    """Rows of ``members`` once for every pair of blocks that theirs is in: own block ``mine``, pair ``i, j``."""
    own = members.withColumn("mine", F.pmod(F.xxhash64("node", F.lit(7)), F.col(blocks)).cast("int"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1)))
    return (other.withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))
            .drop("other", blocks))


def _sorted_cells(cells: DataFrame, group: str) -> DataFrame:
    return cells.repartition(group, "i", "j").sortWithinPartitions(group, "i", "j")


def _pairs(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Index ranges that a cell compares: all pairs of a block with itself, or one block with the other."""
    mine = t.column("mine").to_numpy()
    i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
    return (np.flatnonzero(mine == i), np.flatnonzero(mine == j))


def may_link(t: pa.Table, sig: np.ndarray, size: np.ndarray, percent: int):
    """Pairs (x, y, estimate) of a cell whose estimate and sizes allow a link."""
    left, right = _pairs(t)
    same = len(left) == len(right) and (left == right).all()
    least = slack(percent / 100)
    xs, ys, es = [], [], []
    step = max(1, 400_000 // max(len(right), 1))
    for s in range(0, len(left), step):
        a = left[s:s + step]
        e = estimate(sig[a][:, None, :], sig[right][None, :, :])
        lo, hi = np.minimum.outer(size[a], size[right]), np.maximum.outer(size[a], size[right])
        ok = (e >= least) & (100 * lo >= percent * hi)
        if same:
            ok &= a[:, None] < right[None, :]
        p, q = np.nonzero(ok)
        xs.append(a[p])
        ys.append(right[q])
        es.append(e[p, q])
    cat = np.concatenate
    return (cat(xs), cat(ys), cat(es)) if xs else (np.empty(0, int), np.empty(0, int), np.empty(0))


def _edges(pairs, nodes):
    return pa.RecordBatch.from_arrays([pa.array([nodes[x] for x, _ in pairs], pa.binary()),
                                       pa.array([nodes[y] for _, y in pairs], pa.binary())], ["a", "b"])


def _candidate_edges(cells: DataFrame, percent: int) -> DataFrame:
    def run(batches):
        for t in grouped(batches, 3):
            sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint64).reshape(len(t), -1)
            x, y, _ = may_link(t, sig, t.column("n_shingles").to_numpy(), percent)
            forest = Forest(len(t))
            kept = [(a, b) for a, b in zip(x.tolist(), y.tolist()) if forest.join(a, b)]
            if kept:
                yield _edges(kept, t.column("node").to_pylist())

    return cells.mapInArrow(run, "a binary, b binary")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on the full sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirmed_edges(cells: DataFrame, percent: int) -> DataFrame:
    def run(batches):
        for t in grouped(batches, 3):
            sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint64).reshape(len(t), -1)
            x, y, e = may_link(t, sig, t.column("n_shingles").to_numpy(), percent)
            order = np.argsort(-e, kind="stable")
            sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in t.column("members")]
            forest, kept = Forest(len(t)), []
            for a, b in zip(x[order].tolist(), y[order].tolist()):
                if forest.find(a) != forest.find(b) and linked(sets[a], sets[b], percent):
                    forest.join(a, b)
                    kept.append((a, b))
            if kept:
                yield _edges(kept, t.column("node").to_pylist())

    return cells.mapInArrow(run, "a binary, b binary")


def _full_sets(rows: DataFrame) -> DataFrame:
    """Full sets of the rows whose text has the wanted set."""

    def run(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            sets = [shingles(x) for x in t.column("text").to_pylist()]
            ok = [hashlib.md5(s.tobytes()).digest() == n for s, n in zip(sets, t.column("node").to_pylist())]
            out = t.drop_columns(["text"]).append_column("members", pa.array([s.tobytes() for s in sets], pa.binary()))
            yield from out.filter(pa.array(ok, pa.bool_())).to_batches()

    schema = rows.drop("text").schema.add("members", "binary")
    return rows.mapInArrow(run, schema)


def _salted(members: DataFrame) -> DataFrame:
    """Members with a salt, so that a component of any size is dealt to ``SALTS`` keys."""
    return members.withColumn("salt", F.pmod(F.xxhash64("node", F.lit(13)), F.lit(SALTS)).cast("int"))


def _every_salt(of_component: DataFrame) -> DataFrame:
    """A row per component once for each salt."""
    return of_component.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``doc_id, row_key, n_shingles, component_id, kept`` per row: documents are linked where
    ``100 * |intersection| >= percent * |union|``; a component is named by its smallest ``doc_id``."""
    rows = stored(signatures(docs), "minhash-rows")
    classes = stored(rows.where("node is not null").groupBy("node", "n_shingles", "sig", "bands")
                     .agg(F.min("doc_id").alias("rep"),
                          F.min(F.struct(row_id().alias(ROW_ID), F.col("row_key").alias(ROW_KEY))).alias("name")),
                     "minhash-classes")
    # Candidates: band buckets with two classes or more.
    banded = classes.select("node", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    members = banded.join(shared, "band").join(classes.select("node", "n_shingles", "sig"), "node")
    cells = _cells(members.withColumn("blocks", F.ceil(F.col("m") / BLOCK_MEMBERS)).drop("m"), "blocks")
    cells = _sorted_cells(cells, "band").select("band", "i", "j", "mine", "node", "n_shingles", "sig")
    candidates = components(_candidate_edges(cells, percent))
    # Confirmation on full sets, brought together by candidate component.
    placed = stored(candidates.join(classes.drop("bands"), "node"), "minhash-placed")
    # Only components of several blocks need their size; their members meet it by component and salt.
    sizes = (placed.groupBy("component").agg(F.sum("n_shingles").alias("total")).where(F.col("total") > BLOCK_SHINGLES)
             .select("component", F.ceil(F.col("total") / BLOCK_SHINGLES).alias("blocks")))
    placed = (_salted(placed).join(_every_salt(sizes), ["component", "salt"], "left")
              .select("node", "n_shingles", "sig", "name.*", F.xxhash64("component").alias("part"),
                      F.coalesce("blocks", F.lit(1)).cast("long").alias("blocks")))
    # One row of each class, by its name, as a row may lack an id; its repeats are dropped in the join's partitioning.
    texts = with_row_name(docs).select(ROW_ID, ROW_KEY, text_column().alias("text"))
    sets = _full_sets(texts.join(placed, [ROW_ID, ROW_KEY]).dropDuplicates([ROW_ID, ROW_KEY]).drop(ROW_ID, ROW_KEY))
    cells = _sorted_cells(_cells(sets, "blocks"), "part")
    cells = cells.select("part", "i", "j", "mine", "node", "n_shingles", "sig", "members")
    linked_nodes = components(_confirmed_edges(cells, percent))
    # Name components by their smallest document.
    least = (linked_nodes.join(classes.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("least")))
    # From a component to its members by salt; classes without a link take no part in that join.
    of_node = (_salted(linked_nodes).join(_every_salt(least), ["component", "salt"]).select("node", "least"))
    names = classes.select("node", "rep").join(of_node, "node", "left").select("node", F.coalesce("least", "rep").alias("component_id"))
    out = rows.select("doc_id", "row_key", "n_shingles", "node").join(names, "node", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "row_key", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each group of near-duplicates does."""
    found = near_duplicates(docs, percent).where("kept").select("doc_id", "row_key").distinct()
    # Repeated rows meet in the join's own partitioning, so dropping them moves no text again.
    return (with_row_name(docs).join(row_names(found), [ROW_ID, ROW_KEY]).dropDuplicates([ROW_ID, ROW_KEY])
            .select(docs.columns))
