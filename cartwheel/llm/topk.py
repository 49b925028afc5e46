"""Exact top-k inner products with a pivot table.

Components are made integers, ``floor(256 * x)``.  Every vector's distances to a fixed number of pivots
are computed once.  By the triangle inequality ``|d(q, p) - d(x, p)|`` is at most ``d(q, x)``, and
``q.x = (|q|^2 + |x|^2 - d(q, x)^2) / 2``, so the largest such difference over the pivots bounds the
score from above.  Candidates are evaluated in the order of their bounds, in growing steps, and a query
stops as soon as no bound left can reach its k-th best score.  The result is exact whatever the pivots.

Work is cut into cells of a block of queries and a block of candidates, each of at most about
``BLOCK_ROWS`` rows, so memory is bounded; blocks are formed by a hash and no key can be hot.

Vectors that are null or hold a null or non-finite component take no part.  Rows that share ``vec_id``
count as one (the smallest vector), or each for itself (``each_row``): then every row with a query's id is a query, and
all other rows are its candidates, also those of its own id.  Equal rows are searched once, with their number beside
them.  Vectors of unequal length are compared with zeros added.  With
fewer than k candidates all are returned; an empty table gives an empty result; ties go to the smaller
``vec_id``.  Scores must fit a 64-bit integer (components beyond 2^21 are evaluated with big integers).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import stored

PIVOTS = 16
BLOCK_ROWS = 1024
FIRST = 32  # candidates that a query evaluates before its first stopping test
LARGE = 1 << 21  # components beyond it: float64 sums may round


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", each_row: bool = False) -> DataFrame:
    """``id long, v array<long>, copies long``: usable vectors, one row per id, or per id and vector with the number of such rows."""
    x = F.col(vec_col)
    usable = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                                      & (F.abs(c.cast("double")) < float("inf")))
    found = (rows.where(usable & F.col(id_col).isNotNull())
             .select(F.col(id_col).cast("long").alias("id"),
                     F.transform(x, lambda c: F.floor(c.cast("double") * 256.0)).alias("v")))
    if each_row:
        return found.groupBy("id", "v").agg(F.count(F.lit(1)).alias("copies"))
    return found.groupBy("id").agg(F.min("v").alias("v")).withColumn("copies", F.lit(1).cast("long"))


def _pivot_table(vectors: DataFrame, pivots: np.ndarray, width: int) -> DataFrame:
    """``id``, ``row`` and ``copies``, and packed ``vec`` (float64 components) and ``dist`` (distances to the pivots)."""
    norms = (pivots * pivots).sum(1)

    def run(batches):
        for b in batches:
            lists = b.column(3).to_pylist()
            m = np.zeros((len(lists), width))
            for i, v in enumerate(lists):
                m[i, :len(v)] = v
            far = np.sqrt(np.maximum((m * m).sum(1)[:, None] + norms - 2 * (m @ pivots.T), 0))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array([r.tobytes() for r in m], pa.binary()), pa.array([r.tobytes() for r in far], pa.binary())],
                ["id", "row", "copies", "vec", "dist"])

    return vectors.select("id", "row", "copies", "v").mapInArrow(run, "id long, row long, copies long, vec binary, dist binary")


def search_block(qid, q, qd, cid, c, cd, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best ``k`` candidates of each query in one cell: query ids, candidate ids, scores."""
    i, j, s = best_pairs(q, qd, cid, c, cd, k, qid[:, None] == cid[None, :])
    return qid[i], cid[j], s


def best_pairs(q, qd, cid, c, cd, k: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``search_block``, by places in the cell; pairs that ``own`` marks are left out."""
    big = max(np.abs(q).max(initial=0), np.abs(c).max(initial=0)) > LARGE
    qn, cn = (q * q).sum(1), (c * c).sum(1)
    low = np.zeros((len(q), len(c)))
    for p in range(qd.shape[1]):
        np.maximum(low, np.abs(qd[:, p, None] - cd[None, :, p]), out=low)
    total = qn[:, None] + cn[None, :]
    bound = (total - low * low) / 2 + 1e-9 * total + 1  # rounding never hides a candidate
    if big:
        bound[:] = np.inf
    bound[own] = -np.inf  # the query's own row

    def scores(rows, cols):
        if big:
            return np.array([[sum(int(a) * int(b) for a, b in zip(q[i], c[j])) for j in js] for i, js in zip(rows, cols)], object)
        return np.einsum("ijd,id->ij", c[cols], q[rows])

    done = np.full((len(q), len(c)), None if big else -np.inf, object if big else float)
    reached = np.zeros((len(q), len(c)), bool)
    active, step, n = np.arange(len(q)), FIRST, len(c)
    while len(active):
        left = np.where(reached[active], -np.inf, bound[active])
        if step * 4 < n:
            cols = np.argpartition(-left, step - 1, axis=1)[:, :step]
            got = scores(active, cols)
            fine = np.isfinite(np.take_along_axis(left, cols, 1)) | (big & (np.take_along_axis(left, cols, 1) > 0))
            done[active[:, None], cols] = np.where(fine, got, done[active[:, None], cols])
            reached[active[:, None], cols] = True
        else:  # most bounds are still in play: the rest of the block at once
            fine = left > -np.inf
            got = scores(active, np.tile(np.arange(n), (len(active), 1))) if big else q[active] @ c.T
            done[active] = np.where(fine, got, done[active])
            reached[active] = True
        left = np.where(reached[active], -np.inf, bound[active])
        if n > k and not big:
            worst = -np.partition(-done[active], k - 1, axis=1)[:, k - 1]
        else:
            worst = np.full(len(active), -np.inf)
        active = active[(left.max(axis=1, initial=-np.inf) >= worst) & (left.max(axis=1, initial=-np.inf) > -np.inf)]
        step *= 4
    out_q, out_c, out_s = [], [], []
    for i in range(len(q)):
        seen = np.flatnonzero(reached[i] & (bound[i] > -np.inf))
        if len(seen) > 8 * k and not big:
            least = -np.partition(-done[i, seen], k - 1)[k - 1]
            seen = seen[done[i, seen] >= least]
        best = sorted(seen.tolist(), key=lambda j: (-done[i, j], cid[j]))[:k]
        out_q += [i] * len(best)
        out_c += best
        out_s += [int(done[i, j]) for j in best]
    return np.array(out_q, np.int64), np.array(out_c, np.int64), np.array(out_s, np.int64)


def top_k(rows: DataFrame, every: int = 50, k: int = 5, each_row: bool = False) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every``, the ``k``
    best other rows.  ``each_row``: rows that share an id do not count as one."""
    spark = rows.sparkSession
    vectors = stored(integer_vectors(rows, each_row=each_row).withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, width, n_q = vectors.agg(F.count(F.lit(1)), F.max(F.size("v")),
                                F.count(F.when(F.col("id") % every == 0, 1))).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not n_q:
        return spark.createDataFrame([], schema)
    # Distances to a pivot of large components would round by more than the bounds allow for.
    chosen = (vectors.where(F.forall("v", lambda c: c.between(-LARGE, LARGE)))
              .orderBy(F.xxhash64("id"), "id", "v").limit(PIVOTS).collect())
    pivots = np.zeros((len(chosen), width))
    for i, r in enumerate(chosen):
        pivots[i, :len(r.v)] = r.v
    base = stored(_pivot_table(vectors, pivots, width), "pivot-table")
    c_blocks, q_blocks = -(-n // BLOCK_ROWS), -(-n_q // BLOCK_ROWS)
    # Both sides' block numbers must be of one type: equal numbers of two types are dealt to different tasks.
    block = lambda m: F.pmod(F.xxhash64("id", "row"), F.lit(m)).cast("int")
    span = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    queries = base.where(F.col("id") % every == 0).withColumn("qb", block(q_blocks)).withColumn("cb", span(c_blocks))
    # New names for the other side's columns: Spark may take them for those of the queries.
    against = base.select(*[F.col(c).alias(f"c_{c}") for c in base.columns], block(c_blocks).alias("cb")).withColumn("qb", span(q_blocks))

    def unpack(col, w):
        return np.frombuffer(b"".join(col), np.float64).reshape(len(col), w)

    n_pivots = len(chosen)

    def cell(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        names = ["query", "query_id", "repeats", "vec_id", "times", "score"]
        if not len(q) or not len(c):
            return pd.DataFrame({n: [] for n in names}, dtype="int64")
        same, copies = q["row"].to_numpy()[:, None] == c["c_row"].to_numpy()[None, :], c["c_copies"].to_numpy()
        i, j, s = best_pairs(unpack(q["vec"], width), unpack(q["dist"], n_pivots), c["c_id"].to_numpy(),
                             unpack(c["c_vec"], width), unpack(c["c_dist"], n_pivots), k, same & (copies == 1))
        at = [q[n].to_numpy()[i] for n in ("row", "id", "copies")]
        return pd.DataFrame(dict(zip(names, [*at, c["c_id"].to_numpy()[j], copies[j] - same[i, j], s])))

    hits = (queries.groupBy("qb", "cb").cogroup(against.groupBy("qb", "cb"))
            .applyInPandas(cell, "query long, query_id long, repeats long, vec_id long, times long, score long"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    if not each_row:
        return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    # k different rows are enough; then each stands for its copies, and a query's list for those of the query.
    copies = lambda n: F.explode(F.sequence(F.lit(1).cast("long"), n))
    best = hits.withColumn("rank", rank).where(F.col("rank") <= k).withColumn("copy", copies(F.least("times", F.lit(k).cast("long"))))
    return (best.withColumn("rank", rank).where(F.col("rank") <= k).withColumn("copy", copies(F.col("repeats")))
            .select("query_id", "rank", "vec_id", "score"))
