"""Exact order statistics and buckets without sorting the rows.

NTILE, qcut on first-ranks and exact quantiles need only the rows at a few positions of an ordering.
``positions_of`` finds them by distributed multi-way selection, for several orderings of one table together:

1. a sample of the rows that can still hold a wanted position, chosen by a hash of their key, gives split points;
2. one aggregation counts the rows between neighbouring split points (a search tree of comparisons per row, partial
   counts per task, no shuffle of rows);
3. each position now lies between two neighbouring split points; repeat inside, until at most ``SMALL`` rows are
   left there, which are fetched and sorted.

Rows are ordered by (value, key), so rows that share a value, be it a third of all, are told apart by their unique key, and
no range of them stays together.  Every round divides what is left by the number of split points, so 10^9 rows take
four or five scans of the columns (value, key) and nothing is written.  The driver sees split points, counts, and at
most ``SMALL`` rows per position.

A bucket is then the number of edge rows that come before a row: comparisons with literals, in the scan that reads it.
Values and keys must not be NULL and keys must be unique; an empty table has no positions and no buckets.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPLITS = 64       # split points per ordering and round
LEAST = 8         # split points per range at least
SMALL = 2_000     # rows that are fetched for a position
_HASHES = 1 << 62


@dataclass(frozen=True)
class Ordering:
    """Rows by ``value`` (descending if ``down``), then by ``key`` ascending."""

    value: str
    key: str
    down: bool = False


def _pair(row, down: bool):
    """A row (value, key) as Python compares it."""
    return (-row[0] if down else row[0], row[1])


def _before_or_at(o: Ordering, edge) -> Column:
    """Whether a row comes before ``edge`` (value, key) in the ordering, or is it."""
    v, k = F.col(o.value), F.col(o.key)
    value, key = F.lit(edge[0]), F.lit(edge[1])
    return ((v > value) if o.down else (v < value)) | ((v == value) & (k <= key))


def _leaf(o: Ordering, splits: list, low: int, high: int) -> Column:
    """Number of split points that come strictly before a row, as a balanced tree of comparisons."""
    if low == high:
        return F.lit(low)
    mid = (low + high) // 2
    return F.when(_before_or_at(o, splits[mid]), _leaf(o, splits, low, mid)).otherwise(_leaf(o, splits, mid + 1, high))


def leaf_of(o: Ordering, splits: list) -> Column:
    """0 for rows up to the first split point, ..., ``len(splits)`` for rows after the last."""
    return _leaf(o, splits, 0, len(splits))


def _between(o: Ordering, low, high) -> Column:
    """Rows after ``low`` and up to ``high`` (None: no bound)."""
    out = F.lit(True)
    if low is not None:
        out = out & ~_before_or_at(o, low)
    if high is not None:
        out = out & _before_or_at(o, high)
    return out


def positions_of(df: DataFrame, wanted: dict[str, tuple[Ordering, list[int]]], n: int) -> dict[str, dict[int, tuple]]:
    """For each named ordering, the row (value, key) at each 1-based position of ``n`` rows.

    ``df`` is scanned a few times: store it if it is costly to make.
    """
    found: dict[str, dict[int, tuple]] = {name: {} for name in wanted}
    # What is left: for each ordering, disjoint ranges (low, high, rows before, rows inside, positions inside).
    left = {name: [(None, None, 0, n, sorted({p for p in places if 1 <= p <= n}))] for name, (_, places) in wanted.items()}
    left = {name: [r for r in ranges if r[4]] for name, ranges in left.items()}
    rounds = 0
    while any(left.values()):
        _fetch(df, wanted, left, found)
        left = {name: [r for r in ranges if r[3] > SMALL] for name, ranges in left.items()}
        if any(left.values()):
            rounds += 1
            left = _narrow(df, wanted, left, rounds)
    return found


def _fetch(df: DataFrame, wanted, left, found) -> None:
    """Rows of the small ranges, in one job."""
    parts = [(name, i, r) for name, ranges in left.items() for i, r in enumerate(ranges) if r[3] <= SMALL]
    if not parts:
        return
    rows: dict[tuple[str, int], list[tuple]] = {(name, i): [] for name, i, _ in parts}
    per = []
    for name in {name: None for name, _, _ in parts}:
        o = wanted[name][0]
        which = F.coalesce(*[F.when(_between(o, r[0], r[1]), F.lit(i)) for x, i, r in parts if x == name])
        per.append(F.struct(which.alias("i"), F.col(o.value).alias("v"), F.col(o.key).alias("k")).alias(name))
    names = list({name: None for name, _, _ in parts})
    got = df.select(*per)
    keep = F.lit(False)
    for name in names:
        keep = keep | F.col(f"`{name}`.i").isNotNull()
    for r in got.where(keep).collect():  # bounded: SMALL rows for each range
        for name in names:
            x = r[name]
            if x.i is not None:
                rows[name, x.i].append((x.v, x.k))
    for name, i, r in parts:
        o = wanted[name][0]
        own = sorted(rows[name, i], key=lambda x: _pair(x, o.down))
        for p in r[4]:
            found[name][p] = own[p - r[2] - 1]


def _narrow(df: DataFrame, wanted, left, seed: int):
    """Split the remaining ranges at sampled rows and keep the parts that hold a position.  Every round draws by
    another hash, so a range that a sample misses is split in a later round."""
    picks = []
    for name, ranges in left.items():
        if not ranges:
            continue
        o = wanted[name][0]
        # So many rows of each range in the sample that the ordering gets about SPLITS split points.
        chance = F.lit(None).cast("double")
        for low, high, _, inside, _ in ranges:
            chance = F.when(_between(o, low, high), F.lit(min(1.0, max(LEAST, SPLITS / len(ranges)) / inside))).otherwise(chance)
        draw = F.pmod(F.xxhash64(F.lit(f"{name} {seed}"), F.col(o.key)), F.lit(_HASHES)).cast("double") / float(_HASHES)
        picks.append((name, F.when(draw < chance, F.struct(F.col(o.value).alias("v"), F.col(o.key).alias("k")))))
    keep = F.lit(False)
    for name, c in picks:
        keep = keep | F.col(f"`{name}`").isNotNull()
    splits: dict[str, list] = {name: [] for name, _ in picks}
    for r in df.select(*[c.alias(name) for name, c in picks]).where(keep).collect():  # about SPLITS rows per ordering
        for name in splits:
            if r[name] is not None:
                splits[name].append((r[name].v, r[name].k))
    for name, own in splits.items():
        o = wanted[name][0]
        bounds = [b for low, high, *_ in left[name] for b in (low, high) if b is not None]
        splits[name] = sorted(set(own) | set(bounds), key=lambda x: _pair(x, o.down))
    leaves = F.array(*[F.struct(F.lit(name).alias("name"), leaf_of(wanted[name][0], s).alias("leaf")) for name, s in splits.items()])
    counts: dict[str, dict[int, int]] = {name: {} for name in splits}
    for r in df.select(F.inline(leaves)).groupBy("name", "leaf").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r["name"]][r["leaf"]] = r["n"]
    out = {name: [] for name in left}
    for name, own in splits.items():
        upto, total = [], 0
        for leaf in range(len(own) + 1):
            total += counts[name].get(leaf, 0)
            upto.append(total)
        held: dict[int, list[int]] = {}
        for p in (p for r in left[name] for p in r[4]):
            held.setdefault(bisect.bisect_left(upto, p), []).append(p)
        for leaf, places in sorted(held.items()):
            before = upto[leaf - 1] if leaf else 0
            out[name].append((own[leaf - 1] if leaf else None, own[leaf] if leaf < len(own) else None, before, upto[leaf] - before, places))
    return out


def ntile_ends(n: int, k: int) -> list[int]:
    """The last position of each NTILE(k) bucket of ``n`` rows but the last bucket."""
    return [i * (n // k) + min(i, n % k) for i in range(1, k)]


def qcut_ends(n: int, k: int) -> list[int]:
    """The last position of each bin of pandas' ``qcut(rank(method='first'), k)`` but the last bin."""
    return [i * (n - 1) // k + 1 for i in range(1, k)] if n else []


def bucket(o: Ordering, ends: list[int], rows: dict[int, tuple]) -> Column:
    """1-based bucket of a row whose buckets end at positions ``ends``; a position of 0 or from the last row on cuts nothing off."""
    edges = [rows[p] for p in ends if p in rows]
    skipped = sum(p < 1 for p in ends)
    return (leaf_of(o, edges) + F.lit(1 + skipped)).cast("bigint")


def with_buckets(df: DataFrame, wanted: dict[str, tuple[Ordering, int, str]]) -> DataFrame:
    """``df`` with a bucket column for each name: (ordering, number of buckets, ``ntile`` or ``qcut``)."""
    n = df.count()
    ends = {name: (ntile_ends if kind == "ntile" else qcut_ends)(n, k) for name, (_, k, kind) in wanted.items()}
    rows = positions_of(df, {name: (wanted[name][0], ends[name]) for name in wanted}, n)
    return df.withColumns({name: bucket(wanted[name][0], ends[name], rows[name]) for name in wanted})


def quantile_positions(n: int, probs: list[tuple[int, int]]) -> list[tuple[int, int, float]]:
    """For each probability num/den: the two 1-based positions that linear interpolation uses, and the weight of the second."""
    out = []
    for num, den in probs:
        whole, rest = divmod((n - 1) * num, den)
        out.append((whole + 1, min(whole + 2, n), rest / den))
    return out
