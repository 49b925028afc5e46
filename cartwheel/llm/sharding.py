"""Shards by vector bin packing.

Documents with equal texts form a group; a group's vector is its bytes, tokens and rows.  Shards
have capacity vectors that add up to the corpus: equal bytes, equal tokens, and row counts at most
one apart.  A group goes to the shard where the dot product of its vector with the residual capacity
is highest, among the shards that still have room for its rows, so the row law holds exactly while
bytes and tokens are balanced as well as the groups allow.

At scale groups are not placed one by one on the driver.  Groups whose rows are equal and whose bytes
and tokens fall in the same narrow logarithmic bucket are of one *type* (a bounded number of types,
however many groups).  The driver sees one count per type: whole rounds of a type are dealt to all
shards alike, and only the rest (fewer than the number of shards) is placed by dot product.  Groups of a
type are then numbered in parallel and take the shard that owns their number.

A group with more than ``WHOLE_ROWS`` rows, or one that fits nowhere whole, is split into single rows,
which are placed like other single rows.  Null texts count as empty; repeated rows are rows of one
group; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import stored, text_column

WHOLE_ROWS = 64        # larger groups are split into rows
BUCKET_RATIO = 1.1     # bytes (and tokens) within a type differ by less than this factor
ROWS_PER_SALT = 50_000  # rows that one task numbers


def pack(types: list[tuple[int, float, float, int]], shards: int) -> tuple[list[list[int]], list[int]]:
    """Deal groups of each type (rows, mean bytes and tokens of a group, number of groups) to shards.

    Returns, for each type, how many of its groups each shard takes, and for each type how many of
    its groups found no shard with room for all their rows.  Single-row types must come after all
    others; single rows always find room."""
    n_rows = sum(r * n for r, _, _, n in types)
    cap = np.array([max(sum(b * n for _, b, _, n in types), 1) / shards,
                    max(sum(t * n for _, _, t, n in types), 1) / shards, max(n_rows, 1) / shards])
    rows = np.array([n_rows // shards + (s < n_rows % shards) for s in range(shards)], np.int64)
    left = np.tile(cap, (shards, 1))
    dealt, unplaced = [], []
    for r, size, tokens, n in types:
        item = np.array([size, tokens, r], float)
        took = np.zeros(shards, np.int64)
        while n:
            room = rows // r
            open_ = room > 0
            if not open_.any():
                break
            each = min(n // int(open_.sum()), int(room[open_].min()))
            take = np.where(open_, each, 0)
            if each == 0:
                gain = np.where(open_, (left / cap) @ (item / cap), -np.inf)
                take = np.zeros(shards, np.int64)
                take[int(gain.argmax())] = 1
            took += take
            rows -= take * r
            left -= take[:, None] * item
            n -= int(take.sum())
        dealt.append(took.tolist())
        unplaced.append(n)
    return dealt, unplaced


def _bucket(value: Column) -> Column:
    return F.floor(F.log(value + 1.0) / math.log(BUCKET_RATIO)).cast("int")


def _salts(rows: int) -> int:
    return 16 + rows // ROWS_PER_SALT


def _numbered(df: DataFrame, key: str, order: list[str], salts: int, out: str) -> DataFrame:
    """Number rows 0, 1, ... within ``key`` without gathering a key's rows in one task: each salt's rows
    are numbered alone and start after those of the salts before it."""
    salted = df.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    counts = salted.groupBy(key, "salt").agg(F.count(F.lit(1)).alias("in_salt"))
    first = counts.select(key, "salt", (F.sum("in_salt").over(Window.partitionBy(key).orderBy("salt"))
                                        - F.col("in_salt")).alias("first"))
    inside = F.row_number().over(Window.partitionBy(key, "salt").orderBy(*order)) - 1
    return (salted.withColumn("inside", inside).join(first, [key, "salt"])
            .withColumn(out, F.col("first") + F.col("inside")).drop("salt", "inside", "first"))


def _owner(df: DataFrame, ends: DataFrame, number: str) -> DataFrame:
    """Shard that owns each row's number within its type: how many shards end at or before it."""
    return (df.join(F.broadcast(ends), "type", "left")  # one row per type: bounded by the bucket grid
            .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col(number)))).drop("ends"))


def assign(docs: DataFrame, shards: int = 24) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, tokens``, one row per input row.

    The law is ``rows``: shard counts are at most one apart.  ``slot`` numbers a shard's rows from 0
    without gaps; ``grown_shard`` is null (only a keyed law defines it)."""
    spark = docs.sparkSession
    text = text_column()
    rows = stored(docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.regexp_count(text, F.lit(r"[^ \t\n\r\x0B\f]+")).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text)).alias("digest")), "shard-rows")
    types = lambda df, r: df.withColumn(
        "type", (r.cast("long") * 1_000_000 + _bucket(F.col("size")) * 1000 + _bucket(F.col("tokens"))))
    groups = rows.groupBy("digest", "size", "tokens").agg(F.count(F.lit(1)).alias("n"))
    groups = stored(types(groups.withColumn("whole", F.col("n") <= WHOLE_ROWS),
                          F.when(F.col("n") <= WHOLE_ROWS, F.col("n")).otherwise(1)), "shard-groups")
    found = (groups.groupBy("type", "whole")
             .agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("n"),
                  F.sum(F.col("size") * F.col("n")).alias("size"), F.sum(F.col("tokens") * F.col("n")).alias("tokens"))
             .collect())
    n_rows = sum(t.n for t in found)
    if not n_rows:
        return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.lit(0).alias("shard"),
                           F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "tokens")

    # Whole groups of several rows first, largest first; then single rows, those of split groups included.
    several = sorted((t for t in found if t.whole and t.type >= 2_000_000), key=lambda t: (-t.size / t.groups, t.type))
    dealt, unplaced = pack([(t.type // 1_000_000, t.size / t.groups, t.tokens / t.groups, t.groups) for t in several]
                           + _singles(found, [], [])[1], shards)
    singles, vectors = _singles(found, several, unplaced)
    if any(unplaced[:len(several)]):  # groups that fit nowhere whole go on as single rows
        dealt, _ = pack([(t.type // 1_000_000, t.size / t.groups, t.tokens / t.groups, t.groups - u)
                         for t, u in zip(several, unplaced)] + vectors, shards)
    ends = spark.createDataFrame(
        [(int(k), np.cumsum(d).tolist()) for k, d in zip([t.type for t in several] + singles, dealt)],
        "type long, ends array<long>")

    salts = _salts(n_rows)
    placed = _owner(_numbered(groups.where("whole"), "type", ["digest"], salts, "number"), ends, "number")
    placed = placed.select("digest", F.when(F.col("shard") < shards, F.col("shard")).alias("shard"))
    known = stored(rows.join(placed, "digest", "left"), "shard-known")
    # Rows of split groups take the numbers after those of the single-row groups of their type.
    before = groups.where("whole and n = 1").groupBy("type").agg(F.count(F.lit(1)).alias("before"))
    split = _numbered(types(known.where("shard is null").drop("shard"), F.lit(1)), "type", ["doc_id", "digest"], salts,
                      "number")
    split = split.join(before, "type", "left").withColumn("number", F.col("number") + F.coalesce("before", F.lit(0)))
    split = _owner(split, ends, "number")
    cols = ["doc_id", "size", "tokens", "text_crc32", "shard"]
    every = stored(known.where("shard is not null").select(cols).unionByName(split.select(cols)), "shard-placed")
    return (_numbered(every, "shard", ["doc_id", "text_crc32"], 8 + n_rows // shards // ROWS_PER_SALT, "slot")
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int"),
                    F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"), "tokens"))


def _singles(found, several, unplaced) -> tuple[list[int], list[tuple[int, float, float, int]]]:
    """Single-row types and their vectors: single-row groups, rows of large groups, and rows of the
    ``unplaced`` groups of the types in ``several``."""
    total: dict[int, list[float]] = {}
    for t in found:
        if t.type < 2_000_000:
            add = total.setdefault(t.type, [0, 0.0, 0.0])
            add[0] += t.n
            add[1] += t.size
            add[2] += t.tokens
    for t, u in zip(several, unplaced):
        if u:
            r = t.type // 1_000_000
            add = total.setdefault(1_000_000 + t.type % 1_000_000, [0, 0.0, 0.0])
            add[0] += u * r
            add[1] += t.size / t.groups * u
            add[2] += t.tokens / t.groups * u
    keys = sorted(total, key=lambda k: (-total[k][1] / total[k][0], k))
    return keys, [(1, total[k][1] / total[k][0], total[k][2] / total[k][0], int(total[k][0])) for k in keys]
