"""How far the sources of a language differ in their words, by ranked count cells.

A term is a run of letters ``A-Z a-z`` and non-ASCII characters, with ``A-Z`` lower-cased.  A language keeps the V
terms that at least ``MIN_DOCS`` of its documents hold.  A group (lang, source) with N occurrences of kept terms gives
a term that it holds ``count`` times the share p = 1 + floor(10^9 (count + 1) / (N + V)); the language gives q in the
same way.  The divergence of p from q is f = floor((p - q)^2 / q).  All arithmetic is exact.

* Terms of a group depend on (group count, language count) alone, so f is evaluated once per such *cell*.  Cells of
  equal value are merged, values are ranked by the cumulative number of their terms, and only the values that start
  within the first ``top`` ranks are expanded to terms, in UTF-8 order.
* For a pair of sources the terms also fall in cells.  With p0 the share of a term that a group lacks, the sum of f
  over all kept terms is V f(p0, q0), corrected by the cells of either group's own counts and by the terms
  that both hold; so its cost follows the terms that two sources share, not the vocabulary.

Tasks count the words of their own documents first; then one shuffle by (lang, term).  A row per kept term lists
the sources that hold it, and a language's sources are numbered in one task: both are bounded by the number of
sources of one language, whose square the result has anyway.  Nothing is collected on the driver.

Null text, lang and source are read as ''.  Every row is a document, repeated rows too.  Texts without terms give
groups without terms: all their counts are zero.  A language without kept terms gives pairs of value 0 and no term
rows; a language with one source gives no pairs; an empty table gives an empty result.  Equal values are ranked by the item's UTF-8 bytes.
Texts of over ``PIECE`` bytes are split into words piecewise.  Only ``text``, ``lang`` and ``source`` are read, so other columns may have any name.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import stored, text_column

MIN_DOCS, TOP, SCALE = 3, 200, 1_000_000_000
PIECE, HELD = 1 << 20, 300_000  # bytes split into words at a time; words that a task counts before it hands them on
OUTER = 1 << 20  # pairs that numpy evaluates at a time

#: Letters A-Z lower-cased, a-z and non-ASCII bytes kept, all else made a space.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: bytes):
    """The terms of a text, a list for each piece of it."""
    text = text.translate(_LETTERS)
    start = 0
    while len(text) - start > PIECE:
        cut = text.find(b" ", start + PIECE)
        if cut < 0:
            break
        yield text[start:cut].split()
        start = cut
    yield (text[start:] if start else text).split()


def _counted(batches):
    """Occurrences and documents of each (lang, source, term) of a task's rows."""
    count, docs, held = defaultdict(Counter), defaultdict(Counter), 0
    for b in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in b.columns)):
            own, own_docs = count[lang, source], docs[lang, source]
            held -= len(own)
            seen: set[bytes] = set()
            for part in words(text):
                own.update(part)
                seen.update(part)
            own_docs.update(seen)
            held += len(own)
            if held > HELD:
                yield from _rows(count, docs)
                count, docs, held = defaultdict(Counter), defaultdict(Counter), 0
    yield from _rows(count, docs)


def _rows(count, docs):
    for (lang, source), own in count.items():
        n = len(own)
        if n:
            within = docs[lang, source]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array(list(own), pa.binary()),
                pa.array(list(own.values()), pa.int64()), pa.array([within[w] for w in own], pa.int64())],
                ["lang", "source", "term", "c", "docs"])


def share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(SCALE (count + 1) / (n + v)) in exact arithmetic; 1 where there are no terms."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.when(n + v > 0, F.call_function("div", top, F.greatest(n + v, F.lit(1)).cast("decimal(20,0)")) + 1).otherwise(F.lit(1).cast("long"))


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _f(p, q):
    d = p - q
    return d * d // q


def kept_terms(docs: DataFrame) -> DataFrame:
    """``lang, term, c`` (occurrences), ``held`` (source and occurrences of each source): a row per kept term."""
    rows = docs.select(*(F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in ("lang", "source")),
                       text_column().cast("binary").alias("text"))
    found = rows.mapInArrow(_counted, "lang string, source string, term binary, c long, docs long")
    by_source = found.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("c").alias("c"), F.sum("docs").alias("docs"))
    return by_source.groupBy("lang", "term").agg(
        F.sum("c").alias("c"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "c")).alias("held")
    ).where(F.col("docs") >= MIN_DOCS).drop("docs")


def _groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``lang, source, no`` (number within the language), ``n, v, n_lang`` and ``p0``, the share of a term that the group lacks."""
    every = docs.select(*(F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in ("lang", "source"))).distinct()
    of_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("n_lang"))
    of_group = kept.select("lang", F.explode("held").alias("h")).groupBy("lang", F.col("h.source").alias("source")).agg(F.sum("h.c").alias("n"))
    zero = F.lit(0).cast("long")
    return (every.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
            .withColumns({k: F.coalesce(k, zero) for k in ("n", "v", "n_lang")})
            .withColumn("no", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long"))
            .withColumn("p0", share(zero, F.col("n"), F.col("v"))))


def _term_part(held: DataFrame, top: int) -> DataFrame:
    """The ``top`` terms of each group that it gives a larger share than its language does."""
    group = ["lang", "source"]
    cells = (held.groupBy(*group, "c", "c_lang", "n", "v", "n_lang").agg(F.count(F.lit(1)).alias("terms"))
             .withColumns({"p": share(F.col("c"), F.col("n"), F.col("v")), "q": share(F.col("c_lang"), F.col("n_lang"), F.col("v"))})
             .where(F.col("p") > F.col("q")).withColumn("value", divergence(F.col("p"), F.col("q"))))
    cells = stored(cells.select(*group, "c", "c_lang", "value", "terms"), "divergence-cells")
    down = Window.partitionBy(*group).orderBy(F.desc("value"))
    values = (cells.groupBy(*group, "value").agg(F.sum("terms").alias("terms"))
              .withColumn("place", F.row_number().over(down)).where(F.col("place") <= top)  # every value has a term
              .withColumn("before", F.coalesce(F.sum("terms").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .where(F.col("before") < top).select(*group, "value", "before"))
    chosen = cells.drop("terms").join(values, [*group, "value"])
    in_order = Window.partitionBy(*group, "value", "before").orderBy("term")
    return (held.select(*group, "term", "c", "c_lang").join(chosen, [*group, "c", "c_lang"])
            .withColumn("k", F.row_number().over(in_order)).where(F.col("k") <= top)
            .withColumn("rank", F.col("before") + F.col("k")).where(F.col("rank") <= top)
            .select(*group, F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value", F.col("rank").cast("int").alias("rank")))


_SUMS = "lang string, a long, b long, value long"


def _summed(lang: str, a: np.ndarray, b: np.ndarray, value: np.ndarray):
    """The values of each pair of numbered sources, added up."""
    off = a != b
    code, at = np.unique(a[off] << 32 | b[off], return_inverse=True)
    total = np.zeros(len(code), np.int64)
    np.add.at(total, at, value[off])
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(code), pa.string()), pa.array(code >> 32), pa.array(code & 0xFFFFFFFF),
                                       pa.array(total)], ["lang", "a", "b", "value"])


def _shared_terms(batches):
    """Corrections for the terms that both sources hold; rows: lang, numbers, shares, shares of a missing term."""
    for batch in batches:
        lang = np.array(batch.column(0).to_pylist(), object)
        size = np.diff(batch.column(1).offsets.to_numpy())
        begin = np.concatenate([[0], np.cumsum(size)])
        no, p, p0 = (batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in (1, 2, 3))
        for one in set(lang.tolist()):
            mine = lang == one
            for k in np.unique(size[mine]).tolist():
                if k < 2:
                    continue
                rows = begin[:-1][mine & (size == k)]
                wide = max(1, OUTER // k)  # left sides at a time
                left = np.repeat(rows, k) + np.tile(np.arange(k), len(rows))
                first = np.repeat(rows, k)
                for s in range(0, len(left), wide):
                    x = left[s:s + wide][:, None]
                    y = first[s:s + wide][:, None] + np.arange(k)
                    value = _f(p[x], p[y]) - _f(p[x], p0[y]) - _f(p0[x], p[y]) + _f(p0[x], p0[y])
                    yield _summed(one, np.broadcast_to(no[x], y.shape).ravel(), no[y].ravel(), value.ravel())


def _own_cells(batches):
    """What a group's cells add to its pairs, both ways; rows: lang, no, p, p0, terms, whether they are held, and the
    numbers and shares of a missing term of all sources of the language."""
    for batch in batches:
        lang, no, p, p0, terms, real, others, theirs = batch.columns
        lang = lang.to_pylist()
        cols = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in (no, p, p0, terms, real)]
        for i, one in enumerate(lang):
            g, pg, base, m, held = (int(c[i]) for c in cols)
            h, q0 = (np.asarray(x[i].values, np.int64) for x in (others, theirs))
            there = m * (_f(pg, q0) - held * _f(base, q0))
            back = held * m * (_f(q0, pg) - _f(q0, base))
            me = np.full(len(h), g)
            yield _summed(one, np.concatenate([me, h]), np.concatenate([h, me]), np.concatenate([there, back]))


def _pair_part(held: DataFrame, groups: DataFrame) -> DataFrame:
    """Every other source of the language, by the sum of f over all kept terms."""
    held = held.withColumn("p", share(F.col("c"), F.col("n"), F.col("v")))
    lists = held.groupBy("lang", "term").agg(F.collect_list(F.struct("no", "p", "p0")).alias("h")).where(F.size("h") > 1)
    both = lists.select("lang", "h.no", "h.p", "h.p0").mapInArrow(_shared_terms, _SUMS)
    cells = held.groupBy("lang", "no", "p", "p0").agg(F.count(F.lit(1)).alias("terms")).withColumn("real", F.lit(1))
    cells = cells.unionByName(groups.select("lang", "no", F.col("p0").alias("p"), "p0", F.col("v").alias("terms"), F.lit(0).alias("real")))
    of_lang = groups.groupBy("lang").agg(F.collect_list(F.struct("no", "p0")).alias("h")).select(
        "lang", F.col("h.no").alias("others"), F.col("h.p0").alias("theirs"))
    own = cells.join(of_lang, "lang").select("lang", "no", "p", "p0", "terms", "real", "others", "theirs").mapInArrow(_own_cells, _SUMS)
    sums = both.unionByName(own).groupBy("lang", "a", "b").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value"))
    names = groups.select("lang", "no", "source")
    down = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (sums.join(names.withColumnRenamed("no", "a"), ["lang", "a"])
            .join(names.select("lang", F.col("no").alias("b"), F.col("source").alias("item")), ["lang", "b"])
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(down).cast("int").alias("rank")))


def audit(docs: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: for each group its ``pair`` and ``term`` rows."""
    kept = stored(kept_terms(docs), "divergence-terms")
    groups = stored(_groups(docs, kept), "divergence-groups")
    held = (kept.select("lang", "term", F.col("c").alias("c_lang"), F.explode("held").alias("h"))
            .select("lang", "term", "c_lang", "h.source", "h.c").join(groups, ["lang", "source"]))
    return _pair_part(held, groups).unionByName(_term_part(held, top))
