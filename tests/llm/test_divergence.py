import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cartwheel.llm import divergence

TERM = re.compile("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, top=200):
    docs = [(l or "", s or "", TERM.findall((t or "").translate(LOWER))) for t, l, s in rows]
    held, count, of_lang = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for l, s, w in docs:
        held[l].update(set(w))
    kept = {l: {w for w, n in c.items() if n >= 3} for l, c in held.items()}
    for l, s, w in docs:
        count[l, s].update(x for x in w if x in kept[l])
        of_lang[l].update(x for x in w if x in kept[l])
    p = lambda c, n, v: 1 + 10**9 * (c + 1) // (n + v)
    out = set()
    for (l, s), own in count.items():
        v, n = len(kept[l]), sum(own.values())
        pairs, terms = [], []
        for (m, other), theirs in count.items():
            if m == l and other != s:
                n2 = sum(theirs.values())
                pairs.append((sum((p(own[w], n, v) - (q := p(theirs[w], n2, v))) ** 2 // q for w in kept[l]), other))
        for w, c in own.items():
            x, q = p(c, n, v), p(of_lang[l][w], sum(of_lang[l].values()), v)
            if c and x > q:
                terms.append(((x - q) ** 2 // q, w))
        for part, found in (("pair", pairs), ("term", terms)):
            found.sort(key=lambda f: (-f[0], f[1].encode()))
            out |= {(l, s, part, w, f, k) for k, (f, w) in enumerate(found, 1) if part == "pair" or k <= top}
    return out


def check(spark, rows, top=200):
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    df = df.withColumns({"term": F.lit(1), "value": F.lit("x"), "no": F.lit(2.0), "n": F.lit(0)}).repartition(3)
    got = divergence.audit(df, top).collect()
    assert len(got) == len({(r.lang, r.source, r.part, r.item) for r in got})
    assert {tuple(r) for r in got} == brute(rows, top)


ODD = [(None, "en", "a"), ("", "en", "b"), ("One two, TWO three3four", "en", "a"), ("one two three four", "en", "b"),
       ("one two three Ünï ünï", "en", None), ("one two ÜNÏ", "en", None), ("x ünï Ünï", "en", "c"), ("été", "", ""), ("9 8", None, None),
       ("solo solo", "fr", "s"), ("solo", "fr", "s"), ("solo 中文 😀", "fr", "s"), ("word " * 300_000, "en", "a"), ("word", "en", "b"), ("word", "en", "c"),
       ("one two", "en", "a"), ("one two", "en", "a"), ("\x00a\x7fb", "en", "z"), ("q" * 50_000, "en", "a")]


def test_odd_rows(spark):
    check(spark, ODD)


def test_no_rows(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


@pytest.mark.parametrize("top", [1, 3, 200])
def test_ties_are_cut_in_utf8_order(spark, top):
    """Many terms share a cell, and equal values come from several cells."""
    terms = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(60)] + ["é", "𐐷", "￮", "z"]
    rows = [(" ".join(terms), "en", s) for s in ("a", "b", "c")] + [(" ".join(terms[::2]), "en", "a"), (" ".join(terms[::3]), "en", "b")]
    check(spark, rows, top)


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("text", "lang", "source").collect()]
    assert {tuple(r) for r in divergence.audit(docs).collect()} == brute(rows)


def test_small_pieces_and_batches_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 5)
    monkeypatch.setattr(divergence, "HELD", 2)
    monkeypatch.setattr(divergence, "OUTER", 3)
    check(spark, ODD[:-1])


def test_a_source_with_a_third_of_all_rows_is_counted_before_the_shuffle(spark):
    rows = [("common words here", "en", "hot")] * 400 + [(f"common words {chr(97 + k % 26)}", "en", f"s{k % 5}") for k in range(300)]
    check(spark, rows)
