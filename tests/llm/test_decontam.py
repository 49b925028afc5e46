from itertools import combinations

import numpy as np
import pytest

from cartwheel.llm import decontam
from tests.llm.conftest import ODD


def made(seed=2):
    rng = np.random.default_rng(seed)
    word = lambda: f"w{rng.integers(0, 20_000)}"
    items = [[word() for _ in range(int(n))] for n in rng.integers(15, 60, 30)] + [[word() for _ in range(6)], ["yes", "no"], []]
    docs, want = [], set()
    for d in range(200):
        text = [word() for _ in range(int(rng.integers(20, 400)))]
        if d % 3 == 0:
            k = int(rng.integers(0, 30))
            copy = list(items[k])
            for s in range(3, len(copy), int(rng.integers(7, 12))):  # a substitution every few words
                copy[s] = "other"
            at = int(rng.integers(0, len(text)))
            text[at:at] = copy
            want.add((d, k))
        docs.append((d, (" " if d % 2 else ", ").join(text).upper() if d % 5 == 0 else " ".join(text)))
    docs.append((900, " ".join(["a", *items[30], "b"])))
    docs.append((901, " ".join(["a", *items[30][:3], "x", *items[30][4:]])))
    docs.append((902, "yes no yes no"))
    docs.append((903, " ".join(items[0][:9] + items[1][:9])))  # too little of either
    want.add((900, 30))
    return docs, [(k, " ".join(w)) for k, w in enumerate(items)], want


@pytest.mark.parametrize("held", [decontam.BROADCAST_WORDS, 0])
def test_substitutions_are_found_either_way(spark, held):
    docs, items, want = made()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    b = spark.createDataFrame([*items, (None, "x"), (77, None)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(d, b, held).collect()}
    assert got == want


def test_both_ways_agree_on_all_columns(spark):
    docs, items, _ = made(9)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    a = sorted(map(tuple, decontam.leaks(d, b).collect()))
    assert a and a == sorted(map(tuple, decontam.leaks(d, b, 0).collect()))


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "The quick, brown fox jumps over the lazy dog and runs far away"), (2, "word"), (3, None)],
                                  "item_id long, text string")
    got = decontam.leaks(odd_docs, items)
    assert sorted((r.doc_id, r.item_id, r.n_matched) for r in got.collect()) == [(0, 1, 13), (1, 1, 13)]
    kept = decontam.clean(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == len(ODD) - 3
    own = spark.createDataFrame([(1, "a row without an id, mail me at a.b@c.de or call")], "item_id long, text string")
    for held in (decontam.BROADCAST_WORDS, 0):
        assert [tuple(r)[::2] for r in decontam.leaks(odd_docs, own, held).collect()] == [(None, 1, 14)]
    assert decontam.clean(odd_docs, own).count() == len(ODD) - 1
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.clean(odd_docs, none).count() == len(ODD)
    assert decontam.leaks(no_docs, items).count() == 0 and decontam.leaks(no_docs, items, 0).count() == 0


def test_masks_ignore_their_gaps():
    w = decontam.words("a b c d e f g h i j k l")
    v = decontam.words("a b X d e Y Z h i j k l")
    assert decontam.seeds(w, "110110011", 1)[0] == decontam.seeds(v, "110110011", 1)[0]
    assert decontam.seeds(w, "111111111", 1)[0] != decontam.seeds(v, "111111111", 1)[0]


def best_stretch(equal, least):
    """By the rule itself: the most equal words, four fifths of the stretch equal; the shortest, the first."""
    found = [(-sum(equal[a:z]), z - a, a) for a in range(len(equal)) for z in range(a + 1, len(equal) + 1)
             if 5 * sum(equal[a:z]) >= 4 * (z - a) and sum(equal[a:z]) >= least]
    return (-min(found)[0], *min(found)[1:]) if found else None


def test_overlap_is_the_best_stretch_of_the_rule():
    for n in (8, 10, 12, 14, 15, 16, 18, 20):
        item = np.arange(n, dtype=np.uint64)
        for k in (0, 1, 2, 3) if n < 20 else (3,):
            for places in combinations(range(n), k):
                w = item.copy()
                w[list(places)] = 99
                want = best_stretch((w == item).tolist(), min(12, -(-4 * n // 5)))
                assert decontam.overlap(w, item, 0) == want, (n, places)
    rng = np.random.default_rng(6)
    for _ in range(300):
        item = np.arange(60, dtype=np.uint64)
        w = np.where(rng.random(60) < rng.choice([0.1, 0.2, 0.3]), np.uint64(99), item)
        assert decontam.overlap(w, item, 0) == best_stretch((w == item).tolist(), 12)


def test_one_changed_word_of_fifteen_is_found(spark):
    docs = spark.createDataFrame([(1, "x a b c d e f g h i j k Z m n o y")], "doc_id long, text string")
    items = spark.createDataFrame([(5, "a b c d e f g h i j k l m n o")], "item_id long, text string")
    for held in (decontam.BROADCAST_WORDS, 0):
        assert [tuple(r)[2:] for r in decontam.leaks(docs, items, held).collect()] == [(5, 14, 15, 1)]


def test_every_placement_of_substitutions_is_found():
    for n in range(8, 19):
        item = [f"w{i}" for i in range(n)]
        found = decontam.SeedTable([(1, " ".join(item))])
        for k in range(4):
            for places in combinations(range(n), k):
                equal = [i not in places for i in range(n)]
                want = best_stretch(equal, min(12, -(-4 * n // 5)))
                text = " ".join(["a", *(x if e else "other" for x, e in zip(item, equal)), "b"])
                got = found.overlaps(decontam.words(text)).get(0)
                assert got == (want and (want[0], want[1], want[2] + 1)), (n, places)


@pytest.mark.parametrize("held", [decontam.BROADCAST_WORDS, 0])
def test_short_items_with_a_changed_word_are_found_either_way(spark, held):
    docs = spark.createDataFrame([(1, "x a b c Z e f g h y")], "doc_id long, text string")
    items = spark.createDataFrame([(5, "a b c d e f g h")], "item_id long, text string")
    assert [tuple(r)[2:] for r in decontam.leaks(docs, items, held).collect()] == [(5, 7, 8, 1)]
