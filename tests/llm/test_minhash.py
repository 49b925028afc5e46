import numpy as np
import pytest

from cartwheel.llm import minhash
from cartwheel.llm.components import components
from tests.llm.conftest import ODD


def shingle_set(text):
    w = (text or "").encode().lower().split()
    k = min(5, len(w))
    return {tuple(w[i:i + 5]) for i in range(len(w) - k + 1)} if w else set()


def brute(rows, percent):
    """Component of every row: rows are nodes."""
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= percent * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = d if least.get(r) is None else min(least[r], d if d is not None else least[r])
    return sorted((str(d), len(sets[i]), str(least[find(i)])) for i, (d, _) in enumerate(rows))


def chain(rng, n, edits):
    """Texts that drift away from the first: ends of the chain are not similar, neighbours are."""
    words = [f"w{i}" for i in rng.integers(0, 5000, 150)]
    out = []
    for _ in range(n):
        for _ in range(edits):
            words[int(rng.integers(len(words)))] = f"w{rng.integers(0, 5000)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("blocks", [(512, 400_000), (4, 600)])
def test_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", blocks[0])
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", blocks[1])
    rng = np.random.default_rng(5)
    texts = [t for k in range(6) for t in chain(rng, 15, 1 + k % 3)]
    texts += [" ".join(f"x{i}" for i in rng.integers(0, 300, 60)) for _ in range(60)]
    texts += texts[:10] * 2 + ["one two three", "one two three", "One Two THREE", "a b c d e f", ""] + [None]
    rows = [(int(i), t) for i, t in zip(rng.permutation(1000), texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = minhash.near_duplicates(docs, 85).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(rows, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_odd_rows(odd_docs, no_docs):
    got = minhash.near_duplicates(odd_docs.where("doc_id is not null"), 85)
    rows = [r for r in ODD if r[0] is not None]
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got.collect()) == brute(rows, 85)
    assert minhash.near_duplicates(odd_docs).count() == len(ODD)
    assert minhash.near_duplicates(no_docs).count() == 0
    kept = minhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["0", "2", "3", "4", "5", "7", "8", "9", "None"]
    assert minhash.keep_one(no_docs).count() == 0


def test_estimate_is_unbiased():
    rng = np.random.default_rng(0)
    for share in (0.2, 0.6, 0.9):
        found = []
        for _ in range(60):
            x = rng.integers(0, 2 ** 63, 1000).astype(np.uint64)
            both = int(1000 * 2 * share / (1 + share))
            a, b = np.unique(x[:both + (1000 - both) // 2]), np.unique(np.concatenate([x[:both], x[both + (1000 - both) // 2:]]))
            m = minhash.pack(minhash.minima([a, b]))
            exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            found.append(minhash.estimate(m[0], m[1]) - exact)
        assert abs(np.mean(found)) < 0.02 and np.std(found) < 0.06


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5001), (5001, 5002), (5002, 5000)]
    edges += [(7000, 7000)] + edges[:50]
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    got = {}
    for r in components(df).collect():
        got.setdefault(r.component, set()).add(r.node)
    assert sorted(map(len, got.values())) == [3, 200, 301]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_long_sets_are_cut_for_minima(monkeypatch):
    x = minhash.mix(np.arange(700_000, dtype=np.uint64))
    whole = minhash.minima([np.sort(x), x[:3]])
    assert (whole[0] == [np.min(x * a) for a in minhash._seeds()]).all()
    assert (whole[1] == [np.min(x[:3] * a) for a in minhash._seeds()]).all()


def test_near_copies_without_an_id(spark):
    a, b, c, d = chain(np.random.default_rng(8), 4, 1)
    rows = [(3, a), (None, b), (None, b), (8, c), (None, d), (None, "x " + " ".join(f"y{i}" for i in range(40)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = minhash.near_duplicates(docs, 85).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(rows, 85)
    assert sorted(str(r.doc_id) for r in minhash.keep_one(docs).collect()) == ["3", "None"]
