import math
import pickle
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cartwheel.llm import lm
from tests.llm.conftest import ODD


def words(text):
    return [*(text or "").encode().lower().split(), b"<end>"]


def base(rows):
    count = Counter(w for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 10 for w in words(t))
    n, v = sum(count.values()), len(count)
    return {i: (zlib.crc32(str(i).encode()) % 10 == 0 if i is not None else False, len(words(t)),
                sum(count[w] > 0 for w in words(t)), n,
                sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(t))) for i, t in rows}


@pytest.mark.parametrize("known", [lm.KNOWN, 3, 0])
def test_counts_and_base_score(odd_docs, monkeypatch, known):
    monkeypatch.setattr(lm, "KNOWN", known)
    want = base(ODD)
    got = lm.score(odd_docs).collect()
    assert len(got) == len(ODD)
    for r in got:
        h, n, k, total, b = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, k, total)
        assert r.base_score == pytest.approx(b, rel=1e-9)
        assert r.score < 0 and math.isfinite(r.score)


def test_no_rows(no_docs):
    assert lm.score(no_docs).count() == 0


def small(monkeypatch):
    for name, value in dict(HEAD=12, MEMBERS=4, TAIL=3, HIDDEN=5, CLASSES=6, WINDOW=4).items():
        monkeypatch.setattr(lm, name, value)
    rng = np.random.default_rng(1)
    p = lm.initial(np.zeros(6), np.zeros((3, 4)))
    p = {k: rng.normal(0, 0.4, v.shape) for k, v in p.items()}
    return p, [rng.integers(0, 15, n).astype(np.int32) for n in (1, 9, 14, 3, 22)]


def by_hand(p, doc):
    """Log-likelihood of one document, token by token."""
    h, before, total = np.zeros(5), 0, 0.0
    sig = lambda x: 1 / (1 + np.exp(-x))
    for t in doc.tolist():
        a, b = p["x"][before], h @ p["u"]
        z, r = sig(a[:5] + b[:5]), sig(a[5:10] + b[5:10])
        g = np.tanh(a[10:] + r * b[10:])
        h = (1 - z) * g + z * h
        cls = t // 4 if t < 12 else 3 + t - 12
        e = np.exp(h @ p["cw"] + p["cb"])
        total += math.log(e[cls] / e.sum())
        if t < 12:
            e = np.exp(h @ p["mw"][cls] + p["mb"][cls])
            total += math.log(e[t % 4] / e.sum())
        before = t
    return total


def test_state_is_carried_through_whole_documents(monkeypatch):
    p, docs = small(monkeypatch)
    for most in (1, 2, 1024):
        monkeypatch.setattr(lm, "SCORE_LANES", most)
        assert lm.score_batch(p, docs) == pytest.approx([by_hand(p, d) for d in docs], rel=1e-5)


def test_gradients(monkeypatch):
    """One window long enough for all documents: the step's gradient is that of the log-likelihood."""
    p, docs = small(monkeypatch)
    monkeypatch.setattr(lm, "WINDOW", 64)
    taken = {}
    monkeypatch.setattr(lm, "_step", lambda p, grads, n, state: taken.update(grads))
    lm.train_batch(p, docs, None)
    rng = np.random.default_rng(2)
    for k, v in p.items():
        for _ in range(12):
            at = tuple(int(rng.integers(n)) for n in v.shape)
            old, eps, got = v[at], 1e-4, []
            for d in (eps, -eps):
                v[at] = old + d
                got.append(sum(by_hand(p, x) for x in docs))
            v[at] = old
            assert taken[k][at] == pytest.approx((got[0] - got[1]) / (2 * eps), rel=2e-3, abs=2e-3), k


def test_probabilities_add_up(monkeypatch):
    p, _ = small(monkeypatch)
    h = np.random.default_rng(0).normal(0, 1, (1, 5))
    one = lambda t: math.exp(lm.output(p, h, np.array([t]))[0][0])
    assert sum(one(t) for t in range(15)) == pytest.approx(1, rel=1e-6)


def test_beats_the_base_on_unseen_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in lm.score(docs).collect() if r.held_out]
    assert sum(r.score for r in rows) > 0.95 * sum(r.base_score for r in rows)


def test_averaging_is_weighted():
    import pickle
    a, b = (pickle.dumps((n, {"x": np.full(2, v, np.float32)})) for n, v in ((1, 0.0), (3, 4.0)))
    assert pickle.loads(lm._average([a, b]))[1]["x"].tolist() == [3.0, 3.0]


def test_training_carries_the_state_through_long_documents(monkeypatch):
    p, _ = small(monkeypatch)
    empty, gates = [], lm._gates
    monkeypatch.setattr(lm, "_gates", lambda p, before, h: (empty.append(not h.any()), gates(p, before, h))[1])
    monkeypatch.setattr(lm, "_step", lambda *_: None)
    lm.train_batch(p, [np.random.default_rng(3).integers(0, 15, 2500).astype(np.int32)], None)
    assert empty == [True] + [False] * 2499


def test_words_to_rank_2047_have_a_head_row_and_training_takes_four_rounds():
    known = {lm.END: 10_000} | {b"w%d" % i: 9000 - i for i in range(3000)}
    head = lm.Vocabulary(known, sum(known.values()), len(known)).head
    assert [head.get(b"w%d" % i) for i in (0, 1023, 2046, 2047)] == [1, 1024, 2047, None]
    assert len(lm.ROUNDS) == 4 and sum(lm.ROUNDS) == pytest.approx(1)


def test_scores_do_not_depend_on_how_many_words_the_tasks_know(spark, monkeypatch):
    """Few documents of many words that are all more frequent than the end sign."""
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{k}" for k in rng.permutation(np.repeat(np.arange(60), 1 + np.arange(60) % 7)))) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(lm, "HEAD", 64)
    monkeypatch.setattr(lm, "CLASSES", 1 + lm.TAIL)

    def scores(known):
        monkeypatch.setattr(lm, "KNOWN", known)
        return {r.doc_id: (r.n_known, r.base_score, r.score) for r in lm.score(docs).collect()}

    want = scores(200_000)
    for known in (20, 0):
        got = scores(known)
        assert all(got[i] == pytest.approx(want[i], rel=1e-6) for i in want)


def test_without_training_documents_the_end_sign_is_scored_once(spark):
    held_out = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows = lm.score(spark.createDataFrame([(held_out, "")], "doc_id long, text string")).collect()
    assert [(r.n_tokens, r.n_known, r.base_score) for r in rows] == [(1, 0, 0.0)]
    assert rows[0].score == pytest.approx(-math.log10(lm.HEAD + lm.TAIL), rel=1e-5)


def test_words_are_cut_and_packed_as_columns(spark, odd_docs):
    """As by the plain split, also in a slice; a pack's tokens are its words by number, each text with its end sign."""
    texts = [" a\x1cb  C\tD\n", "", " \t", "x\x0bÄ É\x85z\x1f İ " + "".join(map(chr, range(1, 300))), "A"]
    for part in (pa.array(texts), pa.array(["gone", *texts])[1:], pa.array(texts, pa.large_string())):
        got, n = lm.cut(part)
        want = [t.encode().lower().split() for t in texts]
        assert (got.to_pylist(), n.tolist()) == ([w for x in want for w in x], [len(x) for x in want])
    found = []
    for r in lm.packed(odd_docs).collect():
        ids = np.frombuffer(r.ids, lm._width(len(r.words)))
        assert np.bincount(ids, minlength=len(r.words)).tolist() == r.n
        of = np.split([bytes(r.words[i]) for i in ids], np.cumsum(r.lens)[:-1])
        found += [(str(d), x.tolist()) for d, x in zip(r.docs, of, strict=True)]
    assert sorted(found) == sorted((str(i), [*(t or "").encode().lower().split(), lm.END]) for i, t in ODD)


def test_tasks_get_tables_without_a_dict_of_words():
    known = {lm.END: 9} | {b"w%d" % i: 5 for i in range(3000)}
    vocab = lm.Vocabulary(known, sum(known.values()), len(known))
    vocab.finish()
    sent = pickle.loads(pickle.dumps(vocab))
    assert not any(isinstance(v, dict) for v in vars(sent).values())
    own = pa.array([b"none", b"w0", lm.END, b"w2999", "zä".encode()], pa.binary())[1:]
    assert sent.numbers(own).tolist() == [1, 0, 3000, -1]
    want = [vocab.head[b"w0"], 0, lm.HEAD + ord("9") % lm.TAIL, lm.HEAD + "zä".encode()[-1] % lm.TAIL]
    assert sent.rows(own, sent.numbers(own)).tolist() == want
