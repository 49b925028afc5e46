import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cartwheel.llm import paragraph_sketch as ps
from tests.llm.conftest import ODD


def like(a, b):
    x, y = Counter(ps.pieces(a)), Counter(ps.pieces(b))
    n = sum(x.values()) + sum(y.values())
    return 2 * sum((x & y).values()) / n if n else 1.0


def edit(t, following):
    return t[:len(t) - len(t) // 2] + following[:len(t) // 2]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab. \n!é", max_size=900))
def test_pieces_join_to_the_text(text):
    assert "".join(ps.pieces(text)) == text


def test_long_paragraphs_are_cut_beside_changes_only():
    words = [f"w{k * k % 977}" for k in range(400)]
    a, b = " ".join(words), " ".join([*words[:200], "new", *words[201:]])
    x, y = set(ps.pieces(a)), set(ps.pieces(b))
    assert len(x) > 20 and len(x ^ y) <= 6


@pytest.mark.parametrize("sizes", [(0, 0), (1, 0), (5, 5), (40, 3), (1000, 1000)])
def test_peeling_recovers_the_differing_digests(sizes):
    rng = np.random.default_rng(0)
    common, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (500, *sizes))
    cells = 3 * (20 + sum(sizes))
    owner, keys, sign, empty = (ps.sketches([np.concatenate([common, a])], cells) - ps.sketches([np.concatenate([common, b])], cells)).peel()
    assert empty.all()
    assert set(keys[sign == 1].tolist()) == set(a.tolist()) and set(keys[sign == -1].tolist()) == set(b.tolist())


def test_small_sketches_fail_and_are_made_larger():
    rng = np.random.default_rng(1)
    a = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (3, 0, 2000, 30)]
    b = [np.concatenate([x[:len(x) // 2], rng.integers(0, 2**63, k).astype(np.uint64)]) for x, k in zip(a, (1, 0, 500, 20))]
    only_a, only_b, used = ps.differences(a, b)
    assert only_a.tolist() == [2, 0, 1000, 15] and only_b.tolist() == [1, 0, 500, 20]
    assert used[0] == used[1] == ps.CELLS and used[2] >= 1500 and ps.CELLS < used[3] <= 200


def test_digests_are_compared_where_no_sketch_peels(monkeypatch):
    monkeypatch.setattr(ps, "MOST", 0)
    a, b = [np.arange(100, dtype=np.uint64)], [np.arange(50, 120, dtype=np.uint64)]
    only_a, only_b, used = ps.differences(a, b, cells=24)
    assert (only_a.tolist(), only_b.tolist(), used.tolist()) == ([50], [20], [0])


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    out = {}
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        e = edit(t, following)
        out[i] = (len(t), hashlib.sha256(e.encode()).hexdigest(), *ps.written([ps.digests(t), ps.digests(e)]), like(t, e), like(t, following))
    return out


def test_odd_rows(spark, odd_docs):
    rows = [(i, t or "") for i, t in ODD]
    want = brute(rows)
    got = ps.fingerprints(odd_docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    for r in got:
        if r.doc_id == 1:  # a repeated row: the first of them is followed by the same text, the other by the next document
            continue
        n, sha, own, edited, near_edited, near_next = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (n, sha, own, edited)
        assert (r.near_edited, r.near_next) == pytest.approx((near_edited, near_next))
    assert sorted(r.near_next for r in got if r.doc_id == 1) == [0.0, 1.0]


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_real_documents_over_any_number_of_ranges(spark, parts):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([(r.doc_id, r.text or "") for r in docs.collect()])
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r.doc_id: r for r in ps.fingerprints(docs.repartition(5)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(got) == len(want)
    for i, (n, sha, own, edited, near_edited, near_next) in want.items():
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (n, sha, own, edited)
        assert (r.near_edited, r.near_next) == pytest.approx((near_edited, near_next))


def test_one_row_follows_itself_and_no_rows(spark, no_docs):
    one = ps.fingerprints(spark.createDataFrame([(5, "ab. cd. ef.")], "doc_id long, text string")).collect()
    assert [(r.n_chars, r.near_next) for r in one] == [(11, 1.0)]
    assert one[0].edited_sha256 == hashlib.sha256(edit("ab. cd. ef.", "ab. cd. ef.").encode()).hexdigest()
    assert ps.fingerprints(no_docs).count() == 0


def test_equal_texts_have_equal_fingerprints_and_a_changed_paragraph_another():
    a, b = ps.digests("One. Two. Two. Three."), ps.digests("One. Two. Three.")
    assert ps.written([a]) == ps.written([ps.digests("One. Two. Two. Three.")])
    assert ps.written([a]) != ps.written([b])
    assert ps.differences([a], [b])[:2] == (1, 0)
