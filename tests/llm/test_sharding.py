import zlib

import numpy as np

from cartwheel.llm import sharding
from tests.llm.conftest import ODD


def check_law(rows, shards):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_odd_rows(odd_docs, no_docs):
    rows = sharding.assign(odd_docs, 4).collect()
    check_law(rows, 4)
    want = sorted((str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in ODD)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in rows) == want
    assert sharding.assign(no_docs, 4).count() == 0


def test_groups_stay_whole_and_hot_groups_split(spark):
    rng = np.random.default_rng(1)
    texts = [f"text {i} " * int(rng.integers(1, 400)) for i in range(900)]
    rows = [(i, texts[i]) for i in range(900)] + [(1000 + i, texts[i % 40]) for i in range(160)] + [(5000 + i, "hot") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sharding.assign(docs, 24).collect()
    check_law(got, 24)
    text = dict(rows)
    where = {}
    for r in got:
        where.setdefault(text[r.doc_id], set()).add(r.shard)
    assert len(where.pop("hot")) == 24
    assert all(len(s) == 1 for s in where.values())
    load = np.bincount([r.shard for r in got], weights=[r["size"] for r in got])
    words = np.bincount([r.shard for r in got], weights=[r.tokens for r in got])
    assert load.max() / load.mean() < 1.08 and words.max() / words.mean() < 1.08


def test_groups_that_fit_nowhere_are_split(spark):
    rows = [(i, f"group {i // 30}") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_law(sharding.assign(docs, 24).collect(), 24)


def test_pack_follows_the_dot_product():
    dealt, unplaced = sharding.pack([(1, 10.0, 1.0, 1), (1, 1.0, 10.0, 1)], 2)
    assert unplaced == [0, 0] and dealt[0] != dealt[1]
