import zlib

import numpy as np
from cartwheel.llm import quality
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.score(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    unseen = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.quality for r in unseen]) > 0.97
    low, high = ([r.score for r in unseen if r.quality == q] for q in (0, 1))
    assert np.mean([a < b for a in low for b in high]) > 0.99
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_held_out_labels_do_not_matter(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1 "
                               "THEN 1 - quality ELSE quality END AS quality", "toxic")
    a, b = ({r.doc_id: r.score for r in quality.score(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_risk_is_non_negative_and_recovers_the_classes():
    rng = np.random.default_rng(0)
    n = quality.N_FEATURES
    good = lambda k: rng.normal(0.3, 0.1, (k, n)).astype(np.float32)
    bad = lambda k: rng.normal(0.0, 0.1, (k, n)).astype(np.float32)
    net = quality.fit(good(500), np.concatenate([good(700), bad(300)]), 0.7)
    assert (net.score(good(300)) > 0.5).mean() > 0.97 and (net.score(bad(300)) < 0.5).mean() > 0.97


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1, 0), (5, 0, 0), (9, 1, 1), (0, 1, 0), (None, 1, 0), (3, None, 0), (77, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality.score(odd_docs, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (0, 1)}) == 1 and len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
    kept = quality.keep_good(odd_docs, labels)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r.predicted for r in rows)
    none = labels.limit(0)
    assert {r.score for r in quality.score(odd_docs, none).collect()} == {0.5}
    assert quality.score(no_docs, labels).count() == 0 and quality.keep_good(no_docs, none).count() == 0
