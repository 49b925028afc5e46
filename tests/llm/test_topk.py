import numpy as np
import pytest

from cartwheel.llm import topk


def brute(rows, every, k):
    vec = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = [int(np.floor(float(np.float32(x)) * 256)) for x in v]
        vec[i] = min(vec.get(i, q), q)
    out = []
    for q in (i for i in vec if i % every == 0):
        s = [(-sum(a * b for a, b in zip(vec[q], vec[c])), c) for c in vec if c != q]
        out += [(q, r, c, -v) for r, (v, c) in enumerate(sorted(s)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 64, 1024])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk, "FIRST", 4)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(60)]  # one common vector: ties
    rows += [(300, None), (301, [1.0, None, 2.0]), (302, [float("nan")] * 6), (303, [float("inf")] + [0.0] * 5), (None, [1.0] * 6),
             (304, []), (10, rows[10][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, 10, 5).collect())
    assert got == brute(rows, 10, 5)


def test_few_and_no_rows(spark):
    kind = "vec_id long, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], kind)).count() == 0
    two = spark.createDataFrame([(0, [1.0]), (7, [2.0])], kind)
    assert [tuple(r) for r in topk.top_k(two, 50, 5).collect()] == [(0, 1, 7, 256 * 512)]


def test_large_components_are_exact(spark):
    rows = [(i, [float((i + 1) * 2 ** 18), float(i)]) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, 5, 3).collect())
    assert got == brute(rows, 5, 3)


def test_bounds_do_prune():
    """Clustered vectors: candidates of far clusters are never evaluated."""
    rng = np.random.default_rng(0)
    c = np.round(np.concatenate([rng.normal(0, 5, (300, 8)) + 2000 * np.eye(8)[k % 8] for k in range(8)]))
    p = c[::200]
    far = lambda m: np.sqrt(((m[:, None] - p[None]) ** 2).sum(2))
    seen = []
    real = np.einsum
    np.einsum = lambda *a: seen.append(a[1].shape[0] * a[1].shape[1]) or real(*a)
    try:
        q, i, s = topk.search_block(np.arange(4), c[:4], far(c[:4]), np.arange(len(c)), c, far(c), 5)
    finally:
        np.einsum = real
    exact = c[:4] @ c.T
    exact[np.arange(4), np.arange(4)] = -np.inf
    assert sorted(s[q == 0].tolist(), reverse=True) == np.sort(exact[0])[::-1][:5].tolist()
    assert sum(seen) < 4 * len(c)


@pytest.mark.parametrize("block", [16, 1024])
def test_rows_that_share_an_id(spark, monkeypatch, tmp_path, block):
    """The query's contract: every row but the query's own is a candidate, whatever its id."""
    from cartwheel.llm.queries import QUERIES

    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(0, 400, 5)]
    rows += [(i, [3 * x for x in v]) for i, v in rows[:20]]  # other vectors under the same ids, of queries too
    rows += rows[3:6] + [rows[10], rows[85]] * 7             # equal rows: more than k, of queries too
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = [tuple(r) for r in QUERIES["op8_pivot_top_k"](spark, str(tmp_path)).collect()]
    vec = [(i, [int(np.floor(float(np.float32(x)) * 256)) for x in v]) for i, v in rows]
    wanted = []
    for a, (q, v) in enumerate(vec):
        if q % 50 == 0:
            s = sorted((-sum(x * y for x, y in zip(v, w)), c) for b, (c, w) in enumerate(vec) if a != b)
            wanted += [(q, r, c, -x) for r, (x, c) in enumerate(s[:5], 1)]
    assert sorted(got) == sorted(wanted)


def test_far_pivots_do_not_hide_candidates(spark, monkeypatch):
    """Rows of huge components are no pivots; cells without them are searched by bounds."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    monkeypatch.setattr(topk, "FIRST", 4)
    monkeypatch.setattr(topk, "PIVOTS", 1000)
    rng = np.random.default_rng(2)
    rows = [(i, [2 * float(rng.normal()) if i % 50 else 0.0, *(float(x) for x in rng.normal(size=3))]) for i in range(600)]
    rows += [(1001, [3e38, 0.0, 0.0, 0.0])]  # its score with any query is 0
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, 50, 5).collect())
    assert got == brute(rows, 50, 5)


def test_cells_meet_in_many_tasks(spark, monkeypatch):
    """Every cell's two sides are dealt to one task, also where small tasks are not joined to one."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "5")
        got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, 10, 5).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == brute(rows, 10, 5)
