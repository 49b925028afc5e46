import hashlib
import re

import duckdb
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from cartwheel.llm.queries import QUERIES, SQL
from tests.llm.test_minhash import shingle_set
from tests.llm.test_pii import base

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tokenizer_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF).cache()
        at[name] = docs
        if name != "tokens":
            assert docs.columns == before.columns
    text = {n: {r.doc_id: r.text for r in f.select("doc_id", "text").collect()} for n, f in at.items() if n != "tokens"}

    # Quality: labelled good documents stay, labelled junk goes (a few of the 87 labels may be missed).
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert sum((i in text["quality"]) != (q == 1) for i, q in quality.items()) <= 4
    assert all(text["documents"][i] == t for i, t in text["quality"].items())

    # Near-duplicates: the smallest id of every component stays.
    sets = {i: shingle_set(t) for i, t in text["quality"].items()}
    near = lambda a, b: a and b and 100 * len(a & b) >= 85 * len(a | b)
    up = {i: i for i in sets}
    for _ in range(len(sets)):
        new = {i: min([up[j] for j in sets if i == j or near(sets[i], sets[j])]) for i in sets}
        if new == up:
            break
        up = new
    assert set(text["near_duplicates"]) == {i for i in sets if up[i] == i}

    # Decontamination: no document holds an item word for word any more; others stay.
    plain = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    items = [plain(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaky = {i for i, t in text["near_duplicates"].items() if any(x in plain(t) for x in items)}
    assert set(text["decontamination"]) == set(text["near_duplicates"]) - leaky

    # Personal data: same rows, base spans replaced.
    assert set(text["personal_data"]) == set(text["decontamination"])
    for i, t in text["decontamination"].items():
        if not re.search("[0-9@]", t):
            assert text["personal_data"][i] == t
        assert not base(text["personal_data"][i])

    # Tokens: as the library encodes and decodes.
    library = Tokenizer.from_file(tokenizer_path)
    rows = docs.collect()
    assert {r.doc_id for r in rows} == set(text["personal_data"])
    for r in rows:
        ids = library.encode(text["personal_data"][r.doc_id], add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, list(r.ids)) == (len(ids), ids)
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_empty_documents_table(spark, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"file://{tmp_path}/{name}.parquet")
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"file://{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(SQL[name])
    cols = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(want.fetchall())


def test_all_are_registered():
    names = set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= names
    assert set(SQL) <= set(__spark_entry__.oracle_sql())
