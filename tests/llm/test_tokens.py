"""BPE codec (5) and ORC token files (4) against the tokenizers library."""

import hashlib
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cartwheel.llm import bpe, orc_tokens
from cartwheel.llm.common import whitespace_pieces
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def library(tokenizer_path):
    return Tokenizer.from_file(tokenizer_path)


@pytest.fixture(scope="module")
def codec(tokenizer_path):
    return bpe.Codec(bpe.read_spec(tokenizer_path))


TEXT = st.text(st.one_of(st.characters(max_codepoint=0x24F, blacklist_categories=("Cs",)),
                         st.characters(max_codepoint=0x2FFFF, blacklist_categories=("Cs", "Cn", "Co", "Lu", "Lt")),
                         st.sampled_from(list("aeinorst' .,"))), max_size=60)


def test_codec_equals_library(codec, library):
    @settings(max_examples=400, deadline=None)
    @given(TEXT)
    def check(text):
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text).tolist() == ids
        assert codec.decode(np.array(ids)) == library.decode(ids, skip_special_tokens=False)
    check()


def test_run_encoder_equals_library(tokenizer_path, library):
    enc = orc_tokens.RunEncoder(bpe.read_spec(tokenizer_path))

    @settings(max_examples=400, deadline=None)
    @given(TEXT)
    def check(text):
        assert enc.encode(text, 2).tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]
    check()


def test_greedy_is_not_enough(codec, library):
    """Words on which the longest match first differs from the merge rules need the way back."""
    words = [w.replace("</w>", "") for w in library.get_vocab() if w.isascii() and w.replace("</w>", "").isalpha()]
    rng = np.random.default_rng(0)
    back = 0
    for _ in range(3000):
        word = "".join(rng.choice(words, 3)).lower()
        ids = library.encode(word, add_special_tokens=False).ids
        assert codec.encode(word).tolist() == ids
        first = codec.scan
        back += codec.size[max(t for e, t in first.iter("".join(chr(0x100 + b) for b in word.encode()))
                               if e - codec.size[t] + 1 == 0)] != len(library.id_to_token(ids[0]).replace("</w>", ""))
    assert back


def test_caches_do_not_matter(codec, monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 2)
    codec.cache.clear()
    text = "many different words go through a very small cache, many different words"
    assert codec.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_round_trip_frame(odd_docs, no_docs, tokenizer_path, library):
    out = bpe.round_trip(odd_docs, tokenizer_path, keep_ids=True)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids)) for r in out.collect())
    want = []
    for i, t in ODD:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((str(i), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest(), tuple(ids)))
    assert got == sorted(want)
    assert bpe.round_trip(no_docs, tokenizer_path).count() == 0


def test_encode_then_decode_frames(odd_docs, tokenizer_path, library):
    back = bpe.decode(bpe.encode(odd_docs, tokenizer_path), tokenizer_path)
    want = [library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False) for _, t in ODD]
    assert sorted(r.text for r in back.collect()) == sorted(want)


def test_orc_files(spark, odd_docs, no_docs, tokenizer_path, library, tmp_path):
    path = f"file://{tmp_path}/tokens"
    docs = odd_docs.where("doc_id is not null")
    orc_tokens.write(docs, path, tokenizer_path, end_id=2)
    want = {}
    for i, t in ODD:
        if i is not None:
            want.setdefault(i, []).append([*library.encode(t or "", add_special_tokens=False).ids, 2])
    rows = orc_tokens.catalogue(spark, path).orderBy("start").collect()
    at = 0
    for r, (i, ids) in zip(rows, [(i, x) for i in sorted(want) for x in want[i]], strict=True):
        assert (r.doc_id, r.start, r.n_tokens) == (i, at, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    found = orc_tokens.lookup(spark, path, [5, 3])
    assert sorted((r.doc_id, len(r.ids)) for r in found.collect()) == [(3, 1), (5, len(want[5][0]))]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(doc_id" in plan
    empty = f"file://{tmp_path}/none"
    orc_tokens.write(no_docs, empty, tokenizer_path)
    assert orc_tokens.catalogue(spark, empty).count() == 0


def test_every_code_point_is_lower_cased_and_cut_as_in_the_library(codec, library):
    every = [*range(0xD800), *range(0xE000, 0x110000)]
    for k in range(0, len(every), 4096):
        texts = [f"a{chr(x)}b {chr(x)} {chr(x)}1" for x in every[k:k + 4096]]
        want = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
        assert [codec.encode(t).tolist() for t in texts] == want


def test_capitals_newer_than_python(codec, library):
    text = "\u1c89\ua7cb\ua7cc\ua7dc A\U00010d50\U00016ea0 Σ\ua7d2Σ x"
    assert codec.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_starts_of_unequal_texts_under_one_id(spark, tokenizer_path, tmp_path):
    """Rows of one id in several files: a start points at the row's own ids."""
    rows = [(7, "word " * k) for k in (8, 3, 2, 4, 1, 30, 5, 9)] * 30 + [(i, "other words") for i in (1, 3, 9, 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path = f"file://{tmp_path}/tokens"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        orc_tokens.write(docs, path, tokenizer_path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = orc_tokens.read(spark, path).collect()
    assert len({r.part for r in files if r.doc_id == 7}) > 1
    flat = np.concatenate([np.array(r.ids, "<u4") for r in sorted(files, key=lambda r: (r.part, r.place))])
    found = orc_tokens.catalogue(spark, path).collect()
    assert len(found) == len(rows) and len({r.start for r in found}) == len(rows)
    for r in found:
        assert zlib.crc32(flat[r.start:r.start + r.n_tokens].tobytes()) == r.ids_crc32
    assert [r.doc_id for r in sorted(found, key=lambda r: r.start)] == sorted(i for i, _ in rows)


def test_character_tables_are_built_without_a_list_of_all_characters():
    """Each worker builds them, so their memory counts once for every core."""
    tracemalloc.start()
    try:
        bpe._newer_unicode()
        bpe._lowered()
        assert tracemalloc.get_traced_memory()[1] < 16 << 20
    finally:
        tracemalloc.stop()


def test_texts_of_a_batch_are_encoded_together(tokenizer_path, library):
    """Each distinct run is looked up once for all texts; words of Latin-1 letters never take the whole pipeline."""
    enc = orc_tokens.RunEncoder(bpe.read_spec(tokenizer_path))
    texts = [t or "" for _, t in ODD] + [f"a{chr(x)}b {chr(x)} {chr(x)}1\x1c\x85é́." for x in range(0x3000)]
    ids, sizes = enc.encode_all(pa.array(["gone", *texts])[1:], 2)
    want = [[*e.ids, 2] for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert np.split(ids, np.cumsum(sizes)[:-1])[5].tolist() == want[5]
    assert sizes.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]
    words = ["ñandúes", "ÀÉÞ", "straße", "plain", "Øre"]
    want = [library.encode(w, add_special_tokens=False).ids for w in words]
    enc.library = None
    ids, sizes = enc.encode_all(pa.array([" ".join(words) + " ñandúes. plain"] * 3), 2)
    line = [i for x in [*want, want[0], enc.encode(".", 2).tolist()[:-1], want[3], [2]] for i in x]
    assert ids.tolist() == line * 3 and sizes.tolist() == [len(line)] * 3
    assert [len(x) for x in enc.encode_all(pa.array([], pa.string()), 2)] == [0, 0]


def test_distinct_runs_are_encoded_once(tokenizer_path, library, monkeypatch):
    """Backtracking runs once for each distinct run of some texts, however little is remembered."""
    codec = bpe.Codec(bpe.read_spec(tokenizer_path))
    monkeypatch.setattr(bpe, "CACHE_WORDS", 2)
    seen, tokens = [], codec.tokens
    monkeypatch.setattr(codec, "tokens", lambda word: seen.append(word) or tokens(word))
    words = [f"unusual{a}{b}ñ" for a in "abcdefgh" for b in "ijklmnop"]
    text = " ".join(words * 20)
    assert codec.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(seen) == len(words)


def test_pieces_of_texts_encoded_together(spark, tokenizer_path, codec, library, monkeypatch):
    texts = [t or "" for _, t in ODD] + [f" a{chr(x)}b {chr(x)}, it's{chr(x)}. Á x<|endoftext|>, <|A." for x in range(0, 0x3000, 7)]
    want = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    with monkeypatch.context() as m:
        m.setattr(bpe, "whitespace_pieces", lambda text: whitespace_pieces(text, 5))
        m.setattr(bpe, "GROUP", 100)
        got = [[] for _ in texts]
        for rows, ids, ends in codec.encode_texts([t[:1000] for t in texts[:9]] + texts[11:]):
            for row, a, z in zip(rows, ends, ends[1:]):
                got[row] += ids[a:z].tolist()
    kept = [library.encode(t[:1000], add_special_tokens=False).ids for t in texts[:9]]
    assert got[:len(texts) - 2] == kept + want[11:]
    long = "  " + "long text, " * 150_000  # of several pieces
    ids = library.encode(long, add_special_tokens=False).ids
    docs = spark.createDataFrame([(1, long), (2, long)], "doc_id long, text string").coalesce(1)
    for r in bpe.round_trip(docs, tokenizer_path, keep_ids=True).collect():
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
