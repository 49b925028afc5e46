import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.llm import alignment
from tests.llm.conftest import ODD

public_tokenizers = pytest.importorskip("public_tokenizers")
A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def byte_map():
    """The byte-level alphabet, by the rule that printable bytes stand for themselves."""
    import string
    own = [b for b in range(256) if (chr(b) in string.printable and b > 32 and b < 127) or 0xA1 <= b <= 0xAC or b >= 0xAE]
    rest = iter(range(256, 512))
    return {(chr(b) if b in own else chr(next(rest))): b for b in range(256)}


def brute(rows):
    import sentencepiece
    from tokenizers import Tokenizer
    ta, tb = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    ta.encode_special_tokens = True
    to_byte, docs, count = byte_map(), [], Counter()
    for i, t in rows:
        t = t or ""
        a, b = ta.encode(" " + t, add_special_tokens=False).ids, tb.encode(t)
        ab = [bytes(to_byte[c] for c in ta.id_to_token(k)) if k != 50256 else b"" for k in a]
        bb = [bytes([int(tb.id_to_piece(k)[3:5], 16)]) if tb.is_byte(k) else tb.id_to_piece(k).replace("▁", " ").encode() for k in b]
        want = (" " + t).encode()
        if not t or b"".join(ab) != want or b"".join(bb) != want:
            docs.append((i, [], [], [], []))
            continue
        ae, be = np.cumsum([len(x) for x in ab]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        cuts = sorted(set(ae) & set(be))
        groups, links, x, y = [], [], 0, 0
        for c in cuts:
            p, q = ae.index(c, x) + 1, be.index(c, y) + 1
            groups.append((a[x:p], b[y:q]))
            x, y = p, q
        x = y = 0
        while x < len(a):
            links.append((a[x], b[y]))
            e, f = ae[x], be[y]
            x, y = x + (e <= f), y + (f <= e)
        count.update(links)
        docs.append((i, a, b, groups, links))
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return Counter((i, len(a), len(b), len(g), len(ls), sum(count[p] == best[p[1]] for p in ls), sum(count[p] for p in ls),
                    hashlib.sha256(";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g).encode()).hexdigest() if a else "")
                   for i, a, b, g, ls in docs)


MORE = ODD[:-1] + [(20, "<|endoftext|> <s> </s> <unk> <0x41>"), (21, "a▁b"), (22, "tab\there\r\nand  double   space "), (23, "\x00\x01 ctrl"),
                   (24, "ﬁ ligature ½ Å 한국어 हिन्दी 👩‍👩‍👧"), (25, " lead"), (26, "é é"), (27, "long words " * 300)]


@pytest.mark.parametrize("known", [None, 0, 40])
def test_odd_rows(spark, known):
    df = spark.createDataFrame(MORE, "doc_id long, text string").withColumns({"pairs": F.lit(1), "row": F.lit("x"), "n_a": F.lit(0)}).repartition(3)
    assert Counter(map(tuple, alignment.align(df, A, B, known).collect())) == brute(MORE)


def test_no_rows(no_docs):
    assert alignment.align(no_docs, A, B).count() == 0


def test_long_texts_in_pieces(spark, monkeypatch):
    rows = [(1, "some long words, and 'quotes' don't end.\n\n Next line of text " * 40), (2, "x" * 500), (3, "a b  c d e f"), (4, "ünï cödé " * 60)]
    want = brute(rows)
    both = alignment.Tokenizers(A, B)
    monkeypatch.setattr(alignment, "PIECE", 30)
    assert len(both._cuts(rows[0][1])) > 40
    monkeypatch.setattr(alignment, "TOGETHER", 100)
    assert Counter(map(tuple, alignment.align(spark.createDataFrame(rows, "doc_id long, text string"), A, B).collect())) == want


def test_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert Counter(map(tuple, alignment.align(docs, A, B).collect())) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_groups_are_those_of_all_common_ends():
    rng = np.random.default_rng(0)
    for _ in range(200):
        ends_a, ends_b, a_of, b_of, at = [], [], [0], [0], 0
        for _ in range(rng.integers(1, 5)):
            n = int(rng.integers(0, 60))
            inner = np.arange(1, n)
            for ends, of in ((ends_a, a_of), (ends_b, b_of)):
                mine = inner[rng.random(len(inner)) < rng.choice([0.05, 0.3, 0.9])] + at
                ends += [*mine.tolist(), at + n] if n else []
                of.append(len(ends))
            at += n
        got = alignment.groups(*(np.array(x, np.int64) for x in (ends_a, ends_b, a_of, b_of)))
        common = sorted(set(ends_a) & set(ends_b))
        assert got[0].tolist() == [ends_a.index(c) + 1 for c in common]
        assert got[1].tolist() == [ends_b.index(c) + 1 for c in common]


def test_a_long_interval_without_common_ends_is_one_group():
    n = 100_000
    a, b = np.arange(2, 2 * n + 1, 2), np.concatenate([np.arange(1, 2 * n, 2), [2 * n]])
    got = alignment.groups(a, b, np.array([0, len(a)]), np.array([0, len(b)]))
    assert got[0].tolist() == [len(a)] and got[1].tolist() == [len(b)]


def test_both_libraries_class_and_encode_every_character_alike():
    import random

    from tokenizers import Tokenizer
    both, library = alignment.Tokenizers(A, B), Tokenizer.from_file(A)
    library.encode_special_tokens = True
    assert both.fast is not None and both.as_written
    every = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x110000)]]
    texts = ["a" + "a 1".join(every[k:k + 512]) for k in range(0, 0x30000, 512)]
    rnd = random.Random(0)
    pool = every[:0x3000] + every[0xFE00:0x10000] + list("abc 12'\n\t.,") * 400
    texts += ["".join(rnd.choices(pool, k=80)) for _ in range(3000)]
    want = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert [x.tolist() for x in both._encode_a(texts)] == want
    for t, (a, b) in zip(texts, both.encode(texts)):  # the short check of bytes agrees with the long one
        x, y = both._encode_a([" " + t])[0], np.array(both.b.encode(t))
        full = all(b"".join(table[k] for k in ids.tolist()) == b" " + t.encode() for ids, table in ((x, both.a_bytes), (y, both.b_bytes)))
        assert bool(len(a)) == bool(len(b)) == full


def test_the_tokenizers_library_gives_the_same(spark, monkeypatch):
    rows = MORE[:8] + MORE[-6:]
    made = alignment.Tokenizers.__init__

    def slow(self, *paths):
        made(self, *paths)
        self.fast = None
    both = alignment.Tokenizers(A, B)
    want = both.encode([t or "" for _, t in rows])
    monkeypatch.setattr(alignment.Tokenizers, "__init__", slow)
    got = alignment.Tokenizers(A, B).encode([t or "" for _, t in rows])
    assert [[x.tolist() for x in p] for p in got] == [[x.tolist() for x in p] for p in want]
