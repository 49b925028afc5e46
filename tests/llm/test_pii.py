import hashlib
import re

from hypothesis import given, settings
from pyspark.sql import functions as F
from hypothesis import strategies as st

from cartwheel.llm import pii
from tests.llm.conftest import ODD

RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base(text):
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text):
            d = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")),
                    "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def check(rows, texts):
    for r in rows:
        want = base(texts[r.doc_id])
        shown = ",".join(f"{k}:{a}:{z}" for k, a, z in want)
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest(), texts[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x[0] for x in want) for k in pii.KINDS]
        spans = [(k, int(a), int(z)) for k, a, z in (s.split(":") for s in r.spans.split(",") if s)]
        assert set(want) <= set(spans)
        assert spans == sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), s[1]))


TRICKY = ["a@b-c.d%x@e.f", "a@b@c.d", "x@y", "@a.b", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.2.3.4", "1.2.3", "..1.2.3.4",
          "4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111112", "4111  1111 1111 1111", "1 4111111111111111",
          "+1 (212) 555-0100", "+1 +2 345 6789", "+12345678", "+1234567", "+1 2", "😀 é +49 30 123456-78 a.b@c.de 1.2.3.4",
          "a" * 3000 + "@" + "b.c" * 500, "1" * 5000, "1.1" * 2000, "", " "]


def test_base_spans(spark):
    @settings(max_examples=1, deadline=None)
    @given(st.lists(st.text(st.sampled_from(list("ab@.-+%_ 0123456789()éX")), max_size=40), min_size=300, max_size=300))
    def run(found):
        texts = dict(enumerate(TRICKY + found))
        docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
        check(pii.detect(docs).collect(), texts)
    run()


def test_odd_rows(odd_docs, no_docs):
    rows = pii.detect(odd_docs).collect()
    assert len(rows) == len(ODD)
    check(rows, {i: t or "" for i, t in ODD})
    assert pii.detect(no_docs).count() == 0
    clean = pii.redact(odd_docs)
    assert clean.columns == odd_docs.columns
    by = {r.doc_id: r for r in clean.collect()}
    assert by[None].text == "a row without an id, mail me at [email] or call [phone]"
    assert by[2].text is None and by[2].score == 1 and by[0].text == ODD[0][1]
    assert pii.redact(no_docs).count() == 0


def test_boosting_adds_what_the_rules_miss(spark):
    """A card that touches another number fails the base rule; its format and context are those of the others."""
    def card(i):
        d = f"4{i:014d}"
        return next(d + str(k) for k in range(10) if luhn(d + str(k)))
    rows = [(i, f"words before {card(i)} words after") for i in range(400)]
    rows += [(1000 + i, f"order {i} number {i * 7919 + 10**15} here") for i in range(200) if not luhn(str(i * 7919 + 10**15))]
    rows += [(5000, f"server 10.0.0.173 {card(77)} words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    by = {r.doc_id: r for r in pii.detect(docs).collect()}
    text = dict(rows)[5000]
    at = text.index(card(77))
    assert base(text) == [("ip", 7, 17)]
    assert f"card:{at}:{at + 16}" in by[5000].spans.split(",")
    assert not any(by[i].spans for i, _ in rows if 1000 <= i < 5000)


def test_plan_is_native(spark):
    docs = spark.createDataFrame([(1, "a@b.c 1.2.3.4")], "doc_id long, text string")
    plan = pii.digest(pii.select(pii.spans(docs), pii.fit([]), 0.0))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_trees_and_threshold():
    zero = (0,) * len(pii.FEATURES)
    one = (1, *zero[1:])
    model = pii.fit([(zero, 50.0, 0.0), (one, 50.0, 50.0)])
    least = pii.threshold(model, [(zero, 10.0, 1.0), (one, 10.0, 10.0)])
    score = lambda x: sum((pii._leaf(t, x) for t in model[1]), start=model[0])
    assert score(zero) < least <= score(one) + 1e-12
    assert pii.threshold(model, []) == float("inf")


def test_pieces_change_nothing(spark, monkeypatch):
    """Texts cut into pieces of a few characters give the same spans, candidates and contexts as whole ones."""
    words = ["a.b@c.de", "mail", "x (at) y (dot) z", "10.0.0.1", "4111 1111 1111 1111", "4111-1111-1111-1111", "+1 (212) 555-0100", "call", "visa",
             "(212) 555-0100", "12", "host:", "a@b-c.d,e@f.gh", "é😀", "\n", "tab\there", "555 0100", "x", ";", "1.2.3.4.5", "9", "[at]"]
    import random
    rnd = random.Random(5)
    texts = {i: rnd.choice([" ", "", "  ", ", "]).join(rnd.choices(words, k=rnd.randrange(1, 40))) for i in range(300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)

    def found():
        flat = pii.spans(docs).select("doc_id", *[F.flatten(k).alias(k) for k in (*pii.KINDS, "candidates")])
        got = {r.doc_id: (*[[(x.s, x.e) for x in r[k]] for k in pii.KINDS], sorted(map(tuple, r.candidates))) for r in flat.collect()}
        cut = {r.doc_id: r for r in pii.spans(docs).select("doc_id", F.size("pieces").alias("n"), "pieces.t").collect()}
        assert all("".join(cut[i].t) == texts[i] for i in texts if cut[i].n)
        return got, sum(cut[i].n for i in cut), {r.doc_id: r.text for r in pii.redact(docs).collect()}

    want, n, clean = found()
    monkeypatch.setattr(pii, "PIECE", 5)
    got, more, clean2 = found()
    assert more > 4 * n and got == want and clean2 == clean


def test_time_is_linear_in_a_texts_matches(spark):
    import time

    def took(n):
        text = " ".join(f"write to user{i}.name{i}@host{i}.example.org from 10.0.{i % 250}.{i % 99} now" for i in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        a = time.time()
        row = pii.detect(docs).first()
        assert (row.n_email, row.n_ip) == (n, n)
        assert pii.redact(docs).first().text.count("[email]") == n
        return time.time() - a

    took(200)
    few, many = took(10_000), took(40_000)
    assert many < 2.3 * 2 * few + 5, (few, many)
