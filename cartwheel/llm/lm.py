"""Gated recurrent language model with a class-factored output, for whole-document log-likelihood.

Tokens are lower-cased (A-Z) words and one end sign per document.  The ``HEAD`` most frequent training
tokens (the end sign always) lie in classes of ``MEMBERS`` by rank; every other word, seen or not, lies in one
of ``TAIL`` classes given by its last byte.  With the state h of a gated recurrent unit,

    P(word | h) = P(class | h) * P(word | class, h)            for a head word,
    P(word | h) = P(class | h) * (c + 0.1) / (N_c + 0.1 (V_c + 1))   for a tail word,

c being the word's training count, N_c and V_c the tokens and distinct words of its class.  Output biases start
at the logarithms of the counted shares, so training starts from a unigram model.

Training reads every training document once, in ``ROUNDS`` rounds of growing share (by a hash of the
row).  In a round each task runs truncated back-propagation over windows of ``WINDOW`` steps on its documents,
starting from the shared parameters, with the state carried from window to window through the whole document;
tasks are joined until each has tokens for ``STEPS`` steps of all lanes.  The tasks' parameters are averaged,
weighted by tokens, in a tree.  Counts cover all training documents.
Scoring carries the state through the whole document.  Only a bounded vocabulary (``HEAD``, and at most
``KNOWN`` counts besides) goes to the tasks; counts of all rarer words are joined.

Texts are tokenized once: rows of some hundred thousand tokens, each with its own list of words, are stored,
and the counts, the rounds and the scoring read them.

Null and empty texts are the end sign alone.  Repeated rows get equal results; an empty table gives an
empty result; without training documents all counts are zero.  Texts are cut, numbered and looked up as Arrow
columns, a batch at a time; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import heapq
import itertools
import math
import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import cut_words, ended, gathered, stored, text_column

HEAD, MEMBERS, TAIL, HIDDEN = 2048, 64, 32, 16
KNOWN = 200_000
CLASSES = HEAD // MEMBERS + TAIL
ROUNDS = (0.03, 0.12, 0.35, 0.5)
LANES, WINDOW, STEPS, SCORE_LANES = 256, 32, 128, 1024
TOGETHER = 4_000_000  # tokens of the documents that are laid out in lanes at a time
TOGETHER_BYTES = 12 << 20  # stored bytes of the packs whose words are looked up at a time
PACK = 1 << 19  # tokens of the documents that are stored in a row
PACK_BYTES = 64 << 20  # of their texts, where words are very long
RATE, CLIP = 0.01, 1.0
FAN_IN = 64
END = b"\n"  # no word holds white space, so the end sign has a name of its own
SMOOTH = 0.1


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words (binary) of all texts one after the other, and how many each text has."""
    words, n = cut_words(pc.ascii_lower(texts))
    return words.cast(pa.binary()), n


def held_out() -> Column:
    """Rows that the model and the counts never learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))


# Parameters: x (input rows to gates), u (state to gates), cw, cb (classes), mw, mb (members).


def initial(log_class: np.ndarray, log_member: np.ndarray) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(0)
    p = {"x": rng.normal(0, 0.1, (HEAD + TAIL, 3 * HIDDEN)), "u": rng.normal(0, 0.2, (HIDDEN, 3 * HIDDEN)),
         "cw": np.zeros((HIDDEN, CLASSES)), "cb": log_class,
         "mw": np.zeros((HEAD // MEMBERS, HIDDEN, MEMBERS)), "mb": log_member}
    return {k: v.astype(np.float32) for k, v in p.items()}


def lanes(docs: list[np.ndarray], most: int):
    """Lay documents end to end in parallel lanes: ids (steps x lanes), document numbers (-1: none)
    and starts of documents.  No lane is much longer than the longest document."""
    total, longest = sum(map(len, docs)), max(map(len, docs))
    n = int(max(1, min(most, len(docs), -(-total // longest))))
    heap = [(0, k) for k in range(n)]
    place = []
    for i in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
        at, k = heapq.heappop(heap)
        place.append((i, k, at))
        heapq.heappush(heap, (at + len(docs[i]), k))
    steps = max(at for at, _ in heap)
    ids, owner, start = np.zeros((n, steps), np.int32), np.full((n, steps), -1, np.int32), np.zeros((n, steps), bool)
    for i, k, at in place:
        ids[k, at:at + len(docs[i])] = docs[i]
        owner[k, at:at + len(docs[i])] = i
        start[k, at] = True
    return ids.T.copy(), owner.T.copy(), start.T.copy()


def _gates(u, a, h):
    """One step of all lanes (columns): the new state, and what the backward pass needs."""
    b = u @ h
    zr, c = b[:2 * HIDDEN], b[2 * HIDDEN:]
    zr += a[:2 * HIDDEN]
    zr *= 0.5
    np.tanh(zr, out=zr)
    zr *= 0.5
    zr += 0.5
    z, r = zr[:HIDDEN], zr[HIDDEN:]
    g = r * c
    g += a[2 * HIDDEN:]
    np.tanh(g, out=g)
    new = h - g
    new *= z
    new += g
    return new, (h, z, r, c, g)


def _columns(x: np.ndarray) -> np.ndarray:
    """Steps x lanes x values as contiguous steps x values x lanes, and the other way round."""
    return np.ascontiguousarray(x.transpose(0, 2, 1))


def _run(p, before, start, begins, h, kept=None):
    """States (rows, by step and lane) of one window, and the last one (columns)."""
    u, a = np.ascontiguousarray(p["u"].T), _columns(p["x"].take(before, axis=0))
    states = np.empty((len(before), *h.shape), a.dtype)
    for t in range(len(before)):
        if begins[t]:
            h = np.where(start[t], np.float32(0), h)
        h, k = _gates(u, a[t], h)
        states[t] = h
        if kept is not None:
            kept.append(k)
    return _columns(states).reshape(-1, len(h)), h


def _class_of(ids: np.ndarray) -> np.ndarray:
    return np.where(ids < HEAD, ids // MEMBERS, HEAD // MEMBERS + ids - HEAD)


def output(p, h: np.ndarray, target: np.ndarray, grads=None):
    """Natural log-probabilities of ``target`` given the states; with ``grads``, adds the gradients of
    their sum and returns also that of the states."""
    cls = _class_of(target)
    most = float(np.abs(h).max(initial=0))
    h = np.concatenate([h, np.ones((len(h), 1), h.dtype)], axis=1)  # the last row of the weights is the bias
    cw = np.concatenate([p["cw"], p["cb"][None]])
    mw = np.concatenate([p["mw"], p["mb"][:, None]], axis=1)
    dc, dm = (np.zeros_like(cw), np.zeros_like(mw)) if grads is not None else (None, [None] * len(mw))
    out, dh = _one_of(h, cw, cls, dc, most)
    head = np.flatnonzero(target < HEAD)
    order = head[np.argsort(cls[head].astype(np.int16), kind="stable")]
    edge = np.searchsorted(cls[order], np.arange(HEAD // MEMBERS + 1))
    hs, member = h.take(order, axis=0), target[order] % MEMBERS
    parts = [_one_of(hs[a:z], mw[c], member[a:z], dm[c], most)
             for c, (a, z) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())) if z > a]
    if parts:
        out[order] += np.concatenate([lp for lp, _ in parts])
    if grads is not None:
        if parts:
            dh[order] += np.concatenate([d for _, d in parts])
        for k, g in (("cw", dc[:-1]), ("cb", dc[-1]), ("mw", dm[:, :-1]), ("mb", dm[:, -1])):
            grads[k] += g
    return out, dh


def _one_of(h, w, which, grad, most):
    """Log-softmax of h @ w at ``which``; with ``grad`` (of w) also the gradient of its sum by h.  No value of h
    but the last column's ones exceeds ``most``, so rows are shifted only where exp could leave its range."""
    x = h @ w
    if (np.abs(w[:-1]).sum(axis=0) * most + np.abs(w[-1])).max() > 60:
        x -= x.max(axis=1, keepdims=True)
    flat = x.reshape(-1)
    at = np.arange(len(which)) * x.shape[1] + which
    chosen = flat[at]
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], x.dtype)
    lp = chosen - np.log(total)
    if grad is None:
        return lp, None
    # The gradient by x is (one at ``which``) - x / total; the division is left to the narrower factors.
    flat[at] -= total
    share = (-1 / total)[:, None]
    grad += (h * share).T @ x
    d = x @ w[:-1].T
    d *= share
    return lp, d


def _inputs(ids: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The token before each token; the end sign (0) before a document's first."""
    before = np.zeros_like(ids)
    before[1:] = ids[:-1]
    before[start] = 0
    return before


def score_batch(p, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log-likelihood of every document's classes and head words."""
    total = np.zeros(len(docs))
    if not docs:
        return total
    ids, owner, start = lanes(docs, SCORE_LANES)
    before = _inputs(ids, start)
    begins = start.any(axis=1)
    h = np.zeros((HIDDEN, ids.shape[1]), np.float32)
    for s in range(0, len(ids), WINDOW):
        w = slice(s, s + WINDOW)
        states, h = _run(p, before[w], start[w], begins[w], h)
        own = owner[w].ravel()
        real = np.flatnonzero(own >= 0)
        lp, _ = output(p, states.take(real, axis=0), ids[w].ravel()[real])
        total += np.bincount(own[real], weights=lp, minlength=len(docs))
    return total


def _scatter(rows: np.ndarray, values: np.ndarray, out: np.ndarray) -> None:
    order = np.argsort(rows.astype(np.int16), kind="stable")  # a radix sort
    r = rows[order]
    first = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
    out[r[first]] += np.add.reduceat(values.take(order, axis=0), first, axis=0)


def train_batch(p, docs: list[np.ndarray], state) -> int:
    """One pass of truncated back-propagation over the documents, by Adam; changes ``p`` in place."""
    # Few tokens are laid in fewer lanes, so that they still make some hundred steps.
    ids, owner, start = lanes(docs, max(16, min(LANES, sum(map(len, docs)) // (WINDOW * STEPS))))
    before = _inputs(ids, start)
    begins = start.any(axis=1)
    h = np.zeros((HIDDEN, ids.shape[1]), np.float32)
    for s in range(0, len(ids), WINDOW):
        w, kept = slice(s, s + WINDOW), []
        states, h = _run(p, before[w], start[w], begins[w], h, kept)
        real = np.flatnonzero(owner[w] >= 0)
        n = len(real)
        if not n:
            break
        grads = {k: np.zeros_like(v) for k, v in p.items()}
        _, d_real = output(p, states.take(real, axis=0), ids[w].ravel()[real], grads)
        d_out = np.zeros((len(states), HIDDEN), np.float32)
        d_out[real] = d_real
        d_out = _columns(d_out.reshape(len(kept), -1, HIDDEN))
        dx = np.empty((len(kept), 3 * HIDDEN, ids.shape[1]), np.float32)
        du = np.empty_like(dx)  # as dx, with the reset gate on the candidate's part
        dh = np.zeros_like(h)
        for i in range(len(kept) - 1, -1, -1):
            was, z, r, c, g = kept[i]
            dz, dr, dg = dx[i, :HIDDEN], dx[i, HIDDEN:2 * HIDDEN], dx[i, 2 * HIDDEN:]
            dh += d_out[i]
            rest = 1 - z
            np.multiply(dh, rest, out=dg)
            dg *= 1 - g * g
            rest *= z
            np.subtract(was, g, out=dz)
            dz *= dh
            dz *= rest
            gated = du[i, 2 * HIDDEN:]
            np.multiply(dg, r, out=gated)
            np.subtract(1, r, out=dr)
            dr *= gated
            dr *= c
            du[i, :2 * HIDDEN] = dx[i, :2 * HIDDEN]
            dh *= z
            dh += p["u"] @ du[i]
            if begins[s + i]:
                dh[:, start[s + i]] = 0
            grads["u"] += was @ du[i].T
        _scatter(before[w].ravel(), _columns(dx).reshape(-1, 3 * HIDDEN), grads["x"])
        _step(p, grads, n, state)
    return sum(map(len, docs))


def _step(p, grads, n: int, state) -> None:
    """Adam, ascending the mean log-probability."""
    state["t"] += 1
    t = state["t"]
    size = math.sqrt(sum(float((g * g).sum()) for g in grads.values())) / n
    scale = (min(1.0, CLIP / size) if size else 1.0) / n
    for k, g in grads.items():
        g *= scale
        m, v = state["m"][k], state["v"][k]
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        p[k] += RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-4)


# Spark side.


class _Pack:
    """Documents of one round, as numbers into the pack's own list of words."""

    def __init__(self):
        self.docs, self.lens, self.words, self.size, self.n_bytes = [], [], [], 0, 0

    def add(self, docs: pa.Array, texts: pa.Array) -> None:
        words, n = cut(texts)
        self.docs.append(docs)
        self.lens.append(n + 1)
        self.words.append(words)
        self.size += len(words) + len(docs)
        self.n_bytes += words.nbytes

    def full(self) -> bool:
        return self.size >= PACK or self.n_bytes >= PACK_BYTES

    def row(self, place: int) -> pa.RecordBatch:
        found, lens = pa.concat_arrays(self.words).dictionary_encode(), np.concatenate(self.lens)
        words = pa.concat_arrays([found.dictionary, pa.array([END], pa.binary())])
        ids = ended(found.indices.to_numpy(), lens - 1, len(words) - 1)
        cols = {"round": pa.array([place], pa.int32()), "docs": _listed(pa.concat_arrays(self.docs)),
                "lens": _listed(pa.array(lens, pa.int64())),
                "ids": pa.array([ids.astype(_width(len(words))).tobytes()], pa.binary()),
                "words": _listed(words), "n": _listed(pa.array(np.bincount(ids, minlength=len(words)), pa.int64()))}
        return pa.RecordBatch.from_arrays(list(cols.values()), list(cols))


def _listed(values: pa.Array) -> pa.Array:
    """One row that holds all the values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _width(words: int) -> str:
    return "<u2" if words <= 1 << 16 else "<i4"


def packed(docs: DataFrame) -> DataFrame:
    """All documents, tokenized once and stored: a row per ``PACK`` tokens of one round (``len(ROUNDS)``: held out)
    with the documents' ids and lengths, their tokens by number, and the words with their counts."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_column().alias("text"))
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / float(1 << 20)
    which = F.lit(0)
    for edge in itertools.accumulate(ROUNDS[:-1]):
        which += (place >= edge).cast("int")

    def run(batches):
        packs: dict[int, _Pack] = {}
        for b in batches:
            rounds = b.column(2).to_numpy()
            for k in np.unique(rounds).tolist():
                part = b.filter(pa.array(rounds == k))
                pack = packs.setdefault(k, _Pack())
                pack.add(part.column(0), part.column(1))
                if pack.full():
                    yield packs.pop(k).row(k)
        for k, pack in packs.items():
            yield pack.row(k)

    found = rows.withColumn("round", F.when(held_out(), len(ROUNDS)).otherwise(which)).mapInArrow(
        run, f"round int, docs array<{kind}>, lens array<long>, ids binary, words array<binary>, n array<long>")
    # Rows are megabytes wide: the writer must look at its size after each, and a reader holds a whole row group.
    return stored(found, "lm-packs", {"parquet.block.size": 32 << 20, "parquet.page.size.row.check.min": 1})


def _unpacked(batches, vocab):
    """Of each pack: its documents, their lengths, its tokens by number, its words and the words' numbers in ``vocab``."""
    for b in gathered(batches, TOGETHER_BYTES):  # one look-up for the words of several packs
        words, at = b.column("words"), 0
        numbers = vocab.numbers(words.flatten())
        for docs, lens, ids, own in zip(*(b.column(k) for k in ("docs", "lens", "ids", "words"))):
            n = len(own.values)
            yield (docs.values, lens.values.to_numpy(), np.frombuffer(ids.as_buffer(), _width(n)), own.values,
                   numbers[at:at + n])
            at += n


def word_counts(packs: DataFrame) -> DataFrame:
    """``word binary, c long`` over the tokens of all training documents."""
    each = packs.where(F.col("round") < len(ROUNDS)).select(F.explode(F.arrays_zip("words", "n")).alias("w"))
    return each.groupBy(F.col("w.words").alias("word")).agg(F.sum("w.n").alias("c"))


class Vocabulary:
    """Head ranks and the counts of the most frequent words; sizes of the tail classes."""

    def __init__(self, known: dict[bytes, int], n: int, v: int):
        self.known, self.n, self.v = known, n, v
        ranked = sorted((w for w in known if w != END), key=lambda w: (-known[w], w))[:HEAD - 1]
        self.head = {w: i for i, w in enumerate([END, *ranked])}
        self.tail_n = np.zeros(TAIL)
        self.tail_v = np.zeros(TAIL)

    def finish(self) -> None:
        """Tables by a known word's number: input row, base and tail log-probabilities (base 10)."""
        names = list(self.known)
        self.names = pa.array(names, pa.binary())
        count = np.fromiter(self.known.values(), np.float64, len(names))
        last = np.array([w[-1] % TAIL for w in names], np.int64).reshape(-1)
        self.row = np.array([self.head.get(w, HEAD + k) for w, k in zip(names, last.tolist())], np.int32).reshape(-1)
        self.base_log = np.log10((count + SMOOTH) / (self.n + SMOOTH * (self.v + 1)))
        self.seen = count > 0
        self.tail_log = np.where(self.row < HEAD, 0.0,
                                 np.log10((count + SMOOTH) / (self.tail_n[last] + SMOOTH * (self.tail_v[last] + 1))))

    def __getstate__(self):
        """The tasks need the tables only."""
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "head")}

    def numbers(self, words: pa.Array) -> np.ndarray:
        """Number of each word, -1 where it isn't known."""
        return pc.fill_null(pc.index_in(words, value_set=self.names), -1).to_numpy()

    def rows(self, words: pa.Array, numbers: np.ndarray) -> np.ndarray:
        """Input row of each word: its rank, or its tail class by its last byte."""
        ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset + 1:words.offset + len(words) + 1]
        last = np.frombuffer(words.buffers()[2], np.uint8)[ends - 1]  # no word is empty
        return np.where(numbers >= 0, self.row[numbers], HEAD + last.astype(np.int32) % TAIL)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From the stored counts.  The words that every task knows are the head's, the end sign (even if its count
    is zero) and those with at least the least count that at most ``KNOWN`` words reach."""
    by_count = counts.groupBy("c").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c"))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    held, least = 0, None
    for r in by_count.limit(KNOWN).collect():  # every count holds a word, so KNOWN of them are enough
        if held + r.n > KNOWN:
            break
        held, least = held + r.n, r.c
    common = [] if least is None else counts.where(F.col("c") >= least).collect()
    end = counts.where(F.col("word") == F.lit(END)).collect()
    known = {END: 0} | {bytes(r.word): r.c for r in
                        [*counts.orderBy(F.desc("c"), "word").limit(HEAD).collect(), *end, *common]}
    out = Vocabulary(known, int(total[0]), int(total[1]))
    last = F.conv(F.hex(F.substring("word", -1, 1)), 16, 10).cast("int") % TAIL
    for r in counts.groupBy(last.alias("k")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        out.tail_n[r.k], out.tail_v[r.k] = r.n, r.v
    for w in out.head:
        if known[w]:
            out.tail_n[w[-1] % TAIL] -= known[w]
            out.tail_v[w[-1] % TAIL] -= 1
    out.finish()
    return out


def _start(vocab: Vocabulary) -> dict[str, np.ndarray]:
    member = np.full(HEAD, 0.5)
    for w, i in vocab.head.items():
        member[i] += vocab.known.get(w, 0)
    member = member.reshape(-1, MEMBERS)
    shares = np.concatenate([member.sum(1), vocab.tail_n + 0.5])
    return initial(np.log(shares / shares.sum()), np.log(member / member.sum(1, keepdims=True)))


def _average(blobs: list[bytes]) -> bytes:
    n, mean = 0.0, None
    for b in blobs:
        m, p = pickle.loads(b)
        n += m
        if mean is None:
            mean = {k: v.astype(np.float64) * m for k, v in p.items()}
        else:
            for k in mean:
                mean[k] += p[k].astype(np.float64) * m
    return pickle.dumps((n, {k: (v / n).astype(np.float32) for k, v in mean.items()}), 5)


def _averaged(batches):
    blobs = [x for b in batches for x in b.column(0).to_pylist()]
    if blobs:
        yield pa.RecordBatch.from_arrays([pa.array([_average(blobs)], pa.binary())], ["model"])


def _train_round(packs: DataFrame, p, vocab, tokens: float) -> dict[str, np.ndarray]:
    sc = packs.sparkSession.sparkContext
    held = sc.broadcast((p, vocab))

    def run(batches):
        q, words = held.value
        q = {k: v.copy() for k, v in q.items()}
        state = {"t": 0, "m": {k: np.zeros_like(v) for k, v in q.items()}, "v": {k: np.zeros_like(v) for k, v in q.items()}}
        n, docs, size = 0, [], 0
        for _, lens, ids, own, numbers in _unpacked(batches, words):
            docs += np.split(words.rows(own, numbers)[ids], np.cumsum(lens)[:-1])
            size += len(ids)
            if size > TOGETHER:
                n += train_batch(q, docs, state)
                docs, size = [], 0
        if docs:
            n += train_batch(q, docs, state)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((n, q), 5)], pa.binary())], ["model"])

    # Tasks of fewer tokens would fill only some lanes, and pay a step's fixed cost for few tokens.
    tasks = max(1, int(tokens) // (LANES * WINDOW * STEPS))
    models = stored(packs.select("docs", "lens", "ids", "words").coalesce(tasks).mapInArrow(run, "model binary"), "lm-models")
    while (n := models.count()) > FAN_IN:
        models = stored(models.repartition(-(-n // FAN_IN)).mapInArrow(_averaged, "model binary"), "lm-models")
    got = [bytes(r.model) for r in models.collect()]
    return pickle.loads(_average(got))[1] if got else p


def _counted(words: Vocabulary, numbers: np.ndarray, lens: np.ndarray, ids: np.ndarray, own: pa.Array) -> dict[str, pa.Array]:
    """What the counts alone say of the documents of a pack: columns by document, and the words left to a join."""
    known, first = numbers >= 0, np.concatenate([[0], np.cumsum(lens)[:-1]])  # no document is without its end sign

    def total(table, kind):
        by_word = np.zeros(len(own), kind)
        by_word[known] = table[numbers[known]]
        return pa.array(np.add.reduceat(by_word[ids], first))

    left = np.flatnonzero(~known[ids])
    doc = np.repeat(np.arange(len(lens)), lens)[left]
    key, times = np.unique(doc * len(own) + ids[left], return_counts=True)
    ends = pa.array(np.searchsorted(key, np.arange(len(lens) + 1) * len(own)), pa.int32())
    return {"n_tokens": pa.array(lens, pa.int64()), "n_known": total(words.seen, np.int64),
            "base": total(words.base_log, np.float64), "tail": total(words.tail_log, np.float64),
            "rare": pa.ListArray.from_arrays(ends, own.take(pa.array(key % len(own)))),
            "rare_n": pa.ListArray.from_arrays(ends, pa.array(times, pa.int64()))}


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    packs = packed(docs)
    counts = stored(word_counts(packs), "word-counts")
    vocab = vocabulary(counts)
    p = _start(vocab)
    for k, share in enumerate(ROUNDS):
        p = _train_round(packs.where(F.col("round") == k), p, vocab, share * vocab.n)
    held = docs.sparkSession.sparkContext.broadcast((p, vocab))
    ten = 1 / math.log(10)

    def run(batches):
        q, words = held.value
        done, ids, size = [], [], 0
        for names, lens, local, own, numbers in _unpacked(batches, words):
            done.append({"doc_id": names} | _counted(words, numbers, lens, local, own))
            ids += np.split(words.rows(own, numbers)[local], np.cumsum(lens)[:-1])
            size += len(local)
            if size > TOGETHER:
                yield from scored(q, done, ids)
                done, ids, size = [], [], 0
        if ids:
            yield from scored(q, done, ids)

    def scored(q, done, ids):
        model, at = score_batch(q, ids) * ten, 0
        for cols in done:
            n = len(cols["doc_id"])
            cols["model"] = pa.array(cols.pop("tail").to_numpy() + model[at:at + n])
            at += n
            names = ["doc_id", "n_tokens", "n_known", "base", "model", "rare", "rare_n"]
            yield pa.RecordBatch.from_arrays([cols[k] for k in names], names)

    part = stored(packs.select("docs", "lens", "ids", "words")
                  .mapInArrow(run, f"doc_id {kind}, n_tokens long, n_known long, base double, model double, "
                                   "rare array<binary>, rare_n array<long>")
                  .withColumn("row", F.monotonically_increasing_id()), "lm-parts")
    # Words that not every task knows: their counts are joined, none meaning zero.
    seen = part.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("w")).select(
        "row", F.col("w.rare").alias("word"), F.col("w.rare_n").alias("times"))
    seen = seen.join(counts, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    k = F.conv(F.hex(F.substring("word", -1, 1)), 16, 10).cast("int") % TAIL
    size = F.element_at(F.array(*[F.lit(float(a + SMOOTH * (b + 1))) for a, b in zip(vocab.tail_n, vocab.tail_v)]), k + 1)
    all_size = float(vocab.n + SMOOTH * (vocab.v + 1))
    sums = seen.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10((F.col("c") + SMOOTH) / all_size)).alias("more_base"),
        F.sum(F.col("times") * F.log10((F.col("c") + SMOOTH) / size)).alias("more_model"))
    zero = F.lit(0.0)
    return part.join(sums, "row", "left").select(
        "doc_id", held_out().alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
        (F.col("model") + F.coalesce("more_model", zero)).alias("score"))
