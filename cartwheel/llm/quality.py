"""Quality classifier by positive-unlabelled learning.

Trusted positives are the training rows labelled 1; the unlabelled class is web text of the training part,
whatever its label.  With the class prior p, a small network minimises the non-negative unbiased risk

    p * R+(positives) + max(0, R-(unlabelled) - p * R-(positives)),

with the logistic loss, so its output is a probability; where the second term falls below zero, the step
goes the other way, which keeps the network from fitting the unlabelled rows as negatives.  The prior is
estimated as the share of label 1 among the labelled training rows, all of them counted.

Inputs are shares of byte classes and word and line statistics of the whole text; labels, language,
source and ids are never inputs.  The network is fitted on the driver on a bounded sample, ``POSITIVES``
positives and ``UNLABELLED`` unlabelled rows by a hash of ``doc_id``; every text is scored.

Null texts count as empty and are scored like them; repeated rows get equal scores; an empty table gives
an empty result; without any positive label every score is the prior (0.5 without labels).  Labels of
unknown documents and null labels are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import text_column

POSITIVES, UNLABELLED = 20_000, 40_000
HIDDEN, STEPS, BATCH, RATE, DECAY = 16, 3000, 512, 0.01, 1e-3
SIGNS = [c for c in range(33, 127) if not chr(c).isalnum()]
N_FEATURES = 7 + len(SIGNS) + 9


def _byte_classes() -> np.ndarray:
    """Class of each byte: capitals, small letters, digits, blanks, line ends, other controls, non-ASCII,
    then each ASCII sign by itself."""
    out = np.full(256, 6)
    out[:32] = 5
    out[127] = 5
    out[[32, 9]] = 3
    out[[10, 13]] = 4
    out[65:91], out[97:123], out[48:58] = 0, 1, 2
    out[SIGNS] = 7 + np.arange(len(SIGNS))
    return out


def features(texts: list[str]) -> np.ndarray:
    """One row of ``N_FEATURES`` numbers per text."""
    classes = _byte_classes()
    x = np.zeros((len(texts), N_FEATURES), np.float32)
    for i, t in enumerate(texts):
        raw = t.encode()
        if not raw:
            continue
        counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        x[i, :7 + len(SIGNS)] = np.sqrt(np.bincount(classes, weights=counts, minlength=7 + len(SIGNS)) / len(raw))
        words, lines = raw.split(), raw.split(b"\n")
        n = max(len(words), 1)
        size = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
        x[i, 7 + len(SIGNS):] = (
            np.log1p(len(raw)) / 10, np.log1p(n) / 10, min(size.mean(), 50) / 10, min(size.std(), 50) / 10,
            np.log1p(size.max()) / 5, len(set(words)) / n, len(set(lines)) / len(lines),
            np.log1p(len(raw) / len(lines)) / 10, sum(map(bytes.isalpha, words)) / n)
    return x


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


class Network:
    """One hidden layer on standardised inputs."""

    def __init__(self, mean, scale, w, b, v, c):
        self.mean, self.scale, self.w, self.b, self.v, self.c = mean, scale, w, b, v, c

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.w + self.b) @ self.v + self.c

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logit(x).astype(np.float64))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Network:
    """Minimise the non-negative risk by Adam over mini-batches that hold both classes in proportion."""
    rng = np.random.default_rng(0)
    every = np.concatenate([positive, unlabelled])
    net = Network(every.mean(0), every.std(0) + 1e-3, rng.normal(0, 0.2, (every.shape[1], HIDDEN)).astype(np.float32),
                  np.zeros(HIDDEN, np.float32), rng.normal(0, 0.2, HIDDEN).astype(np.float32), np.float32(0))
    p_in, u_in = (positive - net.mean) / net.scale, (unlabelled - net.mean) / net.scale
    state = [[np.zeros_like(q), np.zeros_like(q)] for q in (net.w, net.b, net.v, net.c)]
    steps, t = max(1, -(-len(u_in) // BATCH)), 0
    for _ in range(-(-STEPS // steps)):
        p_order, u_order = rng.permutation(len(p_in)), rng.permutation(len(u_in))
        for s in range(steps):
            xp = p_in[p_order[np.arange(s, len(p_order) + steps, steps) % len(p_order)]]
            xu = u_in[u_order[s::steps]]
            if not len(xu):
                continue
            hp, hu = np.tanh(xp @ net.w + net.b), np.tanh(xu @ net.w + net.b)
            gp, gu = _sigmoid(hp @ net.v + net.c), _sigmoid(hu @ net.v + net.c)
            # Losses: -log g for label 1, -log(1 - g) for label 0.
            negative = -np.log1p(-np.minimum(gu, 1 - 1e-6)).mean() + prior * np.log1p(-np.minimum(gp, 1 - 1e-6)).mean()
            if negative >= 0:
                dp = (prior * (gp - 1) - prior * gp) / len(gp)
                du = gu / len(gu)
            else:
                dp, du = prior * gp / len(gp), -gu / len(gu)
            d, h, x = np.concatenate([dp, du]), np.concatenate([hp, hu]), np.concatenate([xp, xu])
            back = np.outer(d, net.v) * (1 - h * h)
            grads = (x.T @ back + DECAY * net.w, back.sum(0), h.T @ d + DECAY * net.v, d.sum())
            t += 1
            for name, g, m in zip("wbvc", grads, state):
                m[0] = 0.9 * m[0] + 0.1 * g
                m[1] = 0.999 * m[1] + 0.001 * g * g
                step = RATE * (m[0] / (1 - 0.9 ** t)) / (np.sqrt(m[1] / (1 - 0.999 ** t)) + 1e-8)
                setattr(net, name, (getattr(net, name) - step).astype(np.float32))
    return net


def held_out() -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sample(rows: DataFrame, size: int) -> DataFrame:
    """About the ``size`` rows of lowest hash (never more): a share is cut off first, so that few rows are sorted."""
    n = rows.count()
    share = 2.0 * size / max(n, 1)
    key = F.xxhash64("doc_id")
    part = rows.where(F.pmod(key, F.lit(1 << 30)) < int(min(share, 1.0) * (1 << 30)))
    return part.orderBy(key).limit(size)


def train(docs: DataFrame, labels: DataFrame) -> tuple[Network | None, float]:
    """Network (none without positives) and class prior."""
    known = labels.where("doc_id is not null").where(~held_out())
    n, y = known.where("quality in (0, 1)").agg(F.count(F.lit(1)), F.coalesce(F.sum("quality"), F.lit(0))).first()
    if not y:
        return None, 0.0 if n else 0.5
    prior = float(y) / float(n)
    picked = _sample(known.where("quality = 1").select("doc_id").distinct(), POSITIVES).withColumn("kind", F.lit(1))
    rest = _sample(docs.where("doc_id is not null").where(~held_out()).select("doc_id").distinct(), UNLABELLED)
    # At most POSITIVES + UNLABELLED ids: small enough to go to every task.
    ids = picked.unionByName(rest.withColumn("kind", F.lit(0)))
    rows = docs.select("doc_id", text_column().alias("text")).join(F.broadcast(ids), "doc_id")

    def run(batches):
        for b in batches:
            x = features(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([r.tobytes() for r in x], pa.binary())],
                                             ["doc_id", "kind", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    # One row per id and class, so repeated rows neither grow nor weight the sample.
    got = (rows.mapInArrow(run, f"doc_id {kind}, kind int, x binary")
           .groupBy("doc_id", "kind").agg(F.min("x").alias("x")).orderBy("doc_id", "kind").toArrow())
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float32).reshape(-1, N_FEATURES)
    positive = got.column("kind").to_numpy() == 1
    if not positive.any() or positive.all():
        return None, prior
    return fit(x[positive], x[~positive], prior), prior


def _scorer(docs: DataFrame, labels: DataFrame):
    """Function from texts to scores."""
    net, prior = train(docs, labels)
    if net is None:
        return lambda texts: np.full(len(texts), float(prior))
    return lambda texts: net.score(features(texts))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score`` (0 to 1) ``, predicted`` (1 if ``score >= 0.5``) for each row of ``docs``."""
    scores = _scorer(docs, labels)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores(b.column(1).to_pylist()), pa.float64())],
                                             ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_column().alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that the classifier does not reject."""
    scores, at = _scorer(docs, labels), docs.columns.index("text")

    def run(batches):
        for b in batches:
            good = scores([t or "" for t in b.column(at).to_pylist()]) >= 0.5
            yield b.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
