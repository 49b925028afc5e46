"""Alignment of two tokenizers' tokens over the same bytes, by divide and conquer at shared cuts.

Tokenizer A (byte-level BPE) encodes a space and the text; tokenizer B (sentencepiece BPE, which puts that space
itself) the text.  Where both give the same bytes, the ends of their tokens cut these bytes.  An
interval that spans several tokens of both is halved at a common end near its middle: A's ends are looked up among B's ends by bisection,
from the middle outwards in windows that double, and both halves are treated alike.  An interval without a
common end inside is a group.  All intervals of a batch of texts are halved together, level by level.

Within a group no inner end is shared, so each elementary stretch between neighbouring ends of either tokenizer is the
overlap of one A token and one B token: a link.  A pair of ids is counted over all links of the corpus; per
text, links whose pair is the most frequent of their B id are told, and the counts are summed.

A text's distinct pairs are stored with their numbers, so texts are encoded once.  Pair counts are a grouped sum
over that table.  Tasks get the counts of the most frequent pairs, at most ``KNOWN``, and join those of all others; the
highest count of each B id is at most one number per id.

Texts null or empty, and those where the joined bytes of a tokenizer differ, have no tokens: all numbers are zero
and the digest is ''.  Equal rows give equal rows and count twice in the corpus; ids may repeat or be null; an empty
table gives an empty result.  Texts of over ``PIECE`` characters are encoded piecewise between words (see ``_cuts``), with the
same tokens.  Only ``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cartwheel.llm.common import stored, text_column, worker_state

KNOWN = 1 << 20
PIECE = 1 << 18
TOGETHER = 1 << 21  # characters of the texts that are aligned together
_SAFE = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
#: Fixed value: how a byte-level pre-tokenizer cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others
    for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def _ranks(vocab: dict[str, int], merges: list, byte: dict[str, int]) -> dict[bytes, int] | None:
    """Merge priorities by token bytes, if ids grow with the order of the merges (single bytes first); else None."""
    raw = lambda s: bytes(byte[c] for c in s)
    made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
    if sorted(vocab[c] for c in byte) != list(range(256)) or made != list(range(256, 256 + len(made))):
        return None
    return {raw(s): k for s, k in vocab.items() if k < 256 + len(made)}


def _as_written(model: bytes) -> bool:
    """Whether a sentencepiece model changes nothing of a text but the space before it and U+2581."""
    from sentencepiece import sentencepiece_model_pb2

    m = sentencepiece_model_pb2.ModelProto()
    m.ParseFromString(model)
    n = m.normalizer_spec
    return (m.trainer_spec.byte_fallback and n.name == "identity" and not n.precompiled_charsmap and n.add_dummy_prefix
            and not n.remove_extra_whitespaces)


class Tokenizers:
    """Both tokenizers with the bytes of each id.

    A byte-level BPE whose ids grow with its merges is run by tiktoken from the vocabulary of the JSON file (both libraries
    class every character alike; a test compares them); any other goes through the tokenizers library."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task uses its own core only
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        spec, byte = json.loads(self.a.to_str()), _byte_of()
        vocab = self.a.get_vocab(with_added_tokens=False)
        added = {t["id"]: t["content"] for t in spec["added_tokens"]}
        a_bytes = [b""] * (1 + max([*vocab.values(), *added]))
        for token, k in vocab.items():
            a_bytes[k] = token.encode() if k in added else bytes(byte[c] for c in token)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.a_bytes, self.b_bytes = a_bytes, b_bytes
        self.a_len, self.b_len = (np.array([len(x) for x in y], np.int64) for y in (a_bytes, b_bytes))
        ranks = _ranks({t: k for t, k in vocab.items() if k not in added}, spec["model"]["merges"], byte)
        plain = spec["normalizer"] is None and spec["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": spec["pre_tokenizer"].get("trim_offsets"), "use_regex": True}
        self.fast = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}) if ranks and plain else None
        self.as_written = _as_written(self.b.serialized_model_proto())
        # A space inside a piece, after another character, would join what ``_cuts`` parts.
        self.parts = not any(re.search("[^▁]▁", p) for p in pieces)
        # Ids as text, in 64 bits each: followed by a comma, or by what ends the tokenizer's side of a group.
        self.a_text, self.b_text = (np.array([[int.from_bytes(b"%d%c" % (k, e), "little") for e in ends] for k in range(n)], "<u8")
                                    for n, ends in ((len(a_bytes), b",|"), (len(b_bytes), b",;")))

    def _cuts(self, text: str) -> list[str]:
        """A long text in pieces, each without the space before it: cut at a space between two ASCII letters, where
        neither tokenizer's tokens cross (A's words begin with their space, B's pieces hold none inside)."""
        if len(text) <= PIECE or not self.parts:
            return [text]
        out, start = [], 0
        while len(text) - start > PIECE:
            at = _SAFE.search(text, start + PIECE)
            if not at:
                break
            out.append(text[start:at.start()])
            start = at.end()
        return [*out, text[start:]]

    def _encode_a(self, texts: list[str]) -> list[np.ndarray]:
        if self.fast is None:
            return [np.array(e.ids, np.int64) for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        return [self.fast.encode_to_numpy(t, disallowed_special=()).astype(np.int64) for t in texts]

    def _same(self, text: str, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether the tokens' bytes are those of a space and the text."""
        want = b" " + text.encode()
        if self.fast is not None and self.as_written:  # then only U+2581 is not given back
            return "▁" not in text and int(self.a_len[a].sum()) == int(self.b_len[b].sum()) == len(want)
        return b"".join([self.a_bytes[k] for k in a.tolist()]) == want == b"".join([self.b_bytes[k] for k in b.tolist()])

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The ids of both tokenizers for each text, none where their bytes differ from the text's."""
        cut = [self._cuts(t) if t else [] for t in texts]
        flat = [p for c in cut for p in c]
        a = self._encode_a([" " + p for p in flat])
        b = [np.array(x, np.int64) for x in (self.b.encode(flat, num_threads=1) if flat else [])]
        out, k, none = [], 0, np.zeros(0, np.int64)
        for t, c in zip(texts, cut):
            mine = [x[k] if len(c) == 1 else np.concatenate([none, *x[k:k + len(c)]]) for x in (a, b)]
            k += len(c)
            out.append((mine[0], mine[1]) if t and self._same(t, *mine) else (none, none))
        return out


def _ranges(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers from each ``first`` on, ``size`` of them, and whose they are."""
    owner = np.repeat(np.arange(len(first)), size)
    return np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + first[owner], owner


def _common_near_middle(a: np.ndarray, b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """For A tokens ``lo`` to ``hi`` (exclusive) of each interval: the token near the middle whose end, not the
    interval's own, is one of B's ends; -1 if none is."""
    found = np.full(len(lo), -1)
    last = hi - 1  # its end is the interval's own
    left = np.flatnonzero(last > lo)
    near, width = 0, 1
    while len(left):
        mid = (lo[left] + last[left]) // 2
        # Tokens at a distance of near to near + width - 1 to the right of the middle, then to its left.
        for begin, end in ((mid + near, mid + near + width), (mid - near - width + 1, mid - near + 1)):
            begin, end = np.clip(begin, lo[left], last[left]), np.clip(end, lo[left], last[left])
            token, owner = _ranges(begin, np.maximum(end - begin, 0))
            at = np.searchsorted(b, a[token])
            hit = b[np.minimum(at, len(b) - 1)] == a[token]
            who, where = left[owner[hit]], token[hit]
            free = found[who] < 0
            found[who[free]] = where[free]
        near += width
        width *= 2
        left = left[found[left] < 0]
        mid = (lo[left] + last[left]) // 2
        left = left[(mid + near < last[left]) | (mid - near >= lo[left])]
    return found


def groups(a: np.ndarray, b: np.ndarray, a_of: np.ndarray, b_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where groups end, as numbers of A and of B tokens (exclusive).  ``a`` and ``b`` are the tokens' ends, ascending;
    ``a_of`` and ``b_of`` cut them into texts (first token of each text, and the number of tokens)."""
    lo, hi, b_lo, b_hi = a_of[:-1], a_of[1:], b_of[:-1], b_of[1:]
    some = hi > lo
    lo, hi, b_lo, b_hi = lo[some], hi[some], b_lo[some], b_hi[some]
    a_ends, b_ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(lo):
        single = (hi - lo == 1) | (b_hi - b_lo == 1)
        a_ends.append(hi[single])
        b_ends.append(b_hi[single])
        lo, hi, b_lo, b_hi = (x[~single] for x in (lo, hi, b_lo, b_hi))
        if not len(lo):
            break
        # Most ends are common, so the middle itself is tried first.
        cut = (lo + hi - 1) >> 1
        b_cut = np.searchsorted(b, a[cut])
        miss = np.flatnonzero(b[b_cut] != a[cut])
        if len(miss):
            cut[miss] = _common_near_middle(a, b, lo[miss], hi[miss])
            b_cut[miss] = np.searchsorted(b, a[cut[miss]])
            leaf = cut < 0
            a_ends.append(hi[leaf])
            b_ends.append(b_hi[leaf])
            lo, hi, b_lo, b_hi, cut, b_cut = (x[~leaf] for x in (lo, hi, b_lo, b_hi, cut, b_cut))
        # Left and right halves side by side, so that intervals stay in order.
        cut, b_cut = cut + 1, b_cut + 1
        lo, hi, b_lo, b_hi = (np.stack(x, 1).ravel() for x in ((lo, cut), (cut, hi), (b_lo, b_cut), (b_cut, b_hi)))
    return np.sort(np.concatenate(a_ends)), np.sort(np.concatenate(b_ends))


def _written(ids: np.ndarray, ends: np.ndarray, text: np.ndarray) -> np.ndarray:
    last = np.zeros(len(ids), np.int64)
    last[ends - 1] = 1
    return text[ids, last]


def _bytes_of(line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts of up to eight bytes end to end, and where each one starts."""
    every = line.view(np.uint8)
    full = every != 0
    return every[full], np.concatenate([[0], np.cumsum(full.reshape(-1, 8).sum(axis=1))])


def aligned(both: Tokenizers, texts: list[str]) -> dict[str, list]:
    """Columns for texts: numbers of tokens, groups and links, the groups' digest, distinct pairs and their links."""
    ids = both.encode(texts)
    a_ids, b_ids = (np.concatenate([np.zeros(0, np.int64), *(x[k] for x in ids)]) for k in (0, 1))
    a_of, b_of = (np.concatenate([[0], np.cumsum([len(x[k]) for x in ids], dtype=np.int64)]) for k in (0, 1))
    a, b = np.cumsum(both.a_len[a_ids]), np.cumsum(both.b_len[b_ids])
    a_end, b_end = groups(a, b, a_of, b_of)
    # Links: stretches between neighbouring ends; texts end at common ends, so none crosses texts.
    stop = np.sort(np.concatenate([a, b]))
    stop = stop[np.concatenate([stop[1:] != stop[:-1], np.ones(min(len(stop), 1), bool)])]
    link_a, link_b = np.searchsorted(a, stop), np.searchsorted(b, stop)
    pair = a_ids[link_a] * len(both.b_len) + b_ids[link_b] if len(stop) else np.zeros(0, np.int64)
    link_of = np.searchsorted(link_a, a_of)
    group_of = np.searchsorted(a_end, a_of, "right")
    # A group's A ids, then its B ids: a token's place is its number and that of the other side's tokens before it.
    a_size, b_size = np.diff(a_end, prepend=0), np.diff(b_end, prepend=0)
    line = np.empty(len(a_ids) + len(b_ids), "<u8")
    line[np.arange(len(a_ids)) + np.repeat(b_end - b_size, a_size)] = _written(a_ids, a_end, both.a_text)
    line[np.arange(len(b_ids)) + np.repeat(a_end, b_size)] = _written(b_ids, b_end, both.b_text)
    text, at = _bytes_of(line)
    out: dict[str, list] = {k: [] for k in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times")}
    for k in range(len(texts)):
        x, y = int(at[a_of[k] + b_of[k]]), int(at[a_of[k + 1] + b_of[k + 1]])
        code, times = np.unique(pair[link_of[k]:link_of[k + 1]], return_counts=True)
        out["n_a"].append(int(a_of[k + 1] - a_of[k]))
        out["n_b"].append(int(b_of[k + 1] - b_of[k]))
        out["n_groups"].append(int(group_of[k + 1] - group_of[k]))
        out["n_links"].append(int(link_of[k + 1] - link_of[k]))
        out["groups_sha256"].append(hashlib.sha256(text[x:y - 1]).hexdigest() if y > x else "")
        out["pairs"].append(code)
        out["times"].append(times)
    return out


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values], dtype=np.int64)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *values]), kind))


_COLUMNS = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string()}


def links(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256``, and the distinct ``pairs`` (A id * number of B ids + B id)
    with their number of links, ``times``, for each row."""
    kind = docs.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)

    def run(batches):
        both = worker_state(f"alignment:{a_path}:{b_path}", lambda: Tokenizers(a_path, b_path))
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            start = size = 0
            for k, t in enumerate(texts):
                size += len(t)
                if size > TOGETHER or k == len(texts) - 1:
                    got = aligned(both, texts[start:k + 1])
                    cols = [pa.array(got[c], t) for c, t in _COLUMNS.items()]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[start:k + 1], id_type), *cols, _lists(got["pairs"], pa.int64()),
                                                      _lists(got["times"], pa.int32())], ["doc_id", *_COLUMNS, "pairs", "times"])
                    start, size = k + 1, 0

    return docs.select("doc_id", text_column().alias("text")).mapInArrow(
        run, f"doc_id {kind.simpleString()}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>")


def pair_counts(found: DataFrame) -> DataFrame:
    """``pair, count`` over all links of the corpus."""
    one = found.select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    return one.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("count"))


def _most_frequent(counts: DataFrame, known: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (ascending) and counts of all pairs with at least the least count that at most ``known`` pairs reach."""
    if known < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    held, least = 0, None
    by_count = counts.groupBy("count").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("count"))
    for r in by_count.limit(known).collect():  # a count has a pair at least
        if held + r.n > known:
            break
        held, least = held + r.n, r["count"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    got = counts.where(F.col("count") >= least).select("pair", "count").toArrow()
    pair, count = (got.column(k).to_numpy() for k in (0, 1))
    order = np.argsort(pair)
    return pair[order], count[order]


def align(docs: DataFrame, a_path: str, b_path: str, known: int | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for each row."""
    known = KNOWN if known is None else known
    n_b = Tokenizers(a_path, b_path).b.get_piece_size()
    found = stored(links(docs, a_path, b_path).withColumn("row", F.monotonically_increasing_id()), "alignment-links")
    counts = stored(pair_counts(found), "alignment-pairs")
    best = np.zeros(n_b, np.int64)
    for r in counts.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("count").alias("n")).collect():  # one row for a B id
        best[r.b] = r.n
    pair, count = _most_frequent(counts, known)
    held = docs.sparkSession.sparkContext.broadcast((pair, count, best))

    def run(batches):
        pair, count, best = held.value
        for b in batches:
            pairs, times = b.column("pairs"), b.column("times")
            ends = pairs.offsets.to_numpy()
            code = pairs.flatten().to_numpy(zero_copy_only=False)
            n = times.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(len(b)), np.diff(ends))
            at = np.searchsorted(pair, code)
            there = np.zeros(len(code), bool)
            inside = at < len(pair)
            there[inside] = pair[at[inside]] == code[inside]
            c = np.zeros(len(code), np.int64)
            c[there] = count[at[there]]
            n_best, total = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            np.add.at(n_best, owner[there], (n * (c == best[code % n_b]))[there])
            np.add.at(total, owner[there], (n * c)[there])
            rare = np.concatenate([[0], np.cumsum(np.bincount(owner[~there], minlength=len(b)))])
            lists = [pa.ListArray.from_arrays(pa.array(rare, pa.int32()), pa.array(x[~there], t)) for x, t in ((code, pa.int64()), (n, pa.int64()))]
            keep = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), pa.array(n_best), pa.array(total), *lists],
                                             [*keep, "n_best", "count_sum", "pairs", "times"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    part = found.mapInArrow(run, f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                                 "n_best long, count_sum long, pairs array<long>, times array<long>")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if len(pair) == counts.count():
        return part.select(*names)
    part = stored(part, "alignment-parts")
    highest = docs.sparkSession.createDataFrame(pa.table({"b": np.arange(n_b), "highest": best}))
    rest = (part.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("n"))
            .join(counts, "pair").withColumn("b", F.col("pair") % n_b).join(F.broadcast(highest), "b")  # a row for each B id
            .groupBy("row").agg(F.sum(F.when(F.col("count") == F.col("highest"), F.col("n")).otherwise(0)).alias("more_best"),
                                F.sum(F.col("n") * F.col("count")).alias("more_count")))
    zero = F.lit(0).cast("long")
    return (part.join(rest, "row", "left")
            .withColumns({"n_best": F.col("n_best") + F.coalesce("more_best", zero), "count_sum": F.col("count_sum") + F.coalesce("more_count", zero)})
            .select(*names))
