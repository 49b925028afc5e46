"""Byte-pair encoding by backtracking, and decoding by an offset table.

``Codec`` reads the JSON file of a word-based BPE (lower-cased, NFC, end-of-word
suffix, byte-level alphabet).  A word is a string over the base symbols (the last
one carries the end-of-word mark).  One Aho-Corasick scan gives the longest token
that starts at each symbol; the encoder walks forward with the longest token and
steps back to a shorter one whenever the new token is not *compatible* with the one
before it.  Two tokens are compatible when merging their joined symbols would keep
them apart.  A sequence whose neighbours are all compatible is the sequence that
the merge rules give, so the result is exact, and a bit for each position keeps any
position from being tried twice, so the time is linear in the word's length.

White space never enters a word, so the runs of other characters of many texts are cut as Arrow columns and each
distinct run is encoded once; ids, and the strings of ids, are then taken by number.

Texts of any length are handled piecewise; null reads as the empty text (no tokens);
special-token strings in a text become their single id, as in the library.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.normalizers import Lowercase
from tokenizers.pre_tokenizers import Split

from cartwheel.llm.common import cut_words, lowered_runs, map_batches, text_column, whitespace_pieces, worker_state

CACHE_WORDS = 300_000  # runs, words, and pairs, that a Python worker remembers; only speed depends on it
LONGEST_KEPT = 64  # characters of a remembered run or word
GROUP = 1 << 20  # characters of texts encoded together
RUN = 1 << 14  # code points looked at together


def _byte_alphabet() -> list[str]:
    """Printable stand-in for each byte, the public byte-level convention."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in set(keep):
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return out


def _code_points(first: int = 0):
    """All characters from ``first`` on, some at a time: a list of all would be most of a worker's memory."""
    for begin, end in ((first, 0xD800), (0xE000, 0x110000)):
        for k in range(begin, end, RUN):
            yield "".join(map(chr, range(k, min(k + RUN, end))))


def _newer_unicode() -> tuple[str, str, str]:
    """Character classes: code points that the regex module counts as letters and as numbers but
    the library, built on an older Unicode, does not; and both."""
    found = []
    for kind in (r"\p{L}", r"\p{N}"):
        new = [c for part in _code_points() for run in regex.finditer(kind + "+", part) for c in run.group()
               if unicodedata.category(c) == "Cn"]
        cut = Split(Regex(kind), "isolated").pre_tokenize_str(" " + " ".join(new) + " ")
        known = {c for c, _ in cut if len(c) == 1}
        found.append(_ranges([c for c in new if c not in known]))
    return found[0], found[1], "".join(found)


def _lowered() -> dict[int, str]:
    """What the library makes of code points that it lower-cases differently from Python (capitals newer than Python's
    tables)."""
    out = {}
    for part in _code_points(0x80):
        for c, low in zip(part, Lowercase().normalize_str("\n".join(part)).split("\n")):
            if low != c.lower():
                out[ord(c)] = low
    return out


def _ranges(chars: list[str]) -> str:
    out, i = [], 0
    while i < len(chars):
        j = i
        while j + 1 < len(chars) and ord(chars[j + 1]) == ord(chars[j]) + 1:
            j += 1
        out.append(f"\\U{ord(chars[i]):08x}-\\U{ord(chars[j]):08x}")
        i = j + 1
    return "".join(out) or "\\U0010ffff"


def _joined(table: pa.LargeBinaryArray, which: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The entries of ``table`` with these numbers end to end, and where each begins (and the last one's end)."""
    out = table.take(which)
    ends = np.frombuffer(out.buffers()[1], np.int64)[out.offset:out.offset + len(out) + 1] if len(out) else np.zeros(1, np.int64)
    return memoryview(out.buffers()[2] or b"")[ends[0]:ends[-1]], ends - ends[0]


#: The symbols of a byte inside a word and at its end.
INNER, LAST = [chr(0x100 + b) for b in range(256)], [chr(0x200 + b) for b in range(256)]


class Codec:
    def __init__(self, spec: str):
        d = json.loads(spec)
        model = d["model"]
        suffix = model["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        alphabet = _byte_alphabet()
        # Internal tokens: 0..511 base symbols (byte, byte at a word's end), then merges by rank.
        names = alphabet + [a + suffix for a in alphabet]
        number = {s: i for i, s in enumerate(names)}
        symbols: list[str] = INNER + LAST
        self.parts: list[tuple[int, int] | None] = [None] * 512
        self.pair: dict[tuple[int, int], int] = {}
        for a, b in merges:
            s = a + b
            t = number.get(s)
            if t is None:
                t = number[s] = len(names)
                names.append(s)
                symbols.append(symbols[number[a]] + symbols[number[b]])
                self.parts.append((number[a], number[b]))
            self.pair.setdefault((number[a], number[b]), t)
        self.ids = [vocab[s] for s in names]
        self.size = [len(s) for s in symbols]
        self.of_symbols = {s: i for i, s in enumerate(symbols)}
        self.scan = ahocorasick.Automaton()
        # The automaton looks through a node's letters in the order in which they came: common ones first.
        often = Counter("".join(symbols))
        for i in sorted(range(len(symbols)), key=lambda i: (len(symbols[i]) > 1, -often[symbols[i]], i)):
            self.scan.add_word(symbols[i], i)
        self.scan.make_automaton()
        self.shorter = self._shorter(symbols)
        self.compatible_cache: dict[int, bool] = {}
        pattern = d["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # The library's \s is Unicode white space; write it out so that both agree on U+001C..U+001F.
        pattern = pattern.replace(r"\s", r"\p{White_Space}")
        self.words = regex.compile(pattern).findall
        # Code points that the regex module classes by a newer Unicode than the library: rare, own pattern.
        letters, numbers, new = _newer_unicode()
        self.new = regex.compile(f"[{new}]").search
        self.words_new = regex.compile("(?V1)" + pattern.replace("[\\p{L}]", f"[\\p{{L}}--[{letters}]]").replace(
            "[\\p{N}]", f"[\\p{{N}}--[{numbers}]]").replace("\\p{L}\\p{N}]", f"[\\p{{L}}--[{letters}]][\\p{{N}}--[{numbers}]]]")).findall
        self.lowered = _lowered()
        self.capitals = regex.compile(f"[{_ranges([chr(c) for c in sorted(self.lowered)])}]").search
        self.small = re.compile("[a-zß-öø-ÿ]+").fullmatch  # letters that are one word as they are
        self.special = {t["content"]: t["id"] for t in d.get("added_tokens", [])}
        self.special_cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        # Offset tables (an Arrow column each): all token strings, and all ids in decimal, end to end, each led by the
        # joining space.
        table = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        self.names = pa.array([(" " + table.get(i, "")).encode() for i in range(max(table) + 1)], pa.large_binary())
        self.numbers = pa.array([f" {i}".encode() for i in range(max(table) + 1)], pa.large_binary())
        self.cache: dict[str, bytes] = {}
        self.runs: dict[bytes, bytes] = {}
        self.missed = 0
        self.stops: dict[bytes, bytes] = {}
        self.stops = {s.encode(): self._run(s.encode()) for s in ".,;:!?"}

    def _shorter(self, symbols: list[str]) -> list[int]:
        """For each token, the longest token that is a proper prefix of it (-1: none)."""
        out = []
        for s in symbols:
            p = s[:-1]
            while p and p not in self.of_symbols:
                p = p[:-1]
            out.append(self.of_symbols[p] if p else -1)
        return out

    def compatible(self, a: int, b: int) -> bool:
        """Would the merge rules leave tokens ``a`` and ``b`` standing side by side?

        Undo the merges of both, latest first, looking at the two tokens that touch the seam:
        a rule that joins them before the later of the two was made would have crossed it."""
        key = a << 20 | b
        known = self.compatible_cache.get(key)
        if known is not None:
            return known
        pair, parts = self.pair, self.parts
        limit, ok = 1 << 60, True
        while True:
            joined = pair.get((a, b))
            if joined is not None and joined < limit:
                ok = False
                break
            if parts[a] is None and parts[b] is None:
                break
            # Equal ranks are applied left to right: the right-hand copy is undone first.
            if parts[b] is None or (parts[a] is not None and a > b):
                limit = a
                a = parts[a][1]
            else:
                limit = b + 1
                b = parts[b][0]
        if len(self.compatible_cache) >= CACHE_WORDS:
            self.compatible_cache.clear()
        self.compatible_cache[key] = ok
        return ok

    def tokens(self, word: str) -> list[int]:
        """Internal tokens of a string of base symbols."""
        n = len(word)
        longest = [-1] * n
        size, known = self.size, self.compatible_cache.get
        for end, t in self.scan.iter(word):
            i = end - size[t] + 1
            if longest[i] < 0 or size[longest[i]] < size[t]:
                longest[i] = t
        out: list[int] = []
        open_ = bytearray(b"\x01") * (n + 1)
        pos, t = 0, longest[0]
        while pos < n:
            while t >= 0:
                end = pos + size[t]
                if open_[end]:
                    if not out:
                        break
                    ok = known(out[-1] << 20 | t)
                    if ok or ok is None and self.compatible(out[-1], t):
                        break
                t = self.shorter[t]
            if t >= 0:
                out.append(t)
                pos = end
                if pos < n:
                    t = longest[pos]
            else:  # nothing fits here: never come back, shorten the token before
                open_[pos] = 0
                t = out.pop()
                pos -= size[t]
                t = self.shorter[t]
        return out

    def _ids(self, word: bytes) -> bytes:
        symbols = "".join(map(INNER.__getitem__, word[:-1])) + LAST[word[-1]]
        return array("I", map(self.ids.__getitem__, self.tokens(symbols))).tobytes()

    def _word(self, word: str) -> bytes:
        out = self._ids(word.encode())
        self._keep(self.cache, word, out)
        return out

    def _keep(self, cache: dict, key, out: bytes) -> None:
        """A full cache keeps what it has, mostly common words; all start afresh after four times as many misses."""
        if len(key) > LONGEST_KEPT:
            return
        if len(cache) < CACHE_WORDS:
            cache[key] = out
        else:
            self.missed += 1
            if self.missed > 4 * CACHE_WORDS:
                self.cache.clear()
                self.runs.clear()
                self.missed = 0

    def _run(self, raw: bytes) -> bytes:
        """Ids of a run without ASCII white space."""
        if raw[-1:] in self.stops and raw[-2:-1].isalpha() and b"<|" not in raw:  # a sign after a letter is a word of its own
            word = raw[:-1]
            return (self.runs.get(word) or self._run(word)) + self.stops[raw[-1:]]
        text = raw.decode()
        if self.small(text):
            out = self._ids(raw)
        elif self.special_cut is not None and "<|" in text:
            found: list[bytes] = []
            for part in self.special_cut.split(text):
                i = self.special.get(part)
                found += self._plain(part) if i is None else [int(i).to_bytes(4, "little")]
            out = b"".join(found)
        else:
            out = b"".join(self._plain(text))
        self._keep(self.runs, raw, out)
        return out

    def _plain(self, text: str) -> list[bytes]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            # Lower-casing goes character by character (no final-sigma rule).
            if self.capitals(text):
                text = text.translate(self.lowered)
            text = "".join([c.lower() for c in text]) if "Σ" in text else text.lower()
        else:
            text = text.lower()
        words = self.words_new if not text.isascii() and self.new(text) else self.words
        get, make = self.cache.get, self._word
        return [get(w) or make(w) for w in words(text)]

    def encode_texts(self, texts: list[str]):
        """For some texts, or pieces of long ones, at a time: the number of each one's text, the ids of all one after the
        other, and where each one's ids begin (and the last ones' end)."""
        rows, held, size = [], [], 0
        for row, text in enumerate(texts):
            for piece in whitespace_pieces(text):
                rows.append(row)
                held.append(piece)
                size += len(piece)
                if size >= GROUP:
                    yield rows, *self._encode_group(held)
                    rows, held, size = [], [], 0
        if held:
            yield rows, *self._encode_group(held)

    def _encode_group(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        runs, n = cut_words(pa.array(texts, pa.string()))
        found = runs.dictionary_encode()
        get, make = self.runs.get, self._run
        ids = [get(r) or make(r) for r in lowered_runs(found.dictionary).to_numpy(zero_copy_only=False)]
        raw, ends = _joined(pa.array(ids, pa.large_binary()), found.indices)
        return np.frombuffer(raw, "<u4"), ends[np.concatenate([[0], np.cumsum(n)])] // 4

    def encode(self, text: str) -> np.ndarray:
        out: list[bytes] = []
        for piece in whitespace_pieces(text):
            runs = piece.encode().split()
            ids = {r: self.runs.get(r) or self._run(r) for r in set(runs)}
            out += map(ids.__getitem__, runs)
        return np.frombuffer(b"".join(out), "<u4")

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the token strings, each with a space before it."""
        return bytes(_joined(self.names, pa.array(ids))[0])

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(np.asarray(ids, "<u4"))[1:].decode()


def codec(spec: str) -> Codec:
    """The worker's codec for this vocabulary file."""
    return worker_state("bpe-" + hashlib.md5(spec.encode()).hexdigest(), lambda: Codec(spec))


def _bounds(ends: np.ndarray) -> tuple[list[int], list[int]]:
    return ends[:-1].tolist(), ends[1:].tolist()


def _whole(parts: list[np.ndarray]) -> np.ndarray:
    return (parts[0] if len(parts) == 1 else np.concatenate([np.empty(0, "<u4"), *parts])).astype(np.int32)


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, spec_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids array<int>`` for each row; null and empty texts give an empty array."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(spec_path))

    def run(c):
        k = codec(spec.value)
        kept = [[] for _ in c["id"]]
        for rows, ids, ends in k.encode_texts(c["text"]):
            for row, a, z in zip(rows, *_bounds(ends)):
                kept[row].append(ids[a:z])
        return {id_col: c["id"], "ids": [_whole(i) for i in kept]}

    rows = docs.select(F.col(id_col).alias("id"), text_column(text_col).alias("text"))
    return map_batches(rows, run, f"{id_col} {docs.schema[id_col].dataType.simpleString()}, ids array<int>")


def decode(rows: DataFrame, spec_path: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col``, ``text`` from ``ids`` (null: null)."""
    spec = rows.sparkSession.sparkContext.broadcast(read_spec(spec_path))

    def run(c):
        k = codec(spec.value)
        return {id_col: c["id"], "text": [None if i is None else k.decode(np.array(i, np.int64)) for i in c["ids"]]}

    return map_batches(rows.select(F.col(id_col).alias("id"), "ids"), run,
                       f"{id_col} {rows.schema[id_col].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, spec_path: str, id_col: str = "doc_id", text_col: str = "text",
               keep_ids: bool = False) -> DataFrame:
    """Encode each text, decode the ids again, and digest both: ``id_col``, ``n_tokens long``, ``ids_sha256``
    (decimal ids joined by a space), ``decoded_sha256`` (UTF-8 of the decoded text) and, if ``keep_ids``, the
    ids themselves.  One row per input row, repeated rows and null or empty texts (0 tokens, digests of
    the empty string) included."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(spec_path))

    def run(c):
        k = codec(spec.value)
        size, m = [0] * len(c["id"]), range(len(c["id"]))
        shown, back, kept = [hashlib.sha256() for _ in m], [hashlib.sha256() for _ in m], [[] for _ in m]
        for rows, ids, ends in k.encode_texts(c["text"]):
            column = pa.array(ids)
            (decimal, decimal_ends), (string, string_ends) = _joined(k.numbers, column), _joined(k.names, column)
            for row, a, z, p, q, u, v in zip(rows, *_bounds(ends), *_bounds(decimal_ends[ends]), *_bounds(string_ends[ends])):
                if z > a:
                    first = not size[row]  # nothing comes before the first token
                    shown[row].update(decimal[p + first:q])
                    back[row].update(string[u + first:v])
                    size[row] += z - a
                if keep_ids:
                    kept[row].append(ids[a:z])
        return {id_col: c["id"], "n_tokens": size, "ids_sha256": [h.hexdigest() for h in shown],
                "decoded_sha256": [h.hexdigest() for h in back], "ids": [_whole(i) for i in kept] if keep_ids else None}

    rows = docs.select(F.col(id_col).alias("id"), text_column(text_col).alias("text"))
    return map_batches(rows, run, f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_tokens long, "
                                  "ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids)
