"""Personal data by candidate gradient boosting, in DataFrame functions only.

Rules find *base* spans (e-mail, IPv4, payment card, phone), leftmost and non-overlapping per kind, and
drop the matches that fail their check.  Generators with looser patterns propose further, overlapping
candidates: spelled-out addresses, card numbers that touch another number, phones without a country code
and so on.  Every candidate gets a few small format and context features.  Boosted trees learn which
feature values go with a base span, and a threshold calibrated on documents that the trees have not seen
picks the candidates that are added.  Base spans always stay.

The features are coarse, so however many candidates there are, they fall in a bounded grid of cells
(at most ``CELLS_BOUND``); Spark counts candidates and positives per cell, the trees are fitted on those
counts, and scoring is a CASE expression, so nothing but the counts leaves the executors.

A text is worked on in pieces of about ``PIECE`` characters, cut where no match of any pattern can lie across: at a
character that none of them takes, or at a space between a letter and a letter or digit.  Matches, their contexts (taken from
the piece and the end of the one before it) and their overlaps are therefore found piece by piece, and the time is linear
in the length of the text; only a run of over ``PIECE`` characters without such a place, such as numbers
with nothing but single spaces between them, is one long piece, whose time grows with the square of its matches.

Offsets are code points, ends exclusive.  Null and empty texts have no spans; repeated rows give equal
rows; an empty table gives an empty result; only ``doc_id`` and ``text`` are read.  Where the held-out
documents have no candidate, nothing is added.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import stored, text_column

KINDS = ("email", "ip", "card", "phone")
LOCAL = r"A-Za-z0-9._%+-"
CHAIN = r"(?<![0-9])(?<![0-9][\x20-])[0-9]"

# Possessive and anchored forms of the base patterns: same leftmost matches, linear time, no deep recursion.
BASE = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": CHAIN + r"(?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": [rf"(?<![{LOCAL}])[{LOCAL}]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++"],
    "ip": [r"(?<![0-9.])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}+(?![0-9])"],
    "card": [CHAIN + r"(?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
             r"(?<![0-9])[0-9]{13,19}+(?![0-9])", r"(?<![0-9])[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9])"],
    "phone": [r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])",
              r"(?<![0-9+(])\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"],
}
CUES = {
    "email": r"(?i)(mail|contact|write|reach|@)", "ip": r"(?i)(\bip\b|host|server|address|client|from)",
    "card": r"(?i)(card|visa|credit|debit|pay|account)", "phone": r"(?i)(phone|tel|call|fax|mobile|cell)",
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
FEATURES = ("kind", "gen", "digits", "valid", "seps", "prev", "next", "cue", "size")
CELLS_BOUND = 10 * 7 * 2 * 6 * 4 * 4 * 2 * 4  # generators x the values of the other features

ROUNDS, DEPTH, RATE, RIDGE = 12, 3, 0.5, 1.0
PRECISION = 0.9  # least calibrated share of base-like candidates among those added
SPAN = "struct<s:int,e:int,m:string,before:string,next:string>"
BEFORE = 24  # characters before a candidate that its cue is looked for in
PIECE = 2048
#: A cut lies before a character that no pattern takes, or before a space that none crosses.
CUT = r"[^A-Za-z0-9._%+@()\[\]\x20-]|(?<=[A-Za-z])\x20(?=[A-Za-z0-9])"


PIECES = "array<struct<t:string,o:int,c:string,n:string>>"


def pieces(text: Column) -> Column:
    """Array of (t, o, c, n): a text's pieces, where they start, the characters before them and the one after them."""
    cut = F.regexp_extract_all(text, F.lit(rf"(?s).{{{PIECE}}}(?:(?!{CUT}).)*+|.+"), F.lit(0))
    # Bound by a lambda, so that the text is cut once.
    pairs = F.element_at(F.transform(F.array(cut), lambda c: F.zip_with(
        c, F.slice(c, F.lit(2), F.size(c)), lambda t, after: F.struct(t.alias("t"), F.coalesce(F.left(after, F.lit(1)), F.lit("")).alias("n")))), 1)
    begin = F.struct(F.lit(0).alias("o"), F.lit("").alias("c"), F.array().cast(PIECES).alias("out"))

    def add(a: Column, x: Column) -> Column:
        one = F.array(F.struct(x["t"].alias("t"), a["o"].alias("o"), a["c"].alias("c"), x["n"].alias("n")))
        return F.struct((a["o"] + F.length(x["t"])).alias("o"), F.right(F.concat(a["c"], x["t"]), F.lit(BEFORE)).alias("c"),
                        F.concat(a["out"], one).alias("out"))

    # The usual text is one piece.
    whole = F.array(F.struct(text.alias("t"), F.lit(0).alias("o"), F.lit("").alias("c"), F.lit("").alias("n")))
    return F.when(F.length(text) <= PIECE, whole).otherwise(F.aggregate(pairs, begin, add, lambda a: a["out"]))


def _find(piece: Column, pattern: str) -> Column:
    """Array of (s, e, m, before, next): all matches in a piece with their places in the text, the characters before and the
    one after them.  ``split`` gives what lies between matches, so places are running lengths."""
    text, none = piece["t"], F.array().cast(f"array<{SPAN}>")
    pairs = F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1),
                       lambda m, g: F.struct(m.alias("m"), F.length(g).alias("g")))
    begin = F.struct(F.lit(0).alias("p"), none.alias("out"))

    def add(a: Column, x: Column) -> Column:
        s = a["p"] + x["g"]
        e = s + F.length(x["m"])
        before = F.right(F.concat(piece["c"], F.substring(text, F.lit(1), s)), F.lit(BEFORE))
        one = F.struct((s + piece["o"]).alias("s"), (e + piece["o"]).alias("e"), x["m"].alias("m"), before.alias("before"),
                       F.substring(F.concat(text, piece["n"]), e + 1, F.lit(1)).alias("next"))
        return F.struct(e.alias("p"), F.concat(a["out"], F.array(one)).alias("out"))

    return F.aggregate(F.filter(pairs, lambda x: x["m"].isNotNull()), begin, add, lambda a: a["out"])


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def one(i: Column) -> Column:
        x = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, x).when(x >= 5, 2 * x - 9).otherwise(2 * x)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), n), one), F.lit(0), lambda a, x: a + x)
    return F.when(n > 0, total % 10 == 0).otherwise(False)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _valid(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    if kind == "email":
        return m.rlike(r"@.*[A-Za-z]")
    if kind == "ip":
        return m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return n.between(16, 19) & _luhn(_digits(m))
    return m.startswith("+") & n.between(8, 15)


def _base(kind: str, spans: Column) -> Column:
    return spans if kind == "email" else F.filter(spans, lambda x: _valid(kind, x["m"]))


def _class(c: Column) -> Column:
    return (F.when(c.rlike("^[0-9]"), 2).when(c.rlike(r"^\p{L}"), 1)
            .when((c == "") | c.rlike(r"^\s"), 0).otherwise(3))


def _base_of(kind: str):
    return lambda found: _base(kind, found)


def _candidates(kind: str, gen: int):
    return lambda found, own: F.transform(found, _candidate(kind, gen, own))


def _candidate(kind: str, gen: int, own: Column):
    def features(x: Column) -> Column:
        n = F.length(_digits(x["m"]))
        digits = reduce(lambda w, b: w + (n >= b).cast("int"), (8, 12, 13, 16, 17, 20), F.lit(0))
        size = reduce(lambda w, b: w + (x["e"] - x["s"] >= b).cast("int"), (12, 18, 25), F.lit(0))
        values = {
            "kind": F.lit(KINDS.index(kind)), "gen": F.lit(gen), "digits": digits,
            "valid": _valid(kind, x["m"]).cast("int"),
            "seps": F.least(F.length(F.regexp_replace(x["m"], "[0-9A-Za-z]", "")), F.lit(5)),
            "prev": _class(F.right(x["before"], F.lit(1))), "next": _class(x["next"]),
            "cue": x["before"].rlike(CUES[kind]).cast("int"), "size": size}
        label = F.exists(own, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
        return F.struct(x["s"].alias("s"), x["e"].alias("e"), label.cast("int").alias("y"),
                        *[values[f].cast("int").alias(f) for f in FEATURES])
    return features


def spans(docs: DataFrame) -> DataFrame:
    """``docs`` with ``email, ip, card, phone`` (base spans) and ``candidates`` (spans with features), each an array
    for every piece of the text, and ``pieces``."""
    text = text_column()
    some = {"email": F.contains(text, F.lit("@")) | text.rlike(r"\(at\)|\[at\]")}
    number = text.rlike("[0-9]")
    any_ = some["email"] | number
    out = docs.withColumn("pieces", F.when(any_, pieces(text)).otherwise(F.array().cast(PIECES)))

    def found(k: str, pattern: str) -> Column:
        none = F.transform("pieces", lambda p: F.array().cast(f"array<{SPAN}>"))
        return F.when(some.get(k, number), F.transform("pieces", lambda p: _find(p, pattern))).otherwise(none)

    for k in KINDS:
        out = out.withColumn(f"raw_{k}", found(k, BASE[k]))
    for k in KINDS:
        out = out.withColumn(k, F.transform(f"raw_{k}", _base_of(k)))
    parts, gen = [], 0
    for k in KINDS:
        for j, source in enumerate([f"raw_{k}", *LOOSE[k]]):
            gen += bool(j)
            if j:
                out = out.withColumn(f"loose_{k}_{j}", found(k, source))
                source = f"loose_{k}_{j}"
            out = out.withColumn(f"cand_{k}_{j}", F.zip_with(source, k, _candidates(k, gen)))
            parts.append(f"cand_{k}_{j}")
        gen += 1
    joined = F.transform(F.arrays_zip(*parts), lambda z: F.concat(*[z[c] for c in parts]))
    return out.withColumn("candidates", joined).drop(*parts, *[f"raw_{k}" for k in KINDS],
                                                     *[f"loose_{k}_{j}" for k in KINDS for j in range(1, len(LOOSE[k]) + 1)])


def _tree(cells, grad_hess, depth):
    """Least-squares Newton tree on weighted cells: nested (feature, threshold, left, right) or a leaf."""
    def build(rows, d):
        g = sum(grad_hess[i][0] for i in rows)
        h = sum(grad_hess[i][1] for i in rows)
        best = (1e-9, None)
        if d:
            for f in range(len(FEATURES)):
                by: dict[int, list[float]] = {}
                for i in rows:
                    s = by.setdefault(cells[i][0][f], [0.0, 0.0])
                    s[0] += grad_hess[i][0]
                    s[1] += grad_hess[i][1]
                gl = hl = 0.0
                for v in sorted(by)[:-1]:
                    gl += by[v][0]
                    hl += by[v][1]
                    gain = gl * gl / (hl + RIDGE) + (g - gl) ** 2 / (h - hl + RIDGE) - g * g / (h + RIDGE)
                    if gain > best[0]:
                        best = (gain, (f, v))
        if best[1] is None:
            return RATE * g / (h + RIDGE)
        f, v = best[1]
        return (f, v, build([i for i in rows if cells[i][0][f] <= v], d - 1),
                build([i for i in rows if cells[i][0][f] > v], d - 1))
    return build(range(len(cells)), depth)


def _leaf(tree, x) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def fit(cells: list[tuple[tuple[int, ...], float, float]]) -> tuple[float, list]:
    """Logistic boosting on (features, candidates, positives): start value and trees."""
    n = sum(c[1] for c in cells)
    y = sum(c[2] for c in cells)
    start = math.log((y + 1.0) / (n - y + 1.0))
    margin, trees = [start] * len(cells), []
    for _ in range(ROUNDS if cells else 0):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        tree = _tree(cells, [(c[2] - c[1] * q, c[1] * q * (1 - q)) for c, q in zip(cells, p)], DEPTH)
        trees.append(tree)
        margin = [m + _leaf(tree, c[0]) for m, c in zip(margin, cells)]
    return start, trees


def threshold(model: tuple[float, list], cells, precision: float = PRECISION) -> float:
    """Least score whose isotonic positive rate on unseen cells reaches ``precision`` (infinite if none)."""
    start, trees = model
    scored: dict[float, list[float]] = {}
    for x, n, y in cells:
        score = reduce(lambda a, t: a + _leaf(t, x), trees, start)  # in the order of the SQL expression
        s = scored.setdefault(score, [0.0, 0.0])
        s[0] += n
        s[1] += y
    blocks: list[list[float]] = []  # least score, candidates, positives; rates rise
    for s in sorted(scored):
        blocks.append([s, *scored[s]])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][1] >= blocks[-1][2] / blocks[-1][1]:
            last = blocks.pop()
            blocks[-1][1] += last[1]
            blocks[-1][2] += last[2]
    return next((b[0] for b in blocks if b[2] / b[1] >= precision), math.inf)


def _score(model: tuple[float, list], c: Column) -> Column:
    def case(tree) -> Column:
        if not isinstance(tree, tuple):
            return F.lit(float(tree))
        return F.when(c[FEATURES[tree[0]]] <= tree[1], case(tree[2])).otherwise(case(tree[3]))
    return reduce(lambda a, t: a + case(t), model[1], F.lit(float(model[0])))


def train(found: DataFrame) -> tuple[tuple[float, list], float]:
    """Trees and threshold from the candidates of all documents (``found``: see ``spans``): four fifths
    of the documents, by a hash of ``doc_id``, fit the trees; the others calibrate."""
    part = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0
    counts = (found.where(F.size("candidates") > 0).select(part.alias("unseen"), F.explode(F.flatten("candidates")).alias("c"))
              .groupBy("unseen", *[F.col(f"c.{f}").alias(f) for f in FEATURES])
              .agg(F.count(F.lit(1)).alias("n"), F.sum("c.y").alias("y")).collect())
    cells = {u: sorted((tuple(r[f] for f in FEATURES), float(r.n), float(r.y)) for r in counts if r.unseen == u)
             for u in (True, False)}
    model = fit(cells[False])
    return model, threshold(model, cells[True])


def _touches(a: Column, b: Column) -> Column:
    return (a["s"] < b["e"]) & (b["s"] < a["e"])


def _clear_of(base: Column):
    return lambda c: ~F.exists(base, lambda b: _touches(b, c))


def _added(i: int) -> Column:
    """Places of the added spans of one kind."""
    return F.transform(F.filter(F.flatten("added"), lambda x: x["kind"] == i), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))


def _kinded(base: Column, i: int) -> Column:
    return F.transform(base, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(i).alias("kind")))


def select(found: DataFrame, model: tuple[float, list], least: float) -> DataFrame:
    """Add ``added``: chosen candidates (kind, s, e) that touch no base span, the best of those that overlap; an array for
    each piece."""
    if math.isinf(least):
        none = F.array().cast("array<struct<kind:int,s:int,e:int,p:double>>")
        return found.withColumn("added", F.transform("candidates", lambda c: none))
    scored = lambda c: F.struct(c["kind"].alias("kind"), c["s"].alias("s"), c["e"].alias("e"), _score(model, c).alias("p"))
    out = found.withColumn("scored", F.transform("candidates", lambda cs: F.array_distinct(F.filter(
        F.transform(cs, scored), lambda c: c["p"] >= least))))

    def apart(z: Column) -> Column:
        clear = z["scored"]
        for k in KINDS:
            clear = F.filter(clear, _clear_of(z[k]))
        return clear

    out = out.withColumn("clear", F.transform(F.arrays_zip("scored", *KINDS), apart))
    better = lambda a, b: ((a["p"] > b["p"]) | ((a["p"] == b["p"]) & (
        ((a["e"] - a["s"]) > (b["e"] - b["s"])) | ((a["e"] - a["s"] == b["e"] - b["s"]) & (
            (a["s"] < b["s"]) | ((a["s"] == b["s"]) & (a["kind"] < b["kind"])))))))
    return out.withColumn("added", F.transform("clear", lambda cs: F.filter(cs, lambda c: ~F.exists(
        cs, lambda d: _touches(d, c) & better(d, c))))).drop("scored", "clear")


def _text(kind: str, array: Column) -> Column:
    return F.transform(array, lambda x: F.concat(F.lit(kind + ":"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string")))


def digest(chosen: DataFrame) -> DataFrame:
    """Per document: ``n_email, n_ip, n_card, n_phone`` and ``base_sha256`` of the base spans, and ``spans``,
    all spans as ``kind:start:end`` by kind, then start."""
    flat = chosen.withColumns({k: F.flatten(k) for k in KINDS})
    places = lambda k: F.transform(F.col(k), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
    every = [_text(k, F.array_sort(F.concat(places(k), _added(i)))) for i, k in enumerate(KINDS)]
    return flat.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(F.concat(*[_text(k, F.col(k)) for k in KINDS]), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.concat(*every), ",").alias("spans"))


def detect(docs: DataFrame) -> DataFrame:
    """Find, learn, choose and digest: one row per input row."""
    found = stored(spans(docs.select("doc_id", "text")).drop("text", "pieces"), "pii-candidates")
    model, least = train(found)
    return digest(select(found, model, least))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; other columns unchanged.
    Texts without personal data, null texts included, stay as they are."""
    names = docs.columns
    # A text is stored once: as its pieces where it has some, else in the row.
    row = F.struct(*[F.when(F.size("pieces") == 0, F.col("text")).alias("text") if c == "text" else F.col(f"`row`.`{c}`") for c in names])
    found = spans(docs.select("doc_id", "text", F.struct(*names).alias("row")))
    found = stored(found.withColumn("row", row).drop("text"), "pii-candidates")
    model, least = train(found)

    def clean(z: Column) -> Column:
        text, offset = z["pieces"]["t"], z["pieces"]["o"]
        added = F.transform(z["added"], lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind")))
        every = F.array_sort(F.concat(*[_kinded(z[k], i) for i, k in enumerate(KINDS)], added))
        begin = F.struct(F.lit(0).alias("p"), F.lit("").alias("t"))

        def step(a: Column, x: Column) -> Column:
            s, e = x["s"] - offset, x["e"] - offset
            tag = F.element_at(F.array(*[F.lit(f"[{k}]") for k in KINDS]), x["kind"] + 1)
            gap = F.when(s >= a["p"], F.concat(F.substring(text, a["p"] + 1, s - a["p"]), tag)).otherwise("")
            return F.struct(F.greatest(a["p"], e).alias("p"), F.concat(a["t"], gap).alias("t"))

        return F.aggregate(every, begin, step, lambda a: F.concat(a["t"], F.substring(text, a["p"] + 1, F.length(text))))

    parts = F.transform(F.arrays_zip("pieces", *KINDS, "added"), clean)
    text = F.when(F.size("pieces") > 0, F.array_join(parts, "")).otherwise(F.col("row.text"))
    out = select(found, model, least).withColumn("clean", text)
    return out.select(*[(F.col("clean") if f == "text" else F.col("row")[f]).alias(f) for f in names])
