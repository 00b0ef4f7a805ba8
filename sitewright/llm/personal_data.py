"""Personal data by candidate gradient boosting.

Plain rules find base spans, which always stay.  High-recall generators propose many overlapping spans for what the rules miss: every
run of neighbouring digit groups, every dotted quadruple, every address written with a sign or a word.  Boosted trees rate a candidate by its format and
its context, and a calibrated threshold per kind selects spans that overlap nothing better.

The trees learn from the rules themselves: base spans and rewritten copies of them in their own context (regrouped cards, phone numbers
without the plus sign, spelled-out addresses, a number next to them) are positive; candidates that cross a base span or break the rule of their
kind are negative.
A candidate that meets the rule by itself although the rule missed it is left out of the fit, since that is what the trees are to decide.
"""
from __future__ import annotations

import re
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sitewright.llm.boosted_trees import Trees, boost, calibrate
from sitewright.llm.labels import fold
from sitewright.session import checkpoint

KINDS = ("email", "ip", "card", "phone")
#: Bounds of the fit: candidates of each label that it reads (and as many for the calibration), candidates and base spans that one text gives it.
MAX_FIT = 20000
MAX_PER_TEXT = 512
#: Candidates of a text that are rated at a time.
SLAB = 4096
CONTEXT = 40
MAX_DIGITS, MAX_GROUPS = 19, 8

# fixed values: the base rules, written so that each run of characters is read once
ADDRESS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++")
QUAD = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

ANY = re.compile(r"[0-9@]|\b[Aa][Tt]\b")
GROUP = re.compile(r"[0-9]++")
GAP = re.compile(r"[\x20().-]{0,3}")
SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]{1,64})(\x20?(?:@|\(at\)|\[at\])\x20?|\x20at\x20)"
                     r"((?:[A-Za-z0-9-]{1,63}(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?|\x20dot\x20)){1,8})([A-Za-z0-9-]{1,63})", re.I)
DOT = re.compile(r"\.|\(dot\)|\[dot\]|\x20dot\x20", re.I)
OTHERS = re.compile("[^0-9]")


def digits_of(s: str) -> str:
    return OTHERS.sub("", s)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if i % 2 == 0 else 2 * v - 9 * (v > 4)
    return total % 10 == 0


def octets(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def holds(kind: str, s: str) -> bool:
    """Whether a span by itself meets the base rule of its kind."""
    if kind == "email":
        name, _, rest = s.partition("@")
        return bool(name) and not name.strip(ADDRESS) and bool(DOMAIN.fullmatch(rest))
    if kind == "ip":
        return bool(QUAD.fullmatch(s)) and octets(s)
    if kind == "card":
        return bool(CARD.fullmatch(s)) and 16 <= len(digits_of(s)) <= 19 and luhn(digits_of(s))
    return bool(PHONE.fullmatch(s)) and 8 <= len(digits_of(s)) <= 15


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind and start: leftmost matches that do not overlap within a kind; one that fails its test is not tried again."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(ADDRESS))
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
        # no address holds a second sign, so the next one starts behind this match or sign
        free = m.end() if m else at + 1
        at = text.find("@", free)
    out += [("ip", *m.span()) for m in QUAD.finditer(text) if octets(m.group())]
    for kind, rule, low, high in (("card", CARD, 16, 19), ("phone", PHONE, 8, 15)):
        for m in rule.finditer(text):
            digits = digits_of(m.group())
            if low <= len(digits) <= high and (kind == "phone" or luhn(digits)):
                out.append((kind, *m.span()))
    return out


def candidates(text: str):
    """Spans worth a look, overlapping: at most MAX_GROUPS per digit group and kind, one per written address and its tails."""
    groups = [m.span() for m in GROUP.finditer(text)]
    near = [b[0] - a[1] <= 3 and GAP.fullmatch(text, a[1], b[0]) is not None for a, b in zip(groups, groups[1:])] + [False]
    for i, (start, end) in enumerate(groups):
        total, blanks, dotted = end - start, True, end - start <= 3
        for j in range(i, min(i + MAX_GROUPS, len(groups))):
            if j > i:
                if not near[j - 1]:
                    break
                gap = text[end:groups[j][0]]
                total, end = total + groups[j][1] - groups[j][0], groups[j][1]
                blanks = blanks and gap in (" ", "-", ".")
                dotted = dotted and gap == "." and end - groups[j][0] <= 3
            if total > MAX_DIGITS:
                break
            if dotted and j - i == 3:
                yield "ip", start, end
            if blanks and total >= 13:
                yield "card", start, end
            if 7 <= total <= 15:
                lead = start
                while lead and text[lead - 1] in "(+" and start - lead < 2:
                    lead -= 1
                yield "phone", lead, end
    for m in SPELLED.finditer(text):
        yield "email", *m.span()
        tail = m.group(3)
        # a sentence may go on behind the address: each shorter list of labels too
        for stop in [d.start() for d in DOT.finditer(tail)][1:]:
            yield "email", m.start(), m.start(3) + len(tail[:stop].rstrip())


def _class(c: str) -> int:
    return 0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4 if c in ".,;:!?" else 5 if c in "()[]{}<>\"'" else 6


def features(text: str, spans: list[tuple[str, int, int]]) -> np.ndarray:
    """One row of format and context numbers per span."""
    rows = []
    for kind, start, end in spans:
        s, left, right = text[start:end], text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
        digits, sizes = digits_of(s), [len(x) for x in GROUP.findall(s)] or [0]
        parts = re.split(r"@|\(at\)|\[at\]|\x20at\x20", s, maxsplit=1, flags=re.I) if kind == "email" else [s]
        labels = [x.strip() for x in DOT.split(parts[-1])] if kind == "email" else []
        rows.append((
            KINDS.index(kind), len(digits), len(sizes), luhn(digits) if digits else 0, int(octets(s)) if kind == "ip" else -1,
            int(digits[0]) if digits else -1, s.count("+"), s.count("("), s.count(" "), s.count("-"), s.count("."), len(s),
            max(sizes), min(sizes), len(set(sizes)), len(set(digits)), "@" in s, len(labels), len(labels[-1]) if labels else 0,
            labels[-1].isalpha() if labels else 0, len(parts[0]) if labels else 0, sum(c.isdigit() for c in parts[0]) if labels else 0,
            _class(left[-1:]), _class(right[:1]), _class(left.rstrip()[-1:]), _class(right.lstrip()[:1]),
            sum(c.isdigit() for c in left), sum(c.isdigit() for c in right), len(left) - len(left.rstrip(ADDRESS[:62])), len(right) - len(right.lstrip(ADDRESS[:62]))))
    return np.array(rows, np.float32).reshape(len(rows), 30)


def rewritten(kind: str, s: str, pick: int) -> str:
    """The same data in a form that the base rule does not cover, or covers with another grouping."""
    digits = digits_of(s)
    if kind == "email":
        at, dot = ((" at ", " dot "), ("(at)", "."), (" [at] ", " [dot] "), (" @ ", "."))[pick % 4]
        name, _, domain = s.partition("@")
        return name + at + domain.replace(".", dot)
    if kind == "card":
        return (" ", "-", ".")[pick % 3].join(re.findall("[0-9]{1,4}", digits))
    if kind == "phone":
        return (s.lstrip("+"), digits, s.replace(" ", "-"), "-".join((digits[-10:-7] or digits[:-7], digits[-7:-4], digits[-4:])))[pick % 4]
    return s


def _touch(a: tuple[str, int, int], b: tuple[str, int, int]) -> bool:
    return a[1] < b[2] and b[1] < a[2]


def spread(rows: list, most: int) -> list:
    """At most ``most`` of the rows, evenly spread."""
    return rows if len(rows) <= most else [rows[i * len(rows) // most] for i in range(most)]


def examples(text: str, most: int = MAX_PER_TEXT):
    """(label, row of features) of the candidates of a text and of rewritten windows around its base spans, up to ``most`` of each."""
    known = base_spans(text)
    found = spread(list(candidates(text)), most)
    exact = set(known)
    reach = sorted(known, key=lambda s: s[1])
    starts = np.array([s[1] for s in reach])
    chosen, labels = [], []
    for c in found:
        if c in exact:
            label = 1
        else:
            # base spans are short and few of them overlap, so only near ones can touch
            k = int(np.searchsorted(starts, c[2]))
            if not any(_touch(c, b) for b in reach[max(0, k - 8):k]) and holds(c[0], text[c[1]:c[2]]):
                continue
            label = 0
        chosen.append(c)
        labels.append(label)
    yield from zip(labels, features(text, chosen))
    for kind, start, end in spread(known, most // 8):
        s, left, right = text[start:end], text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
        # once in another form, then as it is with a number before and behind it, which the rule may take into its match
        other = digits_of(s)[::-1][:4 + 4 * (start % 4)] or "4096"
        for before, new, behind in (("", rewritten(kind, s, start), ""), (f"{other} ", s, ""), ("", s, f" {other}")):
            window = left + before + new + behind + right
            at = len(left) + len(before)
            true = (kind, at, at + len(new))
            if new and window != left + s + right:
                around = [c for c in candidates(window) if c[1] < true[2] + len(behind) and c[2] > len(left)]
                yield from zip([int(c == true) for c in around], features(window, around))


class Finder:
    """The trees and the smallest margin that each kind needs."""

    def __init__(self, trees: Trees, least: dict[str, float]):
        self.trees, self.least = trees, least

    def select(self, text: str, known: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """Candidates over the threshold that touch neither base spans nor a better candidate."""
        exact, good, source = set(known), set(), candidates(text)
        while slab := list(islice(source, SLAB)):
            slab = [c for c in slab if c not in exact]
            good.update((-m, c[1], -c[2], c[0]) for c, m in zip(slab, self.trees.margins(features(text, slab))) if m >= self.least[c[0]])
        # spans taken so far, by the blocks of 64 characters that they touch
        taken: dict[int, list] = {}

        def put(s):
            for b in range(s[1] >> 6, (s[2] - 1 >> 6) + 1):
                taken.setdefault(b, []).append(s)

        for s in known:
            put(s)
        out = []
        for _, start, end, kind in sorted(good):
            c = (kind, start, -end)
            if not any(_touch(c, s) for b in range(c[1] >> 6, (c[2] - 1 >> 6) + 1) for s in taken.get(b, ())):
                out.append(c)
                put(c)
        return out


def fit(x: np.ndarray, y: np.ndarray, w: np.ndarray, held: np.ndarray, precision: float) -> Finder | None:
    """Trees of the rows that are not held out; thresholds where the odds calibrated on the held-out rows of a kind reach ``precision``, or even odds."""
    own = ~held
    if len(np.unique(y[own])) < 2:
        return None
    trees, least = boost(x[own], y[own], w[own]), {}
    margin = trees.margins(x)
    for k, kind in enumerate(KINDS):
        at = held & (x[:, 0] == k)
        slope, offset = calibrate(margin[at], y[at], w[at])
        least[kind] = max((np.log(precision / (1 - precision)) - offset) / slope, 0.0) if slope else np.inf
    return Finder(trees, least)


def learn(docs: DataFrame, *, folds: int = 4, held_out_fold: int = 2, precision: float = 0.95, id_col: str = "doc_id", text_col: str = "text",
          limit: int = MAX_FIT) -> Finder | None:
    """Examples of all documents; the fit reads up to ``limit`` of each label and as many held-out ones, those with the smallest hashes."""
    inner = docs.select(F.coalesce(fold(id_col, folds) == held_out_fold, F.lit(False)).alias("held"), F.col(text_col).alias("t"))

    def run(batches):
        for b in batches:
            held, y, x = [], [], []
            for h, t in zip(b.column(0).to_pylist(), b.column(1)):
                t = t.as_py()
                for label, row in examples(t) if t and ANY.search(t) else ():
                    held.append(h)
                    y.append(label)
                    x.append(row.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.bool_()), pa.array(y, pa.int32()), pa.array(x, pa.binary())], ["held", "y", "x"])

    rows = checkpoint(inner.mapInArrow(run, "held boolean, y int, x binary"))
    counts = {(r["held"], r["y"]): r["n"] for r in rows.groupBy("held", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    part = [rows.filter((F.col("held") == h) & (F.col("y") == v)).orderBy(F.xxhash64("x"), "x").limit(limit)
            .withColumn("w", F.lit(n / min(n, limit))) for (h, v), n in sorted(counts.items())]
    if not part:
        return None

    def train(batches):
        got = [(b.column("held").to_numpy(zero_copy_only=False), b.column("y").to_numpy(), b.column("w").to_numpy(),
                np.frombuffer(b"".join(b.column("x").to_pylist()), np.float32)) for b in batches]
        held, y, w, x = (np.concatenate(c) for c in zip(*got))
        x = x.reshape(len(y), -1)
        # the same rows in the same order, however they arrive
        order = np.lexsort((*x.T, y, held))
        made = fit(x[order], y[order].astype(float), w[order], held[order], precision)
        if made:
            t = made.trees
            arrays = [np.ascontiguousarray(a, np.float64).tobytes() for a in (t.feature, t.cut, t.leaf, [made.least[k] for k in KINDS])]
            yield pa.RecordBatch.from_arrays([pa.array([t.base]), pa.array([len(t.feature)]), *(pa.array([a]) for a in arrays)],
                                             ["base", "n", "f", "c", "l", "least"])

    one = reduce(DataFrame.unionByName, part).coalesce(1).mapInArrow(train, "base double, n long, f binary, c binary, l binary, least binary").collect()
    if not one:
        return None
    r = one[0]
    f, c, leaf = (np.frombuffer(r[k]).reshape(r["n"], -1) for k in "fcl")
    return Finder(Trees(r["base"], f.astype(np.int64), c, leaf), dict(zip(KINDS, np.frombuffer(r["least"]).tolist())))


def find(docs: DataFrame, finder: Finder | None, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
         redact: bool = False) -> DataFrame:
    """``keep`` columns of every row with ``spans``, an array of (kind, start, end, base) by kind as listed, then start.

    Offsets are code points, the end is exclusive.  Base spans always stay; the finder's touch no base span and not each other.  With
    ``redact`` a column ``redacted`` has the text with every span replaced by its kind in angle brackets (of spans that overlap, the first).
    A text that is null is an empty one and has no spans; without a finder only base spans are found.  Rows are read one by one, so ids may
    repeat or be null; an empty table gives none.  Of ``keep`` columns named like a result are left out.
    """
    kept = [c for c in keep if c not in ("spans", "redacted")]
    shared = docs.sparkSession.sparkContext.broadcast(finder)
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                         T.StructField("base", T.BooleanType())])
    kind_of = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def run(batches):
        model = shared.value
        for b in batches:
            out, texts = [], []
            for t in b.column(1):
                t = t.as_py() or ""
                spans = []
                if ANY.search(t):
                    known = base_spans(t)
                    more = model.select(t, known) if model else []
                    spans = sorted([(*s, True) for s in known] + [(*s, False) for s in more], key=lambda s: (KINDS.index(s[0]), s[1]))
                out.append([dict(zip(("kind", "start", "end", "base"), s)) for s in spans])
                if redact:
                    pieces, at = [], 0
                    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
                        if start >= at:
                            pieces += [t[at:start], f"<{kind.upper()}>"]
                        at = max(at, end)
                    texts.append("".join(pieces) + t[at:])
            made = [b.column(0), pa.array(out, pa.list_(kind_of))] + ([pa.array(texts, pa.string())] if redact else [])
            yield pa.RecordBatch.from_arrays(made, ["_k", "spans", "redacted"][:len(made)])

    inner = docs.select((F.struct(*kept) if kept else F.struct(F.lit(0).alias("_"))).alias("_k"), F.col(text_col).alias("_t"))
    fields = [inner.schema.fields[0], T.StructField("spans", T.ArrayType(span))] + ([T.StructField("redacted", T.StringType())] if redact else [])
    made = inner.mapInArrow(run, T.StructType(fields))
    return made.select(*(["_k.*"] if kept else []), "spans", *(["redacted"] if redact else []))
