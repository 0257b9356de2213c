"""Personal data: exact base patterns, and a semi-Markov conditional random field that adds spans the patterns miss.

The field scores whole spans of white-space tokens around digits, @ and spelled-out forms of it: features of the span as one text
(shape, groups of digits, checks, the word before it). A dynamic programme over spans of at most MOST_TOKENS tokens chooses boundaries
and kinds together; tokens outside entities are spans of one. A decoded span is added where it overlaps no base span and beats "no
entity" by MARGIN.

Its weights are trained in numpy by stochastic gradient ascent of the likelihood, on a bounded sample of documents: their base spans
are labels, and each also comes in copies as people disguise or mistype such data (perturbed: brackets, other separators, a missing
plus, a wrong check digit), which the base patterns don't match, and in copies where something harmless stands in its place (decoy: a
date, a version, a price, a number), labelled as no entity.

Defined cases: a null or empty text has no spans; texts are searched whole and in time linear in their length; base spans of
different kinds may overlap, as each kind is found by itself; rows with a null id are kept; repeated rows give repeated results;
without a base span in the sample the field adds nothing; other columns are dropped, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches

KINDS = ("email", "ip", "card", "phone")
MOST_TOKENS = 8
MARGIN = 1.0

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match can only begin where a run of digits begins, and never gives digits back: the same matches in linear time.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(2 * int(d) - 9 * (d > "4") for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = []
    at = end = 0
    while (at := text.find("@", max(at, end))) >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            end = m.end()
        at += 1
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "") if m.end() - m.start() <= 40 else ""
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
                    out.append(("phone", *m.span()))
    return out


TOKEN = re.compile(r"[^ \t\n\r\x0b\x0c]+")
#: What an entity can't do without: a digit, @, or a spelled-out at or dot.
SPOT = re.compile(r"[0-9@]|(?i:[(\[]at[)\]]|\bdot\b)")
SPELLED = re.compile(r"(?i)\bat\b.*\bdot\b", re.DOTALL)
BRACKETED = re.compile(r"(?i)[(\[](?:at|dot)[)\]]")
TRIM = ".,;:!?\"')]}"


def windows(text: str) -> list[list[tuple[int, int]]]:
    """Token bounds of stretches around tokens with a spot, with a token on either side (four and two of a spelled one); only those can
    hold an entity."""
    spots = [*SPOT.finditer(text)]
    tokens = [m.span() for m in TOKEN.finditer(text)] if spots else []
    starts = [a for a, _ in tokens]
    out: list[list[tuple[int, int]]] = []
    end = 0  # tokens before it are in the stretches
    for spot in spots:
        i = bisect_right(starts, spot.start()) - 1
        before, after = (4, 2) if spot.group()[0] in "([dD" else (1, 1)
        first, last = max(i - before, 0), min(i + after + 1, len(tokens))
        if last <= end:
            continue
        if not out or first > end:
            out.append([])
        out[-1] += tokens[max(first, end) : last]
        end = last
    return out


SHAPES, WORDS = 1024, 64
FLAGS = 128
WIDTH = FLAGS + SHAPES + WORDS
LETTERS = re.compile(r"[^\W\d_]+")
DIGITS = re.compile(r"[0-9]+")


def span_features(x: str, tokens: int, before: str) -> list[int]:
    """Numbers of the features that hold for the span x of so many tokens, after the word before; as many for every span."""
    groups = DIGITS.findall(x)
    n = sum(map(len, groups))
    shape = DIGITS.sub(lambda m: str(min(m.end() - m.start(), 9)), LETTERS.sub("a", x))
    on = [
        0, tokens, 7 + min(n, 20), 28 + min(3, x.count("@")), 32 + min(4, x.count(".")), 37 + x.startswith("+"), 39 + bool(LETTERS.search(x)),
        41 + ("=" in x or '"' in x), 43 + ("(" in x and ")" in x), 45 + ("-" in x), 47 + x[:1].isdigit(), 49 + x[-1:].isdigit(),
        51 + (13 <= n <= 19 and luhn("".join(groups))), 53 + (len(groups) == 4 and all(len(p) < 4 and int(p) < 256 for p in groups)),
        55 + min(8, len(x) // 5), 64 + bool(SPELLED.search(x)), 66 + bool(BRACKETED.search(x)), 68 + min(len(groups), 8), 77 + x.startswith("("), 79 + (13 <= n <= 19 and not LETTERS.search(x)),
        81 + (bool(groups) and max(map(len, groups)) >= 5), 83 + bool(re.search(r"[A-Za-z]\.[A-Za-z]", x)), 85 + (min(n, 20) if x.isdigit() else 0), 106 + min(3, x.count("/")),
        110 + ([*map(len, groups[-3:])] == [3, 3, 4] or [*map(len, groups[-2:])] == [3, 7]), 112 + (len(groups) > 2 and {*map(len, groups[:-1])} == {4}), 114 + (len(set(re.sub("[0-9]", "", x))) == 1), FLAGS + zlib.crc32(shape.encode()) % SHAPES, FLAGS + SHAPES + zlib.crc32(before.lower().encode()) % WORDS,
    ]
    return on


@dataclass
class Stretch:
    """The candidate spans of a window: (first token, end token, start, end, features)."""

    n: int
    spans: list[tuple[int, int, int, int, list[int]]] = field(default_factory=list)
    spots: list[bool] = field(default_factory=list)  # whether the span can be an entity at all


def stretch(text: str, tokens: list[tuple[int, int]]) -> Stretch:
    out = Stretch(len(tokens))
    for i, (a, _) in enumerate(tokens):
        before = text[slice(*tokens[i - 1])] if i else ""
        for j in range(i, min(len(tokens), i + MOST_TOKENS)):
            raw = text[a : tokens[j][1]]
            x = raw.rstrip(TRIM)
            if j == i and not (set(x) & set(")]}")):  # an opening bracket stays with its closing one
                x = x.lstrip("([{\"'")
            start = a + (raw.find(x) if x else 0)
            out.spans.append((i, j + 1, start, start + len(x), span_features(x, j - i + 1, before)))
            out.spots.append(bool(SPOT.search(x)))
    return out


@dataclass
class SemiMarkov:
    """weights: one row a feature, one column for no entity and each kind."""

    weights: np.ndarray

    def scores(self, s: Stretch) -> np.ndarray:
        """A row for each span, a column for each label; no entity only for single tokens."""
        out = self.weights[[f for *_, f in s.spans]].sum(1)
        out[[b - a > 1 for a, b, *_ in s.spans], 0] = -np.inf
        out[[not spot for spot in s.spots], 1:] = -np.inf
        return out

    def decode(self, s: Stretch) -> list[tuple[int, int, float]]:
        """(span, label, margin over no entity) of the best segmentation's entities."""
        score = self.scores(s)
        best, back = np.full(s.n + 1, -np.inf), [(-1, 0)] * (s.n + 1)
        best[0] = 0
        none = np.full(s.n, 0.0)
        for k, (a, b, *_) in enumerate(s.spans):  # spans come by first token, so best[a] is final
            if b - a == 1:
                none[a] = score[k, 0]
            label = int(score[k].argmax())
            if best[a] + score[k, label] > best[b]:
                best[b], back[b] = best[a] + score[k, label], (k, label)
        out, at = [], s.n
        while at:
            k, label = back[at]
            a, b = s.spans[k][:2]
            if label:
                out.append((k, label, float(score[k, label] - none[a:b].sum())))
            at = a
        return out[::-1]

    def gradient(self, s: Stretch, gold: set[tuple[int, int]]) -> np.ndarray:
        """Counts in the gold segmentation {(span, label)} less expected counts, a row for each span."""
        score = self.scores(s)
        ahead, behind = np.full(s.n + 1, -np.inf), np.full(s.n + 1, -np.inf)
        ahead[0] = behind[s.n] = 0
        whole = np.logaddexp.reduce(score, 1)
        for k, (a, b, *_) in enumerate(s.spans):
            ahead[b] = np.logaddexp(ahead[b], ahead[a] + whole[k])
        for k in range(len(s.spans) - 1, -1, -1):
            a, b = s.spans[k][:2]
            behind[a] = np.logaddexp(behind[a], behind[b] + whole[k])
        a, b = np.array([x[0] for x in s.spans]), np.array([x[1] for x in s.spans])
        out = -np.exp(ahead[a][:, None] + score + behind[b][:, None] - ahead[s.n])
        for k, label in gold:
            out[k, label] += 1
        return out


def gold_segments(text: str, s: Stretch, spans: list[tuple[str, int, int]]) -> set[tuple[int, int]]:
    """The base spans that are candidate spans, and single tokens for the rest."""
    labels = {(a, b): KINDS.index(kind) + 1 for kind, a, b in reversed(spans)}
    gold, used = set(), set()
    for k, (i, j, a, b, _) in enumerate(s.spans):
        if (a, b) in labels and not used & set(range(i, j)):
            gold.add((k, labels[a, b]))
            used |= set(range(i, j))
    return gold | {(k, 0) for k, (i, j, *_) in enumerate(s.spans) if j - i == 1 and i not in used}


def _email(x: str, at: str, dot: str) -> str:
    local, _, domain = x.partition("@")
    return local + at + domain.replace(".", dot)


def _card(x: str, mark: str, wrong: bool, rng: np.random.Generator) -> str:
    digits = re.sub("[^0-9]", "", x)
    if wrong:
        digits = digits[:-1] + str((int(digits[-1]) + 1 + int(rng.integers(9))) % 10)
    return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))


def _phone(x: str, form: str) -> str:
    digits = re.sub("[^0-9]", "", x)
    return form.format(code=digits[:-10], one=digits[:-10] or 1, a=digits[-10:-7], b=digits[-7:-4], c=digits[-4:])


#: The ways in which people disguise or mistype each kind, so that the base patterns miss it; each takes a base span. A run of digits with a
#: wrong check digit and no mark isn't one: texts hold as many such numbers that are no cards.
FORMS = {
    "email": [lambda x, _, f=f: _email(x, *f) for f in (("(at)", "."), ("[at]", "[dot]"), (" at ", " dot "), ("(at)", "(dot)"), (" (at) ", "."), (" @ ", "."), ("[at]", "."))],
    "ip": [lambda x, _, f=f: x.replace(".", f) for f in ("-", ",", "[.]", ":", "_")],
    "card": [lambda x, rng, f=f: _card(x, *f, rng) for f in ((" ", True), ("-", True), (".", True), ("/", True), (".", False), ("/", False))],
    "phone": [
        lambda x, _, f=f: _phone(x, f)
        for f in ("({a}) {b}-{c}", "{a}-{b}-{c}", "{a}.{b}.{c}", "{a} {b} {c}", "{a}/{b}/{c}", "00{code} {a}-{b}-{c}", "00{code} {a}.{b}.{c}", "00{code} {a} {b} {c}", "00{code} {a}/{b}/{c}", "{one}-{a}-{b}-{c}", "({a}){b}-{c}", "{a}/{b}{c}")
    ],
}


def perturbed(kind: str, x: str, rng: np.random.Generator, form: int | None = None) -> str:
    """A base span in the given form of FORMS, or in any."""
    forms = FORMS[kind]
    return forms[int(rng.integers(len(forms))) if form is None else form % len(forms)](x, rng)


def decoy(rng: np.random.Generator) -> str:
    """Something harmless with digits."""
    n = lambda low, high: int(rng.integers(low, high))
    forms = (
        f"{n(1900, 2100)}-{n(1, 13):02d}-{n(1, 29):02d}", f"{n(1, 29)}/{n(1, 13)}/{n(1900, 2100)}", f"{n(1, 29):02d}.{n(1, 13):02d}.{n(1900, 2100)}", f"{n(0, 24):02d}:{n(0, 60):02d}", f"{n(0, 24):02d}:{n(0, 60):02d}:{n(0, 60):02d}",
        f"{n(0, 20)}.{n(0, 20)}.{n(0, 20)}", f"v{n(0, 20)}.{n(0, 20)}", f"{n(1, 999)},{n(0, 1000):03d}.{n(0, 100):02d}", f"{n(1, 999)},{n(0, 1000):03d},{n(0, 1000):03d}", f"${n(1, 999)}.{n(0, 100):02d}", f"{n(0, 10 ** n(1, 10))}", f"{n(1900, 2100)}-{n(1900, 2100)}",
        f"978-{n(0, 10)}-{n(10, 100)}-{n(100000, 1000000)}-{n(0, 10)}", f"{n(1, 100)}%", f"#{n(1, 10**6)}", f"{n(0, 1 << 40):x}", f"A{n(1000, 9999)}-{n(10, 99)}", f"{n(1, 500)} of {n(1, 500)}", f"{n(1, 100)} x {n(1, 100)}", f"@{'abcdefghij'[n(0, 10)]}{n(1, 99)}", f"{n(-90, 90)}.{n(1000, 9999)}, {n(-180, 180)}.{n(1000, 9999)}", "the dot on", "(at) first",
    )
    return forms[n(0, len(forms))]


def lessons(text: str, rng: np.random.Generator, copies: dict[str, int] | None = None) -> list[tuple[Stretch, set[tuple[int, int]]]]:
    """The windows of a text with their labels, and so many perturbed copies of each base span of a kind (two where that isn't said), the
    forms in turn, with half as many decoys in its place."""
    out, spans = [], base_spans(text)

    def learn(x: str, labels: list[tuple[str, int, int]], wanted: int) -> None:
        for w in windows(x):
            s = stretch(x, w)
            gold = gold_segments(x, s, [y for y in labels if w[0][0] <= y[1] and y[2] <= w[-1][1]])
            if not wanted or any(label for _, label in gold):  # a copy that is no candidate span teaches the wrong thing
                out.append((s, gold))

    learn(text, spans, 0)
    for kind, a, b in spans:
        before, after = (" ".join(x) for x in (text[max(0, a - 80) : a].split()[-5:], text[b : b + 80].split()[:3]))
        lead, tail = text[max(0, a - 80) : a][-1:].isspace() or not before, after and text[b : b + 1].isspace()
        head = before + " " * bool(before and lead)
        first, n = int(rng.integers(len(FORMS[kind]))), (copies or {}).get(kind, 2)
        for copy, labelled in [(perturbed(kind, text[a:b], rng, first + i), True) for i in range(n)] + [(decoy(rng), False) for _ in range(-(-n // 2))]:
            if not base_spans(copy):
                line, c, d = head + copy + " " * bool(tail) + after, len(head), len(head) + len(copy)
                others = [x for x in base_spans(line) if x[2] <= c or x[1] >= d]  # other data around it stays what it is
                learn(line, [*others, (kind, c, d)] if labelled else others, labelled)
    return out


def train(texts: list[str], epochs: int = 4, rate: float = 0.4, decay: float = 1e-4, most: int = 6000, each: int = 60, seed: int = 3) -> SemiMarkov:
    """From the lessons of these texts, in a random order, `most` at most. A kind with few base spans has more copies of each (up to 60),
    so that it has `each` of every form all the same."""
    model, rng = SemiMarkov(np.zeros((WIDTH, len(KINDS) + 1))), np.random.default_rng(seed)
    found = [kind for text in texts for kind, *_ in base_spans(text)]
    copies = {kind: min(60, max(2, -(-each * len(FORMS[kind]) // found.count(kind)))) for kind in set(found)}
    data = [x for text in texts for x in lessons(text, rng, copies)]
    if not any(label for _, gold in data for _, label in gold):
        model.weights[0, 1:] = -4
        return model
    data = [data[i] for i in rng.permutation(len(data))[:most]]
    flat = [np.array([f for *_, f in s.spans]) for s, _ in data]
    for epoch in range(epochs):
        for i in rng.permutation(len(data)):
            now = rate / (1 + epoch)
            g = model.gradient(*data[i])
            model.weights *= 1 - now * decay
            np.add.at(model.weights, flat[i], now * g[:, None, :] / 4)
    return model


#: For each kind, a pattern that every base span of it holds: it only chooses rows to learn from.
LIKELY = {"email": r"@[A-Za-z0-9-]+\.", "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", "card": r"[0-9]([ -]?[0-9]){12}", "phone": r"\+[0-9][ ().0-9-]{7}"}


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", rows: int = 200) -> SemiMarkov:
    """The model of at most `rows` documents of each kind of data, those with the least hash of their id whose text may hold it; only they
    reach the driver."""
    kinds = F.array_compact(F.array(*[F.when(F.col(text).contains({"email": "@", "phone": "+"}.get(k, ".") if k != "card" else "") & F.col(text).rlike(p), k) for k, p in LIKELY.items()]))
    some = docs.select(F.col(key).alias("k"), F.xxhash64(key).alias("h"), F.explode(kinds).alias("kind"))
    place = F.row_number().over(Window.partitionBy("kind").orderBy("h", "k"))  # limited to `rows` a kind in every task
    chosen = some.withColumn("place", place).filter(F.col("place") <= rows).select("k").distinct()
    sample = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(chosen), "k").orderBy(F.xxhash64("k"), "k", "t").limit(len(KINDS) * rows).collect()
    return train([r.t or "" for r in sample])


def all_spans(text: str, model: SemiMarkov) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, whether a base pattern found it) by kind, then start."""
    base = base_spans(text)
    out = [(*x, True) for x in base]
    for w in windows(text):
        if all(any(a <= i and j <= b for _, a, b in base) for m in [SPOT.search(text, *t) for t in w] if m for i, j in [m.span()]):
            continue  # base spans cover every token that could hold an entity
        s = stretch(text, w)
        for k, label, margin in model.decode(s):
            a, b = s.spans[k][2:4]
            if margin >= MARGIN and b > a and not any(x < b and a < y for _, x, y in base):
                out.append((KINDS[label - 1], a, b, False))
    return sorted(out, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def find_personal_data(df: DataFrame, model: SemiMarkov, key: str = "doc_id", text: str = "text", redacted: bool = False) -> DataFrame:
    """key, spans (kind, start, end in code points, base); with redacted=True also the text with each span replaced by <KIND>."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def make():
        here = shared.value

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            found = [all_spans(x, here) if SPOT.search(x) else [] for x in texts]
            names = ("kind", "start", "end", "base")
            columns = [batch.column(0), pa.array([[dict(zip(names, s, strict=True)) for s in spans] for spans in found], kind)]
            if redacted:
                columns.append(pa.array([redact(x, spans) for x, spans in zip(texts, found, strict=True)], pa.string()))
            return pa.RecordBatch.from_arrays(columns, [key, "spans", "redacted"][: len(columns)])

        return work

    return map_batches(df.select(key, text), make, f"`{key}` {df.schema[key].dataType.simpleString()}, spans {SPANS}" + ", redacted string" * redacted)


def redacted(docs: DataFrame, model: SemiMarkov, text: str = "text") -> DataFrame:
    """docs with each span in the text replaced by <KIND>; a null text stays null."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def make():
        here = shared.value

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [redact(x, all_spans(x, here)) if x and SPOT.search(x) else x for x in batch.column(at).to_pylist()]
            columns = [*batch.columns]
            columns[at] = pa.array(texts, pa.string())
            return pa.RecordBatch.from_arrays(columns, batch.schema.names)

        return work

    return map_batches(docs, make, docs.schema)


def redact(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """The text with each stretch of overlapping spans replaced by the name of the kind that begins it."""
    parts, at = [], 0
    for kind, a, b, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= at:
            parts += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*parts, text[at:]])
