"""Personal data in texts: fixed patterns, and a semi-Markov CRF for what they miss.

The patterns (email, ip, card, phone) give the base spans. Regions that hold seven digits or more,
or an address written with "(at)", are then cut into units (runs of letters or digits) and given
to the CRF, whose features look at a whole span: its digits, checksum, separators, group lengths,
brackets and the words before it. Boundaries and types of all entities of a region are chosen
together; an entity has at most ``semicrf.LONGEST`` units. Its spans are added where they touch no
base span. The CRF is fitted on generated examples (``examples``), never on the corpus.

All scans are linear in the length of a text, and whole texts are scanned. Defined results: null
and empty texts have no spans; rows with null or repeated ids are returned as they are; only the
id and the text are read.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from batchlake.llm import semicrf
from batchlake.llm.arrow import SPANS_ARROW, ship, steps, texts, with_columns

#: Kinds in their order, and the patterns. Possessive repeats and the look-behind
#: change no match; they keep the search linear.
KINDS = ["email", "ip", "card", "phone"]
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_DIGIT = re.compile("[0-9]")
#: Regions for the CRF, their units, and words that announce a kind.
_NUMBERS = re.compile(r"(?<![0-9A-Za-z])[+(]{0,2}[0-9](?:[-./() ]{0,2}[0-9]){6,}")
_SPELLED = re.compile(
    r"[A-Za-z0-9_.+-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,64}"
    r"(?: ?(?:\.|[\[(] ?dot ?[\])]) ?[A-Za-z0-9-]{1,64}){1,4}",
    re.IGNORECASE,
)
_AT = re.compile(r"at ?[\])]", re.IGNORECASE)
_UNIT = re.compile("[A-Za-z]+|[0-9]+")
_CUES = [
    ("mail", "write"),
    ("ip", "host", "server", "address"),
    ("card", "visa", "credit", "pay"),
    ("phone", "tel", "call", "mobile", "fax"),
]


def luhn(digits: str) -> bool:
    """The card checksum."""
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind, then start."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((0, start, end))
        at = text.find("@", at + 1)
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if 13 <= len(m[0]) <= 37:
            digits = _digits(m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            found.append((3, *m.span()))
    return found


# ---- the CRF's view of a region --------------------------------------------------------------


class Region:
    """Units of a part of a text and the features of all spans of up to ``LONGEST`` units."""

    def __init__(self, text: str, start: int, end: int):
        self.text, self.start, self.end = text, start, end
        units = [m.span() for m in _UNIT.finditer(text, start, end)]
        self.begin = np.array([a for a, _ in units], dtype=np.int64)
        self.stop = np.array([b for _, b in units], dtype=np.int64)
        self.n = len(units)
        words = [text[a:b] for a, b in units]
        self.digit = np.array([w[0].isdigit() for w in words])
        self.size = self.stop - self.begin
        self.value = np.array([int(w) if d and len(w) <= 4 else 9999 for w, d in zip(words, self.digit, strict=True)])
        lowered = [w.lower() for w in words]
        gaps = [text[b:a] for b, a in zip(self.stop, self.begin[1:], strict=False)]
        marks = {
            "dot": [g == "." for g in gaps],
            "blank": [g == " " for g in gaps],
            "dash": [g == "-" for g in gaps],
            "slash": ["/" in g for g in gaps],
            "bracket": ["(" in g or ")" in g or "[" in g or "]" in g for g in gaps],
            "wide": [len(g) > 2 for g in gaps],
        }
        self.gaps = {k: np.concatenate(([0], np.cumsum(v))) for k, v in marks.items()}
        self.digits = np.concatenate(([0], np.cumsum(self.size * self.digit)))
        self.letters = np.concatenate(([0], np.cumsum(~self.digit)))
        self.at = np.concatenate(([0], np.cumsum([w == "at" for w in lowered])))
        self.dots = np.concatenate(([0], np.cumsum([w == "dot" for w in lowered])))
        before = text[max(0, start - 24) : start].lower()
        self.cues = [float(any(w in before for w in words)) for words in _CUES]

    def left(self, i: int) -> int:
        """Where an entity from unit ``i`` on begins: with a plus sign or bracket before it."""
        a = int(self.begin[i])
        low = int(self.stop[i - 1]) if i else self.start
        while a > low and self.text[a - 1] in "+(":
            a -= 1
        return a

    def features(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        count, longest = last - first, semicrf.LONGEST
        i = np.repeat(np.arange(first, last), longest)
        units = np.tile(np.arange(1, longest + 1), count)
        j = np.minimum(i + units, self.n)
        valid = i + units <= self.n
        inner = np.maximum(j - 1, i)
        gap = {k: v[inner] - v[i] for k, v in self.gaps.items()}
        between = units - 1
        digits, letters = self.digits[j] - self.digits[i], self.letters[j] - self.letters[i]
        lefts = np.array([self.left(k) for k in range(first, last)])
        opened = [self.text[a : self.begin[k]] for a, k in zip(lefts, range(first, last), strict=True)]
        plus = np.repeat([float("+" in o) for o in opened], longest)
        paren = np.repeat([float("(" in o) for o in opened], longest)
        numeric = letters == 0
        card = numeric & (digits >= 13) & (digits <= 19) & valid
        check = np.zeros(len(i))
        for k in np.flatnonzero(card):
            check[k] = luhn(_digits(self.text[self.begin[i[k]] : self.stop[j[k] - 1]]))
        top = np.where(self.digit, self.value, 9999)
        small = np.concatenate(([0], np.cumsum(top <= 255)))
        quad = numeric & (units == 4) & (gap["dot"] == 3)
        size = [self.size[np.minimum(i + k, self.n - 1)] * (units > k) for k in range(5)]
        follow = np.array([self.text[b : b + 2] for b in self.stop])[j - 1]
        glued = np.array([bool(f) and (f[0].isalnum() or (f[0] in ".-/@" and f[1:2].isalnum())) for f in follow])
        lead = np.array([self.text[a - 1 : a] for a in lefts])
        after = np.repeat([bool(c) and (c.isalnum() or c in "./-@") for c in lead], longest)
        plain = gap["dot"] + gap["blank"] + gap["dash"] == between
        uniform = (gap["dot"] == between) | (gap["blank"] == between) | (gap["dash"] == between)
        national = numeric & (units == 3) & (size[0] == 3) & (size[1] == 3) & (size[2] == 4)
        dated = numeric & (units == 3) & (size[0] == 4) & (size[1] == 2) & (size[2] == 2)
        at, dots = self.at[j] - self.at[i], self.dots[j] - self.dots[i]
        f = [
            np.ones(len(i)),
            numeric,
            (at == 1) & (gap["bracket"] > 0),
            (dots >= 1) | ((at == 1) & (gap["dot"] >= 1)),
            card,
            check,
            card & (check == 0),
            numeric & (digits >= 9) & (digits <= 15),
            numeric & (digits < 9),
            numeric & (digits > 19),
            quad,
            quad & (small[j] - small[i] == 4),
            quad & (small[j] - small[i] < 4),
            plus,
            paren,
            plain,
            uniform,
            numeric & (units == 4) & (size[0] == 4) & (size[1] == 4) & (size[2] == 4) & (size[3] == 4),
            units == 1,
            national,
            national & (paren == 0),
            dated,
            gap["slash"] > 0,
            gap["wide"] > 0,
            glued,
            after,
            units / longest,
            (units == self.n).astype(float),
            (gap["bracket"] > 0) & numeric,
            *[np.full(len(i), c) for c in self.cues],
        ]
        shape = (count, longest)
        return np.stack(f, axis=1).astype(float).reshape(*shape, -1), valid.reshape(shape)

    def span(self, i: int, units: int) -> tuple[int, int]:
        return self.left(i), int(self.stop[i + units - 1])


# ---- examples and model ----------------------------------------------------------------------


def _number(r: random.Random, n: int) -> str:
    return str(r.randint(1, 9)) + "".join(str(r.randint(0, 9)) for _ in range(n - 1))


def _card_number(r: random.Random, n: int, good: bool) -> str:
    body = _number(r, n - 1)
    last = next(c for c in "0123456789" if luhn(body + c))
    return body + (last if good else str((int(last) + r.randint(1, 9)) % 10))


def _grouped(text: str, sizes: list[int], sep: str) -> str:
    parts, at = [], 0
    for n in sizes:
        parts.append(text[at : at + n])
        at += n
    return sep.join(parts)


def _entity(r: random.Random) -> tuple[str, int | None]:
    """A piece of text and its kind, or a look-alike and None."""
    pick, sep = r.randrange(15), r.choice([" ", "-", "."])
    if pick < 3:
        a, b, c = _number(r, 3), _number(r, 3), _number(r, 4)
        forms = [f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{_number(r, 2)} {_number(r, 2)} {_number(r, 4)} {c}"]
        return r.choice(forms), 3
    if pick < 6:
        n = r.choice([16, 16, 16, 15, 19])
        number = _card_number(r, n, True)
        grouped = r.random() < 0.6 and n == 16
        return _grouped(number, [4] * 4, r.choice([" ", "-"])) if grouped else number, 2
    if pick < 7:
        return ".".join(str(r.randint(10, 255)) for _ in range(4)), 1
    if pick < 9:
        host = "".join(r.choice("abcdefgh") for _ in range(r.randint(3, 8)))
        wrap = r.choice(["[{}]", "({})"])
        name = "".join(r.choice("klmnop") for _ in range(r.randint(2, 7)))
        return f"{name} {wrap.format('at')} {host} {wrap.format('dot')} {r.choice(['com', 'org', 'net'])}", 0
    if pick == 9:
        number = _card_number(r, r.choice([13, 14, 15, 16, 16, 17, 18, 19]), False)
        return _grouped(number, [4] * 4, r.choice([" ", "-"])) if len(number) == 16 and r.random() < 0.5 else number, None
    if pick == 10:
        return ".".join(str(r.randint(100, 999) if k else r.randint(256, 999)) for k in range(4)), None
    if pick == 11:
        return f"{r.randint(1900, 2099)}-{r.randint(1, 12):02}-{r.randint(1, 28):02} {r.randint(10, 23)}.{r.randint(10, 59)}", None
    if pick == 12:
        return _number(r, r.randint(7, 12)), None
    if pick == 13:
        return " ".join(_number(r, r.randint(1, 4)) for _ in range(r.randint(4, 8))), None
    return sep.join(_number(r, r.choice([1, 2, 5, 6])) for _ in range(4)) + "/" + _number(r, 2), None


def examples(n: int, seed: int) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Generated regions with their entities (start, end, kind) in characters."""
    r, out = random.Random(seed), []
    while len(out) < n:
        text, entities = "", []
        for _ in range(r.choice([1, 1, 1, 2])):
            text += " " * bool(text)
            piece, kind = _entity(r)
            if kind is not None:
                entities.append((len(text), len(text) + len(piece), kind))
            text += piece
        if len(_UNIT.findall(text)) <= 16:
            out.append((text, entities))
    return out


def _example(text: str, entities: list[tuple[int, int, int]]):
    region = Region(text, 0, len(text))
    x, valid = region.features(0, region.n)
    found = []
    for start, end, kind in entities:
        i = int(np.searchsorted(region.begin, start))
        found.append((i, int(np.searchsorted(region.stop, end, side="right")) - i, kind))
    return x, valid, found


@cache
def model(count: int = 500, seed: int = 7) -> semicrf.Model:
    """The CRF fitted on ``count`` generated regions."""
    known = [_example(*e) for e in examples(count, seed)]
    return semicrf.fit([e for e in known if all(u <= semicrf.LONGEST for _, u, _ in e[2])], len(KINDS))


def region_entities(text: str, start: int, end: int, crf: semicrf.Model, caution: float = 1.0):
    """(kind, start, end) of the entities the CRF finds in a region."""
    region = Region(text, start, end)
    found = semicrf.decode(crf, region.n, region.features, caution) if region.n else []
    return [(kind, *region.span(i, units)) for i, units, kind in found]


def base_and_own(text: str, crf: semicrf.Model) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and the CRF's where they touch no base span."""
    base = base_spans(text)
    regions = [m.span() for m in _NUMBERS.finditer(text)] if _DIGIT.search(text) else []
    if _AT.search(text):
        regions += [m.span() for m in _SPELLED.finditer(text)]
    if not regions:
        return base, []
    taken = sorted((s, e) for _, s, e in base)
    starts = [s for s, _ in taken]
    furthest = np.maximum.accumulate([e for _, e in taken]) if taken else []

    def free(s: int, e: int) -> bool:
        k = bisect_left(starts, e)
        return not k or furthest[k - 1] <= s

    own: list[tuple[int, int, int]] = []
    for s, e in regions:
        k = bisect_left(starts, s + 1)
        if k and furthest[k - 1] >= e:  # the whole region is a base span
            continue
        own += [x for x in region_entities(text, s, e, crf) if free(*x[1:])]
    return base, sorted(set(own))


def spans(text: str, crf: semicrf.Model) -> list[tuple[int, int, int]]:
    """Base spans and the CRF's, by kind, then start."""
    base, own = base_and_own(text, crf)
    return sorted([*base, *own]) if own else base


#: Spans with whether a base pattern found them.
_SPANS = "spans array<struct<kind: string, start: bigint, end: bigint, base: boolean>>"
_SPANS_ARROW = pa.list_(pa.struct([*SPANS_ARROW.value_type, ("base", pa.bool_())]))


def find_personal(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id and ``spans`` (kind, start, end, and whether it is a base span), by kind,
    then start."""
    ship(docs.sparkSession)
    crf = model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            rows = []
            for t in texts(batch, text):
                base, own = base_and_own(t, crf)
                found = sorted([(*x, True) for x in base] + [(*x, False) for x in own])
                rows.append([{"kind": KINDS[k], "start": s, "end": e, "base": b} for k, s, e, b in found])
            arrays = [batch.column(doc_id), pa.array(rows, _SPANS_ARROW)]
            yield pa.RecordBatch.from_arrays(arrays, [doc_id, "spans"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return with_columns(docs, doc_id, text).mapInArrow(run, f"`{doc_id}` {kind}, {_SPANS}")


def masked(text: str, found: list[tuple[int, int, int]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its (first) kind."""
    parts, at = [], 0
    for kind, s, e in sorted(found, key=lambda x: x[1:]):
        if s >= at:
            parts += [text[at:s], f"[{KINDS[kind].upper()}]"]
        at = max(at, e)
    return "".join([*parts, text[at:]])


def mask_personal(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with personal data in the text replaced by its kind."""
    ship(docs.sparkSession)
    crf = model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            column = batch.column(text)
            new = []
            for t in column.to_pylist():
                found = spans(t, crf) if t else []
                new.append(masked(t, found) if found else t)
            at = batch.schema.get_field_index(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, column.type))

    return docs.mapInArrow(run, docs.schema)
