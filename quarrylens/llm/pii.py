"""Personal data: candidate spans scored by gradient-boosted trees.

Strict patterns (``base_spans``) always count.  Beside them loose generators propose overlapping
spans: spelled-out or non-ASCII mail addresses, digit groups in any common grouping, spaced or defanged
IP addresses, IPv6.  Boosted trees judge each candidate by its format and its surroundings; a calibrated
threshold per kind selects, and the best of overlapping candidates stays.

No table marks personal data, so the labelled rows are made: known positives and look-alikes (order
numbers, dates, versions, failed checksums) are written into windows of the documents' own text.
The windows are at most ``SAMPLE_ROWS``; every document is scored, whole.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrylens.llm import boosting
from quarrylens.llm.common import map_arrow

KINDS = ("email", "ip", "card", "phone")
# Windows of text that become labelled rows, and their letters.
SAMPLE_ROWS = 2000
WINDOW = 240
PRECISION = 0.98
Span = tuple[str, int, int]

# --- strict patterns ---

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Behind a digit nothing can begin that did not begin before it; the look-behind saves the tries.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]+")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    done = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            done = domain.end()
            yield "email", begin, done
        at = text.find("@", max(at + 1, done))


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """The strict spans: leftmost, not overlapping within a kind, in order of kind and place."""
    out = list(_emails(text))
    first = _DIGIT.search(text)
    if not first:
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text, first.start()) if all(map(_octet, m.group().split(".")))]
    for m in _CARD.finditer(text, first.start()):
        if m.end() - m.start() >= 16:
            digits = _NOT_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


# --- candidates ---

_RUN = re.compile(r"[+(]?[0-9](?:[ ().\-/ ‐-—•·]{0,3}[0-9])+")
_GROUP = re.compile("[0-9]+")
_LOOSE_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?[\[(]? ?(?:\.|dot) ?[\])]? ?[0-9]{1,3}){3}(?![0-9])")
# From the first colon on; up to four hexadecimal digits may stand before it.
_IPV6 = re.compile(r"(?::{1,2}[0-9A-Fa-f]{1,4}){3,7}(?![0-9A-Za-z:])")
_HEX_BEFORE = re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{0,4}\Z")
_BRACKETED_AT = re.compile(r"[\[({<] ?[Aa][Tt] ?[\])}>]")
_SPELLED = re.compile(r"[A-Za-z0-9-]+ ?[\[({<]? ?(?:[Dd][Oo][Tt]|\.)(?: |\]|\)|\}|>|[A-Za-z])")
_BEFORE = re.compile(r"[\w.%+'-]{1,64}\Z")
_AFTER = re.compile(r"[\w-]{1,63}(?:(?: ?[\[({<] ?(?:[Dd][Oo][Tt]|\.) ?[\])}>] ?| [Dd][Oo][Tt] | ?\. ?)[\w-]{1,63}){1,5}")


@dataclass(frozen=True)
class Candidate:
    kind: str
    begin: int
    end: int
    # Length of the maximal run of digit groups around the span, 0 for mail addresses.
    run: int = 0


def _at_signs(text: str) -> Iterator[tuple[int, int]]:
    """Places of ``@`` and of its spelled forms, with the single spaces around them."""
    for sign in ("@", " at ", " AT ", " At "):
        at = text.find(sign)
        while at >= 0:
            if sign == "@":
                yield at - (text[at - 1 : at] == " "), at + 1 + (text[at + 1 : at + 2] == " ")
            elif _SPELLED.match(text, at + 4):
                yield at, at + 4
            at = text.find(sign, at + 1)
    for m in _BRACKETED_AT.finditer(text):
        yield m.start() - (text[m.start() - 1 : m.start()] == " "), m.end() + (text[m.end() : m.end() + 1] == " ")


def candidates(text: str) -> Iterator[Candidate]:
    """Everything that may be personal data, overlaps included."""
    for sign, behind in _at_signs(text):
        before = _BEFORE.search(text[max(0, sign - 64) : sign])
        after = _AFTER.match(text, behind)
        if before and after:
            begin = sign - len(before.group())
            # Both the longest and the shortest reading of the domain.
            parts = [p.end() for p in re.finditer(r"[\w-]+", after.group())]
            for end in sorted({parts[-1], parts[1] if len(parts) < 3 or "." in after.group()[: parts[1]] else parts[2]}):
                yield Candidate("email", begin, behind + end)
    # What follows holds a digit; most texts hold none.
    first = _DIGIT.search(text)
    if not first:
        return
    for m in _LOOSE_IP.finditer(text, first.start()):
        yield Candidate("ip", m.start(), m.end(), m.end() - m.start())
    colon = text.find(":")
    while colon >= 0:
        m = _IPV6.match(text, colon)
        before = _HEX_BEFORE.search(text[max(0, colon - 5) : colon]) if m else None
        if before:
            yield Candidate("ip", colon - len(before.group()), m.end(), m.end() - colon)
        colon = text.find(":", m.end() if before else colon + 1)
    for m in _RUN.finditer(text, max(0, first.start() - 1)):
        if m.end() - m.start() < 7:
            continue
        groups = [g.span() for g in _GROUP.finditer(text, m.start(), m.end())]
        for i, (begin, _) in enumerate(groups):
            digits, longest = 0, 0
            opened = begin - (begin > 0 and text[begin - 1] in "+(" and begin > m.start())
            # Each group has a digit, so 20 of them pass the limit of 19.
            for own, end in groups[i : i + 20]:
                digits += end - own
                longest = max(longest, end - own)
                if digits > 19:
                    break
                if longest >= 3 and 7 <= digits <= 15:
                    yield Candidate("phone", opened if i else m.start(), end, m.end() - m.start())
                if longest >= 3 and 12 <= digits <= 19:
                    yield Candidate("card", begin, end, m.end() - m.start())


# Words beside a number or address that tell what it is: fixed values.
CUES = {
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "telefon", "anruf", "ruf", "handy", "teléfono", "móvil", "llama", "téléphone", "appel", "whatsapp", "sms"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "kreditkarte", "karte", "tarjeta", "carte", "payment", "pay", "cc"),
    "ip": ("ip", "host", "server", "addr", "address", "login", "client", "from", "ping", "adresse", "gateway", "peer"),
    "email": ("mail", "email", "contact", "write", "reach", "send", "kontakt", "correo", "courriel", "schreib", "to", "reply"),
}
OTHER = (
    "order", "invoice", "no", "nr", "id", "isbn", "date", "version", "ref", "part", "serial", "page", "total", "price", "euro", "usd",
    "build", "section", "sku", "lot", "account", "iban", "ticket", "case", "doi", "v", "article", "artikel", "bestellung", "rechnung",
)
_WORD = re.compile(r"[^\W\d_]+")


def features(text: str, c: Candidate) -> list[float]:
    """Format of the span, then its surroundings."""
    span = text[c.begin : c.end]
    groups = [len(g) for g in _GROUP.findall(span)] or [0]
    digits = _NOT_DIGIT.sub("", span)
    before, after = text[max(0, c.begin - 40) : c.begin], text[c.end : c.end + 40]
    words = [w.lower() for w in _WORD.findall(before)][-4:]
    values = [int(g) for g in _GROUP.findall(span) if len(g) < 5]
    previous, following = before[-1:] or " ", after[:1] or " "
    marks = [span.count(s) for s in ("-", ".", " ", "/", "(", ":", "@", "[")]
    domain = re.split(r"[.\s\])}>]+", span)[-1]
    year = bool(re.search(r"(?<![0-9])(?:19|20)[0-9]{2}(?![0-9])", span))
    return [
        KINDS.index(c.kind),
        len(digits),
        len(groups),
        groups[0],
        groups[-1],
        min(groups),
        max(groups),
        len(span),
        c.run - (c.end - c.begin),
        *marks,
        span.startswith("+"),
        span.startswith("00"),
        span.startswith("("),
        luhn(digits) if 12 <= len(digits) <= 19 else -1,
        int(digits[:1] or 0),
        len(set(digits)),
        max(values, default=0) <= 255,
        max(values, default=0),
        any(g.startswith("0") and len(g) > 1 for g in _GROUP.findall(span)),
        year,
        len(domain) if c.kind == "email" else 0,
        domain.isascii() and domain.isalpha() and domain.islower(),
        " dot " in span.lower() or "[dot]" in span.lower() or "(dot)" in span.lower(),
        " at " in span.lower() or "[at]" in span.lower() or "(at)" in span.lower(),
        ". " in span or " ." in span,
        previous.isalnum(),
        previous == "=",
        previous in "#£$€",
        previous in ":\"'(<",
        following.isalnum(),
        following in "%€°",
        following in ".,;)>\"' \n",
        any(w in CUES[c.kind] for w in words),
        any(w in CUES[c.kind] for w in words[-2:]),
        any(w in OTHER for w in words),
        any(w in OTHER for w in words[-2:]),
        sum(ch.isdigit() for ch in before + after),
    ]


# --- labelled rows ---


def _digits(rng: random.Random, n: int) -> str:
    return str(rng.randrange(1, 10)) + "".join(rng.choice("0123456789") for _ in range(n - 1))


def _card_number(rng: random.Random, n: int, valid: bool) -> str:
    head = rng.choice("3456") + _digits(rng, n - 2)
    ends = [d for d in "0123456789" if luhn(head + d) == valid]
    return head + rng.choice(ends)


def _grouped(rng: random.Random, digits: str, mark: str) -> str:
    return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))


def _name(rng: random.Random) -> str:
    return rng.choice(["anna", "j.smith", "info", "mueller", "josé", "support", "müller", "garcia", "user"]) + rng.choice(["", str(rng.randrange(100))])


def _host(rng: random.Random, mark: str) -> str:
    parts = [rng.choice(["mail", "example", "web", "firma", "uni"]) + rng.choice(["", str(rng.randrange(10))]), rng.choice(["com", "de", "org", "net", "es", "fr"])]
    return mark.join([rng.choice(["mail", "mx"]), *parts] if rng.random() < 0.3 else parts)


def positive(rng: random.Random, kind: str) -> tuple[str, str]:
    """(cue or "", text of the span) that the strict patterns mostly miss."""
    cue = rng.choice(CUES[kind]) + rng.choice([" ", ": ", ":"]) if rng.random() < 0.6 else ""
    if kind == "email":
        at, dot = rng.choice([(" at ", " dot "), ("[at]", "[dot]"), (" (at) ", " (dot) "), (" [at] ", "."), ("@", "."), (" @ ", "."), (" at ", ".")])
        return cue, _name(rng) + at + _host(rng, dot)
    if kind == "ip":
        if rng.random() < 0.3:
            groups = ["%x" % rng.randrange(1, 65536) for _ in range(8)]
            return cue, ":".join(groups) if rng.random() < 0.6 else ":".join(groups[:3]) + "::" + groups[3]
        return cue, rng.choice([" . ", "[.]", " .", ". ", "(.)", " dot ", "."]).join(str(rng.randrange(256)) for _ in range(4))
    if kind == "card":
        number = _card_number(rng, rng.choice([13, 15, 16, 16, 16, 19]), True)
        mark = rng.choice(["", " ", "-", ".", "/", "  ", " - "])
        return cue, _grouped(rng, number, mark)
    a, b, c = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
    forms = [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1 {a} {b} {c}", f"00{_digits(rng, 2)} {a} {b}{c}", f"+{_digits(rng, 2)} / {a} / {b} {c}", f"0{a} / {b}{c}", f"+1 {a} {b} {c}", f"+1 ({a}) {b}-{c}"]
    if cue:
        forms += [a + b + c, f"0{a}{b}{c}", f"{a} {b} {c}"]
    return cue, rng.choice(forms)


def negative(rng: random.Random) -> str:
    """A look-alike: what is written here holds no personal data."""
    cue = rng.choice(OTHER) + rng.choice([" ", ": ", " #", "="]) if rng.random() < 0.7 else ""
    day, month, year = rng.randrange(1, 29), rng.randrange(1, 13), rng.randrange(1950, 2035)
    forms = [
        f"{year}-{month:02d}-{day:02d}",
        f"{day:02d}.{month:02d}.{year}",
        f"{year}-{month:02d}-{day:02d} {day:02d}:{month:02d}:{rng.randrange(60):02d}",
        f"{year}/{month:02d}/{day:02d} - {year + 1}/{month:02d}/{day:02d}",
        f"978-{_digits(rng, 1)}-{_digits(rng, 4)}-{_digits(rng, 4)}-{_digits(rng, 1)}",
        _digits(rng, rng.randrange(7, 20)) if cue else _digits(rng, rng.choice([8, 9, 11, 12, 14])),
        _grouped(rng, _card_number(rng, 16, False), rng.choice(["", " ", "-"])),
        f"{_digits(rng, 2)}.{_digits(rng, 6)} {_digits(rng, 2)}.{_digits(rng, 6)}",
        f"{_digits(rng, 3)} {_digits(rng, 3)} {_digits(rng, 3)} m",
        ":".join(f"{rng.randrange(60):02d}" for _ in range(4)),
        ":".join("%02x" % rng.randrange(256) for _ in range(6)),
        rng.choice([" . ", ". ", "."]).join(str(rng.choice([rng.randrange(256, 999), rng.randrange(1, 999)])) for _ in range(3)) + f".{rng.randrange(256, 999)}",
        f"v{rng.randrange(9)}.{rng.randrange(20)}.{rng.randrange(20)}-{_digits(rng, 6)}",
        f"@{_name(rng)}",
        f"{rng.randrange(1, 9)} @ {rng.randrange(1, 99)}.{rng.randrange(10, 99)}",
        f"met at {rng.choice(['home', 'work', 'noon'])}. The rest",
        f"look at {rng.choice(['it', 'that', 'them'])}.no more",
        "%032x" % rng.getrandbits(128),
        "DE" + _digits(rng, 2) + " " + _grouped(rng, _digits(rng, 18), " "),
    ]
    return cue + rng.choice(forms)


def labelled(windows: list[str], seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the candidates in windows with one planted span or look-alike each.

    A candidate is positive when it is exactly a planted or a strict span; one that only overlaps
    a planted span is negative (it is the wrong cut).  Unplanted candidates count as negative
    unless they pass a checksum, which leaves them unlabelled.
    """
    rng = random.Random(seed)
    rows, labels = [], []
    for number, window in enumerate(windows):
        cut = rng.randrange(len(window) + 1)
        while 0 < cut < len(window) and not window[cut - 1].isspace():
            cut -= 1
        planted: Span | None = None
        if rng.random() < 0.55:
            kind = KINDS[number % 4]
            cue, span = positive(rng, kind)
            begin = cut + len(cue)
            planted = (kind, begin, begin + len(span))
            span += " " + span if kind == "card" and rng.random() < 0.2 else ""
            text = window[:cut] + cue + span + rng.choice([" ", ". ", ", ", "\n"]) + window[cut:]
        else:
            text = window[:cut] + negative(rng) + " " + window[cut:]
        strict = set(base_spans(text))
        for c in candidates(text):
            key = (c.kind, c.begin, c.end)
            good = key == planted or key in strict
            if not good and planted is None and c.kind == "card" and luhn(_NOT_DIGIT.sub("", text[c.begin : c.end])):
                continue
            second = planted and c.kind == planted[0] == "card" and text[c.begin : c.end] == text[planted[1] : planted[2]]
            rows.append(features(text, c))
            labels.append(float(good or bool(second)))
    return np.array(rows, float).reshape(-1, len(features("", Candidate("ip", 0, 0)))), np.array(labels)


@dataclass
class Model:
    trees: boosting.Boosted | None
    limits: dict[str, float]
    held_out_auc: float = float("nan")
    held_out_precision: float = float("nan")
    held_out_recall: float = float("nan")


def sample_windows(docs: DataFrame, text_col: str = "text", rows: int = SAMPLE_ROWS) -> list[str]:
    """At most ``rows`` stretches of text, chosen by the hash of the stretch: the labelled rows' surroundings."""
    place = F.pmod(F.xxhash64(F.length(text_col)), F.greatest(F.length(text_col), F.lit(1)))
    piece = docs.where(F.length(text_col) > 0).select(F.substring(F.col(text_col), place.cast("int"), F.lit(WINDOW)).alias("piece"))
    chosen = piece.distinct().orderBy(F.xxhash64("piece"), "piece").limit(rows).collect()
    return [r["piece"] for r in chosen]


def fit_model(windows: list[str], precision: float = PRECISION) -> Model:
    """Trees from 60 % of the windows, calibration and thresholds from 20 %, figures from the last 20 %."""
    a, b = len(windows) * 6 // 10, len(windows) * 8 // 10
    # Each window serves several planted rows.
    rows, labels = labelled(windows[:a] * 4, 1)
    if not 0 < labels.sum() < len(labels):
        return Model(None, {})
    trees = boosting.fit(rows, labels)
    rows, labels = labelled(windows[a:b] * 4, 2)
    if not 0 < labels.sum() < len(labels):
        return Model(None, {})
    boosting.calibrate(trees, rows, labels)
    scores = trees.probability(rows)
    limits = {kind: boosting.threshold(scores[rows[:, 0] == i], labels[rows[:, 0] == i], precision) for i, kind in enumerate(KINDS)}
    rows, labels = labelled(windows[b:] * 2, 3)
    scores = trees.probability(rows) if len(rows) else np.zeros(0)
    chosen = scores >= np.array([limits[KINDS[int(k)]] for k in rows[:, 0]]) if len(rows) else np.zeros(0, bool)
    hits = float((labels * chosen).sum())
    return Model(trees, limits, boosting.auc(scores, labels), hits / max(1, chosen.sum()), hits / max(1.0, labels.sum()))


class Taken:
    """Strict spans of a text, joined where they overlap, for overlap tests by search."""

    def __init__(self, spans: list[Span]):
        self.begins: list[int] = []
        self.ends: list[int] = []
        for _, begin, end in sorted(spans, key=lambda s: s[1]):
            if self.ends and begin < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.begins.append(begin)
                self.ends.append(end)

    def touches(self, begin: int, end: int) -> bool:
        at = bisect_right(self.ends, begin)
        return at < len(self.begins) and self.begins[at] < end


def added_spans(texts: list[str], base: list[list[Span]], model: Model) -> list[list[tuple[str, int, int, float]]]:
    """Spans that the model adds: best first, none of them overlapping a strict or an added one."""
    out: list[list[tuple[str, int, int, float]]] = [[] for _ in texts]
    if model.trees is None:
        return out
    held: list[tuple[int, Candidate]] = []

    def judge() -> None:
        scores = model.trees.probability(np.array([features(texts[row], c) for row, c in held], float))
        for (row, c), p in zip(held, scores):
            if p >= model.limits[c.kind]:
                out[row].append((c.kind, c.begin, c.end, float(p)))
        held.clear()

    for row, text in enumerate(texts):
        taken = Taken(base[row])
        for c in candidates(text):
            if not taken.touches(c.begin, c.end):
                held.append((row, c))
                if len(held) == 4096:
                    judge()
    if held:
        judge()
    for row in range(len(texts)):
        best: list[tuple[str, int, int, float]] = []
        # The best candidate wins, then the longer, then the first.
        runs: list[list[tuple[str, int, int, float]]] = []
        reach = -1
        for c in sorted(out[row], key=lambda c: c[1]):
            if c[1] >= reach:
                runs.append([])
            runs[-1].append(c)
            reach = max(reach, c[2])
        for run in runs:
            mine: list[tuple[int, int]] = []
            for c in sorted(run, key=lambda c: (-round(c[3], 6), c[1] - c[2], c[1], c[0])):
                if not any(c[1] < e and b < c[2] for b, e in mine):
                    mine.append((c[1], c[2]))
                    best.append(c)
        out[row] = best
    return out


SPANS = "array<struct<kind:string,begin:int,end:int,score:double,strict:boolean>>"
_SPAN_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("strict", pa.bool_())])
)


def find_spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``found``: all spans by kind, then place; strict ones have score 1.

    A null text is empty and holds none; rows that repeat an id are answered each for itself.
    Places are code points, the end exclusive.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    order = {k: i for i, k in enumerate(KINDS)}

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        base = [base_spans(t) for t in texts]
        rows = []
        for strict, added in zip(base, added_spans(texts, base, model)):
            every = [(k, b, e, 1.0, True) for k, b, e in strict] + [(*c, False) for c in added]
            every.sort(key=lambda s: (order[s[0]], s[1]))
            rows.append([dict(zip(("kind", "begin", "end", "score", "strict"), s)) for s in every])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, _SPAN_TYPE)], names=["id", "found"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_arrow(rows, scan, f"id {kind}, found {SPANS}").withColumnRenamed("id", id_col)


def listed(spans: Column) -> Column:
    """``kind:begin:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the strict spans per kind, the digest of their list, and the list of all spans."""
    strict = F.filter("found", lambda s: s["strict"])

    def count(kind: str) -> Column:
        return F.size(F.filter(strict, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = map(count, KINDS)
    return found.select(id_col, *counts, F.sha2(listed(strict), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; where spans overlap, the union is replaced once."""
    out, done = [], 0
    for kind, begin, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if begin >= done:
            out += [text[done:begin], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]


def redacted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in its text replaced by ``[KIND]``; other columns and null texts stay."""
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    at = names.index(text_col)

    def replace(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(at).to_pylist()
        plain = [t or "" for t in texts]
        base = [base_spans(t) for t in plain]
        added = added_spans(plain, base, model)
        new = [None if t is None else redact(t, b + [c[:3] for c in more]) for t, b, more in zip(texts, base, added)]
        columns = list(batch.columns)
        columns[at] = pa.array(new, pa.string())
        return pa.RecordBatch.from_arrays(columns, names=names)

    return map_arrow(docs, replace, schema)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fit on windows of these documents and list what each document holds; an empty table gives no rows."""
    model = fit_model(sample_windows(docs, text_col))
    return digest(find_spans(docs, model, id_col, text_col), id_col)
