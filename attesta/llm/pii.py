"""Personal data by a semi-Markov conditional random field over candidate segments.

Text is looked at only around digits and at-signs. Each such region is cut into tokens; a segment of
up to MAX_TOKENS tokens is scored as a whole (shape, digit counts, check digit, neighbours, the word
before), and a dynamic program with that bound picks boundaries and types jointly. The model is fitted
by maximum likelihood on regions composed from fixed templates. Fixed patterns give the base spans:
they enter the program as certain segments and are always returned; the model adds spans that touch
none of them, such as a number in national form or a masked address.

Kinds: email, ip, card, phone. Offsets are code points, the end exclusive.

Defined cases: a null text counts as empty (no spans); keys may be null or repeated, rows are never
merged; all patterns run in time linear in the text; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import random
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.llm.common import map_batches, slices

KINDS = ("email", "ip", "card", "phone")
ORDER = {k: n for n, k in enumerate(KINDS)}
#: The longest segment, in tokens.
MAX_TOKENS = 20

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[@0-9]+|\(at\)|\[at\]")
_MASKED = re.compile(r"(?:\(at\)|\[at\]) ?[\w-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[\w-]++)*+")
_SPACE = re.compile(r"\s")
_NUMBERS = re.compile(r"[0-9]+")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|\s+|[^\sA-Za-z0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = ord(d) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, leftmost and non-overlapping within each kind."""
    out: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            out.append(("email", start, end))
            at = text.find("@", end)
        else:
            at = text.find("@", at + 1)
    for m in _DOTTED.finditer(text):  # within a chain, each four numbers in turn are a match
        parts, start = m[0].split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            stop = start + sum(map(len, four)) + 3
            if all(map(_octet, four)):
                out.append(("ip", start, stop))
            start = stop + 1
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


# ---------------------------------------------------------------- segments


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches of chunks that hold a digit or at-sign (masked ones too), joined over single spaces; whole chunks, however long."""
    out: list[tuple[int, int]] = []
    done = 0
    for m in _TRIGGER.finditer(text):
        if m.end() <= done:
            continue
        start, end = m.start(), m.end()
        if text[start] in "([":  # a masked at-sign may stand between spaces
            if start > done and text[start - 1] == " ":
                start -= 1
            if masked := _MASKED.match(text, m.start()):
                end = masked.end()
        while start > done and not text[start - 1].isspace():  # each character is passed once
            start -= 1
        space = _SPACE.search(text, end)
        end = space.start() if space else len(text)
        if out and start - out[-1][1] <= 1:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
        done = end
    return out


def _bucket(n: int, edges: tuple[int, ...]) -> int:
    return sum(n >= e for e in edges)


#: Words that announce a kind; fixed values.
CUES = {
    "email": "mail email e-mail contact write reach",
    "ip": "ip host server address addr node",
    "card": "card visa credit cc account pan",
    "phone": "phone tel telephone call mobile fax cell",
}
_CUE = {word: kind for kind, words in CUES.items() for word in words.split()}
_MAILISH = re.compile(r"[\w.%+-]+ ?(?:@|\(at\)|\[at\]) ?[\w-]+(?: ?(?:\.|\(dot\)|\[dot\]) ?[\w-]+)+")


def features(text: str, start: int, end: int) -> list[str] | None:
    """Features of a whole segment; None if it can't be an entity."""
    s = text[start:end]
    first, last = s[0], s[-1]
    if not (first.isalnum() or first in "+(") or not last.isalnum():
        return None
    n_digits, dots = sum(map(s.count, "0123456789")), s.count(".")
    mail = "@" in s or "at" in s and _MAILISH.fullmatch(s) is not None
    if not (mail or n_digits >= 7 or dots == 3 and n_digits >= 4):
        return None
    letters = sum(map(str.isalpha, s))
    before = re.search(r"([A-Za-z-]+)[\s:.]*$", text[max(0, start - 24) : start])
    quad = s.split(".") if dots == 3 else []
    out = [
        "bias",
        f"turns{_bucket(len(_NUMBERS.findall(s)), (2, 3, 4, 5, 6))}{int(letters > 0)}",
        f"equals{int('=' in s)}",
        f"digits{_bucket(n_digits, (1, 4, 7, 9, 10, 11, 12, 14, 15, 16, 17, 20))}",
        f"letters{_bucket(letters, (1, 4))}",
        f"marks{_bucket(dots + s.count('(') + s.count(')') + s.count('-'), (1, 2, 3, 4))}",
        f"spaces{_bucket(s.count(' '), (1, 2, 4))}",
        f"start{first if first in '+(' else 'd' if first.isdigit() else 'a'}",
        f"cue {_CUE.get(before[1].lower(), '-') if before else '-'}",
        f"mail{int(mail and _MAILISH.fullmatch(s) is not None)}{int('@' in s)}",
        f"quad{int(len(quad) == 4 and all(q.isdigit() and _octet(q) for q in quad))}",
        f"luhn{int(12 <= n_digits <= 19 and not letters and luhn(''.join(_NUMBERS.findall(s))))}",
    ]
    if not letters:
        shape = _NUMBERS.sub(lambda m: str(min(len(m[0]), 9)), s)
        if len(shape) <= 20:
            out.append(f"shape {shape}")
    if start and (text[start - 1].isalnum() or text[start - 1] in ".+-_@("):
        out.append("cut left")
    if end < len(text) and (text[end].isalnum() or text[end] in "-_@" or text[end] in ".)" and end + 1 < len(text) and text[end + 1].isalnum()):
        out.append("cut right")
    return out


class Lattice:
    """The tokens of a region and its candidate segments."""

    def __init__(self, text: str, start: int, end: int) -> None:
        self.text = text
        self.cuts = [start, *(m.end() for m in _TOKEN.finditer(text, start, end))]
        self.n = len(self.cuts) - 1

    def outside(self, j: int) -> str:
        """The feature of token j - 1 where it stands outside all segments."""
        t = self.text[self.cuts[j - 1] : self.cuts[j]]
        return "o " + ("@" if "@" in t else "digits" if t.isdigit() else "other")

    def ending(self, j: int) -> list[tuple[int, list[str]]]:
        """(first token, features) of the candidate segments that end with token j - 1."""
        out = []
        for i in range(max(0, j - MAX_TOKENS), j):
            if (f := features(self.text, self.cuts[i], self.cuts[j])) is not None:
                out.append((i, f))
        return out


class Model:
    """Weights of (feature, kind) for segments and of feature for tokens outside."""

    def __init__(self) -> None:
        self.inside: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(KINDS)))
        self.outside: dict[str, float] = defaultdict(float)

    def segment(self, found: list[str]) -> np.ndarray:
        """Scores of a segment by kind."""
        zero = np.zeros(len(KINDS))
        return sum((self.inside.get(x, zero) for x in found), zero)

    def best(self, lattice: Lattice) -> list[tuple[int, int, int]]:
        """(from token, to token, kind) of the best segmentation; of equal ones, that with fewer segments, then the longer last one.

        Candidates are scored as the program reaches their end, so memory grows with tokens, not candidates.
        """
        top, back = [0.0] + [-np.inf] * lattice.n, [None] * (lattice.n + 1)
        for j in range(1, lattice.n + 1):
            top[j] = top[j - 1] + self.outside.get(lattice.outside(j), 0.0)
            for i, f in lattice.ending(j):
                s = self.segment(f)
                k = int(np.argmax(s))
                if top[i] + s[k] > top[j]:
                    top[j], back[j] = top[i] + s[k], (i, j, k)
        found, j = [], lattice.n
        while j:
            if back[j]:
                found.append(back[j])
                j = back[j][0]
            else:
                j -= 1
        return found[::-1]

    def learn(self, cases: list[tuple[Lattice, set[tuple[int, int, int]]]], rounds: int, rate: float, decay: float) -> None:
        """Gradient ascent on the log likelihood: observed less expected feature counts."""
        known = [([lattice.ending(j) for j in range(lattice.n + 1)], [lattice.outside(j) for j in range(1, lattice.n + 1)]) for lattice, _ in cases]
        for r in range(rounds):
            step = rate / (1 + 0.3 * r)
            for (lattice, gold), (ending, outer) in zip(cases, known):
                seg = [[(i, self.segment(f), f) for i, f in e] for e in ending]
                out = [self.outside.get(o, 0.0) for o in outer]
                n = lattice.n
                a, b = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
                a[0] = b[n] = 0.0
                total = [[np.logaddexp.reduce(s) for _, s, _ in e] for e in seg]
                for j in range(1, n + 1):
                    a[j] = np.logaddexp.reduce([a[j - 1] + out[j - 1], *(a[i] + t for (i, _, _), t in zip(seg[j], total[j]))])
                for j in range(n, 0, -1):
                    b[j - 1] = np.logaddexp(b[j - 1], b[j] + out[j - 1])
                    for (i, _, _), t in zip(seg[j], total[j]):
                        b[i] = np.logaddexp(b[i], b[j] + t)
                z = a[n]
                covered = {t for i, j, _ in gold for t in range(i, j)}
                for j in range(1, n + 1):
                    p = np.exp(a[j - 1] + out[j - 1] + b[j] - z)
                    self.outside[outer[j - 1]] += step * (float(j - 1 not in covered) - p)
                    for i, s, f in seg[j]:
                        g = -np.exp(a[i] + s + b[j] - z)
                        for k in range(len(KINDS)):
                            g[k] += (i, j, k) in gold
                        for x in f:
                            self.inside[x] += step * g
            for x in self.inside:
                self.inside[x] *= 1 - decay


def _digits(r: random.Random, n: int) -> str:
    return str(r.randint(1, 9)) + "".join(str(r.randint(0, 9)) for _ in range(n - 1))


def _card(r: random.Random, n: int, valid: bool) -> str:
    body = r.choice("3456") + _digits(r, n - 2)
    return next(body + str(d) for d in range(10) if luhn(body + str(d)) == valid)


def _hex(r: random.Random, n: int) -> str:
    return "".join(r.choice("0123456789abcdef") for _ in range(n))


def _word(r: random.Random) -> str:
    return "".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4)))


def sample(r: random.Random) -> tuple[str, list[Span]]:
    """A text composed from templates, and its spans."""
    parts: list[tuple[str, str | None]] = []
    for _ in range(r.randint(1, 2)):
        kind = r.choice(["email", "ip", "card", "phone", None, None, None])
        if r.random() < 0.25 and kind:
            parts.append((r.choice(CUES[kind].split()) + r.choice([":", ""]), None))
        else:
            parts += [(_word(r), None) for _ in range(r.randint(1, 2))]
        if kind == "email":
            user = _word(r) + r.choice(["", f".{_digits(r, 2)}", f"_{_word(r)}", f"+{_word(r)}"])
            host = [_word(r), *([f"mail{r.randint(0, 9)}"] * r.randint(0, 1)), r.choice(["com", "org", "net", "de", "example"])]
            at, dot = r.choice([("@", ".")] * 4 + [("(at)", "."), ("[at]", "."), (" (at) ", " (dot) "), (" [at] ", " [dot] ")])
            span = user + at + dot.join(host)
        elif kind == "ip":
            span = ".".join(str(r.randint(0, 255)) for _ in range(4))
        elif kind == "card":
            n = _card(r, r.choice([12, 13, 15, 16, 16, 16, 19]), True)
            span = r.choice([n, " ".join(n[k : k + 4] for k in range(0, len(n), 4)), "-".join(n[k : k + 4] for k in range(0, len(n), 4))])
        elif kind == "phone":
            a, b, c = _digits(r, 3), _digits(r, 3), _digits(r, 4)
            span = r.choice([f"+1 ({a}) {b}-{c}", f"+1 {a} {b} {c}", f"+{_digits(r, 2)} {_digits(r, 3)} {_digits(r, 6)}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"1-{a}-{b}-{c}", f"+1{a}{b}{c}"])
        else:
            y, m, d = r.randint(1950, 2050), r.randint(1, 12), r.randint(1, 28)
            span = r.choice([f"{r.randint(0, 9)}.{r.randint(0, 9)}", f"{y}-{m:02}-{d:02}", f"{d}/{m}/{y}", _card(r, r.choice([12, 15, 16, 16, 19]), False), _digits(r, r.choice([7, 8, 9, 10, 11, 13, 20, 24])), f"{r.randint(256, 999)}.{r.randint(0, 255)}.{r.randint(0, 255)}.{r.randint(256, 999)}", f"@{_word(r)}", f"{_digits(r, 3)},{_digits(r, 3)},{_digits(r, 3)}", f"{_word(r)}{_digits(r, 8)}{_word(r)}", f"{y}{m:02}{d:02}-{_digits(r, 6)}", f"{_digits(r, 3)} {_digits(r, 4)} {_digits(r, 2)}", f"{_digits(r, 18)}{_word(r)[0]}{_digits(r, 3)}", *[_hex(r, r.randint(12, 40)) for _ in range(3)], f"{_word(r)}={_hex(r, r.randint(10, 40))}", f"{_word(r)}:{_digits(r, r.randint(7, 16))}", "".join(r.choice("ABCDEFGHIJ0123456789") for _ in range(20))])
        parts += [(span, kind), (_word(r) + r.choice(["", ".", ","]), None)]
    text, spans = "", []
    for s, kind in parts:
        if text:
            text += " "
        if kind:
            spans.append((kind, len(text), len(text) + len(s)))
        text += s
    return text, spans


@lru_cache(maxsize=1)
def fitted(cases: int = 1200, rounds: int = 10, seed: int = 7) -> dict:
    """Weights after fitting on ``cases`` composed texts; the same on every machine."""
    r, made = random.Random(seed), []
    while len(made) < cases:
        text, spans = sample(r)
        for start, end in regions(text):
            lattice = Lattice(text, start, end)
            place = {c: k for k, c in enumerate(lattice.cuts)}
            gold = {(place[a], place[b], ORDER[k]) for k, a, b in spans if a in place and b in place and (place[b] > place[a])}
            if all(i in {first for first, _ in lattice.ending(j)} for i, j, _ in gold):
                made.append((lattice, gold))
    model = Model()
    model.learn(made, rounds, 0.3, 0.002)
    return {"inside": dict(model.inside), "outside": dict(model.outside)}


def loaded(weights: dict) -> Model:
    model = Model()
    model.inside, model.outside = weights["inside"], weights["outside"]
    return model


def all_spans(text: str, model: Model) -> tuple[list[Span], list[Span]]:
    """(base spans, base and added spans), each by start, then kind."""
    base = base_spans(text)
    taken: list[list[int]] = []  # base spans of all kinds as stretches that don't overlap
    for a, b in sorted((a, b) for _, a, b in base):
        if taken and a <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], b)
        else:
            taken.append([a, b])
    added: list[Span] = []
    first = 0
    for start, end in regions(text):
        while first < len(taken) and taken[first][1] <= start:
            first += 1
        # base spans are certain segments: the program runs over what lies between them
        free, at, k = [], start, first
        while k < len(taken) and taken[k][0] < end:
            if taken[k][0] > at:
                free.append((at, taken[k][0]))
            at, k = max(at, taken[k][1]), k + 1
        if at < end:
            free.append((at, end))
        for a, b in free:
            if b - a >= 5:  # no entity is shorter
                lattice = Lattice(text, a, b)
                added += [(KINDS[kind], lattice.cuts[i], lattice.cuts[j]) for i, j, kind in model.best(lattice)]
    by = lambda s: (s[1], ORDER[s[0]])
    return sorted(base, key=by), sorted(base + added, key=by)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, base, spans) for each row: comma-joined kind:start:end of the base spans and of all spans; narrow, no shuffle."""
    weights = fitted()
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("base", T.StringType(), False), T.StructField("spans", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(weights)
        for batch in slices(batches):
            found = [all_spans(t or "", model) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([joined(b) for b, _ in found], pa.string()), pa.array([joined(s) for _, s in found], pa.string())], names=["key", "base", "spans"])

    return map_batches(docs.select(F.col(key).alias("key"), F.col(text)), run, schema).withColumnRenamed("key", key)
