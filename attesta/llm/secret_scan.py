"""Secrets: an Aho-Corasick keyword prefilter, anchored patterns near hits, checksum validation.

One automaton finds every keyword of a text in a single pass over its lower-cased letters. Patterns
are matched only at the places it reports. Tokens that carry a checksum are reported only if it holds.
Runs of hexadecimal digits have no keyword; every STEP-th character is probed, and as a run of twice
that length holds two neighbouring probes, its pattern is matched only where two are digits.

Base kinds: assign, access, hex. Added kind: checksum, tokens of the public form prefix_ + 30 random
characters + 6 characters of base-62 CRC32 (prefixes in CHECKSUM_PREFIXES). Offsets are code points,
the end exclusive.

Defined cases: a null text counts as empty (no spans); keys may be null or repeated, rows are never
merged; an empty table gives an empty result; other columns are not read (``redact`` keeps them).
``redact`` writes marks that no pattern matches and goes on until nothing is found, so redacting again
changes nothing.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.llm.common import free_name, map_batches, slices

KINDS = ("assign", "access", "hex", "checksum")
ORDER = {k: n for n, k in enumerate(KINDS)}
BASE = frozenset(KINDS[:3])
#: Keywords of assignments and prefixes of keys and checksummed tokens; fixed values.
ASSIGN_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS_PREFIX = "AKIA"
CHECKSUM_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_CHECKSUM = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z_])")
#: Distance of probes for hexadecimal runs: half their least length.
STEP = 16
_PROBES = re.compile(r"[0-9a-f]{2,}")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

Span = tuple[str, int, int]


@lru_cache(maxsize=1)
def automaton():
    """Keywords by kind; built once in a worker."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for kind, words in (("assign", ASSIGN_KEYWORDS), ("access", (ACCESS_PREFIX.lower(),)), ("checksum", CHECKSUM_PREFIXES)):
        for w in words:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


def checksum62(body: str) -> str:
    """CRC32 of ``body`` in base 62, six characters."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = BASE62[d] + out
    return out


def hex_runs(text: str) -> list[Span]:
    """Runs of at least 2 x STEP hexadecimal digits, matched only around neighbouring probes that are digits."""
    out: list[Span] = []
    for m in _PROBES.finditer(text[STEP - 1 :: STEP]):
        # the probes before and after are none, so no run reaches beyond them
        low, high = m.start() * STEP, (m.end() + 1) * STEP - 1
        out += [("hex", r.start(), r.end()) for r in _HEX.finditer(text, low, high)]
    return out


def spans(text: str) -> list[Span]:
    """All spans by start, then kind. Within a kind they are leftmost and non-overlapping; a match that fails its check is dropped with what it covers."""
    folded = text.lower()
    if len(folded) != len(text):  # a letter that grows in lower case would shift offsets
        folded = text.translate(_LOWER)
    out: list[Span] = []
    ends = dict.fromkeys(KINDS, 0)
    for last, (kind, n) in automaton().iter(folded):
        start = last - n + 1
        if start < ends[kind]:
            continue
        if kind == "assign":
            if m := _ASSIGN.match(text, start):
                ends[kind] = m.end()
                if m.end() - m.start(1) >= 8:
                    out.append((kind, start, m.end()))
        elif kind == "access":
            if m := _ACCESS.match(text, start):
                ends[kind] = m.end()
                if m.end() - start >= 16:
                    out.append((kind, start, m.end()))
        elif m := _CHECKSUM.match(text, start):
            ends[kind] = m.end()
            if checksum62(m[1]) == m[2]:
                out.append((kind, start, m.end()))
    out += hex_runs(text)
    out.sort(key=lambda s: (s[1], ORDER[s[0]]))
    return out


def joined(found: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, base, spans) for each row: comma-joined kind:start:end of the base kinds and of all; narrow, no shuffle."""
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("base", T.StringType(), False), T.StructField("spans", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [spans(t) if t else [] for t in batch.column(1).to_pylist()]
            base = [joined([s for s in f if s[0] in BASE]) for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, pa.string()), pa.array(map(joined, found), pa.string())], names=["key", "base", "spans"])

    return map_batches(docs.select(F.col(key).alias("key"), F.col(text)), run, schema).withColumnRenamed("key", key)


def redacted(text: str, mark: str = "<redacted {kind}>") -> str:
    """``text`` with each covered stretch replaced by ``mark`` of its first span's kind, until no span is left.

    A second pass is needed where a stretch hid the start of a further secret. ``mark`` must hold no secret.
    """
    while found := spans(text):
        out, at = [], 0
        for kind, a, b in found:
            if a >= at:
                out += [text[at:a], mark.format(kind=kind)]
            at = max(at, b)
        text = "".join([*out, text[at:]])
    return text


def redact(docs: DataFrame, text: str = "text", mark: str = "<redacted {kind}>") -> DataFrame:
    """``docs`` with secrets in ``text`` replaced; every row and column stays, null texts stay null."""
    if any(spans(mark.format(kind=kind)) for kind in KINDS):
        raise ValueError(f"the mark {mark!r} is a secret itself")
    place = docs.columns.index(text)
    marked = free_name(docs, "redacted")
    schema = T.StructType([*docs.schema.fields, T.StructField(marked, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = [redacted(t, mark) if t else t for t in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, marked])

    cleaned = map_batches(docs, run, schema)
    return cleaned.select(*[F.col(f"`{marked}`").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
