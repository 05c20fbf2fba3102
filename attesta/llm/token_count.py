"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut at the special strings of the vocabulary, which count one token each, then into
pre-tokens. A pre-token starts as a linked list of byte symbols; a heap holds its adjacent pairs by
merge rank and position, and the lowest is popped until none is left. The count is the number of
initial symbols less the merges done; no identifier is emitted. Words repeat, so each worker keeps
the counts of recent words up to a fixed number.

A vocabulary whose special strings strip white space or match whole words only is refused.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); rows are never merged; an empty
table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.llm.common import map_batches, slices

#: Words whose counts a worker keeps; beyond that it starts afresh.
KEPT_WORDS = 400_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the rest take the letters from U+0100 on, in order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Merger:
    """Counts the tokens of byte strings under an ordered list of merges."""

    def __init__(self, merges: list[tuple[str, str]]) -> None:
        letters = byte_letters()
        number = {letter: k for k, letter in enumerate(letters)}  # a byte's symbol is its value
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(merges):
            made = number.setdefault(left + right, len(number))
            self.ranks.setdefault((number[left], number[right]), (rank, made))

    def count(self, word: bytes) -> int:
        n = len(word)
        if n < 2:
            return n
        ranks = self.ranks.get
        symbol = list(word)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = []
        for k in range(n - 1):
            if found := ranks((symbol[k], symbol[k + 1])):
                heap.append((found[0], k, found[1], symbol[k], symbol[k + 1]))
        heapq.heapify(heap)
        left = n
        while heap:
            _, k, made, a, b = heapq.heappop(heap)
            nxt = after[k]
            # stale unless both symbols still stand where the pair was seen
            if symbol[k] != a or nxt >= n or symbol[nxt] != b:
                continue
            left -= 1
            symbol[k], symbol[nxt] = made, -1
            after[k] = follow = after[nxt]
            if follow < n:
                before[follow] = k
                if found := ranks((made, symbol[follow])):
                    heapq.heappush(heap, (found[0], k, found[1], made, symbol[follow]))
            prior = before[k]
            if prior >= 0 and (found := ranks((symbol[prior], made))):
                heapq.heappush(heap, (found[0], prior, found[1], symbol[prior], made))
        return left


@lru_cache(maxsize=2)
def load(path: str) -> tuple[Merger, tuple[str, ...]]:
    """The merger of a byte-level vocabulary file and its special strings."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    added = model.get("added_tokens") or []
    if any(t.get(flag) for t in added for flag in ("lstrip", "rstrip", "single_word")):
        raise ValueError("special strings that take white space with them or stand for whole words only are not supported")
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["model"]["merges"]]
    return Merger(merges), tuple(t["content"] for t in added)


class Counter:
    """Counts the tokens of texts; one per worker."""

    def __init__(self, path: str, pattern: str, kept: int = KEPT_WORDS) -> None:
        import regex

        self.merger, specials = load(path)
        self.split = regex.compile(pattern).findall
        self.special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.kept, self.known = kept, {}

    def __call__(self, text: str) -> int:
        total, parts = 0, [text]
        if self.special is not None and self.special.search(text):
            parts = self.special.split(text)
            total = len(parts) - 1
        known, count = self.known, self.merger.count
        for part in parts:
            for word in self.split(part):
                n = known.get(word)
                if n is None:
                    n = count(word.encode())
                    if len(known) >= self.kept:
                        known.clear()
                    if len(word) < 64:
                        known[word] = n
                total += n
        return total


@lru_cache(maxsize=1)
def _counter(path: str, pattern: str) -> Counter:
    return Counter(path, pattern)


def token_counts(docs: DataFrame, vocabulary: str, pattern: str, limit: int = 512, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) for each row of ``docs``; a narrow pass without a shuffle."""
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("n_bytes", T.LongType(), False), T.StructField("n_tokens", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(vocabulary, pattern)
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(map(count, texts), pa.int64())], names=["key", "n_bytes", "n_tokens"])

    counted = map_batches(docs.select(F.col(key).alias("key"), F.col(text)), run, schema)
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
