"""Source divergence audit: how far the sources of a language differ in their terms, by chi-square shares.

Method: every task counts the terms of its documents in byte radix tries whose leaves hold one counter per source.
Tries are mergeable: they leave the task cut into sub-tries by leading bytes, the sub-tries of one prefix range are
merged elsewhere, whatever order they come in, and a range with too many leaves is first cut deeper. Walking a
merged trie gives the terms in the order of their UTF-8 bytes; the walk feeds sums for each pair of sources and, for
each source, the leading candidates with ties in that order.

All arithmetic is in whole numbers. A term's price in a group is 1 + floor(SCALE * (count + 1) / (N + V)), N being the
group's occurrences of the V terms that its language keeps; (p - q)^2 / q, floored, is what it adds.

Work on pairs of sources grows with filled counters times sources, not with terms times pairs; one lang's matrix of
its sources, the size of its part of the result, is held by a task.

Defined cases: null texts, langs and sources are read as empty strings; empty and very long texts count like any other; rows are
documents, so repeated rows count again; ties go by the item's UTF-8 bytes; a group without terms is in the result
with price floor(SCALE / (N + V)) + 1 for every term, and value 0 where its language keeps none; an empty table
gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import gc
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attesta.llm.common import map_batches, slices, written

SCALE = 1_000_000_000
#: A term is kept with so many documents of its language.
LEAST_DOCUMENTS = 3
#: Ranks of terms that are returned for each group.
TOP_TERMS = 200
#: Leaf counters at which a task hands its tries on; leading bytes of a sub-trie; leaves at which a prefix is cut deeper.
TRIE_COUNTERS, PREFIX_BYTES, RANGE_LEAVES = 700_000, 3, 1_000_000
#: Terms of a merged piece.
PIECE_TERMS = 4096
#: Counts that wait together before they are added to a trie.
FRONT_ENTRIES = 500_000

_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


class RadixTrie:
    """Path-compressed trie of byte strings; a node is [label, children by first byte, leaf], a leaf [documents, {source: occurrences}]."""

    def __init__(self) -> None:
        self.root: list = [b"", None, None]
        self.counters = 0

    def leaf(self, term: bytes) -> list:
        """The leaf of ``term``, made if it is new."""
        node, at, end = self.root, 0, len(term)
        while at < end:
            children = node[1]
            if children is None:
                children = node[1] = {}
            child = children.get(term[at])
            if child is None:
                child = children[term[at]] = [term[at:], None, None]
                at = end
            else:
                label = child[0]
                if term.startswith(label, at):
                    at += len(label)
                else:
                    same, most = 1, min(len(label), end - at)
                    while same < most and label[same] == term[at + same]:
                        same += 1
                    child[0] = label[same:]
                    child = children[term[at]] = [label[:same], {label[same]: child}, None]
                    at += same
            node = child
        if node[2] is None:
            node[2] = [0, {}]
        return node[2]

    def add(self, term: bytes, documents: int, counts: dict) -> None:
        """Adds to the leaf of ``term``; a new leaf keeps ``counts`` itself."""
        leaf = self.leaf(term)
        leaf[0] += documents
        held = leaf[1]
        if not held:
            leaf[1] = counts
            self.counters += len(counts)
            return
        before = len(held)
        for source, n in counts.items():
            held[source] = held.get(source, 0) + n
        self.counters += len(held) - before

    def walk(self) -> Iterator[tuple[bytes, list]]:
        """Terms and leaves in byte order."""
        stack = [(b"", self.root)]
        while stack:
            before, node = stack.pop()
            term = before + node[0]
            if node[2] is not None:
                yield term, node[2]
            if node[1]:
                stack.extend((term, node[1][k]) for k in sorted(node[1], reverse=True))


#: A sub-trie in walking order: its terms (without the prefix), their documents, and the counters of each up to ``ends``.
_TRIE = [
    ("term", pa.list_(pa.binary()), "array<binary>"),
    ("documents", pa.list_(pa.int64()), "array<bigint>"),
    ("ends", pa.list_(pa.int32()), "array<int>"),
    ("leaf", pa.list_(pa.int32()), "array<int>"),
    ("count", pa.list_(pa.int64()), "array<bigint>"),
    ("sources", pa.list_(pa.string()), "array<string>"),
]


def _ddl(*head: tuple) -> str:
    return ", ".join(f"{name} {kind}" for name, _, kind in (*head, *_TRIE))


_HEAD = [("lang", pa.string(), "string"), ("prefix", pa.binary(), "binary"), ("terms", pa.int64(), "bigint")]


def _batch(fields: list[tuple], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f[1]) for k, f in enumerate(fields)], names=[f[0] for f in fields])


def _packed(leaves: list[tuple[bytes, list]]) -> tuple:
    """Columns of ``_TRIE`` for terms in byte order."""
    names: dict[str, int] = {}
    counters = [held for _, (_, held) in leaves]
    leaf = [names.setdefault(source, len(names)) for held in counters for source in held]
    return [t for t, _ in leaves], [d for _, (d, _) in leaves], list(accumulate(map(len, counters))), leaf, [n for held in counters for n in held.values()], list(names)


def _read(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[dict]:
    """Rows as dictionaries; lists are cut out of whole columns, as converting each cell by itself takes several times as long."""
    for batch in slices(batches, rows):
        columns = []
        for name, column in zip(batch.schema.names, batch.columns):
            if isinstance(column, pa.ListArray):
                flat, ends = column.flatten(), column.value_lengths().to_numpy().cumsum().tolist()
                values = flat.to_numpy().tolist() if pa.types.is_integer(flat.type) else flat.to_pylist()
                columns.append([values[at:end] for at, end in zip([0, *ends], ends)])
            else:
                columns.append(column.to_pylist())
        for row in zip(*columns):
            yield dict(zip(batch.schema.names, row))


def _unpacked(row: dict) -> Iterator[tuple[bytes, int, dict]]:
    names, leaf, counts, at = row["sources"], row["leaf"], row["count"], 0
    for term, documents, end in zip(row["term"], row["documents"], row["ends"]):
        if end == at + 1:
            yield term, documents, {names[leaf[at]]: counts[at]}
        else:
            yield term, documents, {names[s]: n for s, n in zip(leaf[at:end], counts[at:end])}
        at = end


#: Sub-tries of one task, each of the terms with its leading bytes, which it holds without them.
Forest = dict[tuple[str, bytes], RadixTrie]


def _add(forest: Forest, lang: str, depth: int, term: bytes, documents: int, counts: dict) -> int:
    """Adds to the sub-trie of ``term``; returns how many counters are new."""
    place = lang, term[:depth]
    trie = forest.get(place)
    if trie is None:
        trie = forest[place] = RadixTrie()
    before = trie.counters
    trie.add(term[depth:], documents, counts)
    return trie.counters - before


def _rows(forest: Forest) -> Iterator[tuple]:
    for (lang, prefix), trie in forest.items():
        leaves = list(trie.walk())
        yield lang, prefix, len(leaves), *_packed(leaves)


@contextmanager
def _no_cycles() -> Iterator[None]:
    """Millions of small containers, none in a cycle: the collector would only look through them again and again."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def _batches_of(fields: list[tuple], rows: Iterator[tuple], most: int = 256) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield _batch(fields, held)
            held = []
    if held:
        yield _batch(fields, held)


class _Front:
    """Counts that wait for the tries: a term that comes often is added to its language's trie once for many documents."""

    def __init__(self) -> None:
        self.occurrences: dict[tuple[str, str], Counter] = {}
        self.documents: dict[str, Counter] = {}

    def add(self, lang: str, source: str, text: bytes) -> None:
        terms = text.translate(_PLAIN).split()
        self.occurrences.setdefault((lang, source), Counter()).update(terms)
        self.documents.setdefault(lang, Counter()).update(set(terms))

    def entries(self) -> int:
        return sum(map(len, self.occurrences.values()))

    def into(self, forest: Forest, depth: int) -> int:
        """Moves all counts to ``forest``; returns how many counters are new there."""
        new = 0
        for lang, documents in self.documents.items():
            counts: dict[bytes, dict] = {term: {} for term in documents}
            for (of, source), found in self.occurrences.items():
                if of == lang:
                    for term, n in found.items():
                        counts[term][source] = n
            for term, held in counts.items():
                new += _add(forest, lang, depth, term, documents[term], held)
        self.__init__()
        return new


def local_tries(docs: DataFrame, depth: int = PREFIX_BYTES, counters: int = TRIE_COUNTERS) -> DataFrame:
    """Sub-tries of each task's documents; ``docs`` has lang, source and text without nulls."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest: Forest = {}
        front, held = _Front(), 0
        with _no_cycles():
            for batch in slices(batches):
                for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.large_binary()).to_pylist()):
                    front.add(lang, source, text)
                if front.entries() >= FRONT_ENTRIES:
                    held += front.into(forest, depth)
                    if held >= counters:
                        yield from _batches_of([*_HEAD, *_TRIE], _rows(forest))
                        forest, held = {}, 0
            front.into(forest, depth)
            yield from _batches_of([*_HEAD, *_TRIE], _rows(forest))

    return map_batches(docs.select("lang", "source", "text"), count, _ddl(*_HEAD))


def _deeper(depth: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for row in _read(batches):
                forest: Forest = {}
                for term, documents, counts in _unpacked(row):
                    _add(forest, row["lang"], depth, row["prefix"] + term, documents, counts)
                yield from _rows(forest)

        yield from _batches_of([*_HEAD, *_TRIE], rows())

    return cut


def split_ranges(tries: DataFrame, depth: int = PREFIX_BYTES, most: int = RANGE_LEAVES) -> DataFrame:
    """Sub-tries none of whose prefixes has more than ``most`` leaves in all, unless it is one term."""
    done = []
    while True:
        size = tries.groupBy("lang", "prefix").agg(F.sum("terms").alias("leaves"), F.max("terms").alias("largest"))
        heavy = written(size.where((F.col("leaves") > most) & (F.col("largest") > 1)).select("lang", "prefix"), "heavy")
        if heavy.isEmpty():
            break
        done.append(tries.join(heavy, ["lang", "prefix"], "left_anti"))
        depth *= 2
        tries = written(map_batches(tries.join(heavy, ["lang", "prefix"], "left_semi").select(*tries.columns), _deeper(depth), tries.schema), "deeper")
    for part in done:
        tries = tries.unionByName(part)
    return tries


_SUMS = [("sums", pa.list_(pa.int64()), "array<bigint>")]


def merged_tries(tries: DataFrame, least: int = LEAST_DOCUMENTS, piece: int = PIECE_TERMS) -> DataFrame:
    """Merged pieces of the kept terms with their occurrences by source; a task holds the terms of one prefix at a time."""
    head = [_HEAD[0], _HEAD[2], *_SUMS]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces(lang: str, leaves: list) -> Iterator[tuple]:
            for at in range(0, len(leaves), piece):
                packed = _packed(leaves[at : at + piece])
                sums = np.zeros(len(packed[5]), np.int64)
                np.add.at(sums, packed[3], packed[4])
                yield lang, len(packed[0]), sums.tolist(), *packed

        def kept(trie: RadixTrie, prefix: bytes) -> list:
            return [(prefix + term, leaf) for term, leaf in trie.walk() if leaf[0] >= least]

        def rows() -> Iterator[tuple]:
            at, trie, leaves = None, RadixTrie(), []
            for row in _read(batches):
                place = row["lang"], row["prefix"]
                if place != at:
                    if at is not None:
                        leaves.extend(kept(trie, at[1]))
                        if at[0] != place[0] or len(leaves) >= piece:
                            yield from pieces(at[0], leaves)
                            leaves = []
                    at, trie = place, RadixTrie()
                for term, documents, counts in _unpacked(row):
                    trie.add(term, documents, counts)
            if at is not None:
                yield from pieces(at[0], [*leaves, *kept(trie, at[1])])

        with _no_cycles():
            yield from _batches_of([*head, *_TRIE], rows(), 16)

    return map_batches(tries.repartition("lang", "prefix").sortWithinPartitions("lang", "prefix"), merge, _ddl(*head))


def prices(counts: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (counts + 1) / total) without leaving 64 bits, for totals up to 9 * 10^15."""
    left = counts + 1
    whole = left // total
    left = left - whole * total
    for _ in range(3):
        left = left * 1000
        step = left // total
        left = left - step * total
        whole = whole * 1000 + step
    return whole + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class _Best:
    """The ``most`` first (value, term) by falling value, then term."""

    def __init__(self, most: int) -> None:
        self.most, self.held = most, []

    def add(self, values: np.ndarray, terms: list[bytes], at: np.ndarray) -> None:
        if len(self.held) >= self.most:
            fit = values >= -self.held[-1][0]
            values, at = values[fit], at[fit]
        if len(values) > self.most:
            fit = values >= np.partition(values, len(values) - self.most)[len(values) - self.most]
            values, at = values[fit], at[fit]
        if len(values):
            self.held = sorted(self.held + [(-v, terms[k]) for v, k in zip(values.tolist(), at.tolist())])[: self.most]


class _Audit:
    """Sums of pairs and best terms of one language over the pieces that a task sees."""

    def __init__(self, row: dict, top: int) -> None:
        self.lang, self.names = row["lang"], row["all_sources"]
        self.index = {s: k for k, s in enumerate(self.names)}
        totals = np.array(row["totals"], np.int64)
        self.totals, self.total = totals + row["kept"], int(totals.sum()) + row["kept"]
        self.zero = prices(np.zeros(len(totals), np.int64), self.totals)
        self.apart = distance(self.zero[:, None], self.zero[None, :])
        self.sums = np.zeros((len(totals), len(totals)), np.int64)
        self.best = [_Best(top) for _ in totals]

    def add(self, row: dict) -> None:
        ends = np.array(row["ends"], np.int64)
        owner = np.repeat(np.arange(len(ends)), np.diff(np.append(0, ends)))
        source = np.array([self.index[s] for s in row["sources"]], np.int64)[np.array(row["leaf"], np.int64)]
        counts = np.zeros((len(ends), len(self.names)), np.int64)
        counts[owner, source] = row["count"]
        price, base = prices(counts, self.totals[None, :]), prices(counts.sum(axis=1), self.total)
        terms = row["term"]
        self.sums += len(ends) * self.apart
        for s in range(len(self.names)):
            held = np.flatnonzero(counts[:, s])
            own = price[held, s]
            # terms that s has and the other group lacks, then, for the terms of s as a group, the difference to that
            self.sums[:, s] += distance(self.zero[:, None], own[None, :]).sum(axis=1) - len(held) * self.apart[:, s]
            other = price[held]
            self.sums[s] += (distance(own[:, None], other) - distance(self.zero[s], other)).sum(axis=0)
            above = held[own > base[held]]
            self.best[s].add(distance(price[above, s], base[above]), terms, above)

    def rows(self) -> Iterator[tuple]:
        for g, source in enumerate(self.names):
            for s, item in enumerate(self.names):
                if s != g:
                    yield self.lang, source, "pair", item, int(self.sums[g, s])
            for value, term in self.best[g].held:
                yield self.lang, source, "term", term.decode(), -value


_RESULT = [("lang", pa.string(), "string"), ("source", pa.string(), "string"), ("part", pa.string(), "string"), ("item", pa.string(), "string"), ("value", pa.int64(), "bigint")]


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS, depth: int = PREFIX_BYTES, most: int = RANGE_LEAVES) -> DataFrame:
    """(lang, source, part, item, value, rank): the other sources of each group and the terms that it has more of."""
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in (("lang", lang), ("source", source), ("text", text))))
    tries = split_ranges(written(local_tries(docs, depth), "tries"), depth, most)
    merged = written(merged_tries(tries, least), "merged")
    occurrences = merged.select("lang", F.explode(F.arrays_zip("sources", "sums")).alias("x")).groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.sums").alias("n"))
    groups = written(docs.select("lang", "source").distinct().join(occurrences, ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n")), "groups")
    # one short row for each language and share of its pieces, so that no task gets all pieces of a language
    known = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("g")).join(merged.groupBy("lang").agg(F.sum("terms").alias("kept")), "lang")
    shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    totals = known.select("lang", "kept", F.col("g.source").alias("all_sources"), F.col("g.n").alias("totals"), F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"))
    pieces = merged.withColumn("share", F.pmod(F.hash(F.get("term", F.lit(0))), F.lit(shares)))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            now = None
            for row in _read(batches, 16):
                if now is None or now.lang != row["lang"]:
                    if now is not None:
                        yield from now.rows()
                    now = _Audit(row, top)
                now.add(row)
            if now is not None:
                yield from now.rows()

        yield from _batches_of(_RESULT, rows(), 4096)

    found = written(map_batches(pieces.join(totals, ["lang", "share"]).drop("share"), compare, ", ".join(f"{n} {k}" for n, _, k in _RESULT)), "compared")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    sums = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    others = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    pairs = others.join(sums, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    terms = found.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.unionByName(terms)
