"""Near-duplicates by SimHash fingerprints and a Gray-order hierarchical index.

Fingerprints: 64 bits over shingles of three words, each hashed by XXH64 with seed 42; a bit is set if
it is set in over half of the hashes. Fingerprints that differ in at most RADIUS bits are linked.

Index: fingerprints within the radius agree on one of RADIUS + 1 blocks of bits, so there is a forest for
each block, its words turned to have that block first. Words are grouped into runs by their leading bits,
as many as give runs of about CELL / 4; Gray rank keeps a run together, as its leading bits follow from
the word's leading bits. A run is sorted by Gray rank. FANOUT neighbours share a node that holds the bits
alike in all its members, FANOUT such nodes share a node above, up to the top. The run is joined with itself from
the top: a pair of nodes is left, with all pairs below it, as soon as the differences on bits that both
hold come to more than the radius, or to any at all inside the leading block (another forest has those).
Only a tree of each component is emitted, never all pairs of a group.

Equal fingerprints are folded first. A run of more than CELL words is split: first by its whole leading
block, then by agreement on one of RADIUS + 1 blocks of the remaining bits, RADIUS + 1 copies a level;
what is left after DEPTH levels is dealt over pairs of cells of about CELL words, so no task gets an
unbounded run and all pairs still meet. Components of the edges come from alternating large-star and
small-star steps; each step is written to the shared folder, so lineage stays short and lost executors
cost a task. Joins on hot fingerprints have one row a fingerprint on the other side and rely on adaptive
execution to split them.

Defined cases: null and empty texts have no shingles and fingerprint zero, linked like any other;
texts of one or two words have one shingle, the whole sequence; keys may repeat (each row is
returned); a null key never becomes a component's name, and a component of null keys has a null name;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.llm.common import free_name, map_batches, remove_table, slices, until_done, write_table, written

SHINGLE, SEED, RADIUS = 3, 42, 3
#: Words of a run that are compared in one piece, and how often a larger one is split before it is dealt over pairs of cells.
CELL, DEPTH = 4096, 3
#: Neighbours in Gray order under one node, at each level.
FANOUT = 16
#: Hashes, and pairs of nodes, that are held at a time.
_CHUNK, _PAIRS = 1 << 15, 1 << 10


def words(text: str | None) -> list[bytes]:
    """Words of the text with A-Z in lower case; they end at space, tab, newline, \\v, \\f and \\r only."""
    return (text or "").encode().lower().split()


def fingerprint(text: str | None, size: int = SHINGLE, seed: int = SEED) -> int:
    from xxhash import xxh64_intdigest

    found = words(text)
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(found) - size + 1)
    starts, ends = starts[:n].tolist(), ends[min(size, len(found)) - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        hashes = np.array([xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK])], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp): fingerprints as signed 64-bit numbers; narrow, whole texts."""
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("fp", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["key", "fp"])

    return map_batches(docs.select(F.col(key).alias("key"), F.col(text)), run, schema)


# ---------------------------------------------------------------- index


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each 64-bit word in the reflected Gray sequence."""
    x = x.astype(np.uint64)
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


class GrayTree:
    """Distinct words in Gray order under levels of nodes that hold the bits alike in all their members."""

    def __init__(self, words: np.ndarray, lead: int = 0) -> None:
        self.order = np.argsort(gray_rank(words), kind="stable")
        self.words = words[self.order]
        self.lead = np.uint64(((1 << lead) - 1) << (64 - lead))
        self.compared = 0  # pairs of words
        ones, some = self.words, self.words
        #: (bits set in all, mask of bits alike in all), words first
        self.levels: list[tuple[np.ndarray, np.ndarray]] = [(ones, ~(ones ^ some))]
        while len(ones) > FANOUT:
            cuts = np.arange(0, len(ones), FANOUT)
            ones, some = np.bitwise_and.reduceat(ones, cuts), np.bitwise_or.reduceat(some, cuts)
            self.levels.append((ones, ~(ones ^ some)))

    def pairs(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (i, j), i < j, of all words within the radius that agree on the leading bits, in batches."""
        top = len(self.levels) - 1
        n = len(self.levels[top][0])
        stack = [(top, *np.triu_indices(n, k=int(top == 0)))]
        while stack:
            level, i, j = stack.pop()
            if len(i) > _PAIRS:
                stack += [(level, i[at : at + _PAIRS], j[at : at + _PAIRS]) for at in range(0, len(i), _PAIRS)]
                continue
            ones, mask = self.levels[level]
            apart = (ones[i] ^ ones[j]) & mask[i] & mask[j]
            near = (np.bitwise_count(apart) <= radius) & (apart & self.lead == 0)
            i, j = i[near], j[near]
            if not level:
                self.compared += len(near)
                if len(i):
                    yield i, j
            elif len(i):
                n = len(self.levels[level - 1][0])
                below = np.arange(FANOUT)
                i, j = np.broadcast_arrays((i[:, None] * FANOUT + below)[:, :, None], (j[:, None] * FANOUT + below)[:, None, :])
                real = (i < n) & (j < n) & ((i < j) if level == 1 else (i <= j))
                stack.append((level - 1, i[real], j[real]))

    def trees(self, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(words, their roots) by place in the order given: a star for each component of the pairs."""
        root = np.arange(len(self.words))
        for i, j in self.pairs(radius):
            while len(i):
                a, b = root[i], root[j]
                open_ = a != b
                i, j, a, b = i[open_], j[open_], a[open_], b[open_]
                np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
                while (up := root[root]).tolist() != root.tolist():
                    root = up
        told = np.flatnonzero(root != np.arange(len(root)))
        return self.order[told], self.order[root[told]]


def _linked(radius: int):
    """Rows (path, node, pair, lead, word, fp) that lie together by the first three, to edges (a, b)."""

    def edges(lead: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch | None:
        words, first = np.unique(np.concatenate([w for w, _ in parts]).view(np.uint64), return_index=True)
        if len(words) < 2:
            return None
        fps = np.concatenate([f for _, f in parts])[first]
        a, b = GrayTree(words, lead).trees(radius)
        return pa.RecordBatch.from_arrays([pa.array(fps[a]), pa.array(fps[b])], names=["a", "b"]) if len(a) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, lead, parts = None, 0, []
        for batch in batches:
            if not batch.num_rows:
                continue
            path, node, pair, leads, word, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(6))
            starts = np.flatnonzero(np.r_[True, (path[1:] != path[:-1]) | (node[1:] != node[:-1]) | (pair[1:] != pair[:-1])]).tolist()
            for at, end in zip(starts, [*starts[1:], len(fp)]):
                name = (int(path[at]), int(node[at]), int(pair[at]))
                if name != now:
                    if parts and (found := edges(lead, parts)):
                        yield found
                    now, lead, parts = name, int(leads[at]), []
                parts.append((word[at:end], fp[at:end]))
        if parts and (found := edges(lead, parts)):
            yield found

    return run


def _shift(direction: str, value: Column, bits: Column) -> Column:
    return F.call_function(direction, value, bits.cast("int"))


def _lowest(bits: Column) -> Column:
    """A number with that many low bits set, for 0 to 63."""
    return _shift("shiftleft", F.lit(1).cast("long"), bits) - 1


def _front(rows: DataFrame, radius: int) -> DataFrame:
    """A copy of each row for each of radius + 1 blocks of the bits behind the leading ones, that block moved up behind them."""
    rest = F.lit(64) - F.col("lead")
    edge = [F.floor(rest * c / (radius + 1)).cast("int") for c in range(radius + 2)]
    tail = F.when(F.col("lead") == 0, F.col("word")).otherwise(F.col("word").bitwiseAND(_lowest(rest % 64)))
    kept = F.col("word").bitwiseXOR(tail)
    copies = []
    for c in range(radius + 1):
        # the first c blocks go behind the others
        turned = tail if c == 0 else _shift("shiftleft", tail.bitwiseAND(_lowest(rest - edge[c])), edge[c]).bitwiseOR(_shift("shiftrightunsigned", tail, rest - edge[c]))
        copies.append(F.struct((F.col("path") * (radius + 2) + (c + 1)).alias("path"), (F.col("lead") + edge[c + 1] - edge[c]).alias("lead"), kept.bitwiseOR(turned).alias("word")))
    return rows.select("fp", F.explode(F.array(*copies)).alias("c")).select("fp", "c.path", "c.lead", "c.word")


def _placed(rows: DataFrame, bits: Column) -> DataFrame:
    """Rows with the value of their first ``bits`` bits as node."""
    return rows.withColumn("node", F.when(bits == 0, F.lit(0).cast("long")).otherwise(_shift("shiftrightunsigned", F.col("word"), (F.lit(64) - bits) % 64)))


def links(distinct: DataFrame, radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """(a, b): edges whose components are those of all links among the distinct fingerprints ``fp``."""
    most = distinct.count()
    bits = max(0, math.ceil(math.log2(4 * most / cell))) if most else 0
    fresh = distinct.select("fp", F.lit(0).cast("long").alias("path"), F.lit(0).alias("lead"), F.col("fp").alias("word"))
    rows = _placed(_front(fresh, radius), F.least(F.lit(bits), F.col("lead")))
    columns = ["path", "node", "lead", "word", "fp"]
    ready: list[DataFrame] = []
    for depth in range(DEPTH + 1):
        hot = written(rows.groupBy("path", "node").agg(F.count("*").alias("n")).where(F.col("n") > cell), "hot-runs")
        if hot.isEmpty():
            ready.append(rows.select(*columns, F.lit(0).cast("long").alias("pair")))
            break
        ready.append(rows.join(hot, ["path", "node"], "left_anti").select(*columns, F.lit(0).cast("long").alias("pair")))
        large = rows.join(hot, ["path", "node"])
        if depth == DEPTH:
            cells = F.ceil(F.col("n") / cell)
            mine = F.pmod(F.xxhash64("fp"), cells)
            # a cell meets every cell, itself included, in the pair named by the two
            pairs = F.transform(F.sequence(F.lit(0).cast("long"), cells - 1), lambda c: F.least(c, mine) * cells + F.greatest(c, mine))
            ready.append(large.select(*columns, F.explode(pairs).alias("pair")))
        elif depth == 0:  # the whole leading block, no copies
            rows = _placed(large.drop("node", "n"), F.col("lead"))
        else:
            rows = _placed(_front(large.drop("node", "n"), radius), F.col("lead"))
    placed = reduce(DataFrame.unionByName, ready).select("path", "node", "pair", "lead", "word", "fp")
    return map_batches(placed.repartition("path", "node", "pair").sortWithinPartitions("path", "node", "pair"), _linked(radius), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every end of an edge: the least number that its component holds."""
    now, path = write_table(edges.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()  # one row
        if tuple(state) == seen:
            until_done(lambda: remove_table(now.sparkSession, path))
            return now.select(F.col("hi").alias("v"), F.col("lo").alias("root")).unionAll(now.select(F.col("lo").alias("v"), F.col("lo").alias("root")).distinct())
        seen = tuple(state)
        both = now.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionAll(now.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).where("lo <> hi").distinct()
        small = large.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        next_ = large.join(small, large["hi"] == small["u"]).select("lo", "hi", "m")
        before = path
        now, path = write_table(next_.select(F.col("m").alias("lo"), F.col("lo").alias("hi")).where("lo <> hi").unionAll(next_.select(F.col("m").alias("lo"), "hi")).distinct(), "edges")
        remove_table(now.sparkSession, before)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """(key, fingerprint, component_id) for each row: 16 hex digits and the least key that links reach.

    What the lazy result reads stays until the innermost ``scratch`` or the process ends.
    """
    # read twice below, so kept on executors' disks; a lost block is computed again from the documents
    fps = fingerprints(docs, key, text).persist(StorageLevel.DISK_ONLY)
    until_done(fps.unpersist)
    groups = written(fps.groupBy("fp").agg(F.min("key").alias("rep")), "fingerprints")
    roots = components(links(groups, radius))
    rooted = groups.join(roots, groups["fp"] == roots["v"], "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = rooted.select("fp", "root").join(names, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(F.col("key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: the one with the least key, then the least hash of its text; null keys come last.

    Columns keep their names and order. A row is told by its key and its text's hash, so unrelated texts
    under one key, null included, are kept apart; of rows alike in both one stays, any of them if other
    columns differ. Keys are compared by their text form.
    """
    named, hashed = F.col(f"`{key}`"), F.xxhash64(F.col(f"`{text}`"))
    rows = docs.select(F.struct(named.isNull().alias("gone"), named.alias("k"), hashed.alias("h")).alias("row"), F.col(f"`{text}`").alias("text"))
    told = lambda k, h: {kept[0]: k.isNull(), kept[1]: F.coalesce(k.cast("string"), F.lit("")), kept[2]: h}
    kept = [free_name(docs, n) for n in ("kept_null", "kept_key", "kept_hash")]
    least = near_duplicates(rows, "row", "text", radius).where(F.col("row").eqNullSafe(F.col("component_id"))).select("row.*").distinct()
    least = least.select(*[c.alias(n) for n, c in told(F.col("k"), F.col("h")).items()])
    # folded before the join, so that a row repeated many times is one before it moves
    single = docs.withColumns(told(named, hashed)).dropDuplicates(kept)
    return single.join(least, kept).select(*[F.col(f"`{c}`") for c in docs.columns])
