"""Benchmark decontamination by SimHash of item-sized windows.

A benchmark item of L words is held against windows of L words of a document. Which windows: an item's
shingles are ordered from rare to common among items, and the rarest whose weight comes to over
1 - SIMILARITY of the item are its leads. A window without any lead has a similarity below SIMILARITY, so
only windows over a lead are fingerprinted; nothing else is left out. Leads are found in two steps. A bitmap
of LEAD_BITS bits, the same size for any benchmark, travels with the tasks: a document that holds none
of its bits is done after one narrow pass. The rest, with the leads they may hold, meet the items in joins
on lead and text, so neither benchmark nor documents go to the driver or have to fit a task.

Fingerprints have LANES x 64 bits, each the majority of that bit over the window's shingles, from running
sums. A multi-index of BLOCKS parts of PART bits guarantees all items within RADIUS bits: one part at least is
within RADIUS // BLOCKS, and only pairs that have such a part are compared in full. Pairs within the radius are verified
exactly: the weight of common shingles, repeats counted, over the weight of the item must reach
SIMILARITY. At similarity 0.8 about 52 of 256 bits are expected to differ, with deviation 6.5, so RADIUS lies
four deviations above. Shingles have five words, those of shorter items all their words.

Defined cases: words are split at white space and compared in lower case (A-Z); null and wordless
items match nothing; documents shorter than an item are one window; null texts have no windows; items
alike in id and words are one, of several texts under one id the best counts, a null id is an id of
its own; ties between windows go to the earliest; documents may repeat, each row is returned or dropped
by its own text; without items nothing matches; an empty table gives an empty result; clashing names of
other columns don't matter.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from attesta.llm.common import free_name, map_batches, slices, written

SHINGLE, SIMILARITY = 5, 0.8
#: 64-bit lanes of a fingerprint, bits by which fingerprints may differ, parts of the multi-index and their bits.
LANES, RADIUS, BLOCKS, PART = 4, 78, 8, 32
#: Standard deviations by which an item's radius goes beyond the bits expected of the most unlike window.
SPREADS = 5
#: Bits of the bitmap of leads, 8 MB.
LEAD_BITS = 1 << 26
#: Items that a text is verified against at a time, words whose hashes a worker keeps, windows and pairs of fingerprints in memory.
CHUNK, KEPT, AT_ONCE, _PAIRS = 256, 1 << 17, 2048, 1 << 18


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


class _Hashes(dict):
    """Hashes of words; starts afresh once it holds KEPT."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= KEPT:
            self.clear()
        self[word] = found = xxh64_intdigest(word)
        return found


_HASHES = _Hashes()


def word_hashes(text: str | None) -> np.ndarray:
    found = words(text)
    return np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))


def _mix(ids: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all runs of ``size`` words; runs of different sizes don't meet."""
    n = max(0, len(ids) - size + 1)
    h = np.full(n, size, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            h = (h ^ (ids[k : k + n] + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(31)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(29))


def _bits(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of the lanes drawn from each hash."""
    lanes = np.empty((len(hashes), LANES), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(LANES):
            lane = (hashes + np.uint64(k) * np.uint64(0xD1B54A32D192ED03)) * np.uint64(0xAEF17502108EF2D9)
            lane ^= lane >> np.uint64(32)
            lane *= np.uint64(0x9FB21C651E98DF25)
            lanes[:, k] = lane ^ (lane >> np.uint64(29))
    return np.unpackbits(lanes.view(np.uint8), axis=1, bitorder="little").astype(np.int32) * 2 - 1


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    """(windows, parts of PART bits)."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u4")


class MultiIndex:
    """Every fingerprint within the radius of a query, by parts of PART bits."""

    def __init__(self, fps: np.ndarray, radius: int | np.ndarray = RADIUS) -> None:
        #: One radius, or one for each member.
        self.fps, self.radius = fps, np.broadcast_to(np.asarray(radius), len(fps))
        self.near = self.radius // BLOCKS
        self.seen = self.met = 0  # pairs offered, and pairs compared in full

    def search(self, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(queries, members) of all pairs within the radius, by chunks of queries."""
        step = max(1, _PAIRS // max(1, len(self.fps)))
        for at in range(0, len(queries), step):
            mine = queries[at : at + step]
            some = np.zeros((len(mine), len(self.fps)), bool)
            for b in range(BLOCKS):
                some |= np.bitwise_count(mine[:, b, None] ^ self.fps[None, :, b]) <= self.near
            q, k = np.nonzero(some)
            self.seen, self.met = self.seen + some.size, self.met + len(q)
            close = np.bitwise_count(mine[q] ^ self.fps[k]).sum(1, dtype=np.int32) <= self.radius[k]
            yield q[close] + at, k[close]


def radius(item: Counter) -> int:
    """Bits by which a window without repeated shingles and of similarity SIMILARITY may differ from ``item`` (weights of shingles).

    A bit is the sign of a sum of weights with random signs; two such sums differ in it with probability arccos(r) / pi, r being their
    correlation. That is least when the window lacks the heaviest shingles. SPREADS standard deviations of the number of bits are added.
    """
    weights = np.sort(np.fromiter(item.values(), np.int64, len(item)))
    total = int(weights.sum())
    kept = int(np.ceil(total * SIMILARITY - 1e-6))
    if kept > len(weights):
        return 0  # no window without repeats is as like as that
    worst = float(weights[:kept].sum()) / np.sqrt(float((weights * weights).sum()) * total)
    p, bits = float(np.arccos(min(1.0, worst))) / np.pi, 64 * LANES
    return min(bits, int(np.ceil(bits * p + SPREADS * np.sqrt(bits * p * (1 - p)))))


def _earlier(hashes: np.ndarray) -> np.ndarray:
    """The place before each at which the same shingle stood, or -1."""
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    out = np.full(len(hashes), -1)
    out[order[1:][same]] = order[:-1][same]
    return out


def _repeating(earlier: np.ndarray, starts: np.ndarray, span: int) -> np.ndarray:
    """Which windows hold a shingle twice: a shingle in them stood before at or after their start."""
    first, stop = int(starts[0]), min(len(earlier), int(starts[-1]) + span)
    # the least start from which the windows up to each place are free of repeats only grows
    free = np.maximum.accumulate(earlier[first:stop])
    return free[np.minimum(starts + span, stop) - first - 1] >= starts


class Items:
    """Benchmark items, as (id, shingle length, shingle hashes, leads), ready to be sought in a text."""

    def __init__(self, items: list[tuple[object, int, np.ndarray, np.ndarray]]) -> None:
        by_size: dict[tuple[int, int], list] = defaultdict(list)
        for name, q, hashes, leads in items:
            by_size[len(hashes), q].append((name, hashes, leads))
        self.sizes = []
        for (span, q), group in by_size.items():
            shingles = [Counter(h.tolist()) for _, h, _ in group]
            index = MultiIndex(_fingerprints(np.stack([_bits(h).sum(0) for _, h, _ in group])), np.array([radius(c) for c in shingles]))
            known = np.unique(np.concatenate([leads for _, _, leads in group]))
            self.sizes.append((span, q, [name for name, _, _ in group], shingles, index, known, [leads for _, _, leads in group]))

    def search(self, text: str | None) -> list[tuple[object, float, int]]:
        """(item, similarity, first word) of each item that a window of the text holds; the best window, then the earliest."""
        ids = word_hashes(text)
        hashes: dict[int, np.ndarray] = {}
        best: dict[object, tuple[float, int]] = {}
        for span, q, names, shingles, index, known, leads in self.sizes:
            mine = hashes.setdefault(q, _mix(ids, q))
            if not len(mine):
                continue
            earlier = _earlier(mine)
            place = np.minimum(np.searchsorted(known, mine), len(known) - 1)
            hits = np.flatnonzero(known[place] == mine)
            last = max(0, len(mine) - span)
            reach = [(min(max(0, p - span + 1), last), min(p, last)) for p in hits.tolist()]
            own: dict[int, np.ndarray] | None = None
            for a, b in _merged(reach):
                for starts, fps in _windows(mine, span, a, b):
                    # a repeated shingle outweighs the others in a fingerprint: such windows are compared in full
                    full = _repeating(earlier, starts, span)
                    met: dict[int, list[int]] = defaultdict(list)
                    for w, k in index.search(fps[~full]):
                        for s, item in zip(starts[~full][w].tolist(), k.tolist()):
                            met[item].append(s)
                    if full.any():
                        some = starts[full]
                        if own is None:  # where each item's own leads stand; a window without one isn't like it
                            lead = mine[hits]
                            own = {k: found for k, those in enumerate(leads) if len(found := hits[np.isin(lead, those)])}
                        for item, found in own.items():
                            first = found[np.minimum(np.searchsorted(found, some), len(found) - 1)]
                            met[item] += some[(first >= some) & (first < some + span)].tolist()
                    for k, those in met.items():
                        for similarity, s in _similarities(mine, span, shingles[k], those):
                            now = best.get(names[k], (0.0, 0))
                            if similarity >= SIMILARITY and (similarity, -s) > (now[0], -now[1]):
                                best[names[k]] = (similarity, s)
        return sorted(((name, sim, s) for name, (sim, s) in best.items()), key=lambda x: (x[2], str(x[0])))


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, overlapping and neighbouring ones as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _windows(hashes: np.ndarray, span: int, first: int, last: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(starts, fingerprints) of all windows that start from ``first`` to ``last``, AT_ONCE at a time."""
    for at in range(first, last + 1, AT_ONCE):
        starts = np.arange(at, min(last + 1, at + AT_ONCE))
        stop = min(len(hashes), int(starts[-1]) + span)
        sums = np.concatenate([np.zeros((1, 64 * LANES), np.int32), np.cumsum(_bits(hashes[at:stop]), axis=0, dtype=np.int32)])
        yield starts, _fingerprints(sums[np.minimum(starts - at + span, stop - at)] - sums[starts - at])


def _similarities(hashes: np.ndarray, span: int, item: Counter, starts: list[int]) -> Iterator[tuple[float, int]]:
    """(similarity, start) of the windows; counts slide from one start to the next where they overlap."""
    total, low, high, common = item.total(), 0, 0, 0
    held: Counter = Counter()
    for s in sorted(starts):
        stop = min(len(hashes), s + span)
        if s >= high:
            held.clear()
            low = high = s
            common = 0
        for x in hashes[low:s].tolist():
            if x in item:
                common -= held[x] <= item[x]
                held[x] -= 1
        for x in hashes[high:stop].tolist():
            if x in item:
                held[x] += 1
                common += held[x] <= item[x]
        low, high = s, stop
        yield common / total, s


# ---------------------------------------------------------------- tables


def item_shingles(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item, q, hashes, code): the shingle hashes of each item, q words a shingle; items alike in id and words are one."""
    schema = T.StructType([T.StructField("item", benchmark.schema[key].dataType), T.StructField("q", T.IntegerType(), False), T.StructField("hashes", T.ArrayType(T.LongType(), False), False)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(ids := word_hashes(body)):
                    q = min(SHINGLE, len(ids))
                    rows.append((name, q, _mix(ids, q).view(np.int64)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    found = map_batches(benchmark.select(F.col(key).alias("item"), F.col(text)), run, schema)
    return found.distinct().withColumn("code", F.xxhash64("item", F.col("item").isNull(), "hashes"))


def leads(items: DataFrame) -> DataFrame:
    """(code, q, h): the rarest shingles of each item, by the items that hold them, whose weight comes to over 1 - SIMILARITY."""
    held = items.select("code", "q", F.explode("hashes").alias("h")).groupBy("code", "q", "h").agg(F.count("*").alias("weight"))
    rare = held.join(held.groupBy("h").agg(F.count("*").alias("items")), "h")
    w = Window.partitionBy("code").orderBy("items", "h")
    before = F.coalesce(F.sum("weight").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("weight").over(Window.partitionBy("code"))
    # a margin of one part in a million, so that rounding can only add a lead
    return rare.select("code", "q", "h", before.alias("before"), total.alias("total")).where(F.col("before") <= F.col("total") * (1 - SIMILARITY + 1e-6)).select("code", "q", "h")


def _bitmap(found: DataFrame) -> np.ndarray:
    """The leads' bits as 64-bit words; what reaches the driver has at most LEAD_BITS / 64 rows of 16 bytes."""
    bit = F.col("h").bitwiseAND(F.lit(LEAD_BITS - 1))
    rows = found.select(F.shiftright(bit, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
    got = rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(LEAD_BITS // 64, np.uint64)
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return out


class _Leads:
    """The bitmap in a worker, with the shingle lengths of the items."""

    def __init__(self, bitmap: np.ndarray, lengths: list[int]) -> None:
        self.bitmap, self.lengths = bitmap, lengths

    def hits(self, text: str | None) -> list[tuple[int, int]]:
        """Distinct (q, hash) of the text that may be leads."""
        if not text:
            return []
        ids, out = word_hashes(text), []
        for q in self.lengths:
            mine = _mix(ids, q)
            bit = mine & np.uint64(LEAD_BITS - 1)
            on = self.bitmap[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)
            out += [(q, x) for x in np.unique(mine[on == 1]).view(np.int64).tolist()]
        return out


class _Search:
    """The steps that ``find_contamination`` and ``drop_contaminated`` share."""

    def __init__(self, docs: DataFrame, text: str, benchmark: DataFrame, item_key: str, item_text: str) -> None:
        self.docs, self.text, self.place = docs, text, docs.columns.index(text)
        self.items = written(item_shingles(benchmark, item_key, item_text), "items")
        self.leads = written(leads(self.items), "leads")
        lengths = [r["q"] for r in self.leads.select("q").distinct().orderBy("q").collect()]  # SHINGLE rows at most
        self.sent = docs.sparkSession.sparkContext.broadcast(_Leads(_bitmap(self.leads), lengths))
        self.one, self.two, self.hits = (free_name(docs, n) for n in ("text_hash", "text_hash_2", "hits"))

    def suspects(self) -> DataFrame:
        """Written: the documents that may hold a lead, with two hashes of the text and the leads."""
        place, sent, name = self.place, self.sent, self.hits
        body = F.col(f"`{self.text}`")
        schema = T.StructType([*self.docs.schema.fields, T.StructField(self.hits, T.ArrayType(T.StructType([T.StructField("q", T.IntegerType()), T.StructField("h", T.LongType())])))])
        kind = to_arrow_schema(schema).field(self.hits).type

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                found = [sent.value.hits(t) for t in batch.column(place).to_pylist()]
                held = pa.array([bool(f) for f in found], pa.bool_())
                made = pa.array([[{"q": q, "h": h} for q, h in f] for f in found if f], kind)
                yield pa.RecordBatch.from_arrays([*batch.filter(held).columns, made], names=[*batch.schema.names, name])

        return written(map_batches(self.docs, run, schema).withColumns({self.one: F.xxhash64(body), self.two: F.xxhash64(body, F.lit(1))}), "suspects")

    def clear(self) -> DataFrame:
        """The documents that hold no bit of any lead; narrow."""
        place, sent = self.place, self.sent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                yield batch.filter(pa.array([not sent.value.hits(t) for t in batch.column(place).to_pylist()], pa.bool_()))

        return map_batches(self.docs, run, self.docs.schema)

    def matches(self, suspects: DataFrame, item_type: T.DataType) -> DataFrame:
        """(text hashes, item, similarity, first_word) of the texts that hold an item, a row for each text and item."""
        at = [self.one, self.two]
        met = suspects.select(*at, F.explode(self.hits).alias("x")).select(*at, "x.q", "x.h").distinct().join(self.leads, ["q", "h"]).select(*at, "code").distinct()
        many = met.groupBy(*at).agg(F.count("*").alias("n"))
        asked = met.join(many, at).join(self.items, "code").withColumn("chunk", F.pmod(F.xxhash64("item"), F.ceil(F.col("n") / CHUNK)))
        rarest = self.leads.groupBy("code").agg(F.collect_list("h").alias("leads"))
        groups = asked.join(rarest, "code").groupBy(*at, "chunk").agg(F.collect_list(F.struct("item", "q", "hashes", "leads")).alias("items"))
        texts = suspects.select(*at, F.col(f"`{self.text}`").alias("text")).dropDuplicates(at)
        schema = T.StructType([T.StructField(self.one, T.LongType()), T.StructField(self.two, T.LongType()), T.StructField("item", item_type), T.StructField("similarity", T.DoubleType(), False), T.StructField("first_word", T.LongType(), False)])
        arrow = to_arrow_schema(schema)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 16):
                rows = []
                for one, two, text, items in zip(*(c.to_pylist() for c in batch.columns)):
                    known = Items([(x["item"], x["q"], np.array(x["hashes"], np.int64).view(np.uint64), np.array(x["leads"], np.int64).view(np.uint64)) for x in items])
                    rows += [(one, two, *f) for f in known.search(text)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

        return map_batches(groups.join(texts, at).select(*at, "text", "items"), run, schema)


def find_contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item, similarity, first_word): a row for each document and item that a window of it holds."""
    search = _Search(docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")), "text", benchmark, item_key, item_text)
    suspects = search.suspects()
    at = [search.one, search.two]
    found = suspects.select("key", *at).join(search.matches(suspects, benchmark.schema[item_key].dataType), at)
    return found.select(F.col("key").alias(key), F.col("item").alias(item_key), "similarity", "first_word")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows of ``docs`` that hold no item, with all their columns. Rows without a lead never move; of the others, those whose text matched go."""
    search = _Search(docs, text, benchmark, item_key, item_text)
    suspects = search.suspects()
    at = [search.one, search.two]
    bad = search.matches(suspects, benchmark.schema[item_key].dataType).select(*at).distinct()
    kept = suspects.join(bad, at, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    return search.clear().unionAll(kept)
