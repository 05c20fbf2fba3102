"""Runs of repeated words: every maximal stretch of a text that goes on with one period.

Method (runs theorem): the longest Lyndon word at a position ends before the next smaller value of the inverse
suffix array, or the next greater one under the opposite order. Each such word is the root of at most one run;
it is extended both ways by longest common extensions, which are range minima of the LCP array (sparse table)
of the text and of the reversed text. Texts are laid end to end with symbols of their own, so one suffix
array serves many short texts and no run crosses two.

A narrow pass without a shuffle. Memory is that of ``CHUNK_WORDS`` words or of one longer text, n log n numbers.

Defined cases: a null or empty text has no words and no runs, its collapsed text is empty; a very long text
is one piece, never cut; a null key stays null; repeated rows each get their result; ties between runs
(same length, start) are separate runs, told apart by period; an empty table gives an empty result; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.llm.common import map_batches, slices

#: Least length of a run in words (and never less than two periods).
LEAST = 12
#: Words that are sorted together.
CHUNK_WORDS = 1 << 17


def _minima(a: np.ndarray, longest: int) -> list[np.ndarray]:
    """Sparse table: level k holds the minima of 2^k neighbours; windows over the end are left out."""
    table, width = [a], 1
    while 2 * width <= min(longest, len(a)):
        table.append(np.minimum(table[-1][:-width], table[-1][width:]))
        width *= 2
    return table


class Suffixes:
    """Inverse suffix array, LCP array and its range minima, for strings that share no symbol and end in one of their own."""

    def __init__(self, symbols: np.ndarray, longest: int) -> None:
        n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        first = np.empty(n, bool)
        first[:1] = True
        np.not_equal(symbols[order[1:]], symbols[order[:-1]], out=first[1:])
        heads = np.flatnonzero(first)
        sizes = np.diff(np.append(heads, n))
        rank = np.empty(n, np.int64)
        rank[order] = np.repeat(heads, sizes)
        # prefix doubling; a suffix that is told from all others drops out
        levels, width, active = [rank.astype(np.int32)], 1, order[np.repeat(sizes, sizes) > 1]
        while len(active):
            key = rank[active] * n + rank[active + width]
            by = np.argsort(key)
            active, key = active[by], key[by]
            old = rank[active]
            index = np.arange(len(active))
            change = np.empty(len(active), bool)
            change[0] = True
            np.not_equal(old[1:], old[:-1], out=change[1:])
            group = np.maximum.accumulate(np.where(change, index, 0))
            np.not_equal(key[1:], key[:-1], out=change[1:])
            head = np.maximum.accumulate(np.where(change, index, 0))
            rank[active] = old + head - group
            levels.append(rank.astype(np.int32))
            sizes = np.diff(np.append(np.flatnonzero(change), len(active)))
            active = active[np.repeat(sizes, sizes) > 1]
            width *= 2
        self.rank = levels[-1]
        places = np.empty(n, np.int64)
        places[rank] = np.arange(n)
        self.minima = _minima(self._neighbours(levels, places[:-1], places[1:]), longest)

    @staticmethod
    def _neighbours(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common length of each pair of neighbours, from the doubled ranks."""
        common = np.zeros(len(a), np.int32)
        equal, held = [], np.arange(len(a))
        for level in levels:
            held = held[level[a[held]] == level[b[held]]]
            if not len(held):
                break
            equal.append(held)
        for k in range(len(equal) - 1, -1, -1):
            longer = equal[k + 1] if k + 1 < len(equal) else held[:0]
            at = common[longer]
            more = longer[levels[k][a[longer] + at] == levels[k][b[longer] + at]]
            common[more] += 1 << k
            fresh = equal[k][common[equal[k]] == 0]
            common[fresh] = 1 << k
        return common

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common extension of different places ``a`` and ``b`` of one string."""
        ra, rb = self.rank[a], self.rank[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        found = np.empty(len(low), np.int32)
        for k in np.unique(level).tolist():
            of = np.flatnonzero(level == k)
            found[of] = np.minimum(self.minima[k][low[of]], self.minima[k][high[of] - (1 << k)])
        return found


def _next_smaller(a: np.ndarray, longest: int) -> np.ndarray:
    """For each place the next with a smaller value, at most ``longest`` further on; the length of ``a`` if there is none."""
    n = len(a)
    table = _minima(a, longest + 1)
    found = np.arange(1, n + 1)
    open_ = np.flatnonzero(a[1:] > a[:-1]) if n else found
    at, value = open_ + 1, a[open_]
    for k in range(len(table) - 1, -1, -1):
        inside = np.flatnonzero(at < len(table[k]))
        jump = inside[table[k][at[inside]] > value[inside]]
        at[jump] += 1 << k
    found[open_] = at
    return found


def runs_of(codes: np.ndarray, lengths: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, start, length and period of every run, ordered by document, start and period.

    ``codes`` numbers the words of all documents, one after the other; ``lengths`` counts them.
    """
    count, longest = len(lengths), int(lengths.max(initial=0))
    none = np.zeros(0, np.int64)
    if longest < least:
        return none, none, none, none
    document = np.repeat(np.arange(count), lengths)
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = starts + lengths
    symbols = np.empty(len(codes) + count, np.int64)
    width = int(codes.max()) + 2
    place = np.arange(len(codes)) + document
    symbols[ends] = np.arange(count) * width
    symbols[place] = document * width + codes + 1
    forward = Suffixes(symbols, longest + 1)
    rank = forward.rank
    # roots under both orders; a text's end is below its words in one and above them in the other
    end = ends[document]
    roots = [(place, np.minimum(_next_smaller(order, longest + 1)[place], end)) for order in (rank, -rank)]
    i, j = (np.concatenate(side) for side in zip(*roots))
    # of a run's roots the first starts less than a period into the run, so it must reach this far
    same = np.flatnonzero(symbols[i] == symbols[j])
    i, j = i[same], j[same]
    period = j - i
    ahead = forward.common(i, j).astype(np.int64)
    wanted = np.maximum(least, 2 * period) - period - ahead
    begin = starts[np.searchsorted(ends, i)]
    back = np.maximum(wanted, 1)
    fit = np.flatnonzero((wanted < period) & ((wanted <= 0) | ((i - wanted >= begin) & (symbols[i - back] == symbols[j - back]) & (symbols[i - 1] == symbols[j - 1]))))
    i, j, period, ahead, begin = i[fit], j[fit], period[fit], ahead[fit], begin[fit]
    if not len(i):
        return none, none, none, none
    # extension to the left: the same on the reversed texts of the documents that still have candidates
    chosen = np.zeros(count, bool)
    chosen[np.searchsorted(ends, i)] = True
    kept = np.repeat(chosen, lengths + 1)
    position = np.cumsum(kept) - 1
    part = symbols[kept]
    mirrored = Suffixes(np.append(part[-2::-1], part[-1]), longest + 1)
    behind = np.zeros(len(i), np.int64)
    inner = np.flatnonzero(i > begin)
    flip = len(part) - 2
    behind[inner] = mirrored.common(flip - position[i[inner] - 1], flip - position[j[inner] - 1])
    length = behind + period + ahead
    long = np.flatnonzero(length >= np.maximum(least, 2 * period))
    start = i[long] - behind[long]
    _, once = np.unique(start * (longest + 1) + period[long], return_index=True)
    once = long[once]
    start = i[once] - behind[once]
    owner = np.searchsorted(ends, start)
    return owner, start - starts[owner], length[once], period[once]


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts and how many each has."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat = split.flatten()
    filled = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])
    return flat.filter(filled), np.diff(before[bounds])


_RUN = pa.struct([pa.field("start", pa.int64()), pa.field("length", pa.int64()), pa.field("period", pa.int64())])


def _describe(keys: pa.Array, words: pa.Array, lengths: np.ndarray, least: int) -> pa.RecordBatch:
    codes = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    owner, start, length, period = runs_of(codes, lengths, least)
    starts = np.cumsum(lengths) - lengths
    cover = np.zeros(len(codes) + 1, np.int64)
    np.add.at(cover, starts[owner] + start + period, 1)
    np.add.at(cover, starts[owner] + start + length, -1)
    keep = np.cumsum(cover)[:-1] == 0
    left = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([starts, [len(codes)]])]
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), words.filter(pa.array(keep))), pa.scalar(" ", pa.large_string()))
    found = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start, length, period)], fields=list(_RUN))
    runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(lengths) + 1)), pa.int32()), found)
    return pa.RecordBatch.from_arrays([keys, pa.array(lengths, pa.int64()), runs, collapsed.cast(pa.string())], names=["key", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, chunk: int = CHUNK_WORDS) -> DataFrame:
    """(key, n_words, runs, collapsed) for each row of ``docs``.

    ``runs`` holds (start, length, period) in words, by start and then period; ``collapsed`` is the text without the
    words that a run repeats: what lies in a run after its first period goes, the other words are joined by one space.
    """
    run = "array<struct<start:bigint,length:bigint,period:bigint>>"
    schema = T.StructType().add("key", docs.schema[key].dataType).add("n_words", "long").add("runs", T.DataType.fromDDL(run)).add("collapsed", "string")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, lengths = _words(batch.column(1))
            ends = np.cumsum(lengths)
            at = 0
            while at < len(lengths):
                before = int(ends[at] - lengths[at])
                to = max(at + 1, int(np.searchsorted(ends, before + chunk, "right")))
                yield _describe(batch.column(0).slice(at, to - at), words.slice(before, int(ends[to - 1]) - before), lengths[at:to], least)
                at = to

    found = map_batches(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), find, schema)
    return found.withColumnRenamed("key", key)
