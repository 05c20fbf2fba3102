"""Toxicity by compression distance.

Two zstandard dictionaries are trained apart: one on windows of ordinary documents, one on text of
toxic documents. A window of a few words that gets shorter once the toxic dictionary stands before the
ordinary one speaks for label 1. Per document, the shares of windows whose saving reaches each of a few
calibrated thresholds, the mean saving and the largest ones go through a logistic link.

What the toxic dictionary is trained on: whole toxic documents are mostly ordinary prose, and a trainer
that ranks by frequency fills a dictionary with that. So its samples are the stretches of toxic text
made of byte runs (RUN bytes inside a word, the unit the trainer counts) that stand in over LIFT times
as large a share of toxic as of ordinary documents, by over EXCESS standard errors.

Calibration is cross-fitted: dictionaries of each half of the sample measure the other half, so no
document is measured by a dictionary that has seen it. Thresholds are the savings that given shares of
ordinary windows reach (QUANTILES); the link's weights are fitted on the same evidence.

Fitting uses at most ``per_class`` documents of each label in the order of a hash of their key, as long
as their texts come to at most ``most_bytes``; never those whose crc32(key as text) mod ``folds`` is 0.
Only texts and labels are read for it; a score depends on the text alone. Scoring is a narrow pass over
whole texts.

Defined cases: null and empty texts have no windows and get the score of no evidence; null labels are
left out of fitting; of repeated labels of a document each counts; of several texts under one key the
fit uses one, the shortest, then the one of the least hash; without labels of both kinds the score is 0
for every row; keys may be null or repeated; clashing names of other columns don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.llm.common import free_name, map_batches, slices

#: Words of a window and from one window to the next.
WINDOW, STRIDE = 8, 7
DICTIONARY_BYTES = 2048
#: Ordinary documents give at most this many windows each, evenly spaced, to the dictionary's training.
SPREAD = 60
#: Shares of ordinary windows that stay below a threshold.
QUANTILES = (0.5, 0.8, 0.9, 0.97, 0.99, 0.997, 0.999, 0.9997, 0.9999)
#: Bounds of the sample for each label.
PER_CLASS, CLASS_BYTES = 3000, 8 << 20
#: A run of RUN bytes is over-represented if its share of toxic documents is over LIFT times that of ordinary ones and EXCESS standard errors above.
RUN, LIFT, EXCESS = 6, 4.0, 5.0
#: Runs that wait to be counted.
_FOLD = 500_000


@dataclass(frozen=True)
class Fit:
    """Dictionary contents, thresholds and the calibrated link; a few KB, sent with each task."""

    ordinary: bytes
    toxic: bytes
    thresholds: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()
    offsets: tuple[float, ...] = ()
    scales: tuple[float, ...] = ()
    bias: float = 0.0


def windows(text: str, stride: int = STRIDE) -> list[bytes]:
    """Runs of WINDOW words, each word with a space on either side."""
    words = text.lower().encode().split()
    if not words:
        return []
    return [b" " + b" ".join(words[i : i + WINDOW]) + b" " for i in range(0, max(1, len(words) - WINDOW + stride), stride)]


def compressor(content: bytes) -> zs.ZstdCompressor:
    p = zs.ZstdCompressionParameters(window_log=13, hash_log=13, chain_log=13, search_log=5, min_match=6, target_length=16, strategy=zs.STRATEGY_GREEDY, write_content_size=False, write_checksum=False, write_dict_id=False)
    d = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=p)
    return zs.ZstdCompressor(dict_data=d, compression_params=p)


class Scorer:
    """Scores of texts under a fit; one per task."""

    def __init__(self, fit: Fit) -> None:
        self.fit = fit
        self.plain, self.toxic = compressor(fit.ordinary), compressor(fit.toxic + fit.ordinary)

    def savings(self, text: str) -> np.ndarray:
        """Bytes that the toxic dictionary saves in each window."""
        plain, toxic = self.plain.compress, self.toxic.compress
        return np.array([len(plain(w)) - len(toxic(w)) for w in windows(text)], float)

    def __call__(self, text: str) -> float:
        f = self.fit
        x = (evidence(self.savings(text), f.thresholds) - f.offsets) / f.scales
        return 1 / (1 + math.exp(-min(max(float(x @ np.array(f.weights)) + f.bias, -30.0), 30.0)))


def evidence(saved: np.ndarray, thresholds: tuple[float, ...]) -> np.ndarray:
    """By threshold, the share of windows that reach it and the logarithm of their number; the mean and largest savings; the number of windows."""
    if not len(saved):
        return np.zeros(2 * len(thresholds) + 4)
    counts = np.array([(saved >= t).sum() for t in thresholds], float)
    top = np.sort(saved)[-3:]
    return np.array([*counts / len(saved), *np.log1p(counts), saved.mean(), top[-1], top.mean(), np.log1p(len(saved))])


def _train(samples: list[bytes], **segments: int) -> bytes:
    """Content of a dictionary trained on the samples, in an order of no meaning."""
    samples = [samples[k] for k in np.random.default_rng(1).permutation(len(samples)).tolist()]
    try:
        return zs.train_dictionary(DICTIONARY_BYTES, samples, d=RUN, **segments).as_bytes()
    except zs.ZstdError:  # too little text to train on: the text itself is the content
        return b"".join(sorted(set(samples)))[:DICTIONARY_BYTES] or b" " * 8


def _spaced(text: str) -> bytes:
    return b" " + b" ".join(text.lower().encode().split()) + b" "


def _runs(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(places, numbers) of the runs of RUN bytes that have no space but at their ends."""
    raw = np.frombuffer(text, np.uint8)
    n = len(raw) - RUN + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    number, inside = np.zeros(n, np.uint64), np.ones(n, bool)
    for k in range(RUN):
        number = number << np.uint64(8) | raw[k : k + n]
        if 0 < k < RUN - 1:
            inside &= raw[k : k + n] != 32
    return np.flatnonzero(inside), number[inside]


def _shares(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(runs, the number of texts that hold each), in order; folded as soon as _FOLD runs are new."""
    runs, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    fresh: list[np.ndarray] = []

    def folded() -> tuple[np.ndarray, np.ndarray]:
        every, place = np.unique(np.concatenate([runs, *fresh]), return_inverse=True)
        return every, np.bincount(place, np.concatenate([counts, np.ones(len(place) - len(runs), np.int64)]), len(every)).astype(np.int64)

    for t in texts:
        fresh.append(np.unique(_runs(t)[1]))
        if sum(map(len, fresh)) > _FOLD:
            runs, counts = folded()
            fresh = []
    return folded()


def stretches(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """Stretches of the toxic texts that over-represented runs cover."""
    toxic_, ordinary_ = [_spaced(t) for t in toxic], [_spaced(t) for t in ordinary]
    runs, held = _shares(toxic_)
    others, counts = _shares(ordinary_)
    if not len(runs):
        return []
    elsewhere = np.zeros(len(runs))
    if len(others):
        place = np.minimum(np.searchsorted(others, runs), len(others) - 1)
        elsewhere = np.where(others[place] == runs, counts[place], 0)
    n, m = len(toxic_), len(ordinary_)
    p, q, both = held / n, elsewhere / m, (held + elsewhere) / (n + m)
    error = np.sqrt(both * (1 - both) * (1 / n + 1 / m)) + 1e-9
    over = runs[(p > LIFT * q) & ((p - q) / error > EXCESS)]
    out: list[bytes] = []
    for text in toxic_:
        at, number = _runs(text)
        at = at[np.isin(number, over)]
        if len(at):
            for run in np.split(at, np.flatnonzero(np.diff(at) > RUN) + 1):
                out.append(text[int(run[0]) : int(run[-1]) + RUN])
    return out


def _dictionaries(texts: list[str], y: np.ndarray) -> Fit:
    """The two dictionaries, each trained on texts of its own label."""
    toxic, ordinary = ([t for t, label in zip(texts, y) if label == side] for side in (1, 0))
    pooled: dict[bytes, None] = {}
    for t in ordinary:
        mine = windows(t, WINDOW)
        pooled.update(dict.fromkeys(mine[:: max(1, math.ceil(len(mine) / SPREAD))]))
    told = stretches(toxic, ordinary) or [w for t in toxic for w in windows(t, WINDOW)]
    # short stretches need the trainer's own search for a segment length
    return Fit(_train(list(pooled), k=16), _train(told, steps=16, level=3))


def _link(x: np.ndarray, y: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Logistic weights by Newton steps with a ridge; classes weigh as in ``prior``, the share of label 1."""
    w = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    z = np.c_[x, np.ones(len(x))]
    b = np.zeros(z.shape[1])
    ridge = np.diag([1.0] * x.shape[1] + [1e-3])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        h = (z * (w * p * (1 - p))[:, None]).T @ z + ridge
        step = np.linalg.solve(h, z.T @ (w * (y - p)) - ridge @ b)
        b += step
        if abs(step).max() < 1e-6:
            break
    return b[:-1], float(b[-1])


def fit_texts(texts: list[str], labels: list[int], prior: float) -> Fit | None:
    """A fit from labelled texts; None unless both labels occur. ``prior`` is the share of label 1 to calibrate for."""
    y = np.array(labels)
    if not 0 < y.sum() < len(y):
        return None
    half = np.empty(len(y), int)
    for side in (0, 1):
        mine = np.flatnonzero(y == side)
        half[mine] = np.arange(len(mine)) % 2
    saved: list[np.ndarray] = [np.zeros(0)] * len(y)
    for h in (0, 1):
        known = half != h if len(set(y[half != h].tolist())) == 2 else np.ones(len(y), bool)  # too few for halves
        scorer = Scorer(_dictionaries([t for t, k in zip(texts, known) if k], y[known]))
        for k in np.flatnonzero(half == h).tolist():
            saved[k] = scorer.savings(texts[k])
    plain = np.concatenate([s for s, label in zip(saved, y) if label == 0])
    levels = np.quantile(plain, QUANTILES).round() if len(plain) else np.zeros(1)
    thresholds = tuple(sorted({max(1.0, float(t)) for t in levels}))
    x = np.array([evidence(s, thresholds) for s in saved])
    offsets, scales = x.mean(0), np.maximum(x.std(0), 1e-6)
    weights, bias = _link((x - offsets) / scales, y, prior)
    both = _dictionaries(texts, y)
    return Fit(both.ordinary, both.toxic, thresholds, tuple(weights), tuple(offsets), tuple(scales), bias)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", folds: int = 5, per_class: int = PER_CLASS, most_bytes: int = CLASS_BYTES) -> Fit | None:
    """Fit on labelled rows of ``docs`` outside fold 0. The driver gets at most 2 x per_class keys and sizes, and texts of at most 2 x most_bytes."""
    spark = docs.sparkSession
    marked = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where("k is not null and y in (0, 1)").where(F.crc32(F.col("k").cast("string").cast("binary")) % folds != 0)
    shares = {r["y"]: r["count"] for r in marked.groupBy("y").count().collect()}  # two rows
    if len(shares) < 2:
        return None
    order = [F.xxhash64("k"), F.col("k")]
    chosen = [marked.where(F.col("y") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    body = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    # at most 2 x per_class rows on the broadcast side; one row a key and label leaves
    sizes = body.join(F.broadcast(chosen[0].unionAll(chosen[1])), "k").groupBy("k", "y").agg(F.min(F.struct(F.octet_length("t").alias("n"), F.xxhash64("t").alias("h"))).alias("s"))
    used, room = [], {0: most_bytes, 1: most_bytes}
    for r in sizes.select("k", "y", "s.n", "s.h").orderBy(*order, "y").collect():
        room[r["y"]] -= r["n"]
        if room[r["y"]] >= 0:
            used.append((r["k"], r["y"], r["n"], r["h"]))
        else:
            room[r["y"]] += r["n"]
    if not used:
        return None
    schema = T.StructType([T.StructField("k", docs.schema[key].dataType), T.StructField("y", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("h", T.LongType())])
    picked = body.withColumns({"n": F.octet_length("t"), "h": F.xxhash64("t")}).join(F.broadcast(spark.createDataFrame(used, schema)), ["k", "n", "h"])
    texts = {(r["k"], r["y"]): r["t"] for r in picked.groupBy("k", "y").agg(F.min("t").alias("t")).collect()}
    rows = [(texts[k, y], y) for k, y, _, _ in used]
    return fit_texts([r[0] for r in rows], [r[1] for r in rows], shares[1] / (shares[0] + shares[1]))


def score(docs: DataFrame, fitted: Fit | None, key: str = "doc_id", text: str = "text", folds: int = 5) -> DataFrame:
    """(key, held_out, score, predicted) for each row of ``docs``."""
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("score", T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(fitted) if fitted else lambda t: 0.0
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([scorer(t or "") for t in batch.column(1).to_pylist()], pa.float64())], names=["key", "score"])

    scored = map_batches(docs.select(F.col(key).alias("key"), F.col(text)), run, schema)
    out = F.coalesce(F.crc32(F.col("key").cast("string").cast("binary")) % folds == 0, F.lit(False))
    return scored.select(F.col("key").alias(key), out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, fitted: Fit | None, text: str = "text", cut: float = 0.5) -> DataFrame:
    """Rows of ``docs`` whose score is below ``cut``, with all their columns; one pass, no join."""
    place = docs.columns.index(text)
    mark = free_name(docs, "score")
    schema = T.StructType([*docs.schema.fields, T.StructField(mark, T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(fitted) if fitted else lambda t: 0.0
        for batch in slices(batches):
            got = pa.array([scorer(t or "") for t in batch.column(place).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, got], names=[*batch.schema.names, mark])

    return map_batches(docs, run, schema).where(F.col(f"`{mark}`") < cut).drop(mark)
