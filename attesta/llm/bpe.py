"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Texts are cut into pre-tokens by the tokenizer's pattern. Documents form blocks of bounded text
size. Inside a block every pre-token is exploded to its position, held as the number of its word in
the block, packed; the distinct words of the block go, packed per word bucket, to the task that owns
the bucket. There each distinct word of the corpus is encoded once, and its ids are joined back to
the blocks, where positions put the documents together again. What travels is one packed row for
each (block, bucket) pair plus the packed positions: no word is a shuffle key, so a word that stands
in every document weighs as much as any other. Decoding joins ids with the token-byte table: the table's
size is fixed by the vocabulary, so each task holds it whole and looks ids up by number.

The documents are scanned twice, for words and for positions, and blocks must come out alike: that
holds for tables and files. A block's name is a hash of its words, so an input whose rows change order
between scans fails instead of giving wrong ids.

Defined cases: a null text counts as empty (no ids, empty bytes); keys may be null or repeated and
rows are never merged; an empty table gives an empty result; columns other than the key and the text
are not read.
"""

from __future__ import annotations

import base64
import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from attesta.llm.common import map_batches, slices

#: Bytes of text after which a block is closed; a longer text is a block of its own.
BLOCK_BYTES = 12 << 20
#: Bytes of text for each task of the two shuffles, so that tasks grow in number with the input, not in size; word buckets are at
#: most MAX_BUCKETS, as distinct words grow slower than texts and each block has a row for each bucket.
TASK_BYTES, MAX_BUCKETS = 32 << 20, 4096
#: Bytes of text in a packed row of positions.
CHUNK_BYTES = 1 << 20
WORDS, IDS, DOCS = 0, 1, 2
ROW = "block long, kind int, bucket int, payload binary, keys array<{key}>"


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """The token-byte table: bytes by id, empty where an id is unused."""
    ranks = load_ranks(path)
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})


def _pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as four byte planes, compressed: the high planes are nearly empty."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.compress(planes.tobytes(), 3)


def _unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()


def _pack_lists(lengths: np.ndarray, numbers: np.ndarray) -> bytes:
    return len(lengths).to_bytes(4, "little") + _pack(np.concatenate([lengths, numbers]))


def _unpack_lists(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, both = int.from_bytes(data[:4], "little"), _unpack(data[4:])
    return both[:n].astype(np.int64), both[n:]


class _Block:
    """Documents of one block while they are scanned."""

    def __init__(self) -> None:
        self.words: dict[str, int] = {}
        self.docs: list[np.ndarray] = []
        self.keys: list = []
        self.sizes: list[int] = []

    def add(self, key, pieces: list[str], size: int) -> None:
        number = self.words.setdefault
        words = self.words
        self.docs.append(np.fromiter((number(p, len(words)) for p in pieces), np.uint32, len(pieces)))
        self.keys.append(key)
        self.sizes.append(size)

    def rows(self, buckets: int, kind: int) -> Iterator[tuple]:
        """Rows of one kind: the distinct words, or the documents as places of words. A block is named by a hash of its words."""
        raw = [w.encode() for w in self.words]
        words = raw
        block = int.from_bytes(hashlib.blake2b(b"\xff".join(raw), digest_size=8).digest(), "little", signed=True)
        homes = np.fromiter((zlib.crc32(w) for w in raw), np.uint32, len(raw)) % buckets
        by_home = np.argsort(homes, kind="stable")
        ends = np.cumsum(np.bincount(homes, minlength=buckets))
        place = np.empty(len(words), np.uint32)
        at = 0
        for bucket, end in enumerate(ends.tolist()):
            # sorted words share prefixes, which packs them well
            mine = sorted(by_home[at:end].tolist(), key=raw.__getitem__)
            place[mine] = np.arange(at, end, dtype=np.uint32)
            if mine and kind == WORDS:
                lengths = np.fromiter((len(raw[k]) for k in mine), np.uint32, len(mine))
                packed = zstandard.compress(b"".join(raw[k] for k in mine), 3)
                sizes = _pack(lengths)
                yield block, WORDS, bucket, len(sizes).to_bytes(4, "little") + sizes + packed, None
            at = end
        start = 0 if kind == DOCS else len(self.docs)
        while start < len(self.docs):
            stop, size = start, 0
            while stop < len(self.docs) and (stop == start or size + self.sizes[stop] <= CHUNK_BYTES):
                size += self.sizes[stop]
                stop += 1
            docs = self.docs[start:stop]
            lengths = np.fromiter(map(len, docs), np.uint32, len(docs))
            packed = _pack_lists(lengths, place[np.concatenate(docs)])
            yield block, DOCS, 0, packed, self.keys[start:stop]
            start = stop


def _unpack_words(payload: bytes) -> list[bytes]:
    n = int.from_bytes(payload[:4], "little")
    lengths, text = _unpack(payload[4 : 4 + n]), zstandard.decompress(payload[4 + n :])
    ends = np.cumsum(lengths, dtype=np.int64).tolist()
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _scan(pattern: str, buckets: int, kind: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        split = regex.compile(pattern).findall
        block, size = _Block(), 0
        for batch in slices(batches):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                n = len(text.encode())
                if size and size + n > BLOCK_BYTES:
                    for row in block.rows(buckets, kind):
                        yield _batch([row], schema)
                    block, size = _Block(), 0
                block.add(key, split(text), n)
                size += n + 1
        if block.docs:
            for row in block.rows(buckets, kind):
                yield _batch([row], schema)

    return run


def _encode_words(path: str, pattern: str, schema: pa.Schema):
    """Word rows become id rows, each distinct word encoded once. Rows come by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path, pattern).encode_ordinary
        bucket, known = None, {}
        for batch in slices(batches, 16):
            out = []
            for block, _, home, payload, _ in zip(*(c.to_pylist() for c in batch.columns)):
                if home != bucket:
                    bucket, known = home, {}
                ids = []
                for word in _unpack_words(payload):
                    got = known.get(word)
                    if got is None:
                        got = known[word] = np.array(encode(word.decode()), np.uint32).tobytes()
                    ids.append(got)
                lengths = np.fromiter(map(len, ids), np.uint32, len(ids)) // 4
                out.append((block, IDS, home, _pack_lists(lengths, np.frombuffer(b"".join(ids), np.uint32)), None))
            if out:
                yield _batch(out, schema)

    return run


def _reassembled(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, np.ndarray]]:
    """(key, ids) of each document. Of each block, id rows come first, by bucket."""
    block, last, counts, flat, starts, lengths = None, -1, [], [], None, None
    for batch in slices(batches, 16):
        for b, kind, bucket, payload, keys in zip(*(batch.column(c).to_pylist() for c in ("block", "kind", "bucket", "payload", "keys"))):
            if b != block:
                block, last, counts, flat, starts = b, -1, [], [], None
            if kind == IDS:
                if bucket == last:
                    continue  # of another block with the same words
                last = bucket
                n, ids = _unpack_lists(payload)
                counts.append(n)
                flat.append(ids)
                continue
            if starts is None:
                lengths = np.concatenate(counts) if counts else np.zeros(0, np.int64)
                ids = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
                starts = np.cumsum(lengths) - lengths
            sizes, words = _unpack_lists(payload)
            if len(words) and not len(lengths):
                raise ValueError("a block changed between the two scans; write the documents to a table first")
            at = 0
            for key, size in zip(keys, sizes.tolist()):
                mine = words[at : at + size]
                at += size
                n, first = lengths[mine], starts[mine]
                ends = np.cumsum(n)
                total = int(ends[-1]) if size else 0
                # position t of the document's ids lies at first[w] + (t - ids before word w)
                where = np.arange(total) + np.repeat(first - (ends - n), n)
                yield key, ids[where]


def _blocks(docs: DataFrame, key: str, text: str, vocabulary: str, pattern: str, buckets: int | None) -> DataFrame:
    """Encoded blocks: per block its id rows by bucket, then its packed documents."""
    spark = docs.sparkSession
    kind = docs.schema[key].dataType
    row = T._parse_datatype_string(ROW.format(key=kind.simpleString()))

    arrow = to_arrow_schema(row)
    body = docs.select(F.col(key), F.col(text))
    size = body.agg(F.sum(F.octet_length(text).cast("double"))).first()[0] or 0.0  # one row
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(size / TASK_BYTES))
    n = buckets or min(tasks, MAX_BUCKETS)
    # a bucket is a task; bucket numbers are partition numbers, so none shares a task while another idles
    words = map_batches(body, _scan(pattern, n, WORDS, arrow), row).repartitionById(n, F.col("bucket")).sortWithinPartitions("bucket", "block")
    ids = map_batches(words, _encode_words(vocabulary, pattern, arrow), row)
    # scanned a second time rather than carried through the shuffle of words
    packed = map_batches(body, _scan(pattern, n, DOCS, arrow), row)
    return ids.unionAll(packed).repartition(tasks, "block").sortWithinPartitions("block", "kind", "bucket")


def encode(docs: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """(key, n_tokens, ids array<int>) for each row of ``docs``.

    ``vocabulary`` is a rank file that every executor can open; ``pattern`` its pre-token pattern.
    ``buckets``: tasks that share the distinct words; where None, one for each TASK_BYTES of text, as many as there are cores at least and MAX_BUCKETS at most.
    """
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("n_tokens", T.LongType(), False), T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    arrow = to_arrow_schema(schema)

    def run(batches):
        for name, ids in _reassembled(batches):
            yield _batch([(name, len(ids), ids.astype(np.int32))], arrow)

    return map_batches(_blocks(docs, key, text, vocabulary, pattern, buckets), run, schema).withColumnRenamed("key", key)


def decode_list(ids: np.ndarray, table: list[bytes]) -> bytes:
    return b"".join(map(table.__getitem__, ids.tolist()))


def decode(encoded: DataFrame, vocabulary: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, decoded binary): the bytes of each list of ids; null ids give null, an unknown id fails."""
    schema = T.StructType([T.StructField("key", encoded.schema[key].dataType), T.StructField("decoded", T.BinaryType())])

    arrow = to_arrow_schema(schema)

    def run(batches):
        joined = token_bytes(vocabulary)
        for batch in slices(batches):
            out = [None if x is None else b"".join([joined[i] for i in x]) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(arrow[0].type), pa.array(out, pa.binary())], schema=arrow)

    return map_batches(encoded.select(F.col(key).alias("key"), F.col(ids)), run, schema).withColumnRenamed("key", key)


def digests(docs: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): encode and decode in the same pass, keeping digests only."""
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("n_tokens", T.LongType(), False), T.StructField("ids_sha256", T.StringType(), False), T.StructField("decoded_sha256", T.StringType(), False)])

    arrow = to_arrow_schema(schema)

    def run(batches):
        joined, out = token_bytes(vocabulary), []
        for name, ids in _reassembled(batches):
            packed = ids.astype("<u4").tobytes()
            out.append((name, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decode_list(ids, joined)).hexdigest()))
            if len(out) == 1000:
                yield _batch(out, arrow)
                out = []
        if out:
            yield _batch(out, arrow)

    return map_batches(_blocks(docs, key, text, vocabulary, pattern, buckets), run, schema).withColumnRenamed("key", key)
