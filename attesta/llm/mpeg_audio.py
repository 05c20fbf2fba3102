"""MPEG audio columns: bytes stored in audio frames, and any MPEG audio described frame by frame.

``store`` writes a payload as a variable-bitrate MPEG-1 Layer III stream: an ID3v2 tag, an information frame with a seek
table, and silent frames that carry the bytes as ancillary data, the unit in which the format keeps other data than sound.
``describe`` reads any stream of layers I to III: tags (ID3v2, ID3v1, APEv2), variable-bitrate tables (Xing or Info with
its extension, VBRI), frame headers, resynchronised after foreign or broken bytes, checksums, exact duration in samples
and the offset of every frame.

Two narrow passes without a shuffle; memory is that of a batch or of one longer payload.

Defined cases: a null text counts as an empty one, whose payload is one block of zeros; very long texts are
one stream, never cut; equal texts give equal streams; null keys stay null; repeated rows each get their result; a null or
empty stream, or one without frames, has 0 frames and null format; an empty table gives an empty result; other columns, whatever
their names, are not read. Not read: free-format frames (they are skipped like foreign bytes); checksums
of Layer II (frames are counted, not checked). A frame cut off by the end is no frame.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.llm.common import map_batches, slices

#: kbit/s by (MPEG 1?, layer), sample rates of MPEG 1, and bytes of Layer III side information by (MPEG 1?, mono?). Fixed values.
BITRATES = {
    (True, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (True, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (True, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (False, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (False, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (False, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = (44100, 48000, 32000)
SIDE = {(True, True): 17, (True, False): 32, (False, True): 9, (False, False): 17}

#: Payloads are filled up with zeros to blocks of this size.
BLOCK = 64
#: The extension of the information frame: encoder name to tag checksum.
EXTENSION = 36


# ---------------------------------------------------------------- checksums


@lru_cache(maxsize=1 << 14)
def frame_crc(covered: bytes) -> int:
    """CRC-16 of a frame: polynomial 0x8005, first bit first, from 0xFFFF."""
    crc = 0xFFFF
    for byte in covered:
        crc ^= byte << 8
        for _ in range(8):
            crc = (crc << 1 ^ 0x8005) & 0xFFFF if crc & 0x8000 else crc << 1
    return crc


def _step(crc: np.ndarray) -> np.ndarray:
    """The reflected CRC-16 after one zero byte."""
    for _ in range(8):
        crc = np.where(crc & 1, crc >> 1 ^ 0xA001, crc >> 1)
    return crc


@lru_cache(maxsize=1)
def _crc_tables(width: int = 1024) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a byte adds by its distance from the end of a block, and what a block does to the low and high byte before it."""
    rows = [_step(np.arange(256, dtype=np.uint16))]
    for _ in range(width - 1):
        rows.append(_step(rows[-1]))
    low, high = np.arange(256, dtype=np.uint16), np.arange(256, dtype=np.uint16) << 8
    for _ in range(width):
        low, high = _step(low), _step(high)
    return np.array(rows[::-1]), low, high


def music_crc(data: bytes) -> int:
    """CRC-16 of information frames: polynomial 0x8005 reflected, from 0; blocks of 1024 bytes at a time."""
    table, low, high = _crc_tables()
    width = len(table)
    values = np.frombuffer(data, np.uint8)
    head = len(values) % width
    crc = int(np.bitwise_xor.reduce(table[np.arange(width - head, width), values[:head]])) if head else 0
    blocks = values[head:].reshape(-1, width)
    for at in range(0, len(blocks), 256):
        part = blocks[at : at + 256]
        for block in np.bitwise_xor.reduce(table[np.arange(width), part], axis=1).tolist():
            crc = int(low[crc & 255]) ^ int(high[crc >> 8]) ^ block
    return crc


# ---------------------------------------------------------------- headers


@dataclass(frozen=True)
class Header:
    version: str
    layer: int
    rate: int
    channels: int
    bitrate: int
    length: int
    samples: int
    #: Bytes behind header and checksum that the checksum covers; None where it isn't verified.
    covered: int | None
    protected: bool
    side: int

    @property
    def kind(self) -> tuple:
        """What all frames of a stream have in common."""
        return self.version, self.layer, self.rate


@lru_cache(maxsize=1 << 14)
def header(four: bytes) -> Header | None:
    """The frame header in four bytes, or None."""
    if len(four) < 4:
        return None
    bits = int.from_bytes(four, "big")
    version, layer = bits >> 19 & 3, 4 - (bits >> 17 & 3)
    index, rate = bits >> 12 & 15, bits >> 10 & 3
    if bits >> 21 != 0x7FF or version == 1 or layer == 4 or index in (0, 15) or rate == 3:
        return None
    first, mono = version == 3, bits >> 6 & 3 == 3
    hertz = RATES[rate] >> {3: 0, 2: 1, 0: 2}[version]
    kbit = BITRATES[first, layer][index]
    padding = bits >> 9 & 1
    samples = 384 if layer == 1 else 1152 if layer == 2 or first else 576
    length = (12000 * kbit // hertz + padding) * 4 if layer == 1 else samples * 125 * kbit // hertz + padding
    covered = SIDE[first, mono] if layer == 3 else None
    if layer == 1:
        bound = 4 * (bits >> 4 & 3) + 4 if bits >> 6 & 3 == 1 else 32
        covered = 16 if mono else (2 * bound + 32 - bound) // 2
    return Header({3: "1", 2: "2", 0: "2.5"}[version], layer, hertz, 1 if mono else 2, kbit, length, samples, covered, not bits >> 16 & 1, SIDE[first, mono])


# ---------------------------------------------------------------- tags


def _syncsafe(four: bytes) -> int:
    return four[0] << 21 | four[1] << 14 | four[2] << 7 | four[3]


def _text(data: bytes) -> str:
    """A text field of ID3v2: encoding byte, then the text; several values are joined by a slash."""
    name = {0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(data[0] if data else 0, "latin-1")
    return data[1:].decode(name, "replace").strip("\0").replace("\0", "/")


def read_id3(data: bytes, at: int, tags: dict[str, str]) -> int:
    """Reads an ID3v2 tag at ``at`` and returns where it ends; ``at`` if there is none."""
    if data[at : at + 3] != b"ID3" or len(data) < at + 10 or max(data[at + 6 : at + 10]) > 127:
        return at
    major, flags, size = data[at + 3], data[at + 5], _syncsafe(data[at + 6 : at + 10])
    body = data[at + 10 : at + 10 + size]
    if flags & 0x80 and major < 4:
        body = body.replace(b"\xff\x00", b"\xff")
    pos, wide = 0, 3 if major == 2 else 4
    if flags & 0x40 and major > 2 and len(body) >= 4:
        pos = _syncsafe(body[:4]) if major == 4 else int.from_bytes(body[:4], "big") + 4
    while pos + (6 if major == 2 else 10) <= len(body) and body[pos]:
        name = body[pos : pos + wide].decode("latin-1")
        raw = body[pos + wide : pos + 2 * wide]
        long = _syncsafe(raw) if major == 4 else int.from_bytes(raw, "big")
        pos += 6 if major == 2 else 10
        value = body[pos : pos + long]
        pos += long
        if name in ("TXXX", "TXX"):
            label, _, text = _text(value).partition("/")
            tags.setdefault(label, text)
        elif name.startswith("T"):
            tags.setdefault(name, _text(value))
    return min(len(data), at + 10 + size + (10 if flags & 0x10 else 0))


def read_trailers(data: bytes, end: int, tags: dict[str, str]) -> int:
    """Reads ID3v1 and APEv2 tags before ``end`` and returns where the first of them starts."""
    if end >= 128 and data[end - 128 : end - 125] == b"TAG":
        end -= 128
        for name, start, stop in (("title", 3, 33), ("artist", 33, 63), ("album", 63, 93), ("year", 93, 97)):
            value = data[end + start : end + stop].split(b"\0")[0].decode("latin-1").strip()
            if value:
                tags.setdefault(name, value)
    if end >= 32 and data[end - 32 : end - 24] == b"APETAGEX":
        _, size, count, flags = struct.unpack_from("<IIII", data, end - 24)
        if 32 <= size <= end:
            pos = end - size
            for _ in range(count):
                if pos + 8 > end - 32:
                    break
                long, _ = struct.unpack_from("<II", data, pos)
                stop = data.find(b"\0", pos + 8, end - 32)
                if stop < 0:
                    break
                tags.setdefault(data[pos + 8 : stop].decode("latin-1"), data[stop + 1 : min(stop + 1 + long, end - 32)].decode("utf-8", "replace"))
                pos = stop + 1 + long
            end -= size
            if flags & 0x80000000 and data[max(0, end - 32) : max(0, end - 24)] == b"APETAGEX":
                end -= 32
    return end


# ---------------------------------------------------------------- variable-bitrate tables


@dataclass
class Table:
    """What an information frame says about the frames after it."""

    kind: str
    frames: int | None = None
    length: int | None = None
    places: list[int] = field(default_factory=list)
    delay: int = 0
    padding: int = 0
    music: int | None = None
    intact: bool | None = None


def read_table(frame: bytes, head: Header) -> Table | None:
    """The table in an information frame, or None if it is an ordinary one."""
    at = 4 + head.side
    kind = frame[at : at + 4]
    if kind not in (b"Xing", b"Info"):  # a protected one has the checksum in between
        at += 2
        kind = frame[at : at + 4]
    if kind in (b"Xing", b"Info") and len(frame) >= at + 8:
        flags, pos, table = int.from_bytes(frame[at + 4 : at + 8], "big"), at + 8, Table(kind.decode())
        if flags & 1:
            table.frames, pos = int.from_bytes(frame[pos : pos + 4], "big"), pos + 4
        if flags & 2:
            table.length, pos = int.from_bytes(frame[pos : pos + 4], "big"), pos + 4
        if flags & 4:
            table.places, pos = list(frame[pos : pos + 100]), pos + 100
        pos += 4 if flags & 8 else 0
        ext = frame[pos : pos + EXTENSION]
        if len(ext) == EXTENSION and ext[0]:
            table.delay, table.padding = ext[21] << 4 | ext[22] >> 4, (ext[22] & 15) << 8 | ext[23]
            table.music = int.from_bytes(ext[32:34], "big")
            table.intact = music_crc(frame[: pos + EXTENSION - 2]) == int.from_bytes(ext[34:36], "big")
        return table
    if frame[36:40] == b"VBRI" and len(frame) >= 62:
        _, delay, _, length, frames, entries, scale, width, _ = struct.unpack_from(">HHHIIHHHH", frame, 40)
        steps = [int.from_bytes(frame[62 + k * width : 62 + (k + 1) * width], "big") * scale for k in range(entries)] if width else []
        return Table("VBRI", frames, length, np.cumsum(steps).tolist() if steps else [], delay)
    return None


# ---------------------------------------------------------------- streams


@dataclass
class Stream:
    """A stream as it is found, frame by frame."""

    tags: dict[str, str] = field(default_factory=dict)
    head: Header | None = None
    table: Table | None = None
    offsets: list[int] = field(default_factory=list)
    lengths: list[int] = field(default_factory=list)
    bitrates: set[int] = field(default_factory=set)
    samples: int = 0
    checked: int = 0
    failed: int = 0
    resyncs: int = 0
    skipped: int = 0
    table_ok: bool | None = None
    music_ok: bool | None = None


def parse(data: bytes) -> Stream:
    """Reads a stream; one pass, each foreign byte is looked at once."""
    s = Stream()
    at, end = 0, read_trailers(data, len(data), s.tags)
    while (nxt := read_id3(data, at, s.tags)) > at:
        at = nxt
    first, synced, kind = at, True, None
    while at < end:
        head = header(data[at : at + 4])
        fits = head is not None and at + head.length <= end and (kind is None or head.kind == kind)
        if fits and (kind is None or not synced):
            # a header found by searching must be followed by another, or by the end
            follow = header(data[at + head.length : at + head.length + 4])
            fits = at + head.length == end or (follow is not None and follow.kind == head.kind)
        if not fits:
            if synced and at > first:
                s.resyncs += 1
            synced = False
            nxt = data.find(b"\xff", at + 1, end)
            nxt = nxt if nxt >= 0 else end
            s.skipped += nxt - at
            at = nxt
            continue
        synced = True
        if kind is None:
            kind, s.head = head.kind, head
            s.table = read_table(data[at : at + head.length], head)
            if s.table is not None:
                start, at = at, at + head.length
                continue
        if head.protected and head.covered is not None:
            s.checked += 1
            s.failed += frame_crc(data[at + 2 : at + 4] + data[at + 6 : at + 6 + head.covered]) != int.from_bytes(data[at + 4 : at + 6], "big")
        s.offsets.append(at)
        s.lengths.append(head.length)
        s.bitrates.add(head.bitrate)
        s.samples += head.samples
        at += head.length
    if s.table is not None:
        t = s.table
        last = s.offsets[-1] + s.lengths[-1] if s.offsets else start + s.head.length
        s.table_ok = t.frames in (None, len(s.offsets)) and t.length in (None, last - start)
        s.samples = max(0, s.samples - t.delay - t.padding)
        if t.music is not None:
            s.music_ok = music_crc(data[start + s.head.length : last]) == t.music
    return s


# ---------------------------------------------------------------- storing bytes

_RATE, _SAMPLES, _SIDE = 48000, 1152, 17
#: Bytes of a stored frame before its ancillary data, and of the number and size that lead those.
_BEFORE, _LEAD = 6 + _SIDE, 6


def _frame_head(index: int, protected: bool) -> bytes:
    """Header, checksum and empty side information of a mono frame at 48 kHz."""
    head = bytes([0xFF, 0xFA if protected else 0xFB, index << 4 | 1 << 2, 0xC0])
    side = bytes(_SIDE)
    return head + (frame_crc(head[2:] + side).to_bytes(2, "big") if protected else b"") + side


_SIZES = [header(_frame_head(k, True)[:4]).length if k else 0 for k in range(15)]
_HEADS = [_frame_head(k, True) if k else b"" for k in range(15)]
_ROOM = _SIZES[14] - _BEFORE - _LEAD


def _id3(values: dict[str, object]) -> bytes:
    body = b""
    for label, value in values.items():
        text = b"\x03" + label.encode() + b"\0" + str(value).encode()
        body += b"TXXX" + _safe(len(text)) + b"\0\0" + text
    return b"ID3\x04\0\0" + _safe(len(body)) + body


def _safe(n: int) -> bytes:
    return bytes([n >> 21 & 127, n >> 14 & 127, n >> 7 & 127, n & 127])


def stored(payload: bytes, values: dict[str, object]) -> bytes:
    """A stream that carries ``payload``: frames of the highest bitrate and a last one just large enough."""
    frames = []
    for number, start in enumerate(range(0, len(payload), _ROOM)):
        part = payload[start : start + _ROOM]
        index = 14 if len(part) == _ROOM else next(k for k in range(1, 15) if _SIZES[k] >= _BEFORE + _LEAD + len(part))
        frames.append((_HEADS[index] + struct.pack(">IH", number, len(part)) + part).ljust(_SIZES[index], b"\0"))
    music = b"".join(frames)
    index = 5
    total = _SIZES[index] + len(music)
    # the place at each hundredth of the duration, in 256ths of the length
    starts = np.cumsum([_SIZES[index], *map(len, frames)])
    places = [min(255, int(starts[k * len(frames) // 100]) * 256 // total) for k in range(100)]
    info = _frame_head(index, False) + b"Xing" + struct.pack(">III", 15, len(frames), total) + bytes(places) + struct.pack(">I", 0)
    info += b"attesta\0\0" + bytes(12) + bytes(3) + bytes(4) + struct.pack(">IH", total, music_crc(music))
    info = (info + music_crc(info).to_bytes(2, "big")).ljust(_SIZES[index], b"\0")
    return _id3(values) + info + music


def carried(data: bytes, s: Stream) -> bytes | None:
    """The payload of a stream made by ``stored``; None if it carries none or a part of it is lost."""
    if "payload_bytes" not in s.tags or s.failed:
        return None
    parts = []
    for number, at in enumerate(s.offsets):
        found, used = struct.unpack_from(">IH", data, at + _BEFORE)
        if found != number or used > _ROOM:
            return None
        parts.append(data[at + _BEFORE + _LEAD : at + _BEFORE + _LEAD + used])
    payload = b"".join(parts)
    return payload if str(len(payload)) == s.tags["payload_bytes"] else None


# ---------------------------------------------------------------- columns


def store(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, media): each text's bytes, filled up to blocks, as an MPEG audio stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            made = []
            for value in batch.column(1).cast(pa.large_binary()).to_pylist():
                value = value or b""
                payload = value.ljust(max(BLOCK, -(-len(value) // BLOCK) * BLOCK), b"\0")
                made.append(stored(payload, {"text_bytes": len(value), "payload_bytes": len(payload)}))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["key", "media"])

    schema = T.StructType().add("key", docs.schema[key].dataType).add("media", "binary")
    return map_batches(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), run, schema).withColumnRenamed("key", key)


_AUDIO = [
    ("version", "string", pa.string()), ("layer", "int", pa.int32()), ("rate", "int", pa.int32()), ("channels", "int", pa.int32()),
    ("frames", "bigint", pa.int64()), ("samples", "bigint", pa.int64()), ("variable", "boolean", pa.bool_()), ("table", "string", pa.string()), ("table_ok", "boolean", pa.bool_()),
    ("table_intact", "boolean", pa.bool_()), ("music_ok", "boolean", pa.bool_()), ("checked", "bigint", pa.int64()), ("failed", "bigint", pa.int64()), ("resyncs", "bigint", pa.int64()),
    ("skipped", "bigint", pa.int64()), ("tags", "map<string,string>", pa.map_(pa.string(), pa.string())), ("offsets", "array<bigint>", pa.list_(pa.int64())), ("seek_crc32", "bigint", pa.int64()),
]


def _row(s: Stream) -> tuple:
    h, t = s.head, s.table
    form = (h.version, h.layer, h.rate, h.channels) if h else (None,) * 4
    seek = zlib.crc32(np.array(s.offsets, "<u8").tobytes())
    return (*form, len(s.offsets), s.samples, len(s.bitrates) > 1, t and t.kind, s.table_ok, t and t.intact, s.music_ok, s.checked, s.failed, s.resyncs, s.skipped, list(s.tags.items()), s.offsets, seek)


def describe(media: DataFrame, key: str = "doc_id", column: str = "media") -> DataFrame:
    """(key, media, payload, then the columns of a stream) for each row; a duration is ``samples`` / ``rate`` seconds, exactly.

    ``offsets`` are the frames' places in the stream, ``payload`` what ``store`` put in, if it is all there.
    """
    schema = T.StructType().add("key", media.schema[key].dataType).add("media", "binary").add("payload", "binary")
    for name, kind, _ in _AUDIO:
        schema = schema.add(name, T.DataType.fromDDL(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            payloads, rows = [], []
            for data in batch.column(1).to_pylist():
                data = data or b""
                s = parse(data)
                payloads.append(carried(data, s))
                rows.append(_row(s))
            columns = [pa.array([r[k] for r in rows], f[2]) for k, f in enumerate(_AUDIO)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(payloads, pa.binary()), *columns], names=schema.fieldNames())

    found = map_batches(media.select(F.col(key).alias("key"), F.col(column).alias("media")), run, schema)
    return found.withColumnRenamed("key", key)
