"""MPEG audio, source divergence and periodic runs against definitions, brute force and built streams."""

import hashlib
import random
import re
import struct
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from attesta.llm import divergence, mpeg_audio, periodic, queries

SF = "/root/testdata/sf0.001"
EDGE = [
    (1, None, None, None),
    (2, "", "en", ""),
    (3, " \n\t\x0b\x0c\r ", "en", "a"),
    (4, "one", "en", "a"),
    (4, "one", "en", "a"),
    (5, "naïve Café — 日本語 🙂‍🔥 İ \x1c\x85 it's  I'LL\n\n end ", "fr", None),
    (6, "ab ab ab ab ab ab x y z " * 3, "en", "b"),
    (None, "word " * 3000 + "x" * 20000 + "1" * 9000, "en", "b"),
]


@pytest.fixture(scope="module")
def edge(spark):
    df = spark.createDataFrame(EDGE, "doc_id long, text string, lang string, source string")
    return df.withColumns({c: F.lit("clash") for c in ("KEY", "media", "runs", "rank", "value", "prefix", "terms", "n", "w", "h")})


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# ---------------------------------------------------------------- periodic runs


def runs(w, least=12):
    """All runs of a list, by the definition."""
    c, out = np.array([hash(x) for x in w]), []
    for q in range(1, len(w) // 2 + 1):
        edge = np.diff(np.concatenate([[0], c[:-q] == c[q:], [0]]).astype(int))
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            n = b - a + q
            if n >= max(least, 2 * q) and not any((c[a : a + n - k] == c[a + k : a + n]).all() for k in range(1, q)):
                out.append((a, n, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def test_runs_equal_the_definition():
    rng = random.Random(1)
    for _ in range(300):
        docs = []
        for _ in range(rng.randint(1, 6)):
            n, k = rng.choice([0, 1, 2, 5, 12, 30, 60]), rng.choice([1, 2, 3, 8])
            w = [rng.randrange(k) for _ in range(n)]
            if rng.random() < 0.5 and n > 4:
                a = rng.randrange(n)
                p = rng.randint(1, max(1, (n - a) // 2))
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            docs.append(w)
        least = rng.choice([2, 4, 12])
        found = periodic.runs_of(np.array(sum(docs, []), np.int64), np.array([len(w) for w in docs]), least)
        got = defaultdict(list)
        for d, *run in zip(*(c.tolist() for c in found)):
            got[d].append(tuple(run))
        assert all(got[d] == runs(w, least) for d, w in enumerate(docs))


def test_runs_of_long_texts():
    a, b = [0], [0, 1]
    while len(b) < 100_000:
        a, b = b, b + a
    began = time.perf_counter()
    same = periodic.runs_of(np.zeros(100_000, np.int64), np.array([100_000]))
    assert [c.tolist() for c in same] == [[0], [0], [100_000], [1]]
    many = periodic.runs_of(np.array(b), np.array([len(b)]))  # a word with as many runs as there can be
    assert len(many[0]) > 10_000 and time.perf_counter() - began < 10


def test_run_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    planted = 0
    for r in queries.op13_periodic_runs(spark, SF).collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]] or "")
        n, h = len(w), zlib.crc32(str(r["doc_id"]).encode())
        g = h // 10
        if h % 10 == 0 and n:
            planted += 1
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if n > 6000:
            continue
        found = runs(w)
        best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else None
        assert r["n_runs"] == len(found)
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert r["runs_sha256"] == sha("".join(f"{s},{k},{q}\n" for s, k, q in found)) and r["collapsed_sha256"] == sha(collapsed(w, found))
    assert planted


@pytest.mark.parametrize("chunk", [1 << 17, 5])
def test_run_edges(edge, chunk):
    got = periodic.find_runs(edge, chunk=chunk).collect()
    assert len(got) == len(EDGE)
    want = []
    for k, t, *_ in EDGE:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        found = runs(w) if len(w) < 1000 else [(0, 3000, 1)]
        want.append((k, len(w), found, collapsed(w, found)))
    assert sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got), key=str) == sorted(want, key=str)
    assert periodic.find_runs(edge.where("false")).count() == 0


# ---------------------------------------------------------------- source divergence


def audited(rows, least=3, top=200):
    """The audit by its definition, in Python's integers."""
    out = []
    terms = [(la or "", so or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))) for _, t, la, so in rows]
    for lang in {t[0] for t in terms}:
        df = Counter(w for la, _, ws in terms if la == lang for w in set(ws))
        kept = {w for w, n in df.items() if n >= least}
        groups = {so: Counter() for la, so, _ in terms if la == lang}
        for la, so, ws in terms:
            if la == lang:
                groups[so].update(w for w in ws if w in kept)
        price = lambda c: {w: 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept)) for w in kept}
        p, q = {s: price(c) for s, c in groups.items()}, price(sum(groups.values(), Counter()))
        f = lambda a, b: (a - b) * (a - b) // b
        for s in groups:
            pairs = [(-sum(f(p[s][w], p[o][w]) for w in kept), o.encode(), o) for o in groups if o != s]
            best = [(-f(p[s][w], q[w]), w.encode(), w) for w in kept if groups[s][w] and p[s][w] > q[w]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(best)[:top])):
                out += [(lang, s, part, item, -v, k + 1) for k, (v, _, item) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("most,depth,counters", [(250_000, 3, 300_000), (2, 1, 1), (0, 2, 1)])
def test_audit_edges(spark, edge, most, depth, counters, monkeypatch):
    rng = random.Random(5)
    words = ["the", "thé", "then", "theory", "日本", "日本語", "🙂", "a", "of"]
    made = [(k, " ".join(rng.choices(words, range(1, 10), k=rng.randint(0, 12))).upper(), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", "é", None])) for k in range(60)]
    made += [(100 + k, "solo " * k, "xx", "only") for k in range(3)]
    df = spark.createDataFrame([*EDGE, *made], "doc_id long, text string, lang string, source string")
    monkeypatch.setattr(divergence, "FRONT_ENTRIES", 3)
    tries = divergence.local_tries(df.fillna(""), depth, counters)
    cut = divergence.split_ranges(tries, depth, most)
    sizes = cut.groupBy("lang", "prefix").agg(F.sum("terms").alias("n"), F.max("terms").alias("m")).where(f"n > {most} and m > 1")
    assert sizes.count() == 0 and cut.agg(F.sum("terms")).first() == tries.agg(F.sum("terms")).first()
    got = divergence.audit(df.withColumns({c: F.lit("clash") for c in ("rank", "value", "terms", "n")}), depth=depth, most=most)
    assert sorted(tuple(r) for r in got.collect()) == audited([*EDGE, *made])
    assert divergence.audit(edge.where("false")).count() == 0


def test_audit_keeps_ties_in_order(spark):
    rows = [(k, " ".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)) if k < 3 else "other " * 3, "en", "a" if k < 3 else "b") for k in range(6)]
    got = divergence.audit(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    assert sorted(tuple(r) for r in got.collect()) == audited(rows)
    assert got.where("part = 'term' and source = 'a'").count() == 200


def test_audit_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    df = queries.op12_source_divergence(spark, SF)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLE_SQL['op12_source_divergence']})").fetchall()
    assert sorted(tuple(r) for r in df.collect()) == sorted(want) and len(want) > 1000


def test_prices_stay_exact():
    rng = random.Random(2)
    for _ in range(500):
        total = rng.randint(1, rng.choice([10, 10**6, 9 * 10**15]))
        counts = [rng.randint(0, total - 1) for _ in range(4)]
        assert divergence.prices(np.array(counts), total).tolist() == [1 + 10**9 * (c + 1) // total for c in counts]


def test_tries_merge_in_any_order():
    rng = random.Random(3)
    parts = [[(bytes(rng.choices(b"ab\xc3\xa9", k=rng.randint(1, 6))), rng.randint(1, 3), {rng.choice("xyz"): rng.randint(1, 5)}) for _ in range(40)] for _ in range(5)]
    want = defaultdict(lambda: [0, Counter()])
    for t, d, c in sum(parts, []):
        want[t][0] += d
        want[t][1].update(c)
    for _ in range(5):
        rng.shuffle(parts)
        forest = {}
        for part in parts:
            local = {}
            for term, d, c in part:
                divergence._add(local, "", 2, term, d, dict(c))
            for row in divergence._rows(local):
                named = dict(zip(("lang", "prefix", "terms", *(f[0] for f in divergence._TRIE)), row))
                for term, d, c in divergence._unpacked(named):
                    divergence._add(forest, "", 2, named["prefix"] + term, d, c)
        got = [(prefix + t, [d, Counter(c)]) for (_, prefix), trie in sorted(forest.items()) for t, (d, c) in trie.walk()]
        assert got == [(t, want[t]) for t in sorted(want)]


# ---------------------------------------------------------------- MPEG audio


def frame(version=3, layer=1, protected=True, index=9, rate=1, padding=0, mode=3, body=b"", spoil=False):
    """A frame of given header fields (as bits), zero side information, then ``body``."""
    head = (0x7FF << 21 | version << 19 | layer << 17 | (not protected) << 16 | index << 12 | rate << 10 | padding << 9 | mode << 6).to_bytes(4, "big")
    h = mpeg_audio.header(head)
    data = bytearray(head + bytes(h.length - 4))
    at = 4
    if protected:
        covered = bytes(data[2:4]) + bytes(h.covered or 0)
        data[4:6] = (mpeg_audio.frame_crc(covered) ^ spoil).to_bytes(2, "big")
        at = 6
    at += h.side
    data[at : at + len(body)] = body
    return bytes(data)


def test_checksums_of_known_values():
    assert mpeg_audio.music_crc(b"123456789") == 0xBB3D and mpeg_audio.frame_crc(b"123456789") == 0xAEE7
    data = random.Random(1).randbytes(300_000)
    crc = 0
    for b in data[:5000]:
        crc ^= b
        for _ in range(8):
            crc = crc >> 1 ^ 0xA001 if crc & 1 else crc >> 1
    assert mpeg_audio.music_crc(data[:5000]) == crc and mpeg_audio.music_crc(b"") == 0


@pytest.mark.parametrize(
    "fields,layer,rate,length,samples",
    [
        (dict(version=3, layer=1, index=9, rate=0, mode=0), 3, 44100, 417, 1152),
        (dict(version=3, layer=1, index=9, rate=0, mode=0, padding=1), 3, 44100, 418, 1152),
        (dict(version=2, layer=1, index=8, rate=0), 3, 22050, 208, 576),
        (dict(version=0, layer=1, index=8, rate=2), 3, 8000, 576, 576),
        (dict(version=3, layer=2, index=10, rate=1, mode=0), 2, 48000, 576, 1152),
        (dict(version=3, layer=3, index=12, rate=0, mode=1), 1, 44100, 416, 384),
        (dict(version=3, layer=3, index=12, rate=0, mode=1, padding=1), 1, 44100, 420, 384),
    ],
)
def test_streams_of_each_layer(fields, layer, rate, length, samples):
    one = frame(**fields)
    s = mpeg_audio.parse(one * 5)
    assert (s.head.layer, s.head.rate, s.head.length, s.samples) == (layer, rate, length, 5 * samples)
    assert len(one) == length and s.offsets == [k * length for k in range(5)] and (s.checked, s.failed) == ((0, 0) if layer == 2 else (5, 0))


def test_resynchronises():
    one, other = frame(index=9), frame(index=5)
    broken = frame(index=9, spoil=True)
    junk = b"\xff\xfb\x00junk\xff\xe0\xff" + one[:3]  # sync words that lead nowhere
    data = junk + one + other + b"garbage \xff\xff" + one + broken + one[:50] + one + other + one[:100]
    s = mpeg_audio.parse(data)
    at, want = len(junk), []
    for part, is_frame in ((one, 1), (other, 1), (b"garbage \xff\xff", 0), (one, 1), (broken, 1), (one[:50], 0), (one, 1), (other, 1)):
        want += [at] * is_frame
        at += len(part)
    # the frame whose body is cut has a good header, and what follows is sought from there
    assert set(s.offsets) <= {*want, want[-1] - len(one) - 50} and {want[0], want[1], want[2], want[3]} <= set(s.offsets)
    assert s.failed == 1 and s.resyncs >= 2 and s.skipped > len(junk)
    clean = mpeg_audio.parse(junk + one * 3)
    assert clean.offsets == [len(junk) + k * len(one) for k in range(3)] and clean.skipped == len(junk)


def test_reads_tags():
    id3 = mpeg_audio._id3({"mood": "calm/quiet"})
    v23 = b"ID3\x03\0\0" + mpeg_audio._safe(10 + 9) + b"TIT2" + (9).to_bytes(4, "big") + b"\0\0" + b"\x01" + "abc".encode("utf-16-le").join([b"\xff\xfe", b""])
    v1 = (b"TAG" + b"Title".ljust(30, b"\0") + b"Artist".ljust(30, b"\0") + b"Album".ljust(30, b" ") + b"1999" + bytes(31))[:128]
    item = struct.pack("<II", 4, 0) + b"Genre\0Jazz"
    ape = item + b"APETAGEX" + struct.pack("<IIII", 2000, len(item) + 32, 1, 0) + bytes(8)
    s = mpeg_audio.parse(id3 + v23 + frame() * 2 + ape + v1)
    assert s.tags["mood"] == "calm/quiet" and s.tags["TIT2"] == "abc" and s.tags["title"] == "Title" and s.tags["album"] == "Album" and s.tags["Genre"] == "Jazz"
    assert len(s.offsets) == 2 and s.skipped == 0


def test_reads_tables():
    info = b"Xing" + struct.pack(">III", 7, 3, 4 * len(frame())) + bytes(range(100))
    good = mpeg_audio.parse(frame(body=info, protected=False) + frame() * 3)
    assert good.table.kind == "Xing" and good.table_ok and len(good.offsets) == 3 and good.table.places == list(range(100))
    assert mpeg_audio.parse(frame(body=info, protected=False) + frame() * 2).table_ok is False
    late = mpeg_audio.parse(frame(body=b"Info" + struct.pack(">II", 1, 3)) + frame() * 3)  # behind the checksum
    assert late.table.kind == "Info" and late.table_ok
    vbri = bytearray(frame(protected=False))
    vbri[36:62] = b"VBRI" + struct.pack(">HHHIIHHHH", 1, 0, 75, 3 * len(vbri), 2, 2, 10, 2, 1)
    vbri[62:66] = struct.pack(">HH", 7, 9)
    s = mpeg_audio.parse(bytes(vbri) + frame() * 2)
    assert s.table.kind == "VBRI" and s.table.frames == 2 and s.table_ok and s.table.places == [70, 160]


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 930, 931, 932, 1862, 5000, 100_001])
def test_payloads_come_back(size):
    payload = random.Random(size).randbytes(size)
    data = mpeg_audio.stored(payload, {"payload_bytes": size})
    s = mpeg_audio.parse(data)
    assert mpeg_audio.carried(data, s) == payload and s.table_ok and s.table.intact and s.music_ok and s.failed == s.resyncs == s.skipped == 0
    assert s.offsets == sorted(s.offsets) and s.samples == 1152 * len(s.offsets)
    if size > 2000:
        hurt = bytearray(data)
        hurt[s.offsets[1] + 8] ^= 1  # side information: the checksum tells
        bad = mpeg_audio.parse(bytes(hurt))
        assert bad.failed == 1 and bad.music_ok is False and mpeg_audio.carried(bytes(hurt), bad) is None
        lost = data[: s.offsets[1]] + data[s.offsets[1] + 5 :]
        cut = mpeg_audio.parse(lost)
        assert cut.resyncs == 1 and len(cut.offsets) == len(s.offsets) - 1 and mpeg_audio.carried(lost, cut) is None


def test_foreign_bytes_take_linear_time():
    began = time.perf_counter()
    for data in (b"\xff" * 1_000_000, b"\xff\xfa\x94\xc0" * 250_000, b"ID3\x04\0\0\x7f\x7f\x7f\x7f" * 10, bytes(1_000_000), b"\xff\xfb" + bytes(10)):
        mpeg_audio.parse(data)
    assert time.perf_counter() - began < 10


def test_audio_query(spark, edge):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op11_mpeg_audio(spark, SF).collect():
        text = (texts[r["doc_id"]] or "").encode()
        payload = text.ljust(max(64, -(-len(text) // 64) * 64), b"\0")
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(text), len(payload), sha(payload), zlib.crc32(payload[-64:]))
        made = mpeg_audio.stored(payload, {"text_bytes": len(text), "payload_bytes": len(payload)})
        assert (r["media_bytes"], r["media_sha256"]) == (len(made), sha(made)) and "music_ok=true" in r["feature"]
    got = mpeg_audio.describe(mpeg_audio.store(edge)).collect()
    assert sorted((str(r["doc_id"]), r["tags"]["text_bytes"], r["payload"].rstrip(b"\0")) for r in got) == sorted((str(k), str(len((t or "").encode())), (t or "").encode()) for k, t, *_ in EDGE)
    assert mpeg_audio.describe(mpeg_audio.store(edge.where("false"))).count() == 0


def test_streams_that_are_none(spark):
    df = spark.createDataFrame([(1, None), (2, b""), (3, b"no audio"), (4, b"\xff\xfb")], "doc_id long, media binary")
    for r in mpeg_audio.describe(df).collect():
        assert r["frames"] == 0 and r["version"] is None and r["payload"] is None and r["offsets"] == []
