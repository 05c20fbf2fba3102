"""Tokenising, scanning, rendering and scoring operators against brute force and on edge cases."""

import hashlib
import html
import math
import random
import re
import struct
import time
import zlib
from collections import Counter

import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from attesta.llm import bpe, html_render, pii, quality, queries, secret_scan, sharding, token_count, toxicity

SF = "/root/testdata/sf0.001"
EDGE = [
    (1, None, "x"),
    (2, "", "x"),
    (3, " \n\t\x0b\x0c\r ", "y"),
    (4, "one", "y"),
    (4, "one", "y"),
    (5, "naïve café — 日本語 🙂‍🔥 İ \x1c\x85 <|endoftext|> it's  I'LL\n\n end ", None),
    (None, "word " * 3000 + "x" * 20000 + "1" * 9000, "z"),
]
COLUMNS = "doc_id long, text string, other string"


@pytest.fixture(scope="module")
def edge(spark):
    df = spark.createDataFrame(EDGE, COLUMNS)
    return df.withColumns({c: F.lit("clash") for c in ("KEY", "score", "words", "shard", "redacted", "cell", "ids", "body")})


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


def found(df):
    return {r["doc_id"]: r for r in df.collect()}


# ---------------------------------------------------------------- byte-level BPE


def library(text):
    return bpe._encoder(queries.BPE_RANKS, queries.PATTERN).encode_ordinary(text or "")


def test_bpe_equals_library(spark, texts):
    got = found(queries.op1_byte_bpe(spark, SF))
    assert got.keys() == texts.keys()
    for k, t in texts.items():
        ids = library(t)
        assert got[k]["n_tokens"] == len(ids)
        assert got[k]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[k]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


@pytest.mark.parametrize("buckets", [1, 3, 7])
def test_bpe_round_trip_on_edges(edge, buckets):
    encoded = bpe.encode(edge, queries.BPE_RANKS, queries.PATTERN, buckets=buckets)
    want = Counter((k, tuple(library(t))) for k, t, _ in EDGE)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in encoded.collect()) == want
    decoded = bpe.decode(encoded, queries.BPE_RANKS).collect()
    assert Counter(bytes(r["decoded"]).decode() for r in decoded) == Counter(t or "" for _, t, _ in EDGE)
    assert bpe.encode(edge.where("false"), queries.BPE_RANKS, queries.PATTERN).count() == 0


def test_bpe_blocks_alike(docs, texts):
    """Blocks that hold the same words, once in two partitions, must not mix."""
    twice = docs.unionAll(docs)
    got = bpe.encode(twice, queries.BPE_RANKS, queries.PATTERN).collect()
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == Counter({(k, tuple(library(t))): 2 for k, t in texts.items()})


# ---------------------------------------------------------------- token counts


def test_token_counts_equal_library(edge, docs, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    count = lambda t: len(tokenizer.encode(t or "", add_special_tokens=False).ids)
    got = token_count.token_counts(edge, queries.BPE_MODEL, queries.PATTERN).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == Counter((k, len((t or "").encode()), count(t), count(t) > 512) for k, t, _ in EDGE)
    for k, r in found(token_count.token_counts(docs, queries.BPE_MODEL, queries.PATTERN)).items():
        assert r["n_tokens"] == count(texts[k])


def test_token_cache_starts_afresh(texts):
    small = token_count.Counter(queries.BPE_MODEL, queries.PATTERN, kept=5)
    large = token_count.Counter(queries.BPE_MODEL, queries.PATTERN)
    assert all(small(t) == large(t) for t in list(texts.values())[:20])


# ---------------------------------------------------------------- personal data


def base_by_patterns(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 12 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.ORDER[s[0]]))


def test_pii_base_spans(texts):
    r = random.Random(1)
    model = pii.loaded(pii.fitted())
    noise = ["".join(r.choice("0123456789..@@ab+ -()%25") for _ in range(r.randint(0, 40))) for _ in range(3000)]
    for t in [*texts.values(), *noise, "4111 1111 1111 1111 and 001.02.3.255 or 1.2.3.4.5.6.7.8.9 a@b@c.d.e"]:
        base, both = pii.all_spans(t, model)
        assert base == base_by_patterns(t)
        assert set(base) <= set(both)
        added = sorted((a, b) for k, a, b in set(both) - set(base))
        assert all(b <= c for (_, b), (c, _) in zip(added, added[1:]))
        assert all(b <= x or a >= y for a, b in added for _, x, y in base)


def test_pii_model_on_held_out_templates():
    model, r = pii.loaded(pii.fitted()), random.Random(1234)
    hit = said = true = 0
    for _ in range(300):
        text, spans = pii.sample(r)
        got = set(pii.all_spans(text, model)[1])
        hit, said, true = hit + len(got & set(spans)), said + len(got), true + len(spans)
    assert hit / true > 0.9 and hit / said > 0.9


def test_pii_decoder_equals_enumeration():
    model, r = pii.loaded(pii.fitted()), random.Random(77)

    def score(lattice, segments):
        covered = {t for i, j, _ in segments for t in range(i, j)}
        outside = sum(model.outside.get(lattice.outside(j), 0.0) for j in range(1, lattice.n + 1) if j - 1 not in covered)
        return outside + sum(float(model.segment(dict(lattice.ending(j))[i])[k]) for i, j, k in segments)

    def segmentations(lattice, at=0):
        """Every set of candidate segments that don't overlap, with every choice of kinds."""
        if at == lattice.n:
            yield []
            return
        for rest in segmentations(lattice, at + 1):
            yield rest
        for j in range(at + 1, lattice.n + 1):
            if at in dict(lattice.ending(j)):
                for rest in segmentations(lattice, j):
                    for k in range(len(pii.KINDS)):
                        yield [(at, j, k), *rest]

    checked = with_spans = 0
    for _ in range(400):
        text, _ = pii.sample(r)
        for a, b in pii.regions(text):
            lattice = pii.Lattice(text, a, b)
            if lattice.n > 9:
                continue
            best = model.best(lattice)
            top = max(score(lattice, s) for s in segmentations(lattice))
            assert abs(score(lattice, best) - top) < 1e-9
            checked, with_spans = checked + 1, with_spans + bool(best)
    assert checked > 100 and with_spans > 30


def test_pii_spans_are_whole_however_long():
    model = pii.loaded(pii.fitted())
    for n in (20, 79, 100, 500):
        text = f"write to {'a' * n}[at]{'b' * n}.org now"
        assert pii.all_spans(text, model)[1] == [("email", 9, len(text) - 4)]


def test_pii_long_texts_take_linear_time():
    model = pii.loaded(pii.fitted())
    assert pii.all_spans("1" * 100_000 + "@" * 1000 + "a" * 100_000 + "+1" * 20_000, model)[0] == []


def test_pii_query(spark, edge, texts):
    got = found(queries.op2_personal_data(spark, SF))
    for k, t in texts.items():
        base = base_by_patterns(t)
        assert got[k]["base_sha256"] == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert [got[k][f"n_{kind}"] for kind in pii.KINDS] == [sum(s[0] == kind for s in base) for kind in pii.KINDS]
    assert pii.find_personal_data(edge).count() == len(EDGE)
    assert pii.find_personal_data(edge.where("false")).count() == 0


# ---------------------------------------------------------------- sharding


def test_shards(edge, docs, texts):
    got = sharding.assign_shards(docs).collect()
    assert {r["doc_id"] for r in got} == texts.keys() and {r["law"] for r in got} == {"key"}
    slots = {}
    for r in got:
        assert r["size"] == len(texts[r["doc_id"]].encode()) + 1
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
        assert r["grown_shard"] in (r["shard"], 16)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    grown = {r["doc_id"]: r["shard"] for r in sharding.assign_shards(docs, [1.0] * 17).collect()}
    assert all(grown[r["doc_id"]] == r["grown_shard"] for r in got)
    same = sharding.assign_shards(edge).collect()
    assert len(same) == len(EDGE) and len({r["shard"] for r in same if r["doc_id"] == 4}) == 1
    assert sharding.assign_shards(edge.where("false")).count() == 0
    plan = sharding.assign_shards(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_shards_of_hot_keys_and_rows(spark):
    hot = spark.range(10_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    keyed = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 900).alias("text"))
    got = sharding.assign_shards(hot.unionAll(keyed).withColumn("slot", F.lit(1))).collect()
    assert len(got) == 13_000 and len({r["shard"] for r in got if r["doc_id"] == 7}) == 1
    slots = {}
    for r in got:
        assert r["grown_shard"] in (r["shard"], 16)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter(r["text_crc32"] for r in got if r["doc_id"] is None) == Counter(zlib.crc32(f"t{k % 900}".encode()) for k in range(3000))


def test_shard_weights(spark):
    rows = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    n = Counter(r["shard"] for r in sharding.assign_shards(rows, [1.0, 3.0]).collect())
    assert 0.73 < n[1] / 20000 < 0.77
    with pytest.raises(ValueError):
        sharding.assign_shards(rows, [1.0, 0.0])


def test_shards_against_scalar_hash(spark):
    def score(key, shard):
        h = xxhash.xxh64_intdigest(f"k{key}".encode(), 42)
        h = xxhash.xxh64_intdigest(struct.pack("<i", shard), h)
        return -math.log(((h >> 11) + 0.5) / 2**53)

    rows = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    for r in sharding.assign_shards(rows).collect():
        assert r["shard"] == min(range(16), key=lambda s: score(r["doc_id"], s))


# ---------------------------------------------------------------- toxicity


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    scored = queries.op5_toxicity(spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in scored)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in scored)
    got = [r for r in scored if r["held_out"] and labels.get(r["doc_id"]) is not None]
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in got) / len(got)
    pairs = [(a["score"], b["score"]) for a in got if labels[a["doc_id"]] == 1 for b in got if labels[b["doc_id"]] == 0]
    ranked = sum((a > b) + (a == b) / 2 for a, b in pairs) / len(pairs)
    assert right > 0.93 and ranked > 0.93


def test_toxic_stretches_equal_direct_count():
    r = random.Random(9)
    common = ["the", "and", "river", "mountain", "council", "spoke"]
    ordinary = [" ".join(r.choice(common) for _ in range(r.randint(0, 60))) for _ in range(120)]
    toxic = [" ".join(r.choice([*common, "blockhead", "Nincompoop"]) for _ in range(r.randint(1, 60))) for _ in range(60)]
    spaced = lambda t: " " + " ".join(t.lower().split()) + " "
    runs = lambda t: [(k, t[k : k + 6]) for k in range(len(t) - 5) if " " not in t[k + 1 : k + 5]]
    held = [Counter(g for t in texts for g in {g for _, g in runs(spaced(t))}) for texts in (ordinary, toxic)]
    over = set()
    for g, c in held[1].items():
        p, q, m = c / 60, held[0][g] / 120, (c + held[0][g]) / 180
        error = math.sqrt(m * (1 - m) * (1 / 60 + 1 / 120)) + 1e-9
        if p > toxicity.LIFT * q and (p - q) / error > toxicity.EXCESS:
            over.add(g)
    want = []
    for t in map(spaced, toxic):
        covered = sorted({k + d for k, g in runs(t) if g in over for d in range(6)})
        for k in covered:
            if want and want[-1][0] is t and want[-1][2] == k - 1:
                want[-1][2] = k
            else:
                want.append([t, k, k])
    assert want and toxicity.stretches(toxic, ordinary) == [t[a : b + 1].encode() for t, a, b in want]


def test_toxicity_score_is_the_difference_of_two_dictionaries():
    fit = toxicity.fit_texts(["you are a blockhead and a fool " * 5, "the river met the sea " * 9] * 40, [1, 0] * 40, 0.5)
    plain, toxic = toxicity.compressor(fit.ordinary), toxicity.compressor(fit.toxic + fit.ordinary)
    for text in ("what a blockhead he is and a fool", "the sea met the river", ""):
        words = text.split()
        saved = []
        for k in range(0, len(words), toxicity.STRIDE):
            if k == 0 or k + 1 < len(words):
                w = (" " + " ".join(words[k : k + toxicity.WINDOW]) + " ").encode()
                saved.append(len(plain.compress(w)) - len(toxic.compress(w)))
        assert toxicity.Scorer(fit).savings(text).tolist() == saved
    assert toxicity.Scorer(fit)("you are a fool and a blockhead " * 5) > 0.5 > toxicity.Scorer(fit)("the sea met the river " * 9)


def test_toxicity_fit_is_bounded_and_whole(spark):
    rows = [(k, ("you blockhead " if k % 2 else "the river ") * 40) for k in range(60)] + [(61, "long " * 5000), (7, "a second text of key 7 that is longer " * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels) is not None
    assert toxicity.fit(docs, labels, most_bytes=3000) is not None
    assert toxicity.fit(docs, labels, most_bytes=1) is None


def test_toxicity_edges(spark, edge):
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, None)], "doc_id long, toxic int")
    for fitted in (None, toxicity.fit(edge, labels)):
        assert toxicity.score(edge, fitted).count() == len(EDGE)
        assert toxicity.reject_toxic(edge, fitted).columns == edge.columns
    assert toxicity.score(edge.where("false"), None).count() == 0
    assert toxicity.reject_toxic(edge, None).count() == len(EDGE)
    assert toxicity.fit(edge, labels.where("toxic = 1")) is None


# ---------------------------------------------------------------- secrets


def secrets_by_patterns(t):
    keywords = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token")) + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
    out = [("assign", m.start(), m.end()) for m in re.finditer(rf"(?:{keywords})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t) if len(m[1]) >= 8]
    out += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[1], secret_scan.ORDER[s[0]]))


def test_secrets(spark, edge, texts):
    r = random.Random(2)
    parts = ["password", "PassWD", "secret", "token", "api_key", "ApiKey", "=", ":", " ", '"', "'", "abcDEF12", "AKIA", "0a" * 17, "x", "AKIA" + "Z9" * 8, "İ", "é", "/+.", "ghp_", "K"]
    noise = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(4000)]
    for t in [*texts.values(), *noise]:
        assert [s for s in secret_scan.spans(t) if s[0] in secret_scan.BASE] == secrets_by_patterns(t)
    got = found(queries.op6_secrets(spark, SF))
    for k, t in texts.items():
        base = secrets_by_patterns(t)
        assert got[k]["base_sha256"] == hashlib.sha256(secret_scan.joined(base).encode()).hexdigest()
        assert (got[k]["n_assign"], got[k]["n_access"], got[k]["n_hex"]) == tuple(sum(s[0] == kind for s in base) for kind in secret_scan.KINDS[:3])
    assert secret_scan.find_secrets(edge).count() == len(EDGE)


def test_secret_checksums(edge):
    body = "abcdefghij0123456789ABCDEFGHIJ"
    good = f"ghp_{body}{secret_scan.checksum62(body)}"
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    assert secret_scan.spans(f"x {good} y") == [("checksum", 2, 2 + len(good))]
    assert secret_scan.spans(f"x {bad} y") == []
    assert secret_scan.redacted(f"x {good} y", "<{kind}>") == "x <checksum> y"
    clean = secret_scan.redact(edge)
    assert clean.columns == edge.columns
    assert Counter(r["text"] for r in clean.collect()) == Counter(t and re.sub("[0-9a-f]{32,}", "<redacted hex>", t) for _, t, _ in EDGE)
    with pytest.raises(ValueError):
        secret_scan.redact(edge, mark="<secret:{kind}>")


def test_redacting_twice_changes_nothing(spark):
    r = random.Random(5)
    body = "abcdefghij0123456789ABCDEFGHIJ"
    parts = ["password=", "secret: ", "token=", "api_key = ", "apikey=", '"', " ", "abcDEF12", "AKIA" + "Z9" * 8, "0a" * 17, "0123456789abcdef0123456789abcdefa", "pikey=secret:abcdefgh", f"npm_{body}{secret_scan.checksum62(body)}", "é", "x"]
    made = ["".join(r.choice(parts) for _ in range(r.randint(1, 12))) for _ in range(3000)]
    for t in made:
        once = secret_scan.redacted(t)
        assert not secret_scan.spans(once) and not secrets_by_patterns(once) and secret_scan.redacted(once) == once
    kinds = {k for t in made for k, _, _ in secret_scan.spans(t)}
    assert kinds == set(secret_scan.KINDS)
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(made[:50])], "doc_id long, text string")
    assert {x["doc_id"]: x["text"] for x in secret_scan.redact(secret_scan.redact(rows)).collect()} == {k: secret_scan.redacted(t) for k, t in enumerate(made[:50])}


def test_hex_runs_equal_the_pattern():
    r = random.Random(6)
    for _ in range(3000):
        t = "".join(r.choice(["0", "f", "a9", "g", " ", "c0ffee" * 3, "é"]) * r.randint(1, 9) for _ in range(r.randint(0, 12)))
        assert secret_scan.hex_runs(t) == [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]


# ---------------------------------------------------------------- HTML


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>one<p>two", "one\n\ntwo"),
        ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol><li>e</ul>", "- a\n- b\n  3. c\n  4. d\n- e"),
        ("<table><tr><th>Name<th>N<tr><td>long name<td>1<tr><td>x<td>22</table>", "Name       N\nlong name  1\nx          22"),
        ("<div hidden>no</div><p style='display: none'>no</p><script>if (a<b) {}</script><title>no</title>yes", "yes"),
        ("a<br>b<pre>  x\n   y</pre>c", "a\nb\n\n  x\n   y\n\nc"),
        ("<div>a<div>b</div>c</div>", "a\nb\nc"),
        ("x <b>bold</b>, <i> y</i>z", "x bold, yz"),
        ("<p>1 < 2 & 3 &bogus; <", "1 < 2 & 3 &bogus; <"),
        ("<table><tr><td colspan=2>wide cell here</td></tr><tr><td>a</td><td>b</td></tr></table>", "wide cell here\na  b"),
        ("<dl><dt>t<dd>d</dl>", "t\n    d"),
        ("</div></p>text<unclosed", "text"),
        ("<table><div><td>x</td></div></table>", "x"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a  b\n   c\nd  e"),
        ("<table><tr><td rowspan=2>a<td rowspan=2>b<td>c<tr><td>d</table>", "a  b  c\n      d"),
        ("<table><tr><td>a<td>b<td>c<tr><td colspan=2>wide cell<td>d</table>", "a  b  c\nwide cell  d"),
        ("<details><summary>s</summary>no</details><details open><summary>t</summary>yes</details>", "s\nt\nyes"),
        ("<p style='color:red /* display:none */'>yes", "yes"),
        ("<p style='color:red; DISPLAY : none !important'>no", ""),
        ("<svg><title>no</title><text>chart</text></svg> <math><mi>x</mi><annotation>no</annotation></math>", "chart x"),
    ],
)
def test_render(page, want):
    assert html_render.render(page) == want


def test_render_deep_and_long():
    n = 20000
    assert html_render.render("<div>" * n + "x" + "</div>" * n) == "x"
    assert html_render.render("<ul><li>" * 300 + "x").strip(" -\n") == "x"
    assert html_render.render("<p " * 5000) == ""
    assert html_render.render("<a '" * 3000 + "x") is not None


def test_render_equals_layout_of_generated_pages():
    """Pages made from blocks whose layout is known: the text is put together from the blocks, not from the markup."""
    r = random.Random(21)
    word = lambda: "".join(r.choice("abcdeé字") for _ in range(r.randint(1, 6)))
    wide = lambda t: sum(2 if c == "字" else 1 for c in t)
    gap = lambda: r.choice(["", " ", "\n", "  \n "])

    def phrase(n=4):
        words = [word() for _ in range(r.randint(1, n))]
        marked = [r.choice(["{}", "<b>{}</b>", "<span class='x'>{}</span>", "{}<!-- no -->", "{}<script>no()</script>", "{}<i hidden>no</i>"]).format(w) for w in words]
        return r.choice([" ", "\n", "  "]).join(marked), " ".join(words)

    def listing(depth=0):
        ordered, html_, lines = r.random() < 0.5, "", []
        first = r.randint(1, 9) if ordered and r.random() < 0.5 else None
        for k in range(r.randint(1, 3)):
            mark = f"{(first or 1) + k}. " if ordered else "- "
            text, shown = phrase()
            html_ += f"{gap()}<li>{text}"
            lines.append(mark + shown)
            if depth < 2 and r.random() < 0.3:
                inner, below = listing(depth + 1)
                html_ += inner
                lines += [" " * len(mark) + x for x in below]
            html_ += r.choice(["</li>", ""])
        tag = "ol" if ordered else "ul"
        return f"<{tag}{f' start={first}' if first else ''}>{html_}</{tag}>", lines

    def table():
        columns, rows = r.randint(1, 4), r.randint(1, 4)
        cells = [[phrase(2) for _ in range(columns)] for _ in range(rows)]
        widths = [max(wide(row[c][1]) for row in cells) for c in range(columns)]
        html_ = "<table>" + r.choice(["", "<tbody>"]) + "".join(gap() + "<tr>" + "".join(gap() + f"<td>{t}" + r.choice(["</td>", ""]) for t, _ in row) + r.choice(["</tr>", ""]) for row in cells) + "</table>"
        return html_, ["  ".join(s + " " * (w - wide(s)) for (_, s), w in zip(row, widths)).rstrip() for row in cells]

    for _ in range(600):
        page, blocks = "", []
        for _ in range(r.randint(1, 6)):
            kind = r.choice(["p", "h2", "list", "table", "pre", "hidden"])
            if kind in ("p", "h2"):
                text, shown = phrase(8)
                page += f"{gap()}<{kind}>{gap()}{text}{gap()}" + (f"</{kind}>" if kind == "h2" or r.random() < 0.5 else "")
                blocks.append([shown])
            elif kind == "list":
                markup, lines = listing()
                page += gap() + markup
                blocks.append(lines)
            elif kind == "table":
                markup, lines = table()
                page += gap() + markup
                blocks.append(lines)
            elif kind == "pre":
                lines = [word() + "  " + word() for _ in range(r.randint(1, 3))]
                page += "<pre>" + "\n".join(lines) + "</pre>"
                blocks.append(lines)
            else:
                page += r.choice(["<div style='display:none'>no<p>no</div>", "<template><p>no</template>", "<p hidden>no</p>"])
        assert html_render.render(page) == "\n\n".join("\n".join(b) for b in blocks), page


def test_render_random_pages():
    r = random.Random(8)
    tags = "table tr td th tbody thead caption div p pre ul li ol dl dt dd details summary select option svg title head body b span dialog textarea script".split()
    for _ in range(20_000):
        page = "x"
        for _ in range(r.randint(1, 14)):
            tag = r.choice(tags)
            page += r.choice([f"<{tag}>", f"<{tag} rowspan=2>", f"<{tag} colspan=3 hidden>", f"</{tag}>", f"</{tag}>", "yy zz", "\n", "&amp;", "<"])
        assert html_render.render(page).startswith("x")


def test_render_many_attributes_takes_linear_time():
    page = "<p " + "a='b' " * 100_000 + ">x" + "<table>" + "<td rowspan=60000 colspan=1000>y" * 300
    assert html_render.render(page).startswith("x")


def test_render_loses_no_letter(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r["page_id"]: r["text"] for r in queries.op7_visible_text(spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        body = re.sub(r"(?s)<!--.*?-->|<(script|style|title)\b.*?</\1>", " ", r["html"])
        words = html.unescape(re.sub(r"<[^>]*>", " ", body)).split()
        assert Counter("".join(words)) - Counter(got[r["page_id"]]) == Counter()


def test_render_edges(spark):
    rows = spark.createDataFrame([(1, None), (1, ""), (None, "<p>x")], "page_id long, html string").withColumn("text", F.lit("clash")).withColumn("key", F.lit(1))
    assert Counter((r["page_id"], r["text"]) for r in html_render.visible_text(rows).collect()) == Counter({(1, ""): 2, (None, "x"): 1})
    assert html_render.visible_text(rows.where("false")).count() == 0


# ---------------------------------------------------------------- quality


def measured(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + d for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for d in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n


def test_quality(spark, edge, texts):
    got = found(queries.op9_quality_rules(spark, SF))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for k, t in texts.items():
        assert tuple(got[k][n] for n in names) == measured(t)
        assert not (got[k]["kept"] and got[k]["base_failed"])
    r = random.Random(4)
    made = [(k + 100, " ".join(r.choice("abc") for _ in range(r.randint(0, 30))) + r.choice(["", "\n#\n#\n"]), None) for k in range(200)]
    rows = EDGE + made
    judged = quality.judge(spark.createDataFrame(rows, COLUMNS)).collect()
    assert Counter((x["doc_id"], *(x[n] for n in names)) for x in judged) == Counter((k, *measured(t)) for k, t, _ in rows)
    assert quality.judge(edge).count() == len(EDGE) and quality.judge(edge.where("false")).count() == 0


def test_quality_keeps_what_labels_call_good(spark):
    sf = "/root/testdata/sf0.01"
    good = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()}
    got = [r for r in queries.op9_quality_rules(spark, sf).collect() if r["doc_id"] in good and not r["base_failed"]]
    assert got and all(r["kept"] for r in got)


def test_quality_stays_in_the_jvm(docs):
    plan = quality.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


@pytest.mark.parametrize(
    "page,want",
    [
        ("<p title=it's>Hello</p> <b>I don't go</b><p>after</p>", "Hello\n\nI don't go\n\nafter"),
        ("<p title=it's>one quote only", "one quote only"),
        ("<a title='x>y' b=\"<i>\" c=d/e>t</a>", "t"),
        ("<plaintext>a<b>c", "a<b>c"),
        ("<ol reversed><li>a<li>b<li value=9>c<li>d</ol>", "4. a\n3. b\n9. c\n8. d"),
        ("<div style='visibility:hidden'>no<p style='visibility:visible'>yes</p></div>", "yes"),
        ("<svg><text><![CDATA[x<y]]></text></svg>", "x<y"),
        ("<p>a<![CDATA[x]]>b", "ab"),
        ("<style>/* .k{display:none} */ .x{display:none} #y, b.z {color:red;visibility:hidden} @media all { h1{display:none} }</style><p class='a x'>no<p id=y>no <i style='visibility: visible'>yes</i></p><b class=z>no</b><i class=z>ok</i><h1>no</h1><p class=k>k", "yes\n\nok\n\nk"),
        ("<style>.x{display:none}</style><p class=x style='display:block'>shown", "shown"),
    ],
)
def test_html_attributes_and_visibility(page, want):
    assert html_render.render(page) == want


@pytest.mark.parametrize(
    "page",
    [
        "<table>" + "<tr><td colspan=1000 rowspan=60000>x" * 20000,
        "<div>" * 20000 + "<option>" * 20000,
        "<li><ul>" + "<div>" * 20000 + "<li>" * 20000,
        "<b>" + "<table>" * 10000 + "</b>" * 10000,
        '<a x="' * 100000,
        "<a ='" * 100000,
        "<style>" + "{" * 300000 + "</style>",
        "<style>" + "a," * 300000 + "</style>",
    ],
)
def test_html_takes_linear_time(page):
    began = time.perf_counter()
    html_render.render(page)
    assert time.perf_counter() - began < 8


def test_personal_data_takes_linear_time():
    model = pii.loaded(pii.fitted())
    began = time.perf_counter()
    base, spans = pii.all_spans("a@b.cd xy " * 30000, model)
    assert len(base) == 30000 and time.perf_counter() - began < 10
