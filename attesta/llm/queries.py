"""The queries opN_<name> over the driver's tables, and SQL for those that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm import bpe, common, decontam, divergence, html_render, mpeg_audio, periodic, pii, quality, secret_scan, sharding, simhash, token_count, toxicity

BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BPE_MODEL = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
_SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    common.bounded_batches(spark)
    return common.table(spark, sf_dir, name)


def count_kind(spans: str, kind: str) -> F.Column:
    """How many of the comma-joined spans are of the kind."""
    return F.size(F.filter(F.split(spans, ","), lambda s: s.startswith(f"{kind}:"))).cast("long").alias(f"n_{kind}")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), BPE_RANKS, PATTERN)


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *(count_kind("base", k) for k in pii.KINDS), F.sha2("base", 256).alias("base_sha256"), "spans")


def op3_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), BPE_MODEL, PATTERN)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *(count_kind("base", k) for k in secret_scan.KINDS[:3]), F.sha2("base", 256).alias("base_sha256"), "spans")


def op7_visible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_render.visible_text(table(spark, sf_dir, "pages"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = mpeg_audio.describe(mpeg_audio.store(table(spark, sf_dir, "documents")))
    feature = F.concat_ws(
        ";",
        *(F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in ("version", "layer", "rate", "channels", "frames", "samples")),
        F.concat(F.lit("microseconds="), F.expr("samples * 1000000 div rate").cast("string")),
        *(F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in ("variable", "table", "table_ok", "table_intact", "music_ok", "checked", "failed", "resyncs", "skipped", "seek_crc32")),
    )
    return read.select(
        "doc_id",
        F.col("tags")["text_bytes"].cast("long").alias("n_bytes"),
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -mpeg_audio.BLOCK, mpeg_audio.BLOCK)).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        feature.alias("feature"),
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): texts of a tenth of the documents, by the checksum of doc_id, go on periodically from some word."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, F.filter(F.split("text", _SPACES), lambda w: w != "")).alias("w"))
    n, g = F.size("w"), F.floor(F.col("h") / 10)
    a = F.when(n > 0, (g % n).cast("int"))
    placed = words.withColumns({"n": n, "g": g, "a": a})
    placed = placed.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    copies = F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int"))
    periodic = F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(F.flatten(copies), F.lit(1), rest))
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(periodic, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    top = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("before"), (-r.period).alias("shortness"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = found.withColumn("top", top)
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.before")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.shortness")).alias("period"),
        F.expr("1000 * top.length div -top.shortness").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_byte_bpe, op2_personal_data, op3_rendezvous_shards, op4_token_counts, op5_toxicity, op6_secrets, op7_visible_text, op8_simhash, op9_quality_rules, op10_decontamination, op11_mpeg_audio, op12_source_divergence, op13_periodic_runs)
}

_STOP = ", ".join(f"'{w}'" for w in sorted(set(quality.STOP_WORDS.split())))
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _rules_sql() -> str:
    """The table of quality rules as SQL over the same figures."""
    figures = {
        "n_words": "n_words",
        "word_length": "word_chars / greatest(n_words, 1)",
        "symbols_per_word": "n_symbols / greatest(n_words, 1)",
        "stop_words": "n_stop / greatest(n_words, 1)",
        "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
        "repeat_words": "n_repeat_words / greatest(n_words, 1)",
    }
    bounds = [(figures[r.figure], op, v) for r in quality.RULES for op, v in ((">=", r.least), ("<=", r.most)) if v is not None]
    return " AND ".join(f"{figure} {op} {value}" for figure, op, value in bounds)


ORACLE_SQL: dict[str, str] = {
    "op9_quality_rules": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
     w AS (SELECT r, doc_id, t, list_filter(string_split_regex(t, '{_SPACES}'), lambda x: x <> '') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
     g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM w WHERE len(w) >= 3)),
     s AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
     c AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM s) GROUP BY r),
     f AS (SELECT w.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS n_stop, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words FROM w LEFT JOIN c ON c.r = w.r),
     b AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_rules_sql()} AS kept FROM b""",
    # the definition itself: every window that shares a shingle with an item of its length, compared exactly
    "op10_decontamination": f"""
WITH i AS (SELECT item_id, w, len(w) AS n, least({decontam.SHINGLE}, len(w)) AS q FROM (SELECT item_id, list_filter(string_split_regex(translate(text, '{_CAPITALS}', '{_CAPITALS.lower()}'), '{_SPACES}'), lambda x: x <> '') AS w FROM benchmark WHERE text IS NOT NULL) WHERE len(w) > 0),
     ig AS (SELECT item_id, n, q, g, count(*) AS c FROM (SELECT item_id, n, q, unnest(list_transform(generate_series(1, n - q + 1), lambda k: array_to_string(w[k:k + q - 1], ' '))) AS g FROM i) GROUP BY ALL),
     total AS (SELECT item_id, sum(c) AS c FROM ig GROUP BY 1),
     d AS (SELECT doc_id, list_filter(string_split_regex(translate(text, '{_CAPITALS}', '{_CAPITALS.lower()}'), '{_SPACES}'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
     dg AS (SELECT doc_id, len(w) AS m, q, k - 1 AS p, array_to_string(w[k:k + q - 1], ' ') AS g FROM (SELECT doc_id, w, q, unnest(generate_series(1, len(w) - q + 1)) AS k FROM d, (SELECT DISTINCT q FROM i) WHERE len(w) >= q)),
     hit AS (SELECT dg.doc_id, dg.m, dg.p, ig.item_id, ig.n, ig.q, ig.g, ig.c FROM dg JOIN ig ON ig.q = dg.q AND ig.g = dg.g),
     start AS (SELECT DISTINCT doc_id, item_id, n, q, unnest(generate_series(least(greatest(p - n + q, 0), greatest(m - n, 0)), least(p, greatest(m - n, 0)))) AS s FROM hit),
     seen AS (SELECT start.doc_id, start.item_id, s, hit.g, hit.c, count(*) AS got FROM start JOIN hit ON hit.doc_id = start.doc_id AND hit.item_id = start.item_id AND hit.p BETWEEN s AND s + start.n - start.q GROUP BY ALL),
     sim AS (SELECT seen.doc_id, seen.item_id, s, sum(least(seen.c, got)) / any_value(total.c) AS similarity FROM seen JOIN total ON total.item_id = seen.item_id GROUP BY seen.doc_id, seen.item_id, s)
SELECT doc_id, item_id, cast(max(similarity) AS double) AS similarity, arg_min(s, (-similarity, s)) AS first_word FROM sim WHERE similarity >= {decontam.SIMILARITY} GROUP BY doc_id, item_id""",
    # the definition itself: every kept term in every group, also where it doesn't occur
    "op12_source_divergence": f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
     w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, '{_CAPITALS}', '{_CAPITALS.lower()}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
     k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= {divergence.LEAST_DOCUMENTS}),
     g AS (SELECT DISTINCT lang, source FROM d),
     c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
     v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
     t AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
     p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (cast({divergence.SCALE} AS HUGEINT) * (coalesce(c.n, 0) + 1)) // cast(coalesce(t.n, 0) + v.v AS HUGEINT) AS p
           FROM g JOIN k ON k.lang = g.lang JOIN v ON v.lang = g.lang LEFT JOIN t ON t.lang = g.lang AND t.source = g.source LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
     q AS (SELECT c.lang, c.term, 1 + (cast({divergence.SCALE} AS HUGEINT) * cast(sum(c.n) + 1 AS HUGEINT)) // cast(any_value(a.n) + any_value(v.v) AS HUGEINT) AS q FROM c JOIN (SELECT lang, sum(n) AS n FROM t GROUP BY lang) a ON a.lang = c.lang JOIN v ON v.lang = c.lang GROUP BY c.lang, c.term),
     s AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
     pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, cast(coalesce(s.value, 0) AS BIGINT) AS value FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
     terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, cast(((p.p - q.q) * (p.p - q.q)) // q.q AS BIGINT) AS value FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q)
SELECT *, cast(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank FROM pairs
UNION ALL SELECT * FROM (SELECT *, cast(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank FROM terms) WHERE rank <= {divergence.TOP_TERMS}""",
}
