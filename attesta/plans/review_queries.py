"""Queries of reviews that come back, of differing words, second readings and the catalog."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.operators import review, speech
from attesta.plans.registry import query
from attesta.plans.store import Store
from attesta.sources import calendar, records

_DECISIONS = ["speaker", "fix", "flag"]
_FLAGS = ("wrong", "unclear")


def _three_way(c: str) -> str:
    same = lambda a, b: f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}"
    return f"CASE WHEN {same('s', 'b')} THEN c.{c} WHEN {same('c', 'b')} OR {same('c', 's')} THEN s.{c} ELSE c.{c} END"


_SHEET = """
  s AS (SELECT row_no, nullif(trim(row_key), '') AS row_key, nullif(trim(text), '') AS text, nullif(trim(speaker), '') AS speaker, nullif(trim(fix), '') AS fix, nullif(trim(flag), '') AS flag, count(*) OVER (PARTITION BY nullif(trim(row_key), '')) AS n FROM s_review_sheet),
  b AS (SELECT * FROM s_review_base), c AS (SELECT * FROM s_review_current)"""


@query(f"""
WITH {_SHEET}, t AS (SELECT s.row_key, {', '.join(f'{_three_way(c)} AS {c}' for c in _DECISIONS)} FROM s JOIN b ON b.row_key = s.row_key LEFT JOIN c ON c.row_key = s.row_key WHERE s.n = 1),
  m AS (SELECT coalesce(c.row_key, t.row_key) AS row_key, {', '.join(f'CASE WHEN t.row_key IS NOT NULL THEN t.{c} ELSE c.{c} END AS {c}' for c in _DECISIONS)} FROM c FULL JOIN t ON t.row_key = c.row_key)
SELECT * FROM m WHERE speaker IS NOT NULL OR fix IS NOT NULL OR flag IS NOT NULL""")
def reviewed_decisions(s: Store) -> DataFrame:
    """Decisions after a reviewed sheet is merged with what was decided meanwhile."""
    return review.import_review(s.review_base, s.review_sheet, s.review_current, "row_key", ["text"], _DECISIONS, {"flag": _FLAGS})[0]


@query(f"""
WITH {_SHEET}, j AS (SELECT s.*, b.row_key IS NOT NULL AS known, b.text AS b_text, {', '.join(f'b.{c} AS b_{c}, c.{c} AS c_{c}' for c in _DECISIONS)}, s.speaker IS NOT NULL OR s.fix IS NOT NULL OR s.flag IS NOT NULL AS said FROM s LEFT JOIN b ON b.row_key = s.row_key LEFT JOIN c ON c.row_key = s.row_key)
SELECT row_no, row_key, 'no key' AS finding, NULL AS column_name, NULL AS before, NULL AS after FROM j WHERE row_key IS NULL AND said
UNION ALL SELECT row_no, row_key, 'orphan', NULL, NULL, NULL FROM j WHERE row_key IS NOT NULL AND NOT known AND said
UNION ALL SELECT row_no, row_key, 'repeated', NULL, NULL, NULL FROM j WHERE known AND n > 1
UNION ALL SELECT row_no, row_key, 'tampered', 'text', b_text, text FROM j WHERE known AND n = 1 AND text IS NOT NULL AND text IS DISTINCT FROM b_text
UNION ALL SELECT row_no, row_key, 'unknown', 'flag', NULL, flag FROM j WHERE known AND n = 1 AND flag IS NOT NULL AND lower(flag) NOT IN {_FLAGS}
""" + "".join(f"UNION ALL SELECT row_no, row_key, 'conflict', '{c}', c_{c}, {c} FROM j WHERE known AND n = 1 AND {c} IS DISTINCT FROM b_{c} AND c_{c} IS DISTINCT FROM b_{c} AND c_{c} IS DISTINCT FROM {c}\n" for c in _DECISIONS))
def review_findings(s: Store) -> DataFrame:
    """What a reviewed sheet has that can't simply be taken."""
    return review.import_review(s.review_base, s.review_sheet, s.review_current, "row_key", ["text"], _DECISIONS, {"flag": _FLAGS})[1]


@query("""
WITH k AS (SELECT w FROM (SELECT DISTINCT id, unnest(regexp_extract_all(lower(coalesce(ours, '')), '[a-z0-9'']+')) AS w FROM s_renderings) GROUP BY w HAVING count(*) >= 2),
     o AS (SELECT id, w, count(*) AS n FROM (SELECT id, unnest(regexp_extract_all(lower(coalesce(ours, '')), '[a-z0-9'']+')) AS w FROM s_renderings) GROUP BY 1, 2), t AS (SELECT id, w, count(*) AS n FROM (SELECT id, unnest(regexp_extract_all(lower(coalesce(theirs, '')), '[a-z0-9'']+')) AS w FROM s_renderings) GROUP BY 1, 2),
     d AS (SELECT coalesce(o.id, t.id) AS id, greatest(coalesce(t.n, 0) - coalesce(o.n, 0), 0) AS lost, greatest(coalesce(o.n, 0) - coalesce(t.n, 0), 0) AS more, k.w IS NOT NULL AS known FROM o FULL JOIN t ON t.id = o.id AND t.w = o.w LEFT JOIN k ON k.w = coalesce(o.w, t.w)),
     g AS (SELECT id, sum(lost) AS lost, sum(more) AS more, coalesce(sum(lost) FILTER (WHERE known), 0) AS ml, coalesce(sum(more) FILTER (WHERE known), 0) AS el FROM d GROUP BY id),
     x AS (SELECT id, trim(regexp_replace(coalesce(ours, ''), '\\s+', ' ', 'g')) AS a, trim(regexp_replace(coalesce(theirs, ''), '\\s+', ' ', 'g')) AS b FROM s_renderings)
SELECT x.id, cast(coalesce(lost, 0) AS bigint) AS missing, cast(coalesce(more, 0) AS bigint) AS extra, round(ml / nullif(lost, 0), 4) AS missing_real, round(el / nullif(more, 0), 4) AS extra_real, starts_with(b, a) AND length(b) > length(a) AND a <> '' AND NOT regexp_matches(a, '[.!?:][''")]*$') AS truncated
FROM x LEFT JOIN g ON g.id = x.id""")
def word_realness(s: Store) -> DataFrame:
    """Words that one of two renderings of a turn lacks, and how many of them are words that other turns use."""
    pairs = s.renderings
    return review.differing_words(pairs, review.lexicon(pairs, "ours"), "id")


@query("""
WITH s AS (SELECT conv_id * 1000 + turn AS id, sha256(text) AS content_hash, text FROM conversations),
     w AS (SELECT id, content_hash, list_distinct(list_filter(string_split_regex(regexp_replace(lower(text), '[^a-z0-9 ]', ' ', 'g'), ' +'), lambda x: x <> '')) AS w, id % 5 AS m,
                  list_distinct(list_filter(string_split_regex(regexp_replace(lower(replace(text, CASE WHEN id % 3 = 0 THEN 'en' ELSE '#' END, 'an')), '[^a-z0-9 ]', ' ', 'g'), ' +'), lambda x: x <> '')) AS o FROM s),
     l AS (SELECT *, list_sort(list_filter(w, lambda x: NOT list_contains(o, x))) AS lost FROM w)
SELECT id, CASE WHEN m = 0 THEN NULL WHEN len(lost) = 0 THEN concat('reader ', id % 2) END AS corroborated, CASE WHEN m = 0 OR len(lost) = 0 THEN NULL ELSE array_to_string(lost[1:20], '|') END AS conflicts, CASE WHEN m = 0 THEN 'clean' ELSE 'unaudited' END AS confidence FROM l""")
def second_read_flags(s: Store) -> DataFrame:
    """Sections' flags after a second reading, kept by content: a reading of a text that has changed since is not one of this text."""
    c = s.raw("conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.sha2("text", 256).alias("content_hash"), "text")
    stale = F.create_map(F.lit("ocr_conflicts"), F.lit("old"), F.lit("has_ocr_blocks"), F.lit("yes"))
    sections = c.withColumns({"parse_flags": stale, "parse_confidence": F.lit("clean")})
    other = F.replace(F.col("text"), F.when(F.col("id") % 3 == 0, "en").otherwise("#"), F.lit("an"))
    reads = c.select("id", F.when(F.col("id") % 5 == 0, F.concat("content_hash", F.lit("x"))).otherwise(F.col("content_hash")).alias("content_hash"), other.alias("other"), F.concat(F.lit("reader "), (F.col("id") % 2).cast("string")).alias("reader"))
    told = review.apply_second_reads(sections, reads)
    flag = lambda name: F.try_element_at("parse_flags", F.lit(name))
    return told.select("id", flag("ocr_corroborated").alias("corroborated"), flag("ocr_conflicts").alias("conflicts"), F.col("parse_confidence").alias("confidence"))


_TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@query(" UNION ALL ".join(f"SELECT table_name, column_name, ordinal_position AS position, (SELECT count(*) FROM {t}) AS n_rows FROM information_schema.columns WHERE table_name = '{t}'" for t in _TABLES))
def table_columns(s: Store) -> DataFrame:
    """Tables, their columns and row counts, by the catalog."""
    return review.described(s.spark, {t: s.raw(t) for t in _TABLES}).select("table_name", "column_name", "position", "n_rows")


# ---------------------------------------------------------------- sources

_PLAIN = "replace(replace(replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', chr(39)), '&nbsp;', ' '), '&amp;', '&')"
_BARE = r"regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>', ' ', 'g'), '(?is)<style\b.*?</style\s*>', ' ', 'g'), '(?i)<br\s*/?>|</p>|</div>|</tr>|</li>', chr(10), 'g')"


@query(rf"""
SELECT page_id, trim(regexp_replace({_PLAIN.format(f"regexp_replace({_BARE}, '<[^>]+>', ' ', 'g')")}, '\s*\n\s*\n\s*(\n\s*)*', chr(10) || chr(10), 'g')) AS body, starts_with(html, '%PDF-') AS pdf FROM pages""")
def page_bodies(s: Store) -> DataFrame:
    """What a fetched page says, and whether it is a PDF."""
    return s.raw("pages").select("page_id", calendar.visible_body(F.col("html")).alias("body"), calendar.is_pdf(F.col("html"), F.lit(None).cast("string")).alias("pdf"))


@query("""
WITH f AS (SELECT DISTINCT l_orderkey * 10 + l_linenumber AS id, cast(l_partkey % 50 AS int) AS page_no, concat('Figure ', l_suppkey % 9) AS top_label FROM lineitem),
     p AS (SELECT cast(p_partkey % 50 AS int) AS page_no, concat('Figure ', p_size % 11) AS top_label, p_size % 5 / 10.0 AS area_frac, p_partkey % 7 AS x0, p_partkey AS y0 FROM part),
     r AS (SELECT *, row_number() OVER (PARTITION BY page_no, top_label ORDER BY area_frac DESC, x0, y0) AS rn FROM p)
SELECT f.id, f.page_no, f.top_label, cast(r.x0 AS bigint) AS x0, cast(r.y0 AS bigint) AS y0, cast(r.area_frac AS double) AS area_frac FROM f LEFT JOIN r ON r.page_no = f.page_no AND r.top_label = f.top_label AND rn = 1""")
def pictured_figures(s: Store) -> DataFrame:
    """Figures with the picture under the same label of their page, the largest of several."""
    figures = s.raw("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), (F.col("l_partkey") % 50).cast("int").alias("page_no"), F.concat(F.lit("Figure "), (F.col("l_suppkey") % 9).cast("string")).alias("top_label")).distinct()
    k = F.col("p_partkey")
    pictures = s.raw("part").select((k % 50).cast("int").alias("page_no"), F.concat(F.lit("Figure "), (F.col("p_size") % 11).cast("string")).alias("top_label"), (F.col("p_size") % 5 / 10.0).alias("area_frac"), F.array((k % 7).cast("long"), k.cast("long")).alias("bbox"))
    told = records.figures_with_pictures(figures, pictures)
    return told.select("id", "page_no", "top_label", F.get("picture_bbox", F.lit(0)).alias("x0"), F.get("picture_bbox", F.lit(1)).alias("y0"), "area_frac")


@query("""
SELECT asked, count(*) AS events, min(event_date) AS first_date FROM (
  SELECT 'all' AS asked, event_date FROM s_events UNION ALL SELECT 'body', event_date FROM s_events WHERE body_id = 3 UNION ALL SELECT 'date', event_date FROM s_events WHERE event_date >= DATE '1996-01-01' UNION ALL SELECT 'both', event_date FROM s_events WHERE body_id = 3 AND event_date >= DATE '1996-01-01') GROUP BY asked""")
def events_since(s: Store) -> DataFrame:
    """Meetings by a body and a first date, either of which may be left out."""
    rows = s.events.select(F.col("body_id").cast("string").alias("EventBodyName"), F.col("event_date").cast("string").alias("EventDate"))
    asked = {"all": (None, None), "body": ("3", None), "date": (None, "1996-01-01"), "both": ("3", "1996-01-01")}
    parts = [records.since(rows, *conditions).select(F.lit(name).alias("asked"), F.col("EventDate").cast("date").alias("event_date")) for name, conditions in asked.items()]
    return reduce(DataFrame.unionAll, parts).groupBy("asked").agg(F.count("*").alias("events"), F.min("event_date").alias("first_date"))


@query()
def chunk_seams(s: Store) -> DataFrame:
    """Words of chunks that overlap by a second, each once; tested against a direct loop."""
    w = s.words.select("id", "media_id", "text", "start_ms", "end_ms")
    chunk = F.floor(F.col("start_ms") / 60000)
    late = w.where(F.col("start_ms") % 60000 < 1000).withColumn("chunk", chunk - 1)
    return speech.drop_seams(w.withColumn("chunk", chunk).unionByName(late)).select("media_id", "id", "chunk")
