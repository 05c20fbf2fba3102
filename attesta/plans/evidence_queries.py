"""Queries of links in their sentences, vocabulary candidates and other evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.operators import links, similarity, speech
from attesta.plans.registry import query
from attesta.plans.store import Store

_SQUEEZE = r"trim(regexp_replace(coalesce({}, ''), '[\x01\x09-\x0D\x20]+', ' ', 'g'))"
_ABBREVIATED = "|".join(a.replace(".", r"\.") for a in links.ABBREVIATIONS)
# words with their places; a word closes a sentence by its last characters and the first of the next word
_SENTENCES = rf"""
  b AS (SELECT doc_id, block_no, page_no, t FROM (SELECT doc_id, block_no, page_no, {_SQUEEZE.format('text')} AS t FROM s_link_blocks) WHERE t <> ''),
  p AS (SELECT *, coalesce(sum(length(t) + 2) OVER (PARTITION BY doc_id ORDER BY block_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c0 FROM b),
  w AS (SELECT doc_id, block_no, c0, t, i, w[i] AS w, w[i + 1] AS nxt, c0 + i - 1 + coalesce(sum(length(w[i])) OVER (PARTITION BY doc_id, block_no ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
        FROM (SELECT doc_id, block_no, c0, t, w, unnest(generate_series(1, len(w))) AS i FROM (SELECT *, string_split(t, ' ') AS w FROM p))),
  e AS (SELECT *, nxt IS NULL OR (regexp_matches(w, '[{links.CLOSERS}]$') AND NOT regexp_matches(w, '[0-9][{links.CLOSERS}]$') AND NOT regexp_matches(w, '(^|[^\p{{L}}\p{{N}}_])({_ABBREVIATED})[{links.CLOSERS}]$') AND regexp_matches(nxt, '^[{links.OPENERS}]')) AS closes FROM w),
  n AS (SELECT *, coalesce(sum(cast(closes AS int)) OVER (PARTITION BY doc_id, block_no ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sentence_no FROM e),
  s AS (SELECT doc_id, block_no, cast(sentence_no AS int) AS sentence_no, min(pos) AS s0, max(pos + length(w)) AS s1, any_value(c0) AS c0, any_value(t) AS t FROM n GROUP BY doc_id, block_no, sentence_no)"""


def _spine(s: Store) -> DataFrame:
    return links.spine(s.link_blocks, "doc_id", "block_no", "page_no", "text")


@query(f"WITH {_SENTENCES} SELECT doc_id, block_no, sentence_no, cast(s0 AS bigint) AS sentence_start, cast(s1 AS bigint) AS sentence_end, substring(t, cast(s0 - c0 + 1 AS bigint), cast(s1 - s0 AS bigint)) AS sentence FROM s")
def sentence_spans(s: Store) -> DataFrame:
    """Sentences of every block with their places in the document."""
    return links.sentences(_spine(s), "doc_id", "block_no", "text")


_LINKED = rf"""{_SENTENCES},
  q AS (SELECT *, {_SQUEEZE.format('anchor_text')} AS a FROM s_links),
  f AS (SELECT q.id, arg_min(p.block_no, p.block_no) AS block, arg_min(p.c0 + strpos(p.t, q.a) - 1, p.block_no) AS a0 FROM q JOIN p ON p.doc_id = q.doc_id AND p.page_no = q.page_no AND q.a <> '' AND contains(p.t, q.a) GROUP BY q.id),
  o AS (SELECT q.doc_id, q.page_no, q.uri, arg_min({{'pos': p.c0 + strpos(p.t, x.s) - 1, 's': x.s, 'block': p.block_no}}, (x.answer_no, p.block_no)) AS o
        FROM (SELECT DISTINCT doc_id, page_no, uri FROM q WHERE id NOT IN (SELECT id FROM f)) q JOIN (SELECT *, {_SQUEEZE.format('sentence')} AS s FROM s_link_answers) x ON x.doc_id = q.doc_id AND x.page_no = q.page_no AND x.uri = q.uri AND x.s <> '' JOIN p ON p.doc_id = q.doc_id AND contains(p.t, x.s) GROUP BY ALL),
  l AS (SELECT q.id, q.doc_id, q.uri, q.page_no, CASE WHEN f.id IS NULL THEN coalesce(o.o.s, q.anchor_text) ELSE q.anchor_text END AS anchor_text, coalesce(f.a0, o.o.pos) AS char_start, coalesce(f.a0 + length(q.a), o.o.pos + length(o.o.s)) AS char_end, coalesce(f.block, o.o.block) AS block,
               CASE WHEN f.id IS NOT NULL THEN 'text' WHEN o.o IS NOT NULL THEN 'answer' END AS anchored_by FROM q LEFT JOIN f ON f.id = q.id LEFT JOIN o ON o.doc_id = q.doc_id AND o.page_no = q.page_no AND o.uri = q.uri),
  c AS (SELECT l.id, min(s.s0) AS s0, max(s.s1) AS s1, any_value(s.c0) AS c0, any_value(s.t) AS t FROM l JOIN s ON s.doc_id = l.doc_id AND s.block_no = l.block AND s.s0 < l.char_end AND s.s1 > l.char_start GROUP BY l.id)"""


@query(f"""
WITH {_LINKED} SELECT l.id, l.uri, l.page_no, l.anchor_text, cast(l.char_start AS bigint) AS char_start, cast(l.char_end AS bigint) AS char_end, l.block, l.anchored_by, substring(t, cast(s0 - c0 + 1 AS bigint), cast(s1 - s0 AS bigint)) AS context_sentence, cast(s0 AS bigint) AS context_start, cast(s1 AS bigint) AS context_end
FROM l LEFT JOIN c ON c.id = l.id""")
def link_sentences(s: Store) -> DataFrame:
    """Every link with the sentence that cites it: anchors verbatim on their page, else an answer that quotes the document, else none."""
    placed = _spine(s)
    located = links.locate_anchors(s.links, placed, "doc_id", "page_no", "block_no", "text")
    known = links.accept_anchors(located, s.link_answers, placed, "doc_id", "page_no", "block_no", "text", "answer_no")
    told = links.with_context(known, placed, "doc_id", "block_no", "text")
    return told.select("id", "uri", "page_no", "anchor_text", "char_start", "char_end", "block", "anchored_by", "context_sentence", "context_start", "context_end")


# ---------------------------------------------------------------- vocabulary


def _readings(s: Store) -> DataFrame:
    """Three systems' readings of every turn: as it is, with other spellings, and with other spellings and words left out."""
    c = s.raw("conversations").select(F.concat_ws("-", "conv_id", "turn").alias("clip"), "text")
    read = {"a": F.col("text"), "b": F.regexp_replace("text", "ou|tion", "u"), "c": F.regexp_replace(F.regexp_replace("text", "er(?=[a-z])", "ar"), " (le|th|de) ", " um ")}
    return c.select("clip", F.explode(F.array(*[F.struct(F.lit(k).alias("system"), v.alias("text")) for k, v in read.items()])).alias("r")).select("clip", "r.*")


@query()
def reading_dissents(s: Store) -> DataFrame:
    """Where one of three systems is alone; tested against a direct loop."""
    return speech.dissents(_readings(s))


@query()
def vocabulary_candidates(s: Store) -> DataFrame:
    """Words that the systems spell in several ways, by clip; tested against a direct loop."""
    told = speech.vocabulary_candidates(speech.dissents(_readings(s)))
    return told.withColumn("variants", F.array_join(F.transform(F.map_entries("variants"), lambda e: F.concat_ws("=", e["key"], e["value"])), ","))


_LEAST = 0.8


@query(f"""
WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{{4,}}')) AS w FROM conversations)
SELECT a, b, distance, round(1 - distance / greatest(length(a), length(b)), 4) AS similarity FROM (
  SELECT x.w AS a, y.w AS b, levenshtein(x.w, y.w) AS distance FROM w x JOIN w y ON x.w < y.w AND abs(length(x.w) - length(y.w)) <= {1 - _LEAST} * greatest(length(x.w), length(y.w)) + 1e-9)
WHERE 1 - distance / greatest(length(a), length(b)) >= {_LEAST} - 1e-9""")
def spelling_variants(s: Store) -> DataFrame:
    """Words of all turns that are one spelling apart or nearly so."""
    words = s.raw("conversations").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{4,})"))).alias("word"))
    return similarity.edit_pairs(words, least=_LEAST)
