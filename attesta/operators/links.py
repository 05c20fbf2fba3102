"""Links and the sentences that cite them.

A document's blocks make one text, its spine: white space within a block is one space, a blank line parts blocks.
All offsets are code points of the spine, so links, sentences and claims share one coordinate system. Pages and
documents are taken to fit a task; links are never paired with blocks or sentences but sorted among them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attesta.operators.intervals import last_start

#: Words whose full stop ends no sentence. Fixed values.
ABBREVIATIONS = ("Dr", "Mr", "Mrs", "Ms", "St", "Ave", "Inc", "No", "U.S")
#: A sentence ends at one of these marks before white space and one of OPENERS, unless a digit or an abbreviation stands before it.
CLOSERS, OPENERS = ".!?", '"“(A-Z0-9-'
#: Marks sentence ends while a text is cut; counts as white space in the input.
_MARK = "\x01"
_BREAK = "\n\n"


def squeezed(text: Column) -> Column:
    """White space as single spaces, none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x01\x09-\x0D\x20]+", " "))


def _sentence_end() -> str:
    before = "".join(rf"(?<!(?<![\p{{L}}\p{{N}}_]){a.replace('.', chr(92) + '.')})" for a in ABBREVIATIONS)
    return rf"(?<![0-9]){before}[{CLOSERS}](?= [{OPENERS}])"


def spine(blocks: DataFrame, key: str, order: str, page: str, text: str) -> DataFrame:
    """Blocks with ``text`` squeezed, char_start and char_end in the spine, page_start in the text of their page alone. Empty blocks aren't in it."""
    kept = blocks.withColumn(text, squeezed(F.col(text))).where(F.col(text) != "")
    length = F.char_length(text) + len(_BREAK)
    before = lambda *keys: F.coalesce(F.sum(length).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = kept.withColumn("char_start", before(key)).withColumn("page_start", before(key, page))
    return placed.withColumn("char_end", F.col("char_start") + F.char_length(text))


def sentences(placed: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """(key, order, sentence_no, sentence_start, sentence_end, sentence) of a spine's blocks; a block's end always ends a sentence."""
    parts = F.split(F.regexp_replace(text, _sentence_end(), f"$0{_MARK}"), _MARK)
    cut = placed.select(key, order, "char_start", F.posexplode(parts).alias("sentence_no", "_part"))
    w = Window.partitionBy(key, order).orderBy("sentence_no").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("char_start") + F.coalesce(F.sum(F.char_length("_part")).over(w), F.lit(0))
    told = cut.withColumn("_at", at).withColumn("sentence", F.ltrim("_part"))
    start = F.col("_at") + F.char_length("_part") - F.char_length("sentence")
    return told.select(key, order, "sentence_no", start.alias("sentence_start"), (F.col("_at") + F.char_length("_part")).alias("sentence_end"), "sentence")


def with_context(spans: DataFrame, placed: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """``spans`` (key, char_start, char_end) with context_sentence, context_start and context_end: the sentences of its block that a span touches.

    A space between two sentences belongs to the later one. Spans without a start have none.
    """
    marks = sentences(placed, key, order, text).withColumn("_edge", F.when(F.col("sentence_no") == 0, F.col("sentence_start")).otherwise(F.col("sentence_start") - 1))
    known = spans.where("char_start is not null").withColumn("_last", F.greatest(F.col("char_end") - 1, F.col("char_start")))
    first = last_start(known, marks.select(key, "_edge", F.col("sentence_start").alias("context_start")), [key], "char_start", "_edge", ["context_start"], "context_start")
    both = last_start(first, marks.select(key, "_edge", F.col("sentence_end").alias("context_end")), [key], "_last", "_edge", ["context_end"], "context_end")
    blocks = placed.select(key, F.col("char_start").alias("_block"), F.col(text).alias("_text"))
    held = last_start(both, blocks, [key], "char_start", "_block", ["_block", "_text"], "_block")
    sentence = F.substr(F.col("_text"), F.col("context_start") - F.col("_block") + 1, F.col("context_end") - F.col("context_start"))
    told = held.withColumn("context_sentence", sentence).select(*spans.columns, "context_sentence", "context_start", "context_end")
    none = F.lit(None)
    return told.unionByName(spans.where("char_start is null").withColumns({"context_sentence": none.cast("string"), **{c: none.cast(told.schema[c].dataType) for c in ("context_start", "context_end")}}))


def locate_anchors(links: DataFrame, placed: DataFrame, key: str, page: str, order: str, text: str, anchor: str = "anchor_text") -> DataFrame:
    """``links`` with char_start, char_end, block (its order) and located: the first place on its page that holds the anchor word for word.

    Verbatim but for white space, or not at all: an anchor that no block holds stays unlocated.
    """
    pages = placed.groupBy(key, page).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, F.col(text).alias("_t")))), lambda b: b["_t"]), _BREAK).alias("_page"))
    sought = links.withColumn("_anchor", squeezed(F.col(anchor)))
    at = F.when(F.col("_anchor") != "", F.nullif(F.instr("_page", F.col("_anchor")), F.lit(0)) - 1)
    found = sought.join(pages, [key, page], "left").withColumn("_at", at).drop("_page")
    blocks = placed.select(key, page, "page_start", "char_start", F.col(order).alias("block"))
    met = last_start(found.where("_at is not null"), blocks, [key, page], "_at", "page_start", ["page_start", "char_start", "block"], "block")
    start = F.col("char_start") + F.col("_at") - F.col("page_start")
    told = met.withColumn("_start", start).select(*links.columns, F.col("_start").alias("char_start"), (F.col("_start") + F.char_length("_anchor")).alias("char_end"), "block", F.lit(True).alias("located"))
    none = {c: F.lit(None).cast(told.schema[c].dataType) for c in ("char_start", "char_end", "block")}
    return told.unionByName(found.where("_at is null").select(*links.columns).withColumns({**none, "located": F.lit(False)}))


def accept_anchors(links: DataFrame, answers: DataFrame, placed: DataFrame, key: str, page: str, order: str, text: str, tie: str) -> DataFrame:
    """Located links, the unlocated ones taken from ``answers`` (key, page, uri, sentence, ``tie``) where that quotes the document.

    An answer counts only if the spine holds its sentence word for word, at its first place; the first such
    answer by ``tie`` for a key, uri and page is taken, and one that a text match placed is never touched.
    Adds anchored_by: text, answer or null.
    """
    quoted = answers.join(links.where("not located").select(key, page, "uri").distinct(), [key, page, "uri"], "left_semi").withColumn("_quote", squeezed(F.col("sentence"))).where("_quote <> ''")
    texts = placed.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, F.col(text).alias("_t")))), lambda b: b["_t"]), _BREAK).alias("_spine"))
    found = quoted.join(texts, key).withColumn("_at", F.instr("_spine", F.col("_quote")) - 1).where("_at >= 0")
    best = found.groupBy(key, page, "uri").agg(F.min_by(F.struct("_at", "_quote"), F.struct(tie, "_quote")).alias("_a"))
    blocks = placed.select(key, F.col("char_start").alias("_start"), F.col(order).alias("_block"))
    placed_ = last_start(best.select(key, page, "uri", F.col("_a._at").alias("_at"), F.col("_a._quote").alias("_quote")), blocks, [key], "_at", "_start", ["_block"], "_start")
    met = links.join(placed_, [key, page, "uri"], "left")
    use = ~F.col("located") & F.col("_at").isNotNull()
    pick = {"char_start": F.col("_at"), "char_end": F.col("_at") + F.char_length("_quote"), "block": F.col("_block"), "located": F.lit(True), "anchor_text": F.col("_quote")}
    by = F.when(use, "answer").when(F.col("located"), "text")
    return met.withColumn("anchored_by", by).select(*[F.when(use, pick[c]).otherwise(F.col(c)).alias(c) if c in pick else F.col(c) for c in links.columns], "anchored_by")
