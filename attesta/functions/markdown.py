"""Markdown normalisers: heading levels to sections and labels, page sources to page comments.

Lines and blocks are rows, and what carries forward (an open figure, the first heading, the page) is a
running value in a window over one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The marks of headings, figures, page sources and front matter; the level from which a heading is a label.
HEADING = r"^(#{1,6})\s+(.*?)\s*#*\s*$"
FIGURE_OPEN, FIGURE_CLOSE = r"^\s*<figure_description", "</figure_description>"
NO_TITLE = ("<!--", ">", "|", "-", "[", "<")
SOURCE = r"[ \t]*\[Source:\s*Page\s+(\d+)\]"
FRONT_MATTER = r"(?s)\A\s*---\s*\n(.*?)\n---\s*\n"
SCALAR = r"^([A-Za-z_][\w-]*):\s*(.*?)\s*$"
LABEL_FROM = 4


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _joined(rows: DataFrame, key: str, order: list[str], part: str, gap: str) -> DataFrame:
    return rows.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(part).alias("_p")))), lambda x: x["_p"]), gap).alias("markdown"))


def reheading(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, markdown, title_promoted, to_section, to_label, unchanged): level 2 for sections, bold for deeper headings, level 1 for the first prose line before any heading.

    Figures stay as they are. Texts that are null or empty come out empty.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = docs.select(key, F.posexplode(F.split(F.regexp_replace(whole, r"\n$", ""), "\n")).alias("pos", "line"))
    w = Window.partitionBy(key).orderBy("pos")
    upto, earlier = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    opened = F.max(F.when(F.col("line").rlike(FIGURE_OPEN), F.col("pos"))).over(upto)
    closed = F.max(F.when(F.contains("line", F.lit(FIGURE_CLOSE)), F.col("pos"))).over(earlier)
    marked = lines.withColumn("figure", F.coalesce(opened > F.coalesce(closed, F.lit(-1)), F.lit(False))).withColumn("s", _stripped(F.col("line")))
    marked = marked.withColumn("hashes", F.when(~F.col("figure"), F.char_length(F.regexp_extract("s", HEADING, 1)))).withColumn("heading", F.coalesce(F.col("hashes") > 0, F.lit(False)))
    special = F.lit(False)
    for mark in NO_TITLE:
        special = special | F.startswith("s", F.lit(mark))
    before = F.coalesce(F.bool_or("heading").over(earlier), F.lit(False))
    prose = ~F.col("figure") & ~F.col("heading") & (F.col("s") != "") & ~special & ~before
    marked = marked.withColumn("prose", prose).withColumn("title", F.col("prose") & (F.count_if("prose").over(upto) == 1))
    title, said = F.col("title"), F.regexp_extract("s", HEADING, 2)
    label, level2 = F.col("heading") & (F.col("hashes") >= LABEL_FROM), F.col("heading") & (F.col("hashes") == 2)
    out = F.when(title, F.concat(F.lit("# "), "s")).when(label, F.concat(F.lit("**"), F.replace(said, F.lit("*"), F.lit("\\*")), F.lit("**"))).when(F.col("heading"), F.concat(F.lit("## "), said)).otherwise(F.col("line"))
    told = marked.select(key, "pos", out.alias("out"), title.alias("t"), (F.col("heading") & ~label & ~level2).alias("section"), label.alias("label"), level2.alias("same"))
    made = told.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "out"))), lambda x: x["out"]), "\n").alias("m"),
        *[F.count_if(a).alias(b) for a, b in (("t", "title_promoted"), ("section", "to_section"), ("label", "to_label"), ("same", "unchanged"))],
    )
    ends = docs.select(key, F.endswith(whole, F.lit("\n")).alias("_end"))
    return made.join(ends, key).select(key, F.when(F.col("_end"), F.concat("m", F.lit("\n"))).otherwise(F.col("m")).alias("markdown"), "title_promoted", "to_section", "to_label", "unchanged")


def page_blocks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, block, text, page_no, page_source, n_markers): the blocks of each document with the page they name, or the last one named before."""
    body = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), FRONT_MATTER, "")
    blocks = docs.select(key, F.posexplode(F.split(body, "\n\n")).alias("block", "raw")).where(F.col("raw").rlike(r"\S"))
    named = F.regexp_extract_all("raw", F.lit(SOURCE), F.lit(1))
    w = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    page = F.last(F.get(named, F.lit(0)).cast("int"), ignorenulls=True).over(w)
    cleaned = F.regexp_replace(F.regexp_replace(F.regexp_replace("raw", r"^\n+|\n+$", ""), SOURCE, ""), r"\s+$", "")
    told = blocks.select(key, "block", cleaned.alias("text"), page.alias("page_no"), F.when(F.size(named) > 0, "explicit").otherwise("inferred").alias("page_source"), F.size(named).alias("n_markers"))
    return told.where(F.col("text").rlike(r"\S"))


def page_comments(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, markdown): page comments where the page changes, before a heading that stands in front of the change; front matter as a comment."""
    w = Window.partitionBy(key).orderBy("block")
    known = page_blocks(docs, key, text).withColumn("_before", F.last("page_no", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    known = known.withColumn("_heading_before", F.coalesce(F.startswith(F.lag("text").over(w), F.lit("#")), F.lit(False))).withColumn("_place", F.lag("block").over(w))
    new = F.col("page_no").isNotNull() & ~F.col("page_no").eqNullSafe(F.col("_before"))
    comments = known.where(new).select(key, F.when(F.col("_heading_before"), F.col("_place")).otherwise(F.col("block")).alias("at"), F.when(F.col("_heading_before"), 1).otherwise(0).alias("rank"), F.format_string("<!-- p.%d -->", "page_no").alias("part"))
    matter = F.regexp_extract(F.coalesce(F.col(text), F.lit("")), FRONT_MATTER, 1)
    pairs = F.filter(F.transform(F.split(matter, "\n"), lambda line: F.struct(F.regexp_extract(line, SCALAR, 1).alias("k"), F.regexp_replace(F.regexp_extract(line, SCALAR, 2), r"^[\"']+|[\"']+$", "").alias("v"))), lambda p: (p["k"] != "") & (p["v"] != ""))
    front = docs.select(key, pairs.alias("p")).where(F.size("p") > 0)
    front = front.select(key, F.lit(-1).alias("at"), F.lit(0).alias("rank"), F.concat(F.lit("<!-- wiki frontmatter: "), F.array_join(F.transform("p", lambda p: F.concat(p["k"], F.lit("="), p["v"])), "; "), F.lit(" -->")).alias("part"))
    made = _joined(known.select(key, F.col("block").alias("at"), F.lit(2).alias("rank"), F.col("text").alias("part")).unionByName(comments).unionByName(front), key, ["at", "rank"], "part", "\n\n")
    return docs.select(key).distinct().join(made, key, "left").select(key, F.concat(F.coalesce("markdown", F.lit("")), F.lit("\n")).alias("markdown"))


def superscript(text: Column) -> Column:
    """The plan's name with the superscript that a converter spaced out."""
    return F.regexp_replace(text, r"\bA 2 (ZERO|Zero)\b", "A²$1")
