"""Relational operators on page blocks and document units: furniture, columns, sections, hyphens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def shape(text: Column) -> Column:
    """A line with runs of digits folded, so that page numbers don't tell running lines apart."""
    return F.regexp_replace(F.lower(F.trim(text)), "[0-9]+", "#")


#: Where on a page furniture begins, as a share of its height; a fixed value.
FURNITURE_BAND = 0.88


def furniture(lines: DataFrame, key: str = "doc_id", page: str = "page", text: str = "text", pages: int = 3, band: bool = False) -> DataFrame:
    """Lines whose shape stands on at least ``pages`` pages of the document.

    With ``band`` only lines from FURNITURE_BAND of the page's height on (top, page_h) count and are
    returned; lines without a place, or on pages without a height, are none of them.
    """
    low = lines.where((F.col("page_h") > 0) & (F.col("top") >= F.col("page_h") * FURNITURE_BAND)) if band else lines
    shaped = low.withColumn("_shape", shape(F.col(text)))
    often = shaped.groupBy(key, "_shape").agg(F.countDistinct(page).alias("_n")).where(F.col("_n") >= pages).select(key, "_shape")
    return shaped.join(often, [key, "_shape"], "left_semi").drop("_shape")


def columns(boxes: DataFrame, key: str, x: str, gap: int) -> DataFrame:
    """Numbers the columns of each page: a left edge more than ``gap`` right of the one before starts another."""
    w = Window.partitionBy(key).orderBy(x)
    new = F.coalesce(F.col(x) - F.lag(x).over(w) > gap, F.lit(True)).cast("int")
    return boxes.withColumn("_new", new).withColumn("column_no", F.sum("_new").over(w.rangeBetween(Window.unboundedPreceding, 0)) - 1).drop("_new")


def sections(units: DataFrame, key: str, order: str, heading: Column) -> DataFrame:
    """Numbers sections: each heading starts one, what stands before the first is section 0."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return units.withColumn("section", F.sum(heading.cast("int")).over(w))


def from_opener(units: DataFrame, key: str, order: str, opens: Column, inclusive: bool = False) -> DataFrame:
    """Marks every unit after the first opener of its document (and the opener too if ``inclusive``)."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    return units.withColumn("in_range", F.coalesce(F.bool_or(opens).over(w), F.lit(False)))


def ascending_pairs(refs: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """How many references of each key are at least the one before, of how many."""
    w = Window.partitionBy(key).orderBy(order)
    up = (F.col(value) >= F.lag(value).over(w)).cast("int")
    return refs.withColumn("_up", up).groupBy(key).agg(F.count("*").alias("refs"), F.coalesce(F.sum("_up"), F.lit(0)).alias("ascending"))


def hyphen_rulings(breaks: DataFrame, words: DataFrame, key: str = "doc_id") -> DataFrame:
    """How to close a line-end hyphen (``breaks``: key, a, b) by what the document says elsewhere.

    join if it writes ab, hyphen if it writes a-b; both or neither is ambiguous. ``words``: key, word.
    """
    asked = breaks.select(key, "a", "b", F.lower(F.concat("a", "b")).alias("joined"), F.lower(F.concat("a", F.lit("-"), "b")).alias("hyphened"))
    seen = words.select(key, F.lower("word").alias("w")).distinct()
    one = seen.select(key, F.col("w").alias("joined"), F.lit(True).alias("_j"))
    two = seen.select(key, F.col("w").alias("hyphened"), F.lit(True).alias("_h"))
    found = asked.join(one, [key, "joined"], "left").join(two, [key, "hyphened"], "left")
    j, h = F.col("_j").isNotNull(), F.col("_h").isNotNull()
    return found.select(key, "a", "b", F.when(j & ~h, "join").when(h & ~j, "hyphen").otherwise("ambiguous").alias("choice"))


#: Words of a section by which another rendering is searched, and the numbers that continue a heading. Fixed values.
ANCHOR_WORDS = 8
LEADING_NUMBER, NUMBER_PREFIX = r"(?i)^(?:STRATEGY\s+)?(\d+)\s*:", r"(?i)^(?:STRATEGY\s+)?\d+\s*:\s*"


def plain_typography(text: Column) -> Column:
    """Quotes, dashes and the superscript two as both renderings would have them, white space as single spaces."""
    folded = F.regexp_replace(F.translate(text, "‘’“”²", "''\"\"2"), "[‒-―]", "-")
    return F.trim(F.regexp_replace(folded, r"\s+", " "))


def merged_headings(headings: DataFrame, key: str = "doc_id", order: str = "seq") -> DataFrame:
    """Headings (key, order, heading, body) with those that continue the one before folded into it: the same leading number, or without any the same words."""
    number = F.nullif(F.regexp_extract("heading", LEADING_NUMBER, 1), F.lit(""))
    core = F.upper(F.trim(F.regexp_replace("heading", NUMBER_PREFIX, "")))
    w = Window.partitionBy(key).orderBy(order)
    told = headings.withColumn("_n", number).withColumn("_c", core)
    same = F.when(F.col("_n").isNotNull() & F.lag("_n").over(w).isNotNull(), F.col("_n") == F.lag("_n").over(w)).when(F.col("_n").isNull() & F.lag("_n").over(w).isNull(), (F.col("_c") != "") & (F.col("_c") == F.lag("_c").over(w))).otherwise(F.lit(False))
    numbered = told.withColumn("_run", F.sum((~F.coalesce(same, F.lit(False))).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct(order, "heading", "body")))
    made = numbered.groupBy(key, "_run").agg(parts.alias("p"))
    return made.select(key, F.get("p", F.lit(0))[order].alias(order), F.get("p", F.lit(0))["heading"].alias("heading"), F.array_join(F.transform("p", lambda x: x["body"]), "\n\n").alias("body"))


def anchor_phrase(body: Column, n: int = ANCHOR_WORDS) -> Column:
    """The first words of a section, without a bullet and with links as their text."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(body), r"^\s*\\?[-*]\s*", ""), r"^\s*\.\s*", "")
    return F.array_join(F.slice(F.split(plain_typography(F.regexp_replace(bare, r"\[([^\]]+)\]\([^)]*\)", "$1")), " "), 1, n), " ")


def locate_sections(headings: DataFrame, texts: DataFrame, key: str = "doc_id", order: str = "seq", anchor: str = "anchor", text: str = "text") -> DataFrame:
    """Where sections begin in another rendering, in words: the anchor's first place, the next located section's as the end.

    Anchors not found have null bounds; the last located section runs to the end of the text. Places are
    words, so that they hold in the text as written and as normalised.
    """
    body = texts.select(key, plain_typography(F.col(text)).alias("_t"))
    sought = F.concat(F.lit(" "), plain_typography(F.col(anchor)))
    found = headings.join(body, key).withColumn("_p", F.nullif(F.position(sought, F.concat(F.lit(" "), F.col("_t"))), F.lit(0)))
    placed = found.withColumn("at", F.when(F.col("_p").isNotNull() & (F.trim(F.col(anchor)) != ""), F.size(F.split(F.substr(F.concat(F.lit(" "), F.col("_t")), F.lit(1), F.col("_p")), " ")) - 2))
    n = F.size(F.filter(F.split("_t", " "), lambda w: w != ""))
    w = Window.partitionBy(key).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    end = F.coalesce(F.last("at", ignorenulls=True).over(w), n)
    return placed.select(key, order, F.col("at").alias("word_start"), F.when(F.col("at").isNotNull(), end).alias("word_end"))


def group_rects(rects: DataFrame, keys: list[str], top: str = "y0", gap: int = 20) -> DataFrame:
    """Numbers groups of rectangles of one link: each at most ``gap`` below the one before."""
    w = Window.partitionBy(*keys).orderBy(top, "id")
    new = F.coalesce(F.col(top) - F.lag(top).over(w) > gap, F.lit(True)).cast("int")
    return rects.withColumn("_new", new).withColumn("group_no", F.sum("_new").over(w) - 1).drop("_new")


#: Share of the shorter side's height by which the sides of a page must run beside each other to be columns, and the gutter between left edges. Fixed values.
BESIDE, GUTTER = 0.3, 60


def reading_order(blocks: DataFrame, key: list[str], order: str = "seq", gutter: int = GUTTER) -> DataFrame:
    """``blocks`` (page keys, order, x0, y0, y1, kind) with ``place``: top to bottom on pages of one column, as they came on others.

    A page has columns if its left edges fall into groups further apart than ``gutter`` and what begins at
    the last of them runs beside the rest; pictures don't tell. Blocks without a box keep their place, the
    others share out the places that they hold together.
    """
    page = Window.partitionBy(*key)
    has = F.col("x0").isNotNull() & F.col("y0").isNotNull() & F.col("y1").isNotNull()
    told = blocks.withColumn("_box", has).withColumn("_text", F.when(has & (F.col("kind") != "PictureItem"), F.col("x0")))
    # the last group of edges begins where an edge stands more than the gutter right of the one before
    edge = told.where("_text is not null").withColumn("_before", F.lag("_text").over(page.orderBy("_text")))
    last = edge.groupBy(*key).agg(F.max(F.when(F.col("_text") - F.col("_before") > gutter, F.col("_text"))).alias("_edge"))
    side = edge.join(last.where("_edge is not null"), key).withColumn("_right", F.col("_text") >= F.col("_edge"))
    reach = side.groupBy(*key).agg(*[f(F.when(F.col("_right") == right, F.col(c))).alias(n) for right, a, b in ((False, "_la", "_lb"), (True, "_ra", "_rb")) for f, c, n in ((F.min, "y0", a), (F.max, "y1", b))])
    span = F.least(F.col("_lb") - F.col("_la"), F.col("_rb") - F.col("_ra"))
    columns = reach.where((span > 0) & (F.least("_lb", "_rb") - F.greatest("_la", "_ra") > span * BESIDE)).select(*key).withColumn("_columns", F.lit(True))
    marked = told.join(columns, key, "left")
    sorted_ = F.col("_box") & F.col("_columns").isNull()
    ranked = marked.withColumn("_k", F.when(sorted_, F.row_number().over(Window.partitionBy(*key, sorted_).orderBy("y0", order))))
    slots = marked.where(sorted_).select(*key, F.row_number().over(page.orderBy(order)).alias("_k"), F.col(order).alias("_slot"))
    return ranked.join(slots, [*key, "_k"], "left").select(*blocks.columns, F.coalesce("_slot", F.col(order)).alias("place"))


def captioned_sections(units: DataFrame, key: str, order: str, heading: Column) -> DataFrame:
    """Sections as by ``sections``; a caption (kind) that ends one goes to the next if that begins on the caption's page (page_no), unless it is all its section has."""
    numbered = sections(units, key, order, heading)
    doc, own = Window.partitionBy(key).orderBy(order), Window.partitionBy(key, "section")
    after = F.lead(F.struct("section", "page_no")).over(doc)
    told = numbered.withColumn("_after", after).withColumn("_n", F.count("*").over(own))
    handed = (F.col("kind") == "caption") & (F.col("_after.section") > F.col("section")) & (F.col("_after.page_no") == F.col("page_no")) & (F.col("_n") > 1)
    return told.withColumn("section", F.when(handed, F.col("_after.section")).otherwise(F.col("section"))).select(*numbered.columns)
