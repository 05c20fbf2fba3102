"""Quality gates: what a conversion lost, as findings with a severity, and the verdict they add up to."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Thresholds, figures, and words on which a sentence can't end.
MIN_TEXT, MIN_NUMERIC, OCR_NOTABLE = 0.60, 0.80, 0.20
IMAGE_DOMINANCE, MIN_PAGE_CHARS, DENSITY_FLOOR, UNUSABLE = 3.0, 40, 0.25, 0.5
MONEY = r"(?i)\$[\d,]+(?:\.\d+)?(?:\s?(?:million|billion|k|M|B))?"
PERCENT = r"[0-9][0-9,\.]*\s?%"
UNIT_NUMBER = r"(?i)[0-9][0-9,\.]*\s?(?:MW|kW|GWh|MWh|tons?|homes?|acres?|trees?)\b"
DANGLING = "a an and at but by for from in including into of on or our the their to with another not as that".split()
ENUMERATED = r"(?i);\s*(and|or)\s*$"
TERMINAL = ".!?:;’\"')"


def figures(text: Column, pattern: str = MONEY) -> Column:
    """Distinct figures of a text, white space folded."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))
    return F.array_distinct(F.transform(found, lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))))


def normal_money(figure: Column) -> Column:
    """A figure as a whole number of dollars, words for millions and billions spelled out."""
    t = F.regexp_replace(F.lower(figure), r"[$,\s]", "")
    factor = F.when(t.rlike("(billion|b)$"), 1e9).when(t.rlike("(million|m)$"), 1e6).otherwise(1.0)
    return F.round(F.regexp_replace(t, "(billion|million|b|m)$", "").try_cast("double") * factor).cast("long")


def dangling(text: Column, kind: Column | None = None) -> Column:
    """Whether a block stops on a word that can't end it; clauses joined by '; and' are complete."""
    t = F.trim(F.coalesce(text, F.lit("")))
    last = F.btrim(F.lower(F.element_at(F.split(t, r"\s+"), -1)), F.lit(","))
    cut = (t != "") & ~F.right(t, F.lit(1)).isin(*TERMINAL) & ~t.rlike(ENUMERATED) & last.isin(*DANGLING)
    return cut if kind is None else cut & ~F.coalesce(kind, F.lit("")).isin("SectionHeaderItem", "TitleItem", "PictureItem")


def garbled(text: Column) -> Column:
    """Words whose letters change case twice or more inside."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: F.regexp_count(w, F.lit("[a-z][A-Z]")) >= 2))


def recovery_findings(docs: DataFrame, key: str = "doc_id", text: str = "text", words: str = "reference_words", numbers: str = "reference_numbers") -> DataFrame:
    """(key, finding, severity) for text and figures lost against an independent read."""
    got = figures(F.col(text))
    flat = lambda a: F.transform(a, lambda x: F.replace(x, F.lit(" "), F.lit("")))
    missing = F.filter(F.col(numbers), lambda n: ~F.array_contains(flat(got), F.replace(n, F.lit(" "), F.lit(""))))
    n_words = F.size(F.filter(F.split(F.col(text), r"\s+"), lambda w: w != ""))
    lost_text = (F.col(words) > 0) & (n_words / F.col(words) < MIN_TEXT)
    lost_numbers = (F.size(numbers) > 0) & ((F.size(numbers) - F.size(missing)) / F.size(numbers) < MIN_NUMERIC)
    named = F.array_compact(F.array(F.when(lost_text, F.lit("text_recovery")), F.when(lost_numbers, F.lit("numeric_conservation"))))
    return docs.select(key, F.explode(named).alias("finding")).withColumn("severity", F.lit("high"))


def block_findings(blocks: DataFrame, texts: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, finding, severity, blocks) over blocks: key, kind, text, text_source, char_start, char_end."""
    full = blocks.join(texts.select(key, F.col("text").alias("_full")), key)
    slice_ = F.substring("_full", F.col("char_start") + 1, F.col("char_end") - F.col("char_start"))
    per = full.groupBy(key).agg(
        F.count_if(F.col("char_start").isNotNull() & (slice_ != F.col("text"))).alias("span_round_trip"),
        F.count_if(dangling(F.col("text"), F.col("kind"))).alias("truncation"),
        F.sum(garbled(F.col("text"))).alias("garbled_text"),
        F.count("text_source").alias("_sources"),
        F.count_if(F.col("text_source") == "ocr").alias("ocr_fraction"),
    )
    found = [F.when(F.col(n) > 0, F.struct(F.lit(n).alias("finding"), F.lit(s).alias("severity"), F.col(n).cast("long").alias("blocks"))) for n, s in (("span_round_trip", "high"), ("truncation", "medium"), ("garbled_text", "high"))]
    ocr = F.when((F.col("_sources") > 0) & (F.col("ocr_fraction") / F.col("_sources") >= OCR_NOTABLE), F.struct(F.lit("ocr_fraction").alias("finding"), F.lit("medium").alias("severity"), F.col("ocr_fraction").cast("long").alias("blocks")))
    return per.select(key, F.explode(F.array_compact(F.array(*found, ocr))).alias("f")).select(key, "f.*")


def page_map_findings(pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, finding, severity, blocks) where a page (key, page_no, char_start, char_end) starts before the one before it ends; how many do."""
    before = F.lag("char_end").over(Window.partitionBy(key).orderBy("page_no"))
    found = pages.withColumn("_before", before).where(F.col("char_start") < F.col("_before")).groupBy(key).agg(F.count("*").alias("blocks"))
    return found.select(key, F.lit("page_map").alias("finding"), F.lit("high").alias("severity"), "blocks")


def table_findings(blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, finding, severity, blocks) where tables were detected (has_cells) but none reached the output."""
    per = blocks.groupBy(key).agg(F.count_if("has_cells").alias("blocks"), F.count_if(F.col("kind") == "TableItem").alias("_tables")).where("blocks > 0 and _tables = 0")
    return per.select(key, F.lit("tables_dropped").alias("finding"), F.lit("high").alias("severity"), "blocks")


def suppressed_findings(runs: DataFrame, figures: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, finding, severity, blocks): pages with a suppressed region that no extracted figure touches.

    A region without a box is covered by any figure of its page.
    """
    box = ["x0", "y0", "x1", "y1"]
    boxed, bare = runs.where(" and ".join(f"{c} is not null" for c in box)), runs.where(" or ".join(f"{c} is null" for c in box))
    touching = (F.col("r.x1") >= F.col("f.x0")) & (F.col("f.x1") >= F.col("r.x0")) & (F.col("r.y1") >= F.col("f.y0")) & (F.col("f.y1") >= F.col("r.y0"))
    same = (F.col(f"r.{key}") == F.col(f"f.{key}")) & (F.col("r.page_no") == F.col("f.page_no"))
    open_ = boxed.alias("r").join(figures.alias("f"), same & touching, "left_anti").select(key, "page_no").unionByName(bare.alias("r").join(figures.alias("f"), same, "left_anti").select(key, "page_no"))
    holes = open_.distinct().groupBy(key).agg(F.count("*").alias("blocks"))
    return holes.select(key, F.lit("unread_suppressed").alias("finding"), F.lit("high").alias("severity"), "blocks")


def verdict(docs: DataFrame, findings: DataFrame, key: str = "doc_id") -> DataFrame:
    """refuse for a high finding, review for any, else pass."""
    worst = findings.groupBy(key).agg(F.bool_or(F.col("severity") == "high").alias("_high"))
    return docs.select(key).join(worst, key, "left").select(key, F.when(F.col("_high"), "refuse").when(F.col("_high").isNotNull(), "review").otherwise("pass").alias("verdict"))


#: Page flags by figure; each is a condition over page statistics. The median joins from the document.
PAGE_FLAGS: tuple[tuple[str, str, str], ...] = (
    ("image_dominance", "high", f"chars > 0 and images / chars * 100 >= {IMAGE_DOMINANCE}"),
    ("empty_page", "high", f"chars < {MIN_PAGE_CHARS}"),
    ("orphan_list_markers", "high", "bullets >= 3 and content_tokens <= bullets"),
    ("subthreshold_images", "medium", "images >= 5 and small_images / images >= 0.8"),
    ("table_row_shortfall", "medium", "table_rows >= 3 and words < table_rows"),
    ("density_outlier", "medium", f"median > 0 and words < median * {DENSITY_FLOOR}"),
)


def parse_audit(pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, pages, flags, high_fraction, verdict): unusable if half of the pages have a high flag, suspect if any flag stands."""
    medians = pages.groupBy(key).agg(F.median("words").alias("median"))
    flagged = pages.join(medians, key)
    count = reduce(lambda a, f: a + F.coalesce(F.expr(f[2]), F.lit(False)).cast("int"), PAGE_FLAGS, F.lit(0))
    high = reduce(lambda a, f: a | F.coalesce(F.expr(f[2]), F.lit(False)), [f for f in PAGE_FLAGS if f[1] == "high"], F.lit(False))
    totals = flagged.groupBy(key).agg(F.count("*").alias("pages"), F.sum(count).alias("_flags"), F.sum(high.cast("int")).alias("_high"), F.sum("money").alias("_money"), F.count_if(F.col("chars") < MIN_PAGE_CHARS).alias("_thin"))
    flags = F.col("_flags") + ((F.col("_money") == 0) & (F.col("_thin") > 0)).cast("int")
    share = F.col("_high") / F.col("pages")
    return totals.select(key, "pages", flags.cast("long").alias("flags"), F.round(share, 4).alias("high_fraction"), F.when(share >= UNUSABLE, "unusable").when(flags > 0, "suspect").otherwise("clean").alias("verdict"))


def second_read(sections: DataFrame, key: str = "id", text: str = "text", other: str = "other") -> DataFrame:
    """Figures and words of a section that a second read lacks: conflicts, else corroborated."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower(c), "[^a-z0-9 ]", " "), " +"), lambda w: w != ""))
    lost_words = F.size(F.array_except(words(F.col(text)), words(F.col(other))))
    lost_figures = F.size(F.array_except(figures(F.col(text)), figures(F.col(other))))
    return sections.select(key, lost_words.alias("words_missing"), lost_figures.alias("figures_missing"), F.when(lost_words + lost_figures > 0, "conflicts").otherwise("corroborated").alias("state"))
