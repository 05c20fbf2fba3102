"""Blocks rendered to markdown, one text a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def block_line(kind: Column, text: Column, level: Column) -> Column:
    t = F.trim(F.coalesce(text, F.lit("")))
    heading = F.concat(F.repeat(F.lit("#"), F.least(F.greatest(F.coalesce(level, F.lit(2)), F.lit(1)), F.lit(3))), F.lit(" "), t)
    return (
        F.when(kind == "TitleItem", F.concat(F.lit("# "), t))
        .when((kind == "SectionHeaderItem") & (level >= 4), F.concat(F.lit("**"), t, F.lit("**")))
        .when(kind == "SectionHeaderItem", heading)
        .when(kind == "ListItem", F.concat(F.lit("- "), t))
        .when(kind == "Furniture", F.concat(F.lit("<!-- FURNITURE: "), t, F.lit(" -->")))
        .when(kind == "Caption", F.concat(F.lit("<!-- CAPTION --> "), t))
        .otherwise(t)
    )


def markdown(blocks: DataFrame, key: str = "doc_id", order: str = "seq") -> DataFrame:
    """(key, markdown): blocks (kind, text, level, page_no) in order, a comment where a page begins. A document is one value."""
    line = F.struct(F.col(order).alias("seq"), F.col("page_no").alias("page"), block_line(F.col("kind"), F.col("text"), F.col("level")).alias("line"))
    ordered = F.array_sort(F.collect_list(line))
    page = lambda b, i: F.concat(F.lit("<!-- p."), b["page"].cast("string"), F.lit(" -->\n"))
    rows = blocks.groupBy(key).agg(ordered.alias("b"))
    lines = F.transform("b", lambda b, i: F.concat(F.when((i == 0) | (F.get("b", i - 1)["page"] != b["page"]), page(b, i)).otherwise(""), b["line"]))
    return rows.select(key, F.array_join(F.filter(lines, lambda x: x != ""), "\n\n").alias("markdown"))


#: A box that a reviewer has ticked.
TICKED = r"(?m)^\s*[-*]\s+\[[xX]\]"


def checklist(findings: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, checklist): an open box for each finding (key, finding, severity, evidence), high ones first, then by name and evidence."""
    line = F.struct(F.when(F.col("severity") == "high", 0).otherwise(1).alias("rank"), "finding", F.coalesce("evidence", F.lit("")).alias("evidence"))
    rows = findings.groupBy(key).agg(F.array_sort(F.collect_list(line)).alias("f"))
    return rows.select(key, F.array_join(F.transform("f", lambda x: F.concat(F.lit("- [ ] "), x["finding"], F.when(x["evidence"] != "", F.concat(F.lit(": "), x["evidence"])).otherwise(""))), "\n").alias("checklist"))


def unticked(new: DataFrame, existing: DataFrame, key: str = "doc_id") -> DataFrame:
    """``new`` checklists that may be written: those whose document has none yet, or one without a ticked box. A reviewer's work is never overwritten."""
    held = existing.where(F.col("checklist").rlike(TICKED)).select(key)
    return new.join(held, key, "left_anti")
