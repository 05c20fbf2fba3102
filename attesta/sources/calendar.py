"""Meeting calendars as HTML: rows, links and video ids, by column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Document codes of the calendar's links, and forms of video addresses.
DOC_CODES = {"A": "agenda_url", "AADA": "agenda_html_url", "M": "minutes_url", "MADA": "minutes_html_url"}
VIDEO = r'href="(https?://(?:www\.)?(?:youtube\.com|youtu\.be)/[^"]+)"'
VIDEO_ID = r"(?:watch\?v=|live/|youtu\.be/)([A-Za-z0-9_-]{11})"


def unescape(c: Column) -> Column:
    """The five entities of XML and no-break spaces."""
    for entity, plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(plain))
    return c


def cell_text(c: Column) -> Column:
    return F.trim(F.regexp_replace(unescape(F.regexp_replace(c, "<[^>]+>", " ")), r"\s+", " "))


def visible_body(html: Column) -> Column:
    """A page without scripts, styles and tags; three or more line ends become two."""
    bare = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"(?i)<br\s*/?>|</p>|</div>|</tr>|</li>", "\n")
    return F.trim(F.regexp_replace(unescape(F.regexp_replace(bare, "<[^>]+>", " ")), r"\s*\n\s*\n\s*(\n\s*)*", "\n\n"))


def is_pdf(content: Column, content_type: Column) -> Column:
    """By content type or by the first bytes."""
    return F.coalesce(F.lower(content_type).contains("pdf"), F.lit(False)) | (F.substring(content.cast("string"), 1, 5) == "%PDF-")


def meeting_rows(pages: DataFrame, key: str = "page_id", html: str = "html", base_url: str = "") -> DataFrame:
    """A row for each table row with six cells or more whose second is a date."""
    rows = pages.select(key, F.explode(F.regexp_extract_all(F.col(html), F.lit(r"(?s)<tr[^>]*>(.*?)</tr>"))).alias("raw"))
    cells = rows.withColumn("cells", F.regexp_extract_all("raw", F.lit(r"(?s)<td[^>]*>(.*?)</td>"))).where(F.size("cells") >= 6)
    dated = cells.withColumn("d", cell_text(F.get("cells", F.lit(1)))).where(F.col("d").rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"))
    part = F.split("d", "/")
    date = F.concat_ws("-", part[2], F.lpad(part[0], 2, "0"), F.lpad(part[1], 2, "0"))
    found = lambda pattern, group=1: F.nullif(F.regexp_extract("raw", pattern, group), F.lit(""))
    detail = r"MeetingDetail\.aspx\?ID=(\d+)&(?:amp;)?GUID=([0-9A-Fa-f-]+)"
    docs = [F.concat(F.lit(base_url), unescape(found(rf'href="(View\.ashx\?M={code}&(?:amp;)?ID=\d+[^"]*)"'))).alias(name) for code, name in DOC_CODES.items()]
    video = unescape(found(VIDEO))
    return dated.select(
        key, cell_text(F.get("cells", F.lit(0))).alias("body_name"), date.alias("meeting_date"), cell_text(F.get("cells", F.lit(3))).alias("meeting_time"), F.left(cell_text(F.get("cells", F.lit(4))), F.lit(400)).alias("location"),
        found(detail).cast("long").alias("meeting_id"), found(detail, 2).alias("guid"), *docs, video.alias("video_url"), F.nullif(F.regexp_extract(video, VIDEO_ID, 1), F.lit("")).alias("youtube_id"),
    )
