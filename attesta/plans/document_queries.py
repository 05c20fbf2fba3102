"""Queries of document operators, quality gates, calendars and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attesta.functions import rollcall
from attesta.operators import documents, gates, geometry
from attesta.plans.registry import query
from attesta.plans.store import Store
from attesta.sources import calendar

_UNITS = "SELECT doc_id, unnest(string_split(text, chr(10))) AS unit, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS seq FROM documents"


def units(s: Store) -> DataFrame:
    return s.raw("documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("seq", "unit"))


@query(f"SELECT doc_id, cast(section AS bigint) AS section, count(*) AS units FROM (SELECT doc_id, sum(CASE WHEN length(unit) < 40 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY seq) AS section FROM ({_UNITS})) GROUP BY 1, 2")
def section_units(s: Store) -> DataFrame:
    return documents.sections(units(s), "doc_id", "seq", F.char_length("unit") < 40).groupBy("doc_id", "section").agg(F.count("*").alias("units"))


@query(f"SELECT doc_id, count(*) FILTER (WHERE r) AS in_range, count(*) AS units FROM (SELECT doc_id, coalesce(bool_or(contains(unit, 'icense')) OVER (PARTITION BY doc_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS r FROM ({_UNITS})) GROUP BY 1")
def range_flags(s: Store) -> DataFrame:
    marked = documents.from_opener(units(s), "doc_id", "seq", F.contains("unit", F.lit("icense")))
    return marked.groupBy("doc_id").agg(F.count_if("in_range").alias("in_range"), F.count("*").alias("units"))


@query(f"""
WITH u AS (SELECT doc_id, seq // 3 AS page, regexp_replace(lower(trim(unit)), '[0-9]+', '#', 'g') AS shape FROM ({_UNITS}) WHERE seq % 3 > 0)
SELECT doc_id, count(*) AS lines FROM u WHERE (doc_id, shape) IN (SELECT (doc_id, shape) FROM u GROUP BY doc_id, shape HAVING count(DISTINCT page) >= 3) GROUP BY doc_id""")
def furniture_lines(s: Store) -> DataFrame:
    """Lines of the lowest eighth of pages of three lines, which repeat on three pages at least."""
    height = F.element_at(F.array(F.lit(10), F.lit(88), F.lit(95)), (F.col("seq") % 3 + 1).cast("int"))
    pages = units(s).select("doc_id", F.floor(F.col("seq") / 3).alias("page"), F.col("unit").alias("text"), height.alias("top"), F.lit(100).alias("page_h"))
    return documents.furniture(pages, band=True).groupBy("doc_id").agg(F.count("*").alias("lines"))


@query("""
SELECT id, cast(sum(fresh) OVER (PARTITION BY page_id ORDER BY x0 RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS bigint) AS column_no
FROM (SELECT id, page_id, x0, CASE WHEN x0 - lag(x0) OVER (PARTITION BY page_id ORDER BY x0) <= 30 THEN 0 ELSE 1 END AS fresh FROM (SELECT DISTINCT id, page_id, x0 FROM s_boxes))""")
def page_columns(s: Store) -> DataFrame:
    return documents.columns(s.boxes.select("id", "page_id", "x0").distinct(), "page_id", "x0", 30).select("id", "column_no")


@query("SELECT l_orderkey AS k, count(*) AS refs, cast(coalesce(sum(CASE WHEN l_partkey >= p THEN 1 WHEN p IS NOT NULL THEN 0 END), 0) AS bigint) AS ascending FROM (SELECT l_orderkey, l_partkey, lag(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS p FROM lineitem) GROUP BY 1")
def ascending_references(s: Store) -> DataFrame:
    rows = s.raw("lineitem").select(F.col("l_orderkey").alias("k"), F.struct("l_linenumber", "l_partkey").alias("o"), "l_partkey")
    return documents.ascending_pairs(rows, "k", "o", "l_partkey")


@query("""
WITH w AS (SELECT DISTINCT doc_id, lower(unnest(string_split(text, ' '))) AS w FROM documents),
     b AS (SELECT DISTINCT doc_id, lower(left(w, 4)) AS a, lower(substring(w, 5)) AS b FROM w WHERE length(w) > 6)
SELECT b.doc_id, b.a, b.b, CASE WHEN j.w IS NOT NULL AND h.w IS NULL THEN 'join' WHEN h.w IS NOT NULL AND j.w IS NULL THEN 'hyphen' ELSE 'ambiguous' END AS choice
FROM b LEFT JOIN w j ON j.doc_id = b.doc_id AND j.w = concat(b.a, b.b) LEFT JOIN w h ON h.doc_id = b.doc_id AND h.w = concat(b.a, '-', b.b)""")
def hyphen_rulings(s: Store) -> DataFrame:
    """Every word of over six letters as if a line had ended after its fourth."""
    words = s.raw("documents").select("doc_id", F.explode(F.split("text", " ")).alias("word"))
    w = F.lower("word")
    breaks = words.where(F.char_length(w) > 6).select("doc_id", F.left(w, F.lit(4)).alias("a"), F.substr(w, F.lit(5)).alias("b")).distinct()
    return documents.hyphen_rulings(breaks, words)


@query("""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS w FROM documents),
     s AS (SELECT doc_id, k AS seq, array_to_string(w[k * 60 + 1:k * 60 + 8], ' ') AS anchor, k % 5 = 4 AS gone, ' ' || array_to_string(w, ' ') AS t, len(w) AS n FROM (SELECT doc_id, w, unnest(generate_series(0, (len(w) - 1) // 60)) AS k FROM d WHERE len(w) > 0)),
     p AS (SELECT doc_id, seq, n, CASE WHEN NOT gone AND strpos(t, ' ' || anchor) > 0 THEN length(substring(t, 1, strpos(t, ' ' || anchor))) - length(replace(substring(t, 1, strpos(t, ' ' || anchor)), ' ', '')) - 1 END AS word_start FROM s)
SELECT doc_id, seq, word_start, CASE WHEN word_start IS NOT NULL THEN coalesce(lead(word_start IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY seq), n) END AS word_end FROM p""")
def located_sections(s: Store) -> DataFrame:
    """A section every sixty words, sought by its first eight in the whole text; every fifth is not in it."""
    w = F.filter(F.split("text", r"\s+"), lambda x: x != "")
    docs = s.raw("documents").select("doc_id", w.alias("w")).where(F.size("w") > 0)
    # another rendering: dashes, quotes and line ends of its own
    anchors = docs.select("doc_id", "w", F.explode(F.sequence(F.lit(0), F.floor((F.size("w") - 1) / 60).cast("int"))).alias("seq"))
    anchors = anchors.select("doc_id", "seq", F.when(F.col("seq") % 5 == 4, "nowhere to be found").otherwise(F.array_join(F.slice("w", F.col("seq") * 60 + 1, F.lit(8)), " \n")).alias("anchor"))
    return documents.locate_sections(anchors, docs.select("doc_id", F.array_join("w", "\n").alias("text")))


@query("SELECT id, page_id, cast(sum(fresh) OVER (PARTITION BY page_id, kind ORDER BY y0, id) - 1 AS bigint) AS group_no FROM (SELECT *, CASE WHEN y0 - lag(y0) OVER (PARTITION BY page_id, kind ORDER BY y0, id) <= 20 THEN 0 ELSE 1 END AS fresh FROM (SELECT DISTINCT ON (id) * FROM s_boxes ORDER BY id, y0, x0, x1))")
def link_groups(s: Store) -> DataFrame:
    once = s.boxes.groupBy("id").agg(F.min_by(F.struct("page_id", "kind", "y0"), F.struct("y0", "x0", "x1")).alias("b")).select("id", "b.*")
    return documents.group_rects(once, ["page_id", "kind"]).select("id", "page_id", "group_no")


# ---------------------------------------------------------------- gates

_PRICED = "SELECT doc_id, concat(text, ' costs $', cast(doc_id * 1000 AS varchar), ' or $2.5 million of') AS full_text FROM documents"


@query(f"""
WITH d AS (SELECT doc_id, full_text, CASE WHEN doc_id % 3 = 0 THEN left(full_text, cast(length(full_text) // 3 AS int)) ELSE full_text END AS text FROM ({_PRICED})),
     n AS (SELECT doc_id, len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')) AS got, len(list_filter(string_split_regex(full_text, '\\s+'), lambda w: w <> '')) AS want,
                  list_distinct(regexp_extract_all(text, '\\$[\\d,]+(?:\\.\\d+)?(?:\\s?(?:million|billion|k|M|B))?')) AS f, list_distinct(regexp_extract_all(full_text, '\\$[\\d,]+(?:\\.\\d+)?(?:\\s?(?:million|billion|k|M|B))?')) AS r FROM d),
     x AS (SELECT doc_id, got / want < 0.6 AS a, len(list_intersect(r, f)) / len(r) < 0.8 AS b FROM n)
SELECT doc_id, CASE WHEN a OR b THEN 'refuse' ELSE 'pass' END AS verdict, cast(a AS int) + cast(b AS int) AS findings FROM x""")
def gate_verdicts(s: Store) -> DataFrame:
    """Text and figures against an independent read; a high finding refuses."""
    full = F.concat("text", F.lit(" costs $"), (F.col("doc_id") * 1000).cast("string"), F.lit(" or $2.5 million of"))
    rows = s.raw("documents").select("doc_id", full.alias("full"))
    cut = F.when(F.col("doc_id") % 3 == 0, F.left("full", F.floor(F.char_length("full") / 3).cast("int"))).otherwise(F.col("full"))
    docs = rows.select("doc_id", cut.alias("text"), F.size(F.filter(F.split("full", r"\s+"), lambda w: w != "")).alias("reference_words"), gates.figures(F.col("full")).alias("reference_numbers"))
    found = gates.recovery_findings(docs)
    counts = found.groupBy("doc_id").agg(F.count("*").cast("int").alias("findings"))
    return gates.verdict(docs, found).join(counts, "doc_id", "left").fillna(0, ["findings"])


_BLOCKS = f"""
  u AS (SELECT doc_id, unit, seq, cast(coalesce(sum(length(unit) + 1) OVER (PARTITION BY doc_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bigint) AS a FROM ({_UNITS})),
  b AS (SELECT u.doc_id, trim(unit) AS t, coalesce(substring(d.text, cast(a + CASE WHEN u.doc_id % 5 = 0 AND seq = 0 THEN 2 ELSE 1 END AS bigint), length(unit)), '') <> unit AS off, seq % 4 = 0 AND u.doc_id % 3 = 0 AS ocr FROM u JOIN documents d ON d.doc_id = u.doc_id)"""


@query(f"""
WITH {_BLOCKS},
     f AS (SELECT doc_id, count(*) FILTER (WHERE off) AS off, count(*) FILTER (WHERE ocr) AS ocr, count(*) AS n, cast(sum(len(list_filter(string_split_regex(t, '\\s+'), lambda w: len(regexp_extract_all(w, '[a-z][A-Z]')) >= 2))) AS bigint) AS garbled,
                  count(*) FILTER (WHERE t <> '' AND right(t, 1) NOT IN ('.', '!', '?', ':', ';', '’', '"', chr(39), ')') AND NOT regexp_matches(t, '(?i);\\s*(and|or)\\s*$') AND trim(lower(list_last(string_split_regex(t, '\\s+'))), ',') IN ({', '.join(f"'{w}'" for w in gates.DANGLING)})) AS cut FROM b GROUP BY doc_id)
SELECT doc_id, 'truncation' AS finding, 'medium' AS severity, cut AS blocks FROM f WHERE cut > 0
UNION ALL SELECT doc_id, 'span_round_trip', 'high', off FROM f WHERE off > 0 UNION ALL SELECT doc_id, 'garbled_text', 'high', garbled FROM f WHERE garbled > 0 UNION ALL SELECT doc_id, 'ocr_fraction', 'medium', ocr FROM f WHERE ocr / n >= 0.2""")
def gate_blocks(s: Store) -> DataFrame:
    """Blocks that stop on a dangling word, slice wrongly or are garbled, and documents read by OCR in good part."""
    w = Window.partitionBy("doc_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.char_length("unit") + 1).over(w), F.lit(0)) + F.when((F.col("doc_id") % 5 == 0) & (F.col("seq") == 0), 1).otherwise(0)
    source = F.when((F.col("seq") % 4 == 0) & (F.col("doc_id") % 3 == 0), "ocr").otherwise("native")
    blocks = units(s).select("doc_id", F.lit("TextItem").alias("kind"), F.col("unit").alias("text"), source.alias("text_source"), at.cast("int").alias("char_start")).withColumn("char_end", F.col("char_start") + F.char_length("text"))
    return gates.block_findings(blocks, s.raw("documents").select("doc_id", "text"))


@query("""
WITH p AS (SELECT l_orderkey AS doc_id, l_linenumber AS page_no, min(l_linenumber * 100 - CASE WHEN l_partkey % 7 = 0 THEN 130 ELSE 0 END) AS a, min(l_linenumber * 100 + 100) AS b FROM lineitem GROUP BY 1, 2),
     m AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, a, lag(b) OVER (PARTITION BY doc_id ORDER BY page_no) AS before FROM p) WHERE a < before GROUP BY 1),
     t AS (SELECT l_orderkey AS doc_id, count(*) FILTER (WHERE l_suppkey % 4 = 0) AS n, count(*) FILTER (WHERE l_partkey % 3 = 0) AS tables FROM lineitem GROUP BY 1),
     r AS (SELECT l_orderkey AS doc_id, l_linenumber AS page_no, CASE WHEN l_suppkey % 5 <> 0 THEN l_partkey % 200 END AS x0, l_suppkey % 90 AS y0 FROM lineitem WHERE l_returnflag = 'R'),
     f AS (SELECT l_orderkey AS doc_id, l_linenumber AS page_no, l_partkey % 150 AS x0, l_suppkey % 70 AS y0 FROM lineitem WHERE l_returnflag <> 'A' AND l_partkey % 4 = 0),
     h AS (SELECT doc_id, count(DISTINCT page_no) AS n FROM r WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.doc_id = r.doc_id AND f.page_no = r.page_no AND (r.x0 IS NULL OR (r.x0 + 40 >= f.x0 AND f.x0 + 40 >= r.x0 AND r.y0 + 40 >= f.y0 AND f.y0 + 40 >= r.y0))) GROUP BY 1)
SELECT doc_id, 'page_map' AS finding, 'high' AS severity, n AS blocks FROM m UNION ALL SELECT doc_id, 'tables_dropped', 'high', n FROM t WHERE n > 0 AND tables = 0 UNION ALL SELECT doc_id, 'unread_suppressed', 'high', n FROM h""")
def gate_layout(s: Store) -> DataFrame:
    """Pages out of order, tables that were lost, and suppressed regions that no figure covers."""
    line = s.raw("lineitem")
    doc, n, part, supp = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    pages = line.groupBy(doc.alias("doc_id"), n.alias("page_no")).agg(F.min(n * 100 - F.when(part % 7 == 0, 130).otherwise(0)).alias("char_start"), F.min(n * 100 + 100).alias("char_end"))
    blocks = line.select(doc.alias("doc_id"), (supp % 4 == 0).alias("has_cells"), F.when(part % 3 == 0, "TableItem").otherwise("TextItem").alias("kind"))
    box = lambda x, y: [x.alias("x0"), y.alias("y0"), (x + 40).alias("x1"), (y + 40).alias("y1")]
    runs = line.where("l_returnflag = 'R'").select(doc.alias("doc_id"), n.alias("page_no"), *box(F.when(supp % 5 != 0, part % 200), supp % 90))
    figures = line.where("l_returnflag <> 'A' and l_partkey % 4 = 0").select(doc.alias("doc_id"), n.alias("page_no"), *box(part % 150, supp % 70))
    return gates.page_map_findings(pages).unionByName(gates.table_findings(blocks)).unionByName(gates.suppressed_findings(runs, figures))


_PAGES = """
  p AS (SELECT l_orderkey AS doc_id, cast(l_partkey % 400 AS int) AS words, cast(l_partkey % 400 * 5 AS int) AS chars, cast(l_suppkey % 60 AS int) AS images, cast(l_suppkey % 50 AS int) AS small_images, cast(l_linenumber AS int) AS bullets, cast(l_partkey % 90 AS int) AS content_tokens, cast(l_suppkey % 9 AS int) AS table_rows, cast(l_partkey % 3 AS int) AS money FROM lineitem),
  m AS (SELECT doc_id, median(words) AS median FROM p GROUP BY 1),
  f AS (SELECT p.*, median FROM p JOIN m ON m.doc_id = p.doc_id)"""


@query(f"""
WITH {_PAGES}, g AS (SELECT doc_id, money, chars, {' + '.join(f'cast(coalesce({c}, false) AS int)' for _, _, c in gates.PAGE_FLAGS)} AS flags, {' OR '.join(f'coalesce({c}, false)' for _, v, c in gates.PAGE_FLAGS if v == 'high')} AS high FROM f),
  t AS (SELECT doc_id, count(*) AS pages, sum(flags) + CASE WHEN sum(money) = 0 AND count(*) FILTER (WHERE chars < 40) > 0 THEN 1 ELSE 0 END AS flags, count(*) FILTER (WHERE high) AS high FROM g GROUP BY 1)
SELECT doc_id, pages, cast(flags AS bigint) AS flags, round(high / pages, 4) AS high_fraction, CASE WHEN high / pages >= 0.5 THEN 'unusable' WHEN flags > 0 THEN 'suspect' ELSE 'clean' END AS verdict FROM t""")
def parse_audit(s: Store) -> DataFrame:
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    pages = s.raw("lineitem").select(
        F.col("l_orderkey").alias("doc_id"), (part % 400).alias("words"), (part % 400 * 5).alias("chars"), (supp % 60).alias("images"), (supp % 50).alias("small_images"), F.col("l_linenumber").alias("bullets"), (part % 90).alias("content_tokens"), (supp % 9).alias("table_rows"), (part % 3).alias("money")
    )
    return gates.parse_audit(pages)


@query("""
WITH d AS (SELECT doc_id AS id, text, CASE WHEN doc_id % 2 = 0 THEN text ELSE left(text, cast(length(text) // 2 AS int)) END AS other FROM documents),
     w AS (SELECT id, list_distinct(list_filter(string_split_regex(regexp_replace(lower(text), '[^a-z0-9 ]', ' ', 'g'), ' +'), lambda x: x <> '')) AS a, list_distinct(list_filter(string_split_regex(regexp_replace(lower(other), '[^a-z0-9 ]', ' ', 'g'), ' +'), lambda x: x <> '')) AS b FROM d)
SELECT id, len(list_filter(a, lambda x: NOT list_contains(b, x))) AS words_missing, 0 AS figures_missing, CASE WHEN len(list_filter(a, lambda x: NOT list_contains(b, x))) > 0 THEN 'conflicts' ELSE 'corroborated' END AS state FROM w""")
def second_read(s: Store) -> DataFrame:
    other = F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise(F.left("text", F.floor(F.char_length("text") / 2).cast("int")))
    return gates.second_read(s.raw("documents").select(F.col("doc_id").alias("id"), "text", other.alias("other")))


@query("SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 2500000 WHEN 1 THEN o_orderkey * 1000 WHEN 2 THEN 3000000000 END AS dollars FROM orders")
def normal_money(s: Store) -> DataFrame:
    m = F.col("o_orderkey") % 4
    figure = F.when(m == 0, "$2.5 million").when(m == 1, F.concat(F.lit("$"), F.format_number(F.col("o_orderkey") * 1000, 0))).when(m == 2, "$3B").otherwise("$n/a")
    return s.raw("orders").select(F.col("o_orderkey").alias("id"), gates.normal_money(figure).alias("dollars"))


@query("""
SELECT o_orderkey AS id, CASE WHEN m IN (0, 3) THEN 2 ELSE 0 END AS present, CASE WHEN m IN (0, 3) THEN 1 ELSE 0 END AS absent, m IN (0, 3) AS reliable,
       CASE m WHEN 1 THEN 'present: declared 3, extracted 2' WHEN 2 THEN 'no ROLL CALL block' WHEN 4 THEN '2 counts, 1 labels, 1 name runs' ELSE '' END AS reason
FROM (SELECT o_orderkey, o_orderkey % 5 AS m FROM orders)""")
def roll_calls(s: Store) -> DataFrame:
    """Roll calls of two layouts, a count that the names don't have, no block, and counts without labels."""
    m = F.col("o_orderkey") % 5
    text = (
        F.when(m == 0, "ROLL CALL Present: 2 - Ann Lee and Bob Ray  Absent: 1 - Cy Young APPROVAL OF MINUTES")
        .when(m == 1, "ROLL CALL 3 - Present : Ann Lee, Bob Ray CONSENT")
        .when(m == 3, "ROLL CALL 2 - 1 - Present : Ann Lee, Bob Ray Excused : Cy Young PUBLIC COMMENT")
        .when(m == 4, "ROLL CALL 2 - 1 - Present : Ann Lee, Bob Ray CONSENT")
        .otherwise("no roll call")
    )
    rows = rollcall.roll_calls(s.raw("orders").select(F.col("o_orderkey").alias("id"), text.alias("minutes")), "minutes")
    return rows.select("id", F.size("present").alias("present"), F.size("absent").alias("absent"), "reliable", "reason")


@query("""
WITH e AS (SELECT l_orderkey AS doc_id, l_linenumber AS n, l_returnflag AS f, cast(l_partkey % 400 + 1 AS int) AS page_ref, CASE WHEN l_linenumber % 2 = 0 THEN 70 ELSE 50 END AS x0, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS k FROM lineitem),
     one AS (SELECT * FROM e WHERE k = 1),
     next AS (SELECT *, lead(n) OVER l AS next_n, lead(f) OVER l AS next_f FROM one WINDOW l AS (PARTITION BY doc_id ORDER BY n)),
     entries AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS entry, concat('Part ', f, CASE WHEN next_n = 3 THEN concat(' and ', next_f) ELSE '' END) AS title, page_ref, x0 FROM next WHERE n <> 3)
SELECT doc_id, entry, title, page_ref, x0, CASE WHEN x0 = 70 AND shallow > 0 THEN 2 ELSE 1 END AS level
FROM (SELECT *, count(*) OVER d AS named, count(*) FILTER (WHERE x0 = 50) OVER d AS shallow FROM entries WINDOW d AS (PARTITION BY doc_id)) WHERE named >= 3""")
def contents_entries(s: Store) -> DataFrame:
    """Contents pages, one an order: an entry a line, the third going on with the second; a heading and a lone page number about them."""
    n = F.col("l_linenumber")
    first = s.raw("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min_by(F.struct("l_returnflag", "l_partkey"), F.struct("l_partkey", "l_suppkey")).alias("l"))
    left = F.when(n % 2 == 0, 70.0).otherwise(50.0)
    token = lambda dy, x0, text: F.struct((n * 12 + dy).cast("double").alias("top"), x0.alias("x0"), text.alias("text"))
    page = F.when(n != 3, (F.col("l.l_partkey") % 400 + 1).cast("string"))
    line = F.array(token(0, left, F.when(n == 3, "and").otherwise("Part")), token(1, left + 30, F.col("l.l_returnflag")), token(2, F.lit(200.0), F.when(n != 3, "......")), token(0, F.lit(300.0), page))
    furniture = F.when(n == 1, F.array(token(-12, F.lit(10.0), F.lit("Contents")), token(500, F.lit(300.0), F.lit("4"))))
    words = first.select(F.col("l_orderkey").alias("doc_id"), F.explode(F.concat(line, F.coalesce(furniture, F.slice(line, 1, 0)))).alias("w")).select("doc_id", F.lit(1).alias("page"), "w.*").where("text is not null")
    return geometry.contents(words, ["doc_id", "page"], ["doc_id"]).select("doc_id", "entry", "title", "page_ref", "x0", "level")


# ---------------------------------------------------------------- calendars and recordings


@query("""
SELECT id, name AS body_name, strftime(event_date, '%Y-%m-%d') AS meeting_date, '6:30 PM' AS meeting_time, location, id AS meeting_id, CASE WHEN id % 2 = 0 THEN concat('https://x.example/View.ashx?M=A&ID=', id, '&GUID=ab') END AS agenda_url,
       CASE WHEN id % 3 = 0 THEN concat('https://x.example/View.ashx?M=MADA&ID=', id) END AS minutes_html_url, CASE WHEN id % 5 = 0 THEN lpad(cast(id AS varchar), 11, 'v') END AS youtube_id
FROM (SELECT e.id, e.event_date, e.location, b.name FROM s_events e JOIN s_bodies b ON b.id = e.body_id)""")
def calendar_rows(s: Store) -> DataFrame:
    """Calendar pages, one meeting each, read back from their HTML."""
    k = F.col("id").cast("string")
    e = s.events.select("id", "event_date", "location", "body_id").join(s.bodies.select(F.col("id").alias("body_id"), "name"), "body_id")
    link = lambda cond, html: F.when(cond, html).otherwise("")
    html = F.concat(
        F.lit("<html><tr><td>head</td></tr><tr class='x'><td><b>"), "name", F.lit("</b></td><td>"), F.date_format("event_date", "M/d/yyyy"), F.lit("</td><td></td><td> 6:30&nbsp;PM </td><td>"), "location", F.lit("</td><td><a href=\"MeetingDetail.aspx?ID="), k, F.lit("&amp;GUID=AB-1\">d</a>"),
        link(F.col("id") % 2 == 0, F.concat(F.lit('<a href="View.ashx?M=A&amp;ID='), k, F.lit('&amp;GUID=ab">a</a>'))), link(F.col("id") % 3 == 0, F.concat(F.lit('<a href="View.ashx?M=MADA&ID='), k, F.lit('">m</a>'))),
        link(F.col("id") % 5 == 0, F.concat(F.lit('<a href="https://youtu.be/'), F.lpad(k, 11, "v"), F.lit('?si=1">v</a>'))), F.lit("</td></tr></html>"),
    )
    return calendar.meeting_rows(e.select("id", html.alias("html")), "id", base_url="https://x.example/").select("id", "body_name", "meeting_date", "meeting_time", "location", "meeting_id", "agenda_url", "minutes_html_url", "youtube_id")


@query("SELECT page_id, length(regexp_extract(html, '<title>(.*?)</title>', 1)) AS title_chars, regexp_matches(html, '(?i)<!doctype html') AS is_html FROM pages")
def fetched_pages(s: Store) -> DataFrame:
    return s.raw("pages").select("page_id", F.char_length(F.regexp_extract("html", "<title>(.*?)</title>", 1)).alias("title_chars"), F.col("html").rlike("(?i)<!doctype html").alias("is_html"))


@query("""
WITH v AS (SELECT l_orderkey * 10 + l_linenumber AS video_id, l_suppkey % 25 AS body_id, cast(l_shipdate AS date) AS stated FROM lineitem WHERE l_linenumber = 1),
     g AS (SELECT v.video_id, count(DISTINCT e.id) AS n, min(e.id) AS event_id FROM v LEFT JOIN s_events e ON e.body_id = v.body_id AND e.event_date = v.stated GROUP BY 1),
     m AS (SELECT DISTINCT event_id FROM s_media_assets)
SELECT g.video_id, CASE WHEN n = 1 THEN g.event_id END AS event_id, CASE WHEN n = 0 THEN 'orphan' WHEN n > 1 THEN 'ambiguous' WHEN m.event_id IS NOT NULL THEN 'both_corroborated' ELSE 'recovered' END AS state FROM g LEFT JOIN m ON m.event_id = g.event_id""")
def channel_reconciliation(s: Store) -> DataFrame:
    """Channel videos against meetings by body and stated date: none, one or several; several are never written."""
    videos = s.raw("lineitem").where("l_linenumber = 1").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("video_id"), (F.col("l_suppkey") % 25).cast("int").alias("body_id"), F.col("l_shipdate").cast("date").alias("event_date"))
    # meetings are told by body and date before videos meet them: none, one id or several, whatever their number
    meetings = s.events.groupBy("body_id", "event_date").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    hits = videos.join(meetings, ["body_id", "event_date"], "left").groupBy("video_id").agg(F.min("least").alias("event_id"), F.max("most").alias("most")).withColumn("n", F.when(F.col("event_id").isNull(), 0).when(F.col("event_id") == F.col("most"), 1).otherwise(2))
    known = s.media_assets.select("event_id").distinct().withColumn("known", F.lit(True))
    state = F.when(F.col("n") == 0, "orphan").when(F.col("n") > 1, "ambiguous").when(F.col("known"), "both_corroborated").otherwise("recovered")
    return hits.join(known, "event_id", "left").select("video_id", F.when(F.col("n") == 1, F.col("event_id")).alias("event_id"), state.alias("state"))


@query("SELECT source, count(*) AS n, min(doc_id) AS first, max(doc_id) AS last, count(*) FILTER (WHERE lang = 'en') AS en, count(*) FILTER (WHERE lang = 'fr') AS fr FROM documents GROUP BY source")
def coverage_report(s: Store) -> DataFrame:
    return s.raw("documents").groupBy("source").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count_if(F.col("lang") == "en").alias("en"), F.count_if(F.col("lang") == "fr").alias("fr"))


@query("""
WITH t AS (SELECT 0 AS src, p_brand AS term, p_partkey AS k FROM part UNION ALL SELECT 1, n_name, n_nationkey FROM nation UNION ALL SELECT 2, upper(p_brand), p_partkey FROM part),
     f AS (SELECT *, row_number() OVER (PARTITION BY lower(term) ORDER BY src, k) AS rn FROM t WHERE length(term) >= 3 AND length(term) < 50 AND len(string_split(term, ' ')) <= 5)
SELECT term, src FROM f WHERE rn = 1 ORDER BY src, k, term LIMIT 100""")
def keyterms(s: Store) -> DataFrame:
    """Terms by source rank, the first of each spelling, at most a hundred."""
    part, nation = s.raw("part"), s.raw("nation")
    rows = part.select(F.lit(0).alias("src"), F.col("p_brand").alias("term"), F.col("p_partkey").alias("k")).unionAll(nation.select(F.lit(1), "n_name", F.col("n_nationkey").cast("long"))).unionAll(part.select(F.lit(2), F.upper("p_brand"), "p_partkey"))
    fit = rows.where((F.char_length("term") >= 3) & (F.char_length("term") < 50) & (F.size(F.split("term", " ")) <= 5))
    first = fit.groupBy(F.lower("term").alias("spelling")).agg(F.min_by(F.struct("term", "src", "k"), F.struct("src", "k")).alias("x")).select("x.*")
    return first.orderBy("src", "k", "term").limit(100).select("term", "src")


@query("SELECT doc_id FROM documents ORDER BY sha256(concat(doc_id, '-17')), doc_id LIMIT 100")
def seeded_sample(s: Store) -> DataFrame:
    """A repeatable sample: the first hundred by a hash of key and seed."""
    return s.raw("documents").select("doc_id").orderBy(F.sha2(F.concat(F.col("doc_id").cast("string"), F.lit("-17")), 256), "doc_id").limit(100)


# ---------------------------------------------------------------- geometry

_RULES = [("greenhouse gas emissions summary", "ghg"), ("^(introduction|closing)$", "plan")]


@query("""
SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN concat('strategy-', 1 + doc_id % 7) WHEN 1 THEN 'strategy-3' WHEN 2 THEN 'ghg' WHEN 3 THEN 'plan' END AS subject_key FROM documents""")
def subject_keys(s: Store) -> DataFrame:
    """Subjects of headings: numbered series, then patterns."""
    m = F.col("doc_id") % 6
    heading = F.when(m == 0, F.concat(F.lit("STRATEGY "), 1 + F.col("doc_id") % 7, F.lit(": Homes"))).when(m == 1, "Strategies three: x").when(m == 2, "Our Greenhouse Gas Emissions Summary").when(m == 3, "Closing").when(m == 4, "Year 5 priorities")
    return s.raw("documents").select("doc_id", geometry.subject_key(heading, _RULES).alias("subject_key"))


@query(f"""
WITH g AS (SELECT page_id, id, x0 / 10.0 AS gap FROM (SELECT DISTINCT ON (id) * FROM s_boxes ORDER BY id, x0, y0, x1)), m AS (SELECT page_id, median(gap) AS median FROM g GROUP BY 1)
SELECT g.page_id, g.id AS position, CASE WHEN gap >= greatest(11 * {geometry.SPACE_EM}, median * {geometry.STANDOUT}) THEN 'space' WHEN gap > 11 * {geometry.TIGHT_EM} THEN 'undecided' ELSE 'kerning' END AS state FROM g JOIN m ON m.page_id = g.page_id""")
def glyph_breaks(s: Store) -> DataFrame:
    """Gaps inside tokens: spaces, kerning, or neither."""
    once = s.boxes.groupBy("id").agg(F.min_by(F.struct("page_id", "x0"), F.struct("x0", "y0", "x1")).alias("b")).select("b.page_id", F.col("id").alias("position"), (F.col("b.x0") / 10.0).alias("gap"), F.lit(11.0).alias("size"))
    return geometry.glyph_breaks(once, ["page_id"])


@query("""
WITH c AS (SELECT l_orderkey AS id, l_linenumber AS col, min(l_partkey) AS v FROM lineitem GROUP BY 1, 2), d AS (SELECT *, dense_rank() OVER (PARTITION BY id ORDER BY col) - 1 AS k, count(*) OVER (PARTITION BY id) AS n FROM c)
SELECT id, string_agg(cast(v AS varchar), '|' ORDER BY k) AS row_text FROM d WHERE n >= 2 GROUP BY id""")
def table_rows(s: Store) -> DataFrame:
    """Cells laid out on one column axis without gaps."""
    cells = s.raw("lineitem").groupBy(F.col("l_orderkey").alias("id"), F.col("l_linenumber").cast("int").alias("col")).agg(F.min("l_partkey").cast("string").alias("text")).withColumns({"row": F.lit(0), "row_span": F.lit(1), "col_span": F.lit(1)})
    rows = geometry.table_rows(geometry.table_grid(cells, ["id"]), ["id"])
    return rows.select("id", F.array_join("values", "|").alias("row_text"))
