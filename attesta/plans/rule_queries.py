"""Queries of the rule classifiers and scalar functions over store rows and literal cases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attesta.functions import rules, text
from attesta.operators.intervals import band_join
from attesta.plans.registry import query
from attesta.plans.store import Store


def q(s: str) -> str:
    return s.replace("'", "''")


def _case(column: str, table, otherwise: str) -> str:
    """DuckDB CASE over regular expressions: an independent evaluation of a rule table."""
    return "CASE " + " ".join(f"WHEN regexp_matches({column}, '{q(p)}') THEN '{n}'" for n, p in table) + f" ELSE {otherwise} END"


_DIRECTION = _case("verbatim", rules.FISCAL_DIRECTION, "'unknown'")


@query(f"SELECT id, {_DIRECTION} AS direction FROM s_claims")
def fiscal_direction(s: Store) -> DataFrame:
    return s.claims.select("id", rules.fiscal_direction(F.col("verbatim")).alias("direction"))


@query(f"SELECT {_DIRECTION} AS direction, count(*) AS claims FROM s_claims GROUP BY 1")
def fiscal_direction_counts(s: Store) -> DataFrame:
    return s.claims.groupBy(rules.fiscal_direction(F.col("verbatim")).alias("direction")).agg(F.count("*").alias("claims"))


_AMOUNTS = "SELECT l_orderkey * 10 + l_linenumber AS id, CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE cast(l_quantity AS int) END AS amount, CASE WHEN l_linenumber = 3 THEN 'a grant of $ 0 this year' WHEN l_linenumber = 6 THEN 'planning grant $0.50' ELSE 'a planning grant' END AS verbatim FROM {lineitem}"


@query(f"SELECT id, CASE WHEN amount <> 0 OR regexp_matches(verbatim, '[$]\\s*0[.,]?0*( |$)') THEN amount END AS stated FROM ({_AMOUNTS.replace('{lineitem}', 'lineitem')})")
def normalise_amount(s: Store) -> DataFrame:
    rows = s.spark.sql(_AMOUNTS, lineitem=s.raw("lineitem"))
    return rows.select("id", rules.stated_amount(F.col("amount"), F.col("verbatim")).alias("stated"))


@query(f"""
WITH m AS (SELECT f.id AS fiscal_id, c.id AS claim_id, c.verbatim, c.document_section_id AS sec, c.span_start FROM s_fiscal_references f JOIN s_claims c ON c.id = f.claim_id),
     r AS (SELECT id, document_section_id AS sec, span_start FROM s_claims WHERE regexp_matches(verbatim, '{rules.REVERSAL}')),
     n AS (SELECT m.fiscal_id, count(r.id) AS reversals, min(abs(r.span_start - m.span_start)) AS nearest FROM m JOIN r ON r.sec = m.sec AND r.id <> m.claim_id AND abs(r.span_start - m.span_start) < {rules.NEAR} GROUP BY 1)
SELECT m.fiscal_id, coalesce(n.reversals, 0) AS reversals, n.nearest,
       CASE WHEN n.reversals IS NULL THEN {_case('m.verbatim', rules.AWARD_STATUS, 'NULL')} END AS proposed,
       CASE WHEN n.reversals > 0 THEN 'reversal' WHEN {_case('m.verbatim', rules.AWARD_STATUS, 'NULL')} IS NOT NULL THEN 'verb' ELSE 'silent' END AS queue
FROM m LEFT JOIN n ON n.fiscal_id = m.fiscal_id""")
def award_status_band(s: Store) -> DataFrame:
    """Award status by verb, unless a claim nearby in the section speaks of a reversal."""
    c = s.claims.select(F.col("id").alias("claim_id"), "verbatim", "document_section_id", "span_start")
    money = s.fiscal_references.select(F.col("id").alias("fiscal_id"), "claim_id").join(c, "claim_id")
    reversed_ = c.where(F.col("verbatim").rlike(rules.REVERSAL)).select(F.col("claim_id").alias("other"), "document_section_id", F.col("span_start").alias("r_span"))
    near = band_join(money, reversed_, ["document_section_id"], "span_start", "r_span", rules.NEAR).where("other <> claim_id")
    counts = near.groupBy("fiscal_id").agg(F.count("*").alias("reversals"), F.min("distance").alias("nearest"))
    rows = money.join(counts, "fiscal_id", "left").fillna(0, ["reversals"])
    verb = rules.award_verb(F.col("verbatim"))
    queue = F.when(F.col("reversals") > 0, "reversal").when(verb.isNotNull(), "verb").otherwise("silent")
    return rows.select("fiscal_id", "reversals", "nearest", F.when(F.col("reversals") == 0, verb).alias("proposed"), queue.alias("queue"))


@query(f"""
SELECT f.id AS fiscal_id, f.claim_id, f.amount_low, CASE WHEN f.amount_low >= 100000 THEN 3 ELSE 5 END AS priority,
       (SELECT count(*) FROM s_fiscal_references g JOIN s_claims d ON d.id = g.claim_id WHERE d.document_id = c.document_id AND g.amount_low = f.amount_low AND d.id <> c.id) AS answers
FROM s_fiscal_references f JOIN s_claims c ON c.id = f.claim_id
WHERE coalesce(trim(f.funder_name_text), '') = '' AND lower(trim(coalesce(f.funding_source, ''))) IN ('', 'other', 'unspecified', 'unknown', 'n/a', 'not specified') AND regexp_matches(c.verbatim, '{rules.RECEIVED}')""")
def emit_questions(s: Store) -> DataFrame:
    """Money received from nobody named, with its priority and how many claims of the document state the same amount."""
    rows = s.fiscal_references.select(F.col("id").alias("fiscal_id"), "claim_id", "amount_low", "funding_source", "funder_name_text").join(s.claims.select(F.col("id").alias("claim_id"), "document_id", "verbatim"), "claim_id")
    known = rows.where("document_id is not null and amount_low is not null")
    same = known.groupBy("document_id", "amount_low").agg(F.count("*").alias("n"))
    own = known.groupBy("document_id", "amount_low", "claim_id").agg(F.count("*").alias("own"))
    asked = rows.where(~rules.names_a_source(F.col("funding_source"), F.col("funder_name_text")) & rules.is_received(F.col("verbatim")))
    answers = (F.coalesce("n", F.lit(0)) - F.coalesce("own", F.lit(0))).alias("answers")
    priority = F.when(F.col("amount_low") >= 100000, 3).otherwise(5).alias("priority")
    return asked.join(same, ["document_id", "amount_low"], "left").join(own, ["document_id", "amount_low", "claim_id"], "left").select("fiscal_id", "claim_id", "amount_low", priority, answers)


@query("SELECT id, CASE WHEN contains(t, 'work session') THEN 'work_session' WHEN contains(t, 'planning session') THEN 'planning_session' WHEN contains(t, 'special') THEN 'special' WHEN contains(t, 'cancel') THEN 'cancelled' ELSE 'regular' END AS kind FROM (SELECT id, lower(concat(location, ' ', CASE id % 5 WHEN 0 THEN 'Work Session' WHEN 1 THEN 'SPECIAL call' WHEN 2 THEN 'Cancelled' ELSE '' END)) AS t FROM s_events)")
def meeting_kind(s: Store) -> DataFrame:
    m = F.col("id") % 5
    comment = F.when(m == 0, "Work Session").when(m == 1, "SPECIAL call").when(m == 2, "Cancelled")
    return s.events.select("id", rules.meeting_kind(F.col("location"), comment).alias("kind"))


_UNIT_CASES = ("MW", "metric_tons_co2e", "MT CO2e", "metric tons of CO2e", "metrics tons carbon dioxide equivalents", "tons of material", "metric tons", "Percent.", "sq ft", "weeks", "  ", "solar arrays", "$", "times per year", "MTCO2e", "ton")
_UNITS_SQL = "SELECT p_partkey AS id, list_element([" + ", ".join(f"'{q(u)}'" for u in _UNIT_CASES) + f"], cast(p_partkey % {len(_UNIT_CASES)} AS int) + 1) AS raw FROM part"


@query(f"""
SELECT id, raw, CASE WHEN trim(raw) = '' THEN 'other' WHEN k IN ({', '.join(f"'{q(k)}'" for k in rules.UNITS)}) THEN CASE {' '.join(f"WHEN k = '{q(k)}' THEN '{v}'" for k, v in rules.UNITS.items())} END
       WHEN regexp_matches(raw, '{rules.CO2E}') THEN 'metric_tons_co2e' WHEN regexp_matches(k, '{rules.TONS}') THEN 'metric_tons' ELSE 'count' END AS dimension,
       CASE WHEN trim(raw) = '' OR k IN ({', '.join(f"'{q(k)}'" for k in rules.UNITS)}) OR regexp_matches(raw, '{rules.CO2E}') THEN NULL WHEN regexp_matches(k, '{rules.TONS}') THEN nullif(regexp_extract(k, '{rules.TONS}', 2), '') ELSE trim(raw) END AS basis
FROM (SELECT *, trim(lower(trim(raw)), '. ') AS k FROM ({_UNITS_SQL}))""")
def split_unit(s: Store) -> DataFrame:
    raw = F.element_at(F.array(*[F.lit(u) for u in _UNIT_CASES]), (F.col("p_partkey") % len(_UNIT_CASES)).cast("int") + 1)
    rows = s.raw("part").select(F.col("p_partkey").alias("id"), raw.alias("raw"))
    return rows.withColumn("u", rules.split_unit(F.col("raw"))).select("id", "raw", "u.dimension", "u.basis")


_TOPICAL = "SELECT id, concat(verbatim, CASE id % 6 WHEN 0 THEN ' Bryant geo-thermal heat pumps' WHEN 1 THEN ' SEU and seu, DTE' WHEN 2 THEN ' electrify the neighbourhood-scale franchise, A2 Zero' WHEN 3 THEN ' geothermal geothermal Bryant bryant' ELSE '' END) AS text FROM {claims}"


_SCAN = f"""
SELECT id, {' + '.join(f"cast(len(regexp_extract_all(text, '{p if c else '(?i)' + p}')) > 0 AS int)" for _, p, c in rules.TOPICS)} AS breadth,
       {' + '.join(f"len(regexp_extract_all(text, '{p if c else '(?i)' + p}'))" for _, p, c in rules.TOPICS)} AS mentions,
       greatest(len(regexp_extract_all(text, '\\S+')), 1) AS words
FROM ({_TOPICAL.replace('{claims}', 's_claims')})"""


@query(f"SELECT *, round(1000.0 * mentions / words, 2) AS density FROM ({_SCAN})")
def topic_scan(s: Store) -> DataFrame:
    """Topics by pattern: how many occur, how often, in how many words, and per thousand words."""
    rows = s.spark.sql(_TOPICAL, claims=s.claims)
    counted = rows.select("id", rules.topic_counts(F.col("text")).alias("c"), F.greatest(F.regexp_count("text", F.lit(r"\S+")).cast("long"), F.lit(1)).alias("words"))
    scored = counted.select("id", F.size(F.filter("c", lambda n: n > 0)).cast("long").alias("breadth"), F.aggregate("c", F.lit(0).cast("long"), lambda a, n: a + n).alias("mentions"), "words")
    return scored.withColumn("density", F.round(1000.0 * F.col("mentions") / F.col("words"), 2))


@query(f"""
SELECT c.document_id, max(breadth) AS breadth, cast(sum(mentions) AS bigint) AS mentions, round(1000.0 * sum(mentions) / sum(words), 2) AS density, rank() OVER (ORDER BY max(breadth) DESC, 1000.0 * sum(mentions) / sum(words) DESC, c.document_id) AS place
FROM (SELECT id, any_value(document_id) AS document_id FROM s_claims GROUP BY id) c JOIN (SELECT id, max(breadth) AS breadth, max(mentions) AS mentions, min(words) AS words FROM ({_SCAN}) GROUP BY id) t ON t.id = c.id WHERE document_id IS NOT NULL GROUP BY c.document_id ORDER BY place LIMIT 50""")
def topic_ranking(s: Store) -> DataFrame:
    """The fifty documents whose claims touch most topics, then most densely."""
    owners = s.claims.groupBy("id").agg(F.min("document_id").alias("document_id")).where("document_id is not null")
    scanned = topic_scan(s).groupBy("id").agg(F.max("breadth").alias("breadth"), F.max("mentions").alias("mentions"), F.min("words").alias("words"))
    per = owners.join(scanned, "id").groupBy("document_id").agg(F.max("breadth").alias("breadth"), F.sum("mentions").alias("mentions"), F.sum("words").alias("words"))
    exact = 1000.0 * F.col("mentions") / F.col("words")
    top = per.withColumn("exact", exact).orderBy(F.desc("breadth"), F.desc("exact"), "document_id").limit(50)
    # fifty rows, so the window's single task is small
    place = F.row_number().over(Window.orderBy(F.desc("breadth"), F.desc("exact"), "document_id"))
    return top.select("document_id", "breadth", "mentions", F.round("exact", 2).alias("density"), place.alias("place"))


@query(f"""
SELECT id, CASE WHEN NOT items AND length(text) < 600 THEN 'C' WHEN regexp_matches(text, '{rules.MONEY}') OR len(regexp_extract_all(text, '{rules.NUMBER}')) >= 15 THEN 'A' ELSE 'B' END AS tier
FROM (SELECT id, id % 4 = 0 AS items, CASE WHEN id % 5 = 0 THEN concat(text, ' costs $1,200') ELSE text END AS text FROM s_documents)""")
def section_tiers(s: Store) -> DataFrame:
    body = F.when(F.col("id") % 5 == 0, F.concat("text", F.lit(" costs $1,200"))).otherwise(F.col("text"))
    return s.documents.select("id", rules.section_tier(body, F.col("id") % 4 == 0).alias("tier"))


@query("""
SELECT id, CASE WHEN sha256(body) <> stored THEN 'suspect' WHEN len(list_filter(string_split_regex(body, '\\s+'), lambda w: len(regexp_extract_all(w, '[a-z][A-Z]')) >= 2)) > 0 THEN 'suspect' WHEN id % 9 IN (2, 4, 6) THEN 'suspect' WHEN trim(body) = '' THEN 'suspect' ELSE 'clean' END AS verdict
FROM (SELECT id, CASE WHEN id % 9 = 0 THEN concat(text, ' abCdEf') WHEN id % 9 = 1 THEN concat(text, ' changed') ELSE text END AS body,
             CASE WHEN id % 9 = 1 THEN sha256(text) ELSE sha256(CASE WHEN id % 9 = 0 THEN concat(text, ' abCdEf') ELSE text END) END AS stored FROM s_documents)""")
def section_verdicts(s: Store) -> DataFrame:
    """Changed, garbled and flagged sections; a second read answers one of the flags."""
    m = F.col("id") % 9
    body = F.when(m == 0, F.concat("text", F.lit(" abCdEf"))).when(m == 1, F.concat("text", F.lit(" changed"))).otherwise(F.col("text"))
    listed = lambda *names: F.array(*map(F.lit, names))
    flags = F.when(m == 2, listed("placement_inferred")).when(m == 3, listed("has_captions")).when(m == 4, listed("has_ocr_blocks")).when(m == 5, listed("has_ocr_blocks", "ocr_corroborated")).when(m == 6, listed("ocr_conflicts", "ocr_corroborated"))
    rows = s.documents.select("id", body.alias("body"), F.when(m == 1, F.sha2("text", 256)).otherwise(F.sha2(body, 256)).alias("stored"), flags.alias("flags"))
    return rows.select("id", rules.machine_verdict(F.col("body"), F.col("stored"), F.col("flags")).alias("verdict"))


_UPLOADS = """
    SELECT id, event_date AS meeting, CASE WHEN id % 4 = 0 THEN NULL WHEN id % 4 = 1 THEN event_date ELSE make_date(2020, 1, 1) END AS stated,
           CASE WHEN id % 7 = 0 THEN NULL WHEN id % 3 = 0 THEN make_date(2030, 1, 1) WHEN id % 3 = 1 THEN make_date(1990, 1, 1) ELSE event_date END AS upload FROM {events}"""
_UPLOADS_DUCK = _UPLOADS.replace("{events}", "s_events")


@query(f"SELECT id, CASE WHEN stated = meeting THEN 'matched' WHEN stated IS NOT NULL THEN 'title_mismatch' WHEN upload BETWEEN meeting - 1 AND meeting + 21 THEN 'no_title_date' WHEN upload IS NOT NULL THEN 'upload_implausible' ELSE 'unverified' END AS verdict, CASE WHEN stated IS NULL THEN 'no_title_date' WHEN stated <> meeting THEN 'title_mismatch' WHEN upload < meeting THEN 'upload_implausible' ELSE 'matched' END AS backfilled FROM ({_UPLOADS_DUCK})")
def video_verdicts(s: Store) -> DataFrame:
    """Both rule sets that write a recording's verification."""
    rows = s.spark.sql(_UPLOADS, events=s.events)
    cols = (F.col("stated"), F.col("meeting"), F.col("upload"))
    return rows.select("id", rules.upload_verdict(*cols).alias("verdict"), rules.backfill_verdict(*cols).alias("backfilled"))


@query(r"""
SELECT id, title, CASE
  WHEN regexp_matches(title, '\b\d{1,2}/\d{1,2}/\d{2,4}\b') THEN try_cast(concat(CASE WHEN length(p[3]) = 2 THEN concat('20', p[3]) ELSE p[3] END, '-', p[1], '-', p[2]) AS date)
  WHEN regexp_matches(title, '\b\d{1,2}-\d{1,2}-\d{2,4}\b') THEN try_cast(concat(CASE WHEN length(h[3]) = 2 THEN concat('20', h[3]) ELSE h[3] END, '-', h[1], '-', h[2]) AS date)
  WHEN regexp_matches(title, '(?i)\bmay\.? \d') THEN try_cast(concat(regexp_extract(title, '(\d{4})', 1), '-5-', regexp_extract(title, '(?i)may (\d{1,2})', 1)) AS date) END AS stated
FROM (SELECT *, string_split(regexp_extract(title, '(\d{1,2}/\d{1,2}/\d{2,4})', 1), '/') AS p, string_split(regexp_extract(title, '(\d{1,2}-\d{1,2}-\d{2,4})', 1), '-') AS h
      FROM (SELECT id, CASE id % 6 WHEN 0 THEN concat('Council ', month(event_date), '/', day(event_date), '/', year(event_date)) WHEN 1 THEN concat('Council ', month(event_date), '-', day(event_date), '-2020')
                   WHEN 2 THEN concat('Board May ', 1 + id % 28, ', 2021') WHEN 3 THEN concat('Council ', month(event_date), '/', day(event_date), '/24') WHEN 4 THEN 'Council 13/45/2020' ELSE 'no date' END AS title FROM s_events))""")
def title_dates(s: Store) -> DataFrame:
    m = F.col("id") % 6
    d = F.col("event_date")
    numeric = lambda sep, year: F.concat(F.lit("Council "), F.month(d), F.lit(sep), F.day(d), F.lit(sep), year)
    title = F.when(m == 0, numeric("/", F.year(d))).when(m == 1, numeric("-", F.lit("2020"))).when(m == 2, F.concat(F.lit("Board May "), 1 + F.col("id") % 28, F.lit(", 2021"))).when(m == 3, numeric("/", F.lit("24"))).when(m == 4, "Council 13/45/2020").otherwise("no date")
    return s.events.select("id", title.alias("title")).select("id", "title", text.title_date(F.col("title")).alias("stated"))


@query(r"SELECT id, trim(regexp_replace(lower(replace(name, '&', ' and ')), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM (SELECT p_partkey AS id, concat(p_name, ' & ', p_brand, '!') AS name FROM part)")
def slugs(s: Store) -> DataFrame:
    name = F.concat("p_name", F.lit(" & "), "p_brand", F.lit("!"))
    return s.raw("part").select(F.col("p_partkey").alias("id"), text.slugify(name).alias("slug"))


@query("SELECT conv_id * 100 + turn AS id, printf('%d:%05d:%d-%d', conv_id, turn, turn * 1000, turn * 1000 + 900) AS key, printf('%d:%02d:%02d', (conv_id * 100 + turn) // 3600, (conv_id * 100 + turn) % 3600 // 60, (conv_id * 100 + turn) % 60) AS shown FROM conversations")
def utterance_keys(s: Store) -> DataFrame:
    turn = F.col("turn")
    seconds = F.col("conv_id") * 100 + turn
    return s.raw("conversations").select(seconds.alias("id"), text.utterance_key(F.col("conv_id"), turn, turn * 1000, turn * 1000 + 900).alias("key"), text.hms(seconds).alias("shown"))


@query("""
SELECT vec_id, label, round(list_cosine_similarity(embedding, first), 5) AS similarity
FROM (SELECT e.vec_id, e.label, cast(e.embedding AS double[]) AS embedding, cast(f.embedding AS double[]) AS first FROM embeddings e JOIN (SELECT label, arg_min(embedding, vec_id) AS embedding FROM embeddings GROUP BY label) f ON f.label = e.label)""")
def voiceprint_similarity(s: Store) -> DataFrame:
    """Cosine of each voiceprint to the first of its label."""
    e = s.raw("embeddings")
    first = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("first"))
    return e.join(first, "label").select("vec_id", "label", F.round(text.cosine(F.col("embedding"), F.col("first")), 5).alias("similarity"))


@query("""
SELECT id, CASE WHEN orphan OR words <= 4 OR seconds <= 1.5 THEN 'high' WHEN words <= 10 OR purity < 0.8 OR clusters > 1 THEN 'medium' ELSE 'low' END AS risk
FROM (SELECT conv_id * 100 + turn AS id, len(string_split(text, ' ')) AS words, turn + 0.5 AS seconds, CASE WHEN turn % 3 <> 0 THEN 0.7 + (conv_id % 4) * 0.1 END AS purity, 1 + conv_id % 2 AS clusters, conv_id % 10 = 0 AS orphan FROM conversations)""")
def attribution_risk(s: Store) -> DataFrame:
    purity = F.when(F.col("turn") % 3 != 0, 0.7 + (F.col("conv_id") % 4) * 0.1)
    risk = rules.attribution_risk(F.size(F.split("text", " ")), F.col("turn") + 0.5, purity, 1 + F.col("conv_id") % 2, F.col("conv_id") % 10 == 0)
    return s.raw("conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("id"), risk.alias("risk"))
