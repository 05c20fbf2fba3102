"""Queries of curation steps and of the remaining aggregates, sorts and classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.operators import anchoring, curation, documents, speech
from attesta.plans.registry import query
from attesta.plans.store import Store


@query("SELECT source, string_agg(lang, ' ' ORDER BY doc_id) AS langs FROM documents GROUP BY source")
def ordered_listagg(s: Store) -> DataFrame:
    """Values of a group as one string, in order."""
    return s.spark.sql("SELECT source, listagg(lang, ' ') WITHIN GROUP (ORDER BY doc_id) AS langs FROM {documents} GROUP BY source", documents=s.raw("documents"))


@query("""
WITH a AS (SELECT l_orderkey AS k, l_returnflag AS v, count(*) AS n FROM lineitem WHERE l_linenumber <= 3 GROUP BY 1, 2), b AS (SELECT l_orderkey AS k, l_returnflag AS v, count(*) AS n FROM lineitem WHERE l_linenumber >= 3 GROUP BY 1, 2)
SELECT a.k, cast(sum(least(a.n, coalesce(b.n, 0))) AS bigint) AS found, cast(sum(a.n) AS bigint) AS total FROM a LEFT JOIN b ON a.k = b.k AND a.v = b.v GROUP BY a.k""")
def multiset_found(s: Store) -> DataFrame:
    """How many of the wanted values were got, repeats counted."""
    rows = s.raw("lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("v"), "l_linenumber")
    both = rows.groupBy("k", "v").agg(F.count_if(F.col("l_linenumber") <= 3).alias("want"), F.count_if(F.col("l_linenumber") >= 3).alias("got")).where("want > 0")
    return both.groupBy("k").agg(F.sum(F.least("want", "got")).alias("found"), F.sum("want").alias("total"))


@query("SELECT page_id, string_agg(cast(id AS varchar), '|' ORDER BY y0, x0, id) AS ids FROM s_boxes GROUP BY page_id")
def reading_order(s: Store) -> DataFrame:
    """Boxes of a page from top to bottom, then left to right."""
    order = F.array_sort(F.collect_list(F.struct("y0", "x0", "id")))
    return s.boxes.groupBy("page_id").agg(F.array_join(F.transform(order, lambda b: b["id"].cast("string")), "|").alias("ids"))


@query("""
WITH b AS (SELECT DISTINCT ON (id) id, page_id, CASE WHEN id % 7 <> 0 THEN x0 END AS x0, y0, y1, kind FROM s_boxes ORDER BY id, y0, x0, x1, y1),
     e AS (SELECT *, lag(x0) OVER (PARTITION BY page_id ORDER BY x0) AS before FROM b WHERE x0 IS NOT NULL AND kind <> 'picture'), l AS (SELECT page_id, max(x0) FILTER (WHERE x0 - before > 60) AS edge FROM e GROUP BY 1),
     r AS (SELECT e.page_id, min(y0) FILTER (WHERE x0 < edge) AS la, max(y1) FILTER (WHERE x0 < edge) AS lb, min(y0) FILTER (WHERE x0 >= edge) AS ra, max(y1) FILTER (WHERE x0 >= edge) AS rb FROM e JOIN l ON l.page_id = e.page_id AND edge IS NOT NULL GROUP BY 1),
     c AS (SELECT page_id FROM r WHERE least(lb - la, rb - ra) > 0 AND least(lb, rb) - greatest(la, ra) > least(lb - la, rb - ra) * 0.3),
     m AS (SELECT b.*, x0 IS NOT NULL AND c.page_id IS NULL AS sorted FROM b LEFT JOIN c ON c.page_id = b.page_id),
     k AS (SELECT *, row_number() OVER (PARTITION BY page_id, sorted ORDER BY y0, id) AS k, row_number() OVER (PARTITION BY page_id, sorted ORDER BY id) AS n FROM m)
SELECT a.id, a.page_id, CASE WHEN a.sorted THEN s.id ELSE a.id END AS place FROM k a LEFT JOIN k s ON s.page_id = a.page_id AND s.sorted AND a.sorted AND s.n = a.k""")
def page_order(s: Store) -> DataFrame:
    """Blocks of pages of one column from top to bottom, of others as they came; a seventh has no box."""
    once = s.boxes.groupBy("id").agg(F.min_by(F.struct("page_id", "x0", "y0", "y1", "kind"), F.struct("y0", "x0", "x1", "y1")).alias("b")).select("id", "b.*")
    blocks = once.withColumn("x0", F.when(F.col("id") % 7 != 0, F.col("x0"))).withColumn("kind", F.when(F.col("kind") == "picture", "PictureItem").otherwise(F.col("kind")))
    return documents.reading_order(blocks, ["page_id"], "id").select("id", "page_id", "place")


@query("""
SELECT vec_id AS media_id, person_id, CASE WHEN vec_id % 7 = 0 THEN 'refused: person not certain' WHEN vec_id % 7 = 1 THEN 'refused: not a public figure' WHEN vec_id % 7 = 2 THEN 'refused: no vector' WHEN vec_id % 7 = 3 THEN 'refused: enrolled for someone else' WHEN vec_id % 7 = 4 THEN 'enrolled already' ELSE 'enrol' END AS action
FROM (SELECT vec_id, cast(label AS bigint) AS person_id FROM embeddings WHERE vec_id % 3 <> 0)""")
def enrolment_actions(s: Store) -> DataFrame:
    return _enrolments(s)[1].select("media_id", "person_id", "action")


@query("""
WITH e AS (SELECT vec_id, cast(label AS bigint) AS p FROM embeddings), o AS (SELECT (p + 1) % 10 AS p, count(*) AS n FROM e WHERE vec_id % 7 = 3 GROUP BY 1),
     g AS (SELECT p, count(*) FILTER (WHERE vec_id % 3 <> 0 AND vec_id % 7 > 4) AS fresh, count(*) FILTER (WHERE vec_id % 7 = 4) AS own FROM e GROUP BY 1)
SELECT g.p AS person_id, cast(2 + fresh AS int) AS sample_count, cast(own + fresh + coalesce(o.n, 0) AS int) AS tokens FROM g LEFT JOIN o ON o.p = g.p""")
def enrolled_voiceprints(s: Store) -> DataFrame:
    prints, decided = _enrolments(s)
    return curation.enrolled(prints, decided).select("person_id", "sample_count", F.size("media").alias("tokens"))


def _enrolments(s: Store) -> tuple[DataFrame, DataFrame]:
    """Voiceprints that hold some tokens, their own and of others' clusters, and what becomes of the candidates."""
    e, k = s.raw("embeddings"), F.col("vec_id")
    person = F.col("label").cast("long")
    owner = F.when(k % 7 == 3, (person + 1) % 10).when(k % 7 == 4, person)
    media = e.select(owner.alias("person_id"), F.concat(k.cast("string"), F.lit(":A")).alias("token")).where("person_id is not null").groupBy("person_id").agg(F.array_sort(F.collect_set("token")).alias("media"))
    first = e.groupBy(person.alias("person_id")).agg(F.min_by("embedding", "vec_id").alias("embedding"))
    prints = first.join(media, "person_id", "left").select("person_id", "embedding", F.lit(2).alias("sample_count"), F.coalesce("media", F.array().cast("array<string>")).alias("media"))
    m = k % 7
    asked = e.select(k.alias("media_id"), F.lit("A").alias("cluster"), F.when(k % 3 != 0, "confirmed").otherwise("left open").alias("decision"), F.lit("Name").alias("name"), person.alias("person_id"), (m != 0).alias("confident"), (m != 1).alias("is_public_figure"), F.when(m != 2, F.col("embedding")).alias("embedding"))
    return prints, curation.enrolments(asked, prints)


@query("""
WITH t AS (SELECT o_orderkey % 40 AS event_id, o_orderkey AS seq, CASE o_orderkey % 3 WHEN 0 THEN concat(['Anna', 'Boris', 'Chloe'][cast(o_orderkey % 7 % 3 AS int) + 1], ' ', ['Lee', 'Ray', 'Young', 'Wood'][cast(o_orderkey % 4 AS int) + 1], ' - topic') WHEN 1 THEN concat('grant to ', ['Huron', 'Raisin', 'Grand'][cast(o_orderkey % 5 % 3 AS int) + 1], ' River') ELSE 'Approve Minutes' END AS title FROM orders),
     p AS (SELECT event_id, 0 AS o, seq AS rank, regexp_extract(title, '^([A-Z][a-z]+ [A-Z][a-z]+) - ', 1) AS term FROM t WHERE title LIKE '% - topic'),
     n AS (SELECT event_id, 1 AS o, row_number() OVER (PARTITION BY event_id ORDER BY count(*) DESC, term) AS rank, term FROM (SELECT event_id, regexp_extract(title, 'to ([A-Z][a-z]+ River)', 1) AS term FROM t WHERE title LIKE 'grant %') GROUP BY event_id, term),
     f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id, lower(term) ORDER BY o, rank) AS rn FROM (SELECT * FROM p UNION ALL SELECT * FROM n)) WHERE rn = 1)
SELECT event_id, row_number() OVER (PARTITION BY event_id ORDER BY o, rank, term) AS place, CASE o WHEN 0 THEN 'agenda_speakers' ELSE 'agenda_proper_nouns' END AS source, term FROM f""")
def agenda_key_terms(s: Store) -> DataFrame:
    """Speakers and capitalised phrases of forty agendas."""
    k = F.col("o_orderkey")
    one = lambda names, at: F.element_at(F.array(*map(F.lit, names)), at.cast("int") + 1)
    title = F.when(k % 3 == 0, F.concat(one(["Anna", "Boris", "Chloe"], k % 7 % 3), F.lit(" "), one(["Lee", "Ray", "Young", "Wood"], k % 4), F.lit(" - topic"))).when(k % 3 == 1, F.concat(F.lit("grant to "), one(["Huron", "Raisin", "Grand"], k % 5 % 3), F.lit(" River"))).otherwise("Approve Minutes")
    terms = curation.agenda_terms(s.raw("orders").select((k % 40).alias("event_id"), k.alias("seq"), title.alias("title")), "event_id")
    return curation.key_terms(terms, "event_id", ["agenda_speakers", "agenda_proper_nouns"])


@query("""
SELECT c.id, coalesce(CASE o.org_type WHEN 'nonprofit' THEN 'philanthropic' WHEN 'government' THEN 'federal_grant' WHEN 'business' THEN 'private' END, 'other') AS category
FROM s_fiscal_references c LEFT JOIN s_orgs o ON o.id = c.awarding_org_id WHERE c.funding_source IS NULL OR c.funding_source = 'other'""")
def funding_category(s: Store) -> DataFrame:
    """A category by the awarding organisation's type, only where none or 'other' is known."""
    kinds = F.create_map(*[F.lit(x) for p in (("nonprofit", "philanthropic"), ("government", "federal_grant"), ("business", "private")) for x in p])
    open_ = s.fiscal_references.where("funding_source is null or funding_source = 'other'").select("id", "awarding_org_id")
    orgs = s.orgs.select(F.col("id").alias("awarding_org_id"), "org_type")
    return open_.join(orgs, "awarding_org_id", "left").select("id", F.coalesce(F.try_element_at(kinds, F.col("org_type")), F.lit("other")).alias("category"))


@query("""
WITH p AS (SELECT DISTINCT unnest(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM (SELECT string_split(text, ' ') AS w FROM benchmark) WHERE len(w) >= 5),
     d AS (SELECT doc_id, unnest(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents) WHERE len(w) >= 5)
SELECT DISTINCT doc_id FROM d SEMI JOIN p ON d.g = p.g""")
def prompt_leaks(s: Store) -> DataFrame:
    """Documents that repeat five words of any prompt in a row; prompts of fewer words have no run."""
    prompt = s.raw("benchmark").select(F.split("text", " ").alias("w")).where(F.size("w") >= 5)
    runs = prompt.select(F.explode(F.transform(F.sequence(F.lit(0), F.size("w") - 5), lambda i: F.array_join(F.slice("w", i + 1, F.lit(5)), " "))).alias("g")).distinct()
    w = F.split("text", " ")
    docs = s.raw("documents").select("doc_id", w.alias("w")).where(F.size("w") >= 5)
    grams = docs.select("doc_id", F.explode(F.transform(F.sequence(F.lit(0), F.size("w") - 5), lambda i: F.array_join(F.slice("w", i + 1, F.lit(5)), " "))).alias("g"))
    return grams.join(runs, "g", "left_semi").select("doc_id").distinct()


@query("""
WITH seg AS (SELECT item_id AS id, concat(translate(text, 'aeo', 'AEO'), repeat(' filler words here', cast(item_id % 40 AS int))) AS text FROM benchmark),
     n AS (SELECT id, list_filter(string_split_regex(regexp_replace(lower(text), '[^a-z0-9 ]', ' ', 'g'), ' +'), lambda x: x <> '') AS w FROM seg), p AS (SELECT item_id AS prompt_id, list_filter(string_split_regex(regexp_replace(lower(text), '[^a-z0-9 ]', ' ', 'g'), ' +'), lambda x: x <> '') AS w FROM benchmark),
     pg AS (SELECT DISTINCT prompt_id, unnest(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM p WHERE len(w) >= 5),
     sg AS (SELECT id, len(w) AS n, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM n WHERE len(w) >= 5)),
     c AS (SELECT id, prompt_id, n, count(DISTINCT q) AS covered FROM (SELECT sg.id, pg.prompt_id, n, unnest(generate_series(i, i + 4)) AS q FROM sg JOIN pg ON pg.g = sg.g) GROUP BY ALL)
SELECT id, prompt_id, round(covered / n, 2) AS coverage FROM c WHERE covered / n >= 0.5""")
def prompt_leak_segments(s: Store) -> DataFrame:
    """Segments that are mostly a prompt: items with other capitals and more and more words of their own."""
    items = s.raw("benchmark")
    segments = items.select(F.col("item_id").alias("id"), F.concat(F.translate("text", "aeo", "AEO"), F.repeat(F.lit(" filler words here"), (F.col("item_id") % 40).cast("int"))).alias("text"))
    return curation.prompt_leaks(segments, items.select(F.col("item_id").alias("prompt_id"), "text"))


_TERMS = [("plan", True, False), ("minutes", True, False)]
_RULINGS = [("doc_type", "memo", "map", "plan"), ("doc_type", "staff_report", "approve", None), ("doc_type", "other", "close", None)]


def _ruled(s: Store):
    terms = s.spark.createDataFrame(_TERMS, "term string, approved boolean, deprecated boolean")
    rulings = s.spark.createDataFrame(_RULINGS, "vocabulary string, term string, action string, target string")
    rows = s.documents.select("id", "doc_type")
    proposals = rows.groupBy(F.col("doc_type").alias("term")).agg(F.count("*").alias("occurrences"))
    return curation.apply_rulings(rows, proposals, rulings, "doc_type", "doc_type", terms)


@query("SELECT id, CASE WHEN doc_type = 'memo' THEN 'plan' ELSE doc_type END AS doc_type FROM s_documents")
def ruled_rows(s: Store) -> DataFrame:
    return _ruled(s)[0]


@query("SELECT doc_type AS term, count(*) AS occurrences, CASE doc_type WHEN 'memo' THEN 'mapped' WHEN 'staff_report' THEN 'approved' ELSE 'pending' END AS state, CASE doc_type WHEN 'memo' THEN 'plan' END AS target FROM s_documents GROUP BY doc_type")
def ruled_proposals(s: Store) -> DataFrame:
    return _ruled(s)[1]


@query("""
SELECT d.id AS document_id, d.id AS section_id, cast(10 + k * 5 AS int) AS span_start, cast(13 + k * 5 AS int) AS span_end, concat('said ', k) AS verbatim, CASE WHEN k = 1 THEN 'negative' ELSE 'affirmative' END AS polarity, coalesce(CASE WHEN k = 2 THEN d.published_date END, d.covers_period_end) AS asserted_start,
       CASE WHEN (CASE WHEN k = 2 THEN d.published_date END) IS NULL AND d.covers_period_end IS NOT NULL THEN 'reporting_period' END AS asserted_precision, sha256(d.text) AS pinned_hash
FROM s_documents d, (VALUES (0), (1), (2)) v(k) WHERE d.id % 4 <> 3""")
def stored_claims(s: Store) -> DataFrame:
    """Proposed claims as stored: absolute spans, defaults, inherited periods, the text's hash."""
    docs = s.documents
    sections = docs.select(F.col("id").alias("section_id"), F.col("id").alias("document_id"), F.lit(10).alias("section_start"), F.sha2("text", 256).alias("content_hash"), F.col("covers_period_end").alias("covers_period_start"), F.when(F.col("id") % 4 == 3, "C").otherwise("A").alias("tier"))
    k = F.col("k")
    proposed = docs.select(F.col("id").alias("section_id"), "published_date", F.explode(F.array(*[F.lit(x) for x in (0, 1, 2, 3)])).alias("k")).select(
        "section_id", (k * 5).alias("span_start"), (k * 5 + 3).alias("span_end"), F.when(k < 3, F.concat(F.lit("said "), k.cast("string"))).otherwise("  ").alias("verbatim"), F.when(k == 1, "negative").alias("polarity"), F.lit(None).cast("string").alias("modality"), F.when(k == 2, F.col("published_date")).alias("asserted_start"), F.array(F.struct(F.lit("fiscal").alias("kind"), k.alias("amount"))).alias("payloads")
    )
    return curation.stored_claims(proposed, sections).select("document_id", "section_id", "span_start", "span_end", "verbatim", "polarity", "asserted_start", "asserted_precision", "pinned_hash")


_SECTIONS = "SELECT id AS section_id, parse_confidence, CASE WHEN id % 11 = 0 THEN 'C' ELSE 'A' END AS tier, sha256(cast(id AS varchar)) AS content_hash, human_verdict, sha256(cast(CASE WHEN id % 2 = 0 THEN id ELSE id + 1 END AS varchar)) AS verdict_hash FROM s_document_sections"


def _sections(s: Store) -> DataFrame:
    k = F.col("id")
    digest = lambda c: F.sha2(c.cast("string"), 256)
    return s.document_sections.select(k.alias("section_id"), "parse_confidence", F.when(k % 11 == 0, "C").otherwise("A").alias("tier"), digest(k).alias("content_hash"), "human_verdict", digest(F.when(k % 2 == 0, k).otherwise(k + 1)).alias("verdict_hash"))


@query(f"SELECT section_id, CASE WHEN tier = 'C' THEN 'tier C' WHEN NOT coalesce(parse_confidence = 'clean' OR (human_verdict IN ('approved', 'approved_with_caveats') AND verdict_hash = content_hash), false) THEN 'not clean, not approved' WHEN section_id % 10 = 0 THEN 'extracted before' END AS refused FROM ({_SECTIONS})")
def extraction_guard(s: Store) -> DataFrame:
    sections = _sections(s)
    return curation.extractable(sections, sections.where("section_id % 10 = 0").select("section_id"))


@query(f"SELECT section_id, human_verdict AS verdict, CASE WHEN human_verdict IS NULL THEN 'none' WHEN verdict_hash = content_hash THEN 'current' ELSE 'stale' END AS state FROM ({_SECTIONS})")
def approval_states(s: Store) -> DataFrame:
    """A verdict holds for the text it was given on and lapses when that changes."""
    sections = _sections(s)
    rulings = sections.where("human_verdict is not null").select("section_id", F.col("human_verdict").alias("verdict"), "verdict_hash")
    return curation.approvals(sections.select("section_id", "content_hash"), rulings)


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'terminated' ELSE 'unknown' END AS award_status, CASE WHEN o_orderkey % 3 = 0 THEN 'quoted' END AS status_change_reason, CASE WHEN o_orderkey % 6 = 0 THEN DATE '2024-01-01' ELSE cast(o_orderdate AS date) END AS status_as_of FROM orders")
def award_status_apply(s: Store) -> DataFrame:
    k = F.col("o_orderkey")
    rows = s.raw("orders").select(k.alias("id"), F.lit("unknown").alias("award_status"), F.lit(None).cast("string").alias("status_change_reason"), F.col("o_orderdate").cast("date").alias("status_as_of"))
    changes = s.raw("orders").where("o_orderkey % 3 = 0").select(k.alias("id"), F.lit("terminated").alias("new_status"), F.lit("quoted").alias("reason"), F.when(k % 6 == 0, F.lit("2024-01-01").cast("date")).alias("as_of"))
    terms = s.spark.createDataFrame([("terminated", True, False), ("unknown", True, False)], "term string, approved boolean, deprecated boolean")
    return curation.apply_award_status(rows, changes, terms)


@query("""
WITH c AS (SELECT id, min(verbatim) AS v FROM s_claims GROUP BY id), r AS (SELECT id, v, CASE id % 4 WHEN 0 THEN substring(v, 5, 4) WHEN 1 THEN split_part(v, ' ', 2) WHEN 2 THEN 'absent' ELSE split_part(v, ' ', 1) END AS phrase FROM c)
SELECT id AS claim_id, phrase, CASE WHEN ok THEN p - 1 END AS span_start, CASE WHEN ok THEN p - 1 + length(phrase) END AS span_end, CASE WHEN p = 0 THEN 'not in the claim' WHEN NOT ok THEN 'ends inside a word' END AS refused
FROM (SELECT *, p > 0 AND NOT regexp_matches(CASE WHEN p > 1 THEN substring(v, p - 1, 1) ELSE '' END, '^[\\p{L}\\p{N}_]$') AND NOT regexp_matches(substring(v, p + length(phrase), 1), '^[\\p{L}\\p{N}_]$') AS ok FROM (SELECT *, strpos(v, phrase) AS p FROM r))""".replace("\\\\", "\\"))
def human_mentions(s: Store) -> DataFrame:
    """Phrases a person ruled on, located or refused."""
    claims = s.claims.groupBy("id").agg(F.min("verbatim").alias("verbatim"))
    m = F.col("id") % 4
    phrase = F.when(m == 0, F.substring("verbatim", 5, 4)).when(m == 1, F.split_part("verbatim", F.lit(" "), F.lit(2))).when(m == 2, "absent").otherwise(F.split_part("verbatim", F.lit(" "), F.lit(1)))
    ruled = claims.select(F.col("id").alias("claim_id"), F.lit(1).alias("subject_id"), phrase.alias("phrase"))
    return curation.human_mentions(claims, ruled).drop("subject_id")


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '1' END AS seen, try_cast(json_extract_string(props, '$.k') AS bigint) AS k FROM events")
def json_set(s: Store) -> DataFrame:
    """A key set in one half of the rows, another kept."""
    flags = curation.set_flag(F.col("props"), "seen", F.when(F.col("event_id") % 2 == 0, F.lit(1)))
    rows = s.raw("events").select("event_id", flags.alias("f"))
    return rows.select("event_id", F.get_json_object("f", "$.seen").alias("seen"), F.get_json_object("f", "$.k").try_cast("bigint").alias("k"))


@query("""
WITH e AS (SELECT vec_id, label, cast(embedding AS double[]) AS v FROM embeddings), f AS (SELECT label, arg_min(v, vec_id) AS first FROM e GROUP BY label),
     u AS (SELECT e.vec_id, list_transform(list_zip(f.first, e.v), lambda p: (p[1] * 3 + p[2]) / 4) AS m FROM e JOIN f ON f.label = e.label)
SELECT vec_id, round(m[1] / sqrt(list_sum(list_transform(m, lambda x: x * x))), 6) AS first_cell FROM u""")
def running_centroid(s: Store) -> DataFrame:
    """A mean of three vectors updated by a fourth."""
    e = s.raw("embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    first = e.groupBy("label").agg(F.min_by("v", "vec_id").alias("mean"))
    made = curation.updated_centroid(F.col("mean"), F.lit(3), F.col("v"))
    return e.join(first, "label").select("vec_id", F.round(F.element_at(made, 1), 6).alias("first_cell"))


@query()
def transferred_labels(s: Store) -> DataFrame:
    """Words of a recording labelled by aligning them with turns; tested on literal cases."""
    turns = s.words.where("speaker is not null").select("media_id", F.col("id").alias("seq"), "speaker", "text")
    return speech.transfer_labels(s.words, turns)


@query()
def window_mentions(s: Store) -> DataFrame:
    """Names whose words stand together in any order; tested on literal cases."""
    names = s.spark.createDataFrame([(1, "Commissions of Housing"), (2, "Authorized Councils"), (3, "Support Residents Saving")], "subject_id int, name string")
    return anchoring.window_mentions(s.claims.groupBy(F.col("id").alias("claim_id")).agg(F.min("verbatim").alias("verbatim")), names)
