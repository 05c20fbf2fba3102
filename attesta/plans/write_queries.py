"""Queries of the write semantics: what tables look like after a write, and what guards find."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.operators import writes
from attesta.plans.registry import query
from attesta.plans.store import Store

_TERMS = [("click", True, False), ("view", True, False), ("purchase", True, True), ("login", False, False)]
_GOOD = "('click', 'view')"


def _normalised(s: Store):
    terms = s.spark.createDataFrame(_TERMS, "term string, approved boolean, deprecated boolean")
    rows = s.raw("events").select("event_id", F.when(F.col("event_id") % 9 == 0, "").when(F.col("event_id") % 11 != 0, F.col("event_type")).alias("event_type"))
    return writes.enforce_vocabulary(rows, "event_type", terms, "event_id", "event_id", "event_type", "other")


_TYPED = "SELECT event_id, CASE WHEN event_id % 9 = 0 THEN '' WHEN event_id % 11 <> 0 THEN event_type END AS t FROM events"


@query(f"SELECT event_id, CASE WHEN t IS NULL OR t = '' OR t IN {_GOOD} THEN t ELSE 'other' END AS event_type FROM ({_TYPED})")
def vocabulary_rows(s: Store) -> DataFrame:
    return _normalised(s)[0].select("event_id", "event_type")


@query(f"SELECT t AS term, count(*) AS occurrences, min(event_id) AS entity_id, 'event_type' AS vocabulary FROM ({_TYPED}) WHERE t <> '' AND t NOT IN {_GOOD} GROUP BY t")
def vocabulary_proposals(s: Store) -> DataFrame:
    return _normalised(s)[1]


def _versions(s: Store) -> tuple[DataFrame, DataFrame]:
    c = s.raw("customer")
    old = c.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("name"), F.col("c_nationkey").alias("nation"))
    new = c.where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("id"), F.upper("c_name").alias("name"), (F.col("c_nationkey") + 100).alias("nation"))
    return old, new


_OLD = "SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS name, c_nationkey AS nation FROM customer WHERE c_custkey % 3 <> 0"
_NEW = "SELECT c_custkey AS id, upper(c_name) AS name, c_nationkey + 100 AS nation FROM customer WHERE c_custkey % 4 <> 0"


def _upsert_sql(name: str, nation: str) -> str:
    return f"SELECT coalesce(o.id, n.id) AS id, {name} AS name, {nation} AS nation FROM ({_OLD}) o FULL JOIN ({_NEW}) n ON n.id = o.id"


@query(_upsert_sql("CASE WHEN n.id IS NOT NULL THEN n.name ELSE o.name END", "CASE WHEN n.id IS NOT NULL THEN n.nation ELSE o.nation END"))
def upsert_update(s: Store) -> DataFrame:
    return writes.upsert(*_versions(s), ["id"], "update")


@query(_upsert_sql("CASE WHEN o.id IS NULL THEN n.name ELSE o.name END", "CASE WHEN o.id IS NULL THEN n.nation ELSE o.nation END"))
def upsert_nothing(s: Store) -> DataFrame:
    return writes.upsert(*_versions(s), ["id"], "nothing")


@query(_upsert_sql("coalesce(o.name, n.name)", "coalesce(o.nation, n.nation)"))
def upsert_enrich(s: Store) -> DataFrame:
    return writes.upsert(*_versions(s), ["id"], "enrich")


def _merges(s: Store) -> DataFrame:
    return s.subjects.where("id % 9 = 0").select(F.col("id").alias("loser"), (F.col("id") - 2).alias("survivor"))


@query("SELECT l_orderkey * 10 + l_linenumber AS claim_id, CASE WHEN l_partkey % 9 = 0 THEN l_partkey - 2 ELSE l_partkey END AS subject_id FROM lineitem")
def merge_repoint(s: Store) -> DataFrame:
    child = s.raw("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("claim_id"), F.col("l_partkey").alias("subject_id"))
    return writes.repoint(child, "subject_id", _merges(s))


@query("""
SELECT page_id, subject_id FROM (SELECT DISTINCT l_suppkey AS page_id, l_partkey AS subject_id FROM lineitem WHERE l_partkey % 9 <> 0
UNION SELECT l_suppkey, l_partkey - 2 FROM lineitem WHERE l_partkey % 9 = 0)""")
def merge_unique(s: Store) -> DataFrame:
    """Repointed rows that would double a unique partner are dropped."""
    child = s.raw("lineitem").select(F.col("l_suppkey").alias("page_id"), F.col("l_partkey").alias("subject_id")).distinct()
    return writes.repoint(child, "subject_id", _merges(s), ["page_id", "subject_id"])


@query("SELECT id, CASE WHEN id % 9 = 0 THEN id - 2 ELSE merged_into_id END AS merged_into_id FROM s_subjects")
def merge_tombstones(s: Store) -> DataFrame:
    return writes.tombstones(s.subjects, _merges(s)).select("id", "merged_into_id")


@query("SELECT a.id, a.merged_into_id, CASE WHEN a.id = a.merged_into_id THEN 'self' WHEN b.id IS NULL THEN 'missing' ELSE 'chain' END AS fault FROM (SELECT p_partkey AS id, CASE WHEN p_partkey % 9 = 0 THEN p_partkey - 9 WHEN p_partkey % 50 = 1 THEN p_partkey END AS merged_into_id FROM part) a LEFT JOIN (SELECT p_partkey AS id, CASE WHEN p_partkey % 9 = 0 THEN p_partkey - 9 WHEN p_partkey % 50 = 1 THEN p_partkey END AS m FROM part) b ON b.id = a.merged_into_id WHERE a.merged_into_id IS NOT NULL AND (a.id = a.merged_into_id OR b.id IS NULL OR b.m IS NOT NULL)")
def merge_guard(s: Store) -> DataFrame:
    k = F.col("p_partkey")
    parents = s.raw("part").select(k.alias("id"), F.when(k % 9 == 0, k - 9).when(k % 50 == 1, k).alias("merged_into_id"))
    return writes.merge_target_faults(parents)


@query("SELECT v.person_id, count(*) AS refused FROM s_person_voiceprints v JOIN s_persons p ON p.id = v.person_id WHERE p.is_public_figure = false GROUP BY v.person_id")
def privacy_gate(s: Store) -> DataFrame:
    return writes.private_voiceprints(s.person_voiceprints, s.persons).groupBy("person_id").agg(F.count("*").alias("refused"))


_REFUSED = "SELECT id FROM s_claims WHERE subject_id IS NULL OR curation_state <> 'confirmed'"


@query(f"SELECT claim_id, page_id FROM s_page_manifests WHERE claim_id IN ({_REFUSED})")
def publication_gate(s: Store) -> DataFrame:
    """Manifest rows that the gate would refuse."""
    return writes.refused_manifests(s.page_manifests, s.claims)


@query(f"SELECT claim_id, page_id FROM s_page_manifests WHERE claim_id NOT IN ({_REFUSED})")
def published_manifests(s: Store) -> DataFrame:
    """Manifests after inserting, under the gate, those rows that it lets pass."""
    bad = writes.refused_manifests(s.page_manifests, s.claims).select("claim_id").distinct()
    return writes.insert_manifests(s.page_manifests.where("false"), s.page_manifests.join(bad, "claim_id", "left_anti"), s.claims)


_SPANS = "SELECT DISTINCT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS doc, l_linenumber * 100 AS span_start, l_linenumber * 100 + 40 AS span_end FROM {lineitem}"
_EDITS = "SELECT l_orderkey AS doc, cast(l_partkey % 700 AS int) AS edit_start, cast(l_partkey % 700 AS int) + 8 AS edit_end, cast(l_suppkey % 11 AS int) - 5 AS delta FROM {lineitem} WHERE l_linenumber <= 2"


@query(f"""
SELECT id, doc, CASE WHEN t THEN span_start ELSE span_start + d END AS span_start, CASE WHEN t THEN span_end ELSE span_end + d END AS span_end, t AS needs_reanchor FROM (
  SELECT s.id, s.doc, s.span_start, s.span_end, cast(coalesce(sum(CASE WHEN e.edit_end <= s.span_start THEN e.delta END), 0) AS bigint) AS d, coalesce(bool_or(e.edit_start < s.span_end AND e.edit_end > s.span_start), false) AS t
  FROM ({_SPANS.replace('{lineitem}', 'lineitem')}) s LEFT JOIN ({_EDITS.replace('{lineitem}', 'lineitem')}) e ON e.doc = s.doc GROUP BY ALL)""")
def span_shift(s: Store) -> DataFrame:
    line = s.raw("lineitem")
    return writes.shift_spans(s.spark.sql(_SPANS, lineitem=line), s.spark.sql(_EDITS, lineitem=line), "doc")


@query("SELECT c.id, coalesce(c.subject_id, d.subject_id) AS subject_id FROM s_claims c LEFT JOIN (SELECT l_orderkey AS document_section_id, min(l_partkey) AS subject_id FROM lineitem GROUP BY 1) d ON d.document_section_id = c.document_section_id")
def inherited_subjects(s: Store) -> DataFrame:
    derived = s.raw("lineitem").groupBy(F.col("l_orderkey").alias("document_section_id")).agg(F.min("l_partkey").alias("subject_id"))
    return writes.fill_only_null(s.claims, derived, ["document_section_id"], "subject_id").select("id", "subject_id")


@query("""
WITH m AS (SELECT label, p, avg(cast(v AS double)) AS m, count(*) AS n FROM (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS p FROM embeddings) GROUP BY 1, 2)
SELECT label, max(n) AS n, round(max(CASE WHEN p = 1 THEN m END) / sqrt(sum(m * m)), 6) AS first_cell FROM m GROUP BY label""")
def centroids(s: Store) -> DataFrame:
    return writes.centroid(s.raw("embeddings"), "label").select("label", "n", F.round(F.element_at("centroid", 1), 6).alias("first_cell"))


@query("""
WITH b AS (SELECT id, external_id, title, action, live, id % 2 AS side, external_id IS NOT NULL AND live AS inside FROM s_partial_items),
     o AS (SELECT external_id AS k, min(id) AS id, arg_min(title, id) AS title, arg_min(action, id) AS action FROM b WHERE inside AND side = 0 GROUP BY 1),
     n AS (SELECT external_id AS k, min(id) AS id, arg_min(title, id) AS title, arg_max(action, id) AS action FROM b WHERE inside AND side = 1 GROUP BY 1)
SELECT coalesce(o.id, n.id) AS id, coalesce(o.k, n.k) AS external_id, CASE WHEN o.k IS NULL THEN n.title ELSE o.title END AS title, coalesce(n.action, o.action) AS action, true AS live FROM o FULL JOIN n ON n.k = o.k
UNION ALL SELECT id, external_id, title, action, live FROM b WHERE NOT inside""")
def upsert_partial(s: Store) -> DataFrame:
    """Items upserted under a key that is unique among live items with a known number only; the action alone is overwritten."""
    items = s.partial_items
    live = F.col("live")
    held = items.where("id % 2 = 0 and external_id is not null and live").groupBy("external_id").agg(F.min_by(F.struct("id", "title", "action", "live"), "id").alias("r")).select("r.id", "external_id", "r.title", "r.action", "r.live")
    old = held.unionByName(items.where("id % 2 = 0 and not (external_id is not null and live)"))
    return writes.upsert_where(old, items.where("id % 2 = 1").withColumn("seq", F.col("id")), ["external_id"], "seq", ["action"], live)


_LINKED = """
  c AS (SELECT DISTINCT ON (body_id, external_id) * FROM s_calendar_meetings WHERE external_id IS NOT NULL ORDER BY body_id, external_id, id),
  old AS (SELECT * FROM c UNION ALL SELECT * FROM s_calendar_meetings WHERE external_id IS NULL),
  n AS (SELECT DISTINCT ON (body_id, external_id) * FROM s_listed_meetings ORDER BY body_id, external_id, seq),
  h AS (SELECT n.*, (SELECT count(*) FROM old o WHERE o.body_id = n.body_id AND o.event_date = n.event_date) AS hits, row_number() OVER (PARTITION BY n.body_id, n.event_date ORDER BY n.seq) AS rn FROM n),
  f AS (SELECT body_id, event_date, hits, arg_max(external_id, seq) AS own, arg_min(external_id, seq) AS own0, arg_min(id, seq) AS id, min(seq) AS s0,
               arg_min(location, seq) FILTER (WHERE location IS NOT NULL) AS location, arg_min(agenda_url, seq) FILTER (WHERE agenda_url IS NOT NULL) AS agenda_url FROM h WHERE hits <= 1 GROUP BY 1, 2, 3),
  l AS (SELECT o.id, o.body_id, coalesce(f.own, o.external_id) AS external_id, o.event_date, coalesce(o.location, f.location) AS location, coalesce(o.agenda_url, f.agenda_url) AS agenda_url FROM old o LEFT JOIN f ON f.hits = 1 AND f.body_id = o.body_id AND f.event_date = o.event_date)"""


def _linked(s: Store) -> tuple[DataFrame, DataFrame]:
    first = lambda df, order: df.groupBy("body_id", "external_id").agg(F.min_by(F.struct(*[c for c in df.columns if c not in ("body_id", "external_id")]), order).alias("r")).select("body_id", "external_id", "r.*")
    cal = s.calendar_meetings
    old = first(cal.where("external_id is not null"), "id").select(*cal.columns).unionByName(cal.where("external_id is null"))
    return writes.link_or_insert(old, first(s.listed_meetings, "seq"), ["body_id", "event_date"], ["body_id", "external_id"], "seq", ["location", "agenda_url"], ["event_date", "agenda_url"])


@query(f"""
WITH {_LINKED} SELECT coalesce(l.id, f.id) AS id, coalesce(l.body_id, f.body_id) AS body_id, coalesce(f.own, l.external_id) AS external_id, coalesce(f.event_date, l.event_date) AS event_date,
  CASE WHEN l.id IS NULL THEN f.location ELSE coalesce(l.location, f.location) END AS location, CASE WHEN f.id IS NULL THEN l.agenda_url ELSE f.agenda_url END AS agenda_url
FROM l FULL JOIN (SELECT * FROM f WHERE hits = 0) f ON f.body_id = l.body_id AND f.own0 = l.external_id""")
def linked_meetings(s: Store) -> DataFrame:
    """Calendar meetings once another source's are linked by body and date, or upserted by its number."""
    return _linked(s)[0]


@query(f"""
WITH {_LINKED} SELECT h.body_id, h.event_date, h.external_id, h.seq, h.hits,
  CASE WHEN hits > 1 THEN 'ambiguous' WHEN hits = 1 OR rn > 1 THEN 'linked' WHEN EXISTS (SELECT 1 FROM l WHERE l.body_id = h.body_id AND l.external_id = h.external_id) THEN 'updated' ELSE 'inserted' END AS outcome FROM h""")
def link_outcomes(s: Store) -> DataFrame:
    """What became of each listed meeting; several calendar rows of one body and date are a queue, never a guess."""
    return _linked(s)[1]


# ---------------------------------------------------------------- inheritance

# several sections and mentions of a key may name several subjects: those decide nothing
_CHAIN = """
  one AS (SELECT id, coalesce(m.merged_into_id, s.id) AS live FROM (SELECT DISTINCT id FROM s_subjects) s LEFT JOIN (SELECT id AS k, any_value(merged_into_id) AS merged_into_id FROM s_subjects GROUP BY id) m ON m.k = s.id),
  src AS (SELECT 0 AS rank, 'section' AS name, 'section' AS kind, id AS k, subject_id AS v FROM s_document_sections UNION ALL SELECT 1, 'document', 'document', document_id, subject_id FROM s_document_mentions
          UNION ALL SELECT 2, 'initiative', 'claim', claim_id, subject_id FROM s_claim_subject_mentions UNION ALL SELECT 3, 'organisation', 'org', org_id, subject_id FROM s_org_subjects),
  cand AS (SELECT rank, any_value(name) AS name, kind, k, list_sort(list(DISTINCT coalesce(one.live, v))) AS c FROM src LEFT JOIN one ON one.id = src.v WHERE k IS NOT NULL AND v IS NOT NULL GROUP BY rank, kind, k),
  cl AS (SELECT id, subject_id, document_section_id, document_id, org_id FROM s_claims),
  met AS (SELECT cl.id, cl.subject_id, a.c AS a, b.c AS b, i.c AS i, o.c AS o FROM cl LEFT JOIN cand a ON a.rank = 0 AND a.k = cl.document_section_id LEFT JOIN cand b ON b.rank = 1 AND b.k = cl.document_id LEFT JOIN cand i ON i.rank = 2 AND i.k = cl.id LEFT JOIN cand o ON o.rank = 3 AND o.k = cl.org_id),
  told AS (SELECT id, coalesce(subject_id, CASE WHEN len(a) = 1 THEN a[1] WHEN len(b) = 1 THEN b[1] WHEN len(i) = 1 THEN i[1] WHEN len(o) = 1 THEN o[1] END) AS subject_id,
                  CASE WHEN subject_id IS NOT NULL THEN NULL WHEN len(a) = 1 THEN 'section' WHEN len(b) = 1 THEN 'document' WHEN len(i) = 1 THEN 'initiative' WHEN len(o) = 1 THEN 'organisation' END AS provenance,
                  list_sort(list_distinct(coalesce(a, []) || coalesce(b, []) || coalesce(i, []) || coalesce(o, []))) AS candidates FROM met)"""


def _inherited(s: Store) -> tuple[DataFrame, DataFrame, DataFrame]:
    claims = s.claims.select("id", "subject_id", "document_section_id", "document_id", "org_id")
    merged = s.subjects.where("merged_into_id is not null").groupBy("id").agg(F.first("merged_into_id").alias("survivor"))
    sources = [
        ("section", s.document_sections.select(F.col("id").alias("document_section_id"), "subject_id"), ["document_section_id"]),
        ("document", s.document_mentions, ["document_id"]),
        ("initiative", s.claim_subject_mentions.select(F.col("claim_id").alias("id"), "subject_id"), ["id"]),
        ("organisation", s.org_subjects, ["org_id"]),
    ]
    return writes.inherit(claims, "id", "subject_id", sources, merged, longest="document")


@query(f"WITH {_CHAIN} SELECT id, subject_id, provenance FROM told")
def inherited_chain(s: Store) -> DataFrame:
    """Claims' subjects: their own, else their section's, document's, initiative's or organisation's, and which of them spoke."""
    return _inherited(s)[0].select("id", "subject_id", "provenance")


@query(f"WITH {_CHAIN} SELECT id, CASE WHEN len(candidates) > 0 THEN 'ambiguous' ELSE 'no candidate' END AS reason, array_to_string(candidates, '|') AS candidates FROM told WHERE subject_id IS NULL")
def inheritance_queue(s: Store) -> DataFrame:
    """Claims that no source gives a subject, and what was offered for them."""
    return _inherited(s)[1].withColumn("candidates", F.array_join("candidates", "|"))


@query(f"WITH {_CHAIN} SELECT provenance, count(*) AS filled FROM told WHERE provenance IS NOT NULL GROUP BY provenance")
def inheritance_counts(s: Store) -> DataFrame:
    return _inherited(s)[2]


@query("""
WITH n AS (SELECT lower(name) AS name, coalesce(any_value(merged_into_id), any_value(id)) AS org FROM s_orgs GROUP BY lower(name), id UNION ALL SELECT lower(a.alias), coalesce(o.merged_into_id, o.id) FROM s_org_aliases a JOIN s_orgs o ON o.id = a.org_id),
     u AS (SELECT name, any_value(org) AS org FROM n GROUP BY name HAVING count(DISTINCT org) = 1),
     p AS (SELECT lower(program) AS name, any_value(coalesce(o.merged_into_id, g.org)) AS org FROM s_programs g LEFT JOIN s_orgs o ON o.id = g.org GROUP BY 1 HAVING count(DISTINCT coalesce(o.merged_into_id, g.org)) = 1),
     f AS (SELECT id, funder, awarding_org_id FROM s_funded)
SELECT f.id, coalesce(f.awarding_org_id, u.org, p.org) AS awarding_org_id, CASE WHEN f.awarding_org_id IS NOT NULL THEN NULL WHEN u.org IS NOT NULL THEN 'registry' WHEN p.org IS NOT NULL THEN 'program' END AS provenance
FROM f LEFT JOIN u ON u.name = lower(f.funder) LEFT JOIN p ON p.name = lower(f.funder)""")
def resolved_funders(s: Store) -> DataFrame:
    """Funders named in awards, by the registry of organisations as it is now, else by the programme's administering body; known ones stay."""
    rows = s.funded.withColumn("_name", F.lower("funder"))
    merged = s.orgs.where("merged_into_id is not null").select("id", F.col("merged_into_id").alias("survivor"))
    named = s.orgs.select(F.lower("name").alias("_name"), F.col("id").alias("awarding_org_id")).unionByName(s.org_aliases.select(F.lower("alias").alias("_name"), F.col("org_id").alias("awarding_org_id")))
    programs = s.programs.select(F.lower("program").alias("_name"), F.col("org").alias("awarding_org_id"))
    return writes.inherit(rows, "id", "awarding_org_id", [("registry", named, ["_name"]), ("program", programs.distinct(), ["_name"])], merged)[0].select("id", "awarding_org_id", "provenance")


@query("""
WITH s AS (SELECT id, any_value(name) AS name, any_value(parent_subject_id) AS parent, any_value(merged_into_id) AS m FROM s_subjects GROUP BY id),
     c AS (SELECT t.id AS child, t.part_of, list(DISTINCT coalesce(s.m, s.id)) AS p FROM s_part_of t JOIN s ON s.name = t.part_of GROUP BY 1, 2)
SELECT s.id, coalesce(s.parent, CASE WHEN len(c.p) = 1 AND c.p[1] <> s.id THEN c.p[1] END) AS parent_subject_id FROM s LEFT JOIN c ON c.child = s.id""")
def resolved_parents(s: Store) -> DataFrame:
    """Parents of subjects by the name that a subject says it is part of: merged ones lead to their survivors, none is its own parent, known ones stay."""
    one = s.subjects.groupBy("id").agg(F.first("name").alias("name"), F.first("parent_subject_id").alias("parent_subject_id"), F.first("merged_into_id").alias("m"))
    rows = one.join(s.part_of, "id", "left").select("id", "parent_subject_id", "part_of")
    named = one.select(F.col("name").alias("part_of"), F.coalesce("m", "id").alias("parent_subject_id"))
    told = writes.inherit(rows, "id", "parent_subject_id", [("name", named, ["part_of"])])[0]
    own = F.col("provenance").isNotNull() & (F.col("parent_subject_id") == F.col("id"))
    return told.select("id", F.when(~own, F.col("parent_subject_id")).alias("parent_subject_id"))
