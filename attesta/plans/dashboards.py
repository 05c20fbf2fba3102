"""The status dashboard and the tour of the store: counting, filtering, three-valued logic, top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.plans.registry import query
from attesta.plans.store import Store


@query("SELECT doc_type, count(*) AS docs, cast(sum(page_count) AS bigint) AS pages, count(*) FILTER (WHERE published_date IS NULL) AS no_pubdate, count(*) FILTER (WHERE covers_period_end IS NULL) AS no_period FROM s_documents GROUP BY 1")
def status_corpus(s: Store) -> DataFrame:
    return s.documents.groupBy("doc_type").agg(F.count("*").alias("docs"), F.sum("page_count").alias("pages"), F.count_if(F.col("published_date").isNull()).alias("no_pubdate"), F.count_if(F.col("covers_period_end").isNull()).alias("no_period"))


@query("""
SELECT d.doc_type, count(*) AS claims, count(*) FILTER (WHERE c.subject_id IS NULL) AS no_subject,
       round(100.0 * count(*) FILTER (WHERE c.subject_id IS NULL) / count(*), 1) AS pct_orphan, count(*) FILTER (WHERE c.org_id IS NULL) AS no_org, count(*) FILTER (WHERE c.actor_id IS NULL) AS no_actor
FROM s_claims c JOIN s_documents d ON d.id = c.document_id GROUP BY 1""")
def status_claim_coverage(s: Store) -> DataFrame:
    none = lambda c: F.count_if(F.col(c).isNull())
    rows = s.claims.join(s.documents.select(F.col("id").alias("document_id"), "doc_type"), "document_id")
    return rows.groupBy("doc_type").agg(F.count("*").alias("claims"), none("subject_id").alias("no_subject"), F.round(100.0 * none("subject_id") / F.count("*"), 1).alias("pct_orphan"), none("org_id").alias("no_org"), none("actor_id").alias("no_actor"))


@query("SELECT parse_confidence, count(*) AS sections, count(*) FILTER (WHERE human_verdict IS NOT NULL) AS human_signed, count(*) FILTER (WHERE subject_id IS NULL) AS no_subject FROM s_document_sections GROUP BY 1")
def status_sections(s: Store) -> DataFrame:
    return s.document_sections.groupBy("parse_confidence").agg(F.count("*").alias("sections"), F.count("human_verdict").alias("human_signed"), F.count_if(F.col("subject_id").isNull()).alias("no_subject"))


@query("""
SELECT 'subjects (initiative)' AS entity, count(*) FILTER (WHERE merged_into_id IS NULL) AS live, count(*) FILTER (WHERE merged_into_id IS NOT NULL) AS merged, (SELECT count(*) FROM s_subject_aliases) AS aliases FROM s_subjects WHERE subject_kind = 'initiative'
UNION ALL SELECT 'orgs', count(*) FILTER (WHERE merged_into_id IS NULL), count(*) FILTER (WHERE merged_into_id IS NOT NULL), (SELECT count(*) FROM s_org_aliases) FROM s_orgs""")
def status_entities(s: Store) -> DataFrame:
    def row(entity: str, rows: DataFrame, aliases: DataFrame) -> DataFrame:
        counts = rows.agg(F.count_if(F.col("merged_into_id").isNull()).alias("live"), F.count("merged_into_id").alias("merged"))
        return counts.crossJoin(aliases.agg(F.count("*").alias("aliases"))).select(F.lit(entity).alias("entity"), "live", "merged", "aliases")  # one row each

    return row("subjects (initiative)", s.subjects.where("subject_kind = 'initiative'"), s.subject_aliases).unionByName(row("orgs", s.orgs, s.org_aliases))


@query("""
SELECT 'subjects' AS entity, (SELECT count(*) FROM s_claims c JOIN s_subjects x ON x.id = c.subject_id WHERE x.merged_into_id IS NOT NULL) AS claims_on_a_tombstone
UNION ALL SELECT 'orgs', (SELECT count(*) FROM s_claims c JOIN s_orgs o ON o.id = c.org_id WHERE o.merged_into_id IS NOT NULL)""")
def status_tombstones(s: Store) -> DataFrame:
    def row(entity: str, dim: DataFrame, key: str) -> DataFrame:
        dead = dim.where("merged_into_id is not null").select(F.col("id").alias(key))
        return s.claims.join(dead, key, "left_semi").agg(F.lit(entity).alias("entity"), F.count("*").alias("claims_on_a_tombstone"))

    return row("subjects", s.subjects, "subject_id").unionByName(row("orgs", s.orgs, "org_id"))


@query("SELECT org_type, count(*) AS n FROM s_orgs GROUP BY 1")
def status_org_types(s: Store) -> DataFrame:
    return s.orgs.groupBy("org_type").agg(F.count("*").alias("n"))


@query("SELECT method, count(*) AS n, count(DISTINCT subject_id) AS subjects_named FROM s_claim_subject_mentions GROUP BY 1")
def status_mentions(s: Store) -> DataFrame:
    return s.claim_subject_mentions.groupBy("method").agg(F.count("*").alias("n"), F.countDistinct("subject_id").alias("subjects_named"))


@query("""
SELECT (SELECT count(*) FROM s_claim_subject_mentions m JOIN s_claims c ON c.id = m.claim_id WHERE substring(c.verbatim, m.span_start + 1, m.span_end - m.span_start) <> m.matched_text) AS span_mismatch,
       (SELECT count(*) FROM s_claim_subject_mentions a JOIN s_claim_subject_mentions b ON b.claim_id = a.claim_id AND b.subject_id = a.subject_id AND b.span_start > a.span_start AND b.span_start < a.span_end) AS overlapping,
       (SELECT count(*) FROM s_claim_subject_mentions m JOIN s_subjects x ON x.id = m.subject_id WHERE x.merged_into_id IS NOT NULL) AS on_a_tombstone""")
def status_mention_invariants(s: Store) -> DataFrame:
    """Spans that don't say what they claim, spans that overlap, mentions of merged subjects."""
    m = s.claim_subject_mentions
    texts = s.claims.select(F.col("id").alias("claim_id"), "verbatim")
    wrong = m.join(texts, "claim_id").where("substring(verbatim, span_start + 1, span_end - span_start) <> matched_text").agg(F.count("*").alias("span_mismatch"))
    b = m.select("claim_id", "subject_id", F.col("span_start").alias("later"))
    over = m.join(b, ["claim_id", "subject_id"]).where("later > span_start and later < span_end").agg(F.count("*").alias("overlapping"))
    dead = m.join(s.subjects.where("merged_into_id is not null").select(F.col("id").alias("subject_id")), "subject_id", "left_semi").agg(F.count("*").alias("on_a_tombstone"))
    return wrong.crossJoin(over).crossJoin(dead)  # one row each


@query("SELECT count(*) AS fiscal_rows, count(subject_id) AS has_subject, count(awarding_org_id) AS has_awarding_org, count(*) FILTER (WHERE award_status = 'unknown') AS status_unknown FROM s_fiscal_references")
def status_money(s: Store) -> DataFrame:
    return s.fiscal_references.agg(F.count("*").alias("fiscal_rows"), F.count("subject_id").alias("has_subject"), F.count("awarding_org_id").alias("has_awarding_org"), F.count_if(F.col("award_status") == "unknown").alias("status_unknown"))


@query("""
SELECT vocabulary, count(*) FILTER (WHERE status = 'pending') AS pending_terms, cast(coalesce(sum(occurrences) FILTER (WHERE status = 'pending'), 0) AS bigint) AS occurrences, cast(max(last_seen_at) AS date) AS last_seen
FROM s_vocabulary_proposals GROUP BY 1 HAVING count(*) FILTER (WHERE status = 'pending') > 0""")
def status_vocabulary_drift(s: Store) -> DataFrame:
    pending = F.col("status") == "pending"
    return s.vocabulary_proposals.groupBy("vocabulary").agg(F.count_if(pending).alias("pending_terms"), F.coalesce(F.sum(F.when(pending, F.col("occurrences"))), F.lit(0)).cast("long").alias("occurrences"), F.max("last_seen_at").cast("date").alias("last_seen")).where("pending_terms > 0")


# ---------------------------------------------------------------- tour


@query("SELECT * FROM s_bodies ORDER BY id LIMIT 10")
def tour_first_rows(s: Store) -> DataFrame:
    return s.bodies.orderBy("id").limit(10)


@query("SELECT name, classification, created_date FROM s_bodies WHERE active ORDER BY created_date DESC NULLS LAST, name LIMIT 15")
def tour_active_bodies(s: Store) -> DataFrame:
    return s.bodies.where("active").select("name", "classification", "created_date").orderBy(F.desc_nulls_last("created_date"), "name").limit(15)


@query("SELECT classification, count(*) AS bodies, count(*) FILTER (WHERE active) AS still_active FROM s_bodies GROUP BY classification")
def tour_filtered_counts(s: Store) -> DataFrame:
    return s.bodies.groupBy("classification").agg(F.count("*").alias("bodies"), F.count_if("active").alias("still_active")).orderBy(F.desc("bodies"))


@query("SELECT strftime(event_date, '%Y-%m') AS month, count(*) AS meetings FROM s_events GROUP BY month")
def tour_meetings_by_month(s: Store) -> DataFrame:
    return s.events.groupBy(F.date_format("event_date", "yyyy-MM").alias("month")).agg(F.count("*").alias("meetings")).orderBy("month")


@query("SELECT e.id, e.event_date, b.name AS body, e.location FROM s_events e JOIN s_bodies b ON b.id = e.body_id ORDER BY e.event_date DESC, e.id LIMIT 10")
def tour_latest_meetings(s: Store) -> DataFrame:
    latest = s.events.orderBy(F.desc("event_date"), "id").limit(10)  # every event has a body: the limit may come first
    return latest.join(s.bodies.select(F.col("id").alias("body_id"), F.col("name").alias("body")), "body_id").select("id", "event_date", "body", "location")


@query("SELECT b.name AS body, count(*) AS meetings, count(m.id) AS videos FROM s_events e JOIN s_bodies b ON b.id = e.body_id LEFT JOIN s_media_assets m ON m.event_id = e.id GROUP BY b.name")
def tour_rows_and_values(s: Store) -> DataFrame:
    media = s.media_assets.select(F.col("event_id").alias("id"), F.col("id").alias("media_id"))
    counts = s.events.join(media, "id", "left").groupBy("body_id").agg(F.count("*").alias("meetings"), F.count("media_id").alias("videos"))
    return counts.join(s.bodies.select(F.col("id").alias("body_id"), F.col("name").alias("body")), "body_id").select("body", "meetings", "videos")


@query("SELECT b.name AS body, count(e.id) AS meetings, min(e.event_date) AS first_meeting, max(e.event_date) AS last_meeting FROM s_bodies b LEFT JOIN s_events e ON e.body_id = b.id GROUP BY b.name")
def example_meetings_by_body(s: Store) -> DataFrame:
    counts = s.events.groupBy("body_id").agg(F.count("*").alias("meetings"), F.min("event_date").alias("first_meeting"), F.max("event_date").alias("last_meeting"))
    return s.bodies.select(F.col("id").alias("body_id"), F.col("name").alias("body")).join(counts, "body_id", "left").fillna(0, ["meetings"]).drop("body_id")


@query("SELECT video_available, count(*) AS n FROM s_events GROUP BY video_available")
def tour_three_values(s: Store) -> DataFrame:
    return s.events.groupBy("video_available").agg(F.count("*").alias("n"))


@query("SELECT count(*) FILTER (WHERE video_available = false) AS said_no, count(*) FILTER (WHERE video_available <> true) AS not_true, count(*) FILTER (WHERE video_available IS NULL) AS unknown, count(*) FILTER (WHERE video_available IS DISTINCT FROM true) AS distinct_from_true FROM s_events")
def tour_null_is_not_false(s: Store) -> DataFrame:
    v = F.col("video_available")
    return s.events.agg(F.count_if(v == F.lit(False)).alias("said_no"), F.count_if(v != F.lit(True)).alias("not_true"), F.count_if(v.isNull()).alias("unknown"), F.count_if(~v.eqNullSafe(F.lit(True))).alias("distinct_from_true"))


@query("SELECT n.name AS successor, l.relation, p.name AS predecessor, l.effective_date FROM s_body_lineage l JOIN s_bodies n ON n.id = l.successor_body_id JOIN s_bodies p ON p.id = l.predecessor_body_id")
def tour_lineage(s: Store) -> DataFrame:
    name = lambda role: s.bodies.select(F.col("id").alias(f"{role}_body_id"), F.col("name").alias(role))
    return s.body_lineage.join(name("successor"), "successor_body_id").join(name("predecessor"), "predecessor_body_id").select("successor", "relation", "predecessor", "effective_date")


@query("""
WITH RECURSIVE up(successor, ancestor, depth, path) AS (
  SELECT successor_body_id, predecessor_body_id, 1, [successor_body_id, predecessor_body_id] FROM s_body_lineage
  UNION ALL SELECT up.successor, l.predecessor_body_id, up.depth + 1, list_append(up.path, l.predecessor_body_id) FROM up JOIN s_body_lineage l ON l.successor_body_id = up.ancestor WHERE NOT list_contains(up.path, l.predecessor_body_id))
SELECT successor, ancestor, min(depth) AS depth FROM up GROUP BY successor, ancestor""")
def lineage_closure(s: Store) -> DataFrame:
    """All ancestors of each body with their least distance. Edges number as bodies do; a path never visits a body twice, so loops end."""
    return lineage(s.spark, s.body_lineage)


def lineage(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(successor, ancestor, depth) over edges (successor_body_id, predecessor_body_id)."""
    return spark.sql(
        """WITH RECURSIVE up(successor, ancestor, depth, path) AS (
             SELECT successor_body_id, predecessor_body_id, 1, array(successor_body_id, predecessor_body_id) FROM {edges}
             UNION ALL SELECT up.successor, l.predecessor_body_id, up.depth + 1, array_append(up.path, l.predecessor_body_id) FROM up JOIN {edges} l ON l.successor_body_id = up.ancestor WHERE NOT array_contains(up.path, l.predecessor_body_id))
           SELECT successor, ancestor, min(depth) AS depth FROM up GROUP BY successor, ancestor""",
        edges=edges,
    )


@query("SELECT e.id, e.event_date FROM s_events e WHERE NOT EXISTS (SELECT 1 FROM s_media_assets m WHERE m.event_id = e.id)")
def tour_without_recording(s: Store) -> DataFrame:
    return s.events.select("id", "event_date").join(s.media_assets.select(F.col("event_id").alias("id")), "id", "left_anti")


@query("SELECT e.id FROM s_events e WHERE EXISTS (SELECT 1 FROM s_commitments c WHERE c.id = e.id AND c.status = 'open')")
def tour_with_open_commitment(s: Store) -> DataFrame:
    return s.events.select("id").join(s.commitments.where("status = 'open'").select("id"), "id", "left_semi")


@query("SELECT id, concat('[', trim(concat('  ', location, ' ')), ']') AS shown FROM s_events WHERE location LIKE '%URGENT%'")
def tour_trimmed_like(s: Store) -> DataFrame:
    return s.events.where(F.col("location").like("%URGENT%")).select("id", F.concat(F.lit("["), F.trim(F.concat(F.lit("  "), "location", F.lit(" "))), F.lit("]")).alias("shown"))


@query("SELECT vote_value, count(*) AS votes, count(DISTINCT person_id) AS voters FROM s_votes WHERE vote_value IS NOT NULL GROUP BY vote_value")
def tour_votes(s: Store) -> DataFrame:
    return s.votes.where("vote_value is not null").groupBy("vote_value").agg(F.count("*").alias("votes"), F.countDistinct("person_id").alias("voters"))


@query("SELECT b.name AS body, count(*) AS meetings, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct FROM s_events e JOIN s_bodies b ON b.id = e.body_id GROUP BY b.name")
def tour_shares(s: Store) -> DataFrame:
    """Shares of a total: the total is one row, joined, rather than a window over one partition."""
    counts = s.events.groupBy("body_id").agg(F.count("*").alias("meetings"))
    total = s.events.agg(F.count("*").alias("total"))
    rows = counts.crossJoin(F.broadcast(total)).join(s.bodies.select(F.col("id").alias("body_id"), F.col("name").alias("body")), "body_id")
    return rows.select("body", "meetings", F.round(100.0 * F.col("meetings") / F.col("total"), 1).alias("pct"))


@query("SELECT p.id AS person_id, p.full_name, count(*) AS utterances FROM s_utterances u JOIN s_persons p ON p.id = u.person_id GROUP BY p.id, p.full_name ORDER BY utterances DESC, p.id LIMIT 10")
def tour_top_speakers(s: Store) -> DataFrame:
    top = s.utterances.groupBy("person_id").agg(F.count("*").alias("utterances")).join(s.persons.select(F.col("id").alias("person_id"), "full_name"), "person_id")
    return top.orderBy(F.desc("utterances"), "person_id").limit(10).select("person_id", "full_name", "utterances")


@query("SELECT id, name, coalesce(merged_into_id, id) AS effective_id, CASE WHEN merged_into_id IS NULL THEN 'live' ELSE 'merged' END AS state FROM s_orgs WHERE org_type IN ('nonprofit', 'government') OR org_type IS NULL")
def filtered_orgs(s: Store) -> DataFrame:
    keep = F.col("org_type").isin("nonprofit", "government") | F.col("org_type").isNull()
    return s.orgs.where(keep).select("id", "name", F.coalesce("merged_into_id", "id").alias("effective_id"), F.when(F.col("merged_into_id").isNull(), "live").otherwise("merged").alias("state"))


@query("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS bigint) AS k, json_extract_string(props, '$.k') IS NOT NULL AS has_k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def json_flags(s: Store) -> DataFrame:
    """A key of a JSON column, and whether it exists."""
    k = F.get_json_object("props", "$.k")
    return s.raw("events").where(k.isNotNull()).select("event_id", k.try_cast("bigint").alias("k"), k.isNotNull().alias("has_k"))


@query("SELECT id, (CASE WHEN subject_id IS NULL THEN 0 ELSE 1 END) + (CASE WHEN issue_id IS NULL THEN 0 ELSE 1 END) + (CASE WHEN org_id IS NULL THEN 0 ELSE 1 END) AS present FROM s_claims")
def num_nonnulls(s: Store) -> DataFrame:
    present = sum((F.col(c).isNotNull().cast("int") for c in ("subject_id", "issue_id", "org_id")), F.lit(0))
    return s.claims.select("id", present.alias("present"))
