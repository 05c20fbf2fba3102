"""The derived views of the claim store (V1 to V17), as functions of its tables.

Dates relative to today take an explicit ``AS_OF``, so that results can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attesta.plans.registry import query
from attesta.plans.store import Store

AS_OF = "2024-06-30"


def distinct_list(c: str) -> Column:
    """Sorted distinct values joined by '|', null as '(null)'; null for no rows."""
    values = F.sort_array(F.collect_set(F.coalesce(F.col(c).cast("string"), F.lit("(null)"))))
    return F.when(F.size(values) > 0, F.array_join(values, "|"))


@query("""
SELECT a.id AS argument_id, a.canonical_name, c.source_type, c.actor_capacity, c.speech_act,
       coalesce(c.asserted_start, e.event_date, d.published_date, d.covers_period_end) AS occurred_on, p.full_name AS actor, c.id AS claim_id, cr.verbatim
FROM s_arguments a JOIN s_claim_reasons cr ON cr.argument_id = a.id JOIN s_claims c ON c.id = cr.claim_id
LEFT JOIN s_persons p ON p.id = c.actor_id LEFT JOIN s_utterances u ON u.id = c.utterance_id LEFT JOIN s_segments s ON s.id = u.segment_id
LEFT JOIN s_events e ON e.id = s.event_id LEFT JOIN s_documents d ON d.id = c.document_id""")
def v_argument_propagation(s: Store) -> DataFrame:
    """How an argument moves through the record; the first known of four dates."""
    c = s.claims.withColumnRenamed("id", "claim_id")
    reasons = s.claim_reasons
    rows = (
        s.arguments.withColumnRenamed("id", "argument_id")
        .join(reasons, "argument_id")
        .join(c.drop("verbatim"), "claim_id")
        .join(s.persons.select(F.col("id").alias("actor_id"), F.col("full_name").alias("actor")), "actor_id", "left")
        .join(s.utterances.select(F.col("id").alias("utterance_id"), "segment_id"), "utterance_id", "left")
        .join(s.segments.select(F.col("id").alias("segment_id"), "event_id"), "segment_id", "left")
        .join(s.events.select(F.col("id").alias("event_id"), "event_date"), "event_id", "left")
        .join(s.documents.select(F.col("id").alias("document_id"), "published_date", "covers_period_end"), "document_id", "left")
    )
    on = F.coalesce("asserted_start", "event_date", "published_date", "covers_period_end").alias("occurred_on")
    return rows.select("argument_id", "canonical_name", "source_type", "actor_capacity", "speech_act", on, "actor", "claim_id", "verbatim")


@query("""
SELECT ae.id AS asserted_event_id, ae.subject_id, ae.canonical_description, ae.event_class, ae.occurred_start, ae.occurred_end, ae.occurred_precision,
       count(*) FILTER (WHERE ea.attestation_type IN ('primary_record', 'firsthand', 'secondhand')) AS independent_attestations,
       count(DISTINCT c.source_type) AS distinct_source_types, count(*) AS total_attestations, count(DISTINCT ea.stated_start) > 1 AS dates_disagree
FROM s_asserted_events ae JOIN s_event_attestations ea ON ea.asserted_event_id = ae.id JOIN s_claims c ON c.id = ea.claim_id
GROUP BY ALL""")
def v_timeline(s: Store) -> DataFrame:
    """Events by independent attestations: boilerplate counts in the total only."""
    independent = F.col("attestation_type").isin("primary_record", "firsthand", "secondhand")
    counts = (
        s.event_attestations.join(s.claims.select(F.col("id").alias("claim_id"), "source_type"), "claim_id")
        .groupBy("asserted_event_id")
        .agg(
            F.count_if(independent).alias("independent_attestations"),
            F.countDistinct("source_type").alias("distinct_source_types"),
            F.count("*").alias("total_attestations"),
            (F.countDistinct("stated_start") > 1).alias("dates_disagree"),
        )
    )
    return s.asserted_events.withColumnRenamed("id", "asserted_event_id").join(counts, "asserted_event_id")


@query("""
SELECT c.subject_id, c.issue_id, i.canonical_name, count(*) AS public_claims,
       (SELECT string_agg(x, '|' ORDER BY x) FROM (SELECT DISTINCT coalesce(l.doc_type, '(null)') AS x FROM s_source_search_log l WHERE l.subject_id = c.subject_id)) AS searched_types
FROM s_claims c JOIN s_issues i ON i.id = c.issue_id
WHERE c.source_type IN ('video_utterance', 'ecomment', 'correspondence') AND c.actor_capacity IN ('public', 'organizational_rep')
  AND NOT EXISTS (SELECT 1 FROM s_claims o WHERE o.issue_id = c.issue_id AND o.subject_id = c.subject_id AND o.source_type IN ('staff_report', 'memo', 'minutes', 'plan', 'annual_report'))
GROUP BY c.subject_id, c.issue_id, i.canonical_name""")
def v_dark_matter_corpus(s: Store) -> DataFrame:
    """Issues raised publicly that no official source engages; null searched_types: nobody has looked."""
    c = s.claims
    public = c.where(F.col("source_type").isin("video_utterance", "ecomment", "correspondence") & F.col("actor_capacity").isin("public", "organizational_rep"))
    official = c.where(F.col("source_type").isin("staff_report", "memo", "minutes", "plan", "annual_report")).select("issue_id", "subject_id").distinct()
    silent = public.join(official, ["issue_id", "subject_id"], "left_anti")  # equality: a null subject stays
    searched = s.source_search_log.groupBy("subject_id").agg(distinct_list("doc_type").alias("searched_types"))
    counted = silent.join(s.issues.withColumnRenamed("id", "issue_id"), "issue_id").groupBy("subject_id", "issue_id", "canonical_name").agg(F.count("*").alias("public_claims"))
    return counted.join(searched, "subject_id", "left")


@query("""
SELECT c.id AS claim_id, c.subject_id, s.name AS subject_name, c.position, c.asserted_start, c.source_type, c.verbatim
FROM s_claims c LEFT JOIN s_subjects s ON s.id = c.subject_id WHERE c.outcome_without_mechanism""")
def v_dark_matter_record(s: Store) -> DataFrame:
    """Outcomes asserted with no mechanism."""
    names = s.subjects.select(F.col("id").alias("subject_id"), F.col("name").alias("subject_name"))
    rows = s.claims.where("outcome_without_mechanism").join(names, "subject_id", "left")
    return rows.select(F.col("id").alias("claim_id"), "subject_id", "subject_name", "position", "asserted_start", "source_type", "verbatim")


@query(f"""
SELECT cc.id, cc.condition_text, cc.condition_origin, cc.target_date, c.subject_id, s.name AS subject_name, c.asserted_start AS stated_on,
       DATE '{AS_OF}' - cc.target_date AS days_past_target, cc.verbatim
FROM s_claim_conditions cc JOIN s_claims c ON c.id = cc.claim_id LEFT JOIN s_subjects s ON s.id = c.subject_id WHERE cc.is_met <> 'true'""")
def v_unmet_conditions(s: Store) -> DataFrame:
    """Conditions not met; unknown (null) ones are not among them, days keep their sign."""
    c = s.claims.select(F.col("id").alias("claim_id"), "subject_id", F.col("asserted_start").alias("stated_on"))
    names = s.subjects.select(F.col("id").alias("subject_id"), F.col("name").alias("subject_name"))
    rows = s.claim_conditions.where("is_met <> 'true'").join(c, "claim_id").join(names, "subject_id", "left")
    days = F.datediff(F.lit(AS_OF).cast("date"), "target_date").cast("long").alias("days_past_target")
    return rows.select("id", "condition_text", "condition_origin", "target_date", "subject_id", "subject_name", "stated_on", days, "verbatim")


@query(f"""
SELECT *, DATE '{AS_OF}' - due_date AS days_overdue FROM s_commitments WHERE status = 'open' AND fulfilled_by_document_id IS NULL""")
def v_open_commitments(s: Store) -> DataFrame:
    """Open commitments with no written follow-up, oldest first."""
    days = F.datediff(F.lit(AS_OF).cast("date"), "due_date").cast("long")
    return s.commitments.where("status = 'open' and fulfilled_by_document_id is null").withColumn("days_overdue", days)


@query("""
SELECT fr.id, s.name AS subject_name, fr.amount_low, fr.amount_high, fr.funding_source, fr.award_status, fr.status_as_of, fr.status_change_reason, fr.verbatim
FROM s_fiscal_references fr LEFT JOIN s_subjects s ON s.id = fr.subject_id
WHERE fr.award_status IN ('on_hold', 'terminated', 'rescinded', 'disputed', 'withdrawn')""")
def v_reversed_funding(s: Store) -> DataFrame:
    """Funding that was awarded and then reversed, latest first."""
    reversed_ = s.fiscal_references.where(F.col("award_status").isin("on_hold", "terminated", "rescinded", "disputed", "withdrawn"))
    names = s.subjects.select(F.col("id").alias("subject_id"), F.col("name").alias("subject_name"))
    return reversed_.join(names, "subject_id", "left").select("id", "subject_name", "amount_low", "amount_high", "funding_source", "award_status", "status_as_of", "status_change_reason", "verbatim")


@query("""
SELECT q.subject_id, s.name AS subject_name, q.measure, q.unit, count(DISTINCT q.value_low) AS distinct_values,
       string_agg(DISTINCT coalesce(lpad(cast(q.value_low AS varchar), 6, ' '), '(null)'), '|' ORDER BY coalesce(lpad(cast(q.value_low AS varchar), 6, ' '), '(null)')) AS all_values,
       string_agg(DISTINCT coalesce(q.scope_note, '(null)'), '|' ORDER BY coalesce(q.scope_note, '(null)')) AS scopes,
       string_agg(DISTINCT q.source_type, '|' ORDER BY q.source_type) AS source_types
FROM s_quantities q LEFT JOIN s_subjects s ON s.id = q.subject_id
GROUP BY q.subject_id, s.name, q.measure, q.unit HAVING count(DISTINCT q.value_low) > 1""")
def v_numeric_drift(s: Store) -> DataFrame:
    """The same measure on the same subject with different values. The name joins after the groups are counted."""
    q = s.quantities.withColumn("shown", F.lpad(F.col("value_low").cast("string"), 6, " "))
    groups = (
        q.groupBy("subject_id", "measure", "unit")
        .agg(F.countDistinct("value_low").alias("distinct_values"), distinct_list("shown").alias("all_values"), distinct_list("scope_note").alias("scopes"), distinct_list("source_type").alias("source_types"))
        .where("distinct_values > 1")
    )
    return groups.join(s.subjects.select(F.col("id").alias("subject_id"), F.col("name").alias("subject_name")), "subject_id", "left")


@query("""
SELECT 'jurisdiction_citation' AS origin, dispute_basis AS condition_text, cited_jurisdiction AS context, verbatim FROM s_jurisdiction_citations WHERE dispute_basis IS NOT NULL
UNION ALL
SELECT 'rejected_alternative', rejection_reason, alternative_name, verbatim FROM s_considered_alternatives WHERE disposition = 'rejected' AND is_scope_condition_candidate""")
def v_scope_conditions(s: Store) -> DataFrame:
    """Disputed comparisons and reasons why alternatives were rejected."""
    cited = s.jurisdiction_citations.where("dispute_basis is not null").select(F.lit("jurisdiction_citation").alias("origin"), F.col("dispute_basis").alias("condition_text"), F.col("cited_jurisdiction").alias("context"), "verbatim")
    rejected = s.considered_alternatives.where("disposition = 'rejected' and is_scope_condition_candidate").select(F.lit("rejected_alternative").alias("origin"), F.col("rejection_reason").alias("condition_text"), F.col("alternative_name").alias("context"), "verbatim")
    return cited.unionByName(rejected)


@query("""
SELECT c.id, c.position, c.evidence_grade, count(pm.page_id) AS page_count FROM s_claims c JOIN s_page_manifests pm ON pm.claim_id = c.id
WHERE c.reviewed_by IS NULL GROUP BY c.id, c.position, c.evidence_grade HAVING count(pm.page_id) > 1""")
def v_load_bearing_claims(s: Store) -> DataFrame:
    """Unreviewed claims on more than one page. Both sides are counted before they join."""
    pages = s.page_manifests.groupBy(F.col("claim_id").alias("id")).agg(F.count("page_id").alias("pages"))
    claims = s.claims.where("reviewed_by is null").groupBy("id", "position", "evidence_grade").agg(F.count("*").alias("rows"))
    counted = claims.join(pages, "id").withColumn("page_count", F.col("rows") * F.col("pages")).where("page_count > 1")
    return counted.select("id", "position", "evidence_grade", "page_count")


@query("SELECT entity_table, entity_id, vocabulary, proposed_term, occurrences, last_seen_at FROM s_vocabulary_proposals WHERE status = 'pending'")
def v_entities_with_pending_vocab(s: Store) -> DataFrame:
    return s.vocabulary_proposals.where("status = 'pending'").select("entity_table", "entity_id", "vocabulary", "proposed_term", "occurrences", "last_seen_at")


def event_documents(s: Store) -> DataFrame:
    best = lambda kind: F.coalesce(f"{kind}_html_url", f"{kind}_url")
    form = lambda kind: F.when(F.col(f"{kind}_html_url").isNotNull(), "html").when(F.col(f"{kind}_url").isNotNull(), "pdf")
    rows = s.events.withColumnRenamed("id", "event_id").join(F.broadcast(s.bodies.select(F.col("id").alias("body_id"), F.col("name").alias("body_name"))), "body_id")
    media = s.media_assets.select("event_id", F.col("external_id").alias("youtube_id"), "date_verification")
    return rows.join(media, "event_id", "left").select(
        "event_id", "body_name", "event_date", "legistar_event_id", best("agenda").alias("agenda_best_url"), form("agenda").alias("agenda_format"),
        best("minutes").alias("minutes_best_url"), form("minutes").alias("minutes_format"), (best("agenda").isNotNull() | best("minutes").isNotNull()).alias("segmentable"), "youtube_id", "date_verification",
    )


_EVENT_DOCUMENTS = """
SELECT e.id AS event_id, b.name AS body_name, e.event_date, e.legistar_event_id, coalesce(e.agenda_html_url, e.agenda_url) AS agenda_best_url,
       CASE WHEN e.agenda_html_url IS NOT NULL THEN 'html' WHEN e.agenda_url IS NOT NULL THEN 'pdf' END AS agenda_format,
       coalesce(e.minutes_html_url, e.minutes_url) AS minutes_best_url,
       CASE WHEN e.minutes_html_url IS NOT NULL THEN 'html' WHEN e.minutes_url IS NOT NULL THEN 'pdf' END AS minutes_format,
       coalesce(e.agenda_html_url, e.agenda_url, e.minutes_html_url, e.minutes_url) IS NOT NULL AS segmentable, m.external_id AS youtube_id, m.date_verification
FROM s_events e JOIN s_bodies b ON b.id = e.body_id LEFT JOIN s_media_assets m ON m.event_id = e.id"""


@query(_EVENT_DOCUMENTS)
def v_event_documents(s: Store) -> DataFrame:
    """The best document of each meeting and its format; bodies are few, one per chartered body."""
    return event_documents(s)


@query(f"""
SELECT DISTINCT event_id, event_date, coalesce(minutes_best_url, agenda_best_url) AS url,
       CASE WHEN minutes_best_url IS NOT NULL THEN minutes_format WHEN agenda_best_url IS NOT NULL THEN agenda_format END AS format,
       CASE WHEN minutes_best_url IS NOT NULL THEN 'minutes' WHEN agenda_best_url IS NOT NULL THEN 'agenda' ELSE 'none' END AS basis
FROM ({_EVENT_DOCUMENTS}) WHERE body_name ILIKE '%on_1%'""")
def best_document(s: Store) -> DataFrame:
    """Minutes before agenda before nothing, for bodies whose name matches."""
    basis = F.when(F.col("minutes_best_url").isNotNull(), "minutes").when(F.col("agenda_best_url").isNotNull(), "agenda").otherwise("none")
    form = F.when(F.col("minutes_best_url").isNotNull(), F.col("minutes_format")).when(F.col("agenda_best_url").isNotNull(), F.col("agenda_format"))
    rows = event_documents(s).where(F.col("body_name").ilike("%on_1%"))
    return rows.select("event_id", "event_date", F.coalesce("minutes_best_url", "agenda_best_url").alias("url"), form.alias("format"), basis.alias("basis")).distinct()


@query("""
SELECT DISTINCT ON (m.event_id) m.event_id, e.event_date, b.name AS body_name, m.id AS media_asset_id, m.host, m.external_id, m.url, m.duration_seconds, m.host_title, m.host_upload_date, m.title_stated_date, m.date_verification, m.discovered_via, m.asr_model, m.asr_completed_at,
       count(*) OVER (PARTITION BY m.event_id) - 1 AS others
FROM s_media_assets m JOIN s_events e ON e.id = m.event_id JOIN s_bodies b ON b.id = e.body_id ORDER BY m.event_id, m.duration_seconds DESC NULLS LAST, m.id""")
def v_meeting_recordings(s: Store) -> DataFrame:
    """The longest recording of each meeting and how many others there are; both windows share one shuffle."""
    w = Window.partitionBy("event_id")
    ranked = s.media_assets.withColumn("others", F.count("*").over(w) - 1).withColumn("rank", F.row_number().over(w.orderBy(F.desc_nulls_last("duration_seconds"), "id")))
    longest = ranked.where("rank = 1").join(s.events.select(F.col("id").alias("event_id"), "event_date", "body_id"), "event_id")
    named = longest.join(F.broadcast(s.bodies.select(F.col("id").alias("body_id"), F.col("name").alias("body_name"))), "body_id")
    host = ["host", "external_id", "url", "duration_seconds", "host_title", "host_upload_date", "title_stated_date", "date_verification", "discovered_via", "asr_model", "asr_completed_at"]
    return named.select("event_id", "event_date", "body_name", F.col("id").alias("media_asset_id"), *host, "others")


@query("SELECT coalesce(direction, 'unknown') AS direction, count(*) AS refs, cast(sum(amount_low) AS bigint) AS total_low, min(amount_low) AS smallest, max(amount_low) AS largest FROM s_fiscal_references GROUP BY 1")
def v_money_by_direction(s: Store) -> DataFrame:
    """Totals by direction, never across."""
    return s.fiscal_references.groupBy(F.coalesce("direction", F.lit("unknown")).alias("direction")).agg(F.count("*").alias("refs"), F.sum("amount_low").alias("total_low"), F.min("amount_low").alias("smallest"), F.max("amount_low").alias("largest"))


@query("SELECT * FROM s_subjects WHERE merged_into_id IS NULL")
def live_subjects(s: Store) -> DataFrame:
    return s.subjects.where("merged_into_id is null")


@query("SELECT * FROM s_orgs WHERE merged_into_id IS NULL")
def live_orgs(s: Store) -> DataFrame:
    return s.orgs.where("merged_into_id is null")


@query("""
SELECT p.id AS person_id, p.full_name, p.is_public_figure, p.legistar_person_id,
  (SELECT string_agg(a.alias, '|' ORDER BY a.alias) FROM s_person_aliases a WHERE a.person_id = p.id) AS aliases,
  (SELECT count(*) FROM s_person_voiceprints v WHERE v.person_id = p.id) AS voiceprint_count,
  (SELECT max(v.sample_count) FROM s_person_voiceprints v WHERE v.person_id = p.id) AS voiceprint_samples,
  (SELECT string_agg(DISTINCT b.name, '|' ORDER BY b.name) FROM s_memberships ms JOIN s_bodies b ON b.id = ms.body_id WHERE ms.person_id = p.id) AS bodies,
  (SELECT string_agg(DISTINCT o.name, '|' ORDER BY o.name) FROM s_affiliations af JOIN s_orgs o ON o.id = af.org_id WHERE af.person_id = p.id) AS orgs,
  (SELECT count(*) FROM s_utterances u WHERE u.person_id = p.id) AS utterances,
  (SELECT count(DISTINCT u.media_asset_id) FROM s_utterances u WHERE u.person_id = p.id) AS meetings_spoken_in,
  (SELECT round(cast(sum(u.duration_ms) AS double) / 60000.0, 1) FROM s_utterances u WHERE u.person_id = p.id) AS minutes_spoken,
  (SELECT string_agg(DISTINCT u.speaker_id_method, '|' ORDER BY u.speaker_id_method) FROM s_utterances u WHERE u.person_id = p.id AND u.speaker_id_method IS NOT NULL) AS id_methods,
  (SELECT count(*) FROM s_votes v WHERE v.person_id = p.id) AS votes_cast,
  (SELECT count(*) FROM s_event_items ei WHERE ei.mover_person_id = p.id OR ei.seconder_person_id = p.id) AS motions_moved_or_seconded,
  (SELECT count(*) FROM s_claims c WHERE c.actor_id = p.id) AS claims,
  (SELECT count(*) FROM s_commitments cm WHERE cm.committed_by_person_id = p.id) AS commitments_made,
  (SELECT string_agg(DISTINCT d.doc_type, '|' ORDER BY d.doc_type) FROM s_claims c JOIN s_documents d ON d.id = c.document_id WHERE c.actor_id = p.id) AS claim_source_types
FROM s_persons p""")
def v_person_dossier(s: Store) -> DataFrame:
    """All that is known of each person: every table is aggregated by person before it joins."""
    by = lambda df, key="person_id": df.groupBy(F.col(key).alias("person_id"))
    movers = s.event_items.select("id", F.explode(F.array_distinct(F.array_compact(F.array("mover_person_id", "seconder_person_id")))).alias("person_id"))
    parts = [
        by(s.person_aliases).agg(F.array_join(F.sort_array(F.collect_list("alias")), "|").alias("aliases")),
        by(s.person_voiceprints).agg(F.count("*").alias("voiceprint_count"), F.max("sample_count").alias("voiceprint_samples")),
        by(s.memberships.join(s.bodies.select(F.col("id").alias("body_id"), "name"), "body_id")).agg(distinct_list("name").alias("bodies")),
        by(s.affiliations.join(s.orgs.select(F.col("id").alias("org_id"), "name"), "org_id")).agg(distinct_list("name").alias("orgs")),
        by(s.utterances).agg(F.count("*").alias("utterances"), F.countDistinct("media_asset_id").alias("meetings_spoken_in"), F.round(F.sum("duration_ms").cast("double") / 60000.0, 1).alias("minutes_spoken"), F.array_join(F.sort_array(F.collect_set("speaker_id_method")), "|").alias("id_methods")),
        by(s.votes).agg(F.count("*").alias("votes_cast")),
        by(movers).agg(F.count("*").alias("motions_moved_or_seconded")),
        by(s.claims, "actor_id").agg(F.count("*").alias("claims")),
        by(s.commitments, "committed_by_person_id").agg(F.count("*").alias("commitments_made")),
        by(s.claims.join(s.documents.select(F.col("id").alias("document_id"), "doc_type"), "document_id"), "actor_id").agg(distinct_list("doc_type").alias("claim_source_types")),
    ]
    out = s.persons.withColumnRenamed("id", "person_id")
    for part in parts:
        out = out.join(part, "person_id", "left")
    counts = ["voiceprint_count", "utterances", "meetings_spoken_in", "votes_cast", "motions_moved_or_seconded", "claims", "commitments_made"]
    return out.fillna(0, counts).withColumn("id_methods", F.nullif("id_methods", F.lit("")))


# ---------------------------------------------------------------- order


def shown_order(view: str) -> tuple:
    """The order in which a reader is shown a view; sorting is left to the caller, as a view that others read needs no global sort."""
    return {
        "v_argument_propagation": ("argument_id", "occurred_on",),
        "v_timeline": (F.desc("independent_attestations"), F.asc_nulls_last("occurred_start"),),
        "v_dark_matter_corpus": (F.desc("public_claims"),),
        "v_dark_matter_record": (F.asc_nulls_last("asserted_start"),),
        "v_unmet_conditions": (F.asc_nulls_last("target_date"),),
        "v_open_commitments": (F.asc_nulls_last("due_date"),),
        "v_reversed_funding": (F.desc_nulls_last("status_as_of"),),
        "v_load_bearing_claims": (F.desc("page_count"),),
        "v_entities_with_pending_vocab": (F.desc("occurrences"),),
    }[view]
