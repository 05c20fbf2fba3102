"""Curation as functions of snapshots: rulings, claim storage, guards, approvals, statuses, mentions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attesta.operators.writes import enforce


def apply_rulings(rows: DataFrame, proposals: DataFrame, rulings: DataFrame, column: str, vocabulary: str, terms: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, proposals, terms) after rulings (vocabulary, term, action, target).

    approve adds the term; map repoints rows to ``target``, which is refused for units, whose numbers it
    would silently convert; close only settles the proposal.
    """
    mine = rulings.where(F.col("vocabulary") == vocabulary).select("term", "action", "target")
    if vocabulary.endswith("_unit"):
        mine = enforce(mine, F.col("action") == "map", "units are never mapped")
    moved = rows.join(mine.where("action = 'map'").select(F.col("term").alias(column), F.col("target").alias("_to")), column, "left")
    rows_after = moved.withColumn(column, F.coalesce("_to", column)).select(*rows.columns)
    settled = proposals.join(mine, "term", "left")
    state = F.when(F.col("action") == "approve", "approved").when(F.col("action") == "map", "mapped").when(F.col("action") == "close", "closed").otherwise("pending")
    added = mine.where("action = 'approve'").select("term", F.lit(True).alias("approved"), F.lit(False).alias("deprecated"))
    return rows_after, settled.select(*proposals.columns, state.alias("state"), "target"), terms.unionByName(added).dropDuplicates(["term"])


def stored_claims(proposed: DataFrame, sections: DataFrame) -> DataFrame:
    """Claims as stored: spans made absolute, defaults filled, the period inherited where the claim states none.

    ``proposed``: section_id, span_start, span_end, verbatim, polarity, modality, asserted_start, payloads.
    ``sections``: section_id, document_id, section_start, content_hash, covers_period_start, tier.
    Sections of tier C hold no claims; blank quotations are refused by being left out.
    """
    rows = proposed.join(sections, "section_id").where((F.coalesce("tier", F.lit("B")) != "C") & (F.trim(F.coalesce("verbatim", F.lit(""))) != ""))
    inherited = F.col("asserted_start").isNull() & F.col("covers_period_start").isNotNull()
    return rows.select(
        "document_id", "section_id", (F.col("section_start") + F.col("span_start")).alias("span_start"), (F.col("section_start") + F.col("span_end")).alias("span_end"), "verbatim",
        F.coalesce("polarity", F.lit("affirmative")).alias("polarity"), F.coalesce("modality", F.lit("asserted")).alias("modality"),
        F.coalesce("asserted_start", "covers_period_start").alias("asserted_start"), F.when(inherited, "reporting_period").alias("asserted_precision"),
        F.col("content_hash").alias("pinned_hash"), F.lit("C").alias("evidence_grade"), F.lit("proposed").alias("curation_state"), "payloads",
    )


def payloads(claims: DataFrame, kind: str) -> DataFrame:
    """Payload rows of one kind (fiscal, quantity, ...) of claims, with the claim's columns of origin."""
    return claims.select("document_id", "section_id", "span_start", F.explode("payloads").alias("p")).where(F.col("p.kind") == kind).select("document_id", "section_id", "span_start", "p.*")


def extractable(sections: DataFrame, extracted: DataFrame, replace: bool = False) -> DataFrame:
    """Sections that may be read for claims, with the reason where not.

    They need a clean machine verdict or a human approval of the current text, no tier C, and no earlier
    run unless it is to be replaced.
    """
    done = extracted.select("section_id").distinct().withColumn("_done", F.lit(True))
    approved = F.col("human_verdict").isin("approved", "approved_with_caveats") & (F.col("verdict_hash") == F.col("content_hash"))
    reason = (
        F.when(F.col("tier") == "C", "tier C")
        .when(~F.coalesce((F.col("parse_confidence") == "clean") | approved, F.lit(False)), "not clean, not approved")
        .when(F.col("_done") & F.lit(not replace), "extracted before")
    )
    return sections.join(done, "section_id", "left").select("section_id", reason.alias("refused"))


def approvals(sections: DataFrame, rulings: DataFrame) -> DataFrame:
    """Human verdicts held against current texts: current, stale where the text changed since, none."""
    state = F.when(F.col("verdict").isNull(), "none").when(F.col("verdict_hash") == F.col("content_hash"), "current").otherwise("stale")
    return sections.join(rulings, "section_id", "left").select("section_id", "verdict", state.alias("state"))


def apply_award_status(rows: DataFrame, changes: DataFrame, terms: DataFrame) -> DataFrame:
    """Rows with new statuses: the term must be approved, and all but ``unknown`` quote a reason; the date is kept unless a new one is given."""
    known = terms.where("approved and not deprecated").select(F.col("term").alias("new_status"), F.lit(True).alias("_known"))
    checked = changes.join(known, "new_status", "left")
    checked = enforce(checked, F.col("_known").isNull(), "the status is not an approved term")
    checked = enforce(checked, (F.col("new_status") != "unknown") & (F.trim(F.coalesce("reason", F.lit(""))) == ""), "a status needs the sentence that says so")
    joined = rows.join(checked.select("id", "new_status", "reason", "as_of"), "id", "left")
    return joined.withColumn("award_status", F.coalesce("new_status", "award_status")).withColumn("status_change_reason", F.coalesce("reason", "status_change_reason")).withColumn("status_as_of", F.coalesce("as_of", "status_as_of")).select(*rows.columns)


def human_mentions(claims: DataFrame, ruled: DataFrame) -> DataFrame:
    """The first exact occurrence of each ruled phrase that begins and ends on word boundaries, or why there is none."""
    rows = ruled.join(claims.select(F.col("id").alias("claim_id"), "verbatim"), "claim_id", "left")
    at = F.position("phrase", "verbatim")
    n = F.char_length("phrase")
    inside = lambda c: c.rlike(r"^[\p{L}\p{N}_]$")
    cut = inside(F.when(at > 1, F.substr("verbatim", at - 1, F.lit(1))).otherwise("")) | inside(F.substr("verbatim", at + n, F.lit(1)))
    reason = F.when(F.col("verbatim").isNull(), "no such claim").when(at == 0, "not in the claim").when(cut, "ends inside a word")
    start = F.when(reason.isNull(), at - 1)
    return rows.select("claim_id", "subject_id", "phrase", start.alias("span_start"), (start + n).alias("span_end"), reason.alias("refused"))


def updated_centroid(old: Column, n: Column, new: Column) -> Column:
    """The mean of ``n`` vectors and one more, at length 1; a null mean starts from the new vector."""
    mean = F.when(old.isNull(), new).otherwise(F.zip_with(old, new, lambda a, b: (a * n + b) / (n + 1)))
    length = F.sqrt(F.aggregate(mean, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(mean, lambda x: x / length)


def set_flag(flags: Column, name: str, value: Column) -> Column:
    """A JSON object (as text) with one key set; null values take the key away."""
    kept = F.map_filter(F.coalesce(F.from_json(flags, "map<string,string>"), F.create_map().cast("map<string,string>")), lambda k, _: k != name)
    return F.to_json(F.when(value.isNull(), kept).otherwise(F.map_concat(kept, F.create_map(F.lit(name), value.cast("string")))))


#: Words of a run that a segment must share with a prompt, and the share of its words that such runs must cover. Fixed values.
LEAK_RUN, LEAK_COVERAGE = 5, 0.5


def prompt_leaks(segments: DataFrame, prompts: DataFrame, key: str = "id", prompt: str = "prompt_id") -> DataFrame:
    """(key, prompt, coverage): segments (key, text) of whose words at least LEAK_COVERAGE stand in runs of LEAK_RUN that a prompt (prompt, text) holds.

    Only runs meet prompts; what they cover is a union of places, so overlapping runs don't count twice.
    """
    words = lambda c: F.filter(F.split(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9 ]", " "), " +"), lambda w: w != "")
    runs = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - LEAK_RUN + 1), lambda k: F.struct(k.alias("at"), F.array_join(F.slice(w, k, F.lit(LEAK_RUN)), " ").alias("run")))
    split = lambda df, name: df.select(F.col(name), words(F.col("text")).alias("w")).where(F.size("w") >= LEAK_RUN)
    known = split(prompts, prompt).select(prompt, F.explode(runs(F.col("w"))).alias("r")).select(prompt, "r.run").distinct()
    said = split(segments, key).select(key, F.size("w").alias("n"), F.explode(runs(F.col("w"))).alias("r")).select(key, "n", "r.*")
    met = said.join(known, "run").select(key, prompt, "n", "at").distinct()
    before = F.lag("at").over(Window.partitionBy(key, prompt).orderBy("at"))
    covered = met.withColumn("new", F.least(F.lit(LEAK_RUN), F.coalesce(F.col("at") - before, F.lit(LEAK_RUN))))
    told = covered.groupBy(key, prompt, "n").agg((F.sum("new") / F.col("n")).alias("share"))
    return told.where(F.col("share") >= LEAK_COVERAGE).select(key, prompt, F.round("share", 2).alias("coverage"))


def enrolments(candidates: DataFrame, prints: DataFrame) -> DataFrame:
    """(media_id, cluster, person_id, action): what becomes of each confirmed cluster, nothing written yet.

    ``candidates``: media_id, cluster, decision, name, person_id, confident, is_public_figure, embedding;
    ``prints``: person_id, embedding, sample_count, media (tokens 'media:cluster'). In this order a cluster
    is refused if its person isn't certain or isn't a public figure, if it has no vector, or if its token
    stands with someone else; one whose token stands already changes nothing.
    """
    asked = candidates.where("decision = 'confirmed' and name is not null and name <> ''").withColumn("token", F.concat_ws(":", F.col("media_id").cast("string"), "cluster"))
    tokens = prints.select(F.col("person_id").alias("owner"), F.explode("media").alias("token"))
    held = asked.select("token").distinct().join(tokens, "token").groupBy("token").agg(F.collect_set("owner").alias("owners"))
    owners = F.coalesce("owners", F.array().cast("array<bigint>"))
    action = (
        F.when(F.col("person_id").isNull() | ~F.coalesce("confident", F.lit(False)), "refused: person not certain")
        .when(~F.coalesce("is_public_figure", F.lit(False)), "refused: not a public figure")
        .when(F.col("embedding").isNull() | (F.size("embedding") == 0), "refused: no vector")
        .when(F.size(F.filter(owners, lambda o: o != F.col("person_id"))) > 0, "refused: enrolled for someone else")
        .when(F.array_contains(owners, F.col("person_id")), "enrolled already")
        .otherwise("enrol")
    )
    return asked.join(held, "token", "left").select("media_id", "cluster", "person_id", "token", "embedding", action.alias("action"))


def enrolled(prints: DataFrame, decided: DataFrame) -> DataFrame:
    """``prints`` after the clusters that ``enrolments`` lets enrol: a running mean at length 1, taken up in the order of tokens; applying it again changes nothing."""
    new = decided.where("action = 'enrol'").dropDuplicates(["person_id", "token"]).groupBy("person_id").agg(F.array_sort(F.collect_list(F.struct("token", F.col("embedding").cast("array<double>").alias("v")))).alias("new"))
    both = prints.join(new, "person_id", "full")
    start = F.struct(F.col("embedding").cast("array<double>").alias("mean"), F.coalesce("sample_count", F.lit(0)).cast("int").alias("n"))
    mixed = F.aggregate(F.coalesce("new", F.array().cast("array<struct<token:string,v:array<double>>>")), start, lambda s, x: F.struct(updated_centroid(s["mean"], s["n"], x["v"]).alias("mean"), (s["n"] + 1).alias("n")))
    media = F.array_sort(F.array_union(F.coalesce("media", F.array().cast("array<string>")), F.coalesce(F.transform("new", lambda x: x["token"]), F.array().cast("array<string>"))))
    return both.withColumn("_m", mixed).select("person_id", F.col("_m.mean").alias("embedding"), F.col("_m.n").alias("sample_count"), media.alias("media"))


# Fixed values of key-term lists: words of agenda titles that name nobody, patterns of speakers and of capitalised phrases, limits of terms.
AGENDA_WORDS = (
    "agenda agreement appointments approve call city comment commentary commission communications confirmation consent council "
    "hearing introductions meeting memorandum minutes ordinance presentation proclamation public report resolution roll update"
).split()
AGENDA_SPEAKER = r"^([A-Z][A-Za-z'\-]+(?:\s+[A-Z][A-Za-z'\-.]+){1,3})\s+-\s+\S"
PROPER_NOUN = r"\b([A-Z][A-Za-z]{3,}(?:\s+(?:of|the|and)?\s*[A-Z][A-Za-z]{3,}){1,3})\b"
NOUN_CHARS, NOUNS, TERM_LEAST, TERM_MOST, TERM_WORDS, TERMS, FORBIDDEN = 44, 25, 3, 50, 5, 100, r"[<>{}\[\]\\]"


def _names_nobody(phrase: Column) -> Column:
    return F.arrays_overlap(F.split(F.lower(phrase), r"\s+"), F.array(*map(F.lit, AGENDA_WORDS)))


def agenda_terms(titles: DataFrame, key: str) -> DataFrame:
    """(key, source, rank, term) from agenda titles (key, seq, title): registered speakers in order, then the most frequent capitalised phrases, ties by phrase."""
    flat = titles.select(key, "seq", F.trim(F.regexp_replace(F.coalesce("title", F.lit("")), r"[\r\n]+", " ")).alias("t"))
    people = flat.withColumn("term", F.regexp_extract("t", AGENDA_SPEAKER, 1)).where((F.col("term") != "") & ~_names_nobody(F.col("term")))
    people = people.select(key, F.lit("agenda_speakers").alias("source"), F.col("seq").cast("long").alias("rank"), "term")
    phrases = flat.select(key, F.explode(F.regexp_extract_all("t", F.lit(PROPER_NOUN), F.lit(1))).alias("term")).where((F.char_length("term") <= NOUN_CHARS) & ~_names_nobody(F.col("term")))
    counted = phrases.groupBy(key, "term").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "term")).cast("long")
    return people.unionByName(counted.select(key, F.lit("agenda_proper_nouns").alias("source"), rank.alias("rank"), "term").where(F.col("rank") <= NOUNS))


def key_terms(sources: DataFrame, key: str, order: list[str]) -> DataFrame:
    """(key, place, source, term): terms (key, source, rank, term) in the order of their sources, the first of each spelling, at most TERMS a key.

    Terms of under TERM_LEAST letters, of TERM_MOST or more, of over TERM_WORDS words or with a forbidden
    character are left out.
    """
    first = F.create_map(*[F.lit(x) for k, name in enumerate(order) for x in (name, k)])
    trimmed = sources.withColumn("term", F.trim(F.coalesce("term", F.lit(""))))
    n = F.char_length("term")
    fit = trimmed.where((n >= TERM_LEAST) & (n < TERM_MOST) & (F.size(F.split("term", r"\s+")) <= TERM_WORDS) & ~F.col("term").rlike(FORBIDDEN))
    placed = fit.withColumn("_o", F.element_at(first, F.col("source")))
    single = placed.groupBy(key, F.lower("term").alias("_s")).agg(F.min(F.struct("_o", "rank", "term", "source")).alias("x")).select(key, "x.*")
    place = F.row_number().over(Window.partitionBy(key).orderBy("_o", "rank", "term"))
    return single.withColumn("place", place).where(F.col("place") <= TERMS).select(key, "place", "source", "term")
