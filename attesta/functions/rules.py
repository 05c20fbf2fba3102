"""Ordered rule classifiers: a table of patterns, the first that matches decides.

``first_match`` compiles a table into one CASE over ``rlike``; nothing leaves the JVM and a rule
added to a table is a rule added to the plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values

#: Which way money moved, by the words of the claim; the order ranks the evidence. Fixed values.
FISCAL_DIRECTION = (
    ("saved", r"(?i)\b(sav(?:ed|ing|ings)|cost[- ]avoidance|avoided cost)\b"),
    ("received", r"(?i)\b(?:was|were|been)\s+(awarded|granted|given|allocated)\b"),
    ("received", r"(?i)\b(won|secur(?:ed|e|ing)|receiv(?:ed|ing)|obtained)\b"),
    ("received", r"(?i)\$[\d,.]+\s*(?:million|billion)?\s+from\b"),
    ("disbursed", r"(?i)\b(granted|provided|distributed|disbursed|awarded)\b.{0,40}\b(to|through|for)\b"),
    ("disbursed", r"(?i)\bin grants to\b"),
    ("authorized", r"(?i)\b(authorized|authorised|appropriated|committed)\b"),
    ("spent", r"(?i)\b(spent|invested|paid out)\b"),
)
#: Verbs of an award's status, and words that say it changed. Fixed values.
AWARD_STATUS = (
    ("awarded", r"(?i)\b(won|awarded|secured|received|granted)\b"),
    ("applied", r"(?i)\b(applied|submitted|seeking|requested|pursuing)\b"),
)
REVERSAL = r"(?i)(terminat|rescind|clawed back|on hold|actively disput|withdraw|revok|laps)"
#: Characters within which a reversal is offered to a claim.
NEAR = 900
#: Money received, and sources that name nobody. Fixed values.
RECEIVED = r"(?i)\b(won|secured|received|obtained|was awarded|were awarded|successful in securing)\b"
EMPTY_SOURCES = ("", "other", "unspecified", "unknown", "n/a", "not specified")
#: Kinds of meeting, by words of body and comment. Fixed values.
MEETING_KIND = (("work_session", "work session"), ("planning_session", "planning session"), ("special", "special"), ("cancelled", "cancel"))
#: Units by spelling, in lower case. Fixed values.
UNITS = {
    "count": "count",
    "percent": "percent",
    "%": "percent",
    "percentage": "percent",
    "mw": "MW",
    "megawatts": "MW",
    "megawatt": "MW",
    "kw": "kW",
    "kilowatts": "kW",
    "mwh": "MWh",
    "kwh": "kWh",
    "metric_tons_co2e": "metric_tons_co2e",
    "metric_tons": "metric_tons",
    "usd": "USD",
    "dollars": "USD",
    "$": "USD",
    "miles": "miles",
    "mile": "miles",
    "square_feet": "square_feet",
    "square feet": "square_feet",
    "sq ft": "square_feet",
    "square foot": "square_feet",
    "acres": "acres",
    "acre": "acres",
    "years": "years",
    "year": "years",
    "annual": "years",
    "times per year": "years",
    "months": "months",
    "month": "months",
    "weeks": "weeks",
    "week": "weeks",
    "days": "days",
    "day": "days",
    "hours": "hours",
    "hour": "hours",
    "ratio": "ratio",
    "other": "other",
}
CO2E = r"(?i)\b(?:m(?:etrics?)?\s*t(?:ons?)?|mt)[\s-]*(?:of\s+)?(?:co\s*2\s*-?\s*e?\b|carbon\s+dioxide(?:\s+equivalents?)?\b)"
TONS = r"^(metric\s+)?tons?\b(?:\s+of\s+(.+))?$"
#: Topics and whether letter case counts. Fixed values.
TOPICS = (
    ("Bryant", r"\bbryant\b", False),
    ("geothermal", r"\bgeo-?thermal\b", False),
    ("SEU", r"\bSEU\b|[Ss]ustainable [Ee]nergy [Uu]tility", True),
    ("DTE", r"\bDTE\b", True),
    ("weatherization", r"\bweatheriz", False),
    ("Community Action Network", r"[Cc]ommunity [Aa]ction [Nn]etwork", True),
    ("electrification", r"\belectrif", False),
    ("heat pump", r"heat ?pumps?\b", False),
    ("decarbonization", r"\bdecarboni", False),
    ("A2Zero", r"\bA2\s?[Zz]ero\b|\bA2Z\b", True),
    ("franchise", r"\bfranchise", False),
    ("neighborhood scale", r"neighbou?rhood[- ]scale", False),
)
#: Flags that demote a section, and the flag that answers one. Fixed values.
DEMOTING = ("placement_inferred", "has_ocr_blocks", "ocr_conflicts")
ANSWERED_BY = {"has_ocr_blocks": "ocr_corroborated"}
#: Section tiers: characters below which prose without items is a label; numbers that make it dense.
TIER_C_CHARS, TIER_A_NUMBERS = 600, 15
MONEY, NUMBER = r"\$[\d,]+", r"\b\d[\d,.]*%?"


# ---------------------------------------------------------------- compilers


def first_match(text: Column, rules: tuple[tuple[str, str], ...], otherwise: str | None = None) -> Column:
    """The name of the first rule whose pattern occurs; ``otherwise`` where none does or the text is null."""
    cases = reduce(lambda c, r: c.when(text.rlike(r[1]), r[0]), rules[1:], F.when(text.rlike(rules[0][1]), rules[0][0]))
    return cases.otherwise(F.lit(otherwise).cast("string"))


def fiscal_direction(verbatim: Column) -> Column:
    return first_match(F.trim(F.coalesce(verbatim, F.lit(""))), FISCAL_DIRECTION, "unknown")


def stated_amount(amount: Column, verbatim: Column) -> Column:
    """The amount, but null for a zero that the text does not state."""
    return F.when((amount != 0) | F.coalesce(verbatim, F.lit("")).rlike(r"[$]\s*0(?![.,]?\d*[1-9])"), amount)


def award_verb(verbatim: Column) -> Column:
    return first_match(verbatim, AWARD_STATUS)


def is_received(verbatim: Column) -> Column:
    return F.coalesce(verbatim, F.lit("")).rlike(RECEIVED)


def names_a_source(source: Column, funder: Column) -> Column:
    """Whether a funder is named, or the kind of source is more than a placeholder."""
    named = F.trim(F.coalesce(funder, F.lit(""))) != ""
    return named | ~F.lower(F.trim(F.coalesce(source, F.lit("")))).isin(*EMPTY_SOURCES)


def meeting_kind(body: Column, comment: Column) -> Column:
    text = F.lower(F.concat_ws(" ", F.coalesce(body, F.lit("")), F.coalesce(comment, F.lit(""))))
    cases = reduce(lambda c, r: c.when(text.contains(r[1]), r[0]), MEETING_KIND[1:], F.when(text.contains(MEETING_KIND[0][1]), MEETING_KIND[0][0]))
    return cases.otherwise("regular")


def split_unit(raw: Column) -> Column:
    """struct(dimension, basis): a known unit, carbon mass, mass, or a count of what the words name."""
    text = F.trim(F.coalesce(raw, F.lit("")))
    key = F.btrim(F.lower(text), F.lit(". "))
    table = F.create_map(*[F.lit(x) for pair in UNITS.items() for x in pair])
    known = F.try_element_at(table, key)
    tons = key.rlike(TONS)
    dimension = F.when(text == "", "other").when(known.isNotNull(), known).when(text.rlike(CO2E), "metric_tons_co2e").when(tons, "metric_tons").otherwise("count")
    of = F.nullif(F.regexp_extract(key, TONS, 2), F.lit(""))
    basis = F.when((text == "") | known.isNotNull() | text.rlike(CO2E), F.lit(None).cast("string")).when(tons, of).otherwise(text)
    return F.struct(dimension.alias("dimension"), basis.alias("basis"))


def topic_counts(text: Column) -> Column:
    """Mentions of each topic, in the order of TOPICS; one alternation goes first, so that texts without any skip the rest."""
    each = lambda pattern, cased: pattern if cased else f"(?i:{pattern})"
    counts = F.array(*[F.regexp_count(text, F.lit(each(p, c))).cast("long") for _, p, c in TOPICS])
    return F.when(text.rlike("|".join(each(p, c) for _, p, c in TOPICS)), counts).otherwise(F.array_repeat(F.lit(0).cast("long"), len(TOPICS)))


def section_tier(text: Column, has_items: Column) -> Column:
    """C: a label; A: money or many numbers; B: other prose."""
    short = ~has_items & (F.char_length(text) < TIER_C_CHARS)
    dense = text.rlike(MONEY) | (F.regexp_count(text, F.lit(NUMBER)) >= TIER_A_NUMBERS)
    return F.when(short, "C").when(dense, "A").otherwise("B")


def machine_verdict(body: Column, stored_hash: Column, flags: Column | None = None) -> Column:
    """clean, unless the text changed, is garbled (two case flips inside a word), bears a demoting flag that nothing answers, or is empty."""
    garbled = F.exists(F.split(body, r"\s+"), lambda w: F.regexp_count(w, F.lit("[a-z][A-Z]")) >= 2)
    demoted = F.lit(False)
    if flags is not None:
        held = lambda name: F.coalesce(F.array_contains(flags, name), F.lit(False))
        for flag in DEMOTING:
            demoted = demoted | (held(flag) & ~(held(ANSWERED_BY[flag]) if flag in ANSWERED_BY else F.lit(False)))
    return F.when(F.sha2(body, 256) != stored_hash, "suspect").when(garbled, "suspect").when(demoted, "suspect").when(F.trim(body) == "", "suspect").otherwise("clean")


def upload_verdict(stated: Column, meeting: Column, upload: Column, before: int = 1, after: int = 21) -> Column:
    """A recording checked against its meeting: the title's date first, then a window for the upload."""
    plausible = upload.between(F.date_sub(meeting, before), F.date_add(meeting, after))
    return F.when(stated == meeting, "matched").when(stated.isNotNull(), "title_mismatch").when(plausible, "no_title_date").when(upload.isNotNull(), "upload_implausible").otherwise("unverified")


def backfill_verdict(stated: Column, meeting: Column, upload: Column) -> Column:
    """The other rule set on the same column: an upload before the meeting contradicts a matching title."""
    return F.when(stated.isNull(), "no_title_date").when(stated != meeting, "title_mismatch").when(upload < meeting, "upload_implausible").otherwise("matched")


def attribution_risk(words: Column, seconds: Column, purity: Column, clusters: Column, orphan: Column) -> Column:
    high = orphan | (words <= 4) | (seconds <= 1.5)
    medium = (words <= 10) | F.coalesce(purity < 0.8, F.lit(False)) | (clusters > 1)
    return F.when(high, "high").when(medium, "medium").otherwise("low")
