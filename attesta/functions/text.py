"""Scalar text and date functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words without identity, verbs that lead a name, suffixes by length, month names.
STOP = "the a an of and or in to with our for toward towards more at on by from into new all we us its their this that as is are be".split()
LEAD_VERBS = (
    "implement develop launch promote expand support increase establish enhance preserve conduct assist transition electrify invest move require foster update "
    "benchmark power reduce offset advance create change improve build deploy adopt encourage incentivize expedite allow set pair subsidize"
).split()
SUFFIXES = "ization ification ation ing ment ize ify ies es s al ic".split()
MONTHS = "january february march april may june july august september october november december".split()
MIN_ROOT = 4


def slugify(text: Column) -> Column:
    """Lower case, ampersands spelled out, other characters as single hyphens."""
    spelled = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("&"), F.lit(" and ")))
    return F.btrim(F.regexp_replace(spelled, "[^a-z0-9]+", "-"), F.lit("-"))


def key_terms(text: Column) -> Column:
    """Distinct words of identity: no stop words, lead verbs or numbers."""
    dull = F.array(*[F.lit(w) for w in [*STOP, *LEAD_VERBS, ""]])
    return F.filter(F.array_except(F.split(slugify(text), "-"), dull), lambda w: ~w.rlike("^[0-9]+$"))


def root(word: Column) -> Column:
    """A rough root: the first of the suffixes, longest first, that leaves MIN_ROOT letters."""
    w = F.lower(word)
    out = w
    for suffix in reversed(SUFFIXES):
        out = F.when(w.endswith(suffix) & (F.char_length(w) - len(suffix) >= MIN_ROOT), F.left(w, F.char_length(w) - len(suffix))).otherwise(out)
    return out


def identity(name: Column, drop: list[str] | None = None) -> Column:
    """Sorted distinct roots of the words that carry identity."""
    words = F.filter(F.split(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9]+"), lambda w: (F.char_length(w) > 2) & ~w.isin(*STOP))
    roots = F.array_distinct(F.transform(words, root))
    return F.sort_array(F.array_except(roots, F.array(*[F.lit(w) for w in drop])) if drop else roots)


def singular(word: Column) -> Column:
    """The crudest fold of plurals: -ies, -es, -s of words over four letters."""
    w = F.lower(word)
    n = F.char_length(w)
    return F.when((n > 4) & w.endswith("ies"), F.concat(F.left(w, n - 3), F.lit("y"))).when((n > 4) & w.endswith("es"), F.left(w, n - 2)).when((n > 4) & w.endswith("s"), F.left(w, n - 1)).otherwise(w)


def core_phrase(name: Column) -> Column:
    """A name without its leading verbs and function words."""
    words = F.regexp_extract_all(F.coalesce(name, F.lit("")), F.lit("([A-Za-z0-9']+)"))
    state = F.struct(F.lit(True).alias("lead"), F.array().cast("array<string>").alias("kept"))
    lead = lambda a, w: a["lead"] & F.lower(w).isin(*STOP, *LEAD_VERBS)
    kept = F.aggregate(words, state, lambda a, w: F.struct(lead(a, w).alias("lead"), F.when(lead(a, w), a["kept"]).otherwise(F.concat(a["kept"], F.array(w))).alias("kept")))
    return F.array_join(kept["kept"], " ")


def title_date(title: Column) -> Column:
    """The date a title states: m/d/y, m-d-y or a month's name; years of two digits are 20xx; impossible dates are null."""
    t = F.coalesce(title, F.lit(""))
    short = r"\b(\d{1,2})%s(\d{1,2})%s(\d{2,4})\b"

    def numeric(sep: str) -> Column:
        part = lambda k: F.regexp_extract(t, short % (sep, sep), k)
        year = F.when(F.char_length(part(3)) == 2, F.concat(F.lit("20"), part(3))).otherwise(F.lpad(part(3), 4, "0"))
        return F.to_date(F.try_to_timestamp(F.concat_ws("-", year, F.lpad(part(1), 2, "0"), F.lpad(part(2), 2, "0")), F.lit("yyyy-MM-dd")))

    wordy = rf"(?i)\b({'|'.join(MONTHS)})\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})\b"
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.regexp_extract(t, wordy, 1)))
    named = F.to_date(F.try_to_timestamp(F.concat_ws("-", F.regexp_extract(t, wordy, 3), F.lpad(month.cast("string"), 2, "0"), F.lpad(F.regexp_extract(t, wordy, 2), 2, "0")), F.lit("yyyy-MM-dd")))
    return F.when(t.rlike(short % ("/", "/")), numeric("/")).when(t.rlike(short % ("-", "-")), numeric("-")).when(t.rlike(wordy), named)


def clock(text: Column) -> Column:
    """'HH:mm' of a 12-hour or 24-hour time, or null."""
    t = F.trim(text)
    return F.coalesce(F.date_format(F.try_to_timestamp(t, F.lit("h:mm a")), "HH:mm"), F.date_format(F.try_to_timestamp(t, F.lit("H:mm")), "HH:mm"))


def hms(seconds: Column) -> Column:
    s = F.floor(seconds)
    return F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)


def utterance_key(media: Column, sequence: Column, start_ms: Column, end_ms: Column) -> Column:
    return F.format_string("%s:%05d:%d-%d", media.cast("string"), sequence, start_ms, end_ms)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays of the same length; null where one is all zero."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))
