"""Quotations located in texts under folding, and names found as tight windows of their words."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.functions.text import LEAD_VERBS, STOP
from attesta.functions.text import singular as fold_plural

# Characters that are one for anchoring.
FOLD = {0x2018: "'", 0x2019: "'", 0x201C: '"', 0x201D: '"', 0x2013: "-", 0x2014: "-", 0x2212: "-", 0xA0: " ", 0xAD: None}
MAX_FILLER = 2


def folded(text: str) -> tuple[str, list[int]]:
    """The text with quotes, dashes and white space folded, and where each character came from."""
    out, places, space = [], [], True
    for k, c in enumerate(text):
        c = FOLD.get(ord(c), c)
        if c is None:
            continue
        if c.isspace():
            if space:
                continue
            c, space = " ", True
        else:
            space = False
        out.append(c.lower())
        places.append(k)
    return "".join(out), places


def anchor(text: str | None, quote: str | None) -> tuple[int, int] | None:
    """Where a quotation stands in a text: exactly, or under folding if that place is the only one."""
    if not text or not (quote or "").strip():
        return None
    at = text.find(quote)
    if at >= 0:
        return at, at + len(quote)
    body, places = folded(text)
    sought = folded(quote)[0].strip()
    at = body.find(sought)
    if not sought or at < 0 or body.find(sought, at + 1) >= 0:
        return None
    return places[at], places[at + len(sought) - 1] + 1


SPAN = T.StructType([T.StructField("span_start", T.IntegerType()), T.StructField("span_end", T.IntegerType())])


@F.pandas_udf(SPAN)
def anchored(text: pd.Series, quote: pd.Series) -> pd.DataFrame:
    found = [anchor(t, q) or (None, None) for t, q in zip(text, quote)]
    return pd.DataFrame(found, columns=["span_start", "span_end"]).astype("Int32")


def singular(word: str) -> str:
    for suffix, instead in (("ies", "y"), ("es", ""), ("s", "")):
        if len(word) > 4 and word.endswith(suffix):
            return word[: -len(suffix)] + instead
    return word


def terms(name: str) -> frozenset[str]:
    words = re.findall(r"[a-z0-9]+", name.lower())
    return frozenset(singular(w) for w in words if w not in STOP and w not in LEAD_VERBS and not w.isdigit())


def windows(text: str, wanted: frozenset[str], filler: int = MAX_FILLER) -> tuple[int, int] | None:
    """The first shortest run of words that holds every wanted term and at most ``filler`` function words."""
    words = [(singular(m[0].lower()), m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9']+", text)]
    for size in range(len(wanted), len(wanted) + filler + 1):
        for i in range(len(words) - size + 1):
            run = words[i : i + size]
            held = {w for w, _, _ in run}
            if wanted <= held and all(w in wanted or w in STOP for w in held):
                hits = [x for x in run if x[0] in wanted]
                return hits[0][1], hits[-1][2]
    return None


def window_mentions(texts: DataFrame, names: DataFrame, key: str = "claim_id", body: str = "verbatim") -> DataFrame:
    """(key, subject_id, span_start, span_end): names of two terms or more whose terms stand together in any order.

    Texts and names meet on the name's least term only, so a text is held against names it may contain.
    """
    split = lambda c, pattern: F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(pattern), F.lit(0))
    telling = F.filter(split(F.col("name"), "[a-z0-9]+"), lambda w: ~w.isin(*STOP, *LEAD_VERBS) & ~w.rlike("^[0-9]+$"))
    listed = F.array_sort(F.array_distinct(F.transform(telling, fold_plural)))
    stems = F.array_distinct(F.transform(split(F.col(body), "[a-z0-9']+"), fold_plural))

    @F.pandas_udf(SPAN)
    def found(text: pd.Series, wanted: pd.Series) -> pd.DataFrame:
        rows = [windows(t, frozenset(w)) or (None, None) for t, w in zip(text, wanted)]
        return pd.DataFrame(rows, columns=["span_start", "span_end"]).astype("Int32")

    named = names.select("subject_id", listed.alias("terms")).where(F.size("terms") >= 2).withColumn("t", F.col("terms")[0])
    asked = texts.select(key, body, F.explode(stems).alias("t"))
    met = asked.join(named, "t").withColumn("s", found(body, "terms"))
    return met.where("s.span_start is not null").select(key, "subject_id", "s.*")
