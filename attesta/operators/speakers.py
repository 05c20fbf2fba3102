"""Speakers of transcript clusters from what is said: a person's ruling, self-identification, roll call, address by the chair.

Relational: calls meet the next turns by ``lead``, the strongest method wins by a rank. Names are compared
with the roster by letters, as recognition corrupts the middle of names; that alone runs in pandas, on the
few fragments that were named.
"""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from attesta.operators.speech import closest

# What a self-identification, a call, a hand-off and an answer look like, the rank of methods and what a spoken title allows.
TITLES = "Commissioner|Chair|Vice Chair|Council ?Member|Councilmember|Mayor|Director"
CALL = rf"\b({TITLES})\s+([A-Z][A-Za-z'\-]+)\s*\?"
HANDOFF = rf"\b({TITLES})\s+([A-Z][A-Za-z'\-]+)\s*[.,]?\s*$"
SELF = r"\b(?:I'?m|I am|my name is|this is)\s+([A-Z][a-z'\-]+(?:\s+[A-Z][a-z'\-]+){1,2})\b"
ANSWER = r"(?i)\b(here|present|hello|hi|yes)\b"
RANK = {"human": 0, "self_id": 1, "roll_call": 2, "chair_address": 3}
TITLE_ROLES = {
    "chair": ("chair",),
    "vice chair": ("vice chair",),
    "council member": ("councilmember",),
    "councilmember": ("councilmember",),
    "commissioner": ("member", "youth member", "chair", "vice chair"),
}
#: Least length of a name; seconds of an answer's delay and of a hand-off's speech; characters of a short answer.
LETTERS = 4
DELAY_S, SPEECH_S, SHORT = 6.0, 8.0, 60


def roster_hit(fragment: str | None, names: list[str], roles: list[str | None], title: str | None = None) -> str | None:
    """The roster entry whose word is closest to the fragment, the first among equals, of those that the title allows; None if none is close."""
    only = lambda w: re.sub("[^a-z]", "", w.lower())
    said = only(fragment or "")
    allowed = TITLE_ROLES.get(" ".join((title or "").lower().split())) if any(roles) else None
    meant = [name for name, role in zip(names, roles) if not allowed or (role or "").lower() in allowed]
    long = lambda words: [w for w in words if len(w) >= LETTERS]
    place, _ = closest(long([said]), [long(map(only, name.split())) for name in meant], math.inf)
    return None if place is None else meant[place]


@F.pandas_udf(T.StringType())
def match_person(fragment: pd.Series, names: pd.Series, roles: pd.Series, title: pd.Series) -> pd.Series:
    return pd.Series([roster_hit(f, list(n) if n is not None else [], list(r) if r is not None else [], t) for f, n, r, t in zip(fragment, names, roles, title)], dtype=object)


def resolve_speakers(turns: DataFrame, roster: DataFrame, human: DataFrame | None = None, key: str = "media_id") -> DataFrame:
    """(key, speaker, name, method, confidence) for every cluster of ``turns`` (key, seq, speaker, start_s, end_s, text); null for clusters that nothing names.

    ``roster`` (key, name, role) lists who may be meant, ``human`` (key, speaker, name) what a listener ruled.
    The strongest method wins, then the earlier turn. A self-identification that the roster doesn't know is
    kept if it has two words; a call that it doesn't know is not.
    """
    order = Window.partitionBy(key).orderBy("seq")
    ahead = lambda k: F.lead(F.struct("speaker", "start_s", "end_s", F.regexp_replace("text", r"^\s+|\s+$", "").alias("said")), k).over(order)
    listed = roster.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("name", "role"))).alias("_r")).select(key, F.col("_r.name").alias("names"), F.col("_r.role").alias("roles"))
    near = turns.withColumn("one", ahead(1)).withColumn("two", ahead(2)).join(listed, key, "left")

    said = near.select(key, "seq", "speaker", "names", "roles", F.posexplode(F.regexp_extract_all("text", F.lit(SELF), F.lit(1))).alias("k", "stated"))
    none = F.lit(None).cast("string")
    hit = F.coalesce(match_person(F.element_at(F.split("stated", r"\s+"), -1), "names", "roles", none), match_person("stated", "names", "roles", none))
    own = said.withColumn("hit", hit).select(key, "speaker", F.coalesce("hit", "stated").alias("name"), F.lit("self_id").alias("method"), F.when(F.col("hit").isNotNull(), 0.95).otherwise(0.9).alias("confidence"), "seq", "k")

    calls = F.regexp_extract_all("text", F.lit(CALL), F.lit(0))
    last = F.element_at(calls, -1)
    handed = F.regexp_replace("text", r"\s+$", "")
    named = near.select(
        "*",
        (F.size(calls) > 0).alias("called"),
        F.when(F.size(calls) > 0, F.regexp_extract(last, CALL, 1)).otherwise(F.regexp_extract(handed, HANDOFF, 1)).alias("title"),
        F.when(F.size(calls) > 0, F.regexp_extract(last, CALL, 2)).otherwise(F.regexp_extract(handed, HANDOFF, 2)).alias("fragment"),
    ).where("title <> ''")
    met = named.withColumn("hit", match_person("fragment", "names", "roles", "title")).where("hit is not null")
    # only the last name called is answered by the next speaker, who may come after one more turn of the caller
    other = F.when(F.col("one.speaker") != F.col("speaker"), F.col("one")).when(F.col("called") & (F.col("two.speaker") != F.col("speaker")), F.col("two"))
    answered = met.withColumn("next", other).where("next is not null")
    short = F.char_length("next.said") < SHORT
    in_time = F.col("next.start_s") - F.col("end_s") <= DELAY_S
    method = (
        F.when(F.col("called") & in_time & short & F.col("next.said").rlike(ANSWER), "roll_call")
        .when(F.col("called") & in_time & short, "chair_address")
        .when(~F.col("called") & (F.col("next.end_s") - F.col("next.start_s") > SPEECH_S), "chair_address")
    )
    confidence = F.when(F.col("method") == "roll_call", 0.85).when(F.col("called"), 0.6).otherwise(0.7)
    addressed = answered.withColumn("method", method).where("method is not null").select(key, F.col("next.speaker").alias("speaker"), F.col("hit").alias("name"), "method", confidence.alias("confidence"), "seq", F.lit(0).alias("k"))

    offers = own.unionByName(addressed)
    if human is not None:
        offers = offers.unionByName(human.select(key, "speaker", "name", F.lit("human").alias("method"), F.lit(1.0).alias("confidence"), F.lit(-1).cast(turns.schema["seq"].dataType).alias("seq"), F.lit(0).alias("k")))
    rank = F.create_map(*[F.lit(x) for pair in RANK.items() for x in pair])
    best = offers.groupBy(key, "speaker").agg(F.min_by(F.struct("name", "method", "confidence"), F.struct(F.element_at(rank, F.col("method")), "seq", "k", "name")).alias("b"))
    return turns.select(key, "speaker").distinct().join(best, [key, "speaker"], "left").select(key, "speaker", "b.*")
