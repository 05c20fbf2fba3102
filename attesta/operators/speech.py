"""Sequence matching on transcripts: label transfer, roster matching, dissent between systems, chunk seams.

Each runs per recording or per row in pandas, as the matching is sequential; recordings are the unit of
distribution.
"""

from __future__ import annotations

import re
from difflib import SequenceMatcher
from os.path import commonprefix

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: A name matches a roster entry from this ratio, or from a shared beginning of this many letters.
RATIO, PREFIX = 0.68, 4
#: Sounds that no system is judged by. Fixed values.
FILLER = ("uh", "um", "mm", "hmm", "mhm", "ah", "er")
#: Examples of a clip that may give candidates, their least length and ratio, and candidates of a clip. Fixed values.
EXAMPLES, LEAST_LETTERS, VARIANT_RATIO, CANDIDATES = 60, 4, 0.5, 40
#: How far before the last kept end a chunk's word may start, in milliseconds.
SEAM_MS = 10


def plain(text: str | None) -> list[str]:
    return re.findall(r"[a-z0-9']+", (text or "").lower())


def transferred(words: list[str], turns: list[tuple[str, str]]) -> list[str | None]:
    """The speaker of each word by aligning words with labelled turns; a gap is filled where both sides agree."""
    owner = np.repeat(np.arange(len(words)), [len(plain(w)) for w in words])
    said = [token for w in words for token in plain(w)]
    names = list(dict.fromkeys(name for name, _ in turns))
    theirs = [(token, names.index(name)) for name, text in turns for token in plain(text)]
    label = np.full(len(words), -1)
    for here, there, n in SequenceMatcher(None, said, [token for token, _ in theirs], autojunk=False).get_matching_blocks():
        label[owner[here : here + n]] = [k for _, k in theirs[there : there + n]]
    at = np.arange(len(words))
    # the nearest labelled word on either side; its place is beyond the ends where there is none
    before = np.maximum.accumulate(np.where(label >= 0, at, -1)) if len(at) else at
    after = np.minimum.accumulate(np.where(label >= 0, at, len(at))[::-1])[::-1] if len(at) else at
    padded = np.append(label, -1)
    filled = np.where(padded[before] == padded[after], padded[before], label)
    return [names[k] if k >= 0 else None for k in np.where(label >= 0, label, filled).tolist()]


def transfer_labels(words: DataFrame, turns: DataFrame, key: str = "media_id") -> DataFrame:
    """(key, id, label): words (key, id, start_ms, text) labelled from turns (key, seq, speaker, text)."""
    kind = dict(words.dtypes)[key]

    def run(w: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        w, t = w.sort_values(["start_ms", "id"]), t.sort_values("seq")
        labels = transferred(w["text"].tolist(), list(zip(t["speaker"], t["text"])))
        return pd.DataFrame({key: w[key], "id": w["id"], "label": labels})

    return words.select(key, "id", "start_ms", "text").groupBy(key).cogroup(turns.select(key, "seq", "speaker", "text").groupBy(key)).applyInPandas(run, f"{key} {kind}, id long, label string")


def closeness(a: str, b: str) -> float:
    """How close a heard word is to a written one: their ratio, or more for a long beginning in common; 0 for words that have neither."""
    shared = len(commonprefix([a, b]))
    ratio_ = SequenceMatcher(None, a, b).ratio()
    by_start = 0.6 + 0.1 * shared if shared >= PREFIX else 0.0
    return max(ratio_, by_start) if ratio_ >= RATIO or by_start else 0.0


def closest(said: list[str], entries: list[list[str]], most: float = 1.0) -> tuple[int | None, float]:
    """The place of the entry (its words) with the word closest to one that was said, the first among equals, and how close; scores end at ``most``."""
    scores = [min(most, max((closeness(b, a) for a in said for b in words), default=0.0)) for words in entries]
    top = max(scores, default=0.0)
    return (scores.index(top), top) if top > 0 else (None, 0.0)


def roster_match(name: str | None, roster: list[str]) -> tuple[str | None, float]:
    """The best roster entry by the closest pair of words; none below the ratio."""
    place, score = closest([w for w in plain(name) if len(w) > 1], [plain(entry) for entry in roster])
    return (None if place is None else roster[place]), score


@F.pandas_udf(T.StructType([T.StructField("entry", T.StringType()), T.StructField("score", T.DoubleType())]))
def match_roster(name: pd.Series, roster: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([roster_match(n, list(r) if r is not None else []) for n, r in zip(name, roster)], columns=["entry", "score"])


def _heard(pivot: list[str], other: list[str]) -> list[str | None]:
    """What the other system has at each word of the pivot: "" where it leaves the word out, None where no word answers to it."""
    out: list[str | None] = [None] * len(pivot)
    for kind, a, b, c, d in SequenceMatcher(None, pivot, other, autojunk=False).get_opcodes():
        answers = [""] * (b - a) if kind == "delete" else other[c:d][: b - a]
        out[a : a + len(answers)] = answers
    return out


def dissent(readings: dict[str, str]) -> list[tuple[int, str, str, str]]:
    """(position, system, read, agreed) where one of three or more systems differs and all others agree.

    The reading of middle length is the pivot, of equally long ones that of the later name where they meet
    the middle. Unequal replacements are compared as far as both go; a word left out reads as "".
    """
    if len(readings) < 3:
        return []
    tokens = {system: [w for w in plain(readings[system]) if w not in FILLER] for system in sorted(readings)}
    pivot = sorted(tokens, key=lambda system: len(tokens[system]))[len(tokens) // 2]
    aligned: dict[tuple[str, ...], list[str | None]] = {tuple(tokens[pivot]): tokens[pivot]}
    heard = []
    for words in tokens.values():
        if tuple(words) not in aligned:
            aligned[tuple(words)] = _heard(tokens[pivot], words)
        heard.append(aligned[tuple(words)])
    if len(aligned) == 1:
        return []
    systems, out = list(tokens), []
    for place, row in enumerate(zip(*heard)):
        if row.count(row[0]) == len(row) or None in row:
            continue
        common = max(set(row), key=row.count)
        if row.count(common) == len(row) - 1:
            odd = next(k for k, said in enumerate(row) if said != common)
            out.append((place, systems[odd], row[odd], common))
    return out


_DISSENT = T.StructType([T.StructField("position", T.IntegerType()), *[T.StructField(c, T.StringType()) for c in ("system", "reading", "agreed")]])


@F.pandas_udf(T.ArrayType(_DISSENT))
def _dissent(readings: pd.Series) -> pd.Series:
    return pd.Series([[dict(zip(_DISSENT.names, d)) for d in dissent({r["system"]: r["text"] for r in rows})] for rows in readings], dtype=object)


def dissents(readings: DataFrame, key: str = "clip") -> DataFrame:
    """(key, position, system, reading, agreed) over readings (key, system, text), many clips to a batch."""
    clips = readings.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("system", "text"))).alias("_readings"))
    return clips.select(key, F.explode(_dissent("_readings")).alias("_d")).select(key, "_d.*")


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of letters in common blocks, twice their number by both lengths."""
    told = {(x, y): SequenceMatcher(None, x, y).ratio() if x is not None and y is not None else None for x, y in set(zip(a, b))}
    return pd.Series([told[pair] for pair in zip(a, b)], dtype=float)


def vocabulary_candidates(found: DataFrame, key: str = "clip") -> DataFrame:
    """(key, spelling, variants, systems, times, rank): words that a clip's systems spell in several ways, from its ``dissents``.

    Of a clip's dissents the first EXAMPLES by position are looked at; an agreed word of LEAST_LETTERS letters or more, letters only, is a
    candidate if what the odd system read is over VARIANT_RATIO like it. ``variants`` counts the readings; candidates rank by times, then
    by first position, up to CANDIDATES. A reading is scored once in a batch, however often it came, so clips' dissents are found once.
    """
    place = F.row_number().over(Window.partitionBy(key).orderBy("position", "system"))
    looked = found.withColumn("_n", place).where(f"_n <= {EXAMPLES} and reading <> ''").where(F.col("agreed").rlike(f"^[a-z]{{{LEAST_LETTERS},}}$"))
    counted = looked.groupBy(key, "agreed", "reading").agg(F.count("*").alias("n"), F.min("position").alias("first"))
    alike = counted.withColumn("_ratio", ratio("agreed", "reading")).where(f"_ratio > {VARIANT_RATIO}")
    told = alike.groupBy(key, F.col("agreed").alias("spelling")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reading", "n")))).alias("variants"), F.count("*").alias("systems"), F.sum("n").alias("times"), F.min("first").alias("_first"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("times"), "_first", "spelling"))
    return told.withColumn("rank", rank).where(f"rank <= {CANDIDATES}").drop("_first")


def drop_seams(words: DataFrame, key: str = "media_id", seam_ms: int = SEAM_MS) -> DataFrame:
    """Words without those that a later chunk repeats: a word that starts before the last kept word's end goes."""
    fields = words.schema

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["chunk", "start_ms", "id"])
        keep, last = [], -(10**18)
        for start, end in zip(pdf["start_ms"], pdf["end_ms"]):
            keep.append(start >= last - seam_ms)
            if keep[-1]:
                last = max(last, end)
        return pdf[keep]

    return words.groupBy(key).applyInPandas(run, fields)
