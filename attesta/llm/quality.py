"""Quality rules: a table of thresholds compiled into one Spark projection.

All figures are built-in column expressions over a document's words and lines; nothing leaves the JVM
and no row moves. Windows of three words are compared by two independent hashes (96 bits); windows
whose 64-bit hashes are all different need no more than a set of numbers.

Defined cases: a null text has no words and all figures are 0 (it fails the base rule); ratios of
documents without words or lines are 0; rows are never merged; an empty table gives an empty result;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Word separators: space, tab, newline, vertical tab, form feed, carriage return. Fixed values.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 3
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Frequent words of English, German, French and Spanish; fixed values.
STOP_WORDS = (
    "the and of to in that is was for it with as be on at by this are from "
    "der die das und in zu den ein eine ist mit auf im sich nicht von "
    "le la les de des et un une du est que qui dans pour sur "
    "el los las del y en por se con para una"
)


@dataclass(frozen=True)
class Rule:
    """A figure and the range in which a document is kept."""

    figure: str
    least: float | None = None
    most: float | None = None

    def holds(self, figures: dict[str, Column]) -> Column:
        value, checks = figures[self.figure], []
        if self.least is not None:
            checks.append(value >= self.least)
        if self.most is not None:
            checks.append(value <= self.most)
        return reduce(lambda a, b: a & b, checks)


#: Figures as compiled by ``ratios``; a document is kept if it holds to every rule.
RULES = (
    Rule("n_words", least=50, most=1_000_000),
    Rule("word_length", least=2.0, most=14.0),
    Rule("symbols_per_word", most=0.25),
    Rule("stop_words", least=0.02),
    Rule("dup_lines", most=0.4),
    Rule("repeat_words", most=0.5),
)


def ratios() -> dict[str, Column]:
    """Figures that rules may name, over the counted columns."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    return {
        "n_words": F.col("n_words"),
        "word_length": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "stop_words": F.col("n_stop_words") / words,
        "dup_lines": F.col("n_dup_lines") / lines,
        "repeat_words": F.col("n_repeat_words") / words,
    }


def _trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def _repeated(words: str, hashes: str) -> Column:
    """Words covered by windows that occur twice or more, over array columns of words and window hashes."""
    w = F.col(words)
    pairs = F.array_sort(F.transform(F.col(hashes), lambda h, i: F.struct(h.alias("h"), F.hash(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("g"), i.alias("i"))))

    def starts(sorted_pairs: Column) -> Column:
        def mark(x: Column, k: Column) -> Column:
            same = lambda y: (y["h"] == x["h"]) & (y["g"] == x["g"])
            before = F.when(k > 0, F.get(sorted_pairs, k - 1))
            return F.when(F.coalesce(same(before), F.lit(False)) | F.coalesce(same(F.get(sorted_pairs, k + 1)), F.lit(False)), x["i"])

        return F.array_sort(F.array_compact(F.transform(sorted_pairs, mark)))

    def covered(at: Column) -> Column:
        step = lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - x, F.lit(WINDOW)))
        return F.aggregate(F.transform(at, step), F.lit(0), lambda a, x: a + x)

    # each array is bound once by a one-element transform, or it would be computed again for each element
    once = lambda value, f: F.transform(F.array(value), f)[0]
    return once(pairs, lambda p: once(starts(p), covered))


def figures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_stop_words, n_lines, n_dup_lines, n_repeat_words) for each row."""
    stop = sorted(set(STOP_WORDS.split()))
    body = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    cut = body.select(
        "key",
        "body",
        F.when(_trimmed(F.col("body")) == "", F.array().cast("array<string>")).otherwise(F.split(_trimmed(F.col("body")), "[ \\t-\\r]+")).alias("words"),
        F.filter(F.split("body", "\n"), lambda x: _trimmed(x) != "").alias("lines"),
    )
    w = F.col("words")
    windows = F.when(F.size(w) < WINDOW, F.array().cast("array<bigint>")).otherwise(F.transform(F.slice(w, 1, F.size(w) - WINDOW + 1), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))))
    counted = cut.select(
        "key",
        "words",
        windows.alias("windows"),
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.octet_length("body") - F.octet_length(F.regexp_replace("body", "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        F.size(F.filter("words", lambda x: F.lower(x).isin(stop))).cast("long").alias("n_stop_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    repeat = F.when(F.size(F.array_distinct("windows")) == F.size("windows"), F.lit(0)).otherwise(_repeated("words", "windows"))
    return counted.select("key", "n_words", "word_chars", "n_symbols", "n_stop_words", "n_lines", "n_dup_lines", repeat.cast("long").alias("n_repeat_words")).withColumnRenamed("key", key)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, figures, base_failed, kept): kept if the base rule and every rule of the table hold."""
    found = ratios()
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    verdict = reduce(lambda a, b: a & b, [r.holds(found) for r in rules], F.lit(True))
    return figures(docs, key, text).select("*", base.alias("base_failed"), (~base & verdict).alias("kept"))
