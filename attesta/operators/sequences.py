"""Ordered operators inside a key: islands, turns, fills, gaps, offsets.

Each is windows over one partitioning (the recording, page or document), so that consecutive ones share
a shuffle. Where the rule is sequential (absorbing interjections), a pandas function runs per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

GAP_MS, INTERJECTION_MS = 2000, 3000


def islands(df: DataFrame, keys: list[str], order: list[str], new: Column, name: str = "island") -> DataFrame:
    """Numbers runs: a row for which ``new`` holds (or is null: the first) starts one."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.sum(F.coalesce(new, F.lit(True)).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def coalesce_runs(segments: DataFrame, key: str = "media_id", gap_ms: int = GAP_MS) -> DataFrame:
    """Merges consecutive segments of a speaker with gaps of at most ``gap_ms`` to the greatest end so far.

    First runs of a speaker, then the gaps inside each run: the greatest end starts afresh with every run.
    """
    order = ["start_ms", "id"]
    w = Window.partitionBy(key).orderBy(*order)
    runs = islands(segments, [key], order, ~F.lag("speaker").over(w).eqNullSafe(F.col("speaker")), "run")
    inside = Window.partitionBy(key, "run").orderBy(*order)
    reach = F.max("end_ms").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    turns = islands(runs.withColumn("reach", reach), [key, "run"], order, F.col("start_ms") - F.col("reach") > gap_ms, "part")
    merged = turns.groupBy(key, "run", "part").agg(F.first("speaker").alias("speaker"), F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.count("*").alias("segments"))
    seq = F.row_number().over(Window.partitionBy(key).orderBy("run", "part")) - 1
    return merged.withColumn("seq", seq).drop("run", "part")


def build_turns(words: DataFrame, key: str = "media_id", gap_ms: int = GAP_MS) -> DataFrame:
    """Turns of words: a new speaker or a gap after the last word starts one; blank words are skipped."""
    spoken = words.where(F.trim(F.coalesce("text", F.lit(""))) != "").withColumn("speaker", F.coalesce(F.nullif("speaker", F.lit("")), F.lit("unknown")))
    w = Window.partitionBy(key).orderBy("start_ms", "id")
    new = (F.lag("speaker").over(w) != F.col("speaker")) | (F.col("start_ms") - F.lag("end_ms").over(w) > gap_ms)
    runs = islands(spoken, [key], ["start_ms", "id"], new, "seq").withColumn("seq", F.col("seq") - 1)
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start_ms", "id", "text"))), lambda x: x["text"]), " ")
    ends = F.max_by("end_ms", F.struct("start_ms", "id"))
    return runs.groupBy(key, "seq").agg(F.first("speaker").alias("speaker"), F.min("start_ms").alias("start_ms"), ends.alias("end_ms"), F.count("*").alias("word_count"), said.alias("text"))


def turn_flags(turns: DataFrame, key: str = "media_id", no_pause_ms: int = 150, short_words: int = 2, terminal: str = ".?!") -> DataFrame:
    """Boundary flags: no pause before, the turn before cut mid-sentence, a flicker between two turns of another speaker."""
    w = Window.partitionBy(key).orderBy("seq")
    before, after = F.lag("speaker").over(w), F.lead("speaker").over(w)
    changed = before != F.col("speaker")
    prior = F.rtrim(F.lag("text").over(w))
    open_ = (F.char_length(prior) > 0) & ~F.right(prior, F.lit(1)).isin(*terminal)
    flag = lambda cond, name: F.when(F.coalesce(cond, F.lit(False)), F.lit(name))
    flags = F.array_compact(F.array(flag(changed & (F.col("start_ms") - F.lag("end_ms").over(w) < no_pause_ms), "no_pause"), flag(changed & open_, "mid_sentence"), flag((F.col("word_count") <= short_words) & (before == after) & changed, "short_run")))
    return turns.withColumn("flags", F.array_join(flags, "|"))


def absorb_interjections(turns: DataFrame, key: str = "media_id", most_ms: int = INTERJECTION_MS) -> DataFrame:
    """Folds A, short B, A into one turn of A that carries B; greedy, one pass, never overlapping.

    A recording is one group; its turns are a few thousand rows.
    """

    def fold(pdf):
        pdf = pdf.sort_values("seq").reset_index(drop=True)
        rows, i = [], 0
        speaker, start, end = pdf["speaker"].tolist(), pdf["start_ms"].tolist(), pdf["end_ms"].tolist()
        while i < len(pdf):
            sandwich = i + 2 < len(pdf) and speaker[i + 1] != speaker[i] == speaker[i + 2] and end[i + 1] - start[i + 1] < most_ms
            last = i + 2 if sandwich else i
            rows.append((pdf[key][i], len(rows), speaker[i], start[i], end[last], int(sandwich)))
            i = last + 1
        return type(pdf)(rows, columns=[key, "seq", "speaker", "start_ms", "end_ms", "interjections"])

    kind = dict(turns.dtypes)
    return turns.select(key, "seq", "speaker", "start_ms", "end_ms").groupBy(key).applyInPandas(fold, f"{key} {kind[key]}, seq int, speaker string, start_ms long, end_ms long, interjections int")


def fill_agreeing(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Fills nulls whose nearest known neighbours on both sides agree."""
    w = Window.partitionBy(*keys).orderBy(*order)
    before = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(value, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    return df.withColumn("filled", F.coalesce(F.col(value), F.when(before == after, before)))


def gaps(df: DataFrame, keys: list[str], least_ms: int) -> DataFrame:
    """Silences of at least ``least_ms`` between a row's end and the next start."""
    w = Window.partitionBy(*keys).orderBy("start_ms", "id")
    return df.withColumn("gap_ms", F.lead("start_ms").over(w) - F.col("end_ms")).where(F.col("gap_ms") >= least_ms)


def offsets(units: DataFrame, key: str, order: str, text: str, separator: int = 2) -> DataFrame:
    """Where each unit begins and ends in the text that joins them with a separator of that length."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.char_length(text) + separator).over(w), F.lit(0))
    return units.withColumn("char_start", start).withColumn("char_end", start + F.char_length(text))


def drop_contained(spans: DataFrame, keys: list[str], start: str = "span_start", end: str = "span_end") -> DataFrame:
    """Spans that lie in no earlier or longer span."""
    w = Window.partitionBy(*keys).orderBy(start, F.desc(end)).rowsBetween(Window.unboundedPreceding, -1)
    return spans.withColumn("_reach", F.max(end).over(w)).where(F.col("_reach").isNull() | (F.col(end) > F.col("_reach"))).drop("_reach")


def plurality(votes: DataFrame, keys: list[str], choice: str, seen: str) -> DataFrame:
    """The most frequent choice of each key, the one seen first among equals, with its share."""
    counted = votes.groupBy(*keys, choice).agg(F.count("*").alias("votes"), F.min(seen).alias("first"))
    best = F.max_by(F.struct(choice, "votes"), F.struct("votes", -F.col("first")))
    return counted.groupBy(*keys).agg(best.alias("_b"), F.sum("votes").alias("total")).select(*keys, f"_b.{choice}", "_b.votes", "total", F.round(F.col("_b.votes") / F.col("total"), 3).alias("purity"))
