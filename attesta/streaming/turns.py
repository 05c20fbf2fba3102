"""Streaming forms of the incremental operators: windows, turns of a speaker, vocabulary proposals.

State is bounded by the watermark: what is later than it is dropped, as the batch forms have no such
limit they are the ones to compare with on complete input.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def windowed_counts(events: DataFrame, length: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts and sums by tumbling or sliding window and type."""
    window = F.window("ts", length, slide) if slide else F.window("ts", length)
    return events.withWatermark("ts", late).groupBy(window, "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "2 hours", late: str = "10 minutes") -> DataFrame:
    """Sessions of a user: events at most ``gap`` apart."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "user_id", "n")


def unknown_terms(events: DataFrame, approved: list[str], late: str = "10 minutes", length: str = "1 day") -> DataFrame:
    """Terms outside the vocabulary, counted by day: what the batch form logs as proposals."""
    asked = events.withWatermark("ts", late).where((F.col("event_type") != "") & ~F.col("event_type").isin(*approved))
    return asked.groupBy(F.window("ts", length), F.col("event_type").alias("term")).agg(F.count("*").alias("occurrences")).select(F.col("window.start").alias("day"), "term", "occurrences")


def first_seen(events: DataFrame, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """The first row of each key within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


TURN = "media_id long, speaker string, start_ms long, end_ms long, segments long"
OPEN = "speaker string, start_ms long, end_ms long, segments long"


def live_turns(segments: DataFrame, gap_ms: int = 2000) -> DataFrame:
    """Turns of segments (media_id, speaker, start_ms, end_ms) that come in order of start.

    One open turn a recording is state. A turn goes out when another speaker or a longer gap follows,
    the last one when the recording has been silent for ten minutes of processing time.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            last = state.get
            state.remove()
            yield pd.DataFrame([(key[0], *last)], columns=["media_id", "speaker", "start_ms", "end_ms", "segments"])
            return
        now = state.getOption
        done = []
        for row in pd.concat(list(batches)).sort_values("start_ms", kind="stable").itertuples(index=False):
            if now is not None and now[0] == row.speaker and row.start_ms - now[2] <= gap_ms:
                now = (now[0], now[1], max(now[2], int(row.end_ms)), now[3] + 1)
            else:
                if now is not None:
                    done.append((key[0], *now))
                now = (row.speaker, int(row.start_ms), int(row.end_ms), 1)
        if now is not None:
            state.update(now)
            state.setTimeoutDuration(600_000)
        yield pd.DataFrame(done, columns=["media_id", "speaker", "start_ms", "end_ms", "segments"])

    return segments.groupBy("media_id").applyInPandasWithState(step, TURN, OPEN, "append", GroupStateTimeout.ProcessingTimeTimeout)
