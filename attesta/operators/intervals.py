"""Joins on intervals: overlap, point in interval, band, nearest, and interval-overlap (IoU) matching.

Range predicates run as equi-joins on buckets of the line, so each task sees one stretch of one key.
A pair that shares several buckets is kept in the first one only, so no distinct follows. Intervals
are [start, end] in whole numbers (milliseconds, characters, points).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _buckets(start: Column, end: Column, width: int) -> Column:
    first, last = F.floor(start / width), F.floor(end / width)
    return F.sequence(first, F.greatest(first, last))


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], width: int, start: str = "start_ms", end: str = "end_ms", least: int = 0) -> DataFrame:
    """Pairs with equal keys whose intervals share more than ``least``; the right side's columns get the prefix ``r_``.

    ``width`` should be about the usual length of an interval: a longer one stands in several buckets.
    Adds ``overlap``. Null ends or keys match nothing.
    """
    r = right.select(*keys, *[F.col(c).alias(f"r_{c}") for c in right.columns if c not in keys])
    lb = left.withColumn("_b", F.explode(_buckets(F.col(start), F.col(end), width)))
    rb = r.withColumn("_b", F.explode(_buckets(F.col(f"r_{start}"), F.col(f"r_{end}"), width)))
    shared = F.least(end, f"r_{end}") - F.greatest(start, f"r_{start}")
    pairs = lb.join(rb, [*keys, "_b"]).withColumn("overlap", shared)
    first = F.floor(F.greatest(start, f"r_{start}") / width)
    return pairs.where((F.col("overlap") > least) & (F.col("_b") == first)).drop("_b")


def band_join(left: DataFrame, right: DataFrame, keys: list[str], at: str, r_at: str, within: int) -> DataFrame:
    """Pairs with equal keys whose positions differ by less than ``within``; adds ``distance``."""
    bucket = F.floor(F.col(r_at) / within)
    r = right.withColumn("_b", F.explode(F.array(bucket - 1, bucket, bucket + 1)))
    pairs = left.withColumn("_b", F.floor(F.col(at) / within)).join(r, [*keys, "_b"]).drop("_b")
    return pairs.withColumn("distance", F.abs(F.col(at) - F.col(r_at))).where(F.col("distance") < within)


def last_start(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, start: str, payload: list[str], tie: str) -> DataFrame:
    """Each point with the payload of the interval of its keys that starts last at or before it (an as-of join).

    Points and intervals are sorted together once; nothing is paired.
    """
    marks = intervals.select(*keys, F.col(start).alias("_at"), F.lit(0).alias("_kind"), F.col(tie).alias("_tie"), F.struct(*payload).alias("_found"), F.lit(None).cast(points.select(F.struct("*")).schema[0].dataType).alias("_point"))
    asked = points.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(intervals.schema[tie].dataType).alias("_tie"), F.lit(None).cast(marks.schema["_found"].dataType).alias("_found"), F.struct("*").alias("_point"))
    w = Window.partitionBy(*keys).orderBy("_at", "_kind", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    seen = marks.unionByName(asked).withColumn("_found", F.last("_found", ignorenulls=True).over(w)).where("_kind = 1")
    return seen.select("_point.*", *[F.col(f"_found.{c}").alias(c) for c in payload])


def assign_points(points: DataFrame, turns: DataFrame, keys: list[str], at: str, tie: str, within: float, interjections: DataFrame | None = None) -> DataFrame:
    """Each point with the turn it belongs to: ``points`` plus turn (its ``tie``), interjection and basis, all null for none.

    A turn that holds the point (ends included) and starts last before it has it; an interjection of that
    turn (``tie``, interjection, start_ms, end_ms) that holds the point, the first by start, goes before
    the turn. A point in no turn goes to the nearer edge of the turn before and the turn after, the
    former among equals, if that lies within ``within``. Sorted both ways once; nothing is paired but
    points with the interjections of their turn.
    """
    place = F.struct("start_ms", "end_ms", F.col(tie).alias("turn"))
    kind = turns.select(place.alias("p")).schema["p"].dataType
    row = F.struct(*points.columns)
    marks = turns.select(*keys, F.col("start_ms").cast("double").alias("_at"), F.lit(0).alias("_kind"), F.col(tie).alias("_tie"), place.alias("_turn"), F.lit(None).cast(points.select(row.alias("r")).schema["r"].dataType).alias("_row"))
    asked = points.select(*keys, F.col(at).cast("double").alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(turns.schema[tie].dataType).alias("_tie"), F.lit(None).cast(kind).alias("_turn"), row.alias("_row"))
    base = Window.partitionBy(*keys)
    before = F.last("_turn", ignorenulls=True).over(base.orderBy("_at", "_kind", "_tie").rowsBetween(Window.unboundedPreceding, 0))
    after = F.last("_turn", ignorenulls=True).over(base.orderBy(F.desc("_at"), F.desc("_kind"), F.desc("_tie")).rowsBetween(Window.unboundedPreceding, 0))
    met = marks.unionByName(asked).withColumn("_before", before).withColumn("_after", after).where("_kind = 1")
    inside = F.coalesce(F.col("_at") <= F.col("_before.end_ms"), F.lit(False))
    far = lambda t: F.least(F.abs(F.col("_at") - F.col(f"{t}.start_ms")), F.abs(F.col("_at") - F.col(f"{t}.end_ms")))
    nearer = F.when(far("_before") <= F.coalesce(far("_after"), far("_before")), F.col("_before.turn")).otherwise(F.col("_after.turn"))
    near = F.least(far("_before"), far("_after")) <= within
    told = met.select("_row.*", F.col("_at").alias("_point"), F.when(inside, F.col("_before.turn")).when(near, nearer).alias("turn"), F.when(inside, "inside").when(near, "nearest").alias("basis"))
    if interjections is None:
        return told.select(*points.columns, "turn", F.lit(None).cast("long").alias("interjection"), "basis")
    held = interjections.select(F.col(tie).alias("turn"), F.col("interjection"), F.col("start_ms").alias("_s"), F.col("end_ms").alias("_e"))
    cut = told.where("basis = 'inside'").join(held, "turn").where("_point between _s and _e")
    first = cut.groupBy(*points.columns, "turn").agg(F.min_by("interjection", F.struct("_s", "interjection")).alias("interjection"))
    return told.join(first.select(*points.columns, "interjection"), points.columns, "left").select(*points.columns, "turn", "interjection", "basis")


def nearest(left: DataFrame, right: DataFrame, keys: list[str], cost: Column, allowed: Column, left_id: str, tie: str) -> DataFrame:
    """For each left row the allowed right row of its keys with the least cost; ties by ``tie``.

    One row per left row survives by min_by in a partial aggregate, not by a sorted window.
    """
    pairs = left.join(right, keys).where(allowed).withColumn("cost", cost)
    best = F.min_by(F.struct("*"), F.struct("cost", tie))
    return pairs.groupBy(left_id).agg(best.alias("_best")).select("_best.*")


def best_iou(left: DataFrame, right: DataFrame, keys: list[str], width: int, left_id: str, right_id: str, least: float = 0.5) -> DataFrame:
    """The right interval with the greatest intersection over union of at least ``least`` for each left one."""
    pairs = overlap_join(left, right, keys, width)
    union = F.greatest("end_ms", "r_end_ms") - F.least("start_ms", "r_start_ms")
    scored = pairs.withColumn("iou", F.col("overlap") / union).where(F.col("iou") >= least)
    return scored.groupBy(left_id).agg(F.max_by(F.struct(F.col(f"r_{right_id}").alias(right_id), "iou"), F.struct("iou", -F.col(f"r_{right_id}"))).alias("_m")).select(left_id, "_m.*")


def reanchor(corrections: DataFrame, turns: DataFrame, keys: list[str], width: int, exact: str, least: float = 0.5) -> DataFrame:
    """``corrections`` (id, keys, ``exact``, start_ms, end_ms) with turn (its id), iou and state: ``exact`` where a turn has the same key, else ``reanchored`` to the turn of the best overlap, else ``lost``."""
    named = turns.groupBy(*keys, exact).agg(F.min("id").alias("turn"))
    known = corrections.join(named, [*keys, exact], "left")
    open_ = known.where("turn is null").drop("turn")
    best = best_iou(open_, turns.withColumnRenamed("id", "turn").select(*keys, "turn", "start_ms", "end_ms"), keys, width, "id", "turn", least)
    told = open_.join(best, "id", "left").select(*corrections.columns, "turn", "iou", F.when(F.col("turn").isNull(), "lost").otherwise("reanchored").alias("state"))
    return known.where("turn is not null").select(*corrections.columns, "turn", F.lit(None).cast("double").alias("iou"), F.lit("exact").alias("state")).unionByName(told)


def boxes_overlap(a: str = "", b: str = "r_") -> Column:
    return (F.least(f"{a}x1", f"{b}x1") > F.greatest(f"{a}x0", f"{b}x0")) & (F.least(f"{a}y1", f"{b}y1") > F.greatest(f"{a}y0", f"{b}y0"))


def flatten(intervals: DataFrame, keys: list[str], label: str, tie: str) -> DataFrame:
    """Atomic stretches between all edges, each with the label of the shortest interval that covers it."""
    edges = intervals.select(*keys, F.explode(F.array("start_ms", "end_ms")).alias("at")).distinct()
    w = Window.partitionBy(*keys).orderBy("at")
    atoms = edges.select(*keys, F.col("at").alias("start_ms"), F.lead("at").over(w).alias("end_ms")).where("end_ms > start_ms")
    width = 60_000
    covered = overlap_join(atoms, intervals.withColumn("length", F.col("end_ms") - F.col("start_ms")), keys, width)
    return covered.groupBy(*keys, "start_ms", "end_ms").agg(F.min_by(f"r_{label}", F.struct("r_length", f"r_{tie}")).alias(label))
