"""Queries of the ordered operators and of the diarization metrics built on interval joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attesta.operators import intervals, metrics, sequences
from attesta.plans.registry import query
from attesta.plans.store import Store

_RUNS = """
  seg AS (SELECT *, lag(speaker) OVER w AS prev FROM s_diarization WINDOW w AS (PARTITION BY media_id ORDER BY start_ms, id)),
  run AS (SELECT *, sum(CASE WHEN prev = speaker THEN 0 ELSE 1 END) OVER (PARTITION BY media_id ORDER BY start_ms, id) AS run FROM seg),
  reach AS (SELECT *, max(end_ms) OVER (PARTITION BY media_id, run ORDER BY start_ms, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM run),
  part AS (SELECT *, sum(CASE WHEN start_ms - reach <= 2000 THEN 0 ELSE 1 END) OVER (PARTITION BY media_id, run ORDER BY start_ms, id) AS part FROM reach),
  turns AS (SELECT media_id, min(speaker) AS speaker, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS segments, cast(row_number() OVER (PARTITION BY media_id ORDER BY run, part) - 1 AS int) AS seq FROM part GROUP BY media_id, run, part)"""


@query(f"WITH {_RUNS} SELECT * FROM turns")
def coalesce_runs(s: Store) -> DataFrame:
    return sequences.coalesce_runs(s.diarization)


_TURNS = """
  spoken AS (SELECT *, coalesce(nullif(speaker, ''), 'unknown') AS who FROM s_words WHERE trim(coalesce(text, '')) <> ''),
  marked AS (SELECT *, CASE WHEN lag(who) OVER w = who AND start_ms - lag(end_ms) OVER w <= 2000 THEN 0 ELSE 1 END AS fresh FROM spoken WINDOW w AS (PARTITION BY media_id ORDER BY start_ms, id)),
  numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY media_id ORDER BY start_ms, id) - 1 AS seq FROM marked),
  turns AS (SELECT media_id, seq, min(who) AS speaker, min(start_ms) AS start_ms, arg_max(end_ms, start_ms * 1000000 + id) AS end_ms, count(*) AS word_count, string_agg(text, ' ' ORDER BY start_ms, id) AS text FROM numbered GROUP BY media_id, seq)"""


@query(f"WITH {_TURNS} SELECT media_id, cast(seq AS bigint) AS seq, speaker, start_ms, end_ms, word_count, text FROM turns")
def build_turns(s: Store) -> DataFrame:
    return sequences.build_turns(s.words)


@query(f"""
WITH {_TURNS}, n AS (SELECT *, lag(speaker) OVER w AS ps, lead(speaker) OVER w AS ns, lag(end_ms) OVER w AS pe, rtrim(lag(text) OVER w) AS pt FROM turns WINDOW w AS (PARTITION BY media_id ORDER BY seq))
SELECT media_id, cast(seq AS bigint) AS seq, concat_ws('|', CASE WHEN ps <> speaker AND start_ms - pe < 150 THEN 'no_pause' END, CASE WHEN ps <> speaker AND length(pt) > 0 AND right(pt, 1) NOT IN ('.', '?', '!') THEN 'mid_sentence' END,
       CASE WHEN word_count <= 2 AND ps = ns AND ps <> speaker THEN 'short_run' END) AS flags FROM n""")
def turn_flags(s: Store) -> DataFrame:
    return sequences.turn_flags(sequences.build_turns(s.words)).select("media_id", "seq", "flags")


@query()
def absorb_interjections(s: Store) -> DataFrame:
    """Sequential by nature; tested against a direct loop."""
    return sequences.absorb_interjections(sequences.coalesce_runs(s.diarization))


@query("""
SELECT id, speaker, coalesce(speaker, CASE WHEN b = a THEN b END) AS filled FROM (
  SELECT *, last_value(speaker IGNORE NULLS) OVER (PARTITION BY media_id ORDER BY start_ms, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b,
            first_value(speaker IGNORE NULLS) OVER (PARTITION BY media_id ORDER BY start_ms, id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS a FROM s_words)""")
def fill_agree(s: Store) -> DataFrame:
    return sequences.fill_agreeing(s.words, ["media_id"], ["start_ms", "id"], "speaker").select("id", "speaker", "filled")


@query("SELECT media_id, id, gap_ms FROM (SELECT *, lead(start_ms) OVER (PARTITION BY media_id ORDER BY start_ms, id) - end_ms AS gap_ms FROM s_diarization) WHERE gap_ms >= 5000")
def silences(s: Store) -> DataFrame:
    return sequences.gaps(s.diarization, ["media_id"], 5000).select("media_id", "id", "gap_ms")


@query("""
WITH u AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS unit, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS seq FROM documents)
SELECT doc_id, seq, sha256(unit) AS unit_sha256, cast(coalesce(sum(length(unit) + 2) OVER (PARTITION BY doc_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bigint) AS char_start,
       cast(coalesce(sum(length(unit) + 2) OVER (PARTITION BY doc_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(unit) AS bigint) AS char_end FROM u""")
def unit_offsets(s: Store) -> DataFrame:
    units = s.raw("documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("seq", "unit"))
    return sequences.offsets(units, "doc_id", "seq", "unit").select("doc_id", F.col("seq").cast("long").alias("seq"), F.sha2("unit", 256).alias("unit_sha256"), "char_start", "char_end")


@query("""
SELECT media_id, person, speaker, votes, total, round(votes / total, 3) AS purity FROM (
  SELECT *, sum(votes) OVER (PARTITION BY media_id, person) AS total, row_number() OVER (PARTITION BY media_id, person ORDER BY votes DESC, seen) AS rn
  FROM (SELECT media_id, id % 7 AS person, speaker, count(*) AS votes, min(id) AS seen FROM s_words WHERE speaker IS NOT NULL GROUP BY 1, 2, 3)) WHERE rn = 1""")
def plurality_speaker(s: Store) -> DataFrame:
    votes = s.words.where("speaker is not null").withColumn("person", F.col("id") % 7)
    return sequences.plurality(votes, ["media_id", "person"], "speaker", "id")


@query("""
SELECT id, media_id, speaker, start_ms, end_ms FROM (SELECT *, max(end_ms) OVER (PARTITION BY media_id ORDER BY start_ms, end_ms DESC, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM (SELECT DISTINCT ON (media_id, start_ms, end_ms) * FROM s_diarization ORDER BY media_id, start_ms, end_ms, id))
WHERE reach IS NULL OR end_ms > reach""")
def contained_spans(s: Store) -> DataFrame:
    once = s.diarization.groupBy("media_id", "start_ms", "end_ms").agg(F.min_by(F.struct("id", "speaker"), "id").alias("x")).select("media_id", "start_ms", "end_ms", "x.*")
    return sequences.drop_contained(once, ["media_id"], "start_ms", "end_ms").select("id", "media_id", "speaker", "start_ms", "end_ms")


# ---------------------------------------------------------------- interval joins

_OVERLAP = "SELECT d.media_id, d.id, d.speaker, r.id AS r_id, r.speaker AS r_speaker, least(d.end_ms, r.end_ms) - greatest(d.start_ms, r.start_ms) AS overlap FROM s_diarization d JOIN s_reference_segments r ON r.media_id = d.media_id AND least(d.end_ms, r.end_ms) - greatest(d.start_ms, r.start_ms) > 0"
_WIDTH = 60_000


def overlaps(s: Store) -> DataFrame:
    return intervals.overlap_join(s.diarization, s.reference_segments, ["media_id"], _WIDTH)


@query(_OVERLAP)
def interval_overlap(s: Store) -> DataFrame:
    return overlaps(s).select("media_id", "id", "speaker", "r_id", "r_speaker", "overlap")


@query(f"SELECT id, count(DISTINCT r_speaker) AS speakers FROM ({_OVERLAP}) WHERE overlap > 400 GROUP BY id HAVING count(DISTINCT r_speaker) > 1")
def welded_turns(s: Store) -> DataFrame:
    return intervals.overlap_join(s.diarization, s.reference_segments, ["media_id"], _WIDTH, least=400).groupBy("id").agg(F.countDistinct("r_speaker").alias("speakers")).where("speakers > 1")


@query(f"""
WITH p AS (SELECT media_id, speaker, r_speaker, sum(overlap) AS ms FROM ({_OVERLAP}) GROUP BY ALL)
SELECT media_id, speaker, count(*) AS spans_speakers, cast(sum(ms) AS bigint) AS ms, round(max(ms) / sum(ms), 4) AS purity FROM p GROUP BY media_id, speaker""")
def cluster_purity(s: Store) -> DataFrame:
    return metrics.purity(overlaps(s), "speaker", "r_speaker")


@query(f"""
WITH p AS (SELECT media_id, speaker, r_speaker, sum(overlap) AS ms FROM ({_OVERLAP}) GROUP BY ALL)
SELECT media_id, r_speaker, count(*) AS spans_speakers, cast(sum(ms) AS bigint) AS ms, round(max(ms) / sum(ms), 4) AS purity FROM p GROUP BY media_id, r_speaker""")
def speaker_coverage(s: Store) -> DataFrame:
    return metrics.purity(overlaps(s), "r_speaker", "speaker")


@query()
def greedy_speaker_map(s: Store) -> DataFrame:
    """Clusters to reference speakers by shared time, greedily; tested against a direct loop."""
    return metrics.greedy_map(overlaps(s))


@query()
def diarization_error(s: Store) -> DataFrame:
    """Confusion, miss and false alarm by atomic stretches; tested against a time grid."""
    return metrics.diarization_error(s.diarization, s.reference_segments)


_INTERJECTIONS = "SELECT id, id * 10 AS interjection, start_ms + (end_ms - start_ms) // 4 AS start_ms, start_ms + (end_ms - start_ms) // 2 AS end_ms FROM s_diarization WHERE id % 3 = 0"


@query(f"""
WITH w AS (SELECT id, media_id, (start_ms + end_ms) / 2 AS mid FROM s_words),
     t AS (SELECT id AS turn, media_id, start_ms, end_ms, row_number() OVER (PARTITION BY media_id ORDER BY start_ms, id) AS n FROM s_diarization),
     i AS (SELECT w.id, w.media_id, w.mid, max(t.n) AS n FROM w LEFT JOIN t ON t.media_id = w.media_id AND t.start_ms <= w.mid GROUP BY ALL),
     d AS (SELECT i.*, a.turn AS ta, b.turn AS tb, coalesce(i.mid <= a.end_ms, false) AS inside, least(abs(i.mid - a.start_ms), abs(i.mid - a.end_ms)) AS da, least(abs(i.mid - b.start_ms), abs(i.mid - b.end_ms)) AS db
           FROM i LEFT JOIN t a ON a.media_id = i.media_id AND a.n = i.n LEFT JOIN t b ON b.media_id = i.media_id AND b.n = coalesce(i.n, 0) + 1),
     r AS (SELECT id, media_id, mid, CASE WHEN inside THEN ta WHEN coalesce(da, 1e18) <= coalesce(db, 1e18) AND da <= 2000 THEN ta WHEN coalesce(db, 1e18) < coalesce(da, 1e18) AND db <= 2000 THEN tb END AS turn, CASE WHEN inside THEN 'inside' WHEN least(da, db) <= 2000 THEN 'nearest' END AS basis FROM d)
SELECT r.id, r.media_id, r.turn, j.interjection, r.basis FROM r LEFT JOIN ({_INTERJECTIONS}) j ON j.id = r.turn AND r.basis = 'inside' AND r.mid BETWEEN j.start_ms AND j.end_ms""")
def word_to_turn(s: Store) -> DataFrame:
    """Each word, by its middle, with its turn, the interjection that has it, or the turn whose edge is nearest, two seconds away at most."""
    words = s.words.select("id", "media_id", ((F.col("start_ms") + F.col("end_ms")) / 2).alias("mid"))
    span = F.col("end_ms") - F.col("start_ms")
    cut = s.diarization.where("id % 3 = 0").select(F.col("id"), (F.col("id") * 10).alias("interjection"), (F.col("start_ms") + F.floor(span / 4)).alias("start_ms"), (F.col("start_ms") + F.floor(span / 2)).alias("end_ms"))
    turns = s.diarization.select(F.col("id").alias("turn_id"), "media_id", "start_ms", "end_ms")
    return intervals.assign_points(words, turns, ["media_id"], "mid", "turn_id", 2000, cut.withColumnRenamed("id", "turn_id")).select("id", "media_id", "turn", "interjection", "basis")


@query("""
SELECT id, r_id, iou FROM (SELECT d.id, r.id AS r_id, (least(d.end_ms, r.end_ms) - greatest(d.start_ms, r.start_ms)) / (greatest(d.end_ms, r.end_ms) - least(d.start_ms, r.start_ms)) AS iou,
  row_number() OVER (PARTITION BY d.id ORDER BY (least(d.end_ms, r.end_ms) - greatest(d.start_ms, r.start_ms)) / (greatest(d.end_ms, r.end_ms) - least(d.start_ms, r.start_ms)) DESC, r.id) AS rn
  FROM s_diarization d JOIN s_reference_segments r ON r.media_id = d.media_id AND least(d.end_ms, r.end_ms) - greatest(d.start_ms, r.start_ms) > 0) WHERE rn = 1 AND iou >= 0.5""")
def reanchor_iou(s: Store) -> DataFrame:
    r = s.reference_segments.withColumnRenamed("id", "r_id")
    return intervals.best_iou(s.diarization, r, ["media_id"], _WIDTH, "id", "r_id")


@query("""
WITH r AS (SELECT id AS turn, media_id, CASE WHEN id % 5 = 0 THEN concat('k', id) ELSE concat('r', id) END AS key, start_ms, end_ms FROM s_reference_segments), c AS (SELECT id, media_id, concat('k', id) AS key, start_ms, end_ms FROM s_diarization),
     x AS (SELECT c.id, c.media_id, c.start_ms, c.end_ms, min(r.turn) AS turn FROM c LEFT JOIN r ON r.media_id = c.media_id AND r.key = c.key GROUP BY ALL),
     i AS (SELECT x.id, r.turn, (least(x.end_ms, r.end_ms) - greatest(x.start_ms, r.start_ms)) / (greatest(x.end_ms, r.end_ms) - least(x.start_ms, r.start_ms)) AS iou FROM x JOIN r ON r.media_id = x.media_id AND least(x.end_ms, r.end_ms) - greatest(x.start_ms, r.start_ms) > 0 WHERE x.turn IS NULL),
     b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY iou DESC, turn) AS rn FROM i) WHERE rn = 1 AND iou >= 0.5)
SELECT x.id, coalesce(x.turn, b.turn) AS turn, b.iou, CASE WHEN x.turn IS NOT NULL THEN 'exact' WHEN b.turn IS NOT NULL THEN 'reanchored' ELSE 'lost' END AS state FROM x LEFT JOIN b ON b.id = x.id""")
def reanchored_corrections(s: Store) -> DataFrame:
    """Corrections by key where the turn kept it, by overlap otherwise."""
    key = lambda p: F.concat(F.lit(p), F.col("id").cast("string"))
    turns = s.reference_segments.select("id", "media_id", F.when(F.col("id") % 5 == 0, key("k")).otherwise(key("r")).alias("key"), "start_ms", "end_ms")
    return intervals.reanchor(s.diarization.select("id", "media_id", key("k").alias("key"), "start_ms", "end_ms"), turns, ["media_id"], _WIDTH, "key").select("id", "turn", "iou", "state")


@query("SELECT a.id, b.id AS r_id, abs(a.end_ms - b.start_ms) AS distance FROM s_diarization a JOIN s_words b ON b.media_id = a.media_id AND abs(a.end_ms - b.start_ms) < 750")
def boundary_tolerance(s: Store) -> DataFrame:
    """Boundaries within three quarters of a second of a word's start."""
    w = s.words.select("media_id", F.col("id").alias("r_id"), F.col("start_ms").alias("r_at"))
    return intervals.band_join(s.diarization, w, ["media_id"], "end_ms", "r_at", 750).select("id", "r_id", "distance")


@query("""
SELECT id, picture_id, cost FROM (SELECT c.id, p.id AS picture_id, abs(c.x0 - p.x0) + abs(c.y0 - p.y0) AS cost, row_number() OVER (PARTITION BY c.id ORDER BY abs(c.x0 - p.x0) + abs(c.y0 - p.y0), p.id) AS rn
  FROM s_boxes c JOIN s_boxes p ON p.page_id = c.page_id AND p.kind = 'picture' AND abs(c.x0 - p.x0) <= 25 AND abs(c.y0 - p.y0) <= 25 WHERE c.kind = 'caption') WHERE rn = 1""")
def nearest_picture(s: Store) -> DataFrame:
    """The nearest picture of the page for each caption."""
    captions = s.boxes.where("kind = 'caption'").select("id", "page_id", "x0", "y0")
    pictures = s.boxes.where("kind = 'picture'").select("page_id", F.col("id").alias("picture_id"), F.col("x0").alias("px"), F.col("y0").alias("py"))
    dx, dy = F.abs(F.col("x0") - F.col("px")), F.abs(F.col("y0") - F.col("py"))
    return intervals.nearest(captions, pictures, ["page_id"], dx + dy, (dx <= 25) & (dy <= 25), "id", "picture_id").select("id", "picture_id", "cost")


@query("SELECT id, page_id FROM s_boxes p WHERE kind = 'picture' AND NOT EXISTS (SELECT 1 FROM s_boxes c WHERE c.page_id = p.page_id AND c.kind = 'caption' AND least(c.x1, p.x1) > greatest(c.x0, p.x0) AND least(c.y1, p.y1) > greatest(c.y0, p.y0))")
def uncovered_pictures(s: Store) -> DataFrame:
    """Pictures that no caption box of the page touches."""
    captions = s.boxes.where("kind = 'caption'").select("page_id", *[F.col(c).alias(f"r_{c}") for c in ("x0", "y0", "x1", "y1")]).withColumnRenamed("page_id", "r_page")
    pictures = s.boxes.where("kind = 'picture'")
    return pictures.join(captions, (F.col("page_id") == F.col("r_page")) & intervals.boxes_overlap(), "left_anti").select("id", "page_id")


@query("""
WITH e AS (SELECT media_id, start_ms AS edge FROM s_reference_segments UNION SELECT media_id, end_ms FROM s_reference_segments),
     a AS (SELECT media_id, edge AS start_ms, lead(edge) OVER (PARTITION BY media_id ORDER BY edge) AS end_ms FROM e)
SELECT a.media_id, a.start_ms, a.end_ms, arg_min(r.speaker, (r.end_ms - r.start_ms) * 10000000 + r.id) AS speaker FROM a JOIN s_reference_segments r ON r.media_id = a.media_id AND r.start_ms < a.end_ms AND r.end_ms > a.start_ms
WHERE a.end_ms > a.start_ms GROUP BY a.media_id, a.start_ms, a.end_ms""")
def reference_timeline(s: Store) -> DataFrame:
    """Atomic stretches of the reference; the shortest covering segment wins."""
    return intervals.flatten(s.reference_segments, ["media_id"], "speaker", "id")


@query("""
SELECT media_id, count(*) AS n, median(gap) AS median_ms, list_sort(list(gap))[cast(floor(count(*) * 0.9) AS bigint) + 1] AS p90_ms, round(avg(CASE WHEN gap <= 3000 THEN 1.0 ELSE 0.0 END), 3) AS within
FROM (SELECT media_id, end_ms - start_ms AS gap FROM s_diarization) GROUP BY media_id""")
def offset_quantiles(s: Store) -> DataFrame:
    """Median and nearest-rank 90th percentile: the element at floor(0.9 n) of the sorted values."""
    rows = s.diarization.select("media_id", (F.col("end_ms") - F.col("start_ms")).alias("gap"))
    ranked = rows.withColumn("k", F.row_number().over(Window.partitionBy("media_id").orderBy("gap")) - 1)
    stats = rows.groupBy("media_id").agg(F.count("*").alias("n"), F.median("gap").alias("median_ms"), F.round(F.avg((F.col("gap") <= 3000).cast("double")), 3).alias("within"))
    return stats.join(ranked.select("media_id", "k", F.col("gap").alias("p90_ms")), "media_id").where(F.col("k") == F.floor(F.col("n") * 0.9)).select("media_id", "n", "median_ms", "p90_ms", "within")


@query("""
WITH r AS (SELECT vec_id, label, cast(embedding[1] AS double) AS x, vec_id % 17 AS y FROM embeddings),
     k AS (SELECT label, rank() OVER (PARTITION BY label ORDER BY x) + (count(*) OVER (PARTITION BY label, x) - 1) / 2.0 AS rx, rank() OVER (PARTITION BY label ORDER BY y) + (count(*) OVER (PARTITION BY label, y) - 1) / 2.0 AS ry FROM r)
SELECT label, round(corr(rx, ry), 6) AS spearman FROM k GROUP BY label""")
def spearman(s: Store) -> DataFrame:
    """Rank correlation with averaged ties."""
    rows = s.raw("embeddings").select("label", F.element_at("embedding", 1).cast("double").alias("x"), (F.col("vec_id") % 17).alias("y"))
    return metrics.spearman(rows, ["label"], "x", "y")
