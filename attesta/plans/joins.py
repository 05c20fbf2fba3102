"""Queries of set similarity, tiered resolution, mentions, sets and text containment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attesta.functions import rules, text
from attesta.operators import metrics, similarity
from attesta.plans.registry import query
from attesta.plans.store import Store

_NAMES = "SELECT p_partkey AS id, concat(p_name, ' ', p_type) AS name, CASE WHEN p_partkey % 4 = 0 THEN p_partkey - 1 END AS parent_id, p_size AS evidence FROM {part}"
_IDENTITY = """
  n AS (SELECT p_partkey AS id, concat(p_name, ' ', p_type) AS name, CASE WHEN p_partkey % 4 = 0 THEN p_partkey - 1 END AS parent_id, p_size AS evidence FROM part),
  w AS (SELECT id, unnest(string_split_regex(lower(name), '[^a-z0-9]+')) AS w FROM n),
  t AS (SELECT DISTINCT id, """ + "CASE " + " ".join(f"WHEN w LIKE '%{x}' AND length(w) - {len(x)} >= 4 THEN left(w, length(w) - {len(x)})" for x in text.SUFFIXES) + " ELSE w END AS r FROM w WHERE length(w) > 2 AND w NOT IN (" + ", ".join(f"'{x}'" for x in text.STOP) + """)),
  c AS (SELECT id, count(*) AS n FROM t GROUP BY id),
  p AS (SELECT a.id AS a, b.id AS b, count(*) AS common FROM t a JOIN t b ON a.r = b.r AND a.id < b.id GROUP BY 1, 2),
  j AS (SELECT a, b, common / (ca.n + cb.n - common) AS score FROM p JOIN c ca ON ca.id = a JOIN c cb ON cb.id = b)"""


def _identified(s: Store) -> DataFrame:
    rows = s.spark.sql(_NAMES, part=s.raw("part"))
    return rows.withColumn("tokens", text.identity(F.col("name")))


@query(f"WITH {_IDENTITY} SELECT CASE WHEN a.id IS NOT NULL THEN a.id END AS id, (SELECT string_agg(r, '|' ORDER BY r) FROM t WHERE t.id = a.id) AS roots FROM n a")
def identity_roots(s: Store) -> DataFrame:
    return _identified(s).select("id", F.nullif(F.array_join("tokens", "|"), F.lit("")).alias("roots"))


@query(f"WITH {_IDENTITY} SELECT least(k, d) AS least_id, count(*) AS links FROM (SELECT a AS k, b AS d FROM j WHERE score >= 0.6) GROUP BY 1")
def dedup_link_counts(s: Store) -> DataFrame:
    """Candidate duplicates of each name that has a larger id: classes of equal names are expanded by counting."""
    rows = _identified(s).where(F.size("tokens") > 0)
    pairs = similarity.jaccard_pairs(rows)
    # members of equal sets link to each other and to all members of linked classes
    classes = rows.select("id", F.sort_array("tokens").alias("t"))
    rep = classes.groupBy("t").agg(F.min("id").alias("rep")).join(classes, "t").select("id", "rep")
    across = pairs.where("not identical").select("a", "b")
    both = across.union(across.select("b", "a")).union(rep.select("rep", F.col("rep").alias("x")).distinct().toDF("a", "b"))
    # each id asks every class linked to its own for its larger members; no pair of members is formed
    asked = both.join(rep.select(F.col("rep").alias("a"), "id"), "a").select(F.col("b").alias("rep"), "id", F.lit(0).alias("member"))
    larger = F.sum("member").over(Window.partitionBy("rep").orderBy(F.desc("id")).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    own = F.sum("member").over(Window.partitionBy("rep", "id"))
    counted = asked.unionAll(rep.select("rep", "id", F.lit(1).alias("member"))).select("id", "member", (larger - own).alias("n")).where("member = 0")
    return counted.groupBy(F.col("id").alias("least_id")).agg(F.sum("n").alias("links")).where("links > 0")


@query(f"WITH {_IDENTITY}, s AS (SELECT id, string_agg(r, '|' ORDER BY r) AS roots FROM t GROUP BY id) SELECT id, min(id) OVER (PARTITION BY roots) AS class_id FROM s")
def dedup_classes(s: Store) -> DataFrame:
    """The class of each name: the least id with the same roots, which stands for all of them in ``dedup_pairs``."""
    rows = _identified(s).where(F.size("tokens") > 0).select("id", F.array_join(F.sort_array("tokens"), "|").alias("roots"))
    # least ids by partial aggregation, so a name that many ids share makes no hot task
    return rows.join(rows.groupBy("roots").agg(F.min("id").alias("class_id")), "roots").select("id", "class_id")


@query(f"""
WITH {_IDENTITY} SELECT CASE WHEN x.evidence > y.evidence OR (x.evidence = y.evidence AND x.id < y.id) THEN x.id ELSE y.id END AS survivor, CASE WHEN x.evidence > y.evidence OR (x.evidence = y.evidence AND x.id < y.id) THEN y.id ELSE x.id END AS duplicate, round(score, 3) AS score
FROM j JOIN n x ON x.id = j.a JOIN n y ON y.id = j.b WHERE score >= 0.6 AND score < 1 AND coalesce(x.parent_id, -1) <> y.id AND coalesce(y.parent_id, -1) <> x.id
  AND NOT EXISTS (SELECT 1 FROM j e WHERE e.score = 1 AND e.b = x.id) AND NOT EXISTS (SELECT 1 FROM j e WHERE e.score = 1 AND e.b = y.id)""")
def dedup_pairs(s: Store) -> DataFrame:
    """Different names that may be one subject, over the least id of each name; the one with more evidence survives; parents and children are settled."""
    rows = _identified(s)
    pairs = similarity.jaccard_pairs(rows).where("not identical")
    side = lambda k: rows.select(F.col("id").alias(k), F.col("evidence").alias(f"e_{k}"), F.col("parent_id").alias(f"p_{k}"))
    known = pairs.join(side("a"), "a").join(side("b"), "b").where("coalesce(p_a, -1) <> b and coalesce(p_b, -1) <> a")
    first = F.col("e_a") >= F.col("e_b")  # a has the lower id
    return known.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("survivor"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("duplicate"), "score")


@query("""
WITH asked AS (SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN upper(p_brand) WHEN 2 THEN split_part(p_name, ' ', 1) ELSE 'nobody' END AS q FROM part),
     hits AS (SELECT a.id, p.p_partkey AS hit, 0 AS tier FROM asked a JOIN part p ON p.p_name = a.q UNION SELECT a.id, p.p_partkey, 1 FROM asked a JOIN part p ON upper(p.p_brand) = a.q UNION SELECT a.id, p.p_partkey, 2 FROM asked a JOIN part p ON split_part(p.p_name, ' ', 1) = a.q),
     best AS (SELECT id, min(tier) AS tier FROM hits GROUP BY id), top AS (SELECT h.id, h.tier, count(*) AS n, min(hit) AS hit FROM hits h JOIN best b ON b.id = h.id AND b.tier = h.tier GROUP BY h.id, h.tier)
SELECT a.id, CASE WHEN n = 1 THEN hit END AS hit, tier, CASE WHEN n IS NULL THEN 'none' WHEN n = 1 THEN 'resolved' ELSE 'ambiguous' END AS state FROM asked a LEFT JOIN top t ON t.id = a.id""")
def resolve_tiers(s: Store) -> DataFrame:
    """Exact name, then brand, then first word; a tie is a queue."""
    part = s.raw("part")
    m = F.col("p_partkey") % 4
    asked = part.select(F.col("p_partkey").alias("id"), F.when(m == 0, F.col("p_name")).when(m == 1, F.upper("p_brand")).when(m == 2, F.split_part("p_name", F.lit(" "), F.lit(1))).otherwise("nobody").alias("q"))
    by = lambda c: part.select(c.alias("q"), F.col("p_partkey").alias("hit"))
    return similarity.resolve_values(asked, [by(F.col("p_name")), by(F.upper("p_brand")), by(F.split_part("p_name", F.lit(" "), F.lit(1)))], "id", "q", "hit")


_MENTION_NAMES = ("Housing Commission", "the housing commission", "city won", "Staff granted", "The award was", "award was")


@query("""
WITH names(subject_id, name) AS (VALUES (0, 'Housing Commission'), (1, 'the housing commission'), (2, 'city won'), (3, 'Staff granted'), (4, 'The award was'), (5, 'award was')),
     hits AS (SELECT c.id AS claim_id, n.subject_id, strpos(lower(c.verbatim), lower(n.name)) - 1 AS a, length(n.name) AS len, c.verbatim FROM (SELECT id, min(verbatim) AS verbatim FROM s_claims GROUP BY id) c JOIN names n ON contains(lower(c.verbatim), lower(n.name)))
SELECT claim_id, cast(subject_id AS int) AS subject_id, cast(a AS int) AS span_start, cast(a + len AS int) AS span_end, substring(verbatim, a + 1, len) AS matched_text FROM hits h
WHERE NOT EXISTS (SELECT 1 FROM hits o WHERE o.claim_id = h.claim_id AND o.subject_id <> h.subject_id AND o.a <= h.a AND o.a + o.len >= h.a + h.len)""")
def literal_mentions(s: Store) -> DataFrame:
    names = s.spark.createDataFrame(list(enumerate(_MENTION_NAMES)), "subject_id int, name string")
    return similarity.literal_mentions(s.claims.groupBy(F.col("id").alias("claim_id")).agg(F.min("verbatim").alias("verbatim")), names)


@query("""
WITH a AS (SELECT l_orderkey AS k, l_returnflag AS v, count(*) AS n FROM lineitem WHERE l_linenumber <= 3 GROUP BY 1, 2), b AS (SELECT l_orderkey AS k, l_returnflag AS v, count(*) AS n FROM lineitem WHERE l_linenumber >= 3 GROUP BY 1, 2)
SELECT coalesce(a.k, b.k) AS k, coalesce(a.v, b.v) AS v, coalesce(a.n, 0) AS in_a, coalesce(b.n, 0) AS in_b FROM a FULL JOIN b ON a.k = b.k AND a.v = b.v WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def multiset_difference(s: Store) -> DataFrame:
    rows = s.raw("lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("v"), "l_linenumber")
    return similarity.multiset_difference(rows.where("l_linenumber <= 3"), rows.where("l_linenumber >= 3"), ["k", "v"])


@query("""
WITH a AS (SELECT DISTINCT l_orderkey AS k, l_returnflag AS v FROM lineitem WHERE l_linenumber <= 3), b AS (SELECT DISTINCT l_orderkey AS k, l_returnflag AS v FROM lineitem WHERE l_linenumber >= 3),
     k AS (SELECT k FROM a UNION SELECT k FROM b), f AS (SELECT a.k, count(*) AS n FROM a JOIN b ON a.k = b.k AND a.v = b.v GROUP BY 1)
SELECT k.k, round(CASE WHEN na IS NULL THEN 1.0 ELSE coalesce(f.n, 0) / na END, 4) AS recall, round(CASE WHEN nb IS NULL THEN 1.0 ELSE coalesce(f.n, 0) / nb END, 4) AS precision
FROM k LEFT JOIN f ON f.k = k.k LEFT JOIN (SELECT k, count(*) AS na FROM a GROUP BY 1) x ON x.k = k.k LEFT JOIN (SELECT k, count(*) AS nb FROM b GROUP BY 1) y ON y.k = k.k""")
def recall_precision(s: Store) -> DataFrame:
    """Sets per key; an empty side counts as fully met."""
    rows = s.raw("lineitem")
    none = F.array().cast("array<string>")
    sides = rows.groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_set(F.when(F.col("l_linenumber") <= 3, F.col("l_returnflag"))).alias("a"), F.collect_set(F.when(F.col("l_linenumber") >= 3, F.col("l_returnflag"))).alias("b"))
    found = F.size(F.array_intersect(F.coalesce("a", none), F.coalesce("b", none)))
    ratio = lambda side: F.round(F.when(F.size(side) == 0, 1.0).otherwise(found / F.size(side)), 4)
    return sides.select("k", ratio("a").alias("recall"), ratio("b").alias("precision"))


@query("SELECT item_id AS id, min(doc_id) AS first_document, count(*) AS documents FROM benchmark b JOIN documents d ON contains(d.text, b.text) GROUP BY item_id")
def contained_passages(s: Store) -> DataFrame:
    """Passages that documents hold word for word, however short."""
    held = similarity.contained(s.raw("documents").select("doc_id", "text"), s.raw("benchmark").select("item_id", F.col("text").alias("passage")), "doc_id", "text", "item_id", "passage")
    return held.groupBy(F.col("item_id").alias("id")).agg(F.min("doc_id").alias("first_document"), F.count("*").alias("documents"))


@query()
def word_agreement(s: Store) -> DataFrame:
    """Agreement of consecutive turns by sequence matching; tested against the definition."""
    c = s.raw("conversations")
    later = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("other"))
    return c.join(later, ["conv_id", "turn"]).select("conv_id", "turn", metrics.word_agreement("text", "other").alias("agreement"), metrics.word_error_rate("text", "other").alias("error"))


@query("SELECT id, title FROM (SELECT doc_id AS id, source AS title, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def first_wins(s: Store) -> DataFrame:
    return s.raw("documents").groupBy(F.col("source").alias("title")).agg(F.min("doc_id").alias("id")).select("id", "title")


@query("SELECT doc_id, sha256(text) AS digest, CASE WHEN doc_id % 10 = 0 THEN 'MISSING' WHEN doc_id % 10 = 1 THEN 'CHANGED' ELSE 'ok' END AS state FROM documents")
def provenance_states(s: Store) -> DataFrame:
    """Stored digests held against the bytes there are now."""
    docs = s.raw("documents")
    stored = docs.select("doc_id", F.sha2("text", 256).alias("digest"))
    now = docs.where("doc_id % 10 <> 0").select("doc_id", F.sha2(F.when(F.col("doc_id") % 10 == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text")), 256).alias("now"))
    state = F.when(F.col("now").isNull(), "MISSING").when(F.col("now") != F.col("digest"), "CHANGED").otherwise("ok")
    return stored.join(now, "doc_id", "left").select("doc_id", "digest", state.alias("state"))


@query(f"SELECT subject_id, count(*) AS reversals, min(id) AS first_claim FROM s_claims WHERE regexp_matches(verbatim, '{rules.REVERSAL}') GROUP BY subject_id")
def regex_filter(s: Store) -> DataFrame:
    """Claims whose words tell of a reversal, by subject."""
    return s.claims.where(F.col("verbatim").rlike(rules.REVERSAL)).groupBy("subject_id").agg(F.count("*").alias("reversals"), F.min("id").alias("first_claim"))


@query("SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def set_difference(s: Store) -> DataFrame:
    return s.raw("customer").select(F.col("c_custkey").alias("id")).exceptAll(s.raw("orders").where("o_orderstatus = 'F'").select("o_custkey").distinct())


@query("SELECT o_custkey AS id FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'")
def set_intersection(s: Store) -> DataFrame:
    orders = s.raw("orders")
    return orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id")).intersect(orders.where("o_orderstatus = 'O'").select("o_custkey"))
