"""Write semantics as pure functions from snapshots to snapshots.

Nothing is updated in place: each function returns the rows after the write (and what it logs), for the
caller to swap in. Guards return offending rows; ``enforce`` turns them into a failure at run time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def enforce_vocabulary(rows: DataFrame, column: str, terms: DataFrame, key: str, order: str, vocabulary: str, fallback: str | None) -> tuple[DataFrame, DataFrame]:
    """(rows, proposals): unknown terms never reject a row.

    ``terms`` has term, approved, deprecated. Null and empty terms stay; approved live terms pass; any
    other is logged with its occurrences and the first row that used it, and replaced by ``fallback``
    (kept as written where that is null).
    """
    good = terms.where("approved and not deprecated").select(F.col("term").alias(column)).distinct().withColumn("_known", F.lit(True))
    marked = rows.join(good, column, "left")
    unknown = (F.col(column) != "") & F.col("_known").isNull()
    proposals = marked.where(unknown).groupBy(F.col(column).alias("term")).agg(F.count("*").alias("occurrences"), F.min_by(key, order).alias("entity_id")).withColumn("vocabulary", F.lit(vocabulary))
    value = F.when(unknown, F.coalesce(F.lit(fallback), F.col(column))).otherwise(F.col(column))
    return marked.withColumn(column, value).select(*rows.columns), proposals


def upsert(old: DataFrame, new: DataFrame, keys: list[str], mode: str) -> DataFrame:
    """Rows after INSERT ... ON CONFLICT: ``update`` takes the new values, ``nothing`` the old, ``enrich`` fills the old row's nulls.

    Of several new rows with one key the least by the other columns, in their order, is taken.
    """
    rest = [c for c in new.columns if c not in keys]
    single = new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(*keys, "_row.*") if rest else new.distinct()
    o, n = old.alias("o"), single.alias("n")
    both = o.join(n, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full")
    had, got = F.col(f"o.{keys[0]}").isNotNull(), F.col(f"n.{keys[0]}").isNotNull()

    def pick(c: str) -> Column:
        if c in keys or mode == "enrich":
            return F.coalesce(f"o.{c}", f"n.{c}").alias(c)
        first = got if mode == "update" else ~had
        return F.when(first, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)

    if mode not in ("update", "nothing", "enrich"):
        raise ValueError(mode)
    return both.select(*[pick(c) for c in old.columns])


def repoint(child: DataFrame, fk: str, merges: DataFrame, unique: list[str] | None = None) -> DataFrame:
    """Child rows after merging (``merges``: loser, survivor): keys repointed; a row that would double one of the survivor's under ``unique`` is dropped."""
    m = merges.select(F.col("loser").alias(fk), F.col("survivor").alias("_survivor"))
    moved = child.join(m, fk, "left").withColumn("_moved", F.col("_survivor").isNotNull()).withColumn(fk, F.coalesce("_survivor", fk))
    if not unique:
        return moved.select(*child.columns)
    w = Window.partitionBy(*unique).orderBy("_moved", *[c for c in child.columns if c not in unique])
    return moved.withColumn("_rank", F.row_number().over(w)).where("not _moved or _rank = 1").select(*child.columns)


def tombstones(parents: DataFrame, merges: DataFrame, key: str = "id") -> DataFrame:
    """Parent rows with merged_into_id set on losers."""
    m = merges.select(F.col("loser").alias(key), F.col("survivor").alias("_survivor"))
    return parents.join(m, key, "left").withColumn("merged_into_id", F.coalesce("_survivor", "merged_into_id")).select(*parents.columns)


def merge_target_faults(parents: DataFrame, key: str = "id") -> DataFrame:
    """Merges into a row that is merged itself, into itself, or into nothing."""
    target = parents.select(F.col(key).alias("merged_into_id"), F.col("merged_into_id").alias("_next"), F.lit(True).alias("_there"))
    rows = parents.where("merged_into_id is not null").join(target, "merged_into_id", "left")
    fault = F.when(F.col(key) == F.col("merged_into_id"), "self").when(F.col("_there").isNull(), "missing").when(F.col("_next").isNotNull(), "chain")
    return rows.select(key, "merged_into_id", fault.alias("fault")).where("fault is not null")


def private_voiceprints(voiceprints: DataFrame, persons: DataFrame) -> DataFrame:
    """Voiceprints of people who are known not to be public figures; an unknown person isn't refused."""
    private = persons.where("is_public_figure = false").select(F.col("id").alias("person_id"))
    return voiceprints.join(private, "person_id", "left_semi")


def enforce(rows: DataFrame, refused: Column, message: str) -> DataFrame:
    """``rows``, failing at run time on the first refused one."""
    checked = F.when(refused, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True))
    return rows.where(checked)


def _refused_claims(claims: DataFrame) -> DataFrame:
    """(claim_id, refused): whether a claim has no subject or a state other than confirmed. A null state raises nothing, as in SQL."""
    bad = F.col("subject_id").isNull() | F.coalesce(F.col("curation_state") != "confirmed", F.lit(False))
    return claims.groupBy(F.col("id").alias("claim_id")).agg(F.bool_or(bad).alias("refused"))


def refused_manifests(manifests: DataFrame, claims: DataFrame) -> DataFrame:
    """New manifest rows (claim_id, ...) whose claim may not be published."""
    return manifests.join(_refused_claims(claims).where("refused").select("claim_id"), "claim_id", "left_semi")


def insert_manifests(existing: DataFrame, new: DataFrame, claims: DataFrame) -> DataFrame:
    """``existing`` and ``new`` rows; fails at run time if a new one is refused. Existing rows aren't looked at again."""
    checked = enforce(new.join(_refused_claims(claims), "claim_id", "left"), F.coalesce("refused", F.lit(False)), "a claim cannot enter a page manifest: subject_id unset or curation_state is not confirmed")
    return existing.unionByName(checked.select(*existing.columns))


def shift_spans(spans: DataFrame, edits: DataFrame, key: str) -> DataFrame:
    """Spans after text edits (``edits``: key, edit_start, edit_end, delta).

    A span shifts by the deltas of edits that end at or before it. An edit that reaches into the span
    from either side, or lies in it, makes it ``needs_reanchor``. Spans and edits are sorted together, so
    no span meets each edit of its text: shifts are running sums, and a span is touched if an edit that
    starts before its end ends after its start.
    """
    rest = [c for c in spans.columns if c not in (key, "span_start", "span_end")]
    row = F.struct(*[F.col(c) for c in rest], "span_start", "span_end")
    kind = spans.select(row.alias("r")).schema["r"].dataType
    none = F.lit(None).cast(kind)
    at_start = spans.select(key, F.col("span_start").alias("_at"), F.lit(1).alias("_kind"), F.lit(0).cast("long").alias("_delta"), row.alias("_row"))
    ends = edits.select(key, F.col("edit_end").alias("_at"), F.lit(0).alias("_kind"), F.col("delta").cast("long").alias("_delta"), none.alias("_row"))
    w = Window.partitionBy(key).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    moved = at_start.unionByName(ends).withColumn("_by", F.sum("_delta").over(w)).where("_kind = 1").select(key, "_row", "_by")
    # the greatest end among the edits that start before the span's end
    starts = edits.select(key, F.col("edit_start").alias("_at"), F.lit(1).alias("_kind"), F.col("edit_end").alias("_end"), none.alias("_row"), F.lit(None).cast("long").alias("_by"))
    at_end = moved.select(key, F.col("_row.span_end").alias("_at"), F.lit(0).alias("_kind"), F.lit(None).cast(edits.schema["edit_end"].dataType).alias("_end"), "_row", "_by")
    both = starts.unionByName(at_end).withColumn("_reach", F.max("_end").over(w)).where("_kind = 0")
    told = both.withColumn("needs_reanchor", F.coalesce(F.col("_reach") > F.col("_row.span_start"), F.lit(False)))
    shift = lambda c: F.when(F.col("needs_reanchor"), F.col(f"_row.{c}")).otherwise(F.col(f"_row.{c}") + F.col("_by")).alias(c)
    return told.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest], shift("span_start"), shift("span_end"), "needs_reanchor")


def fill_only_null(rows: DataFrame, derived: DataFrame, keys: list[str], column: str) -> DataFrame:
    """``rows`` with nulls of ``column`` filled from ``derived``; known values never change."""
    d = derived.select(*keys, F.col(column).alias("_derived"))
    return rows.join(d, keys, "left").withColumn(column, F.coalesce(column, "_derived")).select(*rows.columns)


def centroid(vectors: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """(key, n, centroid): the mean of the vectors, scaled to length 1. Sums are by position, so nothing is collected."""
    cells = vectors.select(key, F.posexplode(vector).alias("p", "v"))
    means = cells.groupBy(key, "p").agg(F.avg(F.col("v").cast("double")).alias("m"), F.count("*").alias("n"))
    joined = means.groupBy(key).agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("p", "m"))), lambda x: x["m"]).alias("c"), F.sqrt(F.sum(F.col("m") * F.col("m"))).alias("length"))
    return joined.select(key, "n", F.transform("c", lambda x: x / F.col("length")).alias("centroid"))


def upsert_where(old: DataFrame, new: DataFrame, keys: list[str], order: str, update: list[str], condition: Column | None = None) -> DataFrame:
    """Rows after INSERT ... ON CONFLICT (``keys``) WHERE ``condition`` DO UPDATE SET ``update``, row by row in ``order``.

    The condition is that of a partial unique index (the keys are known, if it is not given): rows outside it never collide, so
    all of them are inserted. A row that collides changes the ``update`` columns only; the others stay as first inserted. A null key collides with nothing.
    """
    known = reduce(lambda a, k: a & F.col(k).isNotNull(), keys, F.lit(True))
    inside = F.coalesce(known if condition is None else known & condition, F.lit(False))
    fresh = new.withColumn("_in", inside)
    row = F.struct(*old.columns)
    folded = fresh.where("_in").groupBy(*keys).agg(F.min_by(row, order).alias("_first"), F.max_by(F.struct(*update), order).alias("_last"))
    held = old.withColumn("_in", inside)
    met = held.where("_in").select(*keys, row.alias("_old")).join(folded, keys, "full")
    pick = lambda c: F.col(f"_last.{c}") if c in update else F.coalesce(F.col("_old"), F.col("_first"))[c]
    written = met.select(*[(F.when(F.col("_last").isNotNull(), pick(c)).otherwise(F.col(f"_old.{c}"))).alias(c) for c in old.columns])
    return written.unionByName(held.where("not _in").select(*old.columns)).unionByName(fresh.where("not _in").select(*old.columns))


def link_or_insert(old: DataFrame, new: DataFrame, match: list[str], identity: list[str], order: str, fill: list[str], update: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, outcomes): ``new`` rows linked to rows of another source by ``match`` columns, or else upserted by ``identity``.

    One row of the same match: it takes the new identity and keeps what it has, ``fill`` columns getting values where it has none.
    Several: the match is ambiguous, the new rows are queued with their number of hits and nothing is written. None: an
    upsert, which changes ``update`` columns of a row with the same identity, or a new row. Hits are those before the batch; new rows
    that share a match go to one row in ``order``, the last giving the identity, each filling what is still unknown. ``outcomes``
    has a row for each new row: match, identity, order, outcome (linked, inserted, updated, ambiguous), hits.
    """
    own = identity[-1]
    hits = old.groupBy(*match).agg(F.count("*").alias("_hits"))
    met = new.join(hits, match, "left").withColumn("_hits", F.coalesce("_hits", F.lit(0)))
    by = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order)))
    folded = met.where("_hits <= 1").groupBy(*match, "_hits").agg(F.max_by(own, order).alias("_own"), F.min_by(F.struct(*new.columns), order).alias("_first"), *[by(c).alias(f"_{c}") for c in fill])
    # one hit
    one = folded.where("_hits = 1").drop("_hits")
    linked = old.join(one, match, "left")
    got = F.col("_first").isNotNull()
    took = {own: F.when(got, F.col("_own")).otherwise(F.col(own)), **{c: F.coalesce(c, f"_{c}") for c in fill}}
    after = linked.select(*[took.get(c, F.col(c)).alias(c) for c in old.columns])
    # none: an upsert of the first, the others fill it
    none = folded.where("_hits = 0").select("_own", *[f"_{c}" for c in fill], *[F.col(f"_first.{c}").alias(c) for c in new.columns])
    same = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in identity]
    both = after.alias("o").join(none.alias("n"), same, "full")
    had, new_ = F.col(f"o.{own}").isNotNull() | F.col(f"o.{old.columns[0]}").isNotNull(), F.col(f"n.{own}").isNotNull()

    def value(c: str) -> Column:
        filled = F.coalesce(f"n.{c}", f"n._{c}") if c in fill else F.col(f"n.{c}")
        if c == own:
            return F.when(new_, F.col("n._own")).otherwise(F.col(f"o.{c}")).alias(c)
        if c in update:
            kept = filled
        else:
            kept = F.coalesce(f"o.{c}", f"n._{c}") if c in fill else F.col(f"o.{c}")
        return F.when(new_ & had, kept).when(new_, filled).otherwise(F.col(f"o.{c}")).alias(c)

    rows = both.select(*[value(c) for c in old.columns])
    known = after.select(*identity).where(F.col(own).isNotNull()).distinct().withColumn("_known", F.lit(True))
    first = F.row_number().over(Window.partitionBy(*match).orderBy(order)) == 1
    told = met.withColumn("_is_first", first).join(known, identity, "left")
    outcome = F.when(F.col("_hits") > 1, "ambiguous").when(F.col("_hits") == 1, "linked").when(~F.col("_is_first"), "linked").when(F.col("_known"), "updated").otherwise("inserted")
    return rows, told.select(*match, own, order, outcome.alias("outcome"), F.col("_hits").alias("hits"))


def inherit(rows: DataFrame, key: str, column: str, sources: list[tuple[str, DataFrame, list[str]]], live: DataFrame | None = None, longest: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, queue, counts): nulls of ``column`` filled from the first source that knows one value, with its name as provenance.

    ``sources`` are (name, frame, keys of ``rows`` that the frame has beside ``column``) in order of precedence. Known values never change; a source
    with several values for a key decides nothing and the next is asked. ``live`` (id, survivor) sends values that were merged away to
    their survivors. Rows that no source fills are in ``queue`` (key, reason, candidates): ambiguous with the candidates of all
    sources, or no candidate. ``counts`` has filled rows by source. Values are counted by key before they meet rows, so no source multiplies them.

    Only rows without a value ask. A source's least and greatest value of a key tell whether it knows one, so no lists are made but those of the queue, and
    these meet unfilled rows only. The source named by ``longest`` has its lists joined last, so that no shuffle carries them beside rows.
    A source by the rows' own ``key`` may be as long as the rows: only what it says of rows that ask goes further. Rows that lack a source's
    key, or have their value from an earlier one, are dealt over all tasks of its join instead of meeting under one key.
    """
    rest, asked = rows.where(F.col(column).isNotNull()), rows.where(F.col(column).isNull())
    values, told = [], asked.withColumns({"_by": F.lit(None).cast("int"), "_value": F.col(column)})
    for k, (_, frame, keys) in enumerate(sources):
        lacking = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in keys])
        value = frame.where(F.col(column).isNotNull()).where(~lacking)
        if key in keys:
            value = value.join(asked.select(*keys), keys, "left_semi")
        if live is not None:
            value = value.join(live.select(F.col("id").alias(column), F.col("survivor").alias("_survivor")), column, "left").withColumn(column, F.coalesce("_survivor", column))
        values.append(value.select(*keys, column))
        # 0 in every row, but no literal, which the optimizer would take out of the join's keys
        known = values[k].withColumn("_deal", lacking.cast("int")).groupBy(*keys, "_deal").agg(F.min(column).alias("_least"), F.max(column).alias("_most"))
        one = known.select(*keys, "_deal", F.when(F.col("_least") == F.col("_most"), F.col("_least")).alias("_one"))
        if k == 0 or keys != sources[k - 1][2]:  # sources by the same keys share a shuffle
            told = told.withColumn("_deal", F.when(lacking | F.col("_by").isNotNull(), 1 + F.pmod(F.xxhash64(key), F.lit(1 << 10))).otherwise(0).cast("int"))
        met = told.join(one, [*keys, "_deal"], "left")
        told = met.select(*rows.columns, "_deal", F.coalesce("_by", F.when(F.col("_one").isNotNull(), F.lit(k))).alias("_by"), F.coalesce("_value", "_one").alias("_value"))
    by = F.coalesce(*[F.when(F.col("_by") == k, F.lit(name)) for k, (name, *_) in enumerate(sources)])
    told = told.withColumn("provenance", by)
    after = rest.withColumn("provenance", F.lit(None).cast("string")).unionByName(told.withColumn(column, F.col("_value")).select(*rows.columns, "provenance"))
    counts = told.where("provenance is not null").groupBy("provenance").agg(F.count("*").alias("filled"))
    needed = list(dict.fromkeys([key, *[c for *_, keys in sources for c in keys]]))
    queue = told.where("_value is null").select(*needed)
    for k, (_, _, keys) in sorted(enumerate(sources), key=lambda x: x[1][0] == longest):
        queue = queue.join(values[k].groupBy(*keys).agg(F.sort_array(F.collect_set(column)).alias(f"_c{k}")), keys, "left")
    lists = [F.col(f"_c{k}") for k in range(len(sources))]
    none = F.array().cast(T.ArrayType(rows.schema[column].dataType))
    speaking = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in lists])
    # a list that stands alone is sorted and distinct as it is
    candidates = F.when(speaking <= 1, F.coalesce(*lists, none)).otherwise(F.sort_array(F.array_distinct(F.flatten(F.array(*[F.coalesce(c, none) for c in lists])))))
    return after, queue.select(key, candidates.alias("candidates")).select(key, F.when(F.size("candidates") > 0, "ambiguous").otherwise("no candidate").alias("reason"), "candidates"), counts
