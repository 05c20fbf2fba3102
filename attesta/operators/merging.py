"""Merging entities over all tables that declare a key to them.

Which tables and columns a merge touches is read from a ``Keys`` registry, so a table that is declared later is swept
without a change here. A merge is a function from snapshots to snapshots; ``sources.snapshots`` swaps all of them at once.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass(frozen=True)
class Entity:
    """A table of things with one name each; other names stand in ``aliases`` (alias_key, alias, alias_type)."""

    table: str
    aliases: str
    alias_key: str
    key: str = "id"
    name: str = "name"


@dataclass(frozen=True)
class Keys:
    """Declared foreign keys as (table, column, parent table), and unique keys by table."""

    foreign: tuple[tuple[str, str, str], ...]
    unique: Mapping[str, tuple[tuple[str, ...], ...]] = field(default_factory=dict)

    def to(self, parent: str) -> list[tuple[str, str]]:
        """Columns that point at ``parent``, but for the mark of merged rows."""
        return sorted((table, column) for table, column, p in self.foreign if p == parent and (table, column) != (parent, "merged_into_id"))


def merge_faults(parents: DataFrame, merges: DataFrame, entity: Entity) -> DataFrame:
    """(seq, loser, survivor, fault) for merges that may not be made, in the batch's order of ``seq``.

    self: into itself; missing: an id that isn't there; merged: the loser is merged already, before or earlier in the batch;
    target: the survivor is. Each merge has its first fault in this order.
    """
    known = lambda c: parents.select(F.col(entity.key).alias(c), F.col("merged_into_id").isNotNull().alias(f"_{c}_merged"), F.lit(True).alias(f"_{c}_there"))
    gone = merges.groupBy(F.col("loser").alias("_id")).agg(F.min("seq").alias("_seq"))
    earlier = lambda df, c: df.join(gone.select(F.col("_id").alias(c), F.col("_seq").alias(f"_{c}_seq")), c, "left")
    met = earlier(earlier(merges.select("seq", "loser", "survivor").join(known("loser"), "loser", "left").join(known("survivor"), "survivor", "left"), "loser"), "survivor")
    fault = (
        F.when(F.col("loser") == F.col("survivor"), "self")
        .when(F.col("_loser_there").isNull() | F.col("_survivor_there").isNull(), "missing")
        .when(F.col("_loser_merged") | (F.col("_loser_seq") < F.col("seq")), "merged")
        .when(F.col("_survivor_merged") | (F.col("_survivor_seq") < F.col("seq")), "target")
    )
    return met.select("seq", "loser", "survivor", fault.alias("fault")).where("fault is not null")


def final_survivors(merges: DataFrame) -> DataFrame:
    """(loser, survivor): where each loser's rows end when a survivor is merged further on later in the batch.

    One step a round, as many as the longest path of rulings; the plan grows by one small join a round.
    """
    onward = merges.select(F.col("loser").alias("survivor"), F.col("survivor").alias("_next"))
    paths = merges.select("loser", "survivor")
    while True:
        longer = paths.join(onward, "survivor", "left")
        if longer.where("_next is not null").isEmpty():
            return paths
        paths = longer.select("loser", F.coalesce("_next", "survivor").alias("survivor"))


def _repointed(rows: DataFrame, column: str, paths: DataFrame, unique: list[tuple[str, ...]]) -> DataFrame:
    """``rows`` with _moved and _dropped: a moved row goes if another row, unmoved ones first, has the same unique key (nulls alike)."""
    new = paths.select(F.col("loser").alias(column), F.col("survivor").alias("_survivor"))
    moved = rows.join(new, column, "left").withColumn("_moved", F.col("_survivor").isNotNull()).withColumn(column, F.coalesce("_survivor", column)).select(*rows.columns, "_moved")
    doubled: Column = F.lit(False)
    for k, keys in enumerate(unique):
        w = Window.partitionBy(*keys).orderBy("_moved", *[c for c in rows.columns if c not in keys])
        moved = moved.withColumn(f"_rank{k}", F.row_number().over(w))
        doubled = doubled | (F.col(f"_rank{k}") > 1)
    return moved.withColumn("_dropped", F.col("_moved") & doubled).select(*rows.columns, "_moved", "_dropped")


def merge(tables: Mapping[str, DataFrame], keys: Keys, entity: Entity, merges: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """(tables after the merge, report); ``merges`` has seq, loser, survivor, merged_by, merge_note and no faults.

    Every declared column is repointed, a row that would double a unique key of the survivor's is dropped, the losers' names become the
    survivors' aliases unless they have them in any letter case, and losers are marked, never deleted. The report counts
    moved and dropped rows by table and column.
    """
    paths = final_survivors(merges)
    after, reports = {}, []
    for table, column in keys.to(entity.table):
        rows = after.get(table, tables[table])
        told = _repointed(rows, column, paths, [k for k in keys.unique.get(table, ()) if column in k])
        reports.append(told.agg(F.count_if(F.col("_moved") & ~F.col("_dropped")).alias("moved"), F.count_if("_dropped").alias("dropped")).select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "moved", "dropped"))
        after[table] = told.where("not _dropped").select(*rows.columns)
    parents = after.get(entity.table, tables[entity.table])
    names = merges.join(parents.select(F.col(entity.key).alias("loser"), F.col(entity.name).alias("alias")), "loser").join(paths.withColumnRenamed("survivor", "_final"), "loser")
    fresh = names.where("alias is not null").groupBy(F.col("_final").alias(entity.alias_key), F.lower("alias").alias("_lower")).agg(F.min_by("alias", "seq").alias("alias"))
    aliases = after.get(entity.aliases, tables[entity.aliases])
    had = aliases.select(entity.alias_key, F.lower("alias").alias("_lower"))
    extra = fresh.join(had, [entity.alias_key, "_lower"], "left_anti").withColumn("alias_type", F.lit("other"))
    after[entity.aliases] = aliases.unionByName(extra.select(*[c for c in aliases.columns if c in extra.columns]), allowMissingColumns=True)
    ruled = merges.select(F.col("loser").alias(entity.key), F.col("survivor").alias("_into"), *[F.col(c).alias(f"_{c}") for c in ("merged_by", "merge_note")])
    marked = parents.join(ruled, entity.key, "left").withColumn("merged_into_id", F.coalesce("_into", "merged_into_id"))
    for c in ("merged_by", "merge_note"):
        if c in parents.columns:
            marked = marked.withColumn(c, F.when(F.col("_into").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c)))
    after[entity.table] = marked.select(*parents.columns)
    return after, reduce(DataFrame.unionByName, reports)
