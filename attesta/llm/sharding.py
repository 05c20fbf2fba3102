"""Rendezvous hashing of record keys over weighted shards.

Every shard scores a key with -ln(u) / weight, where u in (0, 1) is a hash of key and shard; the
lowest score wins. A score depends on nothing but the key, the shard and its weight, so a further
shard takes rows only into itself and a dropped one gives away only its own. The work is one
projection; no row moves until slots are numbered.

Slots number the rows of each shard from 0 without a gap. Rows are dealt by (shard, cell), where the
cell is a hash of key, checksum and size, counted, and numbered within their cell; the counts of lower
cells come before. Rows alike in all three are one counted row until they have their run of slots; the
run is then dealt in pieces of PIECE over tasks and written out. So neither a hot key nor a hot row
makes a hot task; no task holds a shard, and what is broadcast has at most shards x CELLS rows.

Defined cases: a null key is a key of its own; equal keys share a shard; a null text has size 1 and
checksum 0; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Cells of a shard. Raise it so that a cell (rows / shards / CELLS) sorts in memory.
CELLS = 256
#: Slots of equal rows that one row stands for when slots are written out.
PIECE = 4096


def scores(key: Column, weights: Sequence[float]) -> list[Column]:
    """A struct (score, shard) for each shard; the least is the key's shard."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("every shard needs a weight above 0")
    name = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("n"))
    out = []
    for shard, weight in enumerate(weights):
        h = F.shiftrightunsigned(F.xxhash64(name, F.lit(shard)), 11)  # 53 bits
        u = (h.cast("double") + 0.5) / float(2**53)
        out.append(F.struct((-F.log(u) / float(weight)).alias("score"), F.lit(shard).alias("shard")))
    return out


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    found = scores(key, weights)
    return (F.least(*found) if len(found) > 1 else found[0])["shard"]


def assign_shards(docs: DataFrame, weights: Sequence[float] = (1.0,) * 16, grown_weight: float = 1.0, key: str = "doc_id", text: str = "text", cells: int = CELLS) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) for each row of ``docs``.

    grown_shard is the shard under one more shard of weight ``grown_weight``.
    """
    found = scores(F.col(key), [*weights, grown_weight])
    best = F.least(*found[:-1]) if len(found) > 2 else found[0]
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        best.alias("best"),
        found[-1].alias("added"),
    ).select("key", "size", "text_crc32", F.col("best.shard").alias("shard"), F.least("best", "added")["shard"].alias("grown_shard"))
    told = rows.groupBy("key", "size", "text_crc32", "shard", "grown_shard").agg(F.count("*").alias("n"))
    told = told.withColumn("cell", F.pmod(F.xxhash64(F.coalesce(F.col("key").cast("string"), F.lit("")), "text_crc32", "size"), F.lit(cells)).cast("int"))
    counts = told.groupBy("shard", "cell").agg(F.sum("n").alias("rows"))
    reach = (Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("rows").over(Window.partitionBy("shard").orderBy("cell").rowsBetween(*reach)), F.lit(0))
    starts = counts.select("shard", "cell", before.alias("start"))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("shard", "cell").orderBy("key", "text_crc32", "size").rowsBetween(*reach)), F.lit(0))
    # at most shards x cells rows, whatever the input
    numbered = told.withColumn("inside", inside).join(F.broadcast(starts), ["shard", "cell"]).withColumn("first", (F.col("start") + F.col("inside")).cast("long"))
    pieces = numbered.withColumn("from", F.explode(F.expr(f"sequence(first, first + n - 1, {PIECE}L)"))).repartition("shard", "from")
    return pieces.select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.explode(F.expr(f"sequence(`from`, least(`from` + {PIECE - 1}, first + n - 1))")).alias("slot"),
        "grown_shard",
    )
