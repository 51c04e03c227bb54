"""Shards by a hierarchical weighted hash tree.

A document descends region, rack and shard. At each level every child draws
``-ln(u) / weight`` from a hash of (document, child) and the least draw wins, so a
child's share is its weight, and a changed weight moves documents only into or out of
the subtree that holds it. The weight of an inner node is the sum below it.

All of it is column expressions. A document's place needs no other row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import query
from .tables import store, table

#: Regions of racks of {shard: weight}.
Tree = list[list[dict[int, float]]]


def tree(shards: int, per_rack: int = 2, racks: int = 2) -> Tree:
    """Shards of weight 1 in racks, and the racks in regions."""
    ids = list(range(shards))
    in_racks = [dict.fromkeys(ids[i : i + per_rack], 1.0) for i in range(0, shards, per_rack)]
    return [in_racks[i : i + racks] for i in range(0, len(in_racks), racks)]


def grown(old: Tree) -> Tree:
    """The tree with one more shard in a region of its own.

    Only the draw of the new region is new, so rows move into the new shard and nowhere
    else. In an old rack the shard would also draw rows to its neighbours.
    """
    return [*old, [{1 + max((s for region in old for rack in region for s in rack), default=-1): 1.0}]]


def _pick(key: Column, level: str, children: list[tuple[int, float]]) -> Column:
    """The child with the least draw; children without weight draw nothing."""
    live = [(c, w) for c, w in children if w > 0]
    if len(live) == 1:
        return F.lit(live[0][0])
    draws = []
    for child, weight in live:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(f"{level}/{child}")), 11)
        draws.append(F.struct(-F.log((bits + 0.5) / 2.0**53) / weight, F.lit(child).alias("child")))
    return F.array_min(F.array(*draws))["child"]


def place(key: Column, layout: Tree) -> Column:
    """The shard of a key under a tree; a NULL key is a key of its own."""
    racks = [[(i, math.fsum(rack.values())) for i, rack in enumerate(region)] for region in layout]
    regions = [(i, math.fsum(w for _, w in r)) for i, r in enumerate(racks)]
    if not any(w > 0 for _, w in regions):
        raise ValueError("the tree has no shard with a weight above 0")

    def choose(column: Column, level: str, options: list[tuple[int, Column]]) -> Column:
        out = None
        for i, then in options:
            out = F.when(column == i, then) if out is None else out.when(column == i, then)
        return out

    def in_region(r: int) -> Column:
        level = f"region/{r}/rack"
        options = [
            (k, _pick(key, f"{level}/{k}/shard", list(layout[r][k].items()))) for k, w in racks[r] if w > 0
        ]
        return options[0][1] if len(options) == 1 else choose(_pick(key, level, racks[r]), level, options)

    options = [(r, in_region(r)) for r, w in regions if w > 0]
    out = options[0][1] if len(options) == 1 else choose(_pick(key, "region", regions), "region", options)
    return out.cast("int")


def assign(docs: DataFrame, layout: Tree, name: str = "shard") -> DataFrame:
    """The rows of ``docs`` with a last column for their shard; no shuffle.

    Rows with the same doc_id share a shard, and so do all rows without one.
    """
    return docs.withColumn(name, place(F.col("doc_id"), layout))


def number(rows: DataFrame, shard: str = "shard") -> DataFrame:
    """``rows`` with a last column ``slot``: 0, 1, ... within each shard.

    Rows are stored with the task that read them. The tasks' counts, summed up, give
    each task its first slot of a shard, so no task sees more than one task's rows.
    """
    rows = rows.withColumns({"_task": F.spark_partition_id(), "_nth": F.monotonically_increasing_id()})
    rows = store(rows, "numbered")
    counts = rows.groupBy(shard, "_task").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(shard).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(shard, "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    own = Window.partitionBy(shard, "_task").orderBy("_nth")
    rows = rows.withColumn("_own", F.row_number().over(own) - 1).join(counts, [shard, "_task"])
    return rows.withColumn("slot", F.col("_first") + F.col("_own")).drop("_task", "_nth", "_first", "_own")


def sharded(docs: DataFrame, layout: Tree) -> DataFrame:
    """``doc_id, size, text_crc32, shard, grown_shard, slot`` for every row.

    Size is the UTF-8 bytes of the text plus 1; a NULL text counts as empty. Rows that
    repeat keep a slot each. Slots follow the order of the stored rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        place(F.col("doc_id"), layout).alias("shard"),
        place(F.col("doc_id"), grown(layout)).alias("grown_shard"),
    )
    return number(rows)


@query()
def op8_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of a tree of regions and racks, by their doc_id."""
    rows = sharded(table(spark, sf_dir, "documents"), tree(8))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
