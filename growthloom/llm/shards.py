"""Balanced shards: groups that stay together go, largest first, to the least loaded shard.

The heap runs over a bounded list. A group that holds at least one part in SHARE of a shard is scheduled alone, and there
are at most shards * SHARE such groups. All smaller groups are first put by hash into 4 * TIER bundles, whose widths fall by
eight from tier to tier, so that the last bundles placed level the shards out.
"""
from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SHARE = 1000
TIER = 1024
RANGE_ROWS = 20_000


def _bundle(h: Column) -> Column:
    """Number of the bundle of a hash: tier t takes 7/8 of what the tiers before it left, the last tier all of it."""
    u = F.pmod(h, F.lit(1 << 40)) / F.lit(float(1 << 40))
    start, out = 0.0, None
    for tier in range(4):
        width = 1 - start if tier == 3 else (1 - start) * 7 / 8
        number = F.least(F.floor((u - F.lit(start)) * F.lit(TIER / width)), F.lit(TIER - 1)) + tier * TIER
        out = F.when(u < start + width, number) if out is None else (out.otherwise(number) if tier == 3 else out.when(u < start + width, number))
        start += width
    return out.cast("int")


def schedule(sizes: list[tuple], shards: int) -> dict:
    """Longest processing time: (size, key) pairs, largest first (ties by key), each to the least loaded shard."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for size, key in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        out[key] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def shard(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Every document with size (UTF-8 bytes + 1), text_crc32, shard and slot; equal texts share a shard.

    Other columns stay (names that begin with `__` are reserved, the four added names are replaced). Null texts are one
    group, empty texts another; their CRC is 0. Slots count from 0 without gaps in each shard, by hash range of doc_id;
    rows with equal doc_id and text are interchangeable. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    docs = docs.drop("size", "text_crc32", "shard", "slot")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    one, two = F.xxhash64("text"), F.xxhash64(F.lit(5), "text")
    rows, total = docs.agg(F.count(F.lit(1)), F.sum(size)).first()
    floor = max(1.0, (total or 0) / (shards * SHARE))
    groups = docs.groupBy(one.alias("__one"), two.alias("__two")).agg(F.sum(size).alias("__size"))
    alone = F.col("__size") >= floor
    items = groups.groupBy(
        F.when(alone, F.col("__one")).alias("__one"), F.when(alone, F.col("__two")).alias("__two"),
        F.when(~alone, _bundle(F.col("__two"))).alias("__bundle"),
    ).agg(F.sum("__size").alias("__size")).collect()  # at most shards * SHARE + 4 * TIER rows
    placed = schedule([(r["__size"], (r["__bundle"] is None, r["__one"] or 0, r["__two"] or 0, r["__bundle"] or 0)) for r in items], shards)
    large = spark.createDataFrame([(k[1], k[2], s) for k, s in placed.items() if k[0]], "__one long, __two long, __large int")
    small = spark.createDataFrame([(k[3], s) for k, s in placed.items() if not k[0]], "__bundle int, __small int")
    ranges = 64 + rows // RANGE_ROWS
    put = (
        docs.withColumns({"size": size, "text_crc32": F.coalesce(F.crc32("text"), F.lit(0)).cast("long"),
                          "__one": one, "__two": two, "__bundle": _bundle(two),
                          "__range": F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(ranges))})
        .join(F.broadcast(large), ["__one", "__two"], "left")  # both lists are bounded, see above
        .join(F.broadcast(small), "__bundle", "left")
        .withColumn("shard", F.coalesce("__large", "__small"))
    )
    counts = put.groupBy("shard", "__range").agg(F.count(F.lit(1)).alias("__rows"))
    before = W.partitionBy("shard").orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("shard", "__range", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    inside = W.partitionBy("shard", "__range").orderBy("doc_id", "text_crc32", "size")
    return (
        put.join(starts, ["shard", "__range"])
        .withColumn("slot", (F.col("__start") + F.row_number().over(inside) - 1).cast("long"))
        .select(*docs.columns, "size", "text_crc32", "shard", "slot")
    )
