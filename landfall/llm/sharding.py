"""Sharding of groups that must stay together, by longest processing time (operator 2)."""

import heapq

from pyspark.sql import DataFrame, Window, functions as F

from landfall.llm.common import PARTS
from landfall.workspace import written

# A bundle of small groups holds about this fraction of a shard's even share, so the
# scheduler sees at most a few tens of thousands of items, whatever the number of groups.
BUNDLES_PER_SHARD = 1024
# The last bundles of each bin are this many times finer, to even out the rest.
FINE = 16


def longest_first(sizes: list[tuple[int, tuple]], shards: int) -> dict[tuple, int]:
    """Give items, longest first, to the least-loaded shard; ties by item, then by shard."""
    loads = [(0, shard) for shard in range(shards)]
    placed = {}
    for size, item in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(loads)
        placed[item] = shard
        heapq.heappush(loads, (load + size, shard))
    return placed


def bundles(groups: DataFrame, grain: float) -> DataFrame:
    """Add bin, kind and bundle to groups with a ``bytes`` size.

    A group of at least ``grain`` bytes is a bundle of its own. Smaller ones are
    dealt to bins by hash and cut, largest first, into stretches of about
    ``grain`` bytes, the smallest groups of a bin into finer ones.
    """
    small = F.col("bytes") < F.lit(grain)
    split = groups.withColumn("bin", F.pmod(F.xxhash64("group"), F.lit(PARTS)).cast("int")).withColumn(
        "kind", F.when(small, F.lit(1)).otherwise(F.lit(0))
    )
    order = Window.partitionBy("bin", "kind").orderBy(F.col("bytes").desc(), "group")
    before = F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("bytes")
    total = F.sum("bytes").over(Window.partitionBy("bin", "kind"))
    fine = F.lit(grain / FINE)
    coarse = F.floor(before / F.lit(grain))
    last = total - before <= F.lit(grain)
    cut = F.when(last, -1 - F.floor((total - before) / fine)).otherwise(coarse)
    bundle = F.when(F.col("kind") == 1, cut).otherwise(F.row_number().over(order)).cast("long")
    return split.withColumn("bundle", bundle)


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Put every row into one of ``shards`` shards of near equal bytes, equal texts together.

    ``docs`` needs doc_id and text; other columns are ignored. Returns doc_id,
    size (UTF-8 bytes plus 1; null counts as empty), text_crc32, shard and slot,
    gapless from 0 in each shard. Null and empty texts form one group. Repeated
    rows each get a slot. A group larger than a shard's even share fills a shard
    alone. An empty table gives no rows.

    Group sizes are summed before they are scheduled; groups far smaller than a
    shard are scheduled in bundles, so the heap works on a bounded number of items.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = written(spark, docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("group"),
    ), "sizes")
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    grain = max(1.0, total / (shards * BUNDLES_PER_SHARD))
    bundled = written(spark, bundles(groups, grain), "bundles")
    # At most shards * BUNDLES_PER_SHARD large groups, twice as many bundles, and FINE + 1 more for each bin.
    key = ["bin", "kind", "bundle"]
    items = bundled.groupBy(*key).agg(F.sum("bytes").cast("long").alias("bytes")).collect()
    placed = longest_first([(r["bytes"], (r["bin"], r["kind"], r["bundle"])) for r in items], shards)
    plan = spark.createDataFrame([(*k, s) for k, s in placed.items()], "bin int, kind int, bundle long, shard int")
    homes = bundled.join(F.broadcast(plan), key).select("group", "shard")
    part = F.pmod(F.xxhash64("doc_id", "size"), F.lit(PARTS)).cast("int")
    sharded = written(spark, rows.join(homes, "group").select("doc_id", "size", "text_crc32", "shard", part.alias("part")), "shards")
    # shards * PARTS rows.
    counts = sharded.groupBy("shard", "part").count()
    before = F.coalesce(F.sum("count").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("shard", "part", before.alias("start"))
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")) - 1
    return sharded.withColumn("place", place).join(F.broadcast(starts), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("place")).cast("long").alias("slot")
    )
