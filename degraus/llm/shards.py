"""Shards of nearly equal bytes by longest-processing-time scheduling; equal texts stay together.

Groups are the sets of equal texts. A group that alone weighs at least 1/``GRAIN`` of a shard is an item of its own;
there can be no more than ``shards * GRAIN`` of them. The others are dealt by digest into ``shards * GRAIN`` bins, each
an item. Items, sorted by size, go to the least-loaded shard through a heap on the driver, so what it holds is bounded
by ``2 * shards * GRAIN`` rows at any input size, and the loads end within the largest item of each other.

Slots are numbered without one task seeing a whole shard: rows are counted per (shard, part), the counts are summed up
over the parts, and rows are numbered inside their part.

Defined cases: null counts as a text of its own with size 1 and the checksum of the empty text, apart from empty texts;
repeated rows get a slot each; a null id sorts first; an empty table gives an empty result. Only the id and text columns
are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from degraus.session import stored

GRAIN = 512
PARTS = 256


def longest_first(items: Iterable[tuple[int, int]], shards: int) -> dict[int, int]:
    """(item, size) -> shard: largest first, each to the least-loaded shard; ties to the smaller item and shard."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for item, size in sorted(items, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        placed[item] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def shard_by_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8, grain: int = GRAIN
) -> DataFrame:
    """Per row: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard`` (null under this law)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.when(F.col(text_col).isNull(), F.lit("null")).otherwise(F.sha2(text, 256))
    sized = stored(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            digest.alias("digest"),
        ),
        "shard-rows",
    )
    bins = shards * grain
    groups = stored(
        sized.groupBy("digest").agg(F.sum("size").alias("weight"))
        .withColumn("bin", F.pmod(F.xxhash64("digest"), F.lit(bins)).cast("int")),
        "shard-groups",
    )
    total = groups.agg(F.sum("weight")).first()[0] or 0
    # At most ``bins`` groups reach 1/bins of the total, for together they weigh no more than all.
    is_large = F.col("weight") * bins >= total
    binned = groups.where(~is_large).groupBy("bin").agg(F.sum("weight").alias("weight")).collect()
    alone = groups.where(is_large).select("digest", "weight").orderBy(F.desc("weight"), "digest").collect()
    placed = longest_first(
        [(row["bin"], row["weight"]) for row in binned] + [(bins + i, row["weight"]) for i, row in enumerate(alone)],
        shards,
    )
    of_bin = spark.createDataFrame(
        [(row["bin"], placed[row["bin"]]) for row in binned], "bin int, bin_shard int"
    )
    of_group = spark.createDataFrame(
        [(row["digest"], placed[bins + i]) for i, row in enumerate(alone)], "digest string, own_shard int"
    )
    placed_rows = stored(
        sized.withColumn("bin", F.pmod(F.xxhash64("digest"), F.lit(bins)).cast("int"))
        .join(F.broadcast(of_group), "digest", "left")
        .join(F.broadcast(of_bin), "bin", "left")
        .select(
            "id", "size", "text_crc32",
            F.coalesce("own_shard", "bin_shard").alias("shard"),
            F.pmod(F.xxhash64("id", "text_crc32"), F.lit(PARTS)).cast("int").alias("part"),
        ),
        "shard-placed",
    )
    # shards * PARTS rows at most.
    counts = placed_rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "part").orderBy("id", "text_crc32", "size")
    return (
        placed_rows.withColumn("place", F.row_number().over(inside))
        .join(F.broadcast(starts), ["shard", "part"])
        .select(
            F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("start") + F.col("place") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
