"""Sharding by longest-processing-time scheduling.

Rows that must stay together form a group; groups, largest first, go to the least loaded
shard through a heap. A single heap over all groups would be a single task, so the schedule is hierarchical:

1. A group of at least 1 / (shards * HEAVY) of all bytes is heavy. There are at most shards * HEAVY of
   these, whatever the data; one heap on the driver places them first.
2. The other groups are dealt by hash into chunks. In each chunk a heap places them, largest
   first, into as many bundles as there are shards; bundles of a chunk differ by less than one light group.
3. While there are over ``FAN`` chunks, the bundles of ``FAN`` chunks are scheduled again into one chunk's bundles.
4. The last bundles (at most FAN * shards) go on top of the heavy groups, again largest first.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.common import table
from webloom.scale import position_in_group
from webloom.session import cut_lineage

HEAVY = 256
CHUNK_GROUPS = 20_000
FAN = 64
SLOT_ROWS = 20_000


def longest_first(sizes: Iterable[int], loads: list[int]) -> list[int]:
    """The shard of each size: in descending order each goes to the least loaded shard. ``loads`` is updated."""
    heap = [(load, i) for i, load in enumerate(loads)]
    heapq.heapify(heap)
    sizes = list(sizes)
    chosen = [0] * len(sizes)
    for at in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        load, shard = heapq.heappop(heap)
        heapq.heappush(heap, (load + sizes[at], shard))
        chosen[at] = shard
    for load, shard in heap:
        loads[shard] = load
    return chosen


def _bundles(rows: DataFrame, chunk: str, shards: int) -> DataFrame:
    """(chunk, item, bytes, bundle) of (chunk, item, bytes): one heap per chunk."""

    def place(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("item", kind="stable").reset_index(drop=True)
        part["bundle"] = longest_first(part["bytes"].tolist(), [0] * shards)
        return part

    return rows.select(F.col(chunk).alias("chunk"), "item", "bytes").groupBy("chunk").applyInPandas(
        place, "chunk long, item string, bytes long, bundle int"
    )


def place_groups(groups: DataFrame, shards: int) -> DataFrame:
    """(item, shard) of (item string, bytes long), items distinct: the hierarchical schedule."""
    groups = cut_lineage(groups.select("item", "bytes"), "groups")
    total, count = groups.agg(F.sum("bytes"), F.count(F.lit(1))).first()
    total, loads = int(total or 0), [0] * shards
    light_below = -(-total // (shards * HEAVY)) if total else 1
    heavy = sorted(((r["bytes"], r["item"]) for r in groups.where(F.col("bytes") >= light_below).collect()), key=lambda x: (-x[0], x[1]))
    placed = list(zip([x[1] for x in heavy], longest_first([x[0] for x in heavy], loads), strict=True))

    n_chunks = count // CHUNK_GROUPS + 1
    light = groups.where(F.col("bytes") < light_below).withColumn("c", F.pmod(F.xxhash64("item"), F.lit(n_chunks)))
    # ``way`` holds for each light group the bundle it is in so far
    way = cut_lineage(_bundles(light, "c", shards), "bundles")
    here = way.select("item", "chunk", "bundle")
    sums = way.groupBy("chunk", "bundle").agg(F.sum("bytes").alias("bytes"))
    while n_chunks > FAN:
        upper = _bundles(
            sums.select(F.floor(F.col("chunk") / FAN).alias("c"), F.concat_ws("-", "chunk", "bundle").alias("item"), "bytes"), "c", shards
        )
        upper = cut_lineage(upper, "bundles")
        here = here.withColumn("name", F.concat_ws("-", "chunk", "bundle")).drop("chunk", "bundle").join(
            upper.select(F.col("item").alias("name"), "chunk", "bundle"), "name"
        ).drop("name")
        sums = upper.groupBy("chunk", "bundle").agg(F.sum("bytes").alias("bytes"))
        n_chunks = -(-n_chunks // FAN)
    last = sorted(((r["bytes"], r["chunk"], r["bundle"]) for r in sums.collect()), key=lambda x: (-x[0], x[1], x[2]))
    spots = longest_first([x[0] for x in last], loads)

    spark = groups.sparkSession
    top = spark.createDataFrame(placed, "item string, shard int")
    final = spark.createDataFrame([(c, b, s) for (_, c, b), s in zip(last, spots, strict=True)], "chunk long, bundle int, shard int")
    return here.join(final, ["chunk", "bundle"]).select("item", "shard").unionByName(top)


def shard_by_size(
    docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", group: Column | None = None, overhead: int = 16
) -> DataFrame:
    """One row per input row: (doc_id, size, text_crc32, shard, slot).

    Size is the UTF-8 bytes of the text (null: none) plus ``overhead``; shards get nearly equal
    sums. Rows with equal ``group`` (default: the text) share a shard, null like the empty text. ``slot``
    numbers the rows of a shard from 0 without gaps, in the order of a hash of the id; rows that are repeated
    whole get slots of their own. A null id is allowed. An empty table gives an empty result; shards may stay empty when there
    are fewer groups. Other columns are not read.
    """
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = cut_lineage(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(body) + overhead).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.sha2((body if group is None else group).cast("binary"), 256).alias("item"),
    ), "sized")
    groups = rows.groupBy("item").agg(F.sum("size").alias("bytes"))
    shard_of = place_groups(groups, shards)
    placed = cut_lineage(rows.join(shard_of, "item").withColumn("order", F.xxhash64("doc_id")), "placed")
    chunks = placed.count() // (shards * SLOT_ROWS) + 1
    at = F.floor((F.col("order").cast("double") / float(1 << 64) + 0.5) * chunks).cast("bigint")
    return position_in_group(placed, ["shard"], ["order", "doc_id", "item"], at, "slot").select(
        "doc_id", "size", "text_crc32", "shard", "slot"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = shard_by_size(table(spark, sf_dir, "documents"), 40)
    return got.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
