"""Sharding over fixed virtual slots.

Records are hashed into thousands of slots, bytes are added up per slot, and a versioned table maps
slots to shards. Rebalancing edits that table, never the hash. The number of slots is a constant, so
the table of slots is the one thing that visits the driver. Only DataFrame operations on rows.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalis.llm import common

SLOTS = 4096
SHARDS = 16


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """(key, size, text_crc32, virtual_slot) per row: UTF-8 bytes plus 1, the text's crc32, the hashed slot.

    A null text has size 1 and the crc32 of the empty text. Key and text decide the slot together, so
    neither a hot key nor a group of equal texts fills one slot; only fully equal rows share theirs.
    """
    crc = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    rows = docs.select(
        F.col(key).alias("key"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"), crc.alias("text_crc32"),
    )
    return rows.withColumn("virtual_slot", F.pmod(F.xxhash64("key", "text_crc32"), F.lit(slots)).cast("int"))


def slot_bytes(rows: DataFrame) -> DataFrame:
    """Bytes of every slot that holds rows."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"))


def _loads(sizes: DataFrame, slots: int) -> list[int]:
    """Bytes by slot on the driver; the table has one row per slot at most, ``slots`` being a constant."""
    loads = [0] * slots
    for slot, size in sizes.select("virtual_slot", "bytes").collect():
        loads[slot] = size
    return loads


def first_map(sizes: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> list[int]:
    """Shard by slot: the largest slot first, each to the shard with the fewest bytes so far."""
    loads, heap, chosen = _loads(sizes, slots), [(0, s) for s in range(shards)], [0] * slots
    for slot in sorted(range(slots), key=lambda i: (-loads[i], i)):
        held, shard = heapq.heappop(heap)
        chosen[slot] = shard
        heapq.heappush(heap, (held + loads[slot], shard))
    return chosen


def edited_map(sizes: DataFrame, chosen: list[int], shards: int) -> list[int]:
    """The map for ``shards`` shards: slots leave shards above the mean for the least filled one, if that evens them out.

    With one shard more, slots move into the new shard only, as it stays the least filled one. With fewer shards, the slots of
    those that go, the largest first, move to the least filled one that stays.
    """
    loads, chosen = _loads(sizes, len(chosen)), list(chosen)
    held = [0] * shards
    for slot, shard in enumerate(chosen):
        if shard < shards:
            held[shard] += loads[slot]
    order = sorted(range(len(chosen)), key=lambda i: (-loads[i], i))
    for slot in order:
        if chosen[slot] >= shards:
            chosen[slot] = held.index(min(held))
            held[chosen[slot]] += loads[slot]
    mean = sum(held) / shards
    for slot in order:
        least, shard = held.index(min(held)), chosen[slot]
        if loads[slot] and held[shard] - loads[slot] >= mean and held[least] + loads[slot] <= mean:
            held[shard] -= loads[slot]
            held[least] += loads[slot]
            chosen[slot] = least
    return chosen


def shard_of(slot: Column, chosen: list[int]) -> Column:
    listed = F.split(F.lit(",".join(map(str, chosen))), ",").cast("array<int>")
    return F.get(listed, slot)


def map_table(spark: SparkSession, chosen: list[int], version: int) -> DataFrame:
    """(version, virtual_slot, shard), as stored."""
    slots = spark.range(len(chosen)).select(F.col("id").cast("int").alias("virtual_slot"))
    return slots.select(F.lit(version).alias("version"), "virtual_slot", shard_of(F.col("virtual_slot"), chosen).alias("shard"))


def store_map(spark: SparkSession, chosen: list[int], path: str, version: int) -> None:
    """Adds a version; a version that is there is written again, the others stay."""
    table = map_table(spark, chosen, version).drop("version").coalesce(1)
    table.write.mode("overwrite").parquet(f"{path.rstrip('/')}/version={version}")


def load_map(spark: SparkSession, path: str, version: int | None = None) -> list[int]:
    """The map of a version, the latest by default; as many rows as there are slots."""
    table = spark.read.parquet(path)
    if version is None:
        version = table.agg(F.max("version")).head()[0]
    rows = table.where(F.col("version") == version).select("virtual_slot", "shard").collect()
    return [shard for _, shard in sorted(map(tuple, rows))]


def shards(docs: DataFrame, path: str, shards: int = SHARDS, slots: int = SLOTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's shard by stored bytes, and its place in the shard: (key, size, text_crc32, virtual_slot, shard, slot).

    The map is stored under ``path`` as version 1. Places run from 0 in every shard, by virtual slot, key
    and crc32. An empty table gives no rows and a map all the same.
    """
    spark = docs.sparkSession
    rows = common.written(sized(docs, key, text, slots))
    store_map(spark, first_map(slot_bytes(rows), shards, slots), path, 1)
    chosen = load_map(spark, path)
    rows = rows.withColumn("shard", shard_of(F.col("virtual_slot"), chosen))
    placed = common.place_in_order(rows, ["virtual_slot", "key", "text_crc32"], within="shard")
    return placed.withColumnRenamed("_place", "slot")
