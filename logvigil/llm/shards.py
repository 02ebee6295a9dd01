"""Sharding by fixed virtual slots.

Records are hashed into thousands of slots that never change. Which shard a slot lives in stands in a
small versioned map; rebalancing appends a version that moves as few slots as it can. Only the map
(one row a slot) ever comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 4096
MAP = "version int, slot int, shard int"


def text_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text plus 1; a null text has none."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 1


def text_crc(text: str = "text") -> Column:
    return F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))


COPIES = 1000  # of a record that repeats, listed together


def records(docs: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """Per record: ``key``, size, text_crc32, virtual_slot. Texts are not shuffled; other columns are dropped.

    The text takes part in the slot, so that records without a key, or under one key, spread. Records that are equal in key, size and
    checksum are counted, before the exchange, and listed again under numbers that take part too: so they spread over all slots.
    """
    kinds = docs.groupBy(F.col(key), text_size(text).alias("size"), text_crc(text).alias("text_crc32")).agg(F.count("*").alias("n"))
    parts = kinds.withColumn("part", F.expr(f"explode(sequence(0L, (n - 1) div {COPIES}))")).repartition(key, "size", "text_crc32", "part")
    first, last = F.col("part") * COPIES, F.least(F.col("n"), (F.col("part") + 1) * COPIES) - 1
    each = parts.withColumn("copy", F.explode(F.sequence(first, last)))
    plain, numbered = F.xxhash64(F.col(key), F.col("text_crc32")), F.xxhash64(F.col(key), F.col("text_crc32"), F.col("copy"))
    slot = F.pmod(F.when(F.col("copy") == 0, plain).otherwise(numbered), F.lit(slots)).cast("int")
    return each.select(key, "size", "text_crc32", slot.alias("virtual_slot"))


def slot_bytes(listed: DataFrame) -> dict[int, int]:
    """Bytes per slot that has any, of :func:`records`: summed before the exchange, one row a slot on the driver."""
    sums = listed.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"))
    return {row["virtual_slot"]: row["bytes"] for row in sums.collect()}


def first_map(shards: int, slots: int = SLOTS) -> dict[int, int]:
    """The map before anything is known of the data: slots dealt in turn."""
    return {slot: slot % shards for slot in range(slots)}


def rebalanced(slot_map: dict[int, int], load: dict[int, int], shards: int) -> dict[int, int]:
    """The map with slots moved until no move makes the two shards it concerns more equal.

    Shards that the map does not name are new: they are filled, and no other shard takes any. Slots of shards beyond
    ``shards`` move out first. Each step takes the heaviest shard and moves the slot that comes nearest to half its lead
    over the lightest taker.
    """
    moved = dict(slot_map)
    total = [0] * shards
    takers = sorted(set(range(shards)) - set(moved.values())) or list(range(shards))
    for slot, shard in moved.items():
        if shard < shards:
            total[shard] += load.get(slot, 0)
    for slot in sorted((s for s, shard in moved.items() if shard >= shards), key=lambda s: (-load.get(s, 0), s)):
        moved[slot] = min(takers, key=lambda k: (total[k], k))
        total[moved[slot]] += load.get(slot, 0)
    while True:
        heavy, light = max(range(shards), key=lambda k: (total[k], -k)), min(takers, key=lambda k: (total[k], k))
        lead = total[heavy] - total[light]
        fits = [s for s, shard in moved.items() if shard == heavy and 0 < load.get(s, 0) < lead]
        if not fits:
            return moved
        best = min(fits, key=lambda s: (abs(lead - 2 * load[s]), s))
        moved[best] = light
        total[heavy] -= load[best]
        total[light] += load[best]


def store_map(spark: SparkSession, path: str, version: int, slot_map: dict[int, int]) -> None:
    """Append a version to the map stored at ``path``."""
    rows = [(version, slot, shard) for slot, shard in sorted(slot_map.items())]
    spark.createDataFrame(rows, MAP).coalesce(1).write.mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of a stored map, the newest by default: slot, shard, version."""
    stored = spark.read.schema(MAP).parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).head()[0]
    return stored.where(F.col("version") == version)


def placed(listed: DataFrame, slot_map: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per record (a table of :func:`records`): ``key``, size, text_crc32, shard, slot, virtual_slot, map_version.

    ``slot`` counts the records of a shard from 0 without gaps, by virtual slot, key and checksum. Records
    are counted within their virtual slot, so the largest sort holds one slot; the start of each virtual
    slot comes from the counts. Null keys and texts are records like others;
    records that repeat are spread over the virtual slots.
    """
    places = F.broadcast(  # one row a slot
        slot_map.select(F.col("slot").alias("virtual_slot"), "shard", F.col("version").alias("map_version"))
    )
    counts = listed.groupBy("virtual_slot").agg(F.count("*").alias("n")).join(places, "virtual_slot")
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.broadcast(counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    within = Window.partitionBy("virtual_slot").orderBy(F.col(key), "text_crc32", "size")
    numbered = listed.withColumn("at", F.row_number().over(within) - 1)
    return numbered.join(starts, "virtual_slot").select(
        key, "size", "text_crc32", "shard", (F.col("start") + F.col("at")).cast("long").alias("slot"), "virtual_slot", "map_version"
    )
