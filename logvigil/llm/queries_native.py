"""Queries that are DataFrame functions throughout: shards, url filters, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logvigil.llm import mixing, shards, urls
from logvigil.llm.registry import query
from logvigil.llm.tables import read
from logvigil.session import scratch_dir, written

SHARDS = 8
URL_RULES = [
    urls.Rule("allow", "org", "/"), urls.Rule("block", "example.org", "/es/"), urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"), urls.Rule("block", "com", "/de/"),
]


@query("op3_virtual_slots")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards of nearly equal size: the first map, edited once the bytes of each slot are known."""
    listed = written(shards.records(read(spark, sf_dir, "documents")))
    path = scratch_dir(spark)
    start = shards.first_map(SHARDS)
    shards.store_map(spark, path, 1, start)
    shards.store_map(spark, path, 2, shards.rebalanced(start, shards.slot_bytes(listed), SHARDS))
    return shards.placed(listed, shards.load_map(spark, path)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot", "map_version",
    )


@query("op5_url_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, fixed rule and verdict of each page."""
    return urls.filtered(read(spark, sf_dir, "pages"), URL_RULES)


@query("op10_pfair_mix")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each document in the mix."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mixed(docs)
