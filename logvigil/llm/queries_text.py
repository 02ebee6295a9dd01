"""Queries on single texts: tokens, quality, toxicity."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logvigil.llm import bpe, noise, quality
from logvigil.llm.registry import query
from logvigil.llm.tables import crc_share, read

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@query("op1_byte_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of the token ids of each document, and digest of what they decode to."""
    return bpe.round_trips(read(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


@query("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of each document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.quality_model(docs, read(spark, sf_dir, "labels"))
    return quality.ruled(docs, model).select("doc_id", *quality.BASE, "base_failed", "kept", "quality_score")


@query("op9_quality_pu")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each document; every fifth label (by checksum) is held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(crc_share("doc_id", 5) == 0, F.lit(False))
    model = quality.pu_model(docs, read(spark, sf_dir, "labels"), ~held_out)
    rows = quality.scored(docs, model).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
    return rows.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of each document; every third label (by checksum) is held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(crc_share("doc_id", 3) == 1, F.lit(False))
    model = noise.detector(docs, read(spark, sf_dir, "labels"), ~held_out)
    rows = noise.scored(docs, model).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
    return rows.select("doc_id", held_out.alias("held_out"), "score", "predicted")
