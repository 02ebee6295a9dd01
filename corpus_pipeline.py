"""A corpus pipeline: each stage works on all that the one before kept.

Quality rules reject documents; of near-duplicates one stays; byte strings that repeat are cut out of the
texts; the documents are put in the order of the mix, which the files keep; their tokens are counted.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logvigil.llm import bpe, minhash, mixing, quality, suffixes
from logvigil.llm.queries_text import RANKS
from logvigil.llm.tables import read
from logvigil.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A passage to cut is a run of bytes, covered by strings of this length that repeat, that touches this many words. Fifty words are rarely
#: shorter than the strings; a shorter run that repeats, such as a line of a license, stays.
PASSAGE, PASSAGE_WORDS = suffixes.Depth(whole=240, start=60), 50


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the classifier; it learns from the labels of documents that came in."""
    model = quality.quality_model(docs, read(spark, sf_dir, "labels"))
    return quality.ruled(docs, model).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 percent of its five-word shingles, whatever its id: ids may be null or repeat."""
    return minhash.deduplicated(docs, one_per_key=False)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that repeat (PASSAGE, PASSAGE_WORDS); n_chars counts what is left."""
    cut = suffixes.cleaned(docs, PASSAGE, keep_text=True, least_words=PASSAGE_WORDS).withColumn("text", F.col("kept_text")).withColumn("n_chars", F.length("kept_text").cast("long"))
    return cut.select(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: file by file, and row by row in each file."""
    return mixing.mixed(docs).orderBy("mix_slot", "mix_row").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of the tokens of each document that is left."""
    return bpe.round_trips(docs, RANKS, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_strings),
    ("mixing_to_weights", mixed_sources),
    ("byte_bpe", tokens),
]

#: Learned scores and a byte-level search: no SQL gives these rows, so tests compare them with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again as the next one's input."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = scratch_dir(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
