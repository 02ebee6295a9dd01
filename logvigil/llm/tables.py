"""Reading the corpus tables, and rows that only the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_share(key: str, parts: int) -> Column:
    """The remainder that splits labelled rows: crc32 of the key's decimal text, modulo ``parts``."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(parts))


def unused(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, so that extra columns cannot clash with working ones."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name in taken:
        name += "_"
    return name


SLICE = 1000  # rows that a task turns into Python values at once


def slices(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut into pieces of a few rows, so that memory follows these and not Spark's batch size."""
    for part in parts:
        for start in range(0, part.num_rows, SLICE):
            yield part.slice(start, SLICE)


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = SLICE) -> Iterator[None]:
    """Jobs started inside hand rows to Python in batches of at most ``rows``: with whole texts, Spark's own batches of 10,000 rows
    take a hundred megabytes on either side."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


class Shared:
    """Plain values sent to each worker once, and the object that a worker makes of them and keeps for all its tasks."""

    def __init__(self, spark: SparkSession, make: Callable[..., Any], *parts: Any):
        self.make, self.sent = make, spark.sparkContext.broadcast((parts, []))

    def get(self) -> Any:
        parts, kept = self.sent.value
        if not kept:
            kept.append(self.make(*parts))
        return kept[0]
