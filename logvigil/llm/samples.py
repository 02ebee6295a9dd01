"""Bounded samples of labelled and unlabelled texts, for fitting models on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS = 2000  # texts of each kind a model is fitted on, at most


def texts_of(ids: DataFrame, docs: DataFrame, rows: int = ROWS, key: str = "doc_id", text: str = "text") -> list[str]:
    """Texts of up to ``rows`` of the ids, taken by a hash of the id and returned in that order.

    Null ids are left out; a null text counts as empty; where an id stands for several texts the smallest is taken.
    """
    order = F.xxhash64(F.col(key), F.lit(7))
    few = ids.select(key).where(F.col(key).isNotNull()).distinct().orderBy(order, key).limit(rows)
    found = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(few), key)  # ``rows`` ids
    whole = found.groupBy(key).agg(F.min("text").alias("text"))
    return [row["text"] for row in whole.orderBy(order, key).collect()]


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, value: int, rows: Column | None = None, most: int = ROWS) -> list[str]:
    """Texts whose label has the value, from the label rows that ``rows`` admits. An id labelled both ways is left out."""
    admitted = labels if rows is None else labels.where(rows)
    sure = admitted.where(F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(label).alias("low"), F.max(label).alias("high"))
    return texts_of(sure.where((F.col("low") == value) & (F.col("high") == value)), docs, most)


def unlabelled_texts(docs: DataFrame, most: int = ROWS) -> list[str]:
    """Texts of any documents, whatever labels say of them."""
    return texts_of(docs, docs, most)
