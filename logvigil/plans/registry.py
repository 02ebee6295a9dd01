"""The query registry: name -> Spark query, and its check SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logvigil.plans.oracle import sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}
DIGITS = 4
NUDGE = 1e-9  # moves exact halves (means of decimals) off the rounding edge, as in the SQL


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to four places, so that summation order cannot show."""
    return df.select(
        *[F.round(F.col(c) + NUDGE, DIGITS).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes]
    )


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    """Register a query; its result is rounded. ``check`` is SQL over the steps of the oracle module."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        if check is not None:
            CHECKS[name] = sql(check)
        return fn

    return register
