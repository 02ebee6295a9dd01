"""Importance resampling towards a target: a weighted draw without replacement, as one exact top-k.

Texts are bags of hashed runs of words. A bucket's gain is the log ratio of its share in the target and in the corpus; a
document's weight is the sum of the gains of its runs, gathered from one array. Adding a Gumbel variate that its id decides
turns the draw into taking the highest scores. Which these are is found by quickselect on the composite key (score, id): each
pass draws a few random keys as pivots, counts the rows below, at and above each, and goes on in the one gap that holds the
k-th row. Only winners are ever sorted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logvigil.llm import wordbytes
from logvigil.llm.tables import Shared, small_batches, unused
from logvigil.session import written

PIVOTS = 31  # keys drawn in a pass of the selection
SORT_ROWS = 50_000  # about as many winners are sorted by one task
MOST_SORTS = 4096
NEW = ("n_words", "n_features", "weight", "score", "rank")


@dataclass(frozen=True)
class Params:
    """Runs of 1 to ``longest`` words; ``percent`` of the documents with at least ``least_words`` words are drawn."""

    buckets: int = 10_000
    longest: int = 3
    least_words: int = 20
    percent: int = 5
    seed: int = 42


def features(words: wordbytes.Words, params: Params) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per length of a run: the bucket of each run, and the text that it is in."""
    text, size = words.texts(), words.ends - words.starts
    crc = own = words.crcs()
    found = []
    for length in range(1, params.longest + 1):
        n = max(0, len(own) - length + 1)
        if length > 1:
            crc = wordbytes.joined(wordbytes.spaced(crc[:n]), own[length - 1 :], size[length - 1 :])
        whole = text[:n] == text[length - 1 :]
        found.append(((crc[whole] % np.uint32(params.buckets)).astype(np.int64), text[:n][whole]))
    return found


def bucket_counts(texts: DataFrame, params: Params = Params(), text: str = "text") -> np.ndarray:
    """How many runs of all texts fall into each bucket. Each task adds up its own; the driver gets one row a bucket."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(params.buckets, np.int64)
        for part in parts:
            for _, raw, offsets in wordbytes.chunks(part, text):
                for at, _ in features(wordbytes.Words(raw, offsets, wordbytes.LETTERS, lower=True), params):
                    total += np.bincount(at, minlength=params.buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["bucket", "n"])

    sums = texts.select(text).mapInArrow(batches, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(params.buckets, np.int64)
    for row in sums.collect():  # at most one row a bucket
        counts[row["bucket"]] = row["n"]
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's share in the target and in the corpus, one added to each count; rounded down."""
    more, less = int(corpus.sum()) + len(corpus), int(target.sum()) + len(target)
    ratio = lambda t, s: float((t + 1) * more) / float((s + 1) * less)
    return np.array([math.floor(1000 * math.log(ratio(t, s))) for t, s in zip(target.tolist(), corpus.tolist())], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, params: Params = Params(), text: str = "text") -> DataFrame:
    """``docs`` without the text, with n_words, n_features and weight."""
    rest = [c for c in docs.columns if c != text]
    schema = StructType([*docs.select(*[F.col(f"`{c}`") for c in rest]).schema, *StructType.fromDDL("n_words long, n_features long, weight long")])
    shared = Shared(docs.sparkSession, np.asarray, gain)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain_of = shared.get()
        for part in parts:
            for few, raw, offsets in wordbytes.chunks(part, text):
                words = wordbytes.Words(raw, offsets, wordbytes.LETTERS, lower=True)
                n, total = np.zeros((2, few.num_rows), np.int64)
                for at, owner in features(words, params):
                    upto = np.searchsorted(owner, np.arange(few.num_rows + 1))
                    n += np.diff(upto)
                    total += np.diff(np.concatenate([[0], np.cumsum(gain_of[at])])[upto])
                columns = [few.column(c) for c in rest]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(c, pa.int64()) for c in (words.counts, n, total)]], names=schema.names)

    return docs.mapInArrow(batches, schema)


def gumbel(key: str, seed: int) -> Column:
    """Thousandths of a Gumbel variate made of the digest of seed and id; a null id counts as an empty one."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _literal(row: Row, kinds: dict[str, str]) -> Column:
    return F.struct(*[F.lit(row[c]).cast(kind).alias(c) for c, kind in kinds.items()])


def kth_row(keys: DataFrame, k: int, pivots: int = PIVOTS) -> Column | None:
    """The k-th smallest row (from 1) of ``keys`` as a struct; all rows differ. None if there are fewer. Nulls come first.

    ``keys`` is read twice in each pass, so it should be a table; the driver gets at most ``pivots`` keys and their counts.
    """
    kinds = dict(keys.dtypes)
    key = F.struct(*[F.col(f"`{c}`") for c in kinds])
    inside = keys.select(key.alias("key"))
    rank = k
    while rank >= 1:
        drawn = inside.orderBy(F.rand()).limit(pivots).orderBy("key").collect()
        if not drawn:
            return None
        edges = F.array(*[_literal(row["key"], kinds) for row in drawn])
        below = F.size(F.filter(edges, lambda edge: edge < F.col("key"))).alias("below")
        split = inside.select(below, F.array_contains(edges, F.col("key")).alias("at")).groupBy("below", "at").agg(F.count("*").alias("n"))
        counts = {(row["below"], row["at"]): row["n"] for row in split.collect()}
        for gap in range(len(drawn) + 1):
            between = counts.get((gap, False), 0)
            if rank <= between:
                low = F.col("key") > _literal(drawn[gap - 1]["key"], kinds) if gap else F.lit(True)
                high = F.col("key") < _literal(drawn[gap]["key"], kinds) if gap < len(drawn) else F.lit(True)
                inside = inside.where(low & high)
                break
            rank -= between
            if gap < len(drawn):
                if rank == 1:  # the pivot itself; no other row equals it
                    return _literal(drawn[gap]["key"], kinds)
                rank -= 1
        else:
            return None
    return None


def ranked(winners: DataFrame, order: list[str], n: int, out: str = "rank") -> DataFrame:
    """``winners`` (about n rows) with their place in the order, from 1: ranges sorted one by one, and the counts of earlier ranges."""
    ranges = max(1, min(MOST_SORTS, math.ceil(n / SORT_ROWS)))
    part, start = unused(winners, "range"), unused(winners, "start")
    dealt = written(winners.repartitionByRange(ranges, *order).withColumn(part, F.spark_partition_id()))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = dealt.groupBy(part).agg(F.count("*").alias(start)).withColumn(start, F.coalesce(F.sum(start).over(earlier), F.lit(0)))
    at = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    return dealt.withColumn(out, at).join(F.broadcast(starts), part).withColumn(out, (F.col(out) + F.col(start)).cast("long")).drop(part, start)


def resampled(docs: DataFrame, target: DataFrame, params: Params = Params(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the text, with n_words, n_features, weight, score and rank (null for rows that are not drawn).

    ``target`` holds the texts of the wanted distribution. Drawn are percent * N // 100 rows, N being the rows with at least
    ``least_words`` words; equal scores go to the smaller key, null keys first, then to the row with fewer features; rows equal in
    these too are drawn in any order. Null and empty texts have no features and weight 0; an empty target or corpus is no error:
    all counts are smoothed by one. Repeated rows are rows like others. Columns with the new names are replaced.
    """
    docs = docs.drop(*[c for c in NEW if c not in (key, text)])
    source = target.select(F.col(text).alias("text"))
    place = unused(docs, "place")
    with small_batches(docs.sparkSession):
        gain = gains(bucket_counts(docs.select(F.col(text).alias("text")), params), bucket_counts(source, params))
        rows = weighted(docs, gain, params, text).withColumn("score", F.col("weight") + gumbel(key, params.seed))
        rows = written(rows.withColumn(place, F.monotonically_increasing_id()))
    able = F.col("n_words") >= params.least_words
    wanted = rows.where(able).count() * params.percent // 100
    order = {"score": -F.col("score"), "key": F.col(key), "n_features": F.col("n_features"), "place": F.col(place)}
    last = kth_row(rows.where(able).select(*[c.alias(n) for n, c in order.items()]), wanted)
    if last is None:
        return rows.withColumn("rank", F.lit(None).cast("long")).drop(place)
    wins = able & (F.struct(*[c.alias(n) for n, c in order.items()]) <= last)
    first = unused(docs, "first")
    winners = ranked(rows.where(wins).withColumn(first, -F.col("score")), [first, key, "n_features", place], wanted).drop(first)
    losers = rows.where(~wins).withColumn("rank", F.lit(None).cast("long"))
    return winners.unionByName(losers).drop(place)
