"""Ranked lexical search by sequential reads of impact-sorted postings, without random access (NRA).

The index is split by documents: a block holds some documents and the postings of their terms, sorted by impact (what the term adds
to the document's score). A block is read from its highest impact down. At any time a document has a lower score, the sum of the impacts
read, and an upper one, which adds for each term not yet read the most that it can still bring: the impact read last, or the term's own
maximum. Documents whose upper score lies below the k-th best lower score, in this block or in those that the task has read before, are
out. Reading goes on until nothing is open: who is among the best, in which order, and with which score. Each task hands on its k best
documents of each query, and Spark merges them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logvigil.llm import wordbytes
from logvigil.llm.tables import Shared, small_batches
from logvigil.session import discard, written

BLOCK_DOCS, BLOCK_POSTINGS = 2048, 1 << 19  # of a block, at most (a single text may have more postings)
CELLS = 1 << 21  # pairs of query and document whose scores a task holds at once
GROUP_ITEMS, GROUP_TERMS = 1 << 14, 1 << 21  # queries, and terms in them, that go to the tasks together
MOST_TERMS = 1 << 22  # with more distinct query terms, all terms of documents are indexed
FIRST_PART = 16  # the first look at the scores comes after this part of a block, later ones after twice as much each
# fixed values of the score
UNIT, SATURATION, FLAT, LENGTH = 1_000_000_000, 8, 10, 90


@dataclass
class Terms:
    """Term counts of some texts: words of each, and the distinct terms by text, with how often they occur."""

    n: np.ndarray
    text: np.ndarray
    term: np.ndarray
    tf: np.ndarray


def terms_of(raw: np.ndarray, offsets: np.ndarray, known: np.ndarray | None = None) -> Terms:
    """Terms are hashes of words; with ``known`` (ascending) only these are listed."""
    words = wordbytes.Words(raw, offsets, wordbytes.LETTERS, lower=True)
    term, text = words.hashes().view(np.int64), words.texts()
    if known is not None:
        good = np.zeros(len(term), bool)
        if len(known):
            good = known[np.minimum(np.searchsorted(known, term), len(known) - 1)] == term
        term, text = term[good], text[good]
    order = np.lexsort((term, text))
    term, text = term[order], text[order]
    first = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (text[1:] != text[:-1])])[: len(term)])
    return Terms(words.counts, text[first], term[first], np.diff(np.append(first, len(term))))


def query_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """One row per query: item (its key), terms (distinct)."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for few, raw, offsets in wordbytes.chunks(part, "text"):
                found = terms_of(raw, offsets)
                upto = np.searchsorted(found.text, np.arange(few.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(found.term, pa.int64()))
                yield pa.RecordBatch.from_arrays([few.column("item"), lists], names=["item", "terms"])

    source = items.select(F.col(key).alias("item"), F.col(text).alias("text"))
    return source.mapInArrow(batches, f"item {dict(source.dtypes)['item']}, terms array<long>")


def forward_index(docs: DataFrame, known: np.ndarray | None) -> DataFrame:
    """Per document (columns key, text): block, slot in it, key, n (its words), terms and tf. Blocks are consecutive documents of one task."""
    schema = f"block long, slot int, key {dict(docs.dtypes)['key']}, n long, terms array<long>, tf array<int>"
    shared = Shared(docs.sparkSession, lambda kept: kept, known)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, slot, held = TaskContext.get().partitionId() << 32, 0, 0
        for part in parts:
            for few, raw, offsets in wordbytes.chunks(part, "text"):
                found = terms_of(raw, offsets, shared.get())
                upto = np.searchsorted(found.text, np.arange(few.num_rows + 1))
                places = []
                for size in np.diff(upto).tolist():
                    if slot and (slot == BLOCK_DOCS or held + size > BLOCK_POSTINGS):
                        block, slot, held = block + 1, 0, 0
                    places.append((block, slot))
                    slot, held = slot + 1, held + size
                blocks, slots = zip(*places)
                ends = pa.array(upto, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(blocks, pa.int64()), pa.array(slots, pa.int32()), few.column("key"), pa.array(found.n, pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(found.term, pa.int64())),
                        pa.ListArray.from_arrays(ends, pa.array(found.tf.astype(np.int32))),
                    ],
                    names=["block", "slot", "key", "n", "terms", "tf"],
                )

    return docs.mapInArrow(batches, schema)


class Queries:
    """Some queries as arrays: the queries of each term, the terms of each query, the most that a term can add."""

    def __init__(self, counts: np.ndarray, term: np.ndarray, weight: np.ndarray):
        self.counts = counts  # terms of each query
        self.terms, self.of = np.unique(term, return_inverse=True)
        self.most = np.zeros(len(self.terms), np.int64)
        self.most[self.of] = weight * (UNIT // 1000)
        self.bounds = np.concatenate([[0], np.cumsum(counts)])

    def slices(self, docs: int) -> Iterator[tuple[int, int]]:
        step = max(1, CELLS // max(1, docs))
        for low in range(0, len(self.counts), step):
            yield low, min(len(self.counts), low + step)

    def lists(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """The queries low to high of each term (numbered from low), and where the list of each term begins."""
        of = self.of[self.bounds[low] : self.bounds[high]]
        query = np.repeat(np.arange(high - low), self.counts[low:high])
        order = np.argsort(of, kind="stable")
        return query[order], np.searchsorted(of[order], np.arange(len(self.terms) + 1))

    def unread(self, low: int, high: int, limit: int) -> np.ndarray:
        """Per query, the most that its terms can add together if no unread impact exceeds ``limit``."""
        caps = np.minimum(self.most[self.of[self.bounds[low] : self.bounds[high]]], limit)
        return np.diff(np.concatenate([[0], np.cumsum(caps)])[self.bounds[low : high + 1] - self.bounds[low]])


def read_block(
    queries: Queries, low: int, high: int, docs: int, term: np.ndarray, slot: np.ndarray, impact: np.ndarray, least: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Query (from low), document and exact score of all that can be among the k best of a block, and how many postings were read.

    Postings come by falling impact. ``least`` is a score per query that a document has to reach.
    """
    listed, begin = queries.lists(low, high)
    counts = queries.counts[low:high, None]
    lower, seen = np.zeros((high - low, docs), np.int64), np.zeros((high - low, docs), np.int32)
    alive, wanted = np.ones(docs, bool), np.ones(high - low, bool)
    done, step = 0, max(1024, len(impact) // FIRST_PART)
    while True:
        stop = min(len(impact), done + step)
        part = np.arange(done, stop)
        part = part[alive[slot[part]]]
        order = part[np.argsort(term[part], kind="stable")]
        cuts = np.flatnonzero(np.diff(term[order])) + 1
        for group in np.split(order, cuts) if len(order) else []:
            number = term[group[0]]
            who = listed[begin[number] : begin[number + 1]]
            who = who[wanted[who]]
            if len(who):
                at = np.ix_(who, slot[group])
                lower[at] += impact[group]
                seen[at] += 1
        done, step = stop, 2 * step
        limit = int(impact[done]) if done < len(impact) else 0
        upper = lower + (queries.unread(low, high, limit)[:, None] - seen * np.int64(limit))
        best = np.partition(lower, docs - k, axis=1)[:, docs - k] if docs > k else np.zeros(high - low, np.int64)
        able = (upper >= np.maximum(best, least)[:, None]) & (upper > 0)
        unsure = able & (seen < counts) & (upper > lower)
        if done == len(impact) or not unsure.any():
            query, doc = np.nonzero(able & (lower > 0))
            return query + low, doc, lower[query, doc], done
        alive, wanted = able.any(axis=0), unsure.any(axis=1)


class Best:
    """The k best documents of each query so far."""

    def __init__(self, queries: int, k: int, kind: pa.DataType):
        self.k = k
        self.rows = pa.table({"query": pa.array([], pa.int64()), "score": pa.array([], pa.int64()), "key": pa.array([], kind)})
        self.least = np.zeros(queries, np.int64)

    def add(self, query: np.ndarray, score: np.ndarray, key: pa.Array) -> None:
        if not len(query):
            return
        new = pa.table({"query": pa.array(query, pa.int64()), "score": pa.array(score, pa.int64()), "key": key})
        rows = pa.concat_tables([self.rows, new]).sort_by([("query", "ascending"), ("score", "descending"), ("key", "ascending")])  # nulls last
        of = rows.column("query").to_numpy()
        place = np.arange(len(of)) - np.searchsorted(of, of)
        self.rows = rows.filter(pa.array(place < self.k)).combine_chunks()
        last = place == self.k - 1
        self.least[of[last]] = rows.column("score").to_numpy()[last]


def searched(index: DataFrame, queries: Shared, numbers: list[int], k: int) -> DataFrame:
    """The k best documents that each task finds for each query: query, score, key.

    ``index`` has the rows of a block together: documents first (key, without term), then postings by falling impact.
    """
    kind = dict(index.dtypes)["key"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, best = queries.get(), None

        def read(rows: list[pa.RecordBatch]) -> None:
            block = pa.Table.from_batches(rows)
            is_doc = block.column("term").is_null()
            keys = block.filter(is_doc).sort_by("slot").column("key").combine_chunks()
            postings = block.filter(block.column("term").is_valid())
            term, slot, impact = (postings.column(c).to_numpy() for c in ("term", "slot", "impact"))
            at = np.minimum(np.searchsorted(known.terms, term), max(0, len(known.terms) - 1))
            mine = known.terms[at] == term if len(known.terms) else np.zeros(len(term), bool)
            for low, high in known.slices(len(keys)):
                query, doc, score, _ = read_block(known, low, high, len(keys), at[mine], slot[mine], impact[mine], best.least[low:high], k)
                best.add(query, score, keys.take(pa.array(doc)))

        held: list[pa.RecordBatch] = []
        for part in parts:
            best = best or Best(len(known.counts), k, part.schema.field("key").type)
            block = part.column("block").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for low, high in zip(edges, edges[1:]):
                if high == low:
                    continue
                if held and held[-1].column("block")[0].as_py() != block[low]:
                    read(held)
                    held = []
                held.append(part.slice(low, high - low))
        if held:
            read(held)
        if best is not None and len(best.rows):
            number = pa.array(np.array(numbers, np.int64)[best.rows.column("query").to_numpy()], pa.int64())
            found = best.rows.set_column(0, "query", number)
            yield from found.to_batches()

    return index.mapInArrow(batches, f"query long, score long, key {kind}")


def top_documents(
    docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", item: str = "item_id", text: str = "text", item_text: str = "text"
) -> DataFrame:
    """The ``k`` best documents of each query with a score above 0: ``item``, rank (from 1), ``key``, score.

    A document's score is the sum over the query's distinct terms of weight * (10**9 * tf div (1000 * tf + 8 * m)), where the weight falls with
    the documents that hold the term and m grows with the document's length. Equal scores go by ascending key, null keys last; rows equal
    in key and score are ranked in any order. Each row of ``items`` is a query of its own, also if its key is null or repeats. Null
    and empty texts have no terms: such queries give no rows, such documents are never found. Other columns are dropped.
    """
    spark = docs.sparkSession
    asked = written(query_terms(items, item, item_text).withColumn("query", F.monotonically_increasing_id()))
    size = asked.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("terms")).first()
    distinct = written(asked.select(F.explode("terms").alias("term")).distinct())
    known = None
    if distinct.count() <= MOST_TERMS:
        known = np.sort(np.array([row["term"] for row in distinct.collect()], np.int64))
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    with small_batches(spark):
        forward = written(forward_index(source, known))
    corpus = forward.agg(F.count_if(F.col("n") > 0).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    n, words = corpus["n"], max(1, corpus["words"])
    held = forward.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * n + 2)) / (2 * F.col("df") + 1))).cast("long").alias("w")
    weights = written(distinct.join(held, "term").select("term", weight))
    groups = max(1, math.ceil(size["n"] / GROUP_ITEMS), math.ceil(size["terms"] / GROUP_TERMS))
    best = None
    for group in range(groups):
        mine = asked.where(F.pmod(F.xxhash64("query"), F.lit(groups)) == group)
        found = written(_best_of(spark, forward, weights, mine, n, words, k, groups > 1))
        best = found if best is None else best.unionByName(found)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("key").asc_nulls_last()))
    top = best.withColumn("rank", rank).where(F.col("rank") <= k)
    out = top.join(asked.select("query", "item"), "query").select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")
    discard(forward, distinct)
    return out


def _best_of(spark, forward: DataFrame, weights: DataFrame, asked: DataFrame, n: int, words: int, k: int, some: bool) -> DataFrame:
    """What each task finds for a group of queries, which go to all tasks as arrays of at most about GROUP_TERMS terms."""
    pairs = asked.select("query", F.explode("terms").alias("term")).join(weights.where("w > 0"), "term").toPandas()
    pairs = pairs.sort_values(["query", "term"], kind="stable")
    numbers, counts = np.unique(pairs["query"].to_numpy(np.int64), return_counts=True)
    queries = Shared(spark, Queries, counts, pairs["term"].to_numpy(np.int64), pairs["w"].to_numpy(np.int64))
    if some:
        weights = weights.join(asked.select(F.explode("terms").alias("term")).distinct(), "term", "left_semi")
    m = (F.lit(FLAT) + F.expr(f"({LENGTH} * n * {n}L) div {words}L")).cast("long")
    each = forward.select("block", "slot", m.alias("m"), F.explode(F.arrays_zip("terms", "tf")).alias("p")).select("block", "slot", "m", "p.*")
    impact = F.expr(f"w * (({UNIT}L * tf) div (1000L * tf + {SATURATION}L * m))")
    postings = each.join(weights.where("w > 0"), each["terms"] == weights["term"]).select("block", "slot", "term", impact.alias("impact"))
    heads = forward.select("block", "slot", "key")
    rows = heads.unionByName(postings, allowMissingColumns=True).select("block", "slot", "key", "term", "impact")
    index = rows.repartition("block").sortWithinPartitions("block", F.col("impact").desc_nulls_first())
    return searched(index, queries, numbers.tolist(), k)
