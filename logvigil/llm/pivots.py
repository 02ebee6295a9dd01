"""Near-duplicate vectors by a pivot-permutation index.

A vector is described by its nearest reference points (pivots) in order. Inverted lists hold, for each
pivot, the vectors that name it; vectors of a list that share enough pivots are candidates, and the cosine
in double precision decides. A list is worked on in blocks of arrays, and only per-vector counts and a
spanning forest of the links leave a task, so a dense group never becomes rows of pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logvigil.llm import graph
from logvigil.llm.tables import Shared
from logvigil.session import written

SPARE_DRAWS = 4  # times as many vectors are hashed below the bound as are drawn
BLOCK = 1024  # vectors of a list that one task compares with as many others


@dataclass(frozen=True)
class Index:
    """Pivots grow with the square root of the vectors, so lists and the search for pivots grow alike."""

    pivots_per_root: float = 4.0
    least_pivots: int = 64
    most_pivots: int = 8192  # a bounded sample of the vectors
    pool: int = 2  # vectors drawn for each pivot wanted, from which the pivots are chosen
    prefix: int = 16  # nearest pivots that describe a vector
    shared: int = 2  # pivots that candidates have in common

    def pivots(self, vectors: int) -> int:
        return int(min(self.most_pivots, max(self.least_pivots, self.pivots_per_root * math.sqrt(vectors))))


def unit_rows(vectors: pa.Array) -> list[np.ndarray | None]:
    """Each vector in double precision; None if it is null, empty, zero or holds a null or non-finite component.

    It is scaled by a power of two, which changes no cosine, so that its largest component lies from 0.5 to 1 and no product leaves the range of a
    double.
    """
    rows: list[np.ndarray | None] = []
    for value in vectors.to_pylist():
        if not value or None in value:
            rows.append(None)
            continue
        row = np.array(value, np.float64)
        largest = np.abs(row).max()
        rows.append(np.ldexp(row, -np.frexp(largest)[1]) if np.isfinite(largest) and largest > 0 else None)
    return rows


def described(rows: DataFrame, pivots: np.ndarray, prefix: int, vector: str, label: str) -> DataFrame:
    """key, label, node (class of equal label and vector; null for rows that link with nothing), vector, order of pivots."""
    shared = Shared(rows.sparkSession, np.asarray, pivots)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = shared.get()
        for part in parts:
            labels, nodes, orders = part.column("label").to_pylist(), [], []
            vectors = unit_rows(part.column("vector"))
            vectors = [None if name is None else v for v, name in zip(vectors, labels)]
            same = [i for i, v in enumerate(vectors) if v is not None and len(points) and len(v) == points.shape[1]]
            near = {}
            if same:
                block = np.stack([vectors[i] for i in same])
                closeness = (block / np.linalg.norm(block, axis=1, keepdims=True)) @ points.T
                width = min(prefix, len(points))
                order = np.argsort(-closeness, axis=1, kind="stable")[:, :width] if len(points) <= width else None
                if order is None:
                    top = np.argpartition(-closeness, width - 1, axis=1)[:, :width]
                    order = np.take_along_axis(top, np.argsort(-np.take_along_axis(closeness, top, 1), axis=1, kind="stable"), 1)
                near = dict(zip(same, order.tolist()))
            for i, (v, name) in enumerate(zip(vectors, labels)):
                nodes.append(None if v is None else hashlib.blake2b(repr(name).encode() + b"\0" + v.tobytes(), digest_size=16).digest())
                # vectors of another length than the pivots share one list
                orders.append(None if v is None else near.get(i, [-len(v)]))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("key"), part.column("label"), pa.array(nodes, pa.binary()),
                    pa.array([None if v is None else v.tolist() for v in vectors], pa.list_(pa.float64())),
                    pa.array(orders, pa.list_(pa.int32())),
                ],
                names=["key", "label", "node", "vector", "pivots"],
            )

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(batches, f"key {kinds['key']}, label {kinds['label']}, node binary, vector array<double>, pivots array<int>")


def spread(points: np.ndarray, wanted: int, least: float) -> np.ndarray:
    """Up to ``wanted`` of some unit vectors, farthest first: each is the one farthest from those before it.

    It ends when every vector has a cosine of ``least`` or more with a chosen one, so no two chosen ones could be linked. A dense group
    thus gets few pivots however many vectors it has, and its members name the same ones.
    """
    chosen, nearest = [0], points @ points[0]
    while len(chosen) < min(wanted, len(points)):
        far = int(nearest.argmin())
        if nearest[far] >= least:
            break
        chosen.append(far)
        np.maximum(nearest, points @ points[far], out=nearest)
    return points[chosen]


def chosen_pivots(rows: DataFrame, index: Index, least: float) -> np.ndarray:
    """Unit vectors to serve as pivots, spread over a bounded sample that is taken by a hash of the vector: the same in every run."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            good = [v.tolist() for v in unit_rows(part.column(0)) if v is not None]
            yield pa.RecordBatch.from_arrays([pa.array(good, pa.list_(pa.float64()))], names=["vector"])

    valid = rows.select("vector").mapInArrow(batches, "vector array<double>")
    n, length = valid.agg(F.count("*"), F.mode(F.size("vector"), deterministic=True)).head()
    if not n:
        return np.zeros((0, 0))
    wanted = index.pivots(n)
    hashed = valid.where(F.size("vector") == length).select(F.xxhash64("vector").alias("h"), "vector")

    def drawn(share: float) -> list:
        """The vectors with the smallest hashes. Those above a share of all hashes are dropped before the exchange."""
        low = hashed.where(F.col("h") <= F.lit(int(-(1 << 63) + share * ((1 << 64) - 1)))) if share < 1 else hashed
        sample = low.groupBy("h").agg(F.first("vector").alias("vector")).orderBy("h").limit(index.pool * wanted)
        return [r["vector"] for r in sample.collect()]  # a bounded number

    few = drawn(min(1.0, SPARE_DRAWS * index.pool * wanted / n))
    if len(few) < index.pool * wanted:  # many copies: the share held too few different vectors
        few = drawn(1.0)
    points = np.array(few, np.float64)
    return spread(points / np.linalg.norm(points, axis=1, keepdims=True), wanted, least)


def compare(rows: pd.DataFrame, pivot: int, diagonal: bool, least: float, shared: int) -> pd.DataFrame:
    """Links inside a block pair of one list: per class how many vectors it links with (n), and a forest of links (b).

    A pair is judged in the list of the smallest pivot that both name, and only there.
    """
    first = rows if diagonal else rows[rows["own"]]
    second = rows if diagonal else rows[~rows["own"]]
    if not len(first) or not len(second):
        return pd.DataFrame({"a": [], "b": [], "n": []})
    known, at = np.unique(np.concatenate([np.concatenate(rows_["pivots"].tolist()) for rows_ in (first, second)]), return_inverse=True)

    def marks(part: pd.DataFrame, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(part), len(known)), np.float32)
        out[np.repeat(np.arange(len(part)), part["pivots"].map(len)), at] = 1
        return out

    split = int(first["pivots"].map(len).sum())
    m1, m2 = marks(first, at[:split]), marks(second, at[split:])
    lower = known < pivot
    wanted = min(shared, min(first["pivots"].map(len).min(), second["pivots"].map(len).min()))
    candidate = ((m1 @ m2.T) >= wanted) & ((m1[:, lower] @ m2[:, lower].T) == 0)
    v1, v2 = np.stack(first["vector"].tolist()), np.stack(second["vector"].tolist())
    cosine = (v1 @ v2.T) / (np.linalg.norm(v1, axis=1)[:, None] * np.linalg.norm(v2, axis=1)[None])
    link = candidate & (cosine >= least)
    if diagonal:
        np.fill_diagonal(link, False)
    counts = [(first["node"], link @ second["n"].to_numpy(np.int64))]
    if not diagonal:
        counts.append((second["node"], link.T @ first["n"].to_numpy(np.int64)))
    a, b = np.arange(len(first)), np.arange(len(second)) if diagonal else np.arange(len(first), len(first) + len(second))
    names = first["node"].tolist() + ([] if diagonal else second["node"].tolist())
    far = np.int64(1 << 60)
    while True:  # the smallest position reachable, on both sides
        to_a = np.minimum(a, np.where(link, b[None], far).min(1))
        to_b = np.minimum(b, np.where(link, to_a[:, None], far).min(0))
        if diagonal:
            to_a = to_b = np.minimum(to_a, to_b)
        if (to_a == a).all() and (to_b == b).all():
            break
        a, b = to_a, to_b
    place = a if diagonal else np.concatenate([a, b])
    tree = [(names[i], names[p], None) for i, p in enumerate(place) if p != i]
    found = [(node, None, int(n)) for nodes, ns in counts for node, n in zip(nodes, ns) if n]
    return pd.DataFrame(found + tree, columns=["a", "b", "n"])


def classed(
    rows: DataFrame, least: float = 0.93, index: Index = Index(), key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """Per row: ``key``, n_links (other rows of equal label with cosine >= ``least``) and component_id (smallest key reachable).

    Rows with a null label, and vectors that are null, empty, zero or hold null or non-finite components, have no links and are
    their own component. Equal vectors of a label are one class, which stands for all of them. Vectors of different length are never linked.
    """
    source = rows.select(F.col(key).alias("key"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    points = chosen_pivots(source, index, least)
    described_rows = written(described(source, points, index.prefix, "vector", "label"))
    classes = written(
        described_rows.where("node IS NOT NULL").groupBy("node").agg(
            F.min("key").alias("least"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("vector").alias("vector"),
            F.first("pivots").alias("pivots"),
        )
    )
    postings = classes.select("node", "n", "label", "vector", "pivots", F.explode("pivots").alias("pivot"))
    lists = postings.groupBy("label", "pivot").agg(F.count("*").alias("size")).where("size > 1")
    lists = lists.select("label", "pivot", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    placed = postings.join(lists, ["label", "pivot"]).withColumn("mine", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    meeting = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocks = meeting.select(
        "label", "pivot", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        (F.col("mine") <= F.col("other")).alias("own"), "node", "n", "vector", "pivots",
    )
    shared = index.shared

    def task(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return compare(part, key[1], key[2] == key[3], least, shared)

    found = written(blocks.groupBy("label", "pivot", "i", "j").applyInPandas(task, "a binary, b binary, n long"))
    links = found.where("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("links"))
    roots = graph.components(found.where("b IS NOT NULL").select("a", "b"))
    known = classes.select("node", "least", (F.col("n") - 1).alias("copies")).join(links.withColumnRenamed("a", "node"), "node", "left").join(
        roots, "node", "left"
    ).withColumn("root", F.coalesce("root", "node"))
    smallest = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(smallest, "root").select("node", (F.col("copies") + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    return described_rows.select("key", "node").join(known, "node", "left").select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component_id")).alias("component_id"),
    )
