"""Near-duplicates by b-bit MinHash: bands find candidates, packed low bits estimate, full sets confirm.

Texts with the same set of shingles are one class, found by a 128-bit digest of the set; all later steps
work on classes. Within a band bucket each class is only compared with the bucket's first class (a star),
so a bucket never becomes pairs. That settles most groups. Where a bucket still holds more than one
component, its classes outside the largest component meet all its classes, in blocks of arrays: first their
packed sketches, each pair in the first bucket that it shares, then the texts of those classes that have a
likely partner there. So no link that a bucket could show is lost, and texts go only where sketches agree.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logvigil.llm import graph, grams
from logvigil.llm.tables import slices, small_batches, unused
from logvigil.session import discard, written

MINIMA = 128
BITS = 4  # kept of each minimum
PER_LONG = 64 // BITS
MISS = 1e-6  # chance that the bands miss a pair at the threshold
SIGMAS = 6  # an estimate this many standard deviations below the threshold is dropped without a look at the sets
X_BLOCK, Y_BLOCK = 256, 1024  # classes compared with each other by one task
SKETCH = "node binary, n_shingles long, low_bits array<long>, bands array<long>"


@dataclass(frozen=True)
class Params:
    """Shingles of ``words`` words; linked are sets with percent * union <= 100 * intersection."""

    words: int = 5
    percent: int = 80

    @property
    def rows(self) -> int:
        """Minima of a band: as many as keep the chance of a miss at the threshold below MISS."""
        return max(r for r in range(1, 9) if (1 - (self.percent / 100) ** r) ** (MINIMA // r) <= MISS or r == 1)

    @property
    def least_estimate(self) -> float:
        share = self.percent / 100
        match = share + (1 - share) / 2**BITS
        return share - SIGMAS * (match * (1 - match) / MINIMA) ** 0.5 / (1 - 2**-BITS)


def _seeds(n: int, salt: int) -> np.ndarray:
    return grams.mix(np.arange(1, n + 1, dtype=np.uint64) * grams.M3 + np.uint64(salt))


FACTOR, ADDEND = _seeds(MINIMA, 11) | np.uint64(1), _seeds(MINIMA, 12)


def shingle_sets(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, ascending, and the bounds of the texts.

    A-Z count as lower case. A text with fewer words than ``width`` has its whole row of words as one shingle, one without words none.
    """
    words = grams.Chars(texts).words(lower=True)
    hashes, at = words.windows(width)
    text = words.text_of(at)
    short = np.flatnonzero((words.counts > 0) & (words.counts < width))
    if len(short):
        whole = []
        for i in short:
            value = np.array([words.counts[i]], np.uint64)
            for h in words.hashes[words.bounds[i] : words.bounds[i + 1]]:
                value = grams.mix(value * grams.M3 + h)
            whole.append(value)
        hashes, text = np.concatenate([hashes, *whole]), np.concatenate([text, short])
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes, text = hashes[new], text[new]
    return hashes, np.searchsorted(text, np.arange(len(texts) + 1))


def set_digests(hashes: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    """16 bytes for each set that tell it from any other; None for an empty one."""
    sums = []
    for salt in (grams.M1, grams.M2):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(grams.mix(hashes ^ salt), dtype=np.uint64)])[bounds]
        sums.append(grams.mix(np.diff(total) + np.diff(bounds).astype(np.uint64)))
    raw = np.stack(sums, 1).astype("<u8").tobytes()
    return [raw[16 * i : 16 * i + 16] if n else None for i, n in enumerate(np.diff(bounds))]


def minima(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each set that is not empty, the MINIMA smallest values under as many orders."""
    starts = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(starts), MINIMA), np.uint64)
    if len(starts):
        for k in range(MINIMA):
            out[:, k] = np.minimum.reduceat(hashes * FACTOR[k] + ADDEND[k], starts)
    return out


def sketches(docs: DataFrame, params: Params, text: str = "text") -> DataFrame:
    """``docs`` without the text, with the columns of SKETCH: class, set size, packed low bits, band keys.

    Texts without words, and null texts, have a null class and no bands.
    """
    rest = [c for c in docs.columns if c != text]
    schema = StructType([*docs.select(*[F.col(f"`{c}`") for c in rest]).schema, *StructType.fromDDL(SKETCH)])
    rows, width = params.rows, params.words

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            texts = [t or "" for t in part.column(text).to_pylist()]
            nodes, sizes, low, band, filled = [], [], [], [], []
            for start, stop in grams.chunks(texts):
                hashes, bounds = shingle_sets(texts[start:stop], width)
                nodes += set_digests(hashes, bounds)
                sizes.append(np.diff(bounds))
                filled.append(np.diff(bounds) > 0)
                least = minima(hashes, bounds)
                bits = (least & np.uint64((1 << BITS) - 1)).reshape(len(least), MINIMA // PER_LONG, PER_LONG)
                low.append((bits << (np.arange(PER_LONG, dtype=np.uint64) * np.uint64(BITS))).sum(2, dtype=np.uint64))
                value = np.zeros((len(least), MINIMA // rows), np.uint64) + np.arange(MINIMA // rows, dtype=np.uint64)
                for r in range(rows):
                    value = grams.mix(value * grams.M3 + least[:, r : rows * (MINIMA // rows) : rows])
                band.append(value)
            cat = lambda found, kind: np.concatenate(found) if found else np.zeros(0, kind)
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(c) for c in rest], pa.array(nodes, pa.binary()), pa.array(cat(sizes, np.int64).astype(np.int64)),
                    _lists(cat(filled, bool), low), _lists(cat(filled, bool), band),
                ],
                names=[f.name for f in schema],
            )

    return docs.mapInArrow(batches, schema)


def _lists(filled: np.ndarray, values: list[np.ndarray]) -> pa.Array:
    """A list for each filled row, an empty one for the others."""
    flat = np.concatenate([v.ravel() for v in values]) if values else np.zeros(0, np.uint64)
    width = len(flat) // max(1, int(filled.sum()))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(filled * width)]), pa.int32()), pa.array(flat.view(np.int64)))


def estimate(a: str = "low_a", b: str = "low_b") -> Column:
    """Estimated similarity of two packed sketches, less the matches that chance gives low bits.

    The low bits of a minimum differ if any of their XORed bits is set: these are folded onto one bit each and counted.
    """

    def differing(x: Column) -> Column:
        folded = x
        for shift in (1, 2):
            folded = folded.bitwiseOR(F.shiftrightunsigned(folded, shift))
        return F.bit_count(folded.bitwiseAND(F.lit(0x1111111111111111)))

    differ = F.aggregate(F.zip_with(F.col(a), F.col(b), lambda x, y: differing(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return ((1 - differ / MINIMA) - 2.0**-BITS) / (1 - 2.0**-BITS)


def shared_buckets(classes: DataFrame) -> DataFrame:
    """Buckets with several classes: bucket, node, and the first class of the bucket."""
    members = classes.select("node", F.explode("bands").alias("bucket"))
    first = members.groupBy("bucket").agg(F.min("node").alias("first"), F.max("node").alias("z")).where("first <> z").select("bucket", "first")
    return members.join(first, "bucket")


def unpacked(texts: Iterable[bytes]) -> list[str]:
    return [zstandard.decompress(t).decode("utf-8", "surrogatepass") for t in texts]


def linked(pairs: DataFrame, params: Params) -> DataFrame:
    """Of pairs with compressed texts z_a, z_b, those whose full sets confirm the link: a, b."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            a, b = unpacked(part.column("z_a").to_pylist()), unpacked(part.column("z_b").to_pylist())
            good = np.zeros(len(a), bool)
            for low, high in grams.chunks([x + y for x, y in zip(a, b)], grams.CHUNK):
                hashes, bounds = shingle_sets(a[low:high] + b[low:high], params.words)
                n = high - low
                pair = np.repeat(np.arange(2 * n) % n, np.diff(bounds))
                order = np.lexsort((hashes, pair))
                same = (hashes[order][1:] == hashes[order][:-1]) & (pair[order][1:] == pair[order][:-1])
                common = np.bincount(pair[order][1:][same], minlength=n)
                sizes = np.diff(bounds)
                good[low:high] = 100 * common >= params.percent * (sizes[:n] + sizes[n:] - common)
            keep = pa.array(good)
            yield pa.RecordBatch.from_arrays([part.column("a").filter(keep), part.column("b").filter(keep)], names=["a", "b"])

    return pairs.select("a", "b", "z_a", "z_b").mapInArrow(batches, "a binary, b binary")


def cross_links(blocks: DataFrame, params: Params) -> DataFrame:
    """Links between different components inside blocks (columns block, side, comp, z), as component pairs a, b.

    In a block each class of side x meets each one of side y; a task holds X_BLOCK and Y_BLOCK of them.
    """

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        x, y = rows[rows["side"] == "x"], rows[rows["side"] == "y"]
        found: set[tuple[bytes, bytes]] = set()
        if len(x) and len(y):
            hashes, bounds = shingle_sets(unpacked(y["z"]), params.words)
            own, own_bounds = shingle_sets(unpacked(x["z"]), params.words)
            known = np.unique(hashes)
            at = np.searchsorted(known, hashes)
            comp_y, sizes, mark = y["comp"].to_numpy(), np.diff(bounds), np.zeros(len(known) + 1, np.int64)
            for i, comp in enumerate(x["comp"]):
                mine = own[own_bounds[i] : own_bounds[i + 1]]
                place = np.searchsorted(known, mine)
                hit = place[known[np.minimum(place, len(known) - 1)] == mine]
                mark[hit] = 1
                common = np.add.reduceat(mark[at], bounds[:-1])  # classes are never empty
                mark[hit] = 0
                good = 100 * common >= params.percent * (len(mine) + sizes - common)
                found |= {(comp, other) for other in comp_y[good] if other != comp}
        return pd.DataFrame(list(found), columns=["a", "b"])

    return blocks.groupBy("block").applyInPandas(compare, "a binary, b binary")


def likely_members(blocks: DataFrame, params: Params) -> DataFrame:
    """Of the classes in blocks (bucket, xb, yb, side, node, comp, low_bits, bands) those with a likely partner on the other side: one in
    another component whose sketch agrees, and with which this is the first bucket shared.

    Most blocks are a few rows, so a task goes through its sorted blocks one by one, without a call for each.
    """
    kept = ["bucket", "xb", "yb", "side", "node", "comp"]
    kinds = dict(blocks.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in kept)
    # what an estimate at the least needs in minima that differ, at most
    most = int(MINIMA * (1 - ((1 - 2.0**-BITS) * params.least_estimate + 2.0**-BITS)) + 1e-9)
    fold = np.uint64(0x1111111111111111)

    def partners(is_x: np.ndarray, comp: np.ndarray, low: np.ndarray, bands: np.ndarray, bucket: np.uint64) -> np.ndarray:
        """Which rows of one block have a partner."""
        y, found = np.flatnonzero(~is_x), np.zeros(len(is_x), bool)
        for i in np.flatnonzero(is_x):
            apart = low[y] ^ low[i]
            for shift in (1, 2):
                apart |= apart >> np.uint64(shift)
            at = y[(np.bitwise_count(apart & fold).sum(1) <= most) & (comp[y] != comp[i])]
            at = at[bands[i][(bands[at] == bands[i]).argmax(1)] == bucket]
            if len(at):
                found[i] = found[at] = True
        return found

    def judged(part: pa.RecordBatch) -> pa.RecordBatch:
        """Whole blocks in a row."""
        names = {c: i for i, c in enumerate(part.schema.names)}
        bucket = part.column(names["bucket"]).to_numpy()
        place = np.stack([bucket, part.column(names["xb"]).to_numpy(), part.column(names["yb"]).to_numpy()])
        is_x = np.array([s == "x" for s in part.column(names["side"]).to_pylist()])
        comp = part.column(names["comp"]).dictionary_encode().indices.to_numpy()
        low, bands = (part.column(names[c]).flatten().to_numpy().view(np.uint64).reshape(part.num_rows, -1) for c in ("low_bits", "bands"))
        cuts = [0, *(np.flatnonzero((place[:, 1:] != place[:, :-1]).any(0)) + 1).tolist(), part.num_rows]
        found = np.zeros(part.num_rows, bool)
        for start, stop in zip(cuts, cuts[1:]):
            rows = slice(start, stop)
            found[rows] = partners(is_x[rows], comp[rows], low[rows], bands[rows], bucket.view(np.uint64)[start])
        return part.select(kept).filter(pa.array(found))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the rows of a block that may go on in the next batch
        for part in parts:
            if not part.num_rows:
                continue
            last = [part.column(c)[part.num_rows - 1].as_py() for c in ("bucket", "xb", "yb")]
            same = np.ones(part.num_rows, bool)
            for c, value in zip(("bucket", "xb", "yb"), last):
                same &= part.column(c).to_numpy() == value
            begin = int(same.argmax())  # rows are sorted, so the last block is a stretch at the end
            before = part.slice(0, begin)
            first = [held[-1].column(c)[0].as_py() for c in ("bucket", "xb", "yb")] if held else None
            if begin or (held and first != last):
                whole = pa.Table.from_batches([*held, before]).combine_chunks().to_batches()
                yield from map(judged, whole)
                held = []
            held.append(part.slice(begin))
        if held:
            yield from map(judged, pa.Table.from_batches(held).combine_chunks().to_batches())

    order = ["bucket", "xb", "yb"]
    return blocks.repartition(*order).sortWithinPartitions(*order).mapInArrow(batches, schema)


def _sides(members: DataFrame) -> DataFrame:
    """The blocks of each bucket with more than one component: its classes as side x and side y."""
    sizes = members.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    buckets = sizes.groupBy("bucket").agg(
        F.sum("n").alias("size"), F.max(F.struct("n", "comp")).alias("top"), F.count("*").alias("comps")
    ).where("comps > 1").select(
        "bucket", F.col("top.comp").alias("top"), F.ceil((F.col("size") - F.col("top.n")) / X_BLOCK).cast("int").alias("x_blocks"),
        F.ceil(F.col("size") / Y_BLOCK).cast("int").alias("y_blocks"),
    )
    open_members = members.join(buckets, "bucket")
    h = F.xxhash64("node")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    x = open_members.where("comp <> top").withColumn("xb", F.pmod(h, F.col("x_blocks")).cast("int")).withColumn("yb", each("y_blocks"))
    y = open_members.withColumn("yb", F.pmod(h, F.col("y_blocks")).cast("int")).withColumn("xb", each("x_blocks"))
    columns = ["bucket", "xb", "yb", "node", "comp"]
    return x.select(*columns, F.lit("x").alias("side")).unionByName(y.select(*columns, F.lit("y").alias("side")))


def classed(docs: DataFrame, params: Params = Params(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``key``, n_shingles, node (its class) and component_id.

    component_id is the smallest key in the component. Rows without words have a null node and their own key as component. Null keys
    take part; a component of null keys alone has a null component_id. Repeated rows are of one class. Other columns are dropped.
    """
    with small_batches(docs.sparkSession):
        rows, known = _components(docs, params, key, text)
    return rows.select("key", "n_shingles", "node").join(known.select("node", "component_id"), "node", "left").select(
        F.col("key").alias(key), "n_shingles", "node", F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component_id")).alias("component_id")
    )


def _components(docs: DataFrame, params: Params, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The sketched rows, and of each class: node, least (its smallest key), final (the root of its component), component_id.

    Unlike component_id, the root tells components apart whose smallest keys are null or equal.
    """
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = written(sketches(source, params))
    has_words = rows.where("node IS NOT NULL")
    classes = written(
        has_words.groupBy("node").agg(F.min("key").alias("least"), F.first("low_bits").alias("low_bits"), F.first("bands").alias("bands"))
    )
    shared = written(shared_buckets(classes))
    pairs = written(shared.where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct())
    low = classes.select("node", "low_bits")
    sketched = pairs.join(low.select(F.col("node").alias("a"), F.col("low_bits").alias("low_a")), "a").join(
        low.select(F.col("node").alias("b"), F.col("low_bits").alias("low_b")), "b"
    )
    likely = sketched.where(estimate() >= params.least_estimate).select("a", "b")
    needed = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    texts = written(_class_texts(source, needed, params))
    with_texts = likely.join(texts.select(F.col("node").alias("a"), F.col("z").alias("z_a")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("z").alias("z_b")), "b"
    )
    roots = written(graph.components(linked(with_texts, params)))
    members = written(shared.join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("comp")))
    sides = _sides(members).join(classes.select("node", "low_bits", "bands"), "node")
    likely_sides = written(likely_members(sides, params))
    blocks = likely_sides.join(texts, "node").select(F.struct("bucket", "xb", "yb").alias("block"), "side", "comp", "z")
    across = graph.components(cross_links(blocks, params)).select(F.col("node").alias("comp"), F.col("root").alias("joined"))
    final = classes.select("node", "least").join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("comp"))
    labelled = final.join(across, "comp", "left").select("node", "least", F.coalesce("joined", "comp").alias("final"))
    smallest = labelled.groupBy("final").agg(F.min("least").alias("component_id"))
    known = written(labelled.join(smallest, "final").select("node", "least", "final", "component_id"))
    discard(classes, shared, pairs, texts, roots, members, likely_sides)
    return rows, known


def _class_texts(source: DataFrame, needed: DataFrame, params: Params) -> DataFrame:
    """One text for each class that is needed, compressed before it is shuffled. Texts are digested again instead of being stored."""
    return with_class(source.select("text"), params, "node", packed="z").join(needed, "node").groupBy("node").agg(F.min("z").alias("z"))


def with_class(docs: DataFrame, params: Params, node: str, text: str = "text", packed: str | None = None) -> DataFrame:
    """``docs`` with the digest of each text's shingle set, null without words. With ``packed`` the text is replaced by its
    compressed form under that name."""
    rest = [c for c in docs.columns if not (packed and c == text)]
    schema = docs.select(*[F.col(f"`{c}`") for c in rest]).schema.add(node, "binary")
    schema = schema.add(packed, "binary") if packed else schema

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for part in slices(parts):
            texts, found = [t or "" for t in part.column(text).to_pylist()], []
            for low, high in grams.chunks(texts):
                found += set_digests(*shingle_sets(texts[low:high], params.words))
            columns = [*[part.column(c) for c in rest], pa.array(found, pa.binary())]
            if packed:
                columns.append(pa.array([squeeze.compress(t.encode("utf-8", "surrogatepass")) for t in texts], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    return docs.mapInArrow(batches, schema)


def deduplicated(
    docs: DataFrame, params: Params = Params(), key: str = "doc_id", text: str = "text", one_per_key: bool = True
) -> DataFrame:
    """One row of each group of near-duplicates, with all columns: one with the group's smallest key.

    Rows without words are no duplicates and all stay. Groups are told apart by their texts, so rows with null keys stay if their texts
    differ. With ``one_per_key`` a key names one document: of groups with the same smallest key one stays.
    """
    with small_batches(docs.sparkSession):
        _, known = _components(docs, params, key, text)
    node, spare = unused(docs, "node"), unused(docs, "keep")
    smallest = F.col("least").eqNullSafe(F.col("component_id"))
    group = F.when(F.col("component_id").isNull(), F.col("final")) if one_per_key else F.col("final")
    keep = known.groupBy("component_id", group.alias("group")).agg(F.min(F.when(smallest, F.col("node"))).alias("n"))
    keep = keep.select(F.col("n").alias(node), F.col("component_id").alias(spare))
    rows = with_class(docs, params, node, text)
    first = rows.join(keep, node).where(F.col(f"`{key}`").eqNullSafe(F.col(spare))).dropDuplicates([node])
    return first.drop(node, spare).unionByName(rows.where(F.col(node).isNull()).drop(node))
