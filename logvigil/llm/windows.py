"""Removal of word windows that occurred before, with a count-min sketch in front of the exact grouping.

Windows of ``width`` words are not counted one by one. The least hash of the runs of ``run`` words inside a window names its
anchor, which is the same wherever the window stands; the consecutive windows of one anchor are a range.

1. Each partition counts its anchors in a sketch; the sketches are added up. Cells only overestimate, so an anchor that stands
   at two places is always estimated at two or more.
2. The ranges of anchors estimated repeated are grouped exactly. Ranges with equal windows are one kind, whose first one (by key,
   then by place) stands for it; all the others have occurred before. Where an anchor has ranges of several kinds, the windows of
   the first range of each kind are compared one by one.

A sketch has a cell for about every fifth byte of the corpus, up to MOST_CELLS. Beyond that it lets more single windows through to the
exact grouping, which then shuffles up to one range for about seven words; results are the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logvigil.llm import wordbytes
from logvigil.llm.grams import M1, M2, M3, mix
from logvigil.llm.suffixes import least_in_windows
from logvigil.llm.tables import Shared, slices, small_batches, unused
from logvigil.session import discard, written

LEAST_CELLS, MOST_CELLS = 1 << 16, 1 << 26  # of one row of the sketch; a merged row takes a bit a cell
BYTES_A_CELL = 5
SALTS = (M1, M2)  # one row of the sketch each
BLOCK = 1 << 16  # cells shuffled together
PIECE = 1 << 18  # words looked at at once; a longer text is looked at in pieces that overlap
PLACE_BITS = 20
NEW = ("n_words", "n_removed", "kept_sha256", "kept_text")


@dataclass(frozen=True)
class Params:
    """Windows of ``width`` words with anchors of ``run`` words; ``run`` is a power of two, 2 * run <= width <= 4 * run."""

    width: int = 20
    run: int = 8


@dataclass
class Ranges:
    """Consecutive windows with the same anchor: text, first window (its first word in the text), anchor, number of windows, their hashes."""

    text: np.ndarray
    low: np.ndarray
    anchor: np.ndarray
    size: np.ndarray
    windows: np.ndarray


def _doubled(hashes: np.ndarray, offset: int) -> np.ndarray:
    n = max(0, len(hashes) - offset)
    return mix(hashes[:n] * M3 + hashes[offset:] + np.uint64(offset))


def ranges_of(words: wordbytes.Words, params: Params) -> Iterator[Ranges]:
    """The ranges of some texts; each window is in one of them."""
    hashes, text = words.hashes(), words.texts()
    mask = np.uint64((1 << PLACE_BITS) - 1)
    for start in range(0, len(hashes) - params.width + 1, PIECE):
        part = hashes[start : start + PIECE + params.width - 1]
        owner = text[start : start + len(part)]
        found, held = part, 1
        while 2 * held <= params.run:
            found, held = _doubled(found, held), 2 * held
        runs = found
        while 2 * held <= params.width:
            found, held = _doubled(found, held), 2 * held
        windows = _doubled(found, params.width - held) if held < params.width else found
        key = (runs & ~mask) | np.arange(len(runs), dtype=np.uint64)
        chosen = (least_in_windows(key, params.width - params.run + 1) & mask).astype(np.int64)
        at = np.flatnonzero(owner[: len(windows)] == owner[params.width - 1 :])
        if not len(at):
            continue
        place = chosen[at]
        new = np.ones(len(at), bool)
        new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(new)
        low = at[first]
        yield Ranges(
            owner[low], start + low - words.bounds[owner[low]], runs[place[first]], np.diff(np.append(first, len(at))), windows[at]
        )


class Sketch:
    """Counts up to two, in cells picked by two hashes of an anchor: a bit for one and a bit for two or more."""

    def __init__(self, cells: int):
        self.cells = cells
        self.once, self.twice = (np.zeros((len(SALTS), cells // 8), np.uint8) for _ in range(2))

    def at(self, anchors: np.ndarray, salt: np.uint64) -> np.ndarray:
        return mix(anchors ^ salt) & np.uint64(self.cells - 1)

    def add(self, anchors: np.ndarray) -> None:
        for row, salt in enumerate(SALTS):
            cell, n = np.unique(self.at(anchors, salt), return_counts=True)
            if len(cell):
                self.put(row, *bits(cell), *bits(cell[n > 1]))

    def put(self, row: int, byte: np.ndarray, value: np.ndarray, byte2: np.ndarray, value2: np.ndarray) -> None:
        self.twice[row, byte] |= self.once[row, byte] & value
        self.twice[row, byte2] |= value2
        self.once[row, byte] |= value

    def blocks(self) -> Iterator[tuple[int, bytes]]:
        """The parts of both rows that hold anything, compressed."""
        squeeze, size = zstandard.ZstdCompressor(level=1), min(BLOCK, self.cells) // 8
        for row in range(len(SALTS)):
            for i in range(self.cells // 8 // size):
                once, twice = (plane[row, i * size : (i + 1) * size] for plane in (self.once, self.twice))
                if once.any():
                    yield row * (self.cells // 8 // size) + i, squeeze.compress(once.tobytes() + twice.tobytes())


def bits(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending cells as bytes, each once, and the bits that are set in them."""
    byte = (cells >> np.uint64(3)).astype(np.int64)
    first = np.flatnonzero(np.diff(byte, prepend=-1))
    bit = np.uint8(1) << (cells & np.uint64(7)).astype(np.uint8)
    return byte[first], np.bitwise_or.reduceat(bit, first) if len(first) else bit


def cells_for(texts: DataFrame, text: str) -> int:
    """Cells of a row of the sketch: a power of two that follows the bytes of the corpus, within limits."""
    size = texts.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    return min(MOST_CELLS, max(LEAST_CELLS, 1 << (size // BYTES_A_CELL).bit_length()))


def sketched(texts: DataFrame, params: Params, cells: int, text: str = "text") -> tuple[np.ndarray, ...]:
    """For each row of the merged sketch, a bit for each cell that counted two or more.

    A task sends the parts of its sketch that hold anything; a part is added up as its copies are read, one by one.
    """

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketch(cells)
        for part in parts:
            for _, raw, offsets in wordbytes.chunks(part, text):
                for found in ranges_of(wordbytes.Words(raw, offsets, wordbytes.SOLID), params):
                    sketch.add(found.anchor)
        for block, z in sketch.blocks():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([z], pa.binary())], names=["block", "z"])

    def merged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, once, twice = None, None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([held], pa.int32()), pa.array([twice.tobytes()], pa.binary())], names=["block", "bits"])

        for part in parts:
            for block, z in zip(part.column("block").to_pylist(), part.column("z").to_pylist()):
                planes = np.frombuffer(zstandard.decompress(z), np.uint8).reshape(2, -1)
                if block == held:
                    twice |= planes[1] | (once & planes[0])
                    once |= planes[0]
                    continue
                if held is not None:
                    yield done()
                held, once, twice = block, planes[0].copy(), planes[1].copy()
        if held is not None:
            yield done()

    parts = texts.select(text).mapInArrow(counted, "block int, z binary")
    blocks = parts.repartition("block").sortWithinPartitions("block").mapInArrow(merged, "block int, bits binary")
    flat = np.zeros(len(SALTS) * cells // 8, np.uint8)
    size = min(BLOCK, cells) // 8
    for row in blocks.collect():  # a sketch has a fixed largest size
        flat[row["block"] * size : (row["block"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return tuple(flat.reshape(len(SALTS), -1))


def estimated_twice(anchors: np.ndarray, rows: tuple[np.ndarray, ...]) -> np.ndarray:
    """Whether each anchor is estimated at two or more: all of its cells are."""
    good = np.ones(len(anchors), bool)
    for row, salt in zip(rows, SALTS):
        cell = mix(anchors ^ salt) & np.uint64(8 * len(row) - 1)
        good &= (row[(cell >> np.uint64(3)).astype(np.int64)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return good


def likely_ranges(docs: DataFrame, params: Params, rows: tuple[np.ndarray, ...], text: str = "text") -> DataFrame:
    """The ranges of anchors that the sketch estimates repeated: the columns of ``docs`` but the text, and low, anchor, kind, windows.

    ``kind`` is one hash of all windows of the range.
    """
    rest = [c for c in docs.columns if c != text]
    schema = StructType([*docs.select(*[F.col(f"`{c}`") for c in rest]).schema, *StructType.fromDDL("low int, anchor long, kind long, windows array<long>")])
    shared = Shared(docs.sparkSession, lambda *planes: planes, *rows)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged = shared.get()
        for part in parts:
            for few, raw, offsets in wordbytes.chunks(part, text):
                for found in ranges_of(wordbytes.Words(raw, offsets, wordbytes.SOLID), params):
                    ends = np.cumsum(found.size)
                    keep = estimated_twice(found.anchor, merged)
                    spread = np.repeat(keep, found.size)
                    nth = np.arange(len(found.windows)) - np.repeat(ends - found.size, found.size)
                    kind = mix(np.add.reduceat(mix(found.windows + mix(nth.astype(np.uint64) * M3)), ends - found.size) + found.size.astype(np.uint64))
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], np.cumsum(found.size[keep])]), pa.int32()), pa.array(found.windows[spread].view(np.int64))
                    )
                    owner = pa.array(found.text[keep])
                    yield pa.RecordBatch.from_arrays(
                        [
                            *[few.column(c).take(owner) for c in rest], pa.array(found.low[keep].astype(np.int32)),
                            pa.array(found.anchor[keep].view(np.int64)), pa.array(kind[keep].view(np.int64)), lists,
                        ],
                        names=schema.names,
                    )

    return docs.mapInArrow(batches, schema)


def repeated_windows(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """For each document (columns key, mark, text) with windows that occurred before: key, mark, spans (pairs low, high of first words).

    Each phase is a written table, discarded after its last use.
    """
    cells = cells_for(docs, "text")
    with small_batches(docs.sparkSession):
        found = written(likely_ranges(docs, params, sketched(docs, params, cells)))
    place = F.struct(F.col("key").isNull().alias("last"), "key", "mark", "low")  # null keys come last
    own = found.select("key", "mark", "low", "kind", "anchor", F.size("windows").alias("size"))
    kinds = own.groupBy("anchor", "kind").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    kinds = written(kinds)
    # All ranges of a kind but its first one have occurred before.
    same = own.join(kinds.where("n > 1").select("anchor", "kind", "first"), ["anchor", "kind"]).where(place != F.col("first"))
    later = written(same.select("key", "mark", "low", (F.col("low") + F.col("size") - 1).alias("high")))
    # Anchors with several kinds: the windows of the first range of each kind, one by one.
    mixed = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1").select("anchor")
    firsts = kinds.join(mixed, "anchor", "left_semi").select("anchor", "kind", "first")
    open_ranges = found.join(firsts, ["anchor", "kind"]).where(place == F.col("first")).select("anchor", "first", "windows")
    each = written(
        open_ranges.select("anchor", "first", F.posexplode("windows").alias("nth", "window")).select(
            "anchor", "window", F.col("first").withField("low", F.col("first.low") + F.col("nth")).alias("place")
        )
    )
    discard(found, kinds)
    earliest = each.groupBy("anchor", "window").agg(F.min("place").alias("earliest"), F.count("*").alias("n")).where("n > 1").drop("n")
    apart = each.join(earliest, ["anchor", "window"]).where("place <> earliest")
    both = later.unionByName(apart.select("place.key", "place.mark", "place.low", F.col("place.low").alias("high")))
    spans = written(both.groupBy("key", "mark").agg(F.collect_list(F.struct("low", "high")).alias("spans")))
    discard(later, each)
    return spans


def _packed(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the text compressed (z): texts are shuffled in this form."""
    rest = [c for c in docs.columns if c != text]
    schema = StructType([*docs.select(*rest).schema, *StructType.fromDDL("z binary")])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for part in slices(parts):
            texts = part.column(text).cast(pa.large_binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in rest], pa.array([squeeze.compress(t or b"") for t in texts], pa.binary())], names=schema.names
            )

    return docs.mapInArrow(batches, schema)


def _cut(rows: DataFrame, params: Params, keep_text: bool) -> DataFrame:
    """Replace z and spans by the counts, the digest and, if wanted, the words that are left."""
    rest = [c for c in rows.columns if c not in ("z", "spans")]
    extra = "n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if keep_text else "")
    schema = StructType([*rows.select(*[F.col(f"`{c}`") for c in rest]).schema, *StructType.fromDDL(extra)])

    def left_of(z: bytes, spans: pa.Scalar) -> tuple:
        text = zstandard.decompress(z)
        words = text.split()  # of bytes: exactly the separators 0x20 and 0x09 to 0x0D
        gone = np.zeros(len(words) + 1, np.int64)
        if spans.is_valid:
            low, high = (spans.values.field(i).to_numpy().astype(np.int64) for i in (0, 1))
            np.add.at(gone, low, 1)
            np.add.at(gone, high + params.width, -1)
        covered = np.cumsum(gone[:-1]) > 0
        left = b" ".join(w for w, out in zip(words, covered) if not out) if covered.any() else b" ".join(words)
        row = (len(words), int(covered.sum()), hashlib.sha256(left).hexdigest())
        return (*row, left.decode("utf-8", "replace")) if keep_text else row

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()][: 3 + keep_text]
        for part in slices(parts):
            out = [left_of(z, spans) for z, spans in zip(part.column("z").to_pylist(), part.column("spans"))]
            columns = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in rest], *columns], names=schema.names)

    return rows.mapInArrow(batches, schema)


def without_repeats(docs: DataFrame, params: Params = Params(), key: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` without the text, with n_words, n_removed, kept_sha256 and, if wanted, kept_text (the words that are left, one space between).

    Removed is each word inside a window of ``width`` words whose words, in this order, also start earlier: in a row with a smaller key, or
    earlier in the same text. Null keys come after all others; rows with one key go by a hash of their text. Rows equal in key and text are one
    document listed several times: all get what that document gets. Null texts count as empty; texts with fewer words than a window lose
    nothing. Columns with the new names are replaced.
    """
    rest = [c for c in docs.columns if c != text and c not in NEW]
    row, name, mark = unused(docs, "row"), "key", "mark"
    source = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias(row), F.col(f"`{key}`").alias(name),
        F.xxhash64(F.col(f"`{text}`")).alias(mark), F.col(f"`{text}`").alias("text"),
    )
    spans = repeated_windows(source.select(name, mark, "text"), params)
    known = spans.select(F.col(name).alias("of"), F.col(mark).alias("with"), "spans")
    here: Column = F.col(name).eqNullSafe(F.col("of")) & (F.col(mark) == F.col("with"))
    rows = _packed(source, "text").join(known, here, "left").select(row, "z", "spans")
    return _cut(rows, params, keep_text).select(f"{row}.*", *[c for c in NEW if keep_text or c != "kept_text"])
