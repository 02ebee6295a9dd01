"""Removal of byte strings that repeat anywhere in the corpus, by bucket-pointer refinement.

Each position has a bucket pointer that stands for the q bytes behind it. Pointers of twice the depth come
from sorting by the pair of pointers at the position and at a later offset; here sorting is hashing, so
that equal pairs get equal pointers wherever they are. Depths go 1, 2, 4 ... 64, 100, 200 and 400, each
reusing the pointers of the one before.

Not every position enters a bucket: a string of 400 bytes is represented by the position inside it whose
100-byte pointer is least, so equal strings are represented by equal buckets (about one position in 150).
Refinement then goes on only inside buckets with more than one position:

1. Positions with the same 100-byte bucket, the same range of strings that they represent and equal pointers
   at both ends of the range: all these strings repeat.
2. In buckets with ranges that are not settled so, one range of each kind is cut where its strings lie a multiple of
   BLOCK bytes before the represented position. All strings of such a piece hold the same 400 - BLOCK + 1 bytes, whose
   pointer makes a finer bucket: equal strings have it in common, as they lie alike around their position. A piece
   alone in its bucket holds no string that repeats; pieces that agree in extent and the pointers at both ends repeat.
3. In finer buckets with pieces that are not settled so, one piece of each kind is spread out into its strings,
   and strings with equal 400-byte pointers repeat.
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

from logvigil.llm import grams
from logvigil.llm.tables import slices, small_batches, unused
from logvigil.session import discard, written

POSITION_BITS = 20
BATCH = 20_000  # strings handed on at once, or four times the ranges
PIECE = 1 << 15  # bytes worked on at once; a longer text is worked on in pieces that overlap
BLOCK = 32  # strings that a bucket of step 2 stands for, at most; fewer where strings are short
IS_SPACE = np.isin(np.arange(256), grams.SPACES)
BYTE = grams.mix(np.arange(1, 257, dtype=np.uint64) * grams.M3)
RUNS = "mark long, t binary, at int, low int, high int, bucket long, first long, last long"


@dataclass(frozen=True)
class Depth:
    """Strings of ``whole`` bytes; buckets start at ``start`` bytes, and twice that divides ``whole`` by a power of two."""

    whole: int = 400
    start: int = 100

    @property
    def half(self) -> int:
        """The depth from which that of ``whole`` bytes is reached."""
        width = self.start
        while 2 * width < self.whole:
            width *= 2
        return width

    @property
    def block(self) -> int:
        return min(BLOCK, self.whole - self.half)


def refine(pointers: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Pointers refined by others; half a mix is enough, as each depth adds one."""
    out = pointers * grams.M3
    out += later
    out ^= out >> np.uint64(32)
    out *= grams.M1
    return out


def deeper(pointers: np.ndarray, offset: int) -> np.ndarray:
    """Pointers refined by those at a later offset (fewer: the last ``offset`` positions have none)."""
    return refine(pointers[: max(0, len(pointers) - offset)], pointers[offset:])


def refined(raw: np.ndarray, depth: Depth) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket pointers of ``depth.start``, ``depth.half`` and ``depth.whole`` bytes."""
    pointers, width = BYTE[raw], 1
    while 2 * width <= depth.start:
        pointers, width = deeper(pointers, width), 2 * width
    if width < depth.start:
        pointers = deeper(pointers, depth.start - width)
    start, width = pointers, depth.start
    while width < depth.half:
        pointers, width = deeper(pointers, width), 2 * width
    return start, pointers, deeper(pointers, depth.whole - width)


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    least, held = values, 1
    while 2 * held <= width:
        least = np.minimum(least[: len(least) - held], least[held:])
        held *= 2
    rest = width - held
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def pieces(texts: list[bytes], depth: Depth) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (text, offset, bytes) of about PIECE bytes that hold each string of ``depth.whole`` bytes once."""
    group, held = [], 0
    for i, text in enumerate(texts):
        for offset in range(0, max(0, len(text) - depth.whole) + 1, PIECE):
            part = text[offset : offset + PIECE + depth.whole - 1]
            if len(part) < depth.whole:
                continue
            if group and held + len(part) > PIECE + depth.whole:
                yield group
                group, held = [], 0
            group.append((i, offset, part))
            held += len(part)
    if group:
        yield group


def runs_of(group: list[tuple[int, int, bytes]], depth: Depth) -> list[np.ndarray]:
    """Per represented range: text, position, first and last string start, bucket, pointers of first and last string."""
    raw = np.frombuffer(b"".join(part for _, _, part in group), np.uint8)
    ends = np.cumsum([len(part) for _, _, part in group])
    begins = np.concatenate([[0], ends[:-1]])
    start, _, whole = refined(raw, depth)
    mask = np.uint64((1 << POSITION_BITS) - 1)
    key = (start & ~mask) | np.arange(len(start), dtype=np.uint64)
    chosen = (least_in_windows(key, depth.whole - depth.start + 1) & mask).astype(np.int64)
    owner = np.repeat(np.arange(len(ends)), ends - begins)[: len(chosen)]
    valid = np.arange(len(chosen)) + depth.whole <= ends[owner]
    at = np.flatnonzero(valid)
    position = chosen[at]
    new = np.ones(len(at), bool)
    new[1:] = (position[1:] != position[:-1]) | (at[1:] != at[:-1] + 1)
    low = at[new]
    high = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)] if len(at) else at
    position, mine = position[new], owner[low]
    shift = np.array([offset for _, offset, _ in group])[mine] - begins[mine]
    text = np.array([i for i, _, _ in group])[mine]
    return [text, position + shift, low + shift, high + shift, start[position], whole[low], whole[high]]


def digest(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def texts_of(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def ranges(docs: DataFrame, depth: Depth) -> DataFrame:
    """The columns of RUNS for all texts (columns text, mark); t is the text's digest."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            texts, marks = texts_of(part.column(0)), part.column(1)
            names = pa.array([digest(t) if len(t) >= depth.whole else b"" for t in texts], pa.binary())
            held: list[list[np.ndarray]] = []

            def full() -> pa.RecordBatch:
                text, at, low, high, *pointers = map(np.concatenate, zip(*held))
                held.clear()
                return pa.RecordBatch.from_arrays(
                    [
                        marks.take(pa.array(text)), names.take(pa.array(text)), *[pa.array(c.astype(np.int32)) for c in (at, low, high)],
                        *[pa.array(p.view(np.int64)) for p in pointers],
                    ],
                    names=["mark", "t", "at", "low", "high", "bucket", "first", "last"],
                )

            for group in pieces(texts, depth):
                held.append(runs_of(group, depth))
                if sum(len(columns[0]) for columns in held) > BATCH // 4:
                    yield full()
            if held:
                yield full()

    return docs.select("text", "mark").mapInArrow(batches, RUNS)


def packed(docs: DataFrame, keep: list[str], depth: Depth) -> DataFrame:
    """``keep`` with t and the text compressed (z): texts are shuffled in this form."""
    kept = docs.select("text", *keep)
    schema = ", ".join(f"`{c}` {k}" for c, k in docs.select(*keep).dtypes)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for part in slices(parts):
            texts = texts_of(part.column(0))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[1:], pa.array(map(digest, texts), pa.binary()), pa.array(map(squeeze.compress, texts), pa.binary())],
                names=[*part.schema.names[1:], "t", "z"],
            )

    return kept.mapInArrow(batches, schema + ", t binary, z binary")


def cut(rows: DataFrame, depth: Depth) -> DataFrame:
    """The pieces of the ranges in a text's list (column open), each with its finer bucket and the 400-byte pointers of its strings."""
    core = depth.whole - depth.block + 1

    def cut_ranges(raw: list[bytes], bucket: np.ndarray, low: np.ndarray, before: np.ndarray, settled: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
        counts = np.fromiter(map(len, raw), np.int64, len(raw)) - (depth.whole - 1)
        _, half, whole = refined(np.frombuffer(b"".join(raw), np.uint8), depth)
        begin = np.cumsum(counts + depth.whole - 1) - (counts + depth.whole - 1)
        mine, nth = np.repeat(np.arange(len(raw)), counts), np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        pointer = whole[begin[mine] + nth]
        ahead = before[mine] - nth  # bytes from a string's start to the represented position
        block = ahead // depth.block
        new = np.ones(len(nth), bool)
        new[1:] = (mine[1:] != mine[:-1]) | (block[1:] != block[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(nth)) - 1
        mine, block = mine[first], block[first]
        inner = begin[mine] + nth[first] + ahead[first] - block * depth.block
        finer = refine(half[inner], half[inner + core - depth.half])
        finer = refine(finer, bucket.view(np.uint64)[mine] + block.astype(np.uint64))
        offsets = np.append(first, len(nth)).astype(np.int32) * 8
        return mine, [
            pa.array(finer.view(np.int64)), *[pa.array(c.astype(np.int32)) for c in (low[mine] + nth[first], ahead[first], ahead[last])],
            *[pa.array(pointer[at].view(np.int64)) for at in (first, last)], pa.array(settled[mine]),
            pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(pointer)]),
        ]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            owner = np.repeat(np.arange(part.num_rows), part.column("open").value_lengths().to_numpy())
            bucket, low, high, before, settled = [f.to_numpy(zero_copy_only=False) for f in part.column("open").flatten().flatten()]
            low, before = low.astype(np.int64), before.astype(np.int64)
            end = high + np.int64(depth.whole)
            group = np.cumsum(end - low) // (2 * PIECE)
            row, text = -1, b""
            for few in np.split(np.arange(len(owner)), np.flatnonzero(np.diff(group)) + 1):
                raw = []
                for i, begin, stop in zip(owner[few].tolist(), low[few].tolist(), end[few].tolist()):
                    if i != row:
                        row, text = i, zstandard.decompress(part.column("z")[i].as_py())
                    raw.append(text[begin:stop])
                mine, columns = cut_ranges(raw, bucket[few], low[few], before[few], settled[few])
                name = part.column("t").take(pa.array(owner[few][mine]))
                yield pa.RecordBatch.from_arrays([name, *columns], names=["t", "bucket", "low", "before", "after", "first", "last", "settled", "pointers"])

    kinds = "t binary, bucket long, low int, before int, after int, first long, last long, settled boolean, pointers binary"
    return rows.select("t", "z", "open").mapInArrow(batches, kinds)


def spread(pieces: DataFrame) -> DataFrame:
    """The strings of pieces, each with its bucket and 400-byte pointer."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start in range(0, part.num_rows, BATCH // BLOCK):
                few = part.slice(start, BATCH // BLOCK)
                raw = few.column("pointers").to_pylist()
                counts = np.fromiter(map(len, raw), np.int64, len(raw)) // 8
                row = np.repeat(np.arange(len(raw)), counts)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                low = few.column("low").to_numpy()[row] + nth
                columns = [few.column(c).take(pa.array(row)) for c in ("t", "bucket", "settled")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(np.frombuffer(b"".join(raw), np.int64)), pa.array(low.astype(np.int32))], names=["t", "bucket", "settled", "pointer", "low"]
                )

    return pieces.select("t", "bucket", "low", "settled", "pointers").mapInArrow(batches, "t binary, bucket long, settled boolean, pointer long, low int")


def long_spans(cover: np.ndarray, raw: bytes, least_words: int) -> np.ndarray:
    """``cover`` without its runs that touch fewer than ``least_words`` words."""
    edge = np.diff(cover.astype(np.int8), prepend=0, append=0)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    solid = ~IS_SPACE[np.frombuffer(raw, np.uint8)]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    upto = np.concatenate([[0], np.cumsum(first)])
    words = upto[end] - upto[begin] + (solid[begin] & ~first[begin])
    short = np.zeros(len(raw) + 1, np.int32)
    short[begin[words < least_words]] = 1
    short[end[words < least_words]] -= 1
    return cover & (np.cumsum(short[:-1]) == 0)


def removed(texts_with_starts: DataFrame, depth: Depth, keep_text: bool, least_words: int = 0) -> DataFrame:
    """Replace z and starts (pairs: first and last start of strings to remove; a null list for none) by the counts, digest and,
    if wanted, the text that is left.

    Where the cut leaves bytes that are no UTF-8, these are dropped from the text (not from counts and digest).
    """
    rest = [c for c in texts_with_starts.columns if c not in ("z", "starts", "t")]
    kinds = ", ".join(f"`{c}` {k}" for c, k in texts_with_starts.select(*[F.col(f"`{c}`") for c in rest]).dtypes)
    extra = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept_text string" if keep_text else "")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            out: list[tuple] = []
            for z, starts in zip(part.column("z").to_pylist(), part.column("starts")):
                raw = zstandard.decompress(z)
                left, gone, spans = raw, 0, 0
                if starts.is_valid and len(raw) >= depth.whole:
                    edge = np.zeros(len(raw) + 1, np.int32)
                    low, high = (starts.values.field(i).to_numpy().astype(np.int64) for i in (0, 1))
                    high = np.minimum(high + depth.whole, len(raw))
                    np.add.at(edge, low, 1)
                    np.add.at(edge, high, -1)
                    cover = np.cumsum(edge[:-1]) > 0
                    if least_words:
                        cover = long_spans(cover, raw, least_words)
                    gone, spans = int(cover.sum()), int(cover[:1].sum() + (cover[1:] & ~cover[:-1]).sum())
                    left = np.frombuffer(raw, np.uint8)[~cover].tobytes()
                row = (len(raw), gone, spans, hashlib.sha256(left).hexdigest())
                out.append((*row, left.decode("utf-8", "ignore")) if keep_text else row)
            columns = [pa.array(c, k) for c, k in zip(zip(*out), [pa.int64()] * 3 + [pa.string()] * 2)] if out else [
                pa.array([], k) for k in ([pa.int64()] * 3 + [pa.string()] * (1 + keep_text))
            ]
            names = [*rest, "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept_text"] if keep_text else [])]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in rest], *columns], names=names)

    return texts_with_starts.mapInArrow(batches, ", ".join(filter(None, [kinds, extra])))


def unsettled(kinds: DataFrame) -> DataFrame:
    """Buckets of several kinds, not all of them settled."""
    return kinds.groupBy("bucket").agg(F.bool_and("settled").alias("all"), F.count("*").alias("n")).where("NOT all AND n > 1").select("bucket")


def repeated_starts(docs: DataFrame, depth: Depth = Depth()) -> DataFrame:
    """For each text (columns text, mark; by its digest t) with strings to remove: starts, pairs low, high of string starts.

    Phases are written tables; each one is discarded, with the shuffles behind it, after its last use.
    """
    runs = written(ranges(docs, depth))
    here = F.xxhash64("t", "at")
    twice = lambda column: F.min(column) != F.max(column)
    # Each copy of a text that is long enough has one range that begins at 0.
    copies = written(runs.where("low = 0").groupBy("t").agg(F.count("*").alias("n")).where("n > 1").select("t", F.lit(True).alias("copied")))
    shared = written(runs.groupBy("bucket").agg(twice(here).alias("shared")).where("shared").select("bucket"))
    shared_runs = written(runs.join(shared, "bucket", "left_semi"))
    discard(runs, shared)
    # Step 1: ranges that agree in bucket, extent and the pointers at both ends.
    kind = ["bucket", "before", "after", "first", "last"]
    placed = shared_runs.withColumns({"before": F.col("at") - F.col("low"), "after": F.col("high") - F.col("at"), "here": here})
    kinds = written(placed.groupBy(*kind).agg(twice("here").alias("settled"), F.min(F.struct("here", "t", "low", "high", "mark")).alias("one")))
    settled = written(placed.join(kinds.where("settled").select(*kind), kind, "left_semi").select("t", "low", "high").distinct())
    # Step 2: pieces of ranges in buckets that hold an unsettled one, one range of each kind.
    listed = written(
        kinds.join(unsettled(kinds), "bucket", "left_semi").groupBy("one.t").agg(
            F.min("one.mark").alias("mark"),
            F.collect_list(F.struct(F.col("bucket"), F.col("one.low"), F.col("one.high"), F.col("before"), F.col("settled"))).alias("open"),
        )
    )
    discard(shared_runs, kinds)
    # Copies of a text differ in their mark, so they spread over the tasks and one of them is taken.
    texts = packed(docs, ["mark"], depth).join(listed, ["t", "mark"]).dropDuplicates(["t", "mark"])
    pieces = written(cut(texts, depth))
    del texts
    discard(listed)
    # Each string of a listed range comes once, as copies of a text are out; one of a settled range stands for two or more.
    weight = F.when(F.col("settled"), F.lit(2)).otherwise(F.lit(1))
    kinds = written(pieces.groupBy(*kind).agg((F.sum(weight) > 1).alias("settled"), F.min(F.struct("t", "low")).alias("one")))
    alike = pieces.where("NOT settled").join(kinds.where("settled").select(*kind), kind, "left_semi")
    alike = written(alike.select("t", "low", (F.col("low") + F.col("before") - F.col("after")).alias("high")))
    # Step 3: the strings of pieces in finer buckets that hold an unsettled one, one piece of each kind.
    listed = kinds.join(unsettled(kinds), "bucket", "left_semi").select("bucket", "one.t", "one.low", "settled")
    strings = written(spread(pieces.drop("settled").join(listed, ["bucket", "t", "low"])))
    discard(pieces, kinds)
    again = strings.groupBy("bucket", "pointer").agg(F.sum(weight).alias("n")).where("n > 1")
    again = written(again.select("bucket", "pointer"))
    found = strings.where("NOT settled").join(again, ["bucket", "pointer"], "left_semi").select("t", "low", F.col("low").alias("high"))
    found = written(found)
    discard(strings, again)
    both = settled.unionByName(alike).unionByName(found)
    starts = both.groupBy("t").agg(F.collect_list(F.struct("low", "high")).alias("starts"))
    everything: Column = F.array(F.struct(F.lit(0).alias("low"), F.lit(2**30).alias("high")))
    marks = starts.join(copies, "t", "full").select("t", F.when(F.col("copied"), everything).otherwise(F.col("starts")).alias("starts"))
    marks = written(marks)
    discard(settled, alike, found, copies)
    return marks


def cleaned(
    docs: DataFrame, depth: Depth = Depth(), text: str = "text", keep_text: bool = False, least_words: int = 0
) -> DataFrame:
    """``docs`` without the text, with n_bytes, n_removed, n_spans, kept_sha256 and, if wanted, kept_text.

    Removed is each byte inside a string of ``depth.whole`` bytes that also starts elsewhere in the corpus: in another row, also one with
    the same text, or in the same text (overlaps count). Null texts count as empty; shorter texts lose nothing; rows that repeat lose all that is
    long enough. With ``least_words``, runs of removed bytes that touch fewer words stay. Columns with the new names are replaced.
    """
    new = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
    rest = [c for c in docs.columns if c != text and c not in new]
    row = unused(docs, "row")
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias(row), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    with small_batches(docs.sparkSession):
        marks = repeated_starts(source.select("text", F.xxhash64(row).alias("mark")), depth)
    out = removed(packed(source, [row], depth).join(marks, "t", "left"), depth, keep_text, least_words)
    return out.select(f"{row}.*", *[c for c in new if c in out.columns])
