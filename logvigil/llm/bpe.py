"""Byte-level BPE as a monoid: halves are encoded on their own, neighbours are joined at the seam.

Two facts make the joins exact, whatever the text.

* Pieces. The split pattern scans from left to right, looks at nothing before a match and at most at
  two characters behind it. So a match with two more characters behind it stays when text is appended,
  and as soon as a new scan over the seam starts a match where the right half started one, the rest is
  the right half's own.
* Tokens. A row of tokens is the encoding of its bytes if and only if each two neighbours are the
  encoding of their own bytes: merges inside a pair do not depend on what stands around it, so the first
  merge across a seam in the whole would also be one in the pair. So a seam is re-encoded in a window of
  k tokens on either side, and k doubles until the outer neighbours of the window pass that test.

Decoding is plain concatenation, up the same kind of tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType

from logvigil.llm.tables import Shared, slices

LEAF_BYTES = 8  # pieces up to this size are merged directly
SMALL_BYTES = 24  # up to this size results are remembered: seams and leaves of new words are mostly old
LEAF_CHARS = 1 << 16  # texts up to this size are split in one scan
CACHED = 200_000  # pieces, small results and pairs remembered in a task, each
CACHED_CHARS = 48  # longest piece that is remembered
SPACE = re.compile(r" (?=\S)")  # before such a space a piece ends in any text, as only white space holds spaces inside
DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64 token and rank a line), by rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    return [base64.b64decode(token) for token, _ in sorted(pairs, key=lambda p: int(p[1]))]


class Spaced(dict):
    """Ids of a stretch of text behind a space, by the stretch; forgets them when it gets large."""

    def __init__(self, codec: Codec):
        self.codec = codec

    def __missing__(self, stretch: str) -> tuple[int, ...]:
        if stretch.isalpha():  # one piece
            raw = b" " + stretch.encode()
            whole = self.codec.ranks.get(raw)
            ids = tuple(self.codec.grown(raw)) if whole is None else (whole,)
        else:
            ids = tuple(self.codec.ids_of(self.codec.pattern.findall(" " + stretch)))
        if len(stretch) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.clear()
            self[stretch] = ids
        return ids


class Codec(dict):
    """Encoder and decoder; as a dict it maps pieces to their ids and forgets them when it gets large."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.ranks = tokens, {t: i for i, t in enumerate(tokens)}
        self.pattern, self.decimal = regex.compile(pattern), [str(i) for i in range(len(tokens))]
        self.fits: dict[tuple[int, int], bool] = {}
        self.small: dict[bytes, list[int]] = {}
        self.spaced = Spaced(self)

    def __missing__(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(raw)  # a piece that is a token is that token, even if no merges lead there
        ids = tuple(self.grown(raw)) if whole is None else (whole,)
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.clear()
            self[piece] = ids
        return ids

    def direct(self, raw: bytes) -> list[int]:
        """The ids of a few bytes."""
        if len(raw) > SMALL_BYTES:
            return self.merged(raw)
        ids = self.small.get(raw)
        if ids is None:
            if len(self.small) >= CACHED:
                self.small.clear()
            ids = self.small[raw] = self.merged(raw)
        return ids

    def merged(self, raw: bytes) -> list[int]:
        """Merge the pair of lowest rank, leftmost first, until none is left."""
        ranks = self.ranks
        if len(raw) <= 2 * SMALL_BYTES:
            rank, none = ranks.get, len(ranks)  # above all ranks, so that the lowest is found without a look at each
            parts = [raw[i : i + 1] for i in range(len(raw))]
            found = [rank(raw[i : i + 2], none) for i in range(len(raw) - 1)]
            while found:
                low = min(found)
                if low == none:
                    break
                i = found.index(low)
                whole = parts[i] = parts[i] + parts[i + 1]
                del parts[i + 1], found[i]
                if i < len(found):
                    found[i] = rank(whole + parts[i + 1], none)
                if i:
                    found[i - 1] = rank(parts[i - 1] + whole, none)
            return list(map(ranks.__getitem__, parts))
        end = [i + 1 for i in range(len(raw))]  # end of the part that starts at i; 0 once it is merged away
        start = list(range(-1, len(raw)))  # start of the part that ends at i
        heap = [(r, i, i + 2) for i in range(len(raw) - 1) if (r := ranks.get(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            mid = end[i]
            if not mid or mid >= len(raw) or end[mid] != stop:
                continue  # one of the two has been merged since
            end[i], end[mid], start[stop] = stop, 0, i
            if stop < len(raw) and (r := ranks.get(raw[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
            if i and (r := ranks.get(raw[start[i] : stop])) is not None:
                heapq.heappush(heap, (r, start[i], stop))
        return [ranks[raw[i:e]] for i, e in enumerate(end) if e]

    def neighbours(self, a: int, b: int) -> bool:
        """Whether the two tokens are the encoding of their bytes."""
        known = self.fits.get((a, b))
        if known is None:
            if len(self.fits) >= CACHED:
                self.fits.clear()
            known = self.fits[a, b] = self.direct(self.tokens[a] + self.tokens[b]) == [a, b]
        return known

    def grown(self, raw: bytes) -> list[int]:
        """The ids of a piece: halves, joined."""
        if len(raw) <= LEAF_BYTES:
            return self.direct(raw)
        mid = len(raw) // 2
        return self.joined(self.grown(raw[:mid]), self.grown(raw[mid:]))

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        width = 1
        while True:
            i, j = max(0, len(left) - width), min(width, len(right))
            seam = self.direct(b"".join(map(self.tokens.__getitem__, left[i:] + right[:j])))
            if (not i or self.neighbours(left[i - 1], seam[0])) and (j == len(right) or self.neighbours(seam[-1], right[j])):
                return left[:i] + seam + right[j:]
            width *= 2

    def encode(self, text: str) -> list[int]:
        """The ids of a text; equal to merging each match of the pattern separately."""
        if len(text) > LEAF_CHARS:
            return self.node(text, 0, len(text))[2].tolist()
        first, *spaced = SPACE.split(text)
        ids = self.ids_of(self.pattern.findall(first))
        ids.extend(chain.from_iterable(map(self.spaced.__getitem__, spaced)))
        return ids

    def ids_of(self, pieces: list[str]) -> list[int]:
        return list(chain.from_iterable(map(self.__getitem__, pieces)))

    def counted(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces in a row, and how many each has."""
        found = list(map(self.__getitem__, pieces))
        return np.array(list(chain.from_iterable(found)), np.int32), np.array(list(map(len, found)), np.int32)

    def node(self, text: str, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ends of the pieces, number of ids of each, and ids, of text[low:high] taken on its own."""
        if high - low <= LEAF_CHARS:
            return self.scanned(text, low, high)
        mid = (low + high) // 2
        (ends, counts, ids), (ends_r, counts_r, ids_r) = self.node(text, low, mid), self.node(text, mid, high)
        width = 2
        while True:
            keep = max(0, len(ends) - width)
            start = int(ends[keep - 1]) if keep else low
            if keep and mid - start < 2:
                width *= 2
                continue
            to = min(width, len(ends_r))
            stop = int(ends_r[to - 1])
            seam = self.pattern.findall(text[start:stop])
            at = start + np.cumsum(np.fromiter(map(len, seam), np.int64, len(seam)))
            if stop == high:
                take, drop = len(seam), to
                break
            settled = at[(at >= mid) & (at <= stop - 2)]
            both = settled[np.isin(settled, ends_r[:to])]
            if len(both):
                take, drop = int(np.searchsorted(at, both[0])) + 1, int(np.searchsorted(ends_r, both[0])) + 1
                break
            width *= 2
        ids_s, counts_s = self.counted(seam[:take])
        return (
            np.concatenate([ends[:keep], at[:take], ends_r[drop:]]),
            np.concatenate([counts[:keep], counts_s, counts_r[drop:]]),
            np.concatenate([ids[: int(counts[:keep].sum())], ids_s, ids_r[int(counts_r[:drop].sum()) :]]),
        )

    def scanned(self, text: str, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        pieces = self.pattern.findall(text[low:high])
        ids, counts = self.counted(pieces)
        return low + np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces))), counts, ids

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of ids: halves, concatenated."""
        if len(ids) <= LEAF_CHARS:
            return b"".join(map(self.tokens.__getitem__, ids))
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])

    def written_ids(self, ids: list[int]) -> bytes:
        return ",".join(map(self.decimal.__getitem__, ids)).encode()


def encoded(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the token ids of ``text`` as array column ``ids``.

    Null and empty texts have no ids; text of any length is encoded whole; other columns pass
    through, and a column that is already named ``ids`` is replaced.
    """
    codec_of = Shared(docs.sparkSession, Codec, read_ranks(ranks_path), pattern)
    docs = docs.drop(ids)
    schema = docs.select("*").schema.add(ids, ArrayType(IntegerType()))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of.get()
        for part in slices(parts):
            rows = [codec.encode(t.as_py() or "") for t in part.column(text)]
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
            out = pa.ListArray.from_arrays(pa.array(offsets), pa.array(list(chain.from_iterable(rows)), pa.int32()))
            yield pa.RecordBatch.from_arrays([*part.columns, out], names=[*part.schema.names, ids])

    return docs.mapInArrow(batches, schema)


def decoded(docs: DataFrame, ranks_path: str, ids: str = "ids", raw: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of the token ids as binary column ``raw``; null ids give no bytes."""
    codec_of = Shared(docs.sparkSession, Codec, read_ranks(ranks_path), "")
    docs = docs.drop(raw)
    schema = docs.select("*").schema.add(raw, "binary")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of.get()
        for part in slices(parts):
            rows = [codec.decode(r.as_py() or []) for r in part.column(ids)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(rows, pa.binary())], names=[*part.schema.names, raw])

    return docs.mapInArrow(batches, schema)


def round_trips(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, number of ids, digest of the ids, and digest of the bytes the ids decode to.

    Encodes and decodes in one pass, so that ids need not leave the task. A null text counts as
    empty; repeated rows each give a row; other columns are dropped.
    """
    codec_of = Shared(docs.sparkSession, Codec, read_ranks(ranks_path), pattern)
    rows = docs.select(docs[key], docs[text])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of.get()
        for part in slices(parts):
            n, ids_sha, raw_sha = [], [], []
            for value in part.column(1):
                ids = codec.encode(value.as_py() or "")
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(codec.written_ids(ids)).hexdigest())
                raw_sha.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(raw_sha, pa.string())],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(batches, f"`{key}` {kind}, {DIGESTS}")
