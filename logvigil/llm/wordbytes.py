"""Words of many texts at once, found and hashed on their UTF-8 bytes.

Arrow batches are cut into chunks of about CHUNK bytes, so memory follows the longest text and not the batch: about 60 bytes
for each byte of it. All hashes are 64 bits wide and depend on nothing but the bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from logvigil.llm.grams import M3, mix
from logvigil.llm.tables import slices

CHUNK = 1 << 18
ALL = np.arange(256)
# fixed values: the bytes that words are made of
SOLID = ~np.isin(ALL, [0x20, *range(0x09, 0x0E)])  # anything but white space
LETTERS = (ALL >= 0x80) | ((ALL >= 48) & (ALL <= 57)) | ((ALL >= 65) & (ALL <= 90)) | ((ALL >= 97) & (ALL <= 122))
LOWER = np.where((ALL >= 65) & (ALL <= 90), ALL + 32, ALL).astype(np.uint8)

BYTE = mix(np.arange(1, 257, dtype=np.uint64) * M3)
STEP, BACK = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """The first n powers of STEP and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((STEP, BACK)):
            _powers[i] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, base, np.uint64))])
    return _powers


class Words:
    """The words of some texts: bytes starts[j]:ends[j] of raw; those of text i are bounds[i]:bounds[i + 1]."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, kind: np.ndarray, lower: bool = False):
        self.raw = LOWER[raw] if lower else raw
        solid = np.concatenate([[False], kind[raw], [False]])
        begins = solid[1:-1] & ~solid[:-2]
        stops = solid[1:-1] & ~solid[2:]
        edge = offsets[1:-1]
        inside = edge[(edge > 0) & (edge < len(raw))]
        begins[inside] |= solid[1:-1][inside]
        stops[inside - 1] |= solid[1:-1][inside - 1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        self.bounds = np.searchsorted(self.starts, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def texts(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        """64 bits for each word, from running sums of its bytes times powers."""
        up, down = powers(len(self.raw) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE[self.raw] * up[: len(self.raw)], dtype=np.uint64)])
        return mix((total[self.ends] - total[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(np.uint64))

    def crcs(self) -> np.ndarray:
        """crc32 of each word: the exclusive or of what each byte adds at its distance from the end of the word."""
        size = self.ends - self.starts
        if not len(size):
            return np.zeros(0, np.uint32)
        first = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(self.starts - first, size)  # the bytes of all words
        behind = np.minimum(np.repeat(self.ends, size) - at - 1, NEAR - 1)
        found = np.bitwise_xor.reduceat(ADDED[behind, self.raw[at]], first) ^ ZEROS[np.minimum(size, NEAR)]
        for j in np.flatnonzero(size > NEAR):
            found[j] = zlib.crc32(self.raw[self.starts[j] : self.ends[j]].tobytes())
        return found


def _crc_tables(near: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What a byte adds to a checksum by its distance from the end; checksums of zero bytes; SHIFT[n], which appends n bytes to a
    checksum (by its four bytes); DOUBLED[k], which appends near * 2**k."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> np.uint32(1)), table >> np.uint32(1))
    one = lambda value: table[value & np.uint32(255)] ^ (value >> np.uint32(8))
    shift = [(np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None])]
    for _ in range(near):
        shift.append(one(shift[-1]))
    zeros = np.array([zlib.crc32(bytes(n)) for n in range(near + 1)], np.uint32)
    added = np.stack([applied(shift[n], table ^ table[0]) for n in range(near)])
    doubled = [shift[near]]
    for _ in range(32):
        doubled.append(applied(doubled[-1], doubled[-1]))
    return added, zeros, np.stack(shift), np.stack(doubled)


def applied(shift: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Checksums with bytes appended as ``shift`` (four tables) says."""
    byte = [(value >> np.uint32(8 * j)) & np.uint32(255) for j in range(4)]
    return shift[0][byte[0]] ^ shift[1][byte[1]] ^ shift[2][byte[2]] ^ shift[3][byte[3]]


NEAR = 64
ADDED, ZEROS, SHIFT, DOUBLED = _crc_tables(NEAR)
SPACE = np.uint32(zlib.crc32(b" "))


def joined(crc: np.ndarray, more: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of two strings in a row, given that of each one and the bytes of the second."""
    few = size % NEAR
    byte = [(crc >> np.uint32(8 * j)) & np.uint32(255) for j in range(4)]
    moved = SHIFT[few, 0, byte[0]] ^ SHIFT[few, 1, byte[1]] ^ SHIFT[few, 2, byte[2]] ^ SHIFT[few, 3, byte[3]]
    far = size // NEAR
    for k in range(int(far.max(initial=0)).bit_length()):
        rows = np.flatnonzero((far >> k) & 1)
        moved[rows] = applied(DOUBLED[k], moved[rows])
    return moved ^ more


def spaced(crc: np.ndarray) -> np.ndarray:
    """crc32 of a string with a space behind it, given its own."""
    return applied(SHIFT[1], crc) ^ SPACE


def chunks(part: pa.RecordBatch, text: str, size: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with about ``size`` bytes of text (one row at least), the bytes, and the offset of each text.

    Null texts count as empty.
    """
    for few in slices([part]):
        yield from _chunks(few, text, size)


def _chunks(part: pa.RecordBatch, text: str, size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    column = part.column(text).cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    start = 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1)
        here = offsets[start : stop + 1]
        yield part.slice(start, stop - start), raw[here[0] : here[-1]], here - here[0]
        start = stop
