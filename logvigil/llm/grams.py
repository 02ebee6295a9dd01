"""Words, lines and hashed n-grams of many texts at once, on arrays of code points.

Work goes in chunks of texts of about CHUNK characters, so memory follows the longest text and not the
batch. Hashes are 64 bits wide and depend on nothing but the characters.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

CHUNK = 1 << 18
FEATURE_BITS = 18
SMOOTH = 30
SYMBOLS = "#*$%&|<>"  # fixed values
SPACES = (0x20, *range(0x09, 0x0E))  # fixed values: what separates words


def _table(codes: Sequence[int]) -> np.ndarray:
    table = np.zeros(129, bool)  # the last entry stands for all other characters
    table[list(codes)] = True
    return table


IS_SPACE, IS_SYMBOL = _table(SPACES), _table([ord(c) for c in SYMBOLS])
STEP = 0x9E3779B97F4A7C15
POWER = np.array([pow(STEP, i, 1 << 64) for i in range(4096)], np.uint64)
M1, M2, M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over 64 bits (one to one)."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def chunks(texts: Sequence[str], size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``size`` characters together, one text at least."""
    start = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > size:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def power(places: np.ndarray) -> np.ndarray:
    """The power of STEP for each place in a word, however long the word is."""
    if not len(places) or places.max() < len(POWER):
        return POWER[places]
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(int(places.max()), STEP, np.uint64))])[places]


class Chars:
    """The code points of some texts in a row."""

    def __init__(self, texts: Sequence[str]):
        self.cp = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        self.offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
        self.small = np.minimum(self.cp, 128).astype(np.uint8)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per text, the sum of a value for each character."""
        return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[self.offsets])

    def words(self, lower: bool = False) -> Words:
        solid = ~IS_SPACE[self.small]
        inner = self.offsets[1:-1]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        inner_in = inner[inner < len(solid)]
        first[inner_in] |= solid[inner_in]
        starts = np.flatnonzero(first)
        cp = self.cp
        if lower:
            cp = np.where((cp >= 65) & (cp <= 90), cp + np.uint32(32), cp)
        at = np.cumsum(first) - 1  # word of each character
        place = np.arange(len(cp)) - starts[np.maximum(at, 0)] if len(starts) else np.zeros(len(cp), np.int64)
        value = mix(cp.astype(np.uint64) + M3) * power(place)
        value[~solid] = 0
        size = np.add.reduceat(solid.astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)
        hashes = np.add.reduceat(value, starts) if len(starts) else np.zeros(0, np.uint64)
        return Words(mix(hashes + size.astype(np.uint64)), starts, size, np.searchsorted(starts, self.offsets))


class Words:
    """Hashes of the words of some texts; words of text i stand at bounds[i]:bounds[i + 1]."""

    def __init__(self, hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, bounds: np.ndarray):
        self.hashes, self.starts, self.sizes, self.bounds = hashes, starts, sizes, bounds

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of ``width`` words in a row inside a text, and the place of each one's first word."""
        n = len(self.hashes)
        if n < width:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        value = self.hashes[: n - width + 1].copy()
        for k in range(1, width):
            value = mix(value * M3 + self.hashes[k : n - width + 1 + k])
        text = np.repeat(np.arange(len(self.bounds) - 1), self.counts)
        at = np.flatnonzero(text[: n - width + 1] == text[width - 1 :])
        return value[at], at

    def text_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, places, "right") - 1


def repeated_words(words: Words, width: int = 3) -> np.ndarray:
    """Per text, the words inside a window of ``width`` words that is found twice or more in the text."""
    hashes, at = words.windows(width)
    text = words.text_of(at)
    order = np.lexsort((hashes, text))
    same = (hashes[order][1:] == hashes[order][:-1]) & (text[order][1:] == text[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words.hashes) + width, np.int64)
    np.add.at(covered, at[twice], 1)
    np.add.at(covered, at[twice] + width, -1)
    inside = np.cumsum(covered)[: len(words.hashes)] > 0
    return np.diff(np.concatenate([[0], np.cumsum(inside)])[words.bounds])


def repeated_lines(text: str) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def features(chars: Chars) -> list[tuple[np.ndarray, np.ndarray]]:
    """Two families of hashed features, each with the bounds of its texts: words and word pairs; 3 and 4 characters.

    All pairs of a word with itself are one feature.
    """
    words = chars.words()
    shift = np.uint64(64 - FEATURE_BITS)
    pairs, at = words.windows(2)
    pairs = np.where(words.hashes[at] == words.hashes[np.minimum(at + 1, max(0, len(words.hashes) - 1))], M1, pairs)
    text = np.concatenate([words.text_of(np.arange(len(words.hashes))), words.text_of(at)])
    order = np.argsort(text, kind="stable")
    word_bounds = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(words.counts)))])
    word_family = (np.concatenate([words.hashes, pairs]) >> shift).astype(np.int64)[order]
    cp, n = chars.cp.astype(np.uint64), len(chars.cp)
    three = cp[: max(0, n - 2)] * POWER[1] + cp[1 : max(1, n - 1)] * POWER[2] + cp[2:] * POWER[3] if n >= 3 else np.zeros(0, np.uint64)
    four = three[: max(0, n - 3)] + cp[3:] * POWER[4] if n >= 4 else np.zeros(0, np.uint64)
    # A window that crosses into the next text is dropped: its first character is too near its text's end.
    room = np.repeat(chars.offsets[1:], np.diff(chars.offsets)) - np.arange(n)
    keep3, keep4 = room[: len(three)] >= 3, room[: len(four)] >= 4
    both = np.zeros((n, 2), np.int64)
    both[: len(three), 0] = np.where(keep3, (mix(three + M1) >> shift).astype(np.int64) + 1, 0)
    both[: len(four), 1] = np.where(keep4, (mix(four + M2) >> shift).astype(np.int64) + 1, 0)
    flat = both.ravel()
    char_bounds = np.concatenate([[0], np.cumsum(flat > 0)])[2 * chars.offsets]
    return [(word_family, word_bounds), (flat[flat > 0] - 1, char_bounds)]


def mean_weights(family: tuple[np.ndarray, np.ndarray], weights: np.ndarray) -> np.ndarray:
    """Per text, the mean weight of its features, where SMOOTH features of weight 0 are added: short texts say little."""
    at, bounds = family
    total = np.diff(np.concatenate([[0.0], np.cumsum(weights[at])])[bounds])
    return total / (np.diff(bounds) + SMOOTH)
