"""Toxicity of texts that hide words: noisy-channel restoring, then scoring of the restored text.

A disguised stretch (digits or signs for letters, letters apart, letters repeated) is a lattice of what
each character may stand for. Viterbi takes the path that is likeliest under a character trigram model
of the whole corpus and of the words learned to be toxic, times the cost of each disguise.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logvigil.llm import grams, linear, samples
from logvigil.llm.tables import Shared, slices

SYMBOLS = 60  # space, a-z, the Latin-1 letters, any other letter
BLANK, OTHER = 0, 59
LATIN = 0xDF
# What a sign can stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i", "*": "aeiou", "#": "aeiou",
}
SIGNS = frozenset(LEET)
SIGN = re.escape("".join(LEET))
WORD = re.compile(r"[^\W\d_]+")
EDGES = ".,;:!?\"'()[]{}<>*#%&|"  # taken off a token before it is looked at
PLAIN_EDGES = "".join(c for c in EDGES if c not in LEET)  # those that stand for no letter
SPELT = re.compile(rf"(?:[^\W_]|[{SIGN}])(?:[.\-_*~](?:[^\W_]|[{SIGN}])){{2,}}")  # a token of single characters apart
THRICE = re.compile(r"([^\W\d_])\1\1+")
SWAP, DROP, KEEP_GAP = math.log(0.4), math.log(0.5), math.log(0.05)  # log costs of the disguises
CACHED = 200_000
BEGINNINGS = (4, 5, 6)  # lengths of word beginnings that are features
LEAST_TEXTS = 3  # toxic texts that a feature has to occur in
LEAST_WEIGHT = 2.5  # features below tell too little
MOST_FEATURES = 20_000
TOP = 3  # of a text's words, the most toxic ones
RIDGE = 1e-4
APART = 3  # so many tokens of one character in a row are looked at as one word; of one or two with all but one of them single
LONGEST_SHORT = 8  # longer tokens are no single characters in punctuation
LEXICON_SHARE = 0.3  # of the learned words in the character model


def symbols(chars: np.ndarray) -> np.ndarray:
    """Lower-case code points as symbols of the character model."""
    letter = (chars >= 97) & (chars <= 122)
    latin = (chars >= LATIN) & (chars <= 0xFF) & (chars != 0xF7)
    other = (chars > 0x180) & ~((chars >= 0x2000) & (chars <= 0x2BFF))
    return np.select([letter, latin, other], [chars.astype(np.int64) - 96, np.minimum(27 + (chars.astype(np.int64) - LATIN), 58), OTHER], BLANK)


def trigram_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How often each three symbols follow each other, over whole texts of all documents.

    Summed within each batch, then by Spark; the driver gets one row per trigram that occurs.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            texts = [(t or "").lower() for t in part.column(0).to_pylist()]
            sums = np.zeros(SYMBOLS**3, np.int64)
            for low, high in grams.chunks(texts):
                s = symbols(np.frombuffer("  ".join(["", *texts[low:high], ""]).encode("utf-32-le", "surrogatepass"), "<u4"))
                if len(s) > 2:
                    sums += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums[at], pa.int64())], names=["at", "n"])

    found = docs.select(text).mapInArrow(batches, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SYMBOLS**3)
    counts[found["at"].to_numpy(np.int64)] = found["n"].to_numpy(float)
    return counts


def log_model(counts: np.ndarray) -> np.ndarray:
    """Log chance of a symbol after two others, smoothed by shorter histories."""
    three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS) + 0.0
    two = three.sum(0)
    one = (two.sum(0) + 1) / (two.sum() + SYMBOLS)
    after_one = (two + 5 * one) / (two.sum(1, keepdims=True) + 5)
    return np.log((three + 5 * after_one[None]) / (three.sum(2, keepdims=True) + 5))


def mixed_model(corpus: np.ndarray, words: list[str]) -> np.ndarray:
    """The character model: mostly the corpus, and a share of the learned words."""
    if not words:
        return log_model(corpus)
    s = symbols(np.frombuffer("  ".join(["", *words, ""]).encode("utf-32-le", "surrogatepass"), "<u4"))
    own = np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3).astype(float)
    return np.log((1 - LEXICON_SHARE) * np.exp(log_model(corpus)) + LEXICON_SHARE * np.exp(log_model(own)))


def features(word: str) -> list[str]:
    """The word, and its beginnings."""
    return [f"{word}$", *[word[:n] for n in BEGINNINGS if len(word) > n]]


@dataclass
class Detector:
    """The learned parts, and what a worker remembers of tokens and characters."""

    weights: dict[str, float]  # of features
    log_p: list  # of a symbol after two others
    model: tuple[float, ...]  # bias, then the weights of what ``signals`` gives
    known: dict[str, float] = field(default_factory=dict, repr=False)
    symbol: dict[str, int] = field(default_factory=dict, repr=False)

    def word(self, word: str) -> float:
        """How much likelier in toxic texts (log): of the word's features, the most telling one."""
        get = self.weights.get
        return max(get(f"{word}$", 0.0), get(word[:4], 0.0), get(word[:5], 0.0), get(word[:6], 0.0))

    def words(self, text: str) -> float:
        return max(map(self.word, WORD.findall(text)), default=0.0)

    def token(self, token: str) -> float:
        """The weight of a token in lower case, as it stands and restored."""
        value = self.known.get(token)
        if value is None:
            value = max(map(self.stretch, forms(token)))
            if len(self.known) >= CACHED:
                self.known.clear()
            self.known[token] = value
        return value

    def stretch(self, core: str) -> float:
        """The weight of one form of a token, as it stands and restored."""
        value = self.words(core)
        if not core.isalpha() and len(set(core)) > 1:  # one character alone or repeated hides no word
            if SPELT.fullmatch(core):
                value = max(value, self.words(self.restored(core, apart=True)))
            elif not SIGNS.isdisjoint(core):
                value = max(value, self.words(self.restored(core.rstrip("$@") if core.endswith(("$$$", "@@@")) else core)))
        if THRICE.search(core):
            value = max(value, self.words(self.restored(core)))
        return value

    def restored(self, stretch: str, apart: bool = False) -> str:
        """The likeliest undisguised form: signs may be letters, letters three times may be one or two, and with
        ``apart`` gaps may close."""
        p = self.log_p
        # by the last two symbols: cost, and the letters as pairs of (letters before, letter), so that a step copies no text
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(BLANK, BLANK): (0.0, None)}
        for char, again in _runs(stretch):
            if char in SIGNS and not (apart and char == "*"):
                options = [(SWAP, c) for c in LEET[char]]
            elif char.isalpha():
                options = [(0.0, char), (DROP, "")] if again else [(0.0, char)]
            elif apart:
                options = [(DROP, ""), (KEEP_GAP, " ")]
            else:
                options = [(0.0, " ")]
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, said) in states.items():
                for log_cost, letter in options:
                    if letter:
                        c = self.symbol.get(letter)
                        if c is None:
                            c = self.symbol[letter] = int(symbols(np.array([ord(letter)], np.uint32))[0])
                        key, value = (b, c), (cost + log_cost + p[a][b][c], (said, letter))
                    else:
                        key, value = (a, b), (cost + log_cost, said)
                    if key not in after or value[0] > after[key][0]:
                        after[key] = value
            states = after
        said, letters = max(((cost + p[a][b][BLANK], said) for (a, b), (cost, said) in states.items()), key=lambda end: end[0])[1], []
        while said:
            said, letter = said
            letters.append(letter)
        return "".join(reversed(letters))

    def closed(self, span: str) -> str:
        return self.restored(span, apart=True)

    def signals(self, text: str) -> list[float]:
        """The weights of the most toxic tokens of the text and its restored stretches, and how many stand out."""
        tokens = text.lower().split()
        found = [v for v in map(self.token, set(tokens)) if v]
        found += [max(map(self.words, map(self.closed, spans))) for spans in spelt(tokens)]
        found.sort(reverse=True)
        return [*(found + [0.0] * TOP)[:TOP], math.log1p(sum(v > 0 for v in found))]

    def score(self, text: str) -> float:
        bias, *weights = self.model
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, bias + sum(w * s for w, s in zip(weights, self.signals(text)))))))


def forms(token: str) -> set[str]:
    """The token without its edges, and with those signs at its edges that can stand for a letter."""
    return {token.strip(EDGES), token.strip(PLAIN_EDGES), token.lstrip(PLAIN_EDGES).rstrip(EDGES), token.lstrip(EDGES).rstrip(PLAIN_EDGES)}


def spelt(tokens: list[str]) -> Iterator[set[str]]:
    """Words spelt with gaps: of each run of short tokens with single characters in it, the spans that may be the word.

    A token counts without the punctuation around it. Two characters may stand together: the span goes from the first single character
    to the last one, with and without a pair before and after it. Runs of APART single characters are spans of their own.
    """
    cores = [t if len(t) > LONGEST_SHORT else t.strip(EDGES) or t.strip(PLAIN_EDGES) or t for t in tokens]
    sizes = bytes(min(len(c), 3) for c in cores)
    signed = [t if n > 2 else t.strip(PLAIN_EDGES) or t for t, n in zip(tokens, sizes)]
    for run in re.finditer(b"[\1\2]{2,}", sizes):
        start, stop = run.span()
        if run[0].count(b"\1") < APART - 1 or stop - start < APART:
            continue
        first, last = start + run[0].index(b"\1"), start + run[0].rindex(b"\1") + 1
        bounds = {(a, b) for a in (max(start, first - 1), first) for b in (last, min(stop, last + 1)) if b - a >= APART}
        bounds |= {(start + m.start(), start + m.end()) for m in re.finditer(b"\1{%d,}" % APART, run[0])}
        spans = {" ".join(kind[a:b]) for a, b in bounds for kind in (cores, signed)}
        if spans:
            yield spans


def _runs(stretch: str) -> Iterator[tuple[str, bool]]:
    """The characters; of a letter that comes three times or more, two, the second one marked."""
    for match in re.finditer(r"(.)\1*", stretch, re.DOTALL):
        char, n = match[1], len(match[0])
        if char.isalpha() and n >= 3:
            yield char, False
            yield char, True
        else:
            for _ in range(n):
                yield char, False


def learned(toxic: list[str], clean: list[str], corpus: np.ndarray) -> Detector:
    """Feature weights from two thirds of the texts, the text model from the rest."""
    fit = lambda texts: [t for i, t in enumerate(texts) if i % 3]
    rest = lambda texts: [t for i, t in enumerate(texts) if not i % 3]

    def shares(texts: list[str]) -> Counter[str]:
        n: Counter[str] = Counter()
        for text in texts:
            n.update({f for w in set(WORD.findall(text.lower())) for f in features(w)})
        return n

    toxic_n, clean_n = shares(fit(toxic)), shares(fit(clean))
    size_t, size_c = len(fit(toxic)) + 1, len(fit(clean)) + 1
    weight = {
        # less what chance alone would give a feature of few texts
        f: math.log((n + 0.5) / size_t) - math.log((clean_n[f] + 0.5) / size_c) - 1.5 / math.sqrt(n)
        for f, n in toxic_n.items() if n >= LEAST_TEXTS
    }
    telling = sorted((f for f, w in weight.items() if w >= LEAST_WEIGHT), key=lambda f: (-weight[f] * math.sqrt(toxic_n[f]), f))
    weights = {f: weight[f] for f in telling[:MOST_FEATURES]}
    log_p = mixed_model(corpus, [f[:-1] for f in telling if f[-1] == "$"][:500]).tolist()
    start = Detector(weights, log_p, (0.0,))
    labels = np.array([1.0] * len(rest(toxic)) + [0.0] * len(rest(clean)))
    x = np.array([[1.0, *start.signals(t)] for t in rest(toxic) + rest(clean)])
    share = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
    w = np.zeros(x.shape[1])
    for _ in range(100):  # Newton steps of a ridge logistic regression
        p = linear.sigmoid(x @ w)
        g = x.T @ (share * (p - labels)) + RIDGE * w
        h = (x * (share * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + RIDGE * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step / max(1.0, np.abs(step).max())
    return Detector(weights, log_p, tuple(float(v) for v in w))


def detector(docs: DataFrame, labels: DataFrame, rows: Column | None = None, most: int = samples.ROWS) -> Detector | None:
    """Learn from at most ``most`` texts of each label; the character model reads all documents. None with too few texts."""
    toxic, clean = (samples.labelled_texts(docs, labels, "toxic", value, rows, most) for value in (1, 0))
    if min(len(toxic), len(clean)) < 10:
        return None
    return learned(toxic, clean, trigram_counts(docs))


def _remade(*parts) -> Detector | None:
    return Detector(*parts) if parts else None


def scored(docs: DataFrame, model: Detector | None, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the chance that each text is toxic; null texts count as empty; 0 without a model.

    A column named like the score is replaced; repeated rows are scored alike.
    """
    docs = docs.drop(score)
    schema = docs.select("*").schema.add(score, "double")
    shared = Shared(docs.sparkSession, _remade, *((model.weights, model.log_p, model.model) if model else ()))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detector_of = shared.get()
        for part in slices(parts):
            found = [detector_of.score(t or "") if detector_of else 0.0 for t in part.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.float64())], names=[*part.schema.names, score])

    return docs.mapInArrow(batches, schema)
