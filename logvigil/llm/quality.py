"""Quality of texts: exact base rules, and linear models on hashed n-grams."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from logvigil.llm import grams, linear, pu, samples
from logvigil.llm.tables import Shared, slices

LEAST_ROWS = 10  # with fewer texts of a class no model is fitted
LEAST_WORDS, MOST_REPEATED = 50, 50  # words; percent of words
THRESHOLD = 0.3
CALIBRATION = 3
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class BaseRules:
    """A text fails with too few words or too large a share of words in repeated windows of three."""

    least_words: int = LEAST_WORDS
    most_repeated: int = MOST_REPEATED

    def failed(self, n_words: np.ndarray, n_repeat_words: np.ndarray) -> np.ndarray:
        return (n_words < self.least_words) | (100 * n_repeat_words > self.most_repeated * n_words)


def base_counts(texts: list[str]) -> list[np.ndarray]:
    """The columns of BASE for some texts."""
    found = []
    for low, high in grams.chunks(texts):
        chars = grams.Chars(texts[low:high])
        words = chars.words()
        found.append([
            words.counts, chars.sums(~grams.IS_SPACE[chars.small]), chars.sums(grams.IS_SYMBOL[chars.small]),
            np.array([grams.repeated_lines(t) for t in texts[low:high]], np.int64), grams.repeated_words(words),
        ])
    return [np.concatenate(c).astype(np.int64) for c in zip(*found)] if found else [np.zeros(0, np.int64) for _ in BASE]


def quality_model(docs: DataFrame, labels: DataFrame, rows: Column | None = None, most: int = samples.ROWS) -> linear.Linear | None:
    """Logistic regression on word and character n-grams of labelled texts, at most ``most`` of each class.

    Two thirds fit the weights and the rest the calibration. None where a class has too few texts.
    """
    good, bad = (samples.labelled_texts(docs, labels, "quality", value, rows, most) for value in (1, 0))
    if min(len(good), len(bad)) < LEAST_ROWS:
        return None
    fit = lambda texts: [t for i, t in enumerate(texts) if i % CALIBRATION]
    rest = lambda texts: [t for i, t in enumerate(texts) if not i % CALIBRATION]
    marks = lambda g, b: np.array([1] * len(g) + [0] * len(b))
    model = linear.logistic(fit(good) + fit(bad), marks(fit(good), fit(bad)))
    model.slope, model.shift = linear.platt(model.margins(rest(good) + rest(bad)), marks(rest(good), rest(bad)))
    return model


def ruled(
    docs: DataFrame, model: linear.Linear | None, rules: BaseRules = BaseRules(), threshold: float = THRESHOLD, text: str = "text"
) -> DataFrame:
    """``docs`` with the columns of BASE, base_failed, quality_score and kept.

    A text is kept if it passes the base rules and its calibrated score reaches the threshold; without
    a model all that pass are kept, with a null score. Null texts count as empty: no words, so not kept. Every row is judged on
    its own and gives a row; columns with these names are replaced.
    """
    new = (*BASE, "base_failed", "quality_score", "kept")
    docs = docs.drop(*new)
    schema = docs.select("*").schema
    for name in BASE:
        schema = schema.add(name, "long")
    schema = schema.add("base_failed", "boolean").add("quality_score", "double").add("kept", "boolean")
    shared = Shared(docs.sparkSession, linear.remade, *linear.parts(model))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_of = shared.get()
        for part in slices(parts):
            texts = [t or "" for t in part.column(text).to_pylist()]
            counts = base_counts(texts)
            failed = rules.failed(counts[0], counts[4])
            if model_of is None:
                scores, good = pa.nulls(len(texts), pa.float64()), ~failed
            else:
                p = model_of.scores(texts)
                scores, good = pa.array(p, pa.float64()), ~failed & (p >= threshold)
            columns = [*part.columns, *[pa.array(c, pa.int64()) for c in counts], pa.array(failed), scores, pa.array(good)]
            yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *new])

    return docs.mapInArrow(batches, schema)


def pu_model(docs: DataFrame, labels: DataFrame, rows: Column | None = None, most: int = samples.ROWS) -> linear.Linear | None:
    """The positive-unlabelled model: texts labelled good, and all documents.

    At most ``most`` labelled texts are used, and as many documents start the search; the gradient of the unlabelled risk, the class prior and
    the calibration are those of all documents. None, and so a score of 0.5, with fewer than LEAST_ROWS texts of either kind.
    """
    positive = samples.labelled_texts(docs, labels, "quality", 1, rows, most)
    unlabelled = samples.unlabelled_texts(docs, most)
    if min(len(positive), len(unlabelled)) < LEAST_ROWS:
        return None
    sample = {hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest(): i % pu.FOLDS for i, t in enumerate(unlabelled)}
    return pu.learned(positive, unlabelled, lambda models, at: over_corpus(docs, models, sample, at))


BLOCK = 1 << 12  # sums of a gradient that travel together


def over_corpus(
    docs: DataFrame, models: list[linear.Linear], folds: dict[bytes, int], at: linear.Linear | None = None, text: str = "text"
) -> tuple[pu.Histogram, pu.Unlabelled | None]:
    """Sums over all documents, in one pass: a histogram of their margins and, if ``at`` is given, the unlabelled risk and its gradient there.

    A document's margin is by one of the models: the one not fitted on it, where ``folds`` (by the text's digest) says so, else one by its
    digest. Each task adds up its documents, Spark the tasks; the driver gets one row for each block of cells or features that holds any.
    """
    shared = Shared(docs.sparkSession, _scorers, folds, linear.parts(at), *map(linear.parts, models))
    size = pu.CELLS + (2 << grams.FEATURE_BITS) + 3  # cells, gradient of weights and bias, risk, documents

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, place, scorers = shared.get()
        models_of = pu.side_by_side(scorers)
        total = np.zeros(-(-size // BLOCK) * BLOCK)
        for part in slices(parts):
            texts = [t or "" for t in part.column(0).to_pylist()]
            digests = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in texts]
            own = np.array([known.get(d, d[0]) % len(scorers) for d in digests], np.int64)
            margins, gradient, risk = pu.margins_and_risk(texts, models_of, own, place)
            np.add.at(total, pu.Histogram.of(margins), 1)
            if place is not None:
                total[pu.CELLS : size - 2] += gradient
                total[size - 2] += risk
            total[size - 1] += len(texts)
        blocks = total.reshape(-1, BLOCK)
        held = np.flatnonzero(blocks.any(axis=1))
        yield _blocks(held, blocks[held])

    def added(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for part in parts:
            for block, values in zip(part.column("block").to_pylist(), part.column("sums").to_pylist()):
                sums[block] = sums.get(block, 0) + np.frombuffer(values)
        yield _blocks(np.array(sorted(sums), np.int64), [sums[b] for b in sorted(sums)])

    schema = "block int, sums binary"
    blocks = docs.select(text).mapInArrow(counted, schema).repartition("block").mapInArrow(added, schema)
    total = np.zeros(-(-size // BLOCK) * BLOCK)
    for row in blocks.collect():  # a fixed number of blocks
        total[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = np.frombuffer(row["sums"])
    histogram = pu.Histogram(total[: pu.CELLS].astype(np.int64))
    n = max(1.0, total[size - 1])
    return histogram, None if at is None else pu.Unlabelled(at, total[size - 2] / n, total[pu.CELLS : size - 2] / n)


def _blocks(numbers: np.ndarray, sums) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(numbers, pa.int32()), pa.array([np.asarray(s).tobytes() for s in sums], pa.binary())], names=["block", "sums"]
    )


def _scorers(folds: dict[bytes, int], at: tuple, *models: tuple) -> tuple[dict[bytes, int], linear.Linear | None, list[linear.Linear]]:
    return folds, linear.remade(*at), [linear.remade(*m) for m in models]


def scored(docs: DataFrame, model: linear.Linear | None, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the model's score of each text; a null text counts as empty; 0.5 without a model.

    A column named like the score is replaced.
    """
    docs = docs.drop(score)
    schema = docs.select("*").schema.add(score, "double")
    shared = Shared(docs.sparkSession, linear.remade, *linear.parts(model))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_of = shared.get()
        for part in slices(parts):
            texts = [t or "" for t in part.column(text).to_pylist()]
            found = np.full(len(texts), 0.5) if model_of is None else model_of.scores(texts)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.float64())], names=[*part.schema.names, score])

    return docs.mapInArrow(batches, schema)
