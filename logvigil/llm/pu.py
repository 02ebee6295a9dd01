"""Quality from positives and unlabelled text: non-negative unbiased risk with an estimated class prior."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

from logvigil.llm import grams, linear
from logvigil.llm.linear import Linear, Sparse, sigmoid

FOLDS = 2
PRIOR_STEPS = 40
CALIBRATION = 3  # every third positive is kept for the calibration
BINS = 40
LEAST_SHARE = 0.05  # the prior is read off where at least this share of the positives lies
LOW, HIGH, CELLS = -40.0, 40.0, 80_000  # of a histogram of margins
FLOOR, CEILING = 0.05, 0.98


@dataclass(frozen=True)
class Histogram:
    """How many margins lie in each of CELLS equal cells from LOW to HIGH; those outside count at the ends."""

    counts: np.ndarray

    @staticmethod
    def of(margins: np.ndarray) -> np.ndarray:
        """The cell of each margin."""
        return np.clip(((margins - LOW) * (CELLS / (HIGH - LOW))).astype(np.int64), 0, CELLS - 1)

    @property
    def middles(self) -> np.ndarray:
        return LOW + (np.arange(CELLS) + 0.5) * ((HIGH - LOW) / CELLS)


def counted(margins: np.ndarray) -> Histogram:
    return Histogram(np.bincount(Histogram.of(margins), minlength=CELLS))


def fold_models(positive: list[str], unlabelled: list[str]) -> tuple[list[Linear], np.ndarray]:
    """Models that tell positives from unlabelled texts, each from the other folds, and each positive's margin by its own fold's model."""
    models, margins = [], []
    for fold in range(FOLDS):
        fit = lambda texts: [t for i, t in enumerate(texts) if i % FOLDS != fold]  # noqa: B023, E731
        p, u = fit(positive), fit(unlabelled)
        models.append(linear.logistic(p + u, np.array([1] * len(p) + [0] * len(u)), PRIOR_STEPS))
        margins.append(models[-1].margins([t for i, t in enumerate(positive) if i % FOLDS == fold]))
    return models, np.concatenate(margins)


def class_prior(positive: list[str], unlabelled: list[str]) -> float:
    """The share of positives among the unlabelled texts, each of which is scored by the model not fitted on it."""
    models, margins = fold_models(positive, unlabelled)
    rest = [m.margins([t for i, t in enumerate(unlabelled) if i % FOLDS == fold]) for fold, m in enumerate(models)]
    return prior_of(margins, counted(np.concatenate(rest)))


def prior_of(p: np.ndarray, unlabelled: Histogram) -> float:
    """The share of positives among unlabelled texts, from the margins of both.

    A model tells positives from unlabelled texts; on texts it was not fitted on, unlabelled texts
    above a threshold are at least prior times as frequent as positives above it, with equality where
    no negative lies. So the prior is the smallest such ratio over the thresholds.
    """
    n = unlabelled.counts.sum()
    at = Histogram.of(np.quantile(p, np.linspace(0, 1 - LEAST_SHARE, 50)))
    above_p = (Histogram.of(p)[None] >= at[:, None]).mean(1)
    above_u = unlabelled.counts[::-1].cumsum()[::-1][at] / max(1, n)
    width = np.sqrt(above_u * (1 - above_u) / max(1, n) + above_p * (1 - above_p) / max(1, len(p)))
    return float(np.clip(((above_u + width) / above_p).min(), FLOOR, CEILING))


@dataclass(frozen=True)
class Unlabelled:
    """The unlabelled part of the risk over some texts at the weights of a model: its mean and its gradient (weights, then the bias)."""

    model: Linear
    risk: float
    gradient: np.ndarray


def _add_risk(families: list, model: Linear, total: np.ndarray) -> float:
    """Add the gradient of the unlabelled risk over some texts to ``total``; their risk."""
    half = 1 << grams.FEATURE_BITS
    margin = grams.mean_weights(families[0], model.words) + grams.mean_weights(families[1], model.chars) + model.bias
    slope = sigmoid(margin)
    for f, (at, bounds) in enumerate(families):
        counts = np.diff(bounds)
        total[f * half : (f + 1) * half] += np.bincount(at, np.repeat(slope / (counts + grams.SMOOTH), counts), half)
    total[-1] += slope.sum()
    return float(np.logaddexp(0, margin).sum())


def risk_sums(texts: list[str], model: Linear) -> tuple[np.ndarray, float]:
    """Over some texts, the sums of the gradient of the unlabelled risk and of the risk itself."""
    total, risk = np.zeros((2 << grams.FEATURE_BITS) + 1), 0.0
    for low, high in grams.chunks(texts):
        risk += _add_risk(grams.features(grams.Chars(texts[low:high])), model, total)
    return total, risk


def side_by_side(models: list[Linear]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word weights, character weights and biases of all models, one after the other."""
    return np.concatenate([m.words for m in models]), np.concatenate([m.chars for m in models]), np.array([m.bias for m in models])


def margins_and_risk(texts: list[str], models: tuple, own: np.ndarray, at: Linear | None) -> tuple[np.ndarray, np.ndarray, float]:
    """Margin of each text by its ``own`` one of some models (:func:`side_by_side`), and :func:`risk_sums` at another one if given: features of a
    text are taken once for both."""
    *weights, bias = models
    half = 1 << grams.FEATURE_BITS
    margins, total, risk = bias[own].astype(float), np.zeros((2 << grams.FEATURE_BITS) + 1), 0.0
    for low, high in grams.chunks(texts):
        families = grams.features(grams.Chars(texts[low:high]))
        for (place, bounds), family in zip(families, weights, strict=True):
            margins[low:high] += grams.mean_weights((place + np.repeat(own[low:high] * half, np.diff(bounds)), bounds), family)
        if at is not None:
            risk += _add_risk(families, at, total)
    return margins, total, risk


def fitted(positive: list[str], unlabelled: list[str], prior: float, corpus: Unlabelled | None = None) -> Linear:
    """The linear model of least non-negative risk under the logistic loss.

    With ``corpus`` the unlabelled part of the risk is that of the whole corpus, to the first order: the sample's, moved so that risk and
    gradient are the corpus's own at the weights that ``corpus`` was taken at. The sample then only says how the gradient bends.
    """
    n, m = len(positive), len(unlabelled)
    rows = Sparse(positive + unlabelled)
    anchor, shift, lift = np.zeros((2 << grams.FEATURE_BITS) + 1), 0.0, 0.0
    if corpus is not None:
        anchor = linear.stacked(corpus.model)
        u = rows.margins(anchor[:-1])[n:] + anchor[-1]
        slope = sigmoid(u) / m
        here = np.append(rows.gradient(np.concatenate([np.zeros(n), slope])), slope.sum())
        shift, lift = corpus.gradient - here, corpus.risk - np.logaddexp(0, u).mean()

    def overfits(margin: np.ndarray, w: np.ndarray) -> bool:
        """The risk on negatives is below what any classifier can have."""
        p, u = margin[:n], margin[n:]
        moved = lift + float(np.dot(shift, w - anchor)) if corpus is not None else 0.0
        return np.logaddexp(0, u).mean() + moved < prior * np.logaddexp(0, p).mean()

    def slopes(margin: np.ndarray, w: np.ndarray) -> np.ndarray:
        p, u = margin[:n], margin[n:]
        if overfits(margin, w):  # undo
            return np.concatenate([prior * sigmoid(p) / n, -sigmoid(u) / m])
        return np.concatenate([np.full(n, -prior / n), sigmoid(u) / m])

    def more(margin: np.ndarray, w: np.ndarray) -> np.ndarray:
        return -shift if overfits(margin, w) else shift

    return linear.descended(rows, slopes, more_of=more if corpus is not None else None)


def calibrated(model: Linear, positive: list[str], unlabelled: Histogram, prior: float) -> Linear:
    """The model with slope and shift such that its score is the chance of a positive.

    By Bayes' rule that chance is prior times the ratio of the margins' densities among positives and
    among unlabelled texts, here in bins of about equal numbers of unlabelled texts, falling towards low margins.
    """
    p, counts = Histogram.of(model.margins(positive)), unlabelled.counts
    n, cells = counts.sum(), np.flatnonzero(counts)
    bin_of = np.minimum((counts.cumsum() - counts) * BINS // max(1, n), BINS - 1)  # of each cell: where its first text lies
    count_p = np.bincount(bin_of[p], minlength=BINS)
    count_u = np.bincount(bin_of, counts, BINS)
    chance = np.clip(prior * (count_p + 0.01) / max(1, len(p)) / ((count_u + 0.01) / max(1, n)), 0, 1)
    chance = np.maximum.accumulate(np.where(count_u > 0, chance, 0))
    model.slope, model.shift = linear.matched(unlabelled.middles[cells], chance[bin_of[cells]], weights=counts[cells] / n)
    return model


def learned(
    positive: list[str], unlabelled: list[str], corpus: Callable[[list[Linear], Linear | None], tuple[Histogram, Unlabelled | None]]
) -> Linear:
    """Prior, model and calibration from positives and unlabelled texts, in an order that says nothing about them.

    ``corpus`` reads all documents: it gives the margins of each by one of some models, and the unlabelled risk and its gradient at
    another one. A first model is fitted on the sample ``unlabelled`` alone; the gradient that all documents have there corrects it. So
    prior, weights and calibration all follow the whole corpus, and the sample only starts the search.
    """
    models, margins = fold_models(positive, unlabelled)
    rest = [m.margins([t for i, t in enumerate(unlabelled) if i % FOLDS == fold]) for fold, m in enumerate(models)]
    fit, kept = ([t for i, t in enumerate(positive) if bool(i % CALIBRATION) == used] for used in (True, False))
    first = fitted(fit, unlabelled, prior_of(margins, counted(np.concatenate(rest))))
    histogram, whole = corpus(models, first)
    prior = prior_of(margins, histogram)
    model = fitted(fit, unlabelled, prior, whole)
    return calibrated(model, kept, corpus([model], None)[0], prior)
