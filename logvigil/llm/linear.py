"""Linear models on hashed n-grams: fitted on a bounded sample, scored in Arrow batches."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from logvigil.llm import grams

STEPS, RATE, DECAY = 80, 0.5, 1e-4


@dataclass
class Linear:
    """Weights of the two families, bias, and the calibration of the score."""

    words: np.ndarray
    chars: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margins(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts))
        for low, high in grams.chunks(texts):
            words, chars = grams.features(grams.Chars(texts[low:high]))
            out[low:high] = grams.mean_weights(words, self.words) + grams.mean_weights(chars, self.chars)
        return out + self.bias

    def scores(self, texts: list[str]) -> np.ndarray:
        return sigmoid(self.slope * self.margins(texts) + self.shift)


def stacked(model: Linear) -> np.ndarray:
    """All weights of a model in a row, the bias last."""
    return np.concatenate([model.words, model.chars, [model.bias]]).astype(np.float64)


def parts(model: Linear | None) -> tuple:
    """The model as plain values."""
    return (None,) if model is None else (model.words, model.chars, model.bias, model.slope, model.shift)


def remade(words: np.ndarray | None, *rest) -> Linear | None:
    return None if words is None else Linear(words, *rest)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Sparse:
    """Texts as rows of feature shares, for fitting."""

    def __init__(self, texts: list[str]):
        at, share, row = [], [], []
        for low, high in grams.chunks(texts):
            for f, (features, bounds) in enumerate(grams.features(grams.Chars(texts[low:high]))):
                counts = np.diff(bounds)
                text = np.repeat(np.arange(low, high), counts)
                both, n = np.unique((text << (grams.FEATURE_BITS + 1)) | (f << grams.FEATURE_BITS) | features, return_counts=True)
                r = both >> (grams.FEATURE_BITS + 1)
                at.append(both & ((2 << grams.FEATURE_BITS) - 1))
                row.append(r)
                share.append(n / (counts + grams.SMOOTH)[r - low])
        cat = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        self.at, self.row, self.share, self.rows = cat(at, np.int32), cat(row, np.int32), cat(share, np.float32), len(texts)

    def margins(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.share * weights[self.at], self.rows)

    def gradient(self, slopes: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, self.share * slopes[self.row], 2 << grams.FEATURE_BITS)


def descended(rows: Sparse, slopes_of, steps: int = STEPS, rate: float = RATE, more_of=None) -> Linear:
    """Weights found by Adam; ``slopes_of`` gives the slope of the risk for each row's margin, ``more_of`` what is added to the gradient (for
    weights and bias), given the same margins and the weights."""
    size = 2 << grams.FEATURE_BITS
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        margin = rows.margins(w[:-1]) + w[-1]
        slopes = slopes_of(margin, w)
        g = np.append(rows.gradient(slopes) + DECAY * w[:-1], slopes.sum())
        if more_of is not None:
            g += more_of(margin, w)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    half = size // 2
    return Linear(w[:half].astype(np.float32), w[half:size].astype(np.float32), float(w[-1]))


def logistic(texts: list[str], labels: np.ndarray, steps: int = STEPS) -> Linear:
    """Logistic regression, both classes weighted alike."""
    share = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
    return descended(Sparse(texts), lambda margin, _: share * (sigmoid(margin) - labels), steps)


def platt(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn margins into probabilities, from labels smoothed by one row a class."""
    pos, neg = (labels == 1).sum(), (labels == 0).sum()
    return matched(margins, np.where(labels == 1, (pos + 1) / (pos + 2), 1 / (neg + 2)))


def matched(margins: np.ndarray, target: np.ndarray, steps: int = 50, weights: np.ndarray | float = 1.0) -> tuple[float, float]:
    """Slope and shift that bring sigmoid(slope * margin + shift) nearest to target probabilities (Newton steps)."""
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * margins + b)
        d, w = weights * (p - target), weights * np.maximum(p * (1 - p), 1e-9)
        ga, gb = (d * margins).sum() + 1e-6 * a, d.sum()
        haa, hab, hbb = (w * margins * margins).sum() + 1e-6, (w * margins).sum(), w.sum() + 1e-6
        det = haa * hbb - hab * hab
        if det <= 1e-12:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = 1.0 / max(1.0, abs(da), abs(db))
        a, b = a - step * da, b - step * db
    return float(a), float(b)
