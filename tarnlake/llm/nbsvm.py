"""Quality classifier: naive Bayes support vectors over byte and repetition n-grams.

Indicators of byte n-grams, and of n-grams over the sequence that says of each word
whether it repeats the word before it, are scaled by the log-ratio of their smoothed counts in
the two classes; a linear hinge-loss model over them is fitted by dual coordinate
descent.  Margins become scores by a logistic curve fitted to them.

The model is fitted on a bounded sample of labelled documents, ``SAMPLE`` per
class; its size is fixed by ``BITS``, so it is sent to tasks whatever the corpus.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import labelled_sample, map_batches

SAMPLE = 2000
GRAMS, BITS = (1, 2, 3), 16
# Longest n-gram over the repetition sequence.
REPEATS = 4
SIZE = (len(GRAMS) << BITS) + (2 << REPEATS)


def indicators(text: bytes | None) -> np.ndarray:
    """Sorted numbers, below ``SIZE``, of the n-grams in a text; long ones hashed to ``BITS`` bits."""
    raw = np.frombuffer(text or b"", np.uint8).astype(np.uint64)
    seen = np.zeros(SIZE, bool)
    for slot, n in enumerate(GRAMS):
        if len(raw) >= n:
            code = raw[: len(raw) - n + 1].copy()
            for j in range(1, n):
                code = code << np.uint64(8) | raw[j: len(raw) - n + 1 + j]
            if 8 * n > BITS:  # multiplicative hashing
                code = code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)
            seen[(slot << BITS) + code.astype(np.int64)] = True
    words = (text or b"").split()
    same = np.fromiter(map(eq, words, words[1:]), np.int64, max(0, len(words) - 1))
    code = np.ones(len(same), np.int64)  # a leading 1 tells lengths apart
    for n in range(1, min(REPEATS, len(same)) + 1):
        code = code[: len(same) - n + 1] * 2 + same[n - 1:]
        seen[(len(GRAMS) << BITS) + code] = True
    return np.flatnonzero(seen)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    scale: float
    shift: float

    def score(self, features: np.ndarray) -> float:
        """Probability of class 1."""
        margin = float(self.weights[features].sum()) / math.sqrt(max(1, len(features))) + self.bias
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.scale * margin + self.shift))))


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray, size: int, alpha: float = 1.0) -> np.ndarray:
    p, q = np.full(size, alpha), np.full(size, alpha)
    for x, label in zip(rows, y):
        (p if label > 0 else q)[x] += 1
    return np.log((p / p.sum()) / (q / q.sum()))


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, c: np.ndarray,
    epochs: int = 20, seed: int = 7,
) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear hinge-loss model; ``c`` is each row's cost."""
    w, bias, alpha = np.zeros(size), 0.0, np.zeros(len(rows))
    norm = np.array([float(v @ v) + 1 for v in values])
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in random.permutation(len(rows)):
            x, v = rows[i], values[i]
            gradient = y[i] * (float(w[x] @ v) + bias) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), c[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[x] += step * v
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, bias


def fit(rows: list[np.ndarray], labels: list[int], size: int, cost: float = 1.0) -> Model:
    """A model of the indicator rows; with one class only, its share is every score."""
    y = np.where(np.array(labels, int) > 0, 1.0, -1.0)
    share = float((y > 0).mean()) if len(y) else 0.5
    if not len(y) or share in (0.0, 1.0):
        return Model(np.zeros(size), 0.0, 0.0, math.log((share + 0.01) / (1.01 - share)))
    r = log_count_ratio(rows, y, size)
    values = [r[x] / math.sqrt(max(1, len(x))) for x in rows]
    c = np.where(y > 0, cost / (2 * share), cost / (2 * (1 - share)))
    w, bias = dual_coordinate_descent(rows, values, y, size, c)
    margins = np.array([float(w[x] @ v) for x, v in zip(rows, values)]) + bias
    scale, shift = logistic_curve(margins, (y > 0).astype(float))
    return Model(r * w, bias, scale, shift)


def logistic_curve(margins: np.ndarray, target: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of the likeliest logistic curve, by Newton steps with a small ridge."""
    a, b, x = 1.0, 0.0, np.column_stack([margins, np.ones_like(margins)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        gradient = x.T @ (p - target) + np.array([0.1 * (a - 1), 0.1 * b])
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(float(a), 1e-3), float(b)


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", keep: Column | None = None, sample: int = SAMPLE,
) -> Model:
    """Fit on at most ``sample`` labelled documents of each class."""
    rows = labelled_sample(docs, labels, label, {0: sample, 1: sample}, keep)
    rows = map_batches(rows, ["label", "text"], "label int, x array<int>", lambda: lambda y, texts: {
        "label": y, "x": [indicators(t) for t in texts]}).collect()
    return fit([np.array(r["x"], np.int64) for r in rows], [r["label"] for r in rows], SIZE)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row; a NULL or empty text has no n-grams and the score of the bias."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # SIZE doubles

    def make():
        own = sent.value
        return lambda ids, texts: {"doc_id": ids, "score": [own.score(indicators(t)) for t in texts]}

    return map_batches(docs, ["doc_id", "text"], "doc_id long, score double", make)
