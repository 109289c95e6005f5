"""Toxicity as an ordinal grade: a cumulative-link regression on sparse text features.

P(grade > k) = logistic(w.x - t_k): one weight vector for all grades, ordered
thresholds, and an expected severity, the sum over k.  Features are the words of a
text and the character n-grams inside them, counted and damped; only those tied to
the label in a bounded sample of labelled documents are kept.

Labels say toxic or not.  Grades above 0 come from how many words of a toxic
sample document carry a kept feature, cut at equal shares of these documents;
``fit`` takes any grades.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import SLICE, labelled_sample, map_batches
from tarnlake.session import stage

# Sample bound by label, kept features, grades above 0.
SAMPLE = {0: 4000, 1: 2500}
FEATURES, GRADES = 512, 3
# Chi-square a feature needs, well beyond chance for the number of features tried.
MIN_CHI2 = 40.0
# ... and how much more often toxic documents must have it: long texts have more of every word.
MIN_LIFT = 4.0
GRAM, PREFIX = 5, 4
# Words a cache keeps, and as many of those before: with packed features about 25 MB.
CACHE_WORDS = 50_000
EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def word_features(word: bytes) -> set[int]:
    """Hashes of the word without punctuation at its ends, its start and its inner n-grams."""
    core = word.decode().strip(EDGES).lower()
    if not core:
        return set()
    parts = {" " + core + " "} | {core[i:i + GRAM] for i in range(len(core) - GRAM + 1)}
    if len(core) > PREFIX:
        parts.add(" " + core[:PREFIX])
    return {xxhash.xxh3_64_intdigest(p) - (1 << 63) for p in parts}


def packed_features(word: bytes) -> bytes:
    """``word_features`` as little-endian longs: a set of numbers takes about ten times the memory."""
    found = word_features(word)
    return np.fromiter(found, "<i8", len(found)).tobytes()


class WordCache(dict):
    """What ``make`` gives for a word, never None, kept for a bounded number of words.

    A full cache is set aside, and words still in use come back from there.
    """

    def __init__(self, make):
        super().__init__()
        self.make, self.before = make, {}

    def __missing__(self, word: bytes):
        if len(self) >= CACHE_WORDS:
            self.before = {}  # gone before its successor is copied
            self.before = dict(self)
            self.clear()
        value = self.before.get(word)
        if value is None:
            value = self.make(word)
        self[word] = value
        return value


@dataclass
class Model:
    index: dict[int, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def hits(self, word: bytes) -> tuple[int, ...]:
        return tuple(sorted(self.index[f] for f in word_features(word) if f in self.index))

    def severity(self, hits: list[tuple[int, ...]]) -> np.ndarray:
        """P(grade > k) of a text whose words have these features."""
        counts = np.bincount([f for h in hits for f in h], minlength=len(self.weights))
        return logistic(float(self.weights @ np.log1p(counts)) - self.thresholds)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_cumulative_link(
    x: np.ndarray, grade: np.ndarray, grades: int, ridge: float = 1e-6, rounds: int = 800, rate: float = 0.1,
) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ordered thresholds by Adam on the mean log likelihood.

    Thresholds are the first one plus exponentials, so their order always holds.
    """
    n, d = x.shape
    w, raw = np.zeros(d), np.concatenate([[1.0], np.zeros(grades - 1)])
    state = [np.zeros(d + grades), np.zeros(d + grades)]
    row = np.arange(n)
    for step in range(1, rounds + 1):
        gaps = np.concatenate([raw[:1], np.exp(raw[1:])])
        t = np.cumsum(gaps)
        above = logistic((x @ w)[:, None] - t)  # P(grade > k)
        edge = np.column_stack([np.ones(n), above, np.zeros(n)])
        p = np.maximum(edge[row, grade] - edge[row, grade + 1], 1e-9)
        slope = np.column_stack([np.zeros(n), above * (1 - above), np.zeros(n)])
        hi, lo = slope[row, grade] / p, slope[row, grade + 1] / p
        dt = np.zeros((n, grades + 2))
        dt[row, grade] += hi
        dt[row, grade + 1] -= lo
        by_threshold = dt[:, 1:-1].mean(axis=0)
        tail = np.cumsum(by_threshold[::-1])[::-1]
        gradient = np.concatenate([-(x.T @ (hi - lo)) / n + ridge * w, tail * np.concatenate([[1.0], gaps[1:]])])
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.999 * state[1] + 0.001 * gradient**2
        move = rate * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-8)
        w, raw = w - move[:d], raw - move[d:]
    return w, np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))


def select_features(sample: DataFrame, totals: dict[int, int], features: int = FEATURES) -> list[int]:
    """Features found in more toxic than clean sample documents than chance allows, strongest first."""
    class Count:
        def __init__(self):
            self.of = WordCache(packed_features)

        def __call__(self, labels, texts):
            own = [np.unique(np.frombuffer(b"".join(map(self.of.__getitem__, set(t.split()))), "<i8")) for t in texts]
            toxic = np.repeat([label > 0 for label in labels], [len(f) for f in own])
            f, at = np.unique(np.concatenate(own), return_inverse=True)
            return {"f": f, "neg": np.bincount(at[~toxic], minlength=len(f)), "pos": np.bincount(at[toxic], minlength=len(f))}

    counts = map_batches(sample, ["label", "text"], "f long, neg long, pos long", Count)
    counts = counts.groupBy("f").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")).where("pos > 0")
    neg, pos = float(totals.get(0, 0)), float(totals.get(1, 0))
    a, b = F.col("pos").cast("double"), F.col("neg").cast("double")
    spread = (a + b) * (neg + pos - a - b) * neg * pos
    chi2 = (neg + pos) * F.pow(a * neg - b * pos, F.lit(2.0)) / F.greatest(spread, F.lit(1.0))
    strong = counts.withColumn("chi2", chi2).where((a * neg > MIN_LIFT * b * pos) & (F.col("chi2") >= MIN_CHI2))
    return [r["f"] for r in strong.orderBy(F.desc("chi2"), "f").limit(features).collect()]


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: dict[int, int] = SAMPLE, grades: int = GRADES,
    keep: Column | None = None,
) -> Model:
    """A model from a bounded sample; without both labels nothing is ever toxic."""
    rows = stage(labelled_sample(docs, labels, label, sample, keep), "toxic-sample")
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    nothing = Model({}, np.zeros(0), np.full(grades, 30.0))
    if not (totals.get(0) and totals.get(1)):
        return nothing
    chosen = select_features(rows, totals)
    if not chosen:
        return nothing
    model = Model({f: i for i, f in enumerate(chosen)}, np.zeros(len(chosen)), np.zeros(grades))

    def make():
        of = WordCache(model.hits)

        def work(y, texts):
            hits = [[h for w in t.split() if (h := of[w])] for t in texts]
            return {"label": y, "words": [len(h) for h in hits], "x": [sorted(f for v in h for f in v) for h in hits]}
        return work

    found = map_batches(rows, ["label", "text"], "label int, words int, x array<int>", make).collect()
    words = np.array([r["words"] for r in found])
    toxic = np.array([r["label"] > 0 for r in found])
    # Equal shares of the toxic documents by their number of telling words.
    cuts = np.quantile(words[toxic], [(k + 1) / grades for k in range(grades - 1)])
    grade = np.where(toxic, 1 + np.searchsorted(cuts, words, side="left"), 0)
    x = np.log1p(np.array([np.bincount(r["x"], minlength=len(chosen)) for r in found], float))
    model.weights, model.thresholds = fit_cumulative_link(x, grade, grades)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, severity, grade, toxic`` of every row.

    ``severity`` is the expected grade, ``grade`` the number of thresholds more
    likely passed than not, ``toxic`` whether the first one is.  A NULL or blank
    text has no features; repeated rows score alike.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most FEATURES weights

    def make():
        own = sent.value
        of = WordCache(own.hits)

        def work(ids, texts):
            above = [own.severity([h for w in (t or b"").split() if (h := of[w])]) for t in texts]
            return {"doc_id": ids, "severity": [float(a.sum()) for a in above],
                    "grade": [int((a >= 0.5).sum()) for a in above], "toxic": [bool(a[0] >= 0.5) for a in above]}
        return work

    return map_batches(docs, ["doc_id", "text"], "doc_id long, severity double, grade int, toxic boolean", make)


def keep_civil(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows whose text is toxic; all columns stay as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = sent.value
        of = WordCache(own.hits)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = part.column(part.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
                above = [own.severity([h for w in (t or b"").split() if (h := of[w])])[0] for t in texts]
                yield part.filter(pa.array([bool(a < 0.5) for a in above], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
