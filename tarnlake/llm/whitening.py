"""Whitening of embeddings along their leading principal components, found by spectrum slicing.

The covariance is a sum over the rows, made on Spark; what is left is a matrix with a row
for each dimension, whatever the number of vectors.  Its leading eigenpairs come one by
one: an LDL^T factorisation of the shifted matrix tells by its inertia how many
eigenvalues lie above the shift, so bisection finds an interval that holds exactly the
k-th; Rayleigh quotient iteration from there converges cubically, and two more counts
around its result certify the number k.  Eigenvalues closer than rounding can tell
apart share an interval and get an orthonormal basis of their space.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tarnlake.session import stage

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
# Scaled entries beyond this are held at it, which keeps them whole numbers.
LARGEST = 1 << 61
# Eigenvalues up to this share of the matrix's norm are zero: dividing by them would scale rounding errors up.
ZERO = 1e-11
EPSILON = float(np.finfo(np.float64).eps)


# eigenpairs

def inertia(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix lie above ``shift``.

    By Sylvester's law it is the number of positive eigenvalues of D in an LDL^T
    factorisation of ``matrix - shift``, with pivots of one or two rows (Bunch-Kaufman).
    """
    a = matrix - shift * np.eye(len(matrix))
    tiny = EPSILON * max(float(np.abs(a).max(initial=0.0)), np.finfo(np.float64).tiny)
    bound = (1 + 17 ** 0.5) / 8
    above, k, n = 0, 0, len(a)
    while k < n:
        width = 1
        column = np.abs(a[k + 1:, k])
        most = column.max(initial=0.0)
        if abs(a[k, k]) < bound * most:
            r = k + 1 + int(column.argmax())
            row = np.abs(a[r, k:])
            row[r - k] = 0
            largest = row.max()
            if abs(a[k, k]) * largest >= bound * most ** 2:
                pass
            elif abs(a[r, r]) >= bound * largest:
                a[[k, r]] = a[[r, k]]
                a[:, [k, r]] = a[:, [r, k]]
            else:
                width = 2
                a[[k + 1, r]] = a[[r, k + 1]]
                a[:, [k + 1, r]] = a[:, [r, k + 1]]
        pivot, rest = a[k:k + width, k:k + width], a[k + width:, k:k + width]
        if width == 1:
            d = pivot[0, 0] if abs(pivot[0, 0]) > tiny else -tiny  # a zero eigenvalue is not above the shift
            above += d > 0
            a[k + 1:, k + 1:] -= np.outer(rest[:, 0], rest[:, 0]) / d
        else:
            above += 1  # such a pivot has a negative determinant: one eigenvalue on either side
            a[k + 2:, k + 2:] -= rest @ np.linalg.solve(pivot, rest.T)
        k += width
    return above


def _solve(matrix: np.ndarray, shift: float, vectors: np.ndarray, norm: float) -> np.ndarray:
    """Solution with the shifted matrix; a shift that is an eigenvalue is moved by a rounding error."""
    for step in (0.0, EPSILON * norm, 64 * EPSILON * norm):
        try:
            found = np.linalg.solve(matrix - (shift + step) * np.eye(len(matrix)), vectors)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(found).all():
            return found
    return vectors


def _orthonormal(vectors: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span ``vectors``, orthogonal to the columns of ``others``."""
    for _ in range(2):
        vectors = np.linalg.qr(vectors - others @ (others.T @ vectors))[0]
    return vectors


class Slicer:
    """Leading eigenpairs of a symmetric, positive semidefinite matrix, largest first."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.norm = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
        # Below this, counts depend on rounding.
        self.width = 8 * len(matrix) * EPSILON * self.norm
        self.counts: dict[float, int] = {}

    def above(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = inertia(self.matrix, shift)
        return self.counts[shift]

    def interval(self, k: int) -> tuple[float, float]:
        """``low, high`` around the k-th eigenvalue alone, or around all that cannot be told from it."""
        high = min([s for s, n in self.counts.items() if n < k], default=self.norm * (1 + 1e-9) + self.width)
        low = max([s for s, n in self.counts.items() if n >= k], default=-self.width)
        while high - low > self.width and not self.above(low) - self.above(high) == 1:
            middle = (low + high) / 2
            low, high = (middle, high) if self.above(middle) >= k else (low, middle)
        return low, high

    def rayleigh(self, low: float, high: float, others: np.ndarray) -> tuple[float, np.ndarray] | None:
        """The eigenpair of an interval that holds one; None if the iteration leaves the interval."""
        start = np.random.default_rng(len(others.T)).standard_normal((len(self.matrix), 1))
        # Two steps of inverse iteration lead into the region of cubic convergence.
        v, value = start, (low + high) / 2
        for step in range(12):
            v = _solve(self.matrix, value, v, self.norm)
            v = v - others @ (others.T @ v)
            v /= np.linalg.norm(v)
            if step:
                value = float((v.T @ self.matrix @ v)[0, 0])
                if not low <= value <= high:
                    return None
                if np.linalg.norm(self.matrix @ v - value * v) <= 4 * EPSILON * self.norm:
                    break
        return value, v

    def certified(self, k: int, value: float) -> bool:
        """Whether counts on either side of ``value`` say that it is the k-th eigenvalue."""
        return self.above(value - self.width) >= k > self.above(value + self.width)

    def leading(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Eigenvalues and, as columns, eigenvectors of the ``count`` largest that are not zero."""
        size = len(self.matrix)
        values, vectors = [], np.zeros((size, 0))
        while len(values) < min(count, size):
            k = len(values) + 1
            low, high = self.interval(k)
            if high <= max(2 * self.width, ZERO * self.norm):
                break
            many = self.above(low) - self.above(high)
            found = None
            while many == 1 and found is None and high - low > self.width:
                found = self.rayleigh(low, high, vectors)
                if found is None or not self.certified(k, found[0]):
                    found, middle = None, (low + high) / 2
                    low, high = (middle, high) if self.above(middle) >= k else (low, middle)
            if found is not None:
                if found[0] <= ZERO * self.norm:
                    break
                values.append(found[0])
                vectors = np.hstack([vectors, found[1]])
                continue
            # Eigenvalues that rounding cannot tell apart: a basis of their space, as many as the counts say.
            space = np.random.default_rng(k).standard_normal((size, many))
            for _ in range(4):
                space = _orthonormal(_solve(self.matrix, (low + high) / 2, space, self.norm), vectors)
            vectors = np.hstack([vectors, space])
            values += [float(v @ self.matrix @ v) for v in space.T]
        return np.array(values[:count]), vectors[:, :count]


# statistics

def scaled(embeddings: DataFrame) -> DataFrame:
    """``vec_id, x`` of usable rows, x the floor of each entry times 64, plus a million.

    Rows whose vector is NULL, empty, or holds a NULL or an entry that is not finite are
    left out, and so are rows of another length than most (of equally many: the longer).
    """
    entry = F.col("embedding").cast("array<double>")
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = embeddings.select("vec_id", entry.alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0) & ~bad)
    bound = F.lit(float(LARGEST))
    whole = F.transform("v", lambda c: (
        F.floor(F.greatest(-bound, F.least(bound, c * F.lit(float(SCALE))))) + F.lit(OFFSET)).cast("long"))
    rows = stage(rows.select("vec_id", whole.alias("x")), "whiten-rows")
    sizes = rows.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    return rows if most is None else rows.where(F.size("x") == most["size"])


def _folded(rows: DataFrame, ddl: str, start, add, done) -> DataFrame:
    """Rows ``done(state)`` of each task, ``state = add(state, matrix)`` over its vectors, a batch at a time."""
    schema = StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = start
        for batch in batches:
            if batch.num_rows:
                state = add(state, _matrix(batch.column(batch.num_columns - 1)))
        if state is not start:
            out = done(state)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, arrow)], schema=arrow)

    return rows.select("x").mapInArrow(run, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _product_sums(rows: DataFrame, centred) -> dict[tuple[int, int], float]:
    """Sums over ``rows`` of the products of entries i <= j of ``centred(x)``."""
    def add(state, x):
        y = centred(x)
        return y.T @ y if state is None else state + y.T @ y

    def done(state):
        i, j = np.triu_indices(len(state))
        return i, j, state[i, j]

    parts = _folded(rows, "i int, j int, value double", None, add, done)
    # One row for each pair of dimensions, whatever the number of vectors.
    return {(r["i"], r["j"]): r["value"] for r in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()}


def _symmetric(sums: dict[tuple[int, int], float], size: int) -> np.ndarray:
    out = np.zeros((size, size))
    for (i, j), value in sums.items():
        out[i, j] = out[j, i] = value
    return out


@dataclass
class Whitening:
    """``n`` distinct vectors of sums ``totals``; eigenvalues, eigenvectors as columns, and the trace."""

    n: int
    totals: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centre(self):
        """A function that takes the exact mean off rows of whole numbers, before any product."""
        n = max(1, self.n)
        whole = np.array([t // n for t in self.totals], np.int64)
        part = np.array([t % n / n for t in self.totals])
        return lambda x: (x - whole).astype(np.float64) - part

    def whitened(self):
        centre, factor = self.centre(), self.vectors / np.sqrt(self.values)
        return lambda x: centre(x) @ factor


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Mean, covariance and leading components of stored, distinct vectors ``x``."""
    def add(state, x):
        own = [len(x), *(int(v) for v in x.astype(object).sum(axis=0))] if np.abs(x).max() > 1 << 40 else [
            len(x), *x.sum(axis=0).tolist()]
        return own if state is None else [a + b for a, b in zip(state, own)]

    def done(state):
        return range(len(state)), [str(v) for v in state]

    parts = _folded(distinct, "at int, value string", None, add, done)
    sums = parts.groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).orderBy("at").collect()
    n, *totals = [int(r["value"]) for r in sums] or [0]
    out = Whitening(n, totals, np.zeros(0), np.zeros((len(totals), 0)), 0.0)
    if n:
        covariance = _symmetric(_product_sums(distinct, out.centre()), len(totals)) / n
        out.values, out.vectors = Slicer(covariance).leading(components)
        out.trace = float(np.trace(covariance))
    return out


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity."""
    size = len(model.values)
    whiten = model.whitened()
    ones = lambda x: np.hstack([np.ones((len(x), 1)), whiten(x)])  # noqa: E731  the sums come with the products
    both = _symmetric(_product_sums(distinct, ones), size + 1) / model.n
    mean = both[0, 1:]
    return float(np.abs(both[1:, 1:] - np.outer(mean, mean) - np.eye(size)).max(initial=0.0))


def deviations(x: np.ndarray, n: int, totals: list[int]) -> list[int | None]:
    """Exact sums of ``(n * x - total)^2``; None where a long cannot hold it."""
    # In longs where no step can exceed them, else in Python's integers.
    span = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n + max(abs(t) for t in totals)
    if span < 1 << 62:
        d = x * n - np.array(totals, np.int64)
        most = int(np.abs(d).max(initial=0))
        if most * most * len(totals) < 1 << 63:
            return (d * d).sum(axis=1).tolist()
    exact = [sum((n * int(v) - t) ** 2 for v, t in zip(row, totals)) for row in x]
    return [e if e < 1 << 63 else None for e in exact]


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row per usable vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Components are numbered from 1 by falling eigenvalue of the covariance of the distinct
    vectors ``x`` of ``scaled``, at most ``components``; those of eigenvalue zero (``ZERO``),
    which cannot be whitened, have no rows.  ``deviation`` is the exact sum over dimensions of
    ``(n * x - total)^2``, NULL where a long cannot hold it; ``explained`` the eigenvalue's
    share of the trace.  Repeated rows get equal results, a NULL vec_id stays NULL.  No
    usable rows, or only equal ones: no rows.
    """
    rows = scaled(embeddings)
    # Exactly: equal arrays are one group, reduced in each task first.
    distinct = stage(rows.groupBy("x").agg(F.count("*").alias("copies")).select("x"), "whiten-distinct")
    model = fit(distinct, components)
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    schema = StructType.fromDDL(f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    if not len(model.values):
        return embeddings.sparkSession.createDataFrame([], schema)
    error, shares = identity_error(distinct, model), model.values / model.trace
    arrow, size = to_arrow_schema(schema), len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = model.whitened()
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            out = [
                batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), size))), np.tile(np.arange(1, size + 1), len(x)),
                np.full(len(x) * size, model.n), np.repeat(np.array(deviations(x, model.n, model.totals), object), size),
                apply(x).reshape(-1), np.tile(shares, len(x)), np.full(len(x) * size, error)]
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(out, arrow)], schema=arrow)

    return rows.select("vec_id", "x").mapInArrow(run, schema)
