"""Whitening of embeddings along the leading principal components, found by spectrum slicing.

An entry c becomes the whole number floor(64 c) + 1,000,000. The fit list holds each distinct vector of
such numbers once; counts and sums over it are exact, and its covariance is summed up centred, a matrix
a task. Only matrices of the vectors' length squared come to the driver, never vectors.

By Sylvester's law of inertia an LDL^T factorisation of V - s I has as many positive pivots as V has
eigenvalues above s. Bisection by these counts isolates the k-th largest eigenvalue in an interval of its own;
Rayleigh quotient iteration from inside converges cubically to a pair; counts just below and just above what
it has found certify that it is the k-th, else the interval is cut further. Eigenvalues too near each
other to be told apart by counts form a cluster; their vectors are made orthogonal to those found before.

Defined results: rows whose vector is null or has a null or non-finite entry are left out; all others
come back, repeated rows and null ids each by itself; vectors of different length are fitted apart; components
without variance (to rounding) are left out, so a fit list of one vector, vectors of no entries and an empty
table give no rows; a sum of squares that does not fit a long gives a null deviation; entries beyond
2^40 are taken as 2^40; other columns are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
LARGEST = float(1 << 40)
BISECTIONS, ROUNDS = 200, 30
SEED = 12
ALPHA = (1 + math.sqrt(17)) / 8


def inertia(matrix: np.ndarray) -> int:
    """Positive pivots of an LDL^T factorisation with symmetric pivoting (pivots of one or two rows, Bunch and Parlett)."""
    a = matrix.copy()
    positive, tiny = 0, np.finfo(float).eps * max(float(np.abs(a).max(initial=0.0)), np.finfo(float).tiny)
    while len(a):
        n = len(a)
        size = np.abs(a)
        i = int(size.diagonal().argmax())
        off = size - np.diag(size.diagonal())
        p, q = divmod(int(off.argmax()), n)
        if size[i, i] >= ALPHA * off[p, q]:
            pivot = a[i, i]
            if abs(pivot) <= tiny:  # what is left is nothing to rounding: not above
                return positive
            positive += pivot > 0
            column = np.delete(a[:, i], i)
            rest = np.delete(np.delete(a, i, 0), i, 1)
            a = rest - np.outer(column, column / pivot)
        else:  # a block of two rows has one positive and one negative eigenvalue
            positive += 1
            pair = [p, q]
            columns = np.delete(a[:, pair], pair, 0)
            rest = np.delete(np.delete(a, pair, 0), pair, 1)
            a = rest - columns @ np.linalg.solve(a[np.ix_(pair, pair)], columns.T)
    return positive


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues lie above the shift."""
    return inertia(matrix - shift * np.eye(len(matrix)))


def rayleigh(matrix: np.ndarray, start: float, found: list[np.ndarray], rng: np.random.Generator) -> tuple[float, np.ndarray]:
    """An eigenpair near the start, apart from the vectors found, by Rayleigh quotient iteration."""
    norm = float(np.abs(matrix).sum(axis=1).max())
    basis = np.array(found).reshape(len(found), len(matrix))

    def apart(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - basis.T @ (basis @ x)
        return x / np.linalg.norm(x)

    def solved(shift: float, x: np.ndarray) -> np.ndarray:
        try:
            return np.linalg.solve(matrix - shift * np.eye(len(matrix)), x)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            return np.linalg.solve(matrix - (shift + 4 * np.finfo(float).eps * norm) * np.eye(len(matrix)), x)

    x, value, best = apart(rng.normal(size=len(matrix))), start, None
    for _ in range(2):  # towards the start before the quotient leads
        x = apart(solved(start, x))
    for _ in range(ROUNDS):
        value = float(x @ matrix @ x)
        rest = float(np.linalg.norm(matrix @ x - value * x))
        if best is not None and rest >= best[0]:
            break
        best = rest, value, x
        if rest <= np.finfo(float).eps * norm:
            break
        x = apart(solved(value, x))
    return best[1], best[2]


def leading(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues above rounding, falling, and their unit vectors in rows; each certified by counts."""
    n = len(matrix)
    norm = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    floor = 64 * max(n, 1) * np.finfo(float).eps * norm
    wanted = min(most, above(matrix, floor)) if norm > 0 else 0
    rng = np.random.default_rng(SEED)
    known: dict[float, int] = {norm * (1 + 1e-9): 0, floor: wanted if wanted < most else above(matrix, floor)}

    def count(shift: float) -> int:
        if shift not in known:
            known[shift] = above(matrix, shift)
        return known[shift]

    values, vectors = [], []
    width = 16 * n * np.finfo(float).eps * norm  # to which counts can be trusted
    for k in range(1, wanted + 1):
        high = min(s for s, c in known.items() if c < k)
        low = max(s for s, c in known.items() if c >= k)
        for _ in range(BISECTIONS):
            if high - low <= width:  # a cluster: its vectors are made orthogonal one by one
                value, vector = rayleigh(matrix, (low + high) / 2, vectors, rng)
                break
            if count(low) == k and count(high) == k - 1:
                value, vector = rayleigh(matrix, (low + high) / 2, vectors, rng)
                if low < value < high and count(value - width) >= k and count(value + width) < k:
                    break
            middle = (low + high) / 2
            if count(middle) >= k:
                low = middle
            else:
                high = middle
        values.append(value)
        vectors.append(vector)
    return np.array(values), np.array(vectors).reshape(len(vectors), n)


@dataclass
class Fit:
    """The fit list's counts, sums and components for vectors of one length."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    error: float = 0.0

    def __post_init__(self):
        self.base = np.array([s // self.n for s in self.sums], np.int64)  # the mean's whole part, and its rest
        self.rest = np.array([s % self.n for s in self.sums], np.float64) / self.n

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(np.float64) - self.rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values)[:, None]).T

    def deviations(self, x: np.ndarray) -> list[int | None]:
        own = np.array(self.sums, object)
        far = max((abs(int(v)) for v in (x.max(initial=0), x.min(initial=0))), default=0) * self.n + max(map(abs, self.sums), default=0)
        if far < 1 << 62:
            each = self.n * x - np.array(self.sums, np.int64)
            reach = int(np.abs(each).max(initial=0))
            if reach * reach * x.shape[1] < 1 << 63:
                return (each * each).sum(axis=1).tolist()
        exact = ((self.n * x.astype(object) - own) ** 2).sum(axis=1)
        return [v if v < 1 << 63 else None for v in exact]


def quantized(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id, x (whole numbers) of the rows that take part."""
    v = F.col("v")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(v, lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(-LARGEST)), F.lit(LARGEST))) + SHIFT)
    return (
        vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
        .filter(v.isNotNull() & finite).select("vec_id", whole.alias("x"))
    )


def by_length(batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places in the batch, matrix of their x) for each length of x in the batch."""
    column = batch.column("x")
    flat, bounds = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    bounds = bounds - bounds[0]
    lengths = np.diff(bounds)
    out = []
    for length in np.unique(lengths[lengths > 0]).tolist():
        at = np.flatnonzero(lengths == length)
        out.append((at, flat[bounds[at][:, None] + np.arange(length)]))
    return out


def _matrices(fit: DataFrame, moved) -> dict[int, np.ndarray]:
    """length -> sum of the outer products of `moved(length, x)`; a task gives one matrix, rows of matrices are summed in parallel."""

    def products(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in by_length(batch):
                y = moved(x.shape[1], x)
                if y is not None:
                    sums[x.shape[1]] = sums.get(x.shape[1], 0) + y.T @ y
        for length, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([length] * len(total), pa.int32()), pa.array(range(len(total)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))],
                names=["length", "i", "row"],
            )

    def added(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for length, i, row in zip(*(batch.column(c).to_pylist() for c in ("length", "i", "row"))):
                sums[length, i] = sums.get((length, i), 0) + np.array(row)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in sums], pa.int32()), pa.array([k[1] for k in sums], pa.int32()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
                names=["length", "i", "row"],
            )

    kind = "length int, i int, row array<double>"
    rows = fit.select("x").mapInArrow(products, kind).repartition("length", "i").mapInArrow(added, kind).collect()  # length^2 numbers
    out: dict[int, dict[int, list[float]]] = {}
    for r in rows:
        out.setdefault(r["length"], {})[r["i"]] = r["row"]
    return {length: np.array([by[i] for i in sorted(by)]) for length, by in out.items()}


def fitted(fit: DataFrame, components: int) -> dict[int, Fit]:
    """The fit of every length of vectors in the fit list (x, distinct)."""

    def sums(batches):
        counts: dict[int, int] = {}
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in by_length(batch):
                length = x.shape[1]
                counts[length] = counts.get(length, 0) + len(x)
                totals[length] = totals.get(length, 0) + x.sum(axis=0)
        rows = [(length, i, counts[length], int(s)) for length, total in totals.items() for i, s in enumerate(total)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.int64()))], names=["length", "i", "n", "total"]
        )

    summed = (
        fit.select("x").mapInArrow(sums, "length int, i int, n long, total long").groupBy("length", "i")
        .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()  # a row for each dimension
    )
    by: dict[int, dict[int, tuple[int, int]]] = {}
    for r in summed:
        by.setdefault(r["length"], {})[r["i"]] = r["n"], int(r["total"])
    none = np.zeros(0)
    fits = {length: Fit(d[0][0], [d[i][1] for i in range(length)], none, none, 0.0) for length, d in by.items()}
    for length, total in _matrices(fit, lambda length, x: fits[length].centred(x)).items():
        own = fits[length]
        covariance = (total + total.T) / (2 * own.n)
        own.values, own.vectors = leading(covariance, components)
        own.trace = float(np.trace(covariance))
    fits = {length: f for length, f in fits.items() if len(f.values)}
    # measured on the fit list itself
    for length, total in _matrices(fit, lambda length, x: fits[length].whitened(x) if length in fits else None).items():
        fits[length].error = float(np.abs(total / fits[length].n - np.eye(len(total))).max())
    return fits


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every row and component."""
    rows = written(quantized(vectors, key, vector), "whitening-rows")
    fits = fitted(written(rows.select("x").distinct(), "whitening-fit"), components)

    def projected(batches):
        for batch in batches:
            ids = batch.column("vec_id")
            for at, x in by_length(batch):
                own = fits.get(x.shape[1])
                if own is None:
                    continue
                k = len(own.values)
                explained = own.values / own.trace
                names = ids.take(pa.array(np.repeat(at, k)))
                deviations = pa.array(own.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k)))
                yield pa.RecordBatch.from_arrays(
                    [
                        names, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))), pa.array(np.full(k * len(at), own.n, np.int64)), deviations,
                        pa.array(own.whitened(x).reshape(-1)), pa.array(np.tile(explained, len(at))), pa.array(np.full(k * len(at), own.error)),
                    ],
                    names=[c.split()[0] for c in WHITENED.split(", ")],
                )

    return rows.mapInArrow(projected, WHITENED)
