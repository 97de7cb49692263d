"""Embedding whitening by shifted CholeskyQR.

Entries are turned into integers, and the fit list holds each distinct vector once.
Its centred rows X are orthogonalised without ever being moved or written again:

1. One pass sums the rows exactly.
2. Each further pass reads the rows, centres them, solves with the triangular factors
   found so far, and adds up the Gram matrix of what comes out. Its Cholesky factor is
   the next R. The first Gram matrix is shifted, so that rounding cannot make it
   indefinite; ``PASSES`` passes make the rows orthonormal to double precision.
3. R = R_k ... R_1 has the singular values and right singular vectors of X. Its SVD
   gives the components and variances at the precision of X, where a covariance
   matrix would have squared the condition number.

So that dimensions without variance need no second path, X stands on ``dim`` ridge rows
(a multiple of the identity, held beside the data). They leave the right singular
vectors as they are and add a known constant to each squared singular value, which is
taken off again.

What a task holds is a batch and one ``dim`` x ``dim`` matrix. The matrices are added up by
row in Spark; the driver sees one of them per pass.

Defined results: vectors that are null or hold null or non-finite entries are left out;
rows with a null id stay. Vectors of different lengths lie in different spaces: each
length has its own fit list, components and numbers. An empty vector has no components
and gives no rows in the query. A component without variance (all of them, where only one
distinct vector exists) has whitened null and explained 0, and explained is null where no
component has any. A deviation beyond 64 bits is null. Entries beyond 64-bit integers
take the nearest one. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import fresh, with_result
from tessera.session import materialize

STEP = 256.0            # entries are floor(STEP * entry)
COMPONENTS = 4
PASSES = 3
RIDGE = 1e-18           # squared length of a ridge row, as a share of X's
NO_VARIANCE = 1e-15     # of the largest variance: less counts as none
UNIT = 2.0 ** -53


def _size(x: np.ndarray) -> float:
    """The largest absolute value."""
    return float(np.abs(x.astype(float)).max(initial=0))


@dataclass(frozen=True)
class Whitening:
    """What was fitted on the vectors of one length."""

    dim: int
    n: int
    sums: list[int]                  # per dimension, exact
    components: np.ndarray           # one unit vector a row
    variances: list[float]
    explained: list[float | None]
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n; the whole part is taken off exactly, as integers, where 64 bits hold the difference."""
        whole = np.array([s // self.n for s in self.sums])
        rest = np.array([s % self.n for s in self.sums], float) / self.n
        if max(_size(x), _size(whole)) >= 2.0 ** 62:
            return (x.astype(float) - whole) - rest
        return (x - whole) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """NaN in components without variance."""
        scale = np.array([1 / np.sqrt(v) if v > 0 else np.nan for v in self.variances])
        return self.centred(x) @ self.components.T * scale

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * x - sum)^2, by integers."""
        mean = [s // self.n for s in self.sums]
        most = self.n * (_size(x) + _size(np.array(mean)) + 1)
        if most ** 2 * self.dim < 2.0 ** 62:
            return ((self.n * x - np.array(self.sums)) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * a - s) ** 2 for a, s in zip(row, self.sums)) for row in x.tolist()]
        return [d if d < 2 ** 63 else None for d in exact]


def integers(df: DataFrame, vector: str, x: str) -> DataFrame:
    """The rows with a usable vector, and its integers as column ``x``."""
    v = F.col(vector)
    whole = F.forall(v, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return df.where(v.isNotNull() & whole).withColumn(
        x, F.transform(v, lambda c: F.floor(F.lit(STEP) * c.cast("double"))))


def _matrix(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _sums(rows: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Count and exact sums; halves of 32 bits cannot overflow inside a batch."""

    def run(batches):
        n, high, low = 0, [0] * dim, [0] * dim
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            n += len(x)
            high = [a + b for a, b in zip(high, (x >> 32).sum(axis=0).tolist())]
            low = [a + b for a, b in zip(low, (x & 0xFFFFFFFF).sum(axis=0).tolist())]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dim), pa.int32()), pa.array([n] * dim), pa.array(high), pa.array(low)],
                names=["i", "n", "high", "low"])

    parts = rows.mapInArrow(run, "i int, n long, high long, low long")
    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    found = {r.i: r for r in parts.groupBy("i").agg(whole("n"), whole("high"), whole("low")).collect()}
    return int(found[0].n), [(int(found[i].high) << 32) + int(found[i].low) for i in range(dim)]


def _gram(rows: DataFrame, dim: int, width: int, made: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of the products of ``made`` (rows x ``width``)."""

    def multiply(batches):
        total, seen = np.zeros((width, width)), False
        for batch in batches:
            y = made(_matrix(batch.column(0), dim))
            total += y.T @ y
            seen = True
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(width), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))],
                names=["i", "row"])

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column("i").to_pylist(), _matrix(batch.column("row"), width)):
                totals[i] = totals[i] + row if i in totals else row
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()),
             pa.array([t.tolist() for t in totals.values()], pa.list_(pa.float64()))], names=["i", "row"])

    schema = "i int, row array<double>"
    found = rows.mapInArrow(multiply, schema).repartition("i").mapInArrow(add, schema).collect()
    gram = np.zeros((width, width))
    for r in found:
        gram[r.i] = r.row
    return (gram + gram.T) / 2


def solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``rows`` times the inverse of each triangular factor in turn."""
    for r in factors:
        rows = np.linalg.solve(r.T, rows.T).T
    return rows


def triangular_factors(gram: Callable[[list[np.ndarray]], np.ndarray], n: int, dim: int) -> tuple[list, float]:
    """The R factors of X on its ridge, and the ridge; ``gram(factors)`` is the Gram matrix of X after them."""
    first = gram([])
    ridge = RIDGE * float(np.trace(first))
    factors: list[np.ndarray] = []
    for k in range(PASSES):
        below = solved(np.sqrt(ridge) * np.eye(dim), factors)
        whole = (first if k == 0 else gram(factors)) + below.T @ below
        if k == 0:
            whole += 11 * (n * dim + dim * (dim + 1)) * UNIT * np.linalg.eigvalsh(whole)[-1] * np.eye(dim)
        factors.append(np.linalg.cholesky(whole).T)
    return factors, ridge


def _fit_length(rows: DataFrame, dim: int, components: int) -> Whitening:
    kept = min(components, dim)
    n, sums = _sums(rows, dim)
    plain = Whitening(dim, n, sums, np.eye(dim)[:kept], [0.0] * kept, [None] * kept)
    if n < 2:       # two distinct vectors have some variance
        return plain
    factors, ridge = triangular_factors(
        lambda found: _gram(rows, dim, dim, lambda x: solved(plain.centred(x), found)), n, dim)
    composed = np.eye(dim)
    for r in factors:
        composed = r @ composed
    _, singular, right = np.linalg.svd(composed)
    variances = (singular ** 2 - ridge) / n
    variances = np.where(variances > NO_VARIANCE * variances[0], variances, 0.0)
    right = right[:kept]
    # Either sign is right; the largest entry of a component is made positive.
    right = right * np.sign(right[np.arange(kept), np.abs(right).argmax(axis=1)])[:, None]
    made = Whitening(dim, n, sums, right, variances[:kept].tolist(), (variances[:kept] / variances.sum()).tolist())

    # The covariance that whitened rows have, measured over the fit list.
    live = [i for i, v in enumerate(made.variances) if v > 0]
    moments = _gram(rows, dim, len(live) + 1, lambda x: np.hstack([made.whitened(x)[:, live], np.ones((len(x), 1))]))
    mean = moments[-1, :-1] / n
    away = moments[:-1, :-1] / n - np.outer(mean, mean) - np.eye(len(live))
    return Whitening(**{**made.__dict__, "identity_error": float(np.abs(away).max())})


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> list[Whitening]:
    """One ``Whitening`` per length of vector that occurs, but for empty ones."""
    distinct = materialize(integers(df.select(F.col(vector).alias("v")), "v", "x").select("x").distinct(), "fit-list")
    lengths = sorted(r.dim for r in distinct.select(F.size("x").alias("dim")).distinct().collect())
    return [_fit_length(distinct.where(F.size("x") == dim), dim, components) for dim in lengths if dim]


SCHEMA = "n long, deviation long, whitened array<double>, explained array<double>, identity_error double"


def whiten(df: DataFrame, models: list[Whitening], name: str, vector: str = "embedding") -> DataFrame:
    """The rows with a usable vector of a fitted length, and struct ``name``: count, deviation, whitened entries."""
    x = fresh(df, "x")
    by_length = {m.dim: m for m in models}

    def start():
        def step(vectors):
            out = [None] * len(vectors)
            for dim, model in by_length.items():
                mine = [i for i, v in enumerate(vectors) if len(v) == dim]
                if not mine:
                    continue
                rows = np.array([vectors[i] for i in mine], np.int64)
                white = [[None if np.isnan(w) else w for w in row] for row in model.whitened(rows).tolist()]
                for i, d, w in zip(mine, model.deviations(rows), white):
                    out[i] = (model.n, d, w, model.explained, model.identity_error)
            return [list(c) for c in zip(*out)] or [[]] * 5
        return step

    rows = integers(df, vector, x).where(F.size(x).isin(list(by_length)))
    return with_result(rows, [x], SCHEMA, start, name).drop(x)
