"""Whitening of embeddings by shifted CholeskyQR.

Entries are put on an integer grid, so counts, sums and deviations are exact at any size. The centred
rows Y (n x d) are orthogonalised in passes over the data: a pass applies the triangular factors found
so far to each block of rows by substitution, sums the Gram matrix of the result, and its Cholesky
factor is the next one. The first Gram matrix is shifted, which keeps it positive definite however badly
conditioned Y is; the passes after it repair what the shift and rounding cost. When the Gram matrix is
that of orthonormal columns, Y = Q R with R the product of all factors, and the singular values and
right vectors of the small matrix R give the eigenvalues and components of the covariance without ever
squaring Y's condition.

Only n, d sums, d x d Gram matrices and k x k covariances come to the driver: their size depends on the
dimension alone. Y and Q are never stored; every pass computes them from the vectors.

Defined results:

- Left out: vectors that are null or empty, hold a null, NaN or infinite entry, an entry beyond
  ``LARGEST`` in size, or whose length is not the most frequent one (the larger among equals).
- Repeated rows and null vec_ids are rows as others. Other columns than vec_id and embedding are not
  read.
- Components whose eigenvalue is beyond reach of double precision beside the first (``RANK``) are not
  returned: constant dimensions and tables of fewer rows than dimensions have fewer components, and a
  table whose vectors are all equal, or an empty one, gives no rows.
- ``deviation`` is null where the exact value does not fit a long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the grid: x = floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
#: Entries beyond it do not fit the grid in a long.
LARGEST = 2.0**52
COMPONENTS = 8
#: Rows orthogonalised at once in a task.
BLOCK_ROWS = 4096
#: A Gram matrix G is that of orthonormal (or vanished) columns when G @ G differs from G by less.
SETTLED = 1e-10
#: Safety bound: three passes are enough up to a condition of about 1e15.
MOST_PASSES = 8
#: Eigenvalues below this share of the first, per dimension, are rounding errors.
RANK = np.finfo(float).eps

WHITENED = (
    "vec_id BIGINT, component INT, n BIGINT, deviation BIGINT, whitened DOUBLE, explained DOUBLE, "
    "identity_error DOUBLE"
)


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles, no nulls) of the vectors that take part, all of one length."""
    vectors = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LARGEST))
    # The check of a null vector is null: such rows go as well.
    valid = vectors.where(finite & (F.size("embedding") > 0))
    lengths = valid.groupBy(F.size("embedding").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.agg(F.max(F.struct("n", "length")).getField("length").alias("length")).first().length
    return valid.where(F.size("embedding") == usual if usual else F.lit(False))


def grid(column: pa.Array) -> np.ndarray:
    """Integers x of a block of vectors, [row, dimension]."""
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return np.floor(values * SCALE).astype(np.int64) + OFFSET


def substitute(factor: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Q with Q @ factor = rows for an upper triangular factor; both sides transposed, [column, row]."""
    solved = np.empty_like(rows)
    for j in range(len(factor)):
        solved[j] = (rows[j] - factor[:j, j] @ solved[:j]) / factor[j, j]
    return solved


@dataclass(frozen=True)
class Centre:
    """Number of rows and exact sums per dimension."""

    n: int
    sums: tuple[int, ...]

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """n*x - S: exact where it fits a long, else the nearest double."""
        if abs(x).max(initial=0) * float(self.n) < 2.0**62 and max(map(abs, self.sums)) < 2**62:
            return self.n * x - np.array(self.sums, np.int64)
        return float(self.n) * x - np.array(self.sums, float)

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Centred rows, transposed: [dimension, row]."""
        return np.ascontiguousarray(self.numerators(x).T.astype(float)) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of squares per row; large ones in Python's integers."""
        top = self.numerators(x)
        safe = (top.dtype == np.int64) & ((top.astype(float) ** 2).sum(axis=1) < 2.0**62)
        found = (np.where(safe[:, None], top, 0).astype(np.int64) ** 2).sum(axis=1).tolist()
        for i in np.flatnonzero(~safe):
            exact = sum((self.n * int(v) - s) ** 2 for v, s in zip(x[i], self.sums))
            found[i] = exact if exact < 2**63 else None
        return found


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(start, BLOCK_ROWS)
            yield part.column(0), grid(part.column(1))


def _summed(vectors: DataFrame, entries: Callable[[np.ndarray], np.ndarray], kind: str) -> dict[int, object]:
    """Sum over all blocks of an array computed from each: one partial array per task, then added per
    entry. ``kind`` is the SQL type of an entry; index -> sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _blocks(batches):
            part = entries(x)
            total = part if total is None else total + part
        if total is not None:
            values = pa.array(total.ravel())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(values), dtype=np.int32)), values], names=["entry", "value"]
            )

    parts = vectors.mapInArrow(run, f"entry INT, value {kind}")
    exact = "decimal(38,0)" if kind == "BIGINT" else kind
    sums = parts.groupBy("entry").agg(F.sum(F.col("value").cast(exact)).alias("value"))
    return {r.entry: r.value for r in sums.collect()}


def centre(vectors: DataFrame) -> Centre | None:
    """n and the sums S over all vectors; None without vectors."""
    found = _summed(
        vectors, lambda x: np.concatenate([x.sum(axis=0), [len(x)]]).astype(np.int64), "BIGINT"
    )
    if not found:
        return None
    values = [int(found[i]) for i in range(len(found))]
    return Centre(values[-1], tuple(values[:-1]))


def gram(vectors: DataFrame, middle: Centre, factors: list[np.ndarray]) -> np.ndarray:
    """Gram matrix of the centred rows after substitution through all factors: one pass."""

    def product(x: np.ndarray) -> np.ndarray:
        rows = middle.rows(x)
        for factor in factors:
            rows = substitute(factor, rows)
        return rows @ rows.T

    found = _summed(vectors, product, "DOUBLE")
    size = len(middle.sums)
    return np.array([found[i] for i in range(size * size)]).reshape(size, size)


def cholesky(matrix: np.ndarray, shift: float) -> np.ndarray:
    """Upper triangular R with R'R = matrix + shift, the shift raised until there is one."""
    while True:
        try:
            return np.linalg.cholesky(matrix + shift * np.eye(len(matrix))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, np.finfo(float).eps * np.trace(matrix))


@dataclass(frozen=True)
class Whitening:
    """Components (columns of ``vectors``, unit length) by falling eigenvalue of the covariance."""

    middle: Centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    passes: int

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """[row, component]"""
        return self.middle.rows(x).T @ (self.vectors / np.sqrt(self.values))


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Components from all vectors; None where nothing varies."""
    middle = centre(vectors)
    if middle is None:
        return None
    size = len(middle.sums)
    first = found = gram(vectors, middle, [])
    if not np.trace(first):
        return None
    # The shift of the method's error analysis, per block of rows that is summed at once.
    shift = 11 * size * (BLOCK_ROWS + size + 1) * np.finfo(float).eps * np.trace(first)
    factors, whole = [], np.eye(size)
    for _ in range(MOST_PASSES):
        factors.append(cholesky(found, 0.0 if factors else shift))
        whole = factors[-1] @ whole
        found = gram(vectors, middle, factors)
        if np.abs(found @ found - found).max() < SETTLED:
            break
    else:
        raise RuntimeError(f"rows are not orthogonal after {MOST_PASSES} passes")
    if np.abs(found - np.eye(size)).max() < SETTLED:
        whole = cholesky(found, 0.0) @ whole
    else:  # columns that vanish, which a shift alone would have kept: the Gram matrix has a root still
        shares, axes = np.linalg.eigh(found)
        whole = np.sqrt(np.where(shares > SETTLED, shares, 0))[:, None] * axes.T @ whole
    _, sigma, turned = np.linalg.svd(whole)
    values = sigma**2 / middle.n
    count = min(components, int((values > size * RANK * values[0]).sum()))
    return Whitening(
        middle, values[:count], turned[:count].T, float(np.trace(first)) / middle.n, len(factors) + 1
    )


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, measured over all rows."""
    count = len(model.values)

    def sums(x: np.ndarray) -> np.ndarray:
        white = model.whitened(x)
        return np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])

    found = _summed(vectors, sums, "DOUBLE")
    values = np.array([found[i] for i in range(len(found))]) / model.middle.n
    # Rows are centred on exact sums: what is left of the mean is rounding.
    covariance = values[count:].reshape(count, count) - np.outer(values[:count], values[:count])
    return float(np.abs(covariance - np.eye(count)).max())


def transform(vectors: DataFrame, model: Whitening, error: float) -> DataFrame:
    """One row per vector and component."""
    count, explained = len(model.values), model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _blocks(batches):
            rows = len(x)
            each = np.repeat(np.arange(rows), count)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * count, model.middle.n)),
                    pa.array(model.middle.deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * count, error)),
                ],
                names=[f.split()[0] for f in WHITENED.split(", ")],
            )

    return vectors.mapInArrow(run, WHITENED)


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error."""
    vectors = usable(embeddings)
    model = fit(vectors, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], WHITENED)
    return transform(vectors, model, identity_error(vectors, model))
