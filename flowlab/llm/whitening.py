"""Whitening of embeddings by an incremental eigendecomposition.

A spectrum is kept as eigenvalues and eigenvectors, never as a covariance matrix. Each partition starts from nothing and
applies centred rank-one updates: V + v v' has the eigenvectors of a diagonal matrix plus a rank-one one, whose
eigenvalues are the roots of a secular equation; entries of v that are nearly zero, and all but one of nearly equal
eigenvalues, are deflated first. Rows of a block are turned into at most as many rows as there are dimensions (their
triangular factor has the same sum of squares), and each of those is an update. Spectra of partitions are merged in
a tree, a few at a time, by one update per eigenvector, and a Rayleigh-Ritz step over all rows refines the result to
full precision: the covariance in the found basis is summed over all rows and diagonalised.

Entries become integers, so counts, means and distances from the mean do not depend on the order of rows. Fitting
uses each distinct vector once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import stored
from flowlab.llm.vectors import common_length, integers, matrix

BLOCK = 4096  # rows whose triangular factor is applied at once
FAN_IN = 8  # spectra merged in one task
DEFLATE = 1e-14
BISECTIONS = 64
# Components below this share of the largest eigenvalue have no direction and are left out.
LEAST_SHARE = 1e-12


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + z z', d rising and distinct, no z zero, and the matrix of d[i] - root[j].

    Root j lies between d[j] and d[j + 1] (the last before d[-1] + |z|^2). It is measured from the nearer of the
    two, so differences to the entries of d keep their digits.
    """
    upper = np.append(d[1:], d[-1] + z @ z)
    gap = upper - d
    squares = (z * z)[:, None]

    def secular(shift: np.ndarray, at: np.ndarray) -> np.ndarray:
        return 1.0 + (squares / ((d[:, None] - shift) - at)).sum(axis=0)

    near = secular(d, gap / 2) >= 0
    near[-1] = True
    shift = np.where(near, d, upper)
    low, high = np.where(near, 0.0, -gap / 2), np.where(near, np.where(np.arange(len(d)) == len(d) - 1, gap, gap / 2), 0.0)
    for _ in range(BISECTIONS):
        middle = (low + high) / 2
        up = secular(shift, middle) < 0
        low, high = np.where(up, middle, low), np.where(up, high, middle)
    at = (low + high) / 2
    return shift + at, (d[:, None] - shift) - at


@dataclass
class Spectrum:
    """Eigenvalues, rising, and eigenvectors as columns of a symmetric matrix."""

    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Spectrum:
        return cls(np.zeros(size), np.eye(size))

    def add(self, row: np.ndarray) -> None:
        """Add the rank-one matrix ``row row'``."""
        z = self.vectors.T @ row
        d, q = self.values, self.vectors
        scale = max(d[-1], z @ z)
        if not z @ z > 0:
            return
        # Of nearly equal eigenvalues a rotation leaves all but the last without a part in z.
        equal = d[1:] - d[:-1] <= DEFLATE * scale
        for i in np.flatnonzero(equal):
            size = np.hypot(z[i], z[i + 1])
            if size > 0:
                c, s = z[i + 1] / size, z[i] / size
                q[:, [i, i + 1]] = np.stack([c * q[:, i] - s * q[:, i + 1], s * q[:, i] + c * q[:, i + 1]], axis=1)
                z[i], z[i + 1] = 0.0, size
        live = np.flatnonzero(z * z > (DEFLATE ** 2) * scale)
        if len(live):
            roots, apart = secular_roots(d[live], z[live])
            # z for which the roots are exact: eigenvectors from it are orthogonal whatever the roots' errors.
            between = d[live][:, None] - d[live][None, :]
            np.fill_diagonal(between, 1.0)
            exact = np.sqrt(np.abs(np.prod(apart / between, axis=1)))
            parts = np.copysign(exact, z[live])[:, None] / apart
            parts /= np.linalg.norm(parts, axis=0)
            q[:, live] = q[:, live] @ parts
            d[live] = roots
        order = np.argsort(d, kind="stable")
        self.values, self.vectors = d[order], np.ascontiguousarray(q[:, order])

    def add_rows(self, rows: np.ndarray) -> None:
        """Add ``rows' rows``; more rows than dimensions are first turned into their triangular factor."""
        if len(rows) > rows.shape[1]:
            rows = np.linalg.qr(rows, mode="r")
        for row in rows:
            self.add(row)

    def merge(self, other: Spectrum) -> None:
        """Add another spectrum, an update per eigenvector."""
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.add(np.sqrt(value) * vector)


@dataclass
class Whitening:
    """Components as rows, falling eigenvalues, and what the fit saw: rows n, sums per dimension, trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0  # largest entry of the whitened rows' covariance minus the identity, as measured

    @property
    def size(self) -> int:
        return len(self.sums)

    @property
    def basis(self) -> np.ndarray:
        """Columns that centred rows are multiplied by."""
        return (self.components / np.sqrt(self.values)[:, None]).T


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for start in range(0, len(batch), BLOCK):
            yield matrix(batch.column(0).slice(start, BLOCK), size)


def centred(x: np.ndarray, sums: np.ndarray, n: int) -> np.ndarray:
    return (x * float(n) - sums) / n


def fit(df: DataFrame, vector: str = "embedding", k: int = 4) -> Whitening:
    """Fit on the distinct integer vectors of a table.

    Null and empty vectors, those with a null or non-finite entry, and those of another length than the commonest (of
    equally common ones the longest) are left out; repeated rows count once; an empty table gives no component. Components whose eigenvalue is next to nothing are left out, so there may be fewer than ``k``. Column
    names do not matter; other columns are not read.
    """
    rows = df.select(integers(F.col(vector)).alias("_x"))
    size = common_length(rows)
    if not size:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0)
    distinct = stored(rows.filter(F.size("_x") == size).distinct(), "vectors")
    n, sums = _sums(distinct, size)
    basis = _merged_spectrum(distinct, n, sums)
    model = _rayleigh_ritz(distinct, n, sums, basis, k)
    if len(model.values):
        squares = _projected_squares(distinct, n, sums, model.basis)
        model.identity_error = float(np.abs(squares - np.eye(len(squares))).max())
    return model


def _sums(distinct: DataFrame, size: int) -> tuple[int, list[int]]:
    """Rows, and the exact sum of each dimension; halves of the longs are summed apart so that none overflows."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(size, np.int64), np.zeros(size, np.int64)
        for x in _blocks(batches, size):
            n += len(x)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(np.full(size, n)), pa.array(high), pa.array(low)],
                                         ["i", "n", "high", "low"])

    cells = distinct.mapInArrow(partial, "i bigint, n bigint, high bigint, low bigint").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).orderBy("i").collect()
    return cells[0].n, [(r.high << 32) + r.low for r in cells]


def _merged_spectrum(distinct: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Eigenvectors as columns, from one spectrum per partition merged in a tree."""
    size, mean = len(sums), np.array(sums, float)

    def packed(spectrum: Spectrum, at: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([spectrum.values], pa.list_(pa.float64())),
                                           pa.array([spectrum.vectors.ravel()], pa.list_(pa.float64()))],
                                          ["at", "values", "vectors"])

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        spectrum, any_row = Spectrum.empty(size), False
        for x in _blocks(batches, size):
            spectrum.add_rows(centred(x, mean, n))
            any_row = True
        if any_row:
            yield packed(spectrum, TaskContext.get().partitionId())

    def merged(group: pa.Table) -> pa.Table:
        out = Spectrum.empty(size)
        # In a fixed order, so that a repeated task gives the same.
        for row in sorted(group.to_pylist(), key=lambda r: r["at"]):
            out.merge(Spectrum(np.array(row["values"]), np.array(row["vectors"]).reshape(size, size)))
        return pa.Table.from_batches([packed(out, group.column("at")[0].as_py() // FAN_IN)])

    schema = "at bigint, values array<double>, vectors array<double>"
    spectra = stored(distinct.mapInArrow(of_partition, schema), "spectra")
    while spectra.count() > 1:
        spectra = stored(spectra.groupBy(F.floor(F.col("at") / FAN_IN)).applyInArrow(merged, schema), "spectra")
    vectors = np.array(spectra.first().vectors).reshape(size, size)
    return np.linalg.qr(vectors)[0]


def _projected_squares(distinct: DataFrame, n: int, sums: list[int], basis: np.ndarray) -> np.ndarray:
    """Covariance of the centred rows in a basis (columns), summed over all rows."""
    size, width, mean = len(sums), basis.shape[1], np.array(sums, float)
    shared = distinct.sparkSession.sparkContext.broadcast(basis)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for x in _blocks(batches, size):
            y = centred(x, mean, n) @ shared.value
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], ["i", "v"])

    cells = distinct.mapInArrow(partial, "i bigint, v double").groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()
    return np.array([r.v for r in cells]).reshape(width, width) / n


def _rayleigh_ritz(distinct: DataFrame, n: int, sums: list[int], basis: np.ndarray, k: int) -> Whitening:
    values, turn = np.linalg.eigh(_projected_squares(distinct, n, sums, basis))
    trace = float(values.sum())
    order = np.argsort(-values, kind="stable")[:k]
    order = order[values[order] > LEAST_SHARE * max(values.max(), 0.0)]
    components = (basis @ turn[:, order]).T
    if len(components):  # the largest entry of each is positive
        components *= np.sign(components[np.arange(len(components)), np.abs(components).argmax(axis=1)])[:, None]
    return Whitening(n, sums, components, values[order], trace)


def whitened(spark, model: Whitening, x: Column) -> Column:
    """Array of the whitened components of an integer vector of the model's length."""
    shared = spark.sparkContext.broadcast((model.basis, np.array(model.sums, float), model.n, model.size))

    @F.arrow_udf("array<double>")
    def project(rows: pa.Array) -> pa.Array:
        to, sums, n, size = shared.value
        out = centred(matrix(rows, size), sums, n) @ to
        return pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1) * to.shape[1], pa.int32()), pa.array(out.ravel()))

    return project(x)


def deviation(model: Whitening, x: Column) -> Column:
    """Exact sum over dimensions of (n * entry - sum)^2; null where it does not fit a long."""
    sums = F.array(*[F.lit(s if -(1 << 63) <= s < 1 << 63 else None).cast("bigint") for s in model.sums])
    off = F.zip_with(x, sums, lambda v, s: F.try_subtract(F.try_multiply(v, F.lit(model.n).cast("bigint")), s))
    return F.aggregate(off, F.lit(0).cast("bigint"), lambda total, d: F.try_add(total, F.try_multiply(d, d)))


def transform(df: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key, whitened (array, a value per component) and deviation of each row that the fit could use; null keys and
    repeated rows are rows like others. A model without components gives no row."""
    rows = df.select(F.col(key).alias("_key"), integers(F.col(vector)).alias("_x"))
    rows = rows.filter(F.size("_x") == model.size if len(model.values) else F.lit(False))
    whole = whitened(df.sparkSession, model, F.col("_x")) if len(model.values) else F.array().cast("array<double>")
    return rows.select(F.col("_key").alias(key), whole.alias("whitened"), deviation(model, F.col("_x")).alias("deviation"))
