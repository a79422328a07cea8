"""Embedding whitening with exact covariances by polarisation.

1. A vector's entries c become integers x = floor(scale * c). The fit list is every distinct x vector once: n vectors with
   the sums S of each dimension.
2. With y = n * x - S (integers, centred), the squares of every y_i and of every sum y_i + y_j are added up exactly, task by
   task, then over tasks as wide decimals. Polarisation recovers each covariance from these variances:
   cov(i, j) = (var(i + j) - var(i) - var(j)) / 2. Each entry is rounded once, from exact integers.
3. The driver assembles the D x D matrix and takes its eigenvectors (``eigh``); its size depends on the dimensions only.
4. Every row is projected: ((x - S / n) . component) / sqrt(eigenvalue).

Rows are left out if the vector is null or empty, holds null or non-finite entries or an entry whose x is no 64-bit integer,
or has another length than most of the remaining rows (on a tie, the shorter length). Repeated rows and rows with a null id
are projected like others. Components are numbered by falling eigenvalue; of equal eigenvalues any basis is one. A component's
entry of largest absolute value (the first of equals) is positive. Dimensions without variance give no component: eigenvalues
up to 1e-12 of the largest count as zero, so a fit list of one vector gives no rows, like an empty table. A deviation of more than 38 digits is null. Other columns than
``vec_id`` and ``embedding`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import Staging
from .common import slices

SCALE = 256
LOW = 31                # bits of the lower part of a number that is squared
NO_VARIANCE = 1e-12
_ROWS = 512             # rows squared at a time


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, x array<long>) of the usable rows of ``vec_id`` and ``embedding``."""
    entry = lambda c: F.floor(c.cast("double") * scale)
    # Comparisons with null or NaN aren't true; 2 ** 63 is the first number that doesn't fit.
    good = lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double") * scale) < float(1 << 63)), F.lit(False))
    usable = F.coalesce((F.size("embedding") > 0) & F.forall("embedding", good), F.lit(False))
    rows = vectors.select("vec_id", "embedding").where(usable)
    return rows.select("vec_id", F.transform("embedding", lambda c: entry(c).cast("long")).alias("x"))


def _squares(numbers: np.ndarray) -> list[np.ndarray]:
    """Exact sums over rows of squared 64-bit integers below 2 ** 62, as six sums of parts that each fit."""
    high, low = numbers >> LOW, numbers & ((1 << LOW) - 1)
    parts = []
    for product in (low * low, low * high, high * high):
        parts += [(product >> 32).sum(axis=0), (product & 0xFFFFFFFF).sum(axis=0)]
    return parts


_WEIGHTS = [1 << 32, 1, 1 << (LOW + 1 + 32), 1 << (LOW + 1), 1 << (2 * LOW + 32), 1 << (2 * LOW)]


def square_sums(x: np.ndarray, count: int, sums: np.ndarray) -> list[list[int]]:
    """For each i: the sums over rows of (y_i + y_j) ** 2 for j > i, after that of y_i ** 2; y = count * x - sums."""
    bound = 2 * (count * int(np.abs(x).max(initial=0)) + max((abs(int(s)) for s in sums), default=0))
    found = []
    if bound < 1 << 62:
        y = count * x - sums.astype(np.int64)
        for i in range(y.shape[1]):
            added = y[:, i:] + y[:, i:i + 1]
            added[:, 0] = y[:, i]
            parts = _squares(added)
            found.append([sum(weight * int(part[k]) for weight, part in zip(_WEIGHTS, parts)) for k in range(added.shape[1])])
    else:
        y = count * x.astype(object) - sums
        for i in range(y.shape[1]):
            found.append([int((y[:, i] ** 2).sum()), *(int(((y[:, i] + y[:, j]) ** 2).sum()) for j in range(i + 1, y.shape[1]))])
    return found


def _matrix(lists: pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    return lists.flatten().to_numpy().reshape(len(lists), -1)


def exact_square_sums(fit: DataFrame, count: int, sums: np.ndarray) -> dict[tuple[int, int], int]:
    """{(i, j): sum of squares}; (i, i) is the dimension itself, (i, j) the sum of two. One number per pair reaches the driver."""
    sent = fit.sparkSession.sparkContext.broadcast((count, sums))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = sent.value
        added: list[list[int]] | None = None
        for batch in slices(batches, _ROWS):
            some = square_sums(_matrix(batch.column(0)), n, total)
            added = some if added is None else [[a + b for a, b in zip(one, other)] for one, other in zip(added, some)]
        # One row per pair and task. Whole numbers of any length are cut into pieces of 60 bits.
        for i, values in enumerate(added or []):
            pieces = [[(value >> (60 * at)) & ((1 << 60) - 1) for value in values] for at in range(4)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * len(values), pa.int32()), pa.array(range(i, i + len(values)), pa.int32()), *(pa.array(p, pa.int64()) for p in pieces)],
                names=["i", "j", "p0", "p1", "p2", "p3"])

    tasks = fit.select("x").mapInArrow(run, "i int, j int, p0 long, p1 long, p2 long, p3 long")
    total = [F.sum(F.col(f"p{at}").cast("decimal(20,0)")).alias(f"p{at}") for at in range(4)]
    return {(row["i"], row["j"]): sum(int(row[f"p{at}"]) << (60 * at) for at in range(4)) for row in tasks.groupBy("i", "j").agg(*total).collect()}


def covariance(squares: dict[tuple[int, int], int], count: int, dims: int) -> np.ndarray:
    """The covariance matrix (divisor ``count``) of x from the square sums of y = count * x - S."""
    matrix = np.zeros((dims, dims))
    for (i, j), total in squares.items():
        # Whole numbers are divided with one rounding.
        value = total / count ** 3 if i == j else (total - squares[i, i] - squares[j, j]) / (2 * count ** 3)
        matrix[i, j] = matrix[j, i] = value
    return matrix


@dataclass
class Whitening:
    """Components are rows, in falling order of their eigenvalues."""

    count: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace

    def project(self, x: np.ndarray, most: int | None = None) -> np.ndarray:
        centred = x - (self.sums / self.count).astype(np.float64)
        return centred @ self.components[:most].T / np.sqrt(self.eigenvalues[:most])

    def deviations(self, x: np.ndarray) -> list[int]:
        """The exact sum over dimensions of (count * x - S) ** 2 of each row."""
        y = self.count * x.astype(object) - self.sums
        return (y * y).sum(axis=1).tolist()

    def stored_deviations(self, x: np.ndarray) -> pa.Array:
        """The deviations as decimals; null beyond 38 digits."""
        return pa.array([value if value < 10 ** 38 else None for value in self.deviations(x)], pa.decimal128(38, 0))


def fit_whitening(x: DataFrame, staging: Staging) -> tuple[Whitening | None, DataFrame]:
    """The whitening of (vec_id, x) rows of one length, and the stored fit list. None where nothing has variance."""
    fit = staging.write(x.select("x").distinct(), "fit-list")
    sums = fit.select(F.posexplode("x").alias("dim", "value")).groupBy("dim").agg(
        F.sum(F.col("value").cast("decimal(20,0)")).alias("total"), F.count("*").alias("n")).orderBy("dim").collect()  # a row per dimension
    if not sums:
        return None, fit
    count, totals = sums[0]["n"], np.array([int(row["total"]) for row in sums], dtype=object)
    matrix = covariance(exact_square_sums(fit, count, totals), count, len(totals))
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > NO_VARIANCE * max(values.max(), 0)]
    if not len(order):
        return None, fit
    components = vectors[:, order].T
    largest = np.abs(components).argmax(axis=1)
    components = components * np.sign(components[np.arange(len(components)), largest])[:, None]
    return Whitening(count, totals, components, values[order], float(np.trace(matrix))), fit


def projected(x: DataFrame, model: Whitening, most: int | None = None) -> DataFrame:
    """The rows with ``whitened array<double>``."""
    sent = x.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            values = sent.value.project(_matrix(batch.column("x")), most)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "whitened"])

    return x.mapInArrow(run, f"{', '.join(f'{name} {kind}' for name, kind in x.dtypes)}, whitened array<double>")


def identity_error(fit: DataFrame, model: Whitening, most: int | None = None) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity, measured over the whole list."""
    whitened = projected(fit, model, most)
    width = len(model.components[:most])
    # Spark's covariance centres before it multiplies, and merges the tasks' centred sums.
    pairs = [(a, b) for a in range(width) for b in range(a, width)]
    measured = whitened.agg(*(F.covar_pop(F.col("whitened")[a], F.col("whitened")[b]).alias(f"c{at}") for at, (a, b) in enumerate(pairs))).first()
    return max(abs(value - (a == b)) for (a, b), value in zip(pairs, measured))


def whiten(vectors: DataFrame, staging: Staging, components: int = 4, scale: int = SCALE) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: one row per usable vector and component."""
    x = staging.write(integer_vectors(vectors, scale), "integers")
    lengths = x.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").first()
    x = x.where(F.size("x") == (lengths["size"] if lengths else 0))
    model, fit = fit_whitening(x, staging)
    id_type = x.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None:
        return x.sparkSession.createDataFrame([], schema)
    error = identity_error(fit, model, components)
    sent = x.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for batch in slices(batches, 4096):
            matrix = _matrix(batch.column(1))
            values = held.project(matrix, components)
            rows, width = values.shape
            owner = pa.array(np.repeat(np.arange(rows), width))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(owner), pa.array(np.tile(np.arange(1, width + 1), rows), pa.int32()), pa.array(np.full(rows * width, held.count)),
                 held.stored_deviations(matrix).take(owner), pa.array(values.ravel()),
                 pa.array(np.tile(held.explained[:width], rows)), pa.array(np.full(rows * width, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.select("vec_id", "x").mapInArrow(run, schema)
