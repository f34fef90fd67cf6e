"""Embedding whitening: pivoted Cholesky of the centred scatter, one-sided Jacobi on its factor.

Components are made steps of 1/1024, so that sums over all rows are whole
numbers and exact whatever the order of adding. Only sums reach the driver:
as many rows of numbers as the vectors have components.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vigil.llm.common import package_on_workers, written

STEPS = 1024
SHIFT = 100_000
#: More steps than this, a component of 2**30, do not fit into exact sums of long; such components count as this many.
MOST = 2**40
#: Partial sums one task adds up.
FAN = 64


@dataclass(frozen=True)
class Whitening:
    """Sums of the fit list and the components (columns) of its covariance, largest eigenvalue first."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float
    #: mean of the centred rows as computed: rounding only
    rest: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace if self.trace > 0 else np.zeros(len(self.eigenvalues))


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(factor, order) with matrix[order][:, order] = factor factor^T, the largest diagonal first.

    The factor has a column for each pivot above rounding of the largest one.
    """
    left = matrix.astype(np.float64).copy()
    width = len(left)
    order = np.arange(width)
    factor = np.zeros((width, width))
    least = np.finfo(float).eps * width * max(left.diagonal().max(initial=0.0), 0.0)
    for k in range(width):
        p = k + int(np.argmax(left.diagonal()[k:]))
        if not left[p, p] > least:
            return factor[:, :k], order
        for rows in (left, factor):
            rows[[k, p]] = rows[[p, k]]
        left[:, [k, p]] = left[:, [p, k]]
        order[[k, p]] = order[[p, k]]
        factor[k, k] = math.sqrt(left[k, k])
        factor[k + 1 :, k] = left[k + 1 :, k] / factor[k, k]
        left[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor's columns rotated until each is orthogonal to all others.

    A sweep goes through all pairs of columns in rounds of disjoint pairs, as in
    a round-robin tournament; the pairs of a round are rotated at once. Sweeps
    end when no pair's cosine is above rounding.
    """
    columns = factor.T.copy()  # a row per column
    n = len(columns)
    if n < 2:
        return columns.T
    players = list(range(n)) + ([-1] if n % 2 else [])
    rounds = []
    for _ in range(len(players) - 1):
        pairs = [(a, b) for a, b in zip(players[: len(players) // 2], reversed(players)) if a >= 0 and b >= 0]
        rounds.append(np.array(pairs).T)
        players = [players[0], players[-1], *players[1:-1]]
    enough = np.finfo(float).eps * len(factor)
    for _ in range(sweeps):
        rotated = False
        for a, b in rounds:
            x, y = columns[a], columns[b]
            xx, yy, xy = (x * x).sum(1), (y * y).sum(1), (x * y).sum(1)
            turn = np.abs(xy) > enough * np.sqrt(xx * yy)
            if not turn.any():
                continue
            rotated = True
            a, b, x, y, xx, yy, xy = a[turn], b[turn], x[turn], y[turn], xx[turn], yy[turn], xy[turn]
            zeta = (yy - xx) / (2 * xy)
            tangent = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cosine = 1 / np.hypot(1.0, tangent)
            sine = (cosine * tangent)[:, None]
            cosine = cosine[:, None]
            columns[a], columns[b] = cosine * x - sine * y, sine * x + cosine * y
        if not rotated:
            break
    return columns.T


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns of a positive semidefinite matrix, up to its rank.

    With matrix = L L^T and the columns of L rotated to be orthogonal, their
    squared norms are the eigenvalues and their directions the eigenvectors.
    The largest entry of each vector is positive.
    """
    factor, order = pivoted_cholesky(matrix)
    rotated = np.empty_like(factor)
    rotated[order] = one_sided_jacobi(factor)
    norms = np.sqrt((rotated * rotated).sum(0))
    largest = np.argsort(-norms, kind="stable")
    norms, vectors = norms[largest], (rotated / norms)[:, largest]
    if vectors.size:
        vectors = vectors * np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])])
    return norms * norms, vectors


def _steps(batch: pa.RecordBatch, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows that remain, their steps): of a batch with a column `vector`; short vectors are filled up with zeros."""
    lists = batch.column("vector")
    n = len(lists)
    lengths = np.array(lists.value_lengths().fill_null(0), np.int64)
    flat = lists.flatten()
    present = np.array(flat.is_valid()) if flat.null_count else np.ones(len(flat), bool)
    values = np.array(flat.fill_null(0.0) if flat.null_count else flat, np.float64)
    good = present & np.isfinite(values)
    whose = np.repeat(np.arange(n), lengths)
    keep = np.array(lists.is_valid()) & (np.bincount(whose[~good], minlength=n) == 0)
    columns = width if width is not None else int(lengths[keep].max(initial=0))
    x = np.full((n, columns), SHIFT, np.int64)
    place = np.arange(len(whose)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    inside = keep[whose]
    scaled = np.clip(np.floor(STEPS * values[inside]), -MOST, MOST)
    x[whose[inside], place[inside]] = scaled.astype(np.int64) + SHIFT
    return np.flatnonzero(keep), x[keep]


def _centre(n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """S/n as whole steps and the rest, whose quotient by n is below one."""
    whole = [s // n for s in sums]
    return np.array(whole, np.int64), np.array([s - n * w for s, w in zip(sums, whole)], np.int64)


def _summed(rows: DataFrame) -> dict[int, np.ndarray]:
    """(part, axis, numbers) rows summed by axis in rounds of FAN parts, each in the order of the parts."""
    rows = written(rows, "partial-sums")
    n_parts = rows.agg(F.max("part")).first()[0]
    schema = "part long, axis int, numbers array<double>"

    def add(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        total = np.sum(np.stack(group["numbers"].to_list()), axis=0)
        return pd.DataFrame({"part": group["part"].iloc[:1] // FAN, "axis": group["axis"].iloc[:1], "numbers": [total]})

    while True:
        rows = rows.groupBy(F.floor(F.col("part") / FAN).alias("group"), "axis").applyInPandas(add, schema)
        n_parts = (n_parts or 0) // FAN
        if n_parts == 0:
            break
    return {r["axis"]: np.array(r["numbers"]) for r in rows.collect()}


def _partials(rows: DataFrame, width: int, matrix_of: Callable[[np.ndarray], np.ndarray], product: Callable) -> dict[int, np.ndarray]:
    """Sums over all rows of product(matrix_of(steps)): one matrix per partition, added up as a tree."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        part = 0
        for batch in batches:
            if len(batch):
                part = batch.column("part")[0].as_py()
                made = product(matrix_of(_steps(batch, width)[1]))
                total = made if total is None else total + made
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(total), pa.int64()),
                    pa.array(range(len(total)), pa.int32()),
                    pa.array(list(total), pa.list_(pa.float64())),
                ],
                names=["part", "axis", "numbers"],
            )

    parts = rows.withColumn("part", F.spark_partition_id().cast("long"))
    return _summed(parts.mapInArrow(partial, "part long, axis int, numbers array<double>"))


def _vectors(rows: DataFrame, vector_col: str) -> DataFrame:
    return rows.select(F.col(vector_col).cast("array<double>").alias("vector"))


def fit_whitening(rows: DataFrame, *, vector_col: str = "embedding") -> Whitening:
    """The components of all vectors that are not null and hold only finite numbers.

    Two scans: exact sums, then the scatter of the centred rows. A partition
    sends one row per component, and partial sums are added as a tree.
    The covariance (divisor n) is decomposed on the driver, by
    `pivoted_cholesky` and `one_sided_jacobi`. Vectors may differ in length: a
    short one is filled up with zeros. Without vectors, n is 0.
    """
    package_on_workers(rows.sparkSession)
    vectors = _vectors(rows, vector_col)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(0, np.int64), 0
        for batch in batches:
            keep, x = _steps(batch)
            n += len(keep)
            own = x.sum(axis=0)
            # a component that earlier or these vectors lack is SHIFT in each of them
            if len(own) > len(total):
                total = np.append(total, np.full(len(own) - len(total), SHIFT * (n - len(keep))))
            total[: len(own)] += own
            total[len(own) :] += SHIFT * len(keep)
        if n:
            axes = [*range(-1, len(total))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(axes, pa.int32()), pa.array([n, *total.tolist()], pa.int64()), pa.array([n] * len(axes), pa.int64())],
                names=["axis", "total", "n"],
            )

    summed = (
        vectors.mapInArrow(add_up, "axis int, total long, n long")
        .groupBy("axis")
        .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
        .collect()
    )
    totals = {r["axis"]: (int(r["total"]), r["n"]) for r in summed}
    n = totals.pop(-1, (0, 0))[0]
    width = max(totals, default=-1) + 1
    if n == 0:
        return Whitening(0, (), np.zeros(0), np.zeros((0, 0)), 0.0, np.zeros(0))
    sums = tuple(totals[i][0] + SHIFT * (n - totals[i][1]) for i in range(width))
    whole, rest = _centre(n, sums)

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - whole) - rest / n

    def product(c: np.ndarray) -> np.ndarray:
        return np.vstack([c.T @ c, c.sum(axis=0)]) if width else np.zeros((0, 0))

    matrix = _partials(vectors, width, centred, product) if width else {}
    scatter = np.array([matrix[i] for i in range(width)]).reshape(width, width)
    covariance = (scatter + scatter.T) / (2 * n)
    values, components = eigen(covariance) if width else (np.zeros(0), np.zeros((0, 0)))
    mean = matrix[width] / n if width else np.zeros(0)
    return Whitening(n, sums, values, components, float(np.trace(covariance)), mean)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Per row the sum over components of (n*x - S)^2, exact; null where that is no long."""
    whole, rest = _centre(n, sums)
    apart = x - whole  # n*x - S = n*apart - rest
    largest = n * (int(np.abs(apart).max(initial=0)) + 1)
    if x.shape[1] * largest * largest < 2**63:
        t = n * apart - rest
        return (t * t).sum(axis=1).tolist()
    exact = []
    for row, near in zip(apart.tolist(), (((apart - rest / n) ** 2).sum(axis=1) * float(n) ** 2).tolist()):
        value = sum((n * v - r) ** 2 for v, r in zip(row, rest.tolist())) if near < 2.0**64 else 2**63
        exact.append(value if value < 2**63 else None)
    return exact


def whiten(
    rows: DataFrame, model: Whitening, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8
) -> DataFrame:
    """Per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or hold nulls or numbers that are not finite are left
    out, as in the fit. whitened is the centred vector on the component over the
    root of its eigenvalue; identity_error is the largest difference between the
    covariance of whitened over the rows given and the identity, the same in
    every row. A component without variance (fewer different vectors than
    components) has null whitened and explained 0 and is no part of that error.
    deviation is null where it does not fit a long. Repeated rows and ids and
    null ids stay as they are; vectors of fewer than `components` entries have
    as many components as entries; other columns are not read.
    """
    spark = rows.sparkSession
    package_on_workers(spark)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    shown = min(components, len(model.sums))
    if not shown or not model.n:
        return spark.createDataFrame([], schema)
    full = min(shown, len(model.eigenvalues))
    whole, rest = _centre(model.n, model.sums)
    axes = model.components[:, :full] / np.sqrt(model.eigenvalues[:full])
    shift = model.rest @ axes
    n, sums, width = model.n, model.sums, len(model.sums)

    def projected(x: np.ndarray) -> np.ndarray:
        return ((x - whole) - rest / n) @ axes

    def moments(w: np.ndarray) -> np.ndarray:
        w = w - shift
        return np.vstack([w.T @ w, np.full(full, float(len(w)))])

    error = 0.0
    if full:
        sums_of = _partials(_vectors(rows, vector_col), width, projected, moments)
        if sums_of:
            covariance = np.array([sums_of[i] for i in range(full)]) / sums_of[full][0]
            error = float(np.abs(covariance - np.eye(full)).max())
    explained = np.zeros(shown)
    explained[:full] = model.explained[:full]

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, x = _steps(batch, width)
            m = len(keep)
            values = np.zeros((m, shown))
            values[:, :full] = projected(x)
            missing = np.zeros((m, shown), bool)
            missing[:, full:] = True
            times = np.repeat(np.arange(m), shown)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(keep[times])),
                    pa.array(np.tile(np.arange(1, shown + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * shown, n, np.int64)),
                    pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(times)),
                    pa.array(values.ravel(), mask=missing.ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * shown, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    chosen = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return chosen.mapInArrow(out, schema)
