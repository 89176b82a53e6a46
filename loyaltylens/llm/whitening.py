"""Whitening of embeddings by principal components, found by contour integration of the covariance's resolvent.

Rows are Spark's: exact integer sums, the centred covariance, the projections and the check of the result are passes
over the table.  What is left is a matrix of dimensions x dimensions, whose leading eigenpairs are found interval by
interval, one task each: FEAST iterations in an interval between two shifts, whose inertia says how many there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyaltylens.llm.common import keep

SCALE, OFFSET = 64, 1_000_000  # an entry c becomes floor(64 c) + 1,000,000
NODES = 8  # quadrature nodes on the upper half of a contour
PER_INTERVAL = 6  # eigenvalues of an interval at most, if they can be told apart
EPS = np.finfo(float).eps


# -- inertia and contour integration ------------------------------------------------------------------


def eigenvalues_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix exceed ``shift``: the positive part of the inertia of matrix - shift.

    Symmetric elimination with pivots of one or two rows, the largest that is left, which keeps it stable although
    the shifted matrix is indefinite.
    """
    a = matrix - shift * np.eye(len(matrix))
    positive = 0
    bound = (1 + 17**0.5) / 8
    while len(a):
        diagonal = np.abs(np.diag(a))
        r = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        p, q = divmod(int(off.argmax()), len(a))
        if max(diagonal[r], off[p, q]) == 0:
            return positive
        rows = [r] if diagonal[r] >= bound * off[p, q] else [p, q]
        rest = np.setdiff1d(np.arange(len(a)), rows)
        pivot, below = a[np.ix_(rows, rows)], a[np.ix_(rest, rows)]
        if len(rows) == 1:
            positive += pivot[0, 0] > 0
        else:
            positive += 1  # such a pair of rows always has one eigenvalue of each sign
        a = a[np.ix_(rest, rest)] - below @ np.linalg.solve(pivot, below.T)
        a = (a + a.T) / 2
    return int(positive)


@dataclass(frozen=True)
class Interval:
    low: float
    high: float
    count: int  # eigenvalues in (low, high]


def intervals(matrix: np.ndarray, wanted: int) -> list[Interval]:
    """Disjoint intervals, from the top, that hold the ``wanted`` largest positive eigenvalues and few others.

    Halved until an interval has few eigenvalues or is so narrow that they are one value at this precision.
    """
    scale = float(np.abs(matrix).sum(axis=1).max()) if matrix.size else 0.0
    if scale == 0:
        return []
    floor, top = scale * EPS * len(matrix) * 4, scale * (1 + 1e-9)
    below = {floor: eigenvalues_above(matrix, floor), top: 0}
    found: list[Interval] = []
    open_ones = [(floor, top)]
    have = 0
    while open_ones and have < wanted:
        low, high = open_ones.pop()
        count = below[low] - below[high]
        if not count:
            continue
        if count <= PER_INTERVAL or high - low <= scale * EPS * 64:
            found.append(Interval(low, high, count))
            have += count
            continue
        # Between two values far apart in size the geometric middle is nearer to the next one.
        middle = (low * high) ** 0.5 if high > 1e3 * low else (low + high) / 2
        if not low < middle < high:
            found.append(Interval(low, high, count))
            have += count
            continue
        below[middle] = eigenvalues_above(matrix, middle)
        open_ones += [(low, middle), (middle, high)]
    return [Interval(float(p.low), float(p.high), p.count) for p in found]


def contour_eigenpairs(matrix: np.ndarray, inside: Interval, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in an interval, falling, and their vectors as columns.

    The integral of the resolvent along a circle around the interval projects onto the wanted vectors; Gauss-Legendre
    nodes on the upper half stand for it, as the matrix is real.  A block of random vectors is projected and
    diagonalised in its span until the residuals are at rounding level.  As many pairs as the inertia counted have to
    come out, or the search starts anew with a wider block.
    """
    size = len(matrix)
    centre, radius = (inside.low + inside.high) / 2, max((inside.high - inside.low) / 2, abs(inside.high) * 1e-12)
    points, weights = np.polynomial.legendre.leggauss(NODES)
    turn = np.pi / 2 * (1 - points)  # angles from 0 to pi
    arms = radius * np.exp(1j * turn)
    scale = float(np.abs(matrix).sum(axis=1).max())
    identity = np.eye(size)
    solvers = [np.linalg.inv((centre + arm) * identity - matrix) for arm in arms] if size <= 512 else None
    width = min(size, 2 * inside.count + 4)
    while True:
        block = np.linalg.qr(np.random.default_rng(width).standard_normal((size, width)))[0]
        best = None
        for _ in range(rounds):
            projected = np.zeros_like(block)
            for k, (arm, weight) in enumerate(zip(arms, weights)):
                solved = solvers[k] @ block if solvers else np.linalg.solve((centre + arm) * identity - matrix, block)
                projected += weight / 2 * np.real(arm * solved)
            basis = np.linalg.qr(projected)[0]
            small = basis.T @ matrix @ basis
            values, turned = np.linalg.eigh((small + small.T) / 2)
            block = basis @ turned
            slack = scale * EPS * size
            own = np.flatnonzero((values > inside.low - slack) & (values <= inside.high + slack))
            if len(own) > inside.count:  # neighbours at the very ends: keep those that are deepest inside
                depth = np.minimum(values[own] - inside.low, inside.high - values[own])
                own = np.sort(own[np.argsort(-depth, kind="stable")[: inside.count]])
            residual = np.linalg.norm(matrix @ block[:, own] - block[:, own] * values[own], axis=0).max(initial=0.0)
            if len(own) == inside.count and (best is None or residual < best[0] / 2):
                best = (residual, values[own], block[:, own])
            elif best is not None:
                break  # no better than before: at rounding level
        if best is not None and best[0] <= scale * 1e-9:
            return best[1][::-1], best[2][:, ::-1]
        if width == size:
            raise ArithmeticError(f"{inside} could not be resolved")
        width = min(size, 2 * width)


def leading_components(spark, matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest positive eigenvalues, ``wanted`` of them or as many as there are, and unit vectors as columns.

    Every interval is worked on by a task of its own, which gets the matrix and returns its pairs.  A Rayleigh-Ritz step over all
    of them makes the vectors of neighbouring intervals orthogonal; the inertia below the last one says that none is
    missing.
    """
    parts = intervals(matrix, wanted)
    if not parts:
        return np.zeros(0), np.zeros((len(matrix), 0))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                values, vectors = contour_eigenpairs(matrix, Interval(row.low, row.high, row.count))
                yield pd.DataFrame({"value": values, "vector": list(vectors.T)})

    rows = spark.createDataFrame([(p.low, p.high, p.count) for p in parts], "low double, high double, count bigint")
    found = rows.repartition(len(parts), "high").mapInPandas(run, "value double, vector array<double>").collect()
    basis = np.linalg.qr(np.array([r["vector"] for r in sorted(found, key=lambda r: -r["value"])]).T)[0]
    values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
    if len(values) < min(wanted, sum(p.count for p in parts)) or sum(p.count for p in parts) != len(found):
        raise ArithmeticError("components are missing")
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], basis @ turned[:, order]


# -- passes over the table -----------------------------------------------------------------------------


def whole_vectors(rows: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector counts, with the whole numbers ``llm_x`` in place of it.

    Vectors with missing or non-finite entries are dropped, and those that are missing or empty.
    """
    entries = F.transform(vector, lambda c: c.cast("double"))
    limit = float((1 << 62) // SCALE)  # beyond it, the whole number would not fit 64 bits; infinite ones as well
    fits = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(limit)))
    x: Column = F.transform(entries, lambda c: F.floor(c * SCALE) + F.lit(OFFSET))
    good = rows.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & fits)
    return good.withColumn("llm_x", x)


def as_matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column, all of the same length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def column_sums(vectors: DataFrame, dimensions: int) -> list[int]:
    """Exact sums of every dimension of ``x``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [0] * dimensions
        for batch in batches:
            x = as_matrix(batch.column(0))
            if len(x):
                # Halves of 32 bits, so that no sum of a batch can pass 64 bits.
                high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
                sums = [s + (int(h) << 32) + int(b) for s, h, b in zip(sums, high, low)]
        yield pa.RecordBatch.from_arrays([pa.array(range(dimensions), pa.int32()), pa.array([str(s) for s in sums])], ["i", "s"])

    parts = vectors.mapInArrow(run, "i int, s string")
    rows = parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()
    return [int(r["s"]) for r in rows]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - sums, exact: as 64-bit numbers where they fit, else as whole numbers of any size."""
    largest = max(max(map(abs, sums), default=0), n * int(np.abs(x).max(initial=0)))
    if largest < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def covariance(rows: DataFrame, size: int, vectors_of: Callable[[pa.RecordBatch], np.ndarray], n: int) -> np.ndarray:
    """Mean of the outer products of ``vectors_of`` each batch: one matrix per task, added up per entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                own = vectors_of(batch)
                total += own.T @ own
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"])

    parts = rows.mapInArrow(run, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v"))
    found = np.zeros((size, size))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        found[r["i"], r["j"]] = r["v"]
    return (found + found.T) / (2 * n)


def exact_deviation(y: np.ndarray) -> pa.Array:
    """Sum of squares of every row; missing where it does not fit 64 bits."""
    if y.dtype != object and (not y.size or int(np.abs(y).max()) ** 2 * y.shape[1] < 1 << 63):
        return pa.array((y * y).sum(axis=1), pa.int64())
    sums = [int(s) for s in (y.astype(object) ** 2).sum(axis=1)]
    return pa.array([s if s < 1 << 63 else None for s in sums], pa.int64())


def whiten(
    rows: DataFrame, components: int = 16, id_col: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Every vector on the leading principal components, scaled to unit variance.

    One row per remaining row and component: vec_id, component (1 has the largest variance), n, deviation, whitened,
    explained, identity_error.  Entries are taken as whole numbers floor(64 c) + 1,000,000; mean and covariance are those of the
    distinct vectors, so copies weigh nothing: they are added up per task first, and no group of them stays together.

    Dropped are vectors that are missing, empty, or have a missing or non-finite entry, and those whose
    length is not the most common one (of equally common ones, the longest).  Repeated rows come back each; a missing id stays
    missing.  Components without variance cannot be scaled and are left out, so a table of equal vectors, or an empty one,
    gives no rows.  Equal eigenvalues share their space in any orthogonal way, the same for all rows.  ``deviation`` is
    missing where it does not fit 64 bits.  The driver sees the sums and the covariance, whose size is that of the
    dimensions squared, never vectors.
    """
    spark = rows.sparkSession
    named = rows.select(rows[id_col].alias("vec_id"), rows[vector].alias("llm_v"))
    good = keep(whole_vectors(named, "llm_v").select("vec_id", "llm_x"))
    lengths = good.groupBy(F.size("llm_x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    schema = (
        f"vec_id {dict(named.dtypes)['vec_id']}, component int, n bigint, deviation bigint, whitened double, "
        "explained double, identity_error double"
    )
    if lengths is None:
        return spark.createDataFrame([], schema)
    size = lengths["d"]
    good = good.filter(F.size("llm_x") == size)
    fit = keep(good.select("llm_x").distinct())
    n = fit.count()
    sums = column_sums(fit, size)

    def centred_rows(batch: pa.RecordBatch) -> np.ndarray:
        return centred(as_matrix(batch.column("llm_x")), n, sums).astype(float) / n

    matrix = covariance(fit, size, centred_rows, n)
    values, vectors = leading_components(spark, matrix, min(components, size))
    count = len(values)
    if not count:
        return spark.createDataFrame([], schema)
    scaled = vectors / np.sqrt(values)
    unit = covariance(fit, count, lambda batch: centred_rows(batch) @ scaled, n)
    error = float(np.abs(unit - np.eye(count)).max())
    explained = values / np.trace(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        for batch in batches:
            if not batch.num_rows:
                continue
            y = centred(as_matrix(batch.column("llm_x")), n, sums)
            many = batch.num_rows * count
            each = pa.array(np.repeat(np.arange(batch.num_rows), count))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(each),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), batch.num_rows)),
                    pa.array(np.full(many, n)),
                    exact_deviation(y).take(each),
                    pa.array((y.astype(float) / n @ scaled).ravel()),
                    pa.array(np.tile(explained, batch.num_rows)),
                    pa.array(np.full(many, error)),
                ],
                names,
            )

    return good.mapInArrow(run, schema)
