"""Whitening of embeddings by the leading eigenvectors of their covariance.

Sums and the centred covariance are added up by the tasks, a row of the matrix
at a time. The matrix, of the embedding's dimensions whatever the number of
rows, is reduced to tridiagonal form by Householder reflections; Sturm counts
bisect its leading eigenvalues, inverse iteration finds their vectors, and
vectors of close eigenvalues are made orthogonal to each other. The components
then go to the tasks, which project every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ship import ship
from tidemark.scale import materialise

_SCALE, _SHIFT = 1024, 100_000
# Beyond this size a scaled entry is no exact integer any more.
_MOST = float(1 << 52)
_HALF = 26
_LONG = 1 << 63
# Eigenvalues this close, as a share of the matrix's norm, are treated as a cluster.
_CLUSTER = 1e-3
_EPS = np.finfo(float).eps


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, second diagonal, Q) of a symmetric matrix, which is Q T Q'."""
    a, n = matrix.astype(float).copy(), len(matrix)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x)
        if size == 0 or not np.any(x[1:]):
            continue
        v = x.copy()
        v[0] += np.copysign(size, x[0])
        v /= np.linalg.norm(v)
        block = a[k + 1 :, k + 1 :]
        p = block @ v
        p -= (v @ p) * v
        block -= 2 * (np.outer(v, p) + np.outer(p, v))
        a[k + 1 :, k] = a[k, k + 1 :] = 0
        a[k + 1, k] = a[k, k + 1] = -np.copysign(size, x[0])
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def below(diagonal: np.ndarray, second: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each of ``at``: the sign changes of the Sturm sequence."""
    least = _EPS * max(np.abs(diagonal).max(), np.abs(second).max(initial=0), np.finfo(float).tiny)
    q = diagonal[0] - at
    count = (q < 0).astype(int)
    for d, b in zip(diagonal[1:], second, strict=True):
        q = np.where(np.abs(q) < least, -least, q)
        q = d - at - b * b / q
        count += q < 0
    return count


def leading(diagonal: np.ndarray, second: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection."""
    n = len(diagonal)
    around = np.abs(np.append(second, 0)) + np.abs(np.append(0, second))
    low = np.full(k, (diagonal - around).min() - 1e-300)
    high = np.full(k, (diagonal + around).max())
    high += _EPS * np.abs(high) + 1e-300
    # The j-th largest has n - 1 - j others below it.
    rank = n - 1 - np.arange(k)
    for _ in range(200):
        middle = (low + high) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        left = below(diagonal, second, middle) > rank
        high, low = np.where(left, middle, high), np.where(left, low, middle)
    return (low + high) / 2


def eigenvectors(diagonal: np.ndarray, second: np.ndarray, values: np.ndarray, seed: int = 3) -> np.ndarray:
    """A unit eigenvector of the tridiagonal matrix for each of ``values``, as columns."""
    n, rng = len(diagonal), np.random.default_rng(seed)
    matrix = np.diag(diagonal) + np.diag(second, 1) + np.diag(second, -1)
    norm = np.abs(matrix).sum(axis=1).max()
    if norm == 0:
        return np.eye(n)[:, : len(values)]
    matrix, values = matrix / norm, values / norm
    found = np.zeros((n, len(values)))
    begin = 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > _CLUSTER:
            begin = j
        # A shift beside the eigenvalue keeps the system solvable.
        shifted = matrix - (value + 2 * _EPS * (1 + j - begin)) * np.eye(n)
        v = rng.normal(size=n)
        for _ in range(5):
            near = found[:, begin:j]
            for _ in range(2):
                v -= near @ (near.T @ v)
            v /= np.linalg.norm(v)
            try:
                v = np.linalg.solve(shifted, v)
            except np.linalg.LinAlgError:
                shifted -= 4 * _EPS * np.eye(n)
        near = found[:, begin:j]
        for _ in range(2):
            v -= near @ (near.T @ v)
            v /= np.linalg.norm(v)
        found[:, j] = v
    return found


def principal(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(falling eigenvalues, unit eigenvectors as columns), at most ``k``, none of a value that is zero but for rounding."""
    diagonal, second, q = tridiagonal(covariance)
    values = leading(diagonal, second, min(k, len(diagonal)))
    values = values[values > 4 * len(diagonal) * _EPS * max(values[0], 0.0)]
    vectors = q @ eigenvectors(diagonal, second, values)
    return values, vectors / np.linalg.norm(vectors, axis=0)


@dataclass
class Whitening:
    """The fit: number of vectors, per-dimension sums, eigenvalues, components (columns), trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float


def _matrices(vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimensions, row numbers, scaled integers) of the usable vectors of a batch."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    size = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)  # null entries become NaN
    begin = np.cumsum(size) - size
    for dims in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == dims)
        scaled = np.floor(flat[begin[rows][:, None] + np.arange(dims)] * _SCALE)
        good = (np.abs(scaled) < _MOST).all(axis=1)  # false for NaN
        if good.any():
            yield dims, rows[good], scaled[good].astype(np.int64) + _SHIFT


def _sums(batches) -> Iterator[pa.RecordBatch]:
    total: dict[int, list] = {}
    for batch in batches:
        for dims, rows, x in _matrices(batch.column(0)):
            part = [len(rows), (x >> _HALF).sum(axis=0), (x & ((1 << _HALF) - 1)).sum(axis=0), int(np.abs(x).max())]
            have = total.get(dims)
            total[dims] = part if have is None else [have[0] + part[0], have[1] + part[1], have[2] + part[2], max(have[3], part[3])]
    for dims, (n, high, low, most) in total.items():
        yield pa.RecordBatch.from_pydict(
            {
                "dims": pa.array([dims] * dims, pa.int64()),
                "at": pa.array(np.arange(dims)),
                "n": pa.array([n] * dims, pa.int64()),
                "high": pa.array(high),
                "low": pa.array(low),
                "most": pa.array([most] * dims, pa.int64()),
            }
        )


def _deviations(x: np.ndarray, n: int, sums: list[int], most: int) -> np.ndarray:
    """n * x - sums in exact integers, of 64 bits if all fit."""
    if 4 * n * most < _LONG:
        return x * np.int64(n) - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def _products(batches, n: int, sums: list[int], most: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros((len(sums), len(sums)))
    for batch in batches:
        for dims, _, x in _matrices(batch.column(0)):
            if dims == len(sums):
                centred = (_deviations(x, n, sums, most) / n).astype(float)
                total += centred.T @ centred
    if total.any():
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(len(sums)), pa.int64()), "row": [row.tobytes() for row in total]})


def _added(batches) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total[at] = total.get(at, 0.0) + np.frombuffer(row)
    if total:
        yield pa.RecordBatch.from_pydict({"at": pa.array(list(total), pa.int64()), "row": [row.tobytes() for row in total.values()]})


def fit(vectors: DataFrame, k: int = 8, column: str = "embedding") -> tuple[Whitening, int] | None:
    """Learn from all usable rows of ``vectors``; with the largest entry. None if there is none."""
    ship(vectors.sparkSession)
    only = vectors.where(F.col(column).isNotNull()).select(F.col(column).cast("array<double>").alias("vector"))
    sums = only.mapInArrow(_sums, "dims long, at long, n long, high long, low long, most long").groupBy("dims", "at")
    sums = sums.agg(*(F.sum(c).alias(c) for c in ("n", "high", "low")), F.max("most").alias("most"))
    usual = sums.where("at = 0").orderBy(F.col("n").desc(), F.col("dims").desc()).first()
    if usual is None:
        return None
    dims, n = usual["dims"], usual["n"]
    rows = sorted(sums.where(F.col("dims") == dims).collect(), key=lambda r: r["at"])  # a row a dimension
    totals, most = [(r["high"] << _HALF) + r["low"] for r in rows], max(r["most"] for r in rows)
    parts = only.mapInArrow(lambda b: _products(b, n, totals, most), "at long, row binary")
    added = parts.repartition(min(dims, 64), "at").mapInArrow(_added, "at long, row binary")
    covariance = np.zeros((dims, dims))
    for row in added.collect():  # a row a dimension
        covariance[row["at"]] = np.frombuffer(row["row"]) / n
    covariance = (covariance + covariance.T) / 2
    if not covariance.any():
        return Whitening(n, totals, np.zeros(0), np.zeros((dims, 0)), 0.0), most
    values, components = principal(covariance, k)
    return Whitening(n, totals, values, components, float(np.trace(covariance))), most


def _projected(batches, sent, most: int) -> Iterator[pa.RecordBatch]:
    model = sent.value
    weights = model.components / np.sqrt(model.values)
    for batch in batches:
        for dims, rows, x in _matrices(batch.column(1)):
            if dims != len(model.sums):
                continue
            off = _deviations(x, model.n, model.sums, most)
            whitened = (off / model.n).astype(float) @ weights
            if off.dtype != object and dims * int(np.abs(off).max()) ** 2 >= _LONG:
                off = off.astype(object)
            squares = (off * off).sum(axis=1)
            if off.dtype == object:
                squares = [int(s) if s < _LONG else None for s in squares]
            bounds = np.arange(len(rows) + 1, dtype=np.int32) * whitened.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    pa.array(squares, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(whitened.reshape(-1))),
                ],
                names=["vec_id", "deviation", "whitened"],
            )


def whiten(vectors: DataFrame, k: int = 8, column: str = "embedding") -> DataFrame:
    """A row for each usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or hold null or non-finite entries, or entries of
    2**42 or more, go; so do vectors of another length than most have (of two
    equally frequent lengths, the longer is taken). Repeated rows count each, a
    null id stays null. Components of no variance are left out, with them all
    rows if no entry varies. ``deviation`` is null beyond 64 bits. Other columns
    are not read; an empty table gives no row.
    """
    spark = vectors.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    learned = fit(vectors, k, column)
    if learned is None or not len(learned[0].values):
        return spark.createDataFrame([], schema)
    model, most = learned
    sent = spark.sparkContext.broadcast(model)  # dimensions times components
    rows = vectors.where(F.col(column).isNotNull())
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("vector"))
    rows = rows.mapInArrow(lambda b: _projected(b, sent, most), "vec_id long, deviation long, whitened array<double>")
    rows = materialise(rows, "whitened")
    size = len(model.values)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    value = [F.get("whitened", F.lit(i)) for i in range(size)]
    measured = rows.agg(*(F.covar_pop(value[i], value[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
    error = max(abs(measured[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    shares = F.array(*(F.lit(float(e / model.trace)) for e in model.values))
    exploded = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("nth", "whitened"))
    return exploded.select(
        "vec_id",
        (F.col("nth") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("nth")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
