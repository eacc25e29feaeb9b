"""Whitening of embeddings by the leading components of their covariance, found by FEAST contour integration.

Statistics come from two passes over the vectors (exact sums, centred products). The
spectrum of the covariance, a matrix as wide as a vector, is cut into slices by
inertia counts, and each slice is solved in a task of its own: quadrature of complex
shifted solves around the slice projects a block of vectors onto its eigenvectors,
Rayleigh-Ritz extracts them, and the inertia count says that none is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMPONENTS = 32
#: Eigenvalues of a slice at most, unless they are too close to cut between.
SLICE = 8
#: A slice grows while its neighbours are further away than this share of its width.
SEPARATION = 0.1
NODES = 8
ROUNDS = 40
#: Entries become floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Entries beyond this don't fit the integers of the sums.
LARGEST = 2.0 ** 40
#: Sums of partitions are added up by so many tasks before they reach the driver.
FAN_IN = 64


def valid_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, vec`` (doubles) of the rows whose vector and entries are all there and finite."""
    entry = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    vec = F.col(vec_col).cast("array<double>")
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec"))
            .where(F.col("vec").isNotNull() & (F.size("vec") > 0) & ~F.exists("vec", entry)))


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of one length as rows of integers."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) and np.abs(flat).max() > LARGEST:
        raise ValueError(f"an entry is larger than {LARGEST:g}")
    return (np.floor(SCALE * flat) + SHIFT).astype(np.int64).reshape(len(column), -1)


def column_sums(rows: DataFrame) -> tuple[int, np.ndarray]:
    """The number of vectors of the commonest length (ties: the longest) and their exact sums by dimension."""
    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            sizes = batch.column(0).value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(sizes).tolist():
                x = _matrix(batch.column(0).filter(pa.array(sizes == size)))
                n, s = totals.get(size, (0, 0))
                totals[size] = n + len(x), s + x.sum(axis=0)
        for size, (n, s) in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([size], pa.int32()), pa.array([n], pa.int64()),
                                              pa.array([s.tolist()], pa.list_(pa.int64()))], names=["dim", "n", "sums"])

    parts = rows.select("vec").mapInArrow(added, "dim int, n long, sums array<long>")
    total = (parts.select("dim", "n", F.posexplode("sums").alias("at", "s")).groupBy("dim", "at")
             .agg(F.sum("n").alias("n"), F.sum("s").alias("s")))
    # one row for each length, then one for each dimension of the commonest
    best = total.where("at = 0").orderBy(F.desc("n"), F.desc("dim")).first()
    if best is None:
        return 0, np.zeros(0, np.int64)
    sums = total.where(F.col("dim") == best["dim"]).orderBy("at").collect()
    return best["n"], np.array([r["s"] for r in sums], np.int64)


def _products(rows: DataFrame, mean: np.ndarray, axes: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Sums, and sums of products, of the centred vectors (along ``axes``, if given).

    Each partition gives one row of sums; FAN_IN tasks add them, in order of partitions,
    so at most FAN_IN rows reach the driver, each as large as a covariance matrix.
    """
    width = len(mean) if axes is None else axes.shape[1]
    kinds = "pid long, total array<double>"

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, pid = np.zeros(width * (width + 1)), 0
        for batch in batches:
            pid = batch.column(0)[0].as_py() if len(batch) else pid
            y = _matrix(batch.column(1)) - mean
            y = y if axes is None else y @ axes
            total[:width] += y.sum(axis=0)
            total[width:] += (y.T @ y).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([pid], pa.int64()), pa.array([total.tolist()], pa.list_(pa.float64()))],
                                         names=["pid", "total"])

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, pid = np.zeros(width * (width + 1)), None
        for batch in batches:
            for k in range(len(batch)):
                pid = batch.column(0)[k].as_py() if pid is None else pid
                total += batch.column(1)[k].values.to_numpy(zero_copy_only=False)
        if pid is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pid]), pa.array([total.tolist()], pa.list_(pa.float64()))],
                                             names=["pid", "total"])

    parts = rows.where(F.size("vec") == len(mean)).select(F.spark_partition_id().cast("long").alias("pid"), "vec")
    few = (parts.mapInArrow(summed, kinds).repartition(FAN_IN, "pid").sortWithinPartitions("pid")
           .mapInArrow(combined, kinds).collect())
    total = sum((np.array(r["total"]) for r in sorted(few, key=lambda r: r["pid"])), np.zeros(width * (width + 1)))
    return total[:width], total[width:].reshape(width, width)


# --- the spectrum of a symmetric matrix ---

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the same inertia at every shift."""
    a = matrix.astype(float).copy()
    for k in range(len(a) - 2):
        v = a[k + 1:, k].copy()
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        if not (size := np.linalg.norm(v)):
            continue
        v /= size
        block = a[k:, k:]
        u = np.concatenate(([0.0], v))
        p = block @ u
        w = p - (u @ p) * u
        block -= 2 * (np.outer(u, w) + np.outer(w, u))
    return np.diag(a).copy(), np.diag(a, 1).copy()


def inertia(form: tuple[np.ndarray, np.ndarray], shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie above each shift: the positive pivots of the shifted matrix."""
    diagonal, beside = form
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    above, pivot = np.zeros(len(shifts), int), np.ones(len(shifts))
    with np.errstate(over="ignore"):  # an infinite pivot has the right sign
        for k, d in enumerate(diagonal):
            pivot = d - shifts - (beside[k - 1] ** 2 / pivot if k else 0)
            pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
            above += pivot > 0
    return above


@dataclass
class Slice:
    low: float
    high: float
    count: int


def slices(matrix: np.ndarray, k: int, most: int = SLICE) -> list[Slice]:
    """Intervals around the ``k`` largest eigenvalues (more, where the next are too close to cut between,
    fewer, where the matrix has a lower rank). Inertia counts at all ends say that no eigenvalue
    lies between intervals, and how many lie in each."""
    form, d = tridiagonal(matrix), len(matrix)
    bound = np.abs(matrix).sum(axis=1).max()
    # an eigenvalue below the rounding of the largest is none
    k = min(k, int(inertia(form, np.array([bound * d * np.finfo(float).eps * 16]))[0])) if bound else 0
    if not k:
        return []
    want = np.arange(1, d + 1)
    low, high = np.full(d, -bound * 1.01), np.full(d, bound * 1.01)
    for _ in range(60):  # bisection for all eigenvalues at once
        middle = (low + high) / 2
        more = inertia(form, middle) >= want
        low, high = np.where(more, middle, low), np.where(more, high, middle)
    values = (low + high) / 2
    gaps = np.append(values[:-1] - values[1:], np.inf)  # gaps[i]: below eigenvalue i
    close = bound * 1e-7
    out, at = [], 0
    while at < k:
        above = gaps[at - 1] if at else np.inf
        cuts = range(at, min(at + most, k))
        # quadrature tells a slice's neighbours apart by their distance over its width
        apart = [min(gaps[i], above) / max(values[at] - values[i], close) for i in cuts]
        cut = max((i for i, ratio in zip(cuts, apart) if ratio >= SEPARATION), default=cuts[int(np.argmax(apart))])
        while gaps[cut] < close:
            cut += 1
        widest = min(max(values[at] - values[cut], min(above, gaps[cut])), bound)
        out.append(Slice(float(values[cut] - min(gaps[cut], widest) / 2), float(values[at] + min(above, widest) / 2), cut + 1 - at))
        at = cut + 1
    ends = np.cumsum([s.count for s in out])
    counted = inertia(form, np.array([x for s in out for x in (s.high, s.low)])).reshape(-1, 2)
    if not (counted == np.stack([np.append(0, ends[:-1]), ends], 1)).all():
        raise ArithmeticError("slices and inertia counts disagree")
    return out


def feast(matrix: np.ndarray, part: Slice, nodes: int = NODES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues (falling) and unit eigenvectors of a symmetric matrix within a slice.

    Gauss-Legendre quadrature along a circle around the slice sums the real parts of
    ``(z I - A)^-1 Y``, which keeps of ``Y`` just what lies in the slice's eigenspace, but for the
    quadrature's error; each round projects anew the Ritz vectors of the last. Ends when
    as many residuals as the inertia count are at rounding level, or no longer fall.
    """
    d = len(matrix)
    scale = np.abs(matrix).sum(axis=1).max()
    m = min(d, max(part.count + 4, (3 * part.count + 1) // 2))
    middle, radius = (part.low + part.high) / 2, (part.high - part.low) / 2
    points, weights = np.polynomial.legendre.leggauss(nodes)
    turn = np.exp(-0.5j * np.pi * (points - 1))
    y = np.random.default_rng(d).standard_normal((d, m))
    last, best = np.inf, None
    for _ in range(rounds):
        q = np.zeros((d, m))
        for t, w in zip(turn, weights):
            shifted = (middle + radius * t) * np.eye(d) - matrix
            q += w / 2 * np.real(radius * t * np.linalg.solve(shifted, y.astype(complex)))
        basis, _ = np.linalg.qr(q)
        values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
        y = basis @ turned
        off = np.linalg.norm(matrix @ y - y * values, axis=0)
        inside = np.flatnonzero((values > part.low) & (values < part.high))
        if len(inside) < part.count:
            continue
        # mixtures of eigenvectors on both sides may have Ritz values inside, but large residuals
        inside = np.sort(inside[np.argsort(off[inside], kind="stable")[:part.count]])[::-1]
        found, vectors, residual = values[inside], y[:, inside], off[inside].max()
        if residual < last:
            best = found, vectors
        if residual <= 1e-15 * scale or residual >= last / 2 and residual <= 1e-11 * scale:
            return best
        last = min(last, residual)
    raise ArithmeticError(f"no {part.count} eigenvectors found between {part.low} and {part.high}")


def leading_components(spark: SparkSession, matrix: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest positive eigenvalues (falling) and their unit eigenvectors (columns); a slice a task.

    The vectors of all slices are at last made orthogonal together by one Rayleigh-Ritz step.
    """
    parts = slices(matrix, k)
    if not parts:
        return np.zeros(0), np.zeros((len(matrix), 0))

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, count in zip(*(c.to_pylist() for c in batch.columns)):
                values, vectors = feast(matrix, Slice(low, high, count))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values), pa.array(vectors.T.tolist(), pa.list_(pa.float64()))], names=["value", "vector"])

    tasks = spark.createDataFrame([(s.low, s.high, s.count) for s in parts], "low double, high double, count long")
    # at most k vectors and what ties with the last
    found = tasks.repartition(len(parts), "low").mapInArrow(solved, "value double, vector array<double>").collect()
    found.sort(key=lambda r: -r["value"])
    basis, _ = np.linalg.qr(np.array([r["vector"] for r in found]).T)
    values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
    return values[::-1][:k], (basis @ turned)[:, ::-1][:, :k]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for each vector and component.

    Entries become integers; ``deviation`` is the exact squared distance of n times the
    vector from the sums, a decimal; ``whitened`` is the centred vector along the
    component over the root of its eigenvalue; ``explained`` the eigenvalue's share of the
    trace; ``identity_error`` the largest entry, of all vectors' whitened covariance, off
    the identity.

    Defined cases: rows without a vector, with an empty one, or with null or non-finite
    entries are left out, and so are those whose length isn't the commonest (ties: the
    longest); repeated rows and null ids count as rows; where vectors span fewer than
    ``k`` dimensions there are as many components as they span, none if all are equal;
    entries beyond 2^40 raise; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = valid_vectors(vectors, id_col, vec_col)
    n, sums = column_sums(rows)
    dim, mean = len(sums), sums / max(n, 1)
    _, products = _products(rows, mean, None) if n else (None, np.zeros((0, 0)))
    covariance = (products + products.T) / 2 / max(n, 1)
    values, components = leading_components(spark, covariance, k) if n else (np.zeros(0), np.zeros((0, 0)))
    axes = components / np.sqrt(values)
    error = 0.0
    if len(values):
        total, squares = _products(rows, mean, axes)
        error = float(np.abs(squares / n - np.outer(total / n, total / n) - np.eye(len(values))).max())

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            off = n * x - sums
            if len(x) and float(np.abs(off).max()) ** 2 * dim >= 2.0 ** 62:
                deviation = [sum(v * v for v in row) for row in off.tolist()]
            else:
                deviation = (off * off).sum(axis=1).tolist()
            z = (x - mean) @ axes
            ends = pa.array(np.arange(len(x) + 1) * z.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(deviation, pa.decimal128(38, 0)), pa.ListArray.from_arrays(ends, pa.array(z.ravel()))],
                names=["vec_id", "deviation", "z"])

    placed = rows.where(F.size("vec") == dim).mapInArrow(projected, "vec_id long, deviation decimal(38,0), z array<double>")
    trace = float(np.trace(covariance)) if dim else 0.0
    shares = F.array(*[F.lit(float(v / trace)) for v in values]).cast("array<double>")
    return (placed.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    F.element_at(shares, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error")))
