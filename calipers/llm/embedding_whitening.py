"""PCA whitening of embeddings with eigenvectors refined by matrix products.

Entries become integers x = floor(256 c). What is fitted is the list of distinct x. Its size, sums
and, centred on the integers nearest the means, its products are added up exactly as integers by
the tasks; what the integer centre leaves (under one half an entry) is taken out exactly at the end.
Only the square of the dimension passes through the driver.

The eigenvectors start as those of a float32 decomposition. Ogita and Aishima's iteration then
refines them with matrix products in extended precision: from R = I - X'X and S = X'AX it takes the
eigenvalues S_ii / (1 - R_ii) and the correction X E, E_ij = (S_ij + l_j R_ij) / (l_j - l_i), which
converges quadratically where eigenvalues are apart. Those closer than the iteration can tell form
clusters; each is solved by itself: A - mu I on the cluster's span, a small matrix, whose own eigenvectors
turn the span's basis, after which its eigenvalues can be told apart.

Rows are left out if their vector is null, holds null or non-finite entries, or has another length
than most vectors (the smaller length on ties). An x beyond a long is the nearest long. A component whose
eigenvalue is zero to rounding (fewer distinct vectors than components) has null whitened and takes no
part in identity_error. explained is null where the trace is zero; deviation is null where it
exceeds a long. Repeated rows and equal ids are rows like others. Nothing left gives no rows.
Other columns are not read.
"""

from __future__ import annotations

from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calipers.llm.common import settle, table

SCALE, COMPONENTS = 256, 4
WIDTHS = (1, 2, 4, 8)
LONG = 2**63
#: Rows of a product; their products stay exact in float64 while entries are below EXACT.
BLOCK, EXACT = 4096, 1 << 20
MAX_ROUNDS = 30


# -- vectors as integers ---------------------------------------------------


def packed(x: np.ndarray) -> bytes:
    """Little-endian integers of the narrowest width that holds all of them, after a byte that names it: equal vectors, equal bytes."""
    low, high = (int(x.min()), int(x.max())) if len(x) else (0, 0)
    width = next(w for w in WIDTHS if -(1 << (8 * w - 1)) <= low and high < 1 << (8 * w - 1))
    return bytes([width]) + x.astype(f"<i{width}").tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=f"<i{blob[0]}", offset=1).astype(np.int64)


def integer_rows(embeddings: DataFrame, dimension: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, x) of the rows that stay."""

    def work(batches):
        for batch in batches:
            vectors = batch.column(1)
            flat = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
            scaled = np.floor(flat * SCALE)
            x = np.where(scaled >= LONG, LONG - 1, np.where(scaled < -LONG, -LONG, np.clip(scaled, -LONG, LONG - 1024).astype(np.int64)))
            blobs = pa.array([packed(row) for row in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), blobs], ["id", "x"])

    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    rows = embeddings.where((F.size(v) == dimension) & finite).select(F.col(id_col), v)
    return rows.mapInArrow(work, f"id {embeddings.schema[id_col].dataType.simpleString()}, x binary")


def _blocks(batches, column: int, dimension: int):
    """Matrices of at most BLOCK packed vectors, with the batch slice they are of."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            own = batch.slice(at, BLOCK)
            yield own, np.array([unpacked(b) for b in own.column(column).to_pylist()]).reshape(-1, dimension)


def _add_up(df: DataFrame, work, dimension: int) -> dict[int, list[int]]:
    """Vectors of integers by row number, added over tasks; decimal text keeps them exact at any size."""

    def add(group):
        columns = zip(*(map(int, v) for v in group.column("v").to_pylist()))
        return pa.table({"i": group.column("i")[:1], "v": pa.array([[str(sum(c)) for c in columns]], pa.list_(pa.string()))})

    sums = df.mapInArrow(work, "i int, v array<string>").groupBy("i").applyInArrow(add, "i int, v array<string>")
    return {row["i"]: [int(s) for s in row["v"]] for row in sums.toLocalIterator()}


def _numbered(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int32()), pa.array([[str(int(s)) for s in v] for _, v in rows], pa.list_(pa.string()))], ["i", "v"])


def size_and_sums(fit: DataFrame, dimension: int) -> tuple[int, list[int]]:
    def work(batches):
        n, sums = 0, [0] * dimension
        for _, x in _blocks(batches, 0, dimension):
            n += len(x)
            wide = x.astype(object) if np.abs(x.astype(np.float64)).max(initial=0) >= 2**50 else x
            sums = [s + int(t) for s, t in zip(sums, wide.sum(axis=0))]
        if n:
            yield _numbered([(0, [n, *sums])])

    found = _add_up(fit.select("x"), work, dimension)
    return (found[0][0], found[0][1:]) if found else (0, [0] * dimension)


def products(fit: DataFrame, dimension: int, centre: list[int]) -> list[list[int]]:
    """Sums of z z' over the fit list, z = x - centre, exact."""

    def work(batches):
        total = np.zeros((dimension, dimension), dtype=object)
        held = np.zeros((dimension, dimension), dtype=np.int64)
        for _, x in _blocks(batches, 0, dimension):
            far = max(int(x.max(initial=0)) - min(centre), max(centre) - int(x.min(initial=0)))
            if far < EXACT:
                z = (x - np.array(centre)).astype(np.float64)
                held += (z.T @ z).astype(np.int64)  # below 2 ** 52 each
                if np.abs(held).max() > 2**61:
                    total, held = total + held, np.zeros_like(held)
            else:
                z = x.astype(object) - np.array(centre, dtype=object)
                total = total + z.T.dot(z)
        total = total + held
        if any(any(row) for row in total.tolist()):
            yield _numbered(list(enumerate(total.tolist())))

    found = _add_up(fit.select("x"), work, dimension)
    return [found.get(i, [0] * dimension) for i in range(dimension)]


# -- eigenvectors ----------------------------------------------------------


def _wide(value: Fraction) -> np.longdouble:
    """A fraction in extended precision: the nearest double and what it leaves."""
    near = float(value)
    return np.longdouble(near) + np.longdouble(float(value - Fraction(near)))


def covariance(n: int, sums: list[int], centre: list[int], second: list[list[int]]) -> np.ndarray:
    """Covariance with divisor n, exact but for the last rounding to extended precision."""
    d = len(sums)
    rest = [s - n * c for s, c in zip(sums, centre)]
    out = np.zeros((d, d), dtype=np.longdouble)
    for i in range(d):
        for j in range(i, d):
            out[i, j] = out[j, i] = _wide(Fraction(n * second[i][j] - rest[i] * rest[j], n * n))
    return out


def _clusters(values: np.ndarray, apart: np.longdouble) -> list[np.ndarray]:
    """Groups of two or more positions whose eigenvalues follow each other within `apart`."""
    order = np.argsort(values)
    gaps = np.flatnonzero(np.diff(values[order]) > apart) + 1
    return [g for g in np.split(order, gaps) if len(g) > 1]


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """The orthonormal basis nearest to one that is almost so, by Newton's iteration."""
    for _ in range(2):
        x = x @ (np.longdouble(1.5) * np.eye(x.shape[1]) - np.longdouble(0.5) * (x.T @ x))
    return x


def _sub_solve(a: np.ndarray, x: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The group's vectors turned within their span so that a - mu is diagonal there."""
    span = x[:, group]
    span = _orthonormal(span)
    small = span.T @ (a @ span)
    small -= np.eye(len(group)) * (np.trace(small) / len(group))
    scale = np.abs(small).max()
    if scale == 0:
        return span
    _, turn = np.linalg.eigh(((small + small.T) / (2 * scale)).astype(np.float64))
    return span @ turn


def refined(a: np.ndarray, max_rounds: int = MAX_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, eigenvectors as columns) of a symmetric matrix in extended precision."""
    d, scale = len(a), np.abs(a).max(initial=0)
    if scale == 0:
        return np.zeros(d, dtype=np.longdouble), np.eye(d, dtype=np.longdouble)
    unit, eps = a / scale, np.finfo(np.longdouble).eps
    _, start = np.linalg.eigh(unit.astype(np.float32))
    x, identity, best = start.astype(np.longdouble), np.eye(d, dtype=np.longdouble), np.inf
    for k in range(max_rounds):
        r = identity - x.T @ x
        s = x.T @ (unit @ x)
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        unsure = 2 * (np.linalg.norm(off.astype(np.float64)) + np.linalg.norm(unit.astype(np.float64)) * np.linalg.norm(r.astype(np.float64)))
        groups = _clusters(values, max(np.longdouble(unsure), 4 * d * eps)) if unsure > 64 * d * eps else []
        if groups:
            for group in groups:
                x[:, group] = _sub_solve(unit, x, group)
            r = identity - x.T @ x
            s = x.T @ (unit @ x)
            values = np.diag(s) / (1 - np.diag(r))
        gap = values[None, :] - values[:, None]
        # pairs told apart by more than their own coupling are corrected, the others only made orthonormal
        told = np.abs(gap) > np.maximum(2 * np.abs(s + values[None, :] * r), 4 * d * eps)
        np.fill_diagonal(told, False)
        e = np.where(told, (s + values[None, :] * r) / np.where(told, gap, 1), r / 2)
        x = x + x @ e
        size = float(np.abs(e).max())
        if size <= 8 * eps or (k > 6 and size >= best / 2 and size < 1e-15):
            break
        best = min(best, size)
    x = _orthonormal(x)
    values = np.diag(x.T @ (unit @ x)) / np.diag(x.T @ x)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order]


# -- whitening -------------------------------------------------------------


class Fit(NamedTuple):
    n: int
    sums: list[int]
    mean: np.ndarray
    directions: np.ndarray  # a column per component
    values: np.ndarray  # their eigenvalues
    trace: float


def fitted(fit: DataFrame, dimension: int, components: int = COMPONENTS) -> Fit | None:
    """The fit of a settled table of distinct packed vectors; None if it is empty."""
    n, sums = size_and_sums(fit, dimension)
    if not n:
        return None
    centre = [(2 * s + n) // (2 * n) for s in sums]
    v = covariance(n, sums, centre, products(fit, dimension, centre))
    values, vectors = refined(v)
    keep = min(components, dimension)
    top = np.where(values[:keep] > 64 * dimension * np.finfo(np.float64).eps * max(values.max(initial=0), 0), values[:keep], 0)
    mean = np.array([_wide(Fraction(s, n)) for s in sums], dtype=np.longdouble)
    return Fit(n, sums, mean, vectors[:, :keep].astype(np.float64), top.astype(np.float64), float(np.trace(v)))


def projected(x: np.ndarray, fit: Fit) -> np.ndarray:
    """x - S/n on the components over the root of their eigenvalues; the difference is rounded once."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return ((x - fit.mean).astype(np.float64) @ fit.directions) / np.sqrt(fit.values)


def identity_error(fit_rows: DataFrame, fit: Fit) -> float:
    """Largest entry of whitened's covariance over the fit list, less the identity. Means first, then centred products."""
    live = np.flatnonzero(fit.values > 0)
    if not len(live):
        return 0.0
    dimension, k = len(fit.sums), len(live)

    def averaged(of) -> np.ndarray:
        def work(batches):
            sums = sum((of(projected(x, fit)[:, live]) for _, x in _blocks(batches, 0, dimension)), np.zeros(1))
            yield pa.RecordBatch.from_arrays([pa.array([np.broadcast_to(sums, sums.shape).tolist()], pa.list_(pa.float64()))], ["v"])

        parts = fit_rows.select("x").mapInArrow(work, "v array<double>").select(F.posexplode("v").alias("i", "s"))
        found = parts.groupBy("i").agg(F.sum("s").alias("s")).orderBy("i").collect()
        return np.array([row["s"] for row in found]) / fit.n

    mean = averaged(lambda w: w.sum(axis=0))
    moments = averaged(lambda w: ((w - mean).T @ (w - mean)).ravel()).reshape(k, k)
    return float(np.abs(moments - np.eye(k)).max())


def whitened(rows: DataFrame, fit: Fit, error: float) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of packed rows (id, x)."""
    dimension, k = len(fit.sums), len(fit.values)
    live = fit.values > 0
    share = [float(e) / fit.trace if fit.trace > 0 else None for e in fit.values]
    small = max((abs(s) for s in fit.sums), default=0)

    def deviations(x: np.ndarray) -> list[int | None]:
        most = fit.n * int(np.abs(x.astype(np.float64)).max(initial=0)) + small
        if dimension * (most + 1) ** 2 < LONG // 2:
            y = fit.n * x - np.array(fit.sums, dtype=np.int64)
            return (y * y).sum(axis=1).tolist()
        exact = [sum((fit.n * int(c) - s) ** 2 for c, s in zip(row, fit.sums)) for row in x]
        return [v if v < LONG else None for v in exact]

    def work(batches):
        for own, x in _blocks(batches, 1, dimension):
            m = len(x)
            w = projected(x, fit)
            columns = [
                own.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, fit.n, dtype=np.int64)),
                pa.array([v for v in deviations(x) for _ in range(k)], pa.int64()),
                pa.array(w.ravel(), mask=np.tile(~live, m)),
                pa.array(share * m, pa.float64()),
                pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(work, f"id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    lengths = embeddings.where(F.size(vector_col) > 0).groupBy(F.size(vector_col).alias("d")).count()
    most = lengths.orderBy(F.desc("count"), "d").first()
    dimension = most["d"] if most else 1
    rows = settle(integer_rows(embeddings, dimension, id_col, vector_col))
    distinct = settle(rows.select("x").distinct())
    fit = fitted(distinct, dimension, components) or Fit(0, [0] * dimension, np.zeros(dimension), np.zeros((dimension, 0)), np.zeros(0), 0.0)
    error = identity_error(distinct, fit)
    return whitened(rows, fit, error).withColumnRenamed("id", id_col)


def op12_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
