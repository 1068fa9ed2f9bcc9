"""Embedding whitening by shifted CholeskyQR.

Every entry c becomes the whole number floor(scale * c) + offset, and each distinct vector
of these counts once: the fit list, n vectors with sums S.  With A its centred rows (each
entry (n * x - S) / n, so nothing is lost by subtracting large numbers):

1. A pass over the fit list adds up the Gram matrix of A; a multiple of the identity (the
   shift) is added, so that its Cholesky factor R1 exists whatever the condition of A.
2. Each further pass computes Q = A / R1 / R2 ... by triangular solves, a block of rows at a
   time, and adds up Q's Gram matrix, whose Cholesky factor is the next R, until Q is
   orthonormal.  Only the factors are kept; Q is never stored.
3. The factors are composed to R, and R = U s W' is decomposed: W holds the components (the
   eigenvectors of A'A), s**2 / n their variances.  A'A, whose condition is the square of
   A's, is never decomposed.

A direction in which the vectors do not differ (the Gram matrix of Q has no share of it) is
left alone by the passes and is no component.  A task sends one row of sums for each row of
the Gram matrix; these are added by matrix row, so the driver gets the matrix once, dim * dim
numbers, however many tasks there are.

Defined results: rows whose vector is null, empty or holds null or non-finite entries are
dropped, and so are vectors whose length is not the commonest one (of equally common ones,
the largest); entries whose scaled value leaves 62 bits count as 2**62; ``deviation`` is null
where it leaves 64 bits; rows with a null or repeated id are rows like others; directions
without variance (all of them if there is one distinct vector) give no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, written

SCALE, OFFSET = 64, 1000000
COMPONENTS = 16
ENTRY_LIMIT = float(1 << 62)
#: rows of a block of vectors that a task multiplies at a time
BLOCK = 4096
#: a direction is nil when Q's Gram matrix has no more of it (of at most 1), and Q orthonormal when it differs by no more
NIL, ORTHONORMAL, PASSES = 1e-11, 1e-12, 12
OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass
class Model:
    """What whitening needs: the fit list's size and sums, and the components."""

    n: int
    sums: list[int]
    components: np.ndarray  # a column each
    variances: np.ndarray
    total: float
    identity_error: float = 0.0


def whole_numbers(df: DataFrame, vector: str, keep: list[str], scale: int, offset: int) -> DataFrame:
    """The ``keep`` columns, ``dim`` and ``x`` (the whole numbers, as 64-bit integers one after the other) of rows whose vector is usable."""
    rows = df.select(*keep, F.col(vector).cast("array<double>").alias("vector"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(keep))
            size = np.diff(column.offsets.to_numpy())
            values = column.flatten()
            good = np.isfinite(values.fill_null(np.nan).to_numpy(zero_copy_only=False))
            size[column.is_null().to_numpy(zero_copy_only=False)] = 0
            end = np.cumsum(size)
            bad = np.r_[0, np.cumsum(~good)]
            use = np.flatnonzero((size > 0) & (bad[end] == bad[end - size]))
            x = np.clip(np.floor(np.asarray(values.fill_null(0.0), np.float64) * scale), -ENTRY_LIMIT, ENTRY_LIMIT)
            raw = (np.nan_to_num(x).astype(np.int64) + offset).tobytes()
            blobs = [raw[8 * a:8 * b] for a, b in zip((end - size)[use].tolist(), end[use].tolist())]
            yield pa.record_batch([*(batch.column(i).take(pa.array(use)) for i in range(len(keep))), pa.array(size[use].astype(np.int32)), pa.array(blobs, pa.binary())],
                                  names=[*keep, "dim", "x"])

    kept = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]] + ["dim int", "x binary"])
    return rows.mapInArrow(work, kept)


def _matrix(column: pa.Array, dim: int) -> Iterator[np.ndarray]:
    """Blocks of rows of whole numbers."""
    for lo in range(0, len(column), BLOCK):
        blobs = column.slice(lo, BLOCK).to_pylist()
        yield np.frombuffer(b"".join(blobs), np.int64).reshape(len(blobs), dim)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """(n * x - S) / n; in whole numbers up to the division where 64 bits hold them."""
    most = max(int(np.abs(x).max(initial=0)) * n, max(abs(s) for s in sums))
    if most < 1 << 62:
        return (n * x - np.array(sums, np.int64)) / n
    return np.array([[(n * v - s) / n for v, s in zip(row, sums)] for row in x.tolist()], np.float64).reshape(x.shape)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n * x - S)**2 over the entries of each row, exactly; null beyond 64 bits."""
    most = max(int(np.abs(x).max(initial=0)) * n, max(abs(s) for s in sums))
    if most < 1 << 61:
        apart = n * x - np.array(sums, np.int64)
        if float(np.abs(apart).max(initial=0)) ** 2 * x.shape[1] < 2.0**62:
            return (apart * apart).sum(axis=1).tolist()
    exact = (sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist())
    return [v if v < 1 << 63 else None for v in exact]


def solved(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """a / r for an upper triangular r, by forward substitution along the columns."""
    q = np.empty_like(a)
    for j in range(len(r)):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def added_up(fit: DataFrame, dim: int, of_block, width: int) -> np.ndarray:
    """Sum over all blocks of the fit list of ``of_block(x)``, a matrix of ``width`` columns.

    A task adds up its own blocks; the rows of the sums meet by their number.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in _matrix(batch.column(0), dim):
                part = of_block(x)
                total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch([pa.array(np.arange(len(total), dtype=np.int32)), pa.array([row.tobytes() for row in total], pa.binary())], names=["row", "data"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(data, total_type)
                total[i] = total[i] + part if i in total else part
        yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["row", "data"])

    total_type = of_block(np.zeros((0, dim), np.int64)).dtype
    parts = fit.select("x").mapInArrow(sums, "row int, data binary").repartition(min(shuffle_partitions(fit), dim), "row")
    found = {r.row: np.frombuffer(bytes(r.data), total_type) for r in parts.mapInArrow(rows, "row int, data binary").collect()}
    return np.stack([found[i] for i in range(len(found))]) if found else np.zeros((0, width), total_type)


def _sizes(x: np.ndarray) -> np.ndarray:
    """By entry: the sum in three parts of 21 bits and more, which 64 bits hold apart for 2**42 rows, and the number of rows."""
    return np.stack([(x >> 42).sum(axis=0), (x >> 21 & 0x1FFFFF).sum(axis=0), (x & 0x1FFFFF).sum(axis=0), np.full(x.shape[1], len(x))], axis=1)


def orthogonalised(fit: DataFrame, dim: int, n: int, sums: list[int]) -> tuple[np.ndarray, float]:
    """A matrix M with M'M = A'A for the centred rows A (R, but for directions without variance), and the sum of squares of A."""
    factors: list[np.ndarray] = []
    r, squares = np.eye(dim), 0.0
    for turn in range(PASSES):
        solves = list(factors)

        def gram_of(x: np.ndarray) -> np.ndarray:
            q = centred(x, n, sums)
            for f in solves:
                q = solved(q, f)
            return q.T @ q

        gram = added_up(fit, dim, gram_of, dim)
        gram = (gram + gram.T) / 2
        if not turn:
            squares = float(np.trace(gram))
            if not squares:
                return np.zeros((0, dim)), 0.0
            # the shift that makes Cholesky succeed in double precision, and no smaller than what the sums round off
            shift = 11 * (n * dim + dim * (dim + 1)) * np.finfo(float).eps / 2 * float(np.linalg.norm(gram, 2))
            factor = np.linalg.cholesky(gram + min(shift, squares) * np.eye(dim)).T
        else:
            value, vector = np.linalg.eigh(gram)
            live = value > NIL * value[-1]
            if np.abs(value[live] - 1).max() <= ORTHONORMAL * dim or turn + 1 == PASSES:
                return (np.sqrt(value[live])[:, None] * vector[:, live].T) @ r, squares
            still = vector[:, ~live]
            factor = np.linalg.cholesky(gram + still @ still.T).T
        factors.append(factor)
        r = factor @ r
    raise AssertionError("unreachable")


def fit(df: DataFrame, vector: str = "embedding", k: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> tuple[int, Model | None]:
    """The commonest vector length and the model fitted to the distinct vectors of that length (None without any)."""
    rows = whole_numbers(df, vector, [], scale, offset)
    top = rows.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    if top is None:
        return 0, None
    dim = top.dim
    distinct = written(rows.where(F.col("dim") == dim).select("x").distinct(), "whitening-fit")
    sizes = added_up(distinct, dim, _sizes, 4)
    n, sums = int(sizes[0, 3]), [(int(high) << 42) + (int(middle) << 21) + int(low) for high, middle, low, _ in sizes]
    m, squares = orthogonalised(distinct, dim, n, sums)
    _, s, w = np.linalg.svd(m, full_matrices=False)
    model = Model(n, sums, w[:k].T, s[:k] ** 2 / n, squares / n)
    if len(s):
        model.identity_error = identity_error(distinct, dim, model)
    return dim, model


def projected(x: np.ndarray, model: Model) -> np.ndarray:
    return centred(x, model.n, model.sums) @ model.components / np.sqrt(model.variances)


def identity_error(distinct: DataFrame, dim: int, model: Model) -> float:
    """Largest difference of the whitened fit list's covariance from the identity."""
    k = len(model.variances)

    def moments(x: np.ndarray) -> np.ndarray:
        z = projected(x, model)
        return np.concatenate([z.T @ z, z.sum(axis=0)[None]])

    total = added_up(distinct, dim, moments, k) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whitened(df: DataFrame, vector: str = "embedding", keep: tuple[str, ...] = ("vec_id",), k: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """A row for each usable vector and component (at most ``k``): the ``keep`` columns, component, n, deviation, whitened, explained and identity_error."""
    dim, model = fit(df, vector, k, scale, offset)
    keep = list(keep)
    rows = whole_numbers(df, vector, keep, scale, offset).where(F.col("dim") == dim)
    kept = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields] + [OUT])
    return rows.select(*keep, "x").mapInArrow(_rows_of(dim, model, len(keep)), kept)


def _rows_of(dim: int, model: Model | None, keep: int):
    names = [f.split()[0] for f in OUT.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo = 0
            for x in _matrix(batch.column(keep), dim):
                z = projected(x, model)
                many, k = z.shape
                place = pa.array(lo + np.repeat(np.arange(many), k))
                lo += many
                exact = np.repeat(np.array(deviations(x, model.n, model.sums), object), k)
                shares = model.variances / (model.total or 1.0)
                columns = [pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), many)), pa.array(np.full(many * k, model.n)), pa.array(exact.tolist(), pa.int64()),
                           pa.array(z.ravel()), pa.array(np.tile(shares, many)), pa.array(np.full(many * k, model.identity_error))]
                yield pa.record_batch([*(c.take(place) for c in batch.columns[:keep]), *columns], names=[*batch.schema.names[:keep], *names])

    return work
