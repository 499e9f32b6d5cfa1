"""Principal components and whitening by Chebyshev-filtered subspace iteration.

The covariance is never formed. The table is read once into blocks of whole
numbers; from then on every step multiplies the covariance with a few vectors Q:
each task adds up Xᵀ(XQ) over its blocks, X being the centred rows, and the
tasks' sums are merged in parallel. One round of the iteration is a Chebyshev
polynomial of the covariance, by its three-term recurrence, applied to Q: it
stays small on the unwanted part of the spectrum and grows on the wanted one.
QR and a Rayleigh-Ritz step follow. It ends when the residuals of the wanted
components are at rounding level and a Lanczos run in the complement of Q finds
no larger eigenvalue.

What the driver holds is some dim x BLOCK_FACTOR * k numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators.vectorsum import as_list_column, as_matrix, merge_sums
from kindred.session import materialize

# Fixed values of the whole-number form of an entry.
SCALE = 1024
SHIFT = 100_000
#: Entries from here on have no whole-number form with room for sums and are put aside like infinite ones.
LARGEST_ENTRY = 2.0**40

COMPONENTS = 8
#: Vectors that are iterated for each wanted one.
BLOCK_FACTOR = 4
#: Rows of a block at most, and its bytes.
BLOCK_ROWS = 4_096
#: Residual norm, relative to the largest eigenvalue, that counts as zero, and the one that must be reached.
ROUNDING = 4e-15
CERTIFIED = 1e-10
#: Growth of the largest eigenvalue against the damped ones within one round.
ROUND_GROWTH = 1e8
MAX_DEGREE = 24
MAX_ROUNDS = 200
#: Tasks' products are merged to so many before the driver adds them up.
MERGED = 16

SUMS = "key bigint, part bigint, n bigint, total array<double>"
BLOCKS = "ids array<bigint>, x binary, n bigint, s array<decimal(38,0)>"


@dataclass(frozen=True)
class Whitening:
    """Wanted eigenvectors (columns) and eigenvalues of the covariance, its
    trace, and the exact count and sums of the fit list."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residual: float


def usable_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, v: rows whose vector is neither null nor holds null, non-finite or oversized entries."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= F.lit(LARGEST_ENTRY)))
    return df.filter(v.isNotNull() & ~bad).select(F.col(id_col).cast("bigint").alias("id"), v.cast("array<double>").alias("v"))


def whole_blocks(rows: DataFrame) -> DataFrame:
    """Blocks of ids and whole numbers floor(1024 c) + 100000, with their counts and sums."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                piece = batch.slice(lo, BLOCK_ROWS)
                x = np.floor(SCALE * as_matrix(piece.column(1))).astype(np.int64) + SHIFT
                columns = [
                    pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), piece.column(0)),
                    pa.array([x.astype("<i8").tobytes()], pa.binary()),
                    pa.array([len(x)], pa.int64()),
                    pa.array([[int(s) for s in x.sum(axis=0)]], pa.list_(pa.decimal128(38, 0))),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["ids", "x", "n", "s"])

    return rows.mapInArrow(blocks, BLOCKS)


def exact_sums(blocks: DataFrame) -> tuple[int, list[int]]:
    """Rows of the fit list and their exact sums per dimension (one row per dimension is collected)."""
    sizes = blocks.agg(F.sum("n"), F.min(F.size("s")), F.max(F.size("s"))).first()
    if sizes[0] is None:
        return 0, []
    if sizes[1] != sizes[2]:
        raise ValueError(f"vectors of {sizes[1]} and of {sizes[2]} entries")
    each = blocks.select(F.posexplode("s").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s")).orderBy("i")
    return int(sizes[0]), [int(r["s"]) for r in each.collect()]


def _deviations(data: bytes, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S of a block's rows, exact: in 64 bits where they suffice, else as Python integers."""
    x = np.frombuffer(data, "<i8").reshape(-1, len(sums))
    if n * int(np.abs(x).max(initial=0)) + max((abs(int(s)) for s in sums), default=0) < 2**62:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def _centred(data: bytes, n: int, sums: np.ndarray) -> np.ndarray:
    return _deviations(data, n, sums).astype(np.float64) / n


def _added_up(blocks: DataFrame, n: int, sums: list[int], product) -> np.ndarray:
    """The sum over all blocks of ``product`` (a vector) of the centred rows."""
    sums = np.array(sums, object)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for data in batch.column(0):
                here = product(_centred(data.as_py(), n, sums))
                total = here if total is None else total + here
        if total is not None:
            part = TaskContext.get().partitionId()
            columns = [pa.array([0], pa.int64()), pa.array([part], pa.int64()), pa.array([1], pa.int64()), as_list_column(total[None, :])]
            yield pa.RecordBatch.from_arrays(columns, ["key", "part", "n", "total"])

    merged = merge_sums(blocks.select("x").mapInArrow(added, SUMS), MERGED)
    return np.sum([row["total"] for row in merged.collect()], axis=0)


def _covariance_times(blocks: DataFrame, n: int, sums: list[int], q: np.ndarray) -> np.ndarray:
    """The covariance times the columns of ``q``, in one pass."""
    return _added_up(blocks, n, sums, lambda x: (x.T @ (x @ q)).ravel()).reshape(q.shape) / n


def _orthonormal(y: np.ndarray) -> np.ndarray:
    return np.linalg.qr(y)[0]


def _rayleigh_ritz(q: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values, falling, with the rotated basis and its product, from q and w = Vq."""
    projected = q.T @ w
    values, rotation = np.linalg.eigh((projected + projected.T) / 2)
    rotation = rotation[:, ::-1]
    return values[::-1], q @ rotation, w @ rotation


def _lanczos(apply, start: np.ndarray, keep_out: np.ndarray | None, enough) -> tuple[np.ndarray, np.ndarray, float]:
    """Ritz values (rising) and the largest one's vector of a Lanczos run, with the
    last residual bound. It runs until ``enough(values, bounds)`` or the space is used up."""
    out = np.zeros((len(start), 0)) if keep_out is None else keep_out
    space = len(start) - out.shape[1]
    basis, alpha, beta = [], [], []
    v = start
    while True:
        for _ in range(2):
            v = v - out @ (out.T @ v)
            for b in basis:
                v = v - b * (b @ v)
        length = np.linalg.norm(v)
        if basis and length <= 1e-10 * max(map(abs, alpha)):
            break
        if basis:
            beta.append(length)
        v = v / length
        basis.append(v)
        v = apply(v)
        alpha.append(float(basis[-1] @ v))
        rest = v - alpha[-1] * basis[-1] - (beta[-1] * basis[-2] if beta else 0)
        tri = np.diag(alpha) + np.diag(beta, 1) + np.diag(beta, -1)
        values, vectors = np.linalg.eigh(tri)
        last = np.linalg.norm(rest - out @ (out.T @ rest))
        bounds = last * np.abs(vectors[-1])
        if len(basis) >= space or enough(values, bounds):
            break
        v = rest
    values, vectors = np.linalg.eigh(np.diag(alpha) + np.diag(beta, 1) + np.diag(beta, -1))
    return values, np.array(basis).T @ vectors[:, -1], float(bounds[0])


def _filtered(apply, q: np.ndarray, w: np.ndarray, values: np.ndarray, low: float) -> np.ndarray:
    """A Chebyshev polynomial of the covariance applied to q, w = Vq being known.
    [low, values[-1]] is damped; the recurrence is scaled by its growth at values[0]."""
    cut = values[-1]
    centre, half = (cut + low) / 2, (cut - low) / 2
    top = (values[0] - centre) / half
    degree = int(np.clip(math.log(ROUND_GROWTH) / max(math.acosh(max(top, 1.0)), 1e-3), 2, MAX_DEGREE))
    sigma = first = 1 / top
    before, now = q, (w - centre * q) * (first / half)
    for _ in range(degree - 1):
        grown = 1 / (2 / first - sigma)
        before, now = now, (apply(now) - centre * now) * (2 * grown / half) - before * (sigma * grown)
        sigma = grown
    return now


def fit_whitening(blocks: DataFrame, k: int = COMPONENTS) -> Whitening | None:
    """The k largest components with positive variance of the blocks' rows; None without rows.

    All passes go over the whole table. Raises where the residuals cannot be certified.
    """
    n, sums = exact_sums(blocks)
    if not n:
        return None
    dim = len(sums)
    trace = float(_added_up(blocks, n, sums, lambda x: np.array([np.einsum("ij,ij->", x, x)]))[0]) / n if dim else 0.0
    if trace == 0:
        return Whitening(n, tuple(sums), np.zeros((dim, 0)), np.zeros(0), 0.0, 0.0)
    random = np.random.default_rng(17)

    def apply(y: np.ndarray) -> np.ndarray:
        return _covariance_times(blocks, n, sums, y if y.ndim == 2 else y[:, None]).reshape(y.shape)

    width = min(dim, BLOCK_FACTOR * k)
    q = _orthonormal(random.normal(size=(dim, width)))
    values, q, w = _rayleigh_ritz(q, apply(q))
    k = min(k, dim)
    low = 0.0
    if width < dim:
        # lower end of the spectrum: least Ritz value of a short run, less its bound
        ritz, _, bound = _lanczos(apply, random.normal(size=dim), None, lambda v, b: len(v) >= 12)
        low = max(0.0, ritz[0] - bound)
    before = math.inf
    for _ in range(MAX_ROUNDS):
        residual = float(np.linalg.norm(w[:, :k] - q[:, :k] * values[:k], axis=0).max()) / values[0]
        done = residual <= ROUNDING or (residual <= CERTIFIED and residual > before / 4)
        if done and width < dim:
            q, w, values, done = _certified(apply, q, w, values, k, random)
        if done:
            break
        before = residual
        if width == dim or values[-1] - low <= 1e-12 * values[0]:
            q = _orthonormal(w)  # nothing to damp
        else:
            q = _orthonormal(_filtered(apply, q, w, values, low))
        values, q, w = _rayleigh_ritz(q, apply(q))
    else:
        raise ArithmeticError(f"components not certified: residual {residual:.1e} of the largest variance")
    positive = int((values[:k] > dim * np.finfo(float).eps * trace).sum())
    return Whitening(n, tuple(sums), q[:, :positive], values[:positive], trace, residual)


def _certified(apply, q, w, values, k, random):
    """Whether no direction outside q has more variance than the k-th component;
    if one has, it takes the place of the last column."""
    tolerance = 1e-9 * values[0]

    def settled(ritz: np.ndarray, bounds: np.ndarray) -> bool:
        return ritz[-1] > values[k - 1] + tolerance or ritz[-1] + bounds[-1] <= values[k - 1] + tolerance

    ritz, missed, _ = _lanczos(apply, random.normal(size=len(q)), q, settled)
    if ritz[-1] <= values[k - 1] + tolerance:
        return q, w, values, True
    swapped = _orthonormal(np.column_stack([q[:, :-1], missed]))
    values, q, w = _rayleigh_ritz(swapped, apply(swapped))
    return q, w, values, False


def _project(fit: Whitening):
    sums, axes = np.array(fit.sums, object), fit.vectors / np.sqrt(fit.values)
    return sums, lambda x: x @ axes


def identity_error(blocks: DataFrame, fit: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    _, project = _project(fit)
    k = fit.vectors.shape[1]

    def product(x: np.ndarray) -> np.ndarray:
        y = project(x)
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    total = _added_up(blocks, fit.n, list(fit.sums), product) / fit.n
    mean, second = total[:k], total[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whitened_rows(blocks: DataFrame, fit: Whitening, error: float) -> DataFrame:
    """One row per vector and component."""
    sums, project = _project(fit)
    k = fit.vectors.shape[1]
    explained = fit.values / fit.trace
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data in zip(batch.column(0), batch.column(1)):
                exact = _deviations(data.as_py(), fit.n, sums)
                whitened = project(exact.astype(np.float64) / fit.n)
                rows = len(exact)
                bound = max((abs(int(d)) for d in (exact.max(initial=0), exact.min(initial=0))), default=0)
                if exact.dtype == object or bound * bound * exact.shape[1] >= 2**63:
                    squares = (exact.astype(object) ** 2).sum(axis=1)
                    deviation = pa.array([int(s) if s < 2**63 else None for s in squares], pa.int64())
                else:
                    deviation = pa.array((exact * exact).sum(axis=1))
                every = pa.array(np.repeat(np.arange(rows), k))
                columns = [
                    ids.values.take(every),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, fit.n, np.int64)),
                    deviation.take(every),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = [field.split()[0] for field in schema.split(", ")]
    return blocks.select("ids", "x").mapInArrow(rows, schema)


def whiten(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row
    per vector and component up to k.

    Defined cases: rows whose vector is null or holds null or non-finite entries,
    or entries of 2^40 and more, are left out; vectors of different sizes are an
    error. Ids may be null or repeated, every row comes back. Directions without
    variance are no components: a table of one row, or of equal ones, gives no
    rows, nor does an empty one. A deviation beyond a long is null. Components of
    equal variance are any orthonormal basis of theirs, the same for all rows.
    Other columns are not read.
    """
    rows = usable_vectors(df, id_col, vector_col)
    blocks = materialize(whole_blocks(rows), "whole")
    fit = fit_whitening(blocks, k)
    if fit is None or not len(fit.values):
        fit = Whitening(0, (), np.zeros((0, 0)), np.zeros(0), 1.0, 0.0)
        return whitened_rows(blocks.limit(0), fit, 0.0)
    return whitened_rows(blocks, fit, identity_error(blocks, fit))
