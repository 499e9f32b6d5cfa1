"""Numeric helper used inside tasks: running top-k of cosine scores.

Scores are screened in single precision (one matrix product per tile) and
every pair that may still belong to the result is scored again in double
precision, so the outcome equals a full double precision scan.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

QUERY_TILE = 512
POINT_TILE = 8192
RERANK_PAIRS = 1 << 16


def matrix_of(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Arrow ``list<float>`` column as an (n, dim) float32 matrix; null entries are NaN."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.empty((0, dim), dtype=np.float32)
    if column.null_count or not np.all(column.value_lengths().to_numpy(zero_copy_only=False) == dim):
        raise ValueError(f"every vector must have {dim} entries; see split_invalid_vectors")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float32, copy=False).reshape(-1, dim)


def ids_of(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)
    return values if values.dtype != object else values.astype(str)


def norms_of(matrix: np.ndarray) -> np.ndarray:
    """Row norms in double precision; 1 for zero vectors so that they score 0."""
    norm = np.sqrt(np.einsum("ij,ij->i", matrix, matrix, dtype=np.float64))
    norm[norm == 0] = 1.0
    return norm


def surplus_copies(ids: np.ndarray, matrix: np.ndarray, k: int) -> np.ndarray:
    """Mask of points that cannot be in any top-k of this block.

    Of equal vectors only the k smallest ids can ever be returned (the rest
    lose every tie), so further copies are left out before scoring. Copies are
    found by a row hash and confirmed by comparison.
    """
    surplus = np.zeros(len(ids), dtype=bool)
    if len(ids) <= k:
        return surplus
    bits = np.ascontiguousarray(matrix).view(np.uint32)
    factors = np.random.default_rng(1).integers(1, 1 << 62, matrix.shape[1], dtype=np.uint64) * 2 + 1
    # some rows at a time: in 64 bits they take twice the room
    parts = (bits[i : i + POINT_TILE].astype(np.uint64) * factors for i in range(0, len(bits), POINT_TILE))
    row_hash = np.concatenate([part.sum(axis=1, dtype=np.uint64) for part in parts])
    _, group, size = np.unique(row_hash, return_inverse=True, return_counts=True)
    crowded = np.nonzero(size[group] > k)[0]
    if len(crowded) == 0:
        return surplus
    crowded = crowded[np.lexsort((ids[crowded], group[crowded]))]
    starts = np.nonzero(np.r_[True, np.diff(group[crowded]) != 0])[0]
    first_of_row = np.repeat(starts, np.diff(np.r_[starts, len(crowded)]))
    place = np.arange(len(crowded)) - first_of_row
    same = np.all(matrix[crowded] == matrix[crowded[first_of_row]], axis=1)
    surplus[crowded[(place >= k) & same]] = True
    return surplus


class PointBlock:
    """Points prepared for scoring. Points with an entry that is no number match
    nothing and are left out here, before they can take a place among the best."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, k: int) -> None:
        finite = np.isfinite(matrix).all(axis=1)
        if not finite.all():
            ids, matrix = ids[finite], matrix[finite]
        keep = ~surplus_copies(ids, matrix, k)
        if not keep.all():
            ids, matrix = ids[keep], matrix[keep]
        self.ids = ids
        self.matrix = matrix
        self.norm = norms_of(matrix)
        self.unit = (matrix / self.norm[:, None]).astype(np.float32)


class RunningTopK:
    """Best k points per query row over all blocks seen so far.

    ``floor`` gives each query a score that k points elsewhere are known to reach;
    points below it are not taken."""

    def __init__(self, matrix: np.ndarray, k: int, floor: np.ndarray | None = None) -> None:
        self.k = k
        self.matrix = matrix
        self.norm = norms_of(matrix)
        self.unit = (matrix / self.norm[:, None]).astype(np.float32)
        # rounding error of a single precision dot product of unit vectors
        self.slack = (matrix.shape[1] + 4) * 2.0**-23
        self.floor = np.full(len(matrix), -np.inf) if floor is None else floor
        self.worst = self.floor.copy()
        self.row = np.empty(0, dtype=np.int64)
        self.score = np.empty(0, dtype=np.float64)
        self.point: np.ndarray | None = None

    def update(self, block: PointBlock) -> None:
        tops = []
        for q0 in range(0, len(self.matrix), QUERY_TILE):
            tops.append(self._update_rows(q0, min(q0 + QUERY_TILE, len(self.matrix)), block))
        if tops:
            self.row = np.concatenate([t[0] for t in tops])
            self.score = np.concatenate([t[1] for t in tops])
            self.point = np.concatenate([t[2] for t in tops])

    def _update_rows(self, q0: int, q1: int, block: PointBlock):
        lo, hi = np.searchsorted(self.row, [q0, q1])
        row, score = self.row[lo:hi], self.score[lo:hi]
        point = block.ids[:0] if self.point is None else self.point[lo:hi]
        for c0 in range(0, len(block.ids), POINT_TILE):
            c1 = min(c0 + POINT_TILE, len(block.ids))
            screened = self.unit[q0:q1] @ block.unit[c0:c1].T
            bound = self.worst[q0:q1] - self.slack
            unfilled = np.isneginf(bound)
            if unfilled.any() and c1 - c0 > self.k:
                place = c1 - c0 - self.k
                bound[unfilled] = np.partition(screened[unfilled], place, axis=1)[:, place] - 2 * self.slack
            hit_row, hit_point = np.nonzero(screened >= bound[:, None])
            if len(hit_row) == 0:
                continue
            hit_row += q0
            hit_point += c0
            exact = self._exact(hit_row, hit_point, block)
            reaches = exact >= self.floor[hit_row]
            if not reaches.all():
                hit_row, hit_point, exact = hit_row[reaches], hit_point[reaches], exact[reaches]
            row = np.concatenate([row, hit_row])
            score = np.concatenate([score, exact])
            point = np.concatenate([point, block.ids[hit_point]])
            order = np.lexsort((point, -score, row))
            row, score, point = row[order], score[order], point[order]
            start = np.searchsorted(row, row)
            best = np.arange(len(row)) - start < self.k
            row, score, point = row[best], score[best], point[best]
            last = np.nonzero(np.arange(len(row)) - np.searchsorted(row, row) == self.k - 1)[0]
            self.worst[row[last]] = score[last]
        return row, score, point

    def _exact(self, rows: np.ndarray, points: np.ndarray, block: PointBlock) -> np.ndarray:
        out = np.empty(len(rows), dtype=np.float64)
        for s in range(0, len(rows), RERANK_PAIRS):
            r, p = rows[s : s + RERANK_PAIRS], points[s : s + RERANK_PAIRS]
            dots = np.einsum("ij,ij->i", self.matrix[r].astype(np.float64), block.matrix[p].astype(np.float64))
            out[s : s + RERANK_PAIRS] = dots / (self.norm[r] * block.norm[p])
        return out
