"""Sums of vectors per key: one partial sum per key and task, merged in a tree.

Vectors reach Python in Arrow batches and are added as matrices, so a group of
any size costs one row per task, never a row per vector and position. Partial
sums are rows (key, part, n, total); ``part`` is the task that made them, and a
merge deals a hot key's partial sums to several tasks before the last one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of sums that a task holds at most; beyond it they are put out and begun anew.
HELD_BYTES = 64 << 20
#: Tasks that share the partial sums of one key before the last merge.
MERGE_WIDTH = 64


def partial_schema(key_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("key", key_type),
            T.StructField("part", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("total", T.ArrayType(T.DoubleType())),
        ]
    )


def as_matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column without nulls as a double matrix; rows of different sizes are an error."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes != sizes[0]).any():
        raise ValueError("vectors of different sizes")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), int(sizes[0]))


def as_list_column(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * np.int32(matrix.shape[1])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix, dtype=np.float64).ravel()))


def _same(a: object, b: object) -> bool:
    return a == b or (a != a and b != b)  # NaN is one key


def _partials(keys: list, parts: list[int], n: list[int], totals: list[np.ndarray], key_type: pa.DataType) -> pa.RecordBatch:
    columns = [pa.array(keys, key_type), pa.array(parts, pa.int64()), pa.array(n, pa.int64()), as_list_column(np.array(totals))]
    return pa.RecordBatch.from_arrays(columns, ["key", "part", "n", "total"])


def partial_sums(df: DataFrame, key: str, vector: str) -> DataFrame:
    """One row per key and task: how many vectors, and their sum. Rows without a vector are left out."""
    rows = df.filter(F.col(vector).isNotNull()).select(F.col(key).alias("key"), F.col(vector).alias("v"))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        place: dict[object, int] = {}
        n = np.zeros(0, np.int64)
        totals = np.zeros((0, 0))
        key_type = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key_type = batch.column(0).type
            matrix = as_matrix(batch.column(1))
            if totals.size and totals.shape[1] != matrix.shape[1]:
                raise ValueError("vectors of different sizes")
            coded = batch.column(0).dictionary_encode(null_encoding="encode")
            codes = coded.indices.to_numpy()
            order = np.argsort(codes, kind="stable")
            starts = np.nonzero(np.diff(codes[order], prepend=-1))[0]
            sums = np.add.reduceat(matrix[order], starts, axis=0)
            counts = np.diff(starts, append=len(order))
            here = [place.setdefault("NaN" if k != k else (k,), len(place)) for k in coded.dictionary.to_pylist()]
            if len(place) > len(n):
                grown = len(place) - len(n)
                n = np.concatenate([n, np.zeros(grown, np.int64)])
                old = totals if totals.size else np.zeros((0, matrix.shape[1]))
                totals = np.concatenate([old, np.zeros((grown, matrix.shape[1]))])
            at = np.array(here)[codes[order][starts]]
            n[at] += counts
            totals[at] += sums
            if totals.nbytes > HELD_BYTES:
                yield put_out(place, part, n, totals, key_type)
                place, n, totals = {}, np.zeros(0, np.int64), np.zeros((0, 0))
        if place:
            yield put_out(place, part, n, totals, key_type)

    def put_out(place: dict, part: int, n: np.ndarray, totals: np.ndarray, key_type: pa.DataType) -> pa.RecordBatch:
        keys = [float("nan") if k == "NaN" else k[0] for k in place]
        return _partials(keys, [part] * len(keys), n.tolist(), list(totals), key_type)

    return rows.mapInArrow(added, partial_schema(rows.schema["key"].dataType))


def merge_sums(partials: DataFrame, width: int = 1) -> DataFrame:
    """Partial sums added up: one row per key and ``part`` modulo ``width``."""
    dealt = partials.withColumn("part", F.pmod("part", F.lit(width)).cast("bigint"))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[object, int, int, np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, parts, n = (batch.column(i).to_pylist() for i in range(3))
            matrix = as_matrix(batch.column(3))
            first = [0, *(i for i in range(1, len(keys)) if parts[i] != parts[i - 1] or not _same(keys[i], keys[i - 1])), len(keys)]
            runs = [(keys[a], parts[a], sum(n[a:b]), matrix[a:b].sum(axis=0)) for a, b in zip(first, first[1:])]
            if held is not None:
                if held[1] == runs[0][1] and _same(held[0], runs[0][0]):
                    runs[0] = (*held[:2], held[2] + runs[0][2], held[3] + runs[0][3])
                else:
                    runs.insert(0, held)
            held = runs.pop()
            if runs:
                yield _partials(*map(list, zip(*runs)), batch.column(0).type)
            key_type = batch.column(0).type
        if held is not None:
            yield _partials(*([x] for x in held), key_type)

    return dealt.repartition("key", "part").sortWithinPartitions("key", "part").mapInArrow(added, partials.schema)


def vector_sums(df: DataFrame, key: str, vector: str) -> DataFrame:
    """key, n, total of every key, merged in two levels."""
    return merge_sums(merge_sums(partial_sums(df, key, vector), MERGE_WIDTH)).select("key", "n", "total")
