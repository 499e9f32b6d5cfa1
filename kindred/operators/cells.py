"""Top-k search over a partitioned vector space (inverted-file index).

Points are assigned to the nearest of a bounded number of centroids; a query
is scored only against the points of the cells it probes.

``topk_probed``  the ``nprobe`` nearest cells: approximate, the fast path for
                 very large point tables.
``topk_cells``   exact: a second round visits every further cell that could
                 still hold a better point, by the triangle inequality on
                 angles, so nothing is lost to the cell borders.

Cells may be very uneven: ``topk_in_cells`` cuts large ones by a hash of the
ids, so the largest group never depends on the largest cell.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions.vectors import l2_normalize
from kindred.operators.kernel import matrix_of, norms_of
from kindred.operators.topk import (
    FLOAT_BYTES,
    PART_BYTES,
    best_per_query,
    point_side,
    query_side,
    topk_in_cells,
)
from kindred.session import materialize

CENTROID_BYTES = 64 << 20
ANGLE_SLACK = 1e-5


@dataclass(frozen=True)
class CellIndex:
    """Centroids (unit length) and the table of points with their cell."""

    centroids: np.ndarray
    points: DataFrame
    sizes: DataFrame
    dim: int

    def save(self, path: str) -> None:
        """Points laid out by cell, cell sizes and centroids as tables below ``path``."""
        spark = self.points.sparkSession
        self.points.repartition("cell").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/points")
        self.sizes.write.mode("overwrite").parquet(f"{path}/sizes")
        # bounded: CENTROID_BYTES
        rows = [(i, [float(x) for x in c]) for i, c in enumerate(self.centroids)]
        spark.createDataFrame(rows, "cell int, center array<float>").coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CellIndex:
        rows = spark.read.parquet(f"{path}/centroids").orderBy("cell").collect()
        centroids = np.array([r["center"] for r in rows], dtype=np.float32)
        points = spark.read.parquet(f"{path}/points").select("point_id", "p_vec", "cell")
        return cls(centroids, points, spark.read.parquet(f"{path}/sizes"), centroids.shape[1])

    def extended(self, points: DataFrame, *, point_id: str = "point_id", vector: str = "vector") -> CellIndex:
        """The index with further points, assigned to the centroids it has."""
        more = build_cells(points, self.centroids, self.dim, point_id=point_id, vector=vector)
        both = self.sizes.unionByName(more.sizes).groupBy("cell")
        sizes = both.agg(F.sum("n_points").alias("n_points"), F.max("radius").alias("radius"))
        return CellIndex(self.centroids, self.points.unionByName(more.points), materialize(sizes, "cell-sizes"), self.dim)


def train_centroids(
    points: DataFrame, n_cells: int, dim: int, *, vector: str = "vector", seed: int = 42, training_rows: int | None = None
) -> np.ndarray:
    """K-means centroids on unit vectors, fitted on all usable points, or on about
    ``training_rows`` of them taken by a hash of the vector (so the choice does not
    depend on how the table is stored). All points are assigned afterwards."""
    if n_cells * dim * FLOAT_BYTES > CENTROID_BYTES:
        raise ValueError(f"{n_cells} centroids of {dim} entries exceed the size every task may hold")
    usable = _usable(points.select(F.col(vector).cast("array<float>").alias("q_vec")))
    if training_rows is not None:
        share = min(1.0, training_rows / max(1, usable.count()))
        usable = usable.filter(F.pmod(F.xxhash64("q_vec"), F.lit(1 << 20)) < int(share * (1 << 20)))
    training = usable.select(array_to_vector(l2_normalize(F.col("q_vec"))).alias("features"))
    model = KMeans(k=n_cells, seed=seed, maxIter=10, distanceMeasure="cosine").fit(training)
    centroids = np.asarray(model.clusterCenters(), dtype=np.float64)
    return (centroids / norms_of(centroids)[:, None]).astype(np.float32)


def build_cells(
    points: DataFrame, centroids: np.ndarray, dim: int, *, point_id: str = "point_id", vector: str = "vector"
) -> CellIndex:
    """Assign every point and write the index table, laid out by cell."""
    p = point_side(points, point_id, vector).filter("p_vec is not null")
    shared = p.sparkSession.sparkContext.broadcast(centroids)

    @F.arrow_udf("struct<cell: int, angle: double>")
    def nearest(vectors: Iterator[pa.Array]) -> Iterator[pa.Array]:
        centers = shared.value
        for batch in vectors:
            matrix = matrix_of(batch, dim)
            angles = _angles(np.nan_to_num(matrix), centers)
            # a vector with an entry that is no number belongs to no cell
            cell = np.where(np.isfinite(matrix).all(axis=1), angles.argmin(axis=1), -1)
            yield pa.StructArray.from_arrays(
                [pa.array(cell.astype(np.int32)), pa.array(angles[np.arange(len(cell)), cell])], ["cell", "angle"]
            )

    assigned = p.withColumn("at", nearest("p_vec")).select("point_id", "p_vec", "at.cell", "at.angle")
    table = materialize(assigned.filter(F.col("cell") >= 0), "cells")
    sizes = materialize(
        table.groupBy("cell").agg(F.count(F.lit(1)).alias("n_points"), F.max("angle").alias("radius")), "cell-sizes"
    )
    return CellIndex(centroids, table.drop("angle"), sizes, dim)


def topk_probed(
    queries: DataFrame,
    index: CellIndex,
    k: int,
    nprobe: int,
    *,
    query_id: str = "query_id",
    query_vector: str = "vector",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    q = _usable(query_side(queries, query_id, query_vector))
    return best_per_query(_search(_nearest_cells(q, index, nprobe), index, k, part_bytes), k)


def topk_cells(
    queries: DataFrame,
    index: CellIndex,
    k: int,
    nprobe: int,
    *,
    query_id: str = "query_id",
    query_vector: str = "vector",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    q = _usable(query_side(queries, query_id, query_vector))
    first = materialize(
        best_per_query(_search(_nearest_cells(q, index, nprobe), index, k, part_bytes), k), "first-probe"
    )
    # score a further point has to reach; -1 while fewer than k hits are known
    to_beat = first.groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(-1.0)).alias("to_beat")
    )
    rest = _further_cells(
        q.join(to_beat, "query_id", "left").fillna({"to_beat": -1.0}), index, nprobe
    )
    second = _search(rest, index, k, part_bytes)
    return best_per_query(first.select("query_id", "score", "point_id").unionByName(second), k)


def _usable(q: DataFrame) -> DataFrame:
    """Queries with a vector whose entries are numbers."""
    total = F.aggregate("q_vec", F.lit(0.0), lambda a, x: a + F.abs(x.cast("double")))
    return q.filter(total < float("inf"))


def _angles(matrix: np.ndarray, centers: np.ndarray) -> np.ndarray:
    unit = matrix / norms_of(matrix)[:, None]
    # stored centroids are rounded; angles need them at unit length in full precision
    centers = centers.astype(np.float64)
    return np.arccos(np.clip(unit @ (centers / norms_of(centers)[:, None]).T, -1.0, 1.0))


def _nearest_cells(q: DataFrame, index: CellIndex, nprobe: int) -> DataFrame:
    shared = q.sparkSession.sparkContext.broadcast(index.centroids)
    dim = index.dim

    @F.arrow_udf("array<int>")
    def probed(vectors: Iterator[pa.Array]) -> Iterator[pa.Array]:
        centers = shared.value
        n = min(nprobe, len(centers))
        for batch in vectors:
            chosen = np.argsort(_angles(matrix_of(batch, dim), centers), axis=1, kind="stable")[:, :n]
            yield _list_array(chosen.astype(np.int32))

    return q.withColumn("cell", F.explode(probed("q_vec")))


def _further_cells(q: DataFrame, index: CellIndex, nprobe: int) -> DataFrame:
    """Cells outside the first probe that may hold a point scoring at least
    ``to_beat``: angle to the centroid minus the cell's radius is small enough."""
    radius = np.full(len(index.centroids), -1.0)
    # one row per cell, at most len(centroids) of them
    for row in index.sizes.select("cell", "radius").collect():
        radius[row["cell"]] = row["radius"]
    shared = q.sparkSession.sparkContext.broadcast((index.centroids, radius))
    dim = index.dim

    @F.pandas_udf("array<int>")
    def reachable(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        centers, reach = shared.value
        n = min(nprobe, len(centers))
        for vectors, to_beat in batches:
            angles = _angles(np.stack(vectors.to_numpy()).astype(np.float32).reshape(-1, dim), centers)
            seen = np.argsort(angles, axis=1, kind="stable")[:, :n]
            limit = np.arccos(np.clip(to_beat.to_numpy(), -1.0, 1.0)) + ANGLE_SLACK
            open_cell = (angles - reach[None, :] <= limit[:, None]) & (reach >= 0)[None, :]
            np.put_along_axis(open_cell, seen, False, axis=1)
            yield pd.Series([np.nonzero(row)[0].astype(np.int32) for row in open_cell])

    return q.withColumn("cell", F.explode(reachable("q_vec", "to_beat"))).drop("to_beat")


def _search(probes: DataFrame, index: CellIndex, k: int, part_bytes: int) -> DataFrame:
    """Score probed (query, cell) rows against the points of the cells, with
    cell-wise part counts from the counted sizes of both sides."""
    part_rows = max(1, part_bytes // (FLOAT_BYTES * index.dim))
    probes = materialize(probes, "probes")
    asked = probes.groupBy("cell").agg(F.count(F.lit(1)).alias("n_queries"))
    # at most one row per centroid
    parts = F.broadcast(
        asked.join(index.sizes, "cell").select(
            "cell",
            F.ceil(F.col("n_queries") / part_rows).cast("int").alias("query_parts"),
            F.ceil(F.col("n_points") / part_rows).cast("int").alias("point_parts"),
        )
    )
    return topk_in_cells(
        probes.join(parts, "cell"),
        index.points.join(parts, "cell"),
        k,
        index.dim,
        query_parts=F.col("query_parts"),
        point_parts=F.col("point_parts"),
    )


def _list_array(matrix: np.ndarray) -> pa.ListArray:
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))
