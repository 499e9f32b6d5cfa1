"""Exact top-k cosine similarity join.

One result row per (query, hit): ``query_id, rank, score, point_id``, ordered
by score and then by id, so equal scores have one defined order.

Three ways to run the same join; ``strategy="auto"`` chooses by counted size,
and of two small sides ships the smaller one:

``points``   the point side is small (its bytes are checked): it is shipped to
             every task once, queries stream past it, nothing is shuffled.
``queries``  the query side is small: points stream past the queries where
             they are stored, each task keeps k hits per query, and only those
             are shuffled. Queries are shipped in blocks of bounded size, and the
             points stream past each block.
``grid``     both sides are large: each side is hashed into parts of bounded
             size and every (query part, point part) cell is one task-sized
             group. As a row is copied into every part of the other side, there
             are no more than LEAST_PARTS parts a side that are smaller than
             a task can hold.

Where hits are shuffled, a first pass over a hashed sample of the points gives
each query a floor: the score of the k-th best point of the sample. The pass over
all points sends only hits that reach it, in all some k divided by the sample's
share per query, however many parts or tasks there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.functions import vectors
from kindred.operators.kernel import PointBlock, RunningTopK, ids_of, matrix_of
from kindred.session import materialize

BROADCAST_BYTES = 64 << 20
BLOCK_BYTES = 8 << 20
PART_BYTES = 16 << 20
#: Parts of a side that may be smaller than PART_BYTES, so that small tables are spread over tasks.
LEAST_PARTS = 8
#: Queries of a part that are searched at once.
QUERIES_AT_ONCE = 8_192
#: One point in so many is in the first pass; it is left out where it would hold fewer than this many times k points.
SAMPLE_SHARE = 16
SAMPLE_TIMES_K = 4
#: Room for rounding between the two passes.
FLOOR_ROOM = 1e-12
FLOAT_BYTES = 4


def best_per_query(hits: DataFrame, k: int) -> DataFrame:
    """Final ranking of candidate hits. Spark keeps only k rows per query on
    the map side before the shuffle (window group limit)."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("point_id").asc())
    ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "score", "point_id")


def topk_one(
    points: DataFrame, query_vector: list[float], k: int, *, point_id: str = "point_id", vector: str = "vector"
) -> DataFrame:
    """Top-k for ONE query vector: a projection and a per-task top-k, no shuffle
    of points and no Python."""
    literal = F.array(*[F.lit(float(x)) for x in query_vector])
    scored = points.select(F.col(point_id).alias("point_id"), vectors.cosine(F.col(vector), literal).alias("score"))
    return scored.filter(F.col("score").isNotNull() & ~F.isnan("score")).orderBy(F.col("score").desc(), F.col("point_id").asc()).limit(k)


def topk_join(
    queries: DataFrame,
    points: DataFrame,
    k: int,
    dim: int,
    *,
    query_id: str = "query_id",
    query_vector: str = "vector",
    point_id: str = "point_id",
    vector: str = "vector",
    strategy: str = "auto",
    broadcast_bytes: int = BROADCAST_BYTES,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """The k most similar points of every query. ``query_id`` and ``point_id``
    are unique keys of their tables. Vectors that are null or hold an entry that is
    no number are aside: such a query has no hits, such a point is no hit. A
    vector of another size than ``dim`` is an error."""
    q = query_side(queries, query_id, query_vector).filter("q_vec is not null")
    p = point_side(points, point_id, vector).filter("p_vec is not null")
    row_bytes = FLOAT_BYTES * dim
    n_queries = n_points = None
    if strategy == "auto":
        n_points = points.count()
        n_queries = queries.count()
        small, strategy = min((n_points, "points"), (n_queries, "queries"))
        if small * row_bytes > broadcast_bytes:
            strategy = "grid"
    if strategy == "points":
        return _stream_queries(q, _bounded(p, broadcast_bytes // row_bytes), p, k, dim)
    if strategy not in ("queries", "grid"):
        raise ValueError(f"unknown strategy: {strategy}")
    n_points = points.count() if n_points is None else n_points
    part_rows = max(1, part_bytes // row_bytes)
    n_queries = queries.count() if n_queries is None else n_queries
    if strategy == "queries":
        block_rows = max(1, min(BLOCK_BYTES, broadcast_bytes) // row_bytes)
        n_blocks = ceil(n_queries / block_rows)
        most_rows = broadcast_bytes // row_bytes
        if _worth_a_sample(n_points, k):
            hits = best_per_query(_blocks_past_points(q, sampled(p), k, dim, n_blocks, most_rows), k)
            q = materialize(with_floor(q, hits, k), "floors") if n_blocks > 1 else with_floor(q, hits, k)
        return best_per_query(_blocks_past_points(q, p, k, dim, n_blocks, most_rows), k)
    return best_per_query(grid_hits(q, p, k, dim, n_queries, n_points, part_rows), k)


def _blocks_past_points(q: DataFrame, p: DataFrame, k: int, dim: int, n_blocks: int, most_rows: int) -> DataFrame:
    """Candidate hits of the ``queries`` way. Blocks are cut by a hash and a little uneven."""
    hits = []
    for block in range(max(1, n_blocks)):
        own = q if n_blocks <= 1 else q.filter(F.pmod(F.xxhash64("query_id", "q_vec"), F.lit(n_blocks)) == block)
        hits.append(_stream_points(_bounded(own, most_rows), q, p, k, dim))
    return reduce(DataFrame.unionByName, hits)


def grid_hits(q: DataFrame, p: DataFrame, k: int, dim: int, n_queries: int, n_points: int, part_rows: int) -> DataFrame:
    """Candidate hits of the ``grid`` way, in two passes."""
    whole = F.lit(0).alias("cell")

    most_rows = max(part_rows, PART_BYTES // (FLOAT_BYTES * dim))

    def parts(n: float) -> Column:
        return F.lit(max(1, min(ceil(n / part_rows), max(LEAST_PARTS, ceil(n / most_rows)))))

    def hits(asked: DataFrame, among: DataFrame, n_among: float) -> DataFrame:
        return topk_in_cells(
            asked.select("*", whole), among.select("*", whole), k, dim, query_parts=parts(n_queries), point_parts=parts(n_among)
        )

    if n_points > part_rows and _worth_a_sample(n_points, k):
        q = materialize(with_floor(q, best_per_query(hits(q, sampled(p), n_points / SAMPLE_SHARE), k), k), "floors")
    return hits(q, p, n_points)


def _worth_a_sample(n_points: int, k: int) -> bool:
    return n_points >= SAMPLE_SHARE * SAMPLE_TIMES_K * k


def sampled(p: DataFrame) -> DataFrame:
    """The points of the first pass, chosen by their id."""
    return p.filter(F.pmod(F.xxhash64("point_id", F.lit(3)), F.lit(SAMPLE_SHARE)) == 0)


def with_floor(q: DataFrame, sample_hits: DataFrame, k: int) -> DataFrame:
    """Queries with the score that k points of the sample reach; null where the sample has fewer."""
    floors = sample_hits.filter(F.col("rank") == k).select("query_id", (F.col("score") - FLOOR_ROOM).alias("floor"))
    return q.join(floors, "query_id", "left")


def topk_in_cells(
    q: DataFrame, p: DataFrame, k: int, dim: int, *, query_parts: Column, point_parts: Column
) -> DataFrame:
    """Candidate hits of queries and points that share a ``cell``.

    A cell of any size is cut into ``query_parts`` x ``point_parts`` groups by
    a hash of the ids: a query goes to every point part of its cell and a point
    to every query part, so a hot cell spreads over many tasks and no group
    outgrows its part size. The hash depends on the id alone, so a re-run of a
    lost task rebuilds the same groups. Queries may have a ``floor``.
    """
    q = q.select(
        "query_id",
        "q_vec",
        (F.col("floor") if "floor" in q.columns else F.lit(None).cast("double")).alias("floor"),
        "cell",
        F.pmod(F.xxhash64("query_id"), query_parts).cast("int").alias("q_part"),
        F.explode(F.sequence(F.lit(0), (point_parts - 1).cast("int"))).alias("p_part"),
    )
    p = p.select(
        "point_id",
        "p_vec",
        "cell",
        F.explode(F.sequence(F.lit(0), (query_parts - 1).cast("int"))).alias("q_part"),
        F.pmod(F.xxhash64("point_id"), point_parts).cast("int").alias("p_part"),
    )
    schema = _hit_schema(q, p)
    arrow_schema = _arrow_hits(schema)

    def join_group(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            return arrow_schema.empty_table()
        block = PointBlock(ids_of(right["point_id"]), matrix_of(right["p_vec"], dim), k)
        found = []
        for start in range(0, left.num_rows, QUERIES_AT_ONCE):
            some = left.slice(start, QUERIES_AT_ONCE)
            running = RunningTopK(matrix_of(some["q_vec"], dim), k, _floor(some))
            running.update(block)
            if running.point is not None:
                found.append(_hits(running, some["query_id"], arrow_schema))
        return pa.Table.from_batches(found, arrow_schema)

    keys = ("cell", "q_part", "p_part")
    return q.groupBy(*keys).cogroup(p.groupBy(*keys)).applyInArrow(join_group, schema)


def query_side(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.select(_key(df, key).alias("query_id"), F.col(vector).cast("array<float>").alias("q_vec"))


def point_side(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.select(_key(df, key).alias("point_id"), F.col(vector).cast("array<float>").alias("p_vec"))


def _key(df: DataFrame, name: str) -> Column:
    """Whole numbers as bigint, every other key as string."""
    whole = isinstance(df.schema[name].dataType, T.IntegralType)
    return F.col(name).cast("bigint" if whole else "string")


def _bounded(side: DataFrame, max_rows: int) -> pa.Table:
    """The small side as one Arrow table; fails instead of growing past the
    bound it was checked against."""
    table = side.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows:
        raise ValueError(f"more than {max_rows} rows on the side to ship to every task; use strategy='grid'")
    return table


def _stream_queries(q: DataFrame, table: pa.Table, p: DataFrame, k: int, dim: int) -> DataFrame:
    """Queries stream past the shipped points; every query is finished in the
    task that reads it, so its hits are already final and ranked."""
    shared = q.sparkSession.sparkContext.broadcast(table)
    hit_schema = _hit_schema(q, p)
    schema = T.StructType([*hit_schema.fields, T.StructField("rank", T.IntegerType())])
    arrow_schema = _arrow_hits(hit_schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = shared.value
        if points.num_rows == 0:
            return
        block = PointBlock(ids_of(points["point_id"]), matrix_of(points["p_vec"], dim), k)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            running = RunningTopK(matrix_of(batch["q_vec"], dim), k)
            running.update(block)
            rank = np.arange(len(running.row)) - np.searchsorted(running.row, running.row) + 1
            hits = _hits(running, batch["query_id"], arrow_schema)
            yield hits.append_column("rank", pa.array(rank.astype(np.int32)))

    return q.mapInArrow(search, schema).select("query_id", "rank", "score", "point_id")


def _stream_points(table: pa.Table, q: DataFrame, p: DataFrame, k: int, dim: int) -> DataFrame:
    """Points stream past the shipped queries; a task emits its k best hits per
    query at its end."""
    shared = p.sparkSession.sparkContext.broadcast(table)
    schema = _hit_schema(q, p)
    arrow_schema = _arrow_hits(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        if queries.num_rows == 0:
            return
        running = RunningTopK(matrix_of(queries["q_vec"], dim), k, _floor(queries))
        for batch in batches:
            if batch.num_rows:
                running.update(PointBlock(ids_of(batch["point_id"]), matrix_of(batch["p_vec"], dim), k))
        if running.point is not None:
            yield _hits(running, queries["query_id"], arrow_schema)

    return p.mapInArrow(search, schema)


def _floor(queries: pa.Table) -> np.ndarray | None:
    if "floor" not in queries.column_names:
        return None
    floor = queries["floor"].to_numpy().astype(np.float64)
    return np.where(np.isnan(floor), -np.inf, floor)


def _hit_schema(q: DataFrame, p: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", q.schema["query_id"].dataType),
            T.StructField("score", T.DoubleType()),
            T.StructField("point_id", p.schema["point_id"].dataType),
        ]
    )


def _arrow_hits(schema: T.StructType) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64()}
    return pa.schema([(field.name, kinds[field.dataType.simpleString()]) for field in schema])


def _hits(running: RunningTopK, query_ids: pa.Array | pa.ChunkedArray, schema: pa.Schema) -> pa.RecordBatch:
    if isinstance(query_ids, pa.ChunkedArray):
        query_ids = query_ids.combine_chunks()
    columns = [query_ids.take(pa.array(running.row)), pa.array(running.score), pa.array(running.point)]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)
