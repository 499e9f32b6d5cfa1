"""Queries on vectors and similarity search."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred import config
from kindred.functions import vectors
from kindred.operators.cells import CellIndex, build_cells, topk_cells, topk_probed, train_centroids
from kindred.operators.centroids import group_means
from kindred.operators.points import assemble_points
from kindred.operators.topk import topk_join, topk_one
from kindred.plans.registry import query, table
from kindred.session import new_work_path
from kindred.sources.results import read_result_lines, result_lines, top_hit, write_json_lines

DIM = 64
K = config.BATCH_SEARCH_TOP_K
VEC = {"query_id": "vec_id", "query_vector": "embedding", "point_id": "vec_id", "vector": "embedding"}
ASK = {"query_id": "vec_id", "query_vector": "embedding"}
POINT = {"point_id": "vec_id", "vector": "embedding"}

_NORM = "sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x)))"
_ALL_PAIRS = """SELECT q.vec_id AS query_id, p.vec_id AS point_id,
  list_cosine_similarity(q.embedding::DOUBLE[], p.embedding::DOUBLE[]) AS s FROM embeddings q, embeddings p"""
_RANKED = f"""SELECT query_id, point_id, s, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, point_id) AS rn
  FROM ({_ALL_PAIRS})"""
TOPK_SQL = f"""SELECT query_id, CAST(rn AS INTEGER) AS rank, round(s, 6) AS score, point_id FROM ({_RANKED})
  WHERE rn <= {K}"""


_MEANS = f"""means AS (SELECT label, i, avg(embedding[i]::DOUBLE) AS m, count(*) AS n
    FROM (SELECT label, embedding, unnest(range(1, {DIM + 1})) AS i FROM embeddings) GROUP BY label, i),
  scale AS (SELECT label, sqrt(sum(m * m)) AS norm FROM means GROUP BY label)"""
# The cells of given centroids (the mean vector of each label) and the search of the nearest ones, stated in SQL.
PROBES = 4
_PROBED = f"""WITH {_MEANS}, c AS (SELECT label, list((m / norm)::FLOAT ORDER BY i) AS v FROM means JOIN scale USING (label) GROUP BY label),
  located AS (SELECT vec_id, c.label AS cell, row_number() OVER (PARTITION BY vec_id
      ORDER BY list_cosine_similarity(embedding::DOUBLE[], v::DOUBLE[]) DESC, c.label) AS place FROM embeddings, c),
  found AS (SELECT q.vec_id AS query_id, p.vec_id AS point_id FROM located q JOIN located p ON q.cell = p.cell AND q.place <= {PROBES} AND p.place = 1),
  best AS (SELECT query_id, point_id, s, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, point_id) AS rn
    FROM found JOIN ({_ALL_PAIRS}) USING (query_id, point_id))"""


def _rounded(hits: DataFrame) -> DataFrame:
    return hits.withColumn("score", F.round("score", 6))


@query(TOPK_SQL)
def topk_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return _rounded(topk_join(e, e, K, DIM, **VEC))


@query(TOPK_SQL)
def topk_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides cut into parts of bounded size (small ones here, so that
    there are many cells)."""
    e = table(spark, sf_dir, "embeddings")
    return _rounded(topk_join(e, e, K, DIM, strategy="grid", part_bytes=64 << 10, **VEC))


@query(TOPK_SQL)
def topk_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points stream past the shipped queries."""
    e = table(spark, sf_dir, "embeddings")
    return _rounded(topk_join(e, e, K, DIM, strategy="queries", **VEC))


def _index(e: DataFrame):
    return build_cells(e, train_centroids(e, 16, DIM, vector="embedding"), DIM, **POINT)


@query(TOPK_SQL)
def topk_by_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact search over the cell index: first probe, then all cells that the
    angle bound leaves open."""
    e = table(spark, sf_dir, "embeddings")
    return _rounded(topk_cells(e, _index(e), K, 4, **ASK))


def _label_index(e: DataFrame):
    """Cells around given centroids: one row per label is collected."""
    means = group_means(e, "label", "embedding").orderBy("label").select("centroid").collect()
    return build_cells(e, np.array([row["centroid"] for row in means], dtype=np.float32), DIM, **POINT)


@query(f"{_PROBED} SELECT query_id, CAST(rn AS INTEGER) AS rank, round(s, 6) AS score, point_id FROM best WHERE rn <= {K}")
def topk_approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search of the four nearest cells only, through an index that is stored and read back."""
    e = table(spark, sf_dir, "embeddings")
    path = new_work_path(spark, "cell-index")
    _label_index(e).save(path)
    return _rounded(topk_probed(e, CellIndex.load(spark, path), K, PROBES, **ASK))


@query(
    f"""{_PROBED}, exact AS (SELECT query_id, point_id FROM ({_RANKED}) WHERE rn <= {K})
    SELECT count(*) AS n_exact, count(b.rn) AS n_found, avg(CASE WHEN b.rn IS NULL THEN 0.0 ELSE 1.0 END) AS recall
    FROM exact x LEFT JOIN (SELECT * FROM best WHERE rn <= {K}) b ON x.query_id = b.query_id AND x.point_id = b.point_id"""
)
def probe_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of the exact top-k that probing four cells finds."""
    e = table(spark, sf_dir, "embeddings")
    exact = topk_join(e, e, K, DIM, **VEC).select("query_id", "point_id")
    found = topk_probed(e, _label_index(e), K, PROBES, **ASK).select("query_id", "point_id", F.lit(1).alias("hit"))
    return exact.join(found, ["query_id", "point_id"], "left").agg(
        F.count(F.lit(1)).alias("n_exact"), F.count("hit").alias("n_found"), F.avg(F.coalesce("hit", F.lit(0))).alias("recall")
    )


@query(f"SELECT point_id, round(s, 6) AS score FROM ({_ALL_PAIRS}) WHERE query_id = 0 ORDER BY s DESC, point_id LIMIT {K}")
def topk_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    asked = e.filter(F.col("vec_id") == 0).select("embedding").first()["embedding"]
    return _rounded(topk_one(e, asked, K, **POINT))


@query(
    f"""SELECT query_id, count(*) AS n_results, string_agg(point_id, ',' ORDER BY rn) AS points,
      max(CASE WHEN rn = 1 THEN round(s, 6) END) AS best FROM ({_RANKED}) WHERE rn <= {K} GROUP BY query_id"""
)
def topk_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    nested = _result_lines(topk_join(e, e, K, DIM, **VEC))
    return nested.select(
        "query_id",
        F.size("results").cast("bigint").alias("n_results"),
        F.array_join(F.transform("results", lambda r: r["point_id"].cast("string")), ",").alias("points"),
        top_hit(F.col("results"), "score").alias("best"),
    )


def _result_lines(hits: DataFrame) -> DataFrame:
    named = hits.select(
        "query_id",
        F.concat(F.lit("vector "), "query_id").alias("query"),
        "rank",
        "score",
        F.concat(F.lit("vector "), "point_id").alias("keyword"),
        "point_id",
        F.create_map(F.lit("keyword"), F.concat(F.lit("vector "), "point_id")).alias("payload"),
    )
    return result_lines(named)


@query(
    f"""SELECT 'vector ' || query_id AS query, round(s, 6) AS score, 'vector ' || point_id AS keyword
    FROM ({_RANKED}) WHERE rn = 1"""
)
def result_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results written as JSON lines and read back: best hit of every query."""
    e = table(spark, sf_dir, "embeddings")
    lines = _result_lines(topk_join(e, e, K, DIM, **VEC)).select("query", "results")
    path = new_work_path(spark, "results")
    write_json_lines(lines, path)
    back = read_result_lines(spark, path, lines)
    return back.select(
        "query",
        top_hit(F.col("results"), "score").alias("score"),
        top_hit(F.col("results"), "keyword").alias("keyword"),
    )


@query(
    """SELECT 'v-' || vec_id AS point_id, CAST(label AS VARCHAR) AS label, len(embedding) AS dim FROM embeddings"""
)
def assembled_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors, custom ids and custom payloads from separate frames, paired by position."""
    e = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "pos")
    points = assemble_points(
        e.select("pos", F.col("embedding").alias("vector")),
        ids=e.select("pos", F.concat(F.lit("v-"), "pos").alias("point_id")),
        payloads=e.select("pos", F.create_map(F.lit("label"), F.col("label").cast("string")).alias("payload")),
    )
    return points.select("point_id", F.element_at("payload", "label").alias("label"), F.size("vector").cast("bigint").alias("dim"))


@query(f"SELECT vec_id, round({_NORM}, 6) AS norm FROM embeddings")
def vector_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(vectors.l2_norm(F.col("embedding")), 6).alias("norm"))


@query(
    f"""SELECT vec_id, i - 1 AS i, round(embedding[i]::DOUBLE * 3 / ({_NORM} * 3), 6) AS x
    FROM (SELECT vec_id, embedding, unnest(range(1, {DIM + 1})) AS i FROM embeddings)"""
)
def vector_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = F.transform("embedding", lambda x: x.cast("double") * 3)
    unit = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(vectors.l2_normalize(scaled)).alias("i", "x"))
    return unit.select("vec_id", F.col("i").cast("bigint").alias("i"), F.round("x", 6).alias("x"))


@query(
    f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE embedding IS NULL) AS n_null,
      count(*) FILTER (WHERE len(embedding) <> {DIM}) AS n_wrong_dim,
      count(*) FILTER (WHERE list_bool_or(list_transform(embedding, lambda x: isnan(x) OR isinf(x)))) AS n_not_finite,
      count(*) FILTER (WHERE {_NORM} = 0) AS n_zero,
      count(*) FILTER (WHERE abs({_NORM} - 1) > 1e-4) AS n_not_unit FROM embeddings"""
)
def vector_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.vector_report(table(spark, sf_dir, "embeddings"), "embedding", DIM)


@query(
    """SELECT a.vec_id, b.vec_id AS next_id,
      round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine,
      round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS dot
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"""
)
def pair_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    after = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("vec_id").alias("next_id"), F.col("embedding").alias("other"))
    a, b = F.col("embedding"), F.col("other")
    return e.join(after, "vec_id").select(
        "vec_id", "next_id", F.round(vectors.cosine(a, b), 6).alias("cosine"), F.round(vectors.dot(a, b), 6).alias("dot")
    )


@query(
    f"""WITH {_MEANS} SELECT label, i - 1 AS i, n, round(m / norm, 6) AS x FROM means JOIN scale USING (label)"""
)
def centroid_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = group_means(table(spark, sf_dir, "embeddings"), "label", "embedding")
    flat = means.select("label", "n", F.posexplode("centroid").alias("i", "x"))
    return flat.select("label", F.col("i").cast("bigint").alias("i"), "n", F.round("x", 6).alias("x"))


@query(
    f"""WITH {_MEANS}, c AS (SELECT label, list((m / norm)::FLOAT ORDER BY i) AS v FROM means JOIN scale USING (label) GROUP BY label),
    scored AS (SELECT vec_id, c.label AS nearest, list_cosine_similarity(embedding::DOUBLE[], v::DOUBLE[]) AS s
      FROM embeddings, c)
    SELECT vec_id, CAST(nearest AS BIGINT) AS nearest, round(s, 6) AS score FROM (
      SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, nearest) AS rn FROM scored) WHERE rn = 1"""
)
def nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    centers = group_means(e, "label", "embedding")
    hits = topk_join(e, centers, 1, DIM, **ASK, point_id="label", vector="centroid")
    return hits.select(F.col("query_id").alias("vec_id"), F.col("point_id").alias("nearest"), F.round("score", 6).alias("score"))
