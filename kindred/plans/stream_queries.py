"""Queries that load a table with a stream and read it back."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindred.operators.fulltext import match
from kindred.operators.link import make_points, search_texts
from kindred.plans.registry import query, table
from kindred.plans.text_queries import _BENCH_POINTS, DIM, LINK_K, MODEL, _match_sql, hash_vectors_sql, topk_sql
from kindred.session import new_work_path
from kindred.sources.tables import read_table
from kindred.streaming import ingest, statistics


def _ingest_vectors(spark: SparkSession, sf_dir: str, *tables: str) -> str:
    """The tables in as many micro-batches, one file each where a table is a file."""
    path = new_work_path(spark, "stream-points")
    n_files = sum(len(table(spark, sf_dir, name).inputFiles()) for name in tables)
    stream = ingest.text_stream(spark, sf_dir, "text", tables=tables, files_per_batch=ceil(n_files / len(tables)))
    ingest.run_ingest(stream, path, ingest.vector_step(path, MODEL, DIM))
    return path


@query("SELECT row_number() OVER (ORDER BY doc_id) - 1 AS point_id, md5(text) AS keyword_md5 FROM documents")
def ingest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _ingest_vectors(spark, sf_dir, "documents")
    points = ingest.current_rows(spark, path, "point_id")
    return points.select("point_id", F.md5(F.element_at("payload", "keyword")).alias("keyword_md5"))


@query(
    """WITH all_texts AS (SELECT text FROM documents UNION ALL SELECT text FROM benchmark UNION ALL SELECT text FROM conversations)
    SELECT count(*) AS n_points, 0 AS first_id, count(*) - 1 AS last_id, count(DISTINCT text) AS n_texts FROM all_texts"""
)
def ingest_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables in three micro-batches: ids go on behind the existing ones."""
    path = _ingest_vectors(spark, sf_dir, "documents", "benchmark", "conversations")
    points = ingest.current_rows(spark, path, "point_id")
    return points.agg(
        F.count(F.lit(1)).alias("n_points"),
        F.min("point_id").alias("first_id"),
        F.max("point_id").alias("last_id"),
        F.countDistinct(F.element_at("payload", "keyword")).alias("n_texts"),
    )


def _places_in_tables(spark: SparkSession, sf_dir: str, *tables: str) -> DataFrame:
    """file, table, table_offset: of each file the name of its table and the rows of the table's files before it."""
    counted = [
        table(spark, sf_dir, name)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("table", F.lit(f"{name}.parquet"))
        for name in tables
    ]
    before = Window.partitionBy("table").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("n").over(before), F.lit(0))
    return reduce(DataFrame.unionByName, counted).select("file", "table", offset.alias("table_offset"))


@query(
    """SELECT 'documents.parquet:' || (row_number() OVER (ORDER BY doc_id) - 1) AS _id, md5(text) AS source_md5 FROM documents
    UNION ALL SELECT 'benchmark.parquet:' || (row_number() OVER (ORDER BY item_id) - 1), md5(text) FROM benchmark"""
)
def ingest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with given ids; the last batch is replayed, which changes nothing."""
    path = new_work_path(spark, "stream-docs")
    tables = ("documents", "benchmark")
    # one row per file
    places = F.broadcast(_places_in_tables(spark, sf_dir, *tables))
    row_id = F.concat_ws(":", "table", (F.col("table_offset") + F.col("row_in_file")).cast("string"))
    step = ingest.document_step(doc_id=row_id, source_key="source")
    n_files = sum(len(table(spark, sf_dir, name).inputFiles()) for name in tables)
    stream = ingest.text_stream(spark, sf_dir, "text", tables=tables, files_per_batch=ceil(n_files / 2))
    ingest.run_ingest(stream.join(places, "file"), path, step)
    replayed = new_work_path(spark, "replayed")
    read_table(spark, path).filter(F.col("batch_id") == 1).drop("batch_id").write.parquet(replayed)
    ingest.write_batch(spark.read.parquet(replayed), path, 1)
    docs = ingest.current_rows(spark, path, "_id", within="pos")
    return docs.select("_id", F.md5("source").alias("source_md5"))


_NAMES = hash_vectors_sql("asked", "(SELECT DISTINCT p_name FROM part)", "p_name", "'検索クエリ: ' || p_name")


@query(
    f"""WITH {_BENCH_POINTS}, {_NAMES}
    SELECT query_id AS product_name, string_agg(point_id, ',' ORDER BY rn) AS ids FROM ({topk_sql('asked', 'docs', LINK_K)})
    GROUP BY query_id"""
)
def ingest_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products arrive as a stream and are linked against stored points."""
    path = new_work_path(spark, "stream-links")
    points = make_points(table(spark, sf_dir, "benchmark"), MODEL, DIM, row_id="item_id")
    stream = ingest.text_stream(spark, sf_dir, "p_name", tables=("part",))
    ingest.run_ingest(stream, path, ingest.link_step(points, MODEL, DIM, top_k=LINK_K))
    docs = ingest.current_rows(spark, path, "product_name")
    ids = F.transform("keywords", lambda h: h["keyword_id"].cast("string"))
    return docs.select("product_name", F.array_join(ids, ",").alias("ids"))


_SAMPLE_QUERIES = hash_vectors_sql("asked", "region", "r_regionkey", "r_name")
_DOC_POINTS = hash_vectors_sql("docs", "documents", "doc_id", "text")


@query(
    f"""WITH {_DOC_POINTS}, {_SAMPLE_QUERIES} SELECT r_name AS query, CAST(rn AS INTEGER) AS rank, point_id,
      round(s, 6) AS score, (SELECT count(*) FROM documents) AS n_points
    FROM ({topk_sql('asked', 'docs', 5)}) JOIN region ON r_regionkey = query_id"""
)
def ingest_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a load: how many points there are, and sample searches on them."""
    points = ingest.current_rows(spark, _ingest_vectors(spark, sf_dir, "documents"), "point_id")
    asked = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("query_id"), F.col("r_name").alias("query"))
    hits = search_texts(asked, points, MODEL, DIM, top_k=5)
    return hits.select("query", "rank", "point_id", F.round("score", 6).alias("score")).withColumn(
        "n_points", F.lit(points.count())
    )


@query("SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS VARCHAR) AS _id, md5(text) AS source_md5 FROM documents")
def ingest_default_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without given ids: their numbers, as strings."""
    path = new_work_path(spark, "stream-numbered")
    step = ingest.document_step(path, source_key="source")
    ingest.run_ingest(ingest.text_stream(spark, sf_dir, "text", tables=("documents",)), path, step)
    return ingest.current_rows(spark, path, "_id", within="pos").select("_id", F.md5("source").alias("source_md5"))


_STORED = "(SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, text FROM documents)"


@query(
    f"""WITH hits AS ({_match_sql(_STORED, 'pos', 'text', 'benchmark', 'item_id', 'text', 3)}),
    t AS (SELECT len(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS dl FROM documents)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, score, CAST(doc_id AS VARCHAR) AS _id, (SELECT count(*) FROM documents) AS n_stored,
      (SELECT count(*) FROM t WHERE dl > 0) AS n_docs, (SELECT CAST(sum(dl) AS BIGINT) FROM t) AS n_tokens FROM hits"""
)
def ingest_verified_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a load of documents: how many there are, the corpus numbers that the
    batches have left, and three matches for each sample query."""
    path = new_work_path(spark, "stream-verified")
    step = statistics.with_statistics(ingest.document_step(path, source_key="source"), "source")
    ingest.run_ingest(ingest.text_stream(spark, sf_dir, "text", tables=("documents",)), path, step)
    docs = ingest.current_rows(spark, path, "_id", within="pos")
    _, totals = statistics.corpus_numbers(spark, path, "_id", "source", within="pos")
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    # equal scores are ordered by position
    hits = match(docs, asked, doc_id="pos", text="source", size=3)
    counted = totals.select(F.lit(docs.count()).alias("n_stored"), "n_docs", "n_tokens")
    named = hits.withColumn("_id", F.col("doc_id").cast("string")).drop("doc_id")
    return named.crossJoin(F.broadcast(counted)).select("query_id", "rank", F.round("score", 6).alias("score"), "_id", "n_stored", "n_docs", "n_tokens")
