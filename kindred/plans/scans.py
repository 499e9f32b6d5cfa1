"""Queries on sources, row numbers, batches and text expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred import config
from kindred.functions.text import as_text, payload_of, payload_value, tokens, truncate_tokens, with_prefix
from kindred.operators.rowerrors import conform_rows
from kindred.plans.registry import query, spread_table, table
from kindred.session import new_work_path
from kindred.sources.mapping import conform, default_mapping, schema_of
from kindred.sources.results import write_text_lines
from kindred.sources.text import load_texts, read_line_texts, read_parquet_texts

SCAN_LIMIT = 500
CHUNK_ROWS = 300


@query("SELECT doc_id AS pos, md5(text) AS text_md5, length(text) AS n_chars FROM documents")
def scan_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts, _ = load_texts(spark, parquet=f"{sf_dir}/documents.parquet", text_column="text")
    return texts.select("pos", F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("n_chars"))


@query(
    f"""SELECT pos, text_md5 FROM (
      SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, md5(text) AS text_md5 FROM documents)
    WHERE pos < {SCAN_LIMIT}"""
)
def scan_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = read_parquet_texts(spark, f"{sf_dir}/documents.parquet", "text", limit=SCAN_LIMIT)
    return texts.select("pos", F.md5("text").alias("text_md5"))


@query(
    """SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), 'None') AS quality_text
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
)
def null_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return joined.select("doc_id", as_text(F.col("quality"), "None").alias("quality_text"))


@query(
    f"""SELECT pos, pos // {CHUNK_ROWS} AS chunk_id, pos AS row_id FROM (
      SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents)"""
)
def chunk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = read_parquet_texts(spark, f"{sf_dir}/documents.parquet", "text", chunk_rows=CHUNK_ROWS)
    return texts.select("pos", "chunk_id", "row_id")


@query(
    f"""SELECT pos // {CHUNK_ROWS} AS chunk_id, count(*) AS n_rows, min(pos) AS first_pos, CAST(sum(length(text)) AS BIGINT) AS n_chars
    FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, text FROM documents) GROUP BY 1"""
)
def chunk_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = read_parquet_texts(spark, f"{sf_dir}/documents.parquet", "text", chunk_rows=CHUNK_ROWS)
    return texts.groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("pos").alias("first_pos"), F.sum(F.length("text")).alias("n_chars")
    )


@query(
    f"""SELECT (pos // {config.EMBED_BATCH_ROWS}) * {config.EMBED_BATCH_ROWS} AS batch_start, count(*) AS n_rows
    FROM (SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS pos FROM part) GROUP BY 1"""
)
def batch_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = read_parquet_texts(spark, f"{sf_dir}/part.parquet", "p_name")
    start = (F.floor(F.col("pos") / config.EMBED_BATCH_ROWS) * config.EMBED_BATCH_ROWS).alias("batch_start")
    return texts.groupBy(start).agg(F.count(F.lit(1)).alias("n_rows"))


_COUNTED = ("documents", "benchmark", "conversations", "part", "embeddings")


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS source, count(*) AS n_rows, CAST(ceil(count(*) / {CHUNK_ROWS}.0) AS BIGINT) AS n_chunks FROM {t}"
        for t in _COUNTED
    )
)
def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and expected chunks per source, from row counts only."""
    counts = [table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("source", F.lit(t)) for t in _COUNTED]
    all_counts = counts[0]
    for more in counts[1:]:
        all_counts = all_counts.unionByName(more)
    return all_counts.select("source", "n_rows", F.ceil(F.col("n_rows") / CHUNK_ROWS).alias("n_chunks"))


@query(
    """SELECT doc_id, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars FROM (
      SELECT doc_id, unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS line FROM documents)
    WHERE line <> '' GROUP BY doc_id"""
)
def non_blank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.filter(F.split("text", r"\r\n|\r|\n"), lambda line: line != "")
    counted = spread_table(spark, sf_dir, "documents", "doc_id").select("doc_id", lines.alias("lines"))
    return counted.filter(F.size("lines") > 0).select(
        "doc_id",
        F.size("lines").cast("bigint").alias("n_lines"),
        F.aggregate("lines", F.lit(0).cast("bigint"), lambda n, line: n + F.length(line)).alias("n_chars"),
    )


@query("SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS pos, p_name AS text FROM part")
def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names written as text lines and read back with their line numbers."""
    path = new_work_path(spark, "lines")
    write_text_lines(table(spark, sf_dir, "part").orderBy("p_partkey"), "p_name", path)
    return read_line_texts(spark, path).select("pos", "text")


@query(
    """SELECT 'documents' AS source, doc_id AS id, md5(text) AS text_md5 FROM documents
    UNION ALL SELECT 'benchmark', item_id, md5(text) FROM benchmark
    UNION ALL SELECT 'conversations', conv_id * 1000 + turn, md5(text) FROM conversations"""
)
def union_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    def part(name: str, key: Column) -> DataFrame:
        return table(spark, sf_dir, name).select(
            F.lit(name).alias("source"), key.alias("id"), F.md5("text").alias("text_md5")
        )

    return (
        part("documents", F.col("doc_id"))
        .unionByName(part("benchmark", F.col("item_id")))
        .unionByName(part("conversations", F.col("conv_id") * 1000 + F.col("turn")))
    )


@query(
    f"""SELECT p_partkey, '{config.QUERY_PREFIX}' || p_name AS as_query, '{config.DOCUMENT_PREFIX}' || p_name AS as_document,
      p_name AS as_encoded, '' || p_name AS overridden FROM part"""
)
def prefix_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_name")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        with_prefix(name, mode="query").alias("as_query"),
        with_prefix(name, mode="document").alias("as_document"),
        with_prefix(name, mode="encode").alias("as_encoded"),
        with_prefix(name, "").alias("overridden"),
    )


@query(
    """SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS present, '' AS missing, event_type AS keyword
    FROM events"""
)
def payload_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = F.from_json("props", "map<string,string>")
    named = payload_of("keyword", F.col("event_type"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        payload_value(payload, "k").alias("present"),
        payload_value(payload, "no such key").alias("missing"),
        payload_value(named, "keyword").alias("keyword"),
    )


@query(
    f"""SELECT doc_id, len(t) AS n_tokens, least(len(t), {config.CLIENT_MAX_TOKENS}) AS client_tokens,
      t[least(len(t), {config.SERVER_MAX_TOKENS})] AS last_server_token
    FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS t FROM documents)"""
)
def token_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the token limits of the model leave of each whole text."""
    split = spread_table(spark, sf_dir, "documents", "doc_id").select("doc_id", tokens(F.col("text")).alias("t"))
    return split.select(
        "doc_id",
        F.size("t").cast("bigint").alias("n_tokens"),
        F.size(truncate_tokens(F.col("t"), config.CLIENT_MAX_TOKENS)).cast("bigint").alias("client_tokens"),
        F.try_element_at(truncate_tokens(F.col("t"), config.SERVER_MAX_TOKENS), F.lit(-1)).alias("last_server_token"),
    )


@query("SELECT p_name AS keyword, p_partkey, p_size FROM part")
def mapping_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows brought to the default mapping; undeclared fields stay."""
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("keyword"), "p_size")
    return conform(parts, schema_of(default_mapping("keyword")))


@query(
    """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE n_chars END AS n_chars,
      CASE WHEN doc_id % 3 = 0 THEN 'n_chars' ELSE '' END AS bad_fields FROM documents"""
)
def row_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose value does not fit the mapping (every third, by rule) put aside, the others loaded."""
    given = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("about "), F.col("n_chars"))).otherwise(F.col("n_chars").cast("string"))
    docs = table(spark, sf_dir, "documents").select("doc_id", given.alias("n_chars"))
    mapping = {"properties": {"doc_id": {"type": "long"}, "n_chars": {"type": "long"}}}
    loaded, rejected = conform_rows(docs, schema_of(mapping), on_row_error="deadletter")
    return loaded.withColumn("bad_fields", F.lit("")).unionByName(
        rejected.select("doc_id", F.lit(None).cast("bigint").alias("n_chars"), F.array_join("bad_fields", ",").alias("bad_fields"))
    )
