"""Queries on the embedding stage, text search, links and full text."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred import config
from kindred.config import RetryPolicy
from kindred.functions import nested
from kindred.functions.text import tokens
from kindred.operators import deadletter, metrics
from kindred.operators.embed import GRAM_FACTORS, GRAM_PRIME, HashEmbedder, embed, embed_outcomes, hash_embedder
from kindred.operators.fulltext import B, K1, corpus_stats, match, postings, token_stats
from kindred.operators.link import link_products, make_points, nest_links, search_distinct, search_texts, trace_keywords
from kindred.plans.registry import query, spread_table, table
from kindred.session import materialize, new_work_path

DIM = 64
LINK_K = 5
MODEL = hash_embedder(DIM)


def hash_vectors_sql(name: str, source: str, key: str, text: str) -> str:
    """CTE ``name(key, v)``: the built-in embedder written as SQL."""
    a, b, c = GRAM_FACTORS
    gram = f"(c[i] * {a} + c[i + 1] * {b} + c[i + 2] * {c}) % {GRAM_PRIME} % {DIM}"
    return f"""{name}_codes AS (SELECT {key} AS key,
        list_transform(string_split(' ' || {text} || ' ', ''), lambda ch: unicode(ch)::BIGINT) AS c FROM {source}),
      {name}_counts AS (SELECT key, bucket, count(*) AS n FROM (SELECT key,
        unnest(list_transform(range(1, len(c) - 1), lambda i: {gram})) AS bucket FROM {name}_codes) GROUP BY key, bucket),
      {name}_norms AS (SELECT key, sqrt(sum(n * n)) AS norm FROM {name}_counts GROUP BY key),
      {name} AS (SELECT g.key, list((coalesce(n, 0) / norm)::FLOAT ORDER BY g.bucket) AS v
        FROM (SELECT key, unnest(range({DIM})) AS bucket FROM {name}_norms) g
        JOIN {name}_norms USING (key) LEFT JOIN {name}_counts t ON t.key = g.key AND t.bucket = g.bucket
        GROUP BY g.key)"""


def topk_sql(queries: str, points: str, k: int) -> str:
    score = "list_cosine_similarity(q.v::DOUBLE[], p.v::DOUBLE[])"
    return f"""SELECT * FROM (SELECT q.key AS query_id, p.key AS point_id, {score} AS s,
        row_number() OVER (PARTITION BY q.key ORDER BY {score} DESC, p.key) AS rn FROM {queries} q, {points} p)
      WHERE rn <= {k}"""


def _document_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return make_points(spread_table(spark, sf_dir, "documents", "doc_id"), MODEL, DIM, row_id="doc_id")


_DOC_VECTORS = hash_vectors_sql("docs", "documents", "doc_id", "text")


@query(
    f"""WITH {_DOC_VECTORS} SELECT key AS doc_id, bucket, round(v[bucket + 1]::DOUBLE, 5) AS x
    FROM (SELECT key, v, unnest(range({DIM})) AS bucket FROM docs)"""
)
def hash_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    embedded = embed(spread_table(spark, sf_dir, "documents", "doc_id").select("doc_id", "text"), "text", MODEL, DIM)
    flat = embedded.select("doc_id", F.posexplode("vector").alias("bucket", "x"))
    return flat.select(
        "doc_id", F.col("bucket").cast("bigint").alias("bucket"), F.round(F.col("x").cast("double"), 5).alias("x")
    )


_BENCH_QUERIES = hash_vectors_sql("asked", "benchmark", "item_id", f"'{config.QUERY_PREFIX}' || text")


@query(
    f"""WITH {_DOC_VECTORS}, {_BENCH_QUERIES}, hits AS ({topk_sql('asked', 'docs', 10)})
    SELECT query_id, CAST(rn AS INTEGER) AS rank, round(s, 6) AS score, point_id, md5(text) AS keyword_md5
    FROM hits JOIN documents ON doc_id = point_id"""
)
def text_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File-style batch search: every benchmark text against all documents."""
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    points = _document_points(spark, sf_dir)
    hits = search_texts(asked, points, MODEL, DIM, top_k=10, prefix=config.QUERY_PREFIX)
    return hits.select("query_id", "rank", F.round("score", 6).alias("score"), "point_id", F.md5("keyword").alias("keyword_md5"))


_NAME_QUERIES = hash_vectors_sql("asked", "(SELECT DISTINCT p_name FROM part)", "p_name", "p_name")
_BENCH_POINTS = hash_vectors_sql("docs", "benchmark", "item_id", "text")


@query(
    f"""WITH {_BENCH_POINTS}, {_NAME_QUERIES}
    SELECT query_id AS query, CAST(rn AS INTEGER) AS rank, round(s, 6) AS score, point_id
    FROM ({topk_sql('asked', 'docs', config.SEARCH_TOP_K)})"""
)
def multi_query_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal queries collapse to one result."""
    points = make_points(table(spark, sf_dir, "benchmark"), MODEL, DIM, row_id="item_id")
    hits = search_distinct(table(spark, sf_dir, "part"), points, MODEL, DIM, query="p_name")
    return hits.select("query", "rank", F.round("score", 6).alias("score"), "point_id")


# --- links -------------------------------------------------------------------

_PRODUCTS = hash_vectors_sql("asked", "(SELECT DISTINCT p_name FROM part)", "p_name", f"'{config.QUERY_PREFIX}' || p_name")
LINKS_SQL = f"""WITH {_DOC_VECTORS}, {_PRODUCTS}, hits AS ({topk_sql('asked', 'docs', LINK_K)}),
  links AS (SELECT query_id AS product_name, CAST(rn AS INTEGER) AS rank, text AS keyword, point_id AS keyword_id,
    round(s, 6) AS score FROM hits JOIN documents ON doc_id = point_id)"""


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pos"), F.col("p_name").alias("product_name"))
    return link_products(products, _document_points(spark, sf_dir), MODEL, DIM, top_k=LINK_K)


@query(f"{LINKS_SQL} SELECT product_name, rank, md5(keyword) AS keyword_md5, keyword_id, score FROM links")
def link_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links(spark, sf_dir).select(
        "product_name", "rank", F.md5("keyword").alias("keyword_md5"), "keyword_id", "score"
    )


@query(
    f"""{LINKS_SQL} SELECT product_name, count(*) AS n_keywords, string_agg(keyword_id, ',' ORDER BY rank) AS ids,
      max(score) AS best FROM links GROUP BY product_name"""
)
def link_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nest_links(links(spark, sf_dir)).select(
        "product_name",
        F.size("keywords").cast("bigint").alias("n_keywords"),
        F.array_join(F.transform("keywords", lambda h: h["keyword_id"].cast("string")), ",").alias("ids"),
        F.array_max(F.transform("keywords", lambda h: h["score"])).alias("best"),
    )


@query(
    f"""{LINKS_SQL} SELECT product_name, rank, keyword_id AS point_id, score, md5(text) AS payload_md5
    FROM links JOIN documents ON doc_id = keyword_id"""
)
def link_traced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword ids of the nested documents traced back to the stored points."""
    traced = trace_keywords(nest_links(links(spark, sf_dir)), _document_points(spark, sf_dir))
    return traced.select(
        "product_name", "rank", "point_id", "score", F.md5(F.element_at("payload", config.PAYLOAD_KEY)).alias("payload_md5")
    )


MIN_SCORE = 0.5
MENTION = "the red"
_MENTIONS = "list_has_any(regexp_extract_all(lower(keyword), '[\\p{L}\\p{N}]+'), ['the', 'red'])"


@query(f"{LINKS_SQL} SELECT DISTINCT product_name FROM links WHERE score >= {MIN_SCORE}")
def nested_score_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = nest_links(links(spark, sf_dir))
    return docs.filter(nested.any_child(F.col("keywords"), nested.score_at_least(MIN_SCORE))).select("product_name")


@query(f"{LINKS_SQL} SELECT DISTINCT product_name FROM links WHERE {_MENTIONS}")
def nested_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = nest_links(links(spark, sf_dir))
    return docs.filter(nested.any_child(F.col("keywords"), nested.mentions(MENTION))).select("product_name")


@query(f"{LINKS_SQL} SELECT DISTINCT product_name FROM links WHERE {_MENTIONS} AND score >= {MIN_SCORE}")
def nested_match_and_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both conditions on the same nested entry."""
    docs = nest_links(links(spark, sf_dir))
    both = nested.any_child(F.col("keywords"), nested.mentions(MENTION), nested.score_at_least(MIN_SCORE))
    return docs.filter(both).select("product_name")


@query(
    f"""{LINKS_SQL} SELECT product_name, keyword_id, score FROM (SELECT *, row_number() OVER (
      PARTITION BY product_name ORDER BY rank) AS hit FROM links WHERE score >= {MIN_SCORE}) WHERE hit <= 3"""
)
def nested_inner_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = nest_links(links(spark, sf_dir))
    inner = nested.matching_children(F.col("keywords"), nested.score_at_least(MIN_SCORE), size=3)
    return docs.select("product_name", F.explode(inner).alias("hit")).select("product_name", "hit.keyword_id", "hit.score")


@query(
    f"""{LINKS_SQL} SELECT product_name, CAST(count(*) FILTER (WHERE rank <= 3) AS BIGINT) AS shown,
      greatest(count(*) - 3, 0) AS more FROM links GROUP BY product_name"""
)
def link_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown, more = nested.preview(F.col("keywords"), 3)
    return nest_links(links(spark, sf_dir)).select(
        "product_name", F.size(shown).cast("bigint").alias("shown"), more.cast("bigint").alias("more")
    )


@query("SELECT p_name AS product_name, count(*) AS n_parts FROM part GROUP BY p_name")
def raw_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouping on the untouched string, not on its tokens."""
    return table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("product_name")).agg(F.count(F.lit(1)).alias("n_parts"))


# --- full text ---------------------------------------------------------------

_TOKENS = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')"


@query(f"SELECT doc_id, len({_TOKENS}) AS dl, len(list_distinct({_TOKENS})) AS n_distinct FROM documents")
def document_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = spread_table(spark, sf_dir, "documents", "doc_id").select("doc_id", tokens(F.col("text")).alias("t"))
    return split.select(
        "doc_id",
        F.size("t").cast("bigint").alias("dl"),
        F.size(F.array_distinct("t")).cast("bigint").alias("n_distinct"),
    )


_POSTINGS = f"""SELECT doc_id, token, count(*) AS tf, max(dl) AS dl FROM (
  SELECT doc_id, unnest(t) AS token, len(t) AS dl FROM (SELECT doc_id, {_TOKENS} AS t FROM documents))
  GROUP BY doc_id, token"""


@query(_POSTINGS)
def posting_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = postings(spread_table(spark, sf_dir, "documents", "doc_id"), "doc_id", "text")
    return found.withColumn("dl", F.col("dl").cast("bigint"))


@query(f"SELECT token, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM ({_POSTINGS}) GROUP BY token")
def token_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_stats(postings(spread_table(spark, sf_dir, "documents", "doc_id"), "doc_id", "text"))


@query(
    f"""SELECT count(*) AS n_docs, round(avg(dl), 6) AS avg_dl, CAST(sum(dl) AS BIGINT) AS n_tokens
    FROM (SELECT len({_TOKENS}) AS dl FROM documents) WHERE dl > 0"""
)
def corpus_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_stats(spread_table(spark, sf_dir, "documents", "doc_id"), "text").withColumn("avg_dl", F.round("avg_dl", 6))


def _match_sql(docs: str, doc_id: str, text: str, queries: str, query_id: str, query_text: str, size: int) -> str:
    def toks(column: str) -> str:
        return f"regexp_extract_all(lower({column}), '[\\p{{L}}\\p{{N}}]+')"

    return f"""WITH split AS (SELECT {doc_id} AS doc_id, {toks(text)} AS t FROM {docs}),
      occ AS (SELECT doc_id, unnest(t) AS token, len(t) AS dl FROM split),
      lengths AS (SELECT count(*) AS n_docs, avg(len(t)) AS avg_dl FROM split WHERE len(t) > 0),
      post AS (SELECT doc_id, token, dl, count(*) AS tf FROM occ GROUP BY ALL),
      asked AS (SELECT query_id, token, count(*) AS weight FROM (
        SELECT {query_id} AS query_id, unnest({toks(query_text)}) AS token FROM {queries}) GROUP BY ALL),
      freq AS (SELECT token, count(*) AS df FROM post GROUP BY token),
      scored AS (SELECT query_id, doc_id, round(sum(weight * ln(1 + (n_docs - df + 0.5) / (df + 0.5))
          * tf / (tf + {K1} * (1 - {B} + {B} * dl / avg_dl))), 9) AS score
        FROM asked JOIN freq USING (token) JOIN post USING (token), lengths GROUP BY query_id, doc_id)
      SELECT query_id, CAST(rn AS INTEGER) AS rank, round(score, 6) AS score, doc_id FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rn FROM scored)
      WHERE rn <= {size}"""


@query(_match_sql("documents", "doc_id", "text", "benchmark", "item_id", "text", config.MATCH_SIZE))
def match_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark text as a match query on all documents."""
    hits = match(
        spread_table(spark, sf_dir, "documents", "doc_id"), table(spark, sf_dir, "benchmark"), query_id="item_id", query="text"
    )
    return hits.withColumn("score", F.round("score", 6))


@query(_match_sql("part", "p_partkey", "p_name", "(SELECT DISTINCT p_name FROM part)", "p_name", "p_name", 3))
def match_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product-name search: every distinct name as a query on all parts."""
    parts = table(spark, sf_dir, "part")
    names = parts.select("p_name").distinct()
    hits = match(spread_table(spark, sf_dir, "part", "p_partkey"), names, doc_id="p_partkey", text="p_name", query_id="p_name", query="p_name", size=3)
    return hits.withColumn("score", F.round("score", 6))


# --- failures as data ---------------------------------------------------------

NO_WAIT = RetryPolicy(max_attempts=2, first_wait=0.0)
# Texts that the faulty model refuses: by a hash, so that short and long ones are treated alike.
REFUSED = "00"


class PickyModel:
    """The built-in embedder behind a fault: it refuses about one text of 256,
    and with it the whole call."""

    def __init__(self) -> None:
        self.embedder = HashEmbedder(DIM)

    def __call__(self, texts: list[str]) -> np.ndarray:
        refused = sum(hashlib.md5(t.encode()).hexdigest().startswith(REFUSED) for t in texts)
        if refused:
            raise ValueError(f"{refused} texts refused")
        return self.embedder(texts)


_OUTCOMES = f"""WITH rows AS (SELECT doc_id AS pos, (doc_id // 64) * 64 AS batch_id, text,
    md5(text) LIKE '{REFUSED}%' AS refused FROM documents),
  batches AS (SELECT batch_id, count(*) AS n_rows, count(*) FILTER (WHERE refused) AS n_refused,
    CASE WHEN bool_or(refused) THEN 'failed' ELSE 'ok' END AS status,
    CASE WHEN bool_or(refused) THEN 2 ELSE 1 END AS attempts FROM rows GROUP BY batch_id)"""


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pos"), "text")
    return embed_outcomes(docs, PickyModel, DIM, retry=NO_WAIT)


@query(f"{_OUTCOMES} SELECT pos, r.batch_id, status, attempts FROM rows r JOIN batches b ON r.batch_id = b.batch_id")
def embed_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcomes(spark, sf_dir).select("pos", "batch_id", "status", "attempts")


@query(
    f"""{_OUTCOMES} SELECT r.batch_id, 'ValueError' AS error_type,
      any_value(n_refused) || ' texts refused' AS error_message, CAST(count(*) AS INTEGER) AS count,
      md5(string_agg(text, '|' ORDER BY pos)) AS texts_md5
    FROM rows r JOIN batches b ON r.batch_id = b.batch_id WHERE status = 'failed' GROUP BY r.batch_id"""
)
def dead_letter_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed batches written as dead letters and read back."""
    _, failed = deadletter.route_outcomes(_outcomes(spark, sf_dir))
    path = new_work_path(spark, "dead-letters")
    deadletter.write_dead_letters(deadletter.dead_letters(failed), path)
    return deadletter.read_dead_letters(spark, path).select(
        "batch_id", "error_type", "error_message", "count", F.md5(F.array_join("texts", "|")).alias("texts_md5")
    )


@query(
    f"""{_OUTCOMES} SELECT batch_id, CAST(attempt AS INTEGER) AS attempt, 'ValueError' AS error_type
    FROM (SELECT batch_id, unnest(range(1, attempts + 1)) AS attempt FROM batches WHERE status = 'failed')"""
)
def attempt_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deadletter.attempt_records(_outcomes(spark, sf_dir)).select("batch_id", "attempt", "error_type")


@query(
    f"""{_OUTCOMES} SELECT pos, CASE WHEN refused THEN 'failed' ELSE 'ok' END AS status
    FROM rows r JOIN batches b ON r.batch_id = b.batch_id WHERE b.status = 'failed'"""
)
def dead_letter_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters run again one by one, so that one text fails alone."""
    _, failed = deadletter.route_outcomes(_outcomes(spark, sf_dir))
    again = deadletter.letters_to_texts(deadletter.dead_letters(failed))
    return embed_outcomes(again, PickyModel, DIM, batch_size=1, retry=NO_WAIT).select("pos", "status")


@query(
    f"""{_OUTCOMES}, totals AS (SELECT sum(CASE WHEN status = 'ok' THEN n_rows ELSE 0 END) AS processed,
      sum(attempts - 1) AS retries, sum(CASE WHEN status = 'failed' THEN n_rows ELSE 0 END) AS failed_count,
      count(*) FILTER (WHERE status = 'failed') AS failed_batches FROM batches)
    SELECT metric, CAST(value AS BIGINT) AS value FROM (
      SELECT 'processed' AS metric, processed AS value FROM totals
      UNION ALL SELECT 'retries', retries FROM totals UNION ALL SELECT 'failed_count', failed_count FROM totals
      UNION ALL SELECT 'failed_batches', failed_batches FROM totals)
    WHERE metric = 'processed' OR value > 0"""
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = metrics.batch_outcomes(_outcomes(spark, sf_dir))
    return metrics.summary_rows(metrics.run_totals(batches))
