"""Queries on keyed tables: upserts, updates, deletes, change logs, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred import config
from kindred.functions.text import payload_value
from kindred.operators import metrics, store
from kindred.operators.embed import hash_embedder
from kindred.operators.generate import Template, generate_texts, vocabulary
from kindred.operators.link import make_points
from kindred.plans.registry import query, spread_table, table
from kindred.session import new_work_path
from kindred.sources import tables
from kindred.sources.text import read_parquet_texts


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("value"))


def _event_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), "value", "event_id")


@query(
    """WITH newest AS (SELECT user_id AS id, arg_max(value, event_id) AS value FROM events GROUP BY user_id)
    SELECT id, value FROM newest UNION ALL
    SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT id FROM newest)"""
)
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as upserts on the accounts: last write per key wins."""
    return store.upsert(_accounts(spark, sf_dir), _event_values(spark, sf_dir), "id", ["event_id"])


@query(
    """WITH moved AS (SELECT vec_id * 2 AS point_id, embedding, label FROM embeddings)
    SELECT coalesce(m.point_id, e.vec_id) AS point_id, 'label ' || coalesce(m.label, e.label) AS keyword,
      round(list_sum(coalesce(m.embedding, e.embedding)::DOUBLE[]), 6) AS total
    FROM embeddings e FULL JOIN moved m ON m.point_id = e.vec_id"""
)
def upsert_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points replaced or added by id, payload included."""

    def points(key: Column) -> DataFrame:
        return table(spark, sf_dir, "embeddings").select(
            key.alias("point_id"),
            F.col("embedding").alias("vector"),
            F.concat(F.lit("label "), "label").alias("keyword"),
        )

    merged = store.upsert(
        points(F.col("vec_id")), points(F.col("vec_id") * 2).withColumn("seq", F.lit(1)), "point_id", ["seq"]
    )
    total = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return merged.select("point_id", "keyword", F.round(total, 6).alias("total"))


@query("SELECT CAST(doc_id AS VARCHAR) AS _id, md5(text) AS keyword_md5 FROM documents")
def bulk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk load: the table is replaced, ids are positions as strings and hence
    unique, so rows are written where they are read."""
    path = new_work_path(spark, "bulk")
    docs = spread_table(spark, sf_dir, "documents", "doc_id")
    tables.replace_table(docs.select(F.col("doc_id").cast("string").alias("_id"), F.col("text").alias(config.SOURCE_KEY)), path)
    return tables.read_table(spark, path).select("_id", F.md5(config.SOURCE_KEY).alias("keyword_md5"))


@query("SELECT CAST(event_id AS VARCHAR) AS _id, props AS keyword FROM events")
def bulk_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk load of short texts."""
    path = new_work_path(spark, "bulk")
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("_id"), F.col("props").alias(config.SOURCE_KEY)
    )
    tables.replace_table(events, path)
    return tables.read_table(spark, path)


@query("SELECT p_partkey AS point_id, p_name AS keyword FROM part")
def index_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector load of short texts: scan, row ids, model, table write."""
    path = new_work_path(spark, "points")
    texts = read_parquet_texts(spark, f"{sf_dir}/part.parquet", "p_name")
    tables.replace_table(make_points(tables.spread(texts, "row_id"), hash_embedder(64), 64), path)
    points = tables.read_table(spark, path, tables.points_schema())
    return points.select("point_id", payload_value(F.col("payload"), config.PAYLOAD_KEY).alias("keyword"))


@query(
    """SELECT CAST(d.doc_id AS VARCHAR) AS _id, coalesce('quality ' || l.quality, d.source) AS keyword
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
)
def upsert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents put over stored ones, ids as strings, into a table that may
    not exist yet."""
    path = new_work_path(spark, "stored")
    key = F.col("doc_id").cast("string").alias("_id")
    stored = table(spark, sf_dir, "documents").select(key, F.col("source").alias("keyword"))
    tables.ensure_table(spark, path, stored.schema)
    stored.write.mode("append").parquet(path)
    labels = table(spark, sf_dir, "labels").select(
        key, F.concat(F.lit("quality "), "quality").alias("keyword"), F.col("doc_id").alias("seq")
    )
    return store.upsert(tables.read_table(spark, path), labels, "_id", ["seq"])


@query(
    """SELECT d.doc_id, lang, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
)
def partial_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels set two fields of the documents they cover."""
    base = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.lit(-1).alias("quality"), F.lit(-1).alias("toxic")
    )
    return store.partial_update(base, table(spark, sf_dir, "labels"), "doc_id", ["quality", "toxic"])


@query("SELECT doc_id * 3 AS doc_id, quality FROM labels WHERE doc_id * 3 NOT IN (SELECT doc_id FROM documents)")
def unmatched_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = table(spark, sf_dir, "labels").select((F.col("doc_id") * 3).alias("doc_id"), "quality")
    return store.unmatched_updates(table(spark, sf_dir, "documents"), updates, "doc_id")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def delete_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = table(spark, sf_dir, "labels").filter(F.col("toxic") == 1)
    return store.delete_ids(table(spark, sf_dir, "documents").select("doc_id", "source"), gone, "doc_id")


@query(
    """SELECT asked.doc_id, d.lang, d.doc_id IS NOT NULL AS found FROM (SELECT DISTINCT doc_id * 3 AS doc_id FROM labels) asked
    LEFT JOIN documents d ON d.doc_id = asked.doc_id"""
)
def get_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "labels").select((F.col("doc_id") * 3).alias("doc_id")).distinct()
    return tables.get_documents(table(spark, sf_dir, "documents").select("doc_id", "lang"), ids, "doc_id")


# The event stream read as a change log on the accounts of its users.
_LOG_SQL = """log AS (SELECT user_id AS id, event_id AS seq,
    CASE event_type WHEN 'signup' THEN 'index' WHEN 'error' THEN 'delete' ELSE 'update' END AS op,
    CASE WHEN event_type IN ('signup', 'purchase', 'click') THEN value END AS value,
    CASE WHEN event_type IN ('signup', 'view') THEN props END AS note,
    event_type IN ('purchase', 'click') AS gives_value, event_type = 'view' AS gives_note FROM events),
  base AS (SELECT c_custkey AS id, c_acctbal AS value, c_name AS note FROM customer)"""


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        F.col("event_id").alias("seq"),
        F.when(kind == "signup", "index").when(kind == "error", "delete").otherwise("update").alias("op"),
        F.when(kind.isin("signup", "purchase", "click"), F.col("value")).alias("value"),
        F.when(kind.isin("signup", "view"), F.col("props")).alias("note"),
        F.when(kind.isin("purchase", "click"), F.array(F.lit("value"))).otherwise(F.array(F.lit("note"))).alias("given"),
    )


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("value"), F.col("c_name").alias("note")
    )


@query(
    f"""WITH {_LOG_SQL}, resets AS (SELECT id, max(seq) AS at, arg_max(op, seq) AS op FROM log
        WHERE op <> 'update' GROUP BY id),
      live AS (SELECT l.* FROM log l LEFT JOIN resets r ON l.id = r.id WHERE l.seq >= coalesce(r.at, -1)),
      last_value AS (SELECT id, max(seq) AS at FROM live WHERE op = 'index' OR gives_value GROUP BY id),
      last_note AS (SELECT id, max(seq) AS at FROM live WHERE op = 'index' OR gives_note GROUP BY id),
      ids AS (SELECT id FROM base UNION SELECT id FROM log)
    SELECT ids.id, CASE WHEN v.at IS NOT NULL THEN (SELECT value FROM log WHERE log.id = ids.id AND seq = v.at) ELSE b.value END AS value,
      CASE WHEN n.at IS NOT NULL THEN (SELECT note FROM log WHERE log.id = ids.id AND seq = n.at) ELSE b.note END AS note
    FROM ids LEFT JOIN base b ON b.id = ids.id LEFT JOIN resets r ON r.id = ids.id
      LEFT JOIN last_value v ON v.id = ids.id LEFT JOIN last_note n ON n.id = ids.id
    WHERE r.op = 'index' OR (r.op IS NULL AND b.id IS NOT NULL)"""
)
def changelog_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.fold_changes(_stored(spark, sf_dir), _log(spark, sf_dir), "id", "seq", ["value", "note"])


@query(
    f"""WITH {_LOG_SQL}, states AS (SELECT id, seq, op, last_value(CASE WHEN op <> 'update' THEN op END IGNORE NULLS) OVER (
        PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS state FROM log)
    SELECT s.id, s.seq FROM states s LEFT JOIN base b ON b.id = s.id
    WHERE s.op = 'update' AND (s.state = 'delete' OR (s.state IS NULL AND b.id IS NULL))"""
)
def rejected_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    missed = store.rejected_updates(_stored(spark, sf_dir), _log(spark, sf_dir), "id", "seq", seq_per_part=1000)
    return missed.select("id", "seq")


@query(
    """SELECT 'created' AS step, 1 AS happened, 0 AS n_rows UNION ALL SELECT 'kept', 0, count(*) FROM orders
    UNION ALL SELECT 'replaced', 1, count(*) FROM customer"""
)
def table_life(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create if absent, keep what exists, replace; with the row count after each step."""
    path = new_work_path(spark, "life")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"))
    created = tables.ensure_table(spark, path, orders.schema)
    after_create = tables.read_table(spark, path).count()
    tables.replace_table(orders, path)
    created_again = tables.ensure_table(spark, path, orders.schema)
    after_keep = tables.read_table(spark, path).count()
    tables.replace_table(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key")), path)
    after_replace = tables.read_table(spark, path).count()
    return spark.createDataFrame(
        [("created", int(created), after_create), ("kept", int(created_again), after_keep), ("replaced", 1, after_replace)],
        "step string, happened int, n_rows bigint",
    )


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def compacted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_work_path(spark, "compact")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    tables.compact(orders, path, "o_orderkey", n_files=4)
    return tables.read_table(spark, path)


# --- statistics over event-like outcome tables ----------------------------------


def _event_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as batch outcomes: finished at ``ts``, ``value`` rounded down
    rows each."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("batch_id"),
        F.col("ts").cast("timestamp").alias("finished_at"),
        F.floor("value").alias("n_rows"),
        "event_type",
        "value",
    )


@query("SELECT event_type AS stage, round(sum(value), 4) AS total_ms FROM events GROUP BY event_type")
def stage_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    timings = metrics.stage_timings(_event_batches(spark, sf_dir), "event_type", "value")
    return timings.withColumn("total_ms", F.round("total_ms", 4))


@query(
    """SELECT n, processed, round(processed / secs, 6) AS rps, round(n * 100.0 / nullif(processed, 0), 6) AS share FROM (
      SELECT count(*) AS n, CAST(sum(floor(value)) AS BIGINT) AS processed,
        (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS secs FROM events)"""
)
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    micros = F.unix_micros("finished_at")
    totals = _event_batches(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("n_rows").alias("processed"),
        ((F.max(micros) - F.min(micros)) / 1e6).alias("secs"),
    )
    return totals.select(
        "n",
        "processed",
        F.round(metrics.rate(F.col("processed"), F.col("secs")), 6).alias("rps"),
        F.round(metrics.percent(F.col("n"), F.col("processed")), 6).alias("share"),
    )


@query(
    """SELECT event_id AS batch_id, CAST(sum(floor(value)) OVER (ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS processed FROM events"""
)
def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows done after every batch, in order of completion."""
    batches = _event_batches(spark, sf_dir).select("batch_id", "finished_at", "n_rows")
    total = batches.agg(F.sum("n_rows")).first()[0]
    return metrics.progress(batches, total).select("batch_id", "processed")


@query(
    """SELECT CAST(epoch(time_bucket(INTERVAL '1 hour', ts)) AS BIGINT) AS started_at, CAST(sum(floor(value)) AS BIGINT) AS rows,
      round(sum(floor(value)) / 3600, 6) AS rps FROM events GROUP BY 1"""
)
def interval_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = metrics.interval_rates(_event_batches(spark, sf_dir), "1 hour")
    return rates.select(F.unix_timestamp("started_at").alias("started_at"), "rows", F.round("rps", 6).alias("rps"))


# --- generated corpora ------------------------------------------------------------

_PRODUCT_TEMPLATES = [
    Template(("adjective", "noun"), 2),
    Template(("brand", "adjective", "noun"), 4),
    Template(("nation", "adjective", "noun", "kind"), 3),
    Template(("brand", "nation", "noun", "kind"), 2),
]
_KEYWORD_TEMPLATES = [
    Template(("nation", "noun")),
    Template(("nation", "adjective", "noun")),
    Template(("kind", "nation", "adjective", "noun")),
    Template(("brand", "kind", "noun", "nation")),
]
_WORDS_SQL = {
    "adjective": "SELECT DISTINCT split_part(p_name, ' ', 1) AS w FROM part",
    "noun": "SELECT DISTINCT split_part(p_name, ' ', 2) AS w FROM part",
    "brand": "SELECT DISTINCT p_brand AS w FROM part",
    "kind": "SELECT DISTINCT p_type AS w FROM part",
    "nation": "SELECT DISTINCT n_name AS w FROM nation",
}


def _generated_sql(templates: list[Template], seed: int) -> str:
    def drawn(purpose: str, size: str) -> str:
        return f"(('0x' || substr(md5('{seed}:' || row || ':{purpose}'), 1, 8))::BIGINT % {size})"

    branches, upto = [], 0
    for t in templates:
        upto += t.weight
        words = " || ' ' || ".join(
            f"(SELECT l[1 + {drawn(str(i), 'len(l)')}] FROM v_{slot})" for i, slot in enumerate(t.slots)
        )
        branches.append(f"WHEN slot < {upto} THEN {words}")
    vocab = ", ".join(f"v_{n} AS (SELECT list(w ORDER BY w) AS l FROM ({sql}))" for n, sql in _WORDS_SQL.items())
    return f"""WITH {vocab}, n AS (SELECT count(*) AS n FROM part),
      slots AS (SELECT row, {drawn('template', str(upto))} AS slot FROM (SELECT unnest(range(4 * n)) AS row FROM n)),
      texts AS (SELECT row, CASE {' '.join(branches)} END AS text FROM slots),
      firsts AS (SELECT text, min(row) AS row FROM texts GROUP BY text)
    SELECT pos, text FROM (SELECT row_number() OVER (ORDER BY row) - 1 AS pos, text FROM firsts), n WHERE pos < n"""


def _generated(spark: SparkSession, sf_dir: str, templates: list[Template], seed: int) -> DataFrame:
    """As many distinct texts as there are parts, words taken from the tables, or
    all that four draws a part make where the words are too few for that."""
    part, nation = table(spark, sf_dir, "part"), table(spark, sf_dir, "nation")
    words = {
        "adjective": vocabulary(part, F.split_part("p_name", F.lit(" "), F.lit(1))),
        "noun": vocabulary(part, F.split_part("p_name", F.lit(" "), F.lit(2))),
        "brand": vocabulary(part, F.col("p_brand")),
        "kind": vocabulary(part, F.col("p_type")),
        "nation": vocabulary(nation, F.col("n_name")),
    }
    n_parts = part.count()
    return generate_texts(spark, n_parts, words, templates, seed=seed, draws=4 * n_parts)


@query(_generated_sql(_PRODUCT_TEMPLATES, config.GENERATOR_SEED))
def generate_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _generated(spark, sf_dir, _PRODUCT_TEMPLATES, config.GENERATOR_SEED)


@query(_generated_sql(_KEYWORD_TEMPLATES, 7))
def generate_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _generated(spark, sf_dir, _KEYWORD_TEMPLATES, 7)
