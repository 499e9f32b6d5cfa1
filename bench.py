"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the tables and the cores; BENCH_ONLY (comma separated) a part of the queries.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from kindred import build_session  # noqa: E402
from kindred.operators.embed import embed, hash_embedder  # noqa: E402
from kindred.operators.generate import Template, generate_texts, vocabulary  # noqa: E402
from kindred.operators.link import link_products, make_points  # noqa: E402
from kindred.plans import catalog  # noqa: E402
from kindred.session import materialize  # noqa: E402

HEADLINE = (
    "scan_texts",
    "hash_embed",
    "link_flat",
    "link_distinct",
    "text_search",
    "topk_exact",
    "topk_blocked",
    "topk_streamed",
    "topk_by_cells",
    "topk_approximate",
    "topk_single",
    "centroid_by_label",
    "index_keywords",
    "bulk_keywords",
    "bulk_documents",
    "upsert_latest",
    "changelog_fold",
    "rejected_updates",
    "posting_list",
    "match_documents",
    "match_names",
    "embed_status",
    "dead_letter_file",
    "progress",
    "generate_products",
    "ingest_vectors",
    "nested_match_and_score",
)


#: The link job at its default width and depth, over names that are all different.
LINKED_NAMES, LINK_DIM, LINK_TOP_K = 20_000, 768, 30


def link_distinct(spark, sf_dir):
    """20,000 distinct names, each with its 30 nearest of all documents at 768 dimensions."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.explode(F.split("p_name", " ")).alias("word"))
    words = vocabulary(part, F.col("word"))
    slots = tuple("abcdef")
    names = generate_texts(spark, LINKED_NAMES, dict.fromkeys(slots, words), [Template(slots)])
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("row_id"), "text")
    points = make_points(docs.repartition(spark.sparkContext.defaultParallelism), hash_embedder(LINK_DIM), LINK_DIM)
    points = materialize(points, "bench-points")
    return link_products(names.withColumnRenamed("text", "product_name"), points, hash_embedder(LINK_DIM), LINK_DIM, top_k=LINK_TOP_K)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]
    spark = build_session(
        "kindred-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # the JVM and one Python worker per core are up before the clock starts
    texts = spark.range(0, 1000, 1, int(cpus)).select(F.col("id").cast("string").alias("text"))
    embed(texts, "text", hash_embedder(8), 8).write.format("noop").mode("overwrite").save()
    cold: dict[str, float] = {}
    seconds: dict[str, float] = {}
    for name in only or HEADLINE:
        # first run compiles the plan's code, second run is the measurement
        for taken in (cold, seconds):
            started = time.perf_counter()
            run = link_distinct if name == "link_distinct" else catalog.QUERIES[name]
            run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken[name] = round(time.perf_counter() - started, 3)
    rows = {
        "embedded_texts_per_sec": ("hash_embed", "documents"),
        "indexed_keywords_per_sec": ("index_keywords", "part"),
        "stored_documents_per_sec": ("bulk_documents", "documents"),
        "stored_keywords_per_sec": ("bulk_keywords", "events"),
        "linked_products_per_sec": ("link_flat", "part"),
    }
    rates = {
        metric: round(spark.read.parquet(f"{sf_dir}/{table}.parquet").count() / seconds[name], 1)
        for metric, (name, table) in rows.items()
        if name in seconds
    }
    if "link_distinct" in seconds:
        rates["linked_distinct_names_per_sec"] = round(LINKED_NAMES / seconds["link_distinct"], 1)
    if "topk_exact" in seconds:
        n = spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
        rates["exact_pairs_per_sec"] = round(n * n / seconds["topk_exact"], 1)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "rates": rates,
                "first_run": cold,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
