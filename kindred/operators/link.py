"""The link job: every product gets its most similar keywords, nested."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred import config
from kindred.functions.text import payload_value
from kindred.operators.cells import CellIndex, topk_cells, topk_probed
from kindred.operators.embed import EmbedFactory, embed
from kindred.operators.sizes import shipped
from kindred.operators.topk import topk_join
from kindred.session import materialize

# Cells that an exact search opens before it bounds the rest.
FIRST_PROBE = 4


def make_points(
    texts: DataFrame,
    factory: EmbedFactory,
    dim: int,
    *,
    row_id: str = "row_id",
    text: str = "text",
    payload_key: str = config.PAYLOAD_KEY,
) -> DataFrame:
    """Vector table ``point_id, vector, payload`` of a corpus (no prefix)."""
    embedded = embed(texts, text, factory, dim)
    return embedded.select(
        F.col(row_id).alias("point_id"), "vector", F.create_map(F.lit(payload_key), F.col(text)).alias("payload")
    )


def search_texts(
    queries: DataFrame,
    points: DataFrame,
    factory: EmbedFactory,
    dim: int,
    *,
    top_k: int = config.SEARCH_TOP_K,
    query_id: str = "query_id",
    query: str = "query",
    prefix: str = "",
    payload_key: str = config.PAYLOAD_KEY,
    index: CellIndex | None = None,
    nprobe: int | None = None,
    **search: object,
) -> DataFrame:
    """Ranked hits of text queries: ``query_id, query, rank, score, <payload_key>,
    point_id, payload``. A query without hits keeps one row with null rank.

    With an ``index`` over the points the search goes through its cells: exact,
    or approximate over the ``nprobe`` nearest cells if that is given."""
    embedded = embed(queries.select(query_id, query), query, factory, dim, prefix=prefix)
    if index is None:
        hits = topk_join(embedded, points, top_k, dim, query_id=query_id, **search)
    elif nprobe is None:
        hits = topk_cells(embedded, index, top_k, FIRST_PROBE, query_id=query_id, **search)
    else:
        hits = topk_probed(embedded, index, top_k, nprobe, query_id=query_id, **search)
    # hits of few queries go to the points, not the points through a shuffle
    few = shipped(hits, queries.count() * top_k)
    with_payload = points.select("point_id", "payload").join(few, "point_id")
    return (
        queries.select(F.col(query_id).alias("query_id"), F.col(query).alias("query"))
        .join(with_payload, "query_id", "left")
        .select(
            "query_id",
            "query",
            "rank",
            "score",
            F.when(F.col("rank").isNotNull(), payload_value(F.col("payload"), payload_key)).alias(payload_key),
            "point_id",
            "payload",
        )
    )


def search_distinct(queries: DataFrame, points: DataFrame, factory: EmbedFactory, dim: int, *, query: str = "query", **options) -> DataFrame:
    """Multi-query search: equal queries are asked once and share one result.
    The query text is the key."""
    distinct = queries.select(F.col(query).alias("query")).distinct().select(F.col("query").alias("query_id"), "query")
    return search_texts(distinct, points, factory, dim, **options).drop("query_id")


def link_products(
    products: DataFrame,
    points: DataFrame,
    factory: EmbedFactory,
    dim: int,
    *,
    pos: str = "pos",
    product: str = "product_name",
    top_k: int = config.LINK_TOP_K,
    prefix: str = config.QUERY_PREFIX,
    payload_key: str = config.PAYLOAD_KEY,
    **search: object,
) -> DataFrame:
    """Flat links ``product_name, rank, keyword, keyword_id, score``.

    The document key is the product name and the result depends on nothing but
    the name, so equal names are reduced to one before the model and the search
    run. A product without hits keeps one row with null rank.
    """
    named = products.groupBy(F.col(product).alias("product_name")).agg(F.max(pos).alias("pos"))
    hits = search_texts(
        named, points, factory, dim, top_k=top_k, query_id="pos", query="product_name", prefix=prefix,
        payload_key=payload_key, **search,
    )
    return hits.select(
        F.col("query").alias("product_name"),
        "rank",
        F.col(payload_key).alias("keyword"),
        F.col("point_id").alias("keyword_id"),
        F.round("score", 6).alias("score"),
    )


def nest_links(links: DataFrame) -> DataFrame:
    """One document per product, keywords in rank order. At most top-k rows
    per product are collected."""
    hit = F.struct("rank", "keyword", "keyword_id", "score")
    ordered = F.array_sort(F.collect_list(F.when(F.col("rank").isNotNull(), hit)))
    nested = F.transform(
        ordered,
        lambda h: F.struct(h["keyword"].alias("keyword"), h["keyword_id"].alias("keyword_id"), h["score"].alias("score")),
    )
    return links.groupBy("product_name").agg(nested.alias("keywords"))


def trace_keywords(documents: DataFrame, points: DataFrame) -> DataFrame:
    """Every nested keyword joined back to the vector it came from."""
    flat = documents.select("product_name", F.posexplode("keywords").alias("place", "hit")).select(
        "product_name", (F.col("place") + 1).alias("rank"), F.col("hit.keyword_id").alias("point_id"), F.col("hit.score").alias("score")
    )
    # links are written once and counted: few go to the vectors, which then stay where they are
    flat = materialize(flat, "links")
    return points.join(shipped(flat, flat.count()), "point_id").select(*flat.columns, *[c for c in points.columns if c != "point_id"])
