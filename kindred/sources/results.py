"""Search-result, dead-letter and plain text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred import config

# Field names of a hit, which a payload key may not take.
RESERVED_FIELDS = ("rank", "score", "point_id", "payload")


def result_lines(
    hits: DataFrame, *, query_pos: str = "query_id", query: str = "query", payload_key: str = config.PAYLOAD_KEY
) -> DataFrame:
    """One row per query: ``query`` and its hits in rank order.

    ``hits`` has one row per hit with ``rank, score, point_id, payload`` and
    the hit's text in a column named ``payload_key``. A query without hits
    (null rank) keeps an empty list. The lists are bounded by the k of the
    search.
    """
    if payload_key in RESERVED_FIELDS:
        raise ValueError(f"'{payload_key}' is a field of every hit; choose another payload key")
    hit = F.struct(
        F.col("rank"),
        F.round("score", 6).alias("score"),
        F.col(payload_key).alias(payload_key),
        F.col("point_id"),
        F.col("payload"),
    )
    collected = F.collect_list(F.when(F.col("rank").isNotNull(), hit))
    ranked = F.array_sort(collected, lambda a, b: a["rank"] - b["rank"])
    return hits.groupBy(query_pos, query).agg(ranked.alias("results"))


def write_json_lines(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """JSON lines that keep null fields."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_result_lines(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Result lines with the schema they were written with (no inference scan)."""
    return spark.read.schema(like.schema).json(path)


def top_hit(results: Column, field: str) -> Column:
    """Field of the best hit, null where there is none."""
    return F.get(results, 0)[field]


def write_text_lines(df: DataFrame, column: str, path: str, *, mode: str = "errorifexists") -> None:
    df.select(F.col(column).cast("string")).write.mode(mode).text(path)
