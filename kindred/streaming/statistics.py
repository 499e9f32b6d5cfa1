"""Corpus statistics of a streamed table, kept per micro-batch.

Each batch leaves, beside its data, how many of its documents hold each token
(``_terms/batch_id=N``) and one row of sums (``_lengths/batch_id=N``). The numbers of
the corpus add these up; only batches with replaced rows are counted anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions.text import tokens
from kindred.operators.fulltext import postings, token_stats
from kindred.sources.tables import read_table
from kindred.streaming.ingest import BatchStep, current_parts


def _lengths(rows: DataFrame, text: str) -> DataFrame:
    length = rows.select(F.size(tokens(F.col(text))).cast("bigint").alias("dl")).filter("dl > 0")
    return length.agg(F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum("dl"), F.lit(0)).alias("n_tokens"))


def commit_statistics(spark: SparkSession, table: str, number: int, key: str, text: str) -> None:
    """Count the stored batch ``number``; a replay writes the same again."""
    rows = read_table(spark, f"{table}/batch_id={number}")
    token_stats(postings(rows, key, text)).write.mode("overwrite").parquet(f"{table}/_terms/batch_id={number}")
    _lengths(rows, text).write.mode("overwrite").parquet(f"{table}/_lengths/batch_id={number}")


def with_statistics(step: BatchStep, text: str) -> BatchStep:
    """``step`` whose batches are counted when they are stored; ``step`` must name its key."""
    key = step.key
    step.stored = lambda spark, table, number: commit_statistics(spark, table, number, key, text)
    return step


def corpus_numbers(spark: SparkSession, table: str, key: str, text: str, *, within: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(token, df, cf) and one row n_docs, n_tokens, avg_dl of the current documents.

    Texts are split only in batches that hold replaced rows."""
    _, touched, numbers = current_parts(spark, table, key, within=within)
    known = ~F.col("batch_id").isin(numbers) if numbers else F.lit(True)
    terms = read_table(spark, f"{table}/_terms").filter(known).select("token", "df", "cf")
    sums = read_table(spark, f"{table}/_lengths").filter(known).select("n_docs", "n_tokens")
    if touched is not None:
        terms = terms.unionByName(token_stats(postings(touched, key, text)))
        sums = sums.unionByName(_lengths(touched, text))
    terms = terms.groupBy("token").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))
    totals = sums.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_tokens"))
    return terms, totals.withColumn("avg_dl", F.try_divide(F.col("n_tokens").cast("double"), F.col("n_docs")))
