"""Corpus numbers kept per batch against counting the current documents."""

from pyspark.sql import functions as F

from kindred.operators.fulltext import corpus_stats, postings, token_stats
from kindred.sources.tables import read_table
from kindred.streaming import ingest, statistics

BATCHES = [
    [("a", "one two two", 0), ("b", "three", 1), ("c", None, 2)],
    [("d", "two four", 0), ("e", "", 1)],
    [("b", "one one", 0), ("f", "five", 1), ("f", "six one", 2)],
]


def _load(spark, table, numbers):
    step = statistics.with_statistics(ingest.keyed(lambda batch, number: batch, "_id"), "text")
    for number in numbers:
        rows = spark.createDataFrame(BATCHES[number], "_id string, text string, pos int")
        ingest.write_batch(step(rows, number), table, number, step.key)
        step.stored(spark, table, number)


def _same_as_counting(spark, table):
    terms, totals = statistics.corpus_numbers(spark, table, "_id", "text", within="pos")
    docs = ingest.current_rows(spark, table, "_id", within="pos")
    counted = token_stats(postings(docs, "_id", "text"))
    assert sorted(map(tuple, terms.collect())) == sorted(map(tuple, counted.select("token", "df", "cf").collect()))
    assert totals.select("n_docs", "n_tokens", "avg_dl").first() == corpus_stats(docs, "text").select("n_docs", "n_tokens", "avg_dl").first()


def test_numbers_of_appended_replaced_and_replayed_batches(spark, tmp_path):
    table = f"{tmp_path}/t"
    _load(spark, table, [0, 1])
    _same_as_counting(spark, table)
    _load(spark, table, [2])
    _same_as_counting(spark, table)
    _load(spark, table, [2, 0])
    _same_as_counting(spark, table)


def test_untouched_batches_are_not_split_again(spark, tmp_path):
    table = f"{tmp_path}/t"
    _load(spark, table, [0, 1])
    terms, totals = statistics.corpus_numbers(spark, table, "_id", "text")
    for numbers in (terms, totals):
        assert all("/_terms/" in f or "/_lengths/" in f for f in numbers.inputFiles())
    _load(spark, table, [2])
    terms, _ = statistics.corpus_numbers(spark, table, "_id", "text", within="pos")
    plan = terms._jdf.queryExecution().optimizedPlan().toString()
    assert "batch_id" in plan and "NOT batch_id" in plan  # kept sums are picked by partition, touched data likewise
    assert read_table(spark, f"{table}/_terms").filter(F.col("token") == "two").agg(F.sum("df")).first()[0] == 2
