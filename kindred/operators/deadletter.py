"""Failures as rows: routing, dead-letter files and their reprocessing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.session import materialize
from kindred.sources.results import write_json_lines

LETTER_SCHEMA = (
    "batch_id bigint, error_type string, error_message string, timestamp timestamp, count int, texts array<string>, "
    "positions array<bigint>"
)


def route_outcomes(outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ok, failed). The outcomes are written once and both sides read the
    written table, so the model does not run twice."""
    written = materialize(outcomes, "outcomes")
    return written.filter(F.col("status") == "ok"), written.filter(F.col("status") == "failed")


def dead_letters(failed: DataFrame) -> DataFrame:
    """One record per failed batch with its texts in order, where they stood, and its last error.
    Groups are bounded by the batch size."""
    last = F.element_at("errors", -1)
    placed = F.array_sort(F.collect_list(F.struct("pos", "text")))
    return (
        failed.groupBy("batch_id")
        .agg(F.first(last).alias("last"), F.count(F.lit(1)).cast("int").alias("count"), placed.alias("placed"))
        .select(
            "batch_id",
            "last.error_type",
            "last.error_message",
            "last.timestamp",
            "count",
            F.transform("placed", lambda p: p["text"]).alias("texts"),
            F.transform("placed", lambda p: p["pos"]).alias("positions"),
        )
    )


def attempt_records(outcomes: DataFrame) -> DataFrame:
    """One record per failed attempt of a batch, retried or final."""
    # every row of a batch carries the same list
    first_of_batch = outcomes.groupBy("batch_id").agg(F.first("errors").alias("errors"))
    return first_of_batch.select("batch_id", F.explode("errors").alias("error")).select("batch_id", "error.*")


def write_dead_letters(letters: DataFrame, path: str | None) -> None:
    """Append to the dead-letter folder; without a path nothing is written."""
    if path is not None:
        write_json_lines(letters, path, mode="append")


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LETTER_SCHEMA).json(path)


def letters_to_texts(letters: DataFrame) -> DataFrame:
    """Texts of dead letters as a source for another run, at their old positions.
    Letters of files without positions count from their batch number."""
    place = F.coalesce(F.get("positions", F.col("place")), F.col("batch_id") + F.col("place"))
    return letters.select("batch_id", "positions", F.posexplode("texts").alias("place", "text")).select(place.alias("pos"), "text")
