"""Run statistics from the batch-outcome table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.operators.numbering import running_total


def batch_outcomes(outcomes: DataFrame) -> DataFrame:
    """One row per batch from the row-wise outcomes of the embedding stage."""
    return outcomes.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max("attempts").alias("attempts"),
        F.max("status").alias("status"),
        F.sum("embed_ms").alias("embed_ms"),
        F.max("finished_at").alias("finished_at"),
    )


def run_totals(batches: DataFrame) -> DataFrame:
    """processed, retries, failed_count, failed_batches (ok and failed apart)."""
    ok = F.col("status") == "ok"
    return batches.agg(
        F.coalesce(F.sum(F.when(ok, F.col("n_rows"))), F.lit(0)).alias("processed"),
        F.coalesce(F.sum(F.col("attempts") - 1), F.lit(0)).cast("bigint").alias("retries"),
        F.coalesce(F.sum(F.when(~ok, F.col("n_rows"))), F.lit(0)).alias("failed_count"),
        F.count_if(~ok).alias("failed_batches"),
    )


def summary_rows(totals: DataFrame) -> DataFrame:
    """(metric, value) rows; retries and failures only where there are any."""
    names = ["processed", "retries", "failed_count", "failed_batches"]
    rows = totals.select(
        F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("bigint").alias("value")) for n in names])).alias("r")
    ).select("r.*")
    return rows.filter((F.col("metric") == "processed") | (F.col("value") > 0))


def stage_timings(timings: DataFrame, stage: str, ms: str) -> DataFrame:
    return timings.groupBy(F.col(stage).alias("stage")).agg(F.sum(ms).alias("total_ms"))


def rate(count: Column, seconds: Column) -> Column:
    """Rows per second; 0 when no time has passed."""
    return F.when(seconds > 0, count / seconds).otherwise(F.lit(0.0))


def percent(part: Column, total: Column) -> Column:
    """Share in percent; 0 when the total is 0."""
    return F.when(total > 0, part * 100.0 / total).otherwise(F.lit(0.0))


def progress(batches: DataFrame, total: int, *, order: str = "finished_at", tie: str = "batch_id", rows: str = "n_rows") -> DataFrame:
    """Cumulative rows and percent done after each finished batch."""
    done = running_total(batches, order, F.col(rows), tie=tie, out="processed")
    return done.withColumn("percent", percent(F.col("processed"), F.lit(total)))


def interval_rates(batches: DataFrame, width: str, *, at: str = "finished_at", rows: str = "n_rows") -> DataFrame:
    """Rows and rows per second in each interval of ``width`` seconds."""
    slot = F.window(F.col(at).cast("timestamp"), width)
    counted = batches.groupBy(slot.alias("slot")).agg(F.sum(rows).alias("rows"))
    seconds = F.unix_timestamp("slot.end") - F.unix_timestamp("slot.start")
    return counted.select(F.col("slot.start").alias("started_at"), "rows", rate(F.col("rows"), seconds).alias("rps"))
