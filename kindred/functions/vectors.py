"""Vector arithmetic as Spark column expressions (JVM side, double precision)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions.binding import once


def dot(a: Column, b: Column) -> Column:
    """Dot product, summed in index order in double precision."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; 0 where one of them is the zero vector."""
    norms = l2_norm(a) * l2_norm(b)
    return F.when(norms > 0, dot(a, b) / norms).otherwise(F.lit(0.0))


def l2_normalize(v: Column) -> Column:
    """Vector scaled to unit length; the zero vector stays as it is."""
    return once(
        l2_norm(v),
        lambda norm: F.transform(v, lambda x: F.when(norm > 0, x.cast("double") / norm).otherwise(F.lit(0.0))),
    )


def vector_report(df: DataFrame, vector: str, dim: int, tolerance: float = 1e-4) -> DataFrame:
    """One row that counts what is wrong with a vector table.

    One pass with map-side aggregation: nulls, wrong dimension, entries that
    are null or not finite, zero vectors, and vectors whose norm is not 1.
    """
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    checked = df.select(
        v.isNull().alias("is_null"),
        (v.isNotNull() & (F.size(v) != dim)).alias("wrong_dim"),
        (v.isNotNull() & ~finite).alias("not_finite"),
        F.when(v.isNotNull() & finite, l2_norm(v)).alias("norm"),
    )
    return checked.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("is_null").alias("n_null"),
        F.count_if("wrong_dim").alias("n_wrong_dim"),
        F.count_if("not_finite").alias("n_not_finite"),
        F.count_if(F.col("norm") == 0).alias("n_zero"),
        F.count_if(F.abs(F.col("norm") - 1) > tolerance).alias("n_not_unit"),
    )


def split_invalid_vectors(df: DataFrame, vector: str, dim: int) -> tuple[DataFrame, DataFrame]:
    """(usable, rejected): rejected rows carry a ``reason`` column."""
    v = F.col(vector)
    bad_entry = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    reason = (
        F.when(v.isNull(), F.lit("null vector"))
        .when(F.size(v) != dim, F.lit("wrong dimension"))
        .when(bad_entry, F.lit("entry is not finite"))
    )
    tagged = df.withColumn("reason", reason)
    return tagged.filter(F.col("reason").isNull()).drop("reason"), tagged.filter(F.col("reason").isNotNull())
