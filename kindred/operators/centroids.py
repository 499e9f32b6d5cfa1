"""Mean vectors per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.functions.vectors import l2_normalize
from kindred.operators.vectorsum import vector_sums

# Fixed value: lower bound of the divisor of a mean.
MIN_WEIGHT = 1e-9


def group_means(df: DataFrame, group: str, vector: str, *, unit: bool = True) -> DataFrame:
    """``group, n, centroid``: the mean vector of each group, scaled to unit
    length. Each task adds its vectors up, the sums are merged in a tree. Rows
    without a vector count nowhere; vectors of different sizes are an error."""
    divisor = F.greatest(F.col("n").cast("double"), F.lit(MIN_WEIGHT))
    mean = F.transform("total", lambda x: x / divisor)
    centroid = l2_normalize(mean) if unit else mean
    return vector_sums(df, group, vector).select(F.col("key").alias(group), "n", centroid.alias("centroid"))
