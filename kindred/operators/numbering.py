"""Running totals and dense row numbers over a global order, without a single
task for the whole table.

Rows are put into order-preserving buckets at quantiles of the order column.
The bucket totals (a bounded number of rows) are summed up in one small window
and added to the running total inside each bucket. A value that fills several
quantiles by itself gets its own bucket, split further by the tie-break column
into about as many parts as it fills quantiles, so all buckets together stay in
proportion to the number of quantiles. Without a tie-break column a digest of the
whole row splits it and orders its rows; only rows equal in every column then stay
together. (Maps have no digest and are left out of it.)
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import chain

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def running_total(
    df: DataFrame, order: str, value: Column, *, tie: str | None = None, out: str = "running_total", n_buckets: int | None = None
) -> DataFrame:
    """``df`` with the sum of ``value`` over all rows up to and including this
    one, by ``order`` and then ``tie``."""
    bucketed = _with_buckets(df.withColumn("_value", value), order, tie, n_buckets)
    keys = ["_bucket", "_sub"]
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    totals = bucketed.groupBy(*keys).agg(F.sum("_value").alias("_total"))
    # bounded: one row per bucket
    offsets = F.broadcast(
        totals.select(*keys, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(*keys).orderBy(order, tie or "_tie_key").rowsBetween(Window.unboundedPreceding, 0)
    summed = bucketed.join(offsets, keys).withColumn(out, F.col("_before") + F.sum("_value").over(inside))
    return summed.drop("_value", "_before", "_key", "_tie_key", *keys)


def dense_positions(df: DataFrame, order: str, *, tie: str | None = None, n_buckets: int | None = None) -> DataFrame:
    """``df`` with ``pos`` = 0, 1, 2, ... in the given order."""
    numbered = running_total(df, order, F.lit(1).cast("bigint"), tie=tie, out="pos", n_buckets=n_buckets)
    return numbered.withColumn("pos", F.col("pos") - 1)


def first_rows(df: DataFrame, n: int, order: str, *, tie: str | None = None) -> DataFrame:
    """The first ``n`` rows of a global order, numbered by ``pos``."""
    return dense_positions(df, order, tie=tie).filter(F.col("pos") < n)


def _numeric(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    return F.col(name).cast("double")


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind)
    return isinstance(kind, (T.MapType, T.VariantType))


def _with_buckets(df: DataFrame, order: str, tie: str | None, n_buckets: int | None) -> DataFrame:
    n = n_buckets or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_key", _numeric(df, order))
    cuts, hot = _cuts(keyed, "_key", n)
    keyed = _bucketize(keyed, "_key", "_bucket", cuts)
    if tie is None:
        keyed = keyed.withColumn("_tie_key", F.xxhash64(*[F.col(f.name) for f in df.schema if not _holds_map(f.dataType)]))
    if not hot:
        return keyed.withColumn("_sub", F.lit(0.0))
    if tie is None:
        share = F.element_at(F.create_map(*[F.lit(x) for x in chain(*hot.items())]), F.col("_key"))
        return keyed.withColumn("_sub", F.coalesce(F.when(F.col("_key").isin(list(hot)), F.pmod("_tie_key", share)), F.lit(0)).cast("double"))
    keyed = keyed.withColumn("_tie_key", _numeric(df, tie))
    tie_cuts, _ = _cuts(keyed, "_tie_key", n)
    keyed = _bucketize(keyed, "_tie_key", "_sub", tie_cuts)
    parts = F.create_map(*[F.lit(x) for value, filled in hot.items() for x in (value, float(filled))])
    share = F.floor(F.col("_sub") * parts[F.col("_key")] / F.lit(len(tie_cuts) + 1.0))
    return keyed.withColumn("_sub", F.coalesce(F.when(F.col("_key").isin(list(hot)), share.cast("double")), F.lit(0.0)))


def _cuts(df: DataFrame, name: str, n: int) -> tuple[list[float], dict[float, int]]:
    """(bucket borders, values that fill more than one quantile with how many)."""
    found = df.approxQuantile(name, [i / n for i in range(1, n)], 0.25 / n)
    hot = {value: filled for value, filled in Counter(found).items() if filled > 1}
    return sorted({*found, *(math.nextafter(x, math.inf) for x in hot)}), hot


def _bucketize(df: DataFrame, name: str, out: str, cuts: list[float]) -> DataFrame:
    if not cuts:
        return df.withColumn(out, F.lit(0.0))
    return Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol=name, outputCol=out).transform(df)
