"""Snapshot tables: replace, create if absent, compaction, existence, lookups.

A table is a folder of Parquet files. Merges (``operators.store``) make a new
snapshot; nothing overwrites the files it still reads.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def points_schema(id_type: T.DataType = T.LongType()) -> T.StructType:
    return T.StructType(
        [
            T.StructField("point_id", id_type, False),
            T.StructField("vector", T.ArrayType(T.FloatType(), containsNull=False)),
            T.StructField("payload", T.MapType(T.StringType(), T.StringType())),
        ]
    )


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows of a scan dealt out by key when the scan has fewer splits than the
    session has cores (one large row group is one task). A large table has more
    splits than cores and is left where it is. For plain scans only: the split
    count is read from the plan."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema
    except AnalysisException:
        return False
    return True


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Drop what is there and write ``df``."""
    df.write.mode("overwrite").parquet(path)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """Create an empty table unless one exists; True if it was created."""
    if table_exists(spark, path):
        return False
    spark.createDataFrame([], schema).write.parquet(path)
    return True


def compact(df: DataFrame, path: str, key: str, *, n_files: int | None = None) -> None:
    """Finalize after a bulk load: few files, sorted by key and disjoint in key
    range, so that lookups by key skip files by their statistics. Without
    ``n_files`` the adaptive planner sizes the files."""
    ranged = df.repartitionByRange(F.col(key)) if n_files is None else df.repartitionByRange(n_files, F.col(key))
    ranged.sortWithinPartitions(key).write.mode("overwrite").parquet(path)


def get_documents(table: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Documents of the given ids; an unknown id keeps null fields."""
    return ids.join(table.withColumn("found", F.lit(True)), key, "left").fillna({"found": False})
