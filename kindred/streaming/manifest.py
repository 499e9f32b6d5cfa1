"""What is known about each batch of a keyed table, so that readers open only what they must.

Beside the data (``batch_id=N``) a table has three folders that Spark's readers
of the table pass over:

* ``_batches/batch_id=N``: one row with the batch's counts, its smallest and
  largest key, and the smallest and largest id where keys are numbers;
* ``_filters/batch_id=N``: a Bloom filter of the batch's keys in blocks of 4 KB,
  built and merged by Spark's bitmap functions;
* ``_superseded/by_batch=N``: which keys of which batches the batch has replaced.

A batch is committed when its row stands in ``_batches``. Committing costs what
the batch brings in: earlier batches are picked by key range, then by filter, and
only of those that may hold one of the new keys the key column is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.operators.sizes import shipped
from kindred.session import materialize
from kindred.sources.tables import read_table, table_exists

#: Bits of one block of a filter (what a bitmap of Spark holds), bits per key, and bits set per key.
BLOCK_BITS = 32_768
BITS_PER_KEY = 12
BITS_SET = 6

BATCHES = (
    "batch_id int, key_name string, n_rows bigint, n_keys bigint, n_new_keys bigint, most_copies bigint, n_blocks bigint, "
    "least_key string, largest_key string, least_id bigint, largest_id bigint"
)


def _as_id(key: Column) -> Column:
    """Keys that are no numbers are no ids."""
    return key.cast("string").try_cast("bigint")


def _block(key: Column, n_blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), n_blocks)


def _places(key: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BLOCK_BITS)) for i in range(BITS_SET)])


def _may_hold() -> Column:
    """Whether all bits of ``places`` are set in ``bits``."""
    byte = "conv(hex(substring(bits, cast(p div 8 as int) + 1, 1)), 16, 10)"
    return F.expr(f"forall(places, p -> (shiftright(cast({byte} as int), cast(p % 8 as int)) & 1) = 1)")


def batches(spark: SparkSession, table: str) -> DataFrame | None:
    """The committed batches, None for a table without a manifest."""
    path = f"{table}/_batches"
    if not table_exists(spark, path):
        return None
    return read_table(spark, path)


def key_name(spark: SparkSession, table: str) -> str | None:
    known = batches(spark, table)
    first = None if known is None else known.select("key_name").first()
    return None if first is None else first["key_name"]


def commit_batch(spark: SparkSession, table: str, number: int, key: str) -> None:
    """Write down what batch ``number``, whose rows are stored, holds and replaces.

    A replay writes the same again. Keys that are null replace nothing.
    """
    rows = read_table(spark, f"{table}/batch_id={number}")
    name = F.col(key)
    keys = materialize(rows.filter(name.isNotNull()).groupBy(name.alias("key")).agg(F.count(F.lit(1)).alias("n")), "batch-keys")
    found = keys.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.max("n").alias("most_copies"),
        F.min("key").cast("string").alias("least_key"),
        F.max("key").cast("string").alias("largest_key"),
        F.min(_as_id(F.col("key"))).alias("least_id"),
        F.max(_as_id(F.col("key"))).alias("largest_id"),
    ).first()
    n_blocks = max(1, -(-found["n_keys"] * BITS_PER_KEY // BLOCK_BITS))
    blocks = keys.select(_block(F.col("key"), F.lit(n_blocks)).alias("block"), F.explode(_places(F.col("key"))).alias("place"))
    blocks.groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits")).write.mode("overwrite").parquet(
        f"{table}/_filters/batch_id={number}"
    )
    n_new = found["n_keys"] - _write_superseded(spark, table, number, keys, key, found)
    values = (number, key, rows.count(), found["n_keys"], n_new, found["most_copies"] or 0, n_blocks, *found[2:])
    row = spark.createDataFrame([values], BATCHES).drop("batch_id").coalesce(1)
    row.write.mode("overwrite").parquet(f"{table}/_batches/batch_id={number}")


def _write_superseded(spark: SparkSession, table: str, number: int, keys: DataFrame, key: str, found) -> int:
    """Store which rows lose against batch ``number``, or its own against later
    batches; the number of its keys that an earlier batch has."""
    path = f"{table}/_superseded/by_batch={number}"
    schema = f"key {keys.schema['key'].dataType.simpleString()}, batch_id int"
    others = _in_range(batches(spark, table), number, found, keys.schema["key"].dataType.simpleString())
    hits = spark.createDataFrame([], schema)
    if others is not None:
        hits = _shared_keys(spark, table, keys, key, others)
    lost = hits.select("key", F.least("batch_id", F.lit(number)).alias("batch_id"), (F.col("batch_id") < number).alias("is_earlier"))
    lost = materialize(lost, "superseded")
    lost.select("key", "batch_id").write.mode("overwrite").parquet(path)
    return lost.filter("is_earlier").select("key").distinct().count()


def _in_range(known: DataFrame | None, number: int, found, key_type: str) -> DataFrame | None:
    """Other batches whose range of keys meets the new one; None if there is none."""
    if known is None or found["n_keys"] == 0:
        return None
    others = known.filter((F.col("batch_id") != number) & (F.col("n_keys") > 0))
    if key_type in ("bigint", "int", "smallint", "tinyint"):
        meets = (F.col("least_id") <= found["largest_id"]) & (F.col("largest_id") >= found["least_id"])
    elif key_type == "string":
        meets = (F.col("least_key") <= found["largest_key"]) & (F.col("largest_key") >= found["least_key"])
    else:
        meets = F.lit(True)
    others = materialize(others.filter(meets).select("batch_id", "n_blocks"), "meeting")
    return None if others.isEmpty() else others


def _shared_keys(spark: SparkSession, table: str, keys: DataFrame, key: str, others: DataFrame) -> DataFrame:
    """key, batch_id of the keys that other batches hold, too."""
    name = F.col("key")
    # one row per key and batch whose range it meets; batches are few beside keys
    asked = keys.select("key", _places(name).alias("places")).crossJoin(F.broadcast(others))
    asked = asked.withColumn("block", _block(name, F.col("n_blocks")))
    filters = read_table(spark, f"{table}/_filters")
    maybe = asked.join(filters, ["batch_id", "block"]).filter(_may_hold()).select("key", "batch_id")
    maybe = materialize(maybe, "maybe")
    open_batches = [row["batch_id"] for row in maybe.select("batch_id").distinct().collect()]
    held = read_table(spark, table).filter(F.col("batch_id").isin(open_batches)).select(F.col(key).alias("key"), "batch_id")
    return maybe.join(held, ["key", "batch_id"], "left_semi")


def superseded(spark: SparkSession, table: str) -> DataFrame:
    """key, batch_id of rows that another batch has replaced."""
    return read_table(spark, f"{table}/_superseded").select("key", "batch_id")


def touched_batches(spark: SparkSession, table: str, known: DataFrame) -> tuple[list[int], list[int], DataFrame]:
    """Batches with rows that lost, batches that hold a key twice, and the lost keys."""
    lost = superseded(spark, table)
    hit = [row["batch_id"] for row in lost.select("batch_id").distinct().collect()]
    double = [row["batch_id"] for row in known.filter("most_copies > 1").select("batch_id").collect()]
    return hit, double, lost


def without_superseded(rows: DataFrame, lost: DataFrame, key: str) -> DataFrame:
    lost = lost.select(F.col("key").alias(key), "batch_id").distinct()
    return rows.join(shipped(lost, lost.count()), [key, "batch_id"], "left_anti")
