"""Incremental loads with Structured Streaming.

A table grows by one folder per micro-batch (``batch_id=N``). Writing a batch
overwrites its own folder, so a batch that is replayed after a failure leaves
the table as if it had run once. A micro-batch costs what it brings in: the
existing table is not rewritten. Beside each batch stands what it holds and
replaces (``manifest``), so numbering reads no data and readers fold only batches
whose keys came again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindred import config
from kindred.operators.embed import EmbedFactory
from kindred.operators.link import link_products, make_points, nest_links
from kindred.operators.sizes import shipped
from kindred.operators.store import latest_per_key
from kindred.session import materialize
from kindred.sources.tables import read_table, table_exists
from kindred.streaming import manifest

BatchStep = Callable[[DataFrame, int], DataFrame]


def text_stream(
    spark: SparkSession,
    path: str,
    text_column: str = config.PARQUET_TEXT_COLUMN,
    *,
    glob: str = "*.parquet",
    tables: Sequence[str] = (),
    files_per_batch: int | None = None,
) -> DataFrame:
    """Stream of ``text, file, row_in_file`` from the Parquet files of a folder whose
    names fit ``glob``, or from its ``tables``: each is a file ``<name>.parquet`` or a
    folder of that name with files of any name."""
    reader = spark.readStream.schema(f"`{text_column}` string")
    if tables:
        # a pattern in the path picks files and folders, the filter sees names of files only
        path = f"{path}/{{{','.join(tables)}}}.parquet"
    else:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).select(
        F.col(text_column).alias("text"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row_in_file"),
    )


def batch_positions(batch: DataFrame) -> DataFrame:
    """Rows of one micro-batch with ``pos`` = 0, 1, 2, ... by file and row; only
    one count per file is windowed."""
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        batch.groupBy("file")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"))
    )
    placed = batch.join(shipped(offsets, offsets.count()), "file")
    return placed.withColumn("pos", F.col("rows_before") + F.col("row_in_file")).drop("rows_before")


def run_ingest(stream: DataFrame, table: str, step: BatchStep, *, checkpoint: str | None = None) -> None:
    """Bring in everything new and stop. The checkpoint lives beside the data,
    one per table, so batch numbers of a table never start over."""

    def write(batch: DataFrame, number: int) -> None:
        write_batch(step(batch, number), table, number, getattr(step, "key", None))
        if hasattr(step, "stored"):
            step.stored(batch.sparkSession, table, number)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint or f"{table}/_checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def keyed(step: BatchStep, key: str) -> BatchStep:
    """``step`` with the name of the key of its rows: its table gets a manifest."""
    step.key = key
    return step


def write_batch(rows: DataFrame, table: str, number: int, key: str | None = None) -> None:
    """Write one batch, and its manifest where the key is given or the table has one."""
    spark = rows.sparkSession
    rows.write.mode("overwrite").parquet(f"{table}/batch_id={number}")
    key = key or manifest.key_name(spark, table)
    if key is not None:
        manifest.commit_batch(spark, table, number, key)


def current_rows(spark: SparkSession, table: str, key: str, *, within: str | None = None) -> DataFrame:
    """Newest row per key; ``within`` orders rows of the same batch.

    Batches whose keys no other batch has pass as they are. In those where some
    lost against a newer batch the lost rows are left out by a join, and only
    batches that hold a key twice are folded. Rows without a key all pass."""
    untouched, touched, _ = current_parts(spark, table, key, within=within)
    return untouched if touched is None else untouched.unionByName(touched)


def current_parts(
    spark: SparkSession, table: str, key: str, *, within: str | None = None
) -> tuple[DataFrame, DataFrame | None, list[int]]:
    """The rows of batches that are as they were written, the rows left of the
    others (None if there are no such batches), and the numbers of those."""
    known = manifest.batches(spark, table)
    if known is None or manifest.key_name(spark, table) != key:
        rows = read_table(spark, table)
        numbers = [row["batch_id"] for row in rows.select("batch_id").distinct().collect()]
        return rows.drop("batch_id").limit(0), _folded_rows(rows, key, within), numbers
    # a batch whose commit is still to come is not there yet
    newest = known.agg(F.max("batch_id")).first()[0]
    rows = read_table(spark, table).filter(F.col("batch_id") <= newest)
    hit, double, lost = manifest.touched_batches(spark, table, known)
    if not hit and not double:
        return rows.drop("batch_id"), None, []
    untouched = rows.filter(~F.col("batch_id").isin(hit + double)).drop("batch_id")
    parts = []
    plain = sorted(set(hit) - set(double))
    if plain:
        parts.append(manifest.without_superseded(rows.filter(F.col("batch_id").isin(plain)), lost, key).drop("batch_id"))
    if double:
        inside = rows.filter(F.col("batch_id").isin(double))
        parts.append(_folded_rows(manifest.without_superseded(inside, lost, key) if hit else inside, key, within))
    touched = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return untouched, touched.select(*untouched.columns), sorted({*hit, *double})


def _folded_rows(rows: DataFrame, key: str, within: str | None) -> DataFrame:
    """Newest row per key without a manifest. Only the keys are counted; rows of
    repeated keys alone are shuffled and folded."""
    order = ["batch_id"] if within is None else ["batch_id", within]
    repeated = materialize(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key), "repeated")
    n_repeated = repeated.count()
    if n_repeated == 0:
        return rows.drop("batch_id")
    few = shipped(repeated, n_repeated)
    newest = latest_per_key(rows.join(few, key, "left_semi"), key, order)
    return rows.join(few, key, "left_anti").unionByName(newest).drop("batch_id")


def next_id(spark: SparkSession, table: str, key: str, number: int, id_mode: str) -> int:
    """First id of batch ``number``: behind the largest id of earlier batches
    (``append``), the number of keys in earlier batches (``count``), or 0
    (``restart``). Where the table has a manifest no data is read."""
    if id_mode not in ("restart", "count", "append"):
        raise ValueError(f"unknown id mode: {id_mode}")
    if id_mode == "restart":
        return 0
    known = manifest.batches(spark, table)
    if known is not None:
        before = known.filter(F.col("batch_id") < number)
        total = F.max("largest_id") + 1 if id_mode == "append" else F.sum("n_new_keys")
        return int(before.agg(total).first()[0] or 0)
    if not table_exists(spark, table):
        return 0
    earlier = read_table(spark, table)
    if "batch_id" in earlier.columns:
        earlier = earlier.filter(F.col("batch_id") < number)
    if id_mode == "count":
        return earlier.select(key).distinct().count()
    # ids that are no numbers were given by somebody else and do not count
    largest = earlier.agg(F.max(F.col(key).cast("string").try_cast("bigint"))).first()[0]
    return 0 if largest is None else int(largest) + 1


def vector_step(
    table: str, factory: EmbedFactory, dim: int, *, id_mode: str = "append", payload_key: str = config.PAYLOAD_KEY
) -> BatchStep:
    """Embed the new texts and give them ids behind the existing ones."""

    def step(batch: DataFrame, number: int) -> DataFrame:
        first = next_id(batch.sparkSession, table, "point_id", number, id_mode)
        numbered = batch_positions(batch).withColumn("row_id", F.col("pos") + F.lit(first).cast("bigint"))
        return make_points(numbered, factory, dim, payload_key=payload_key)

    return keyed(step, "point_id")


def document_step(
    table: str | None = None, *, doc_id: Column | None = None, id_mode: str = "append", source_key: str = config.SOURCE_KEY
) -> BatchStep:
    """Documents ``_id`` and ``source_key``. Ids are given, or numbers as strings
    by ``id_mode`` (see ``next_id``): behind those of ``table`` unless stated
    otherwise; with ``restart`` every batch replaces rows of the one before."""
    if doc_id is None and table is None and id_mode != "restart":
        raise ValueError(f"id_mode {id_mode!r} needs the table, to go on behind its ids")

    def step(batch: DataFrame, number: int) -> DataFrame:
        rows = batch_positions(batch)
        key = doc_id
        if key is None:
            first = 0 if table is None else next_id(batch.sparkSession, table, "_id", number, id_mode)
            key = (F.col("pos") + F.lit(first).cast("bigint")).cast("string")
        return rows.select(key.alias("_id"), F.col("text").alias(source_key), "pos")

    return keyed(step, "_id")


def link_step(points: DataFrame, factory: EmbedFactory, dim: int, **options: object) -> BatchStep:
    """Link documents of the new products against the stored points."""

    def step(batch: DataFrame, number: int) -> DataFrame:
        products = batch_positions(batch).withColumnRenamed("text", "product_name")
        return nest_links(link_products(products, points, factory, dim, **options))

    return keyed(step, "product_name")
