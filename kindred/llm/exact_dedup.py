"""Exact duplicates against a persistent digest index.

The index is a table bucketed and sorted by the digest of the normalised text.
A batch is reduced to one row per digest (map-side first, so a group of copies
costs one row per task), digests that the index has are taken out by a
sort-merge anti-join, and what is left is appended. Only digests and ids are
shuffled, never texts. Everything runs as DataFrame and SQL functions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.session import lasting_path, materialize, new_work_table, remove_folder

#: Characters that do not count for equality.
SPACES = " \t\n\x0b\x0c\r"

INDEX_SCHEMA = "text_sha256 string, keep_id bigint, keep_points int, group_size bigint, batch string"
#: Begins the name of the file that holds an index's number of buckets.
BUCKETS_MARK = "_buckets-"


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def text_digest(text: Column) -> Column:
    return F.sha2(F.encode(normalised(text), "UTF-8"), 256)


class DigestIndex:
    """A table of the digests seen so far, bucketed and sorted by digest.

    The index is its folder: ``path``, or one below ``spark.checkpoint.dir`` that
    follows from ``name``. A session that does not know the table registers it
    over the files that are there, so further batches of any application append
    to it; an index that is new begins as an empty bucketed table. A hidden file
    in the folder holds the number of buckets, which wins over ``buckets``. With
    neither name nor path it is a work table, which goes with its job's scope.
    """

    def __init__(self, spark: SparkSession, name: str | None = None, *, path: str | None = None, buckets: int = 64):
        self.spark = spark
        self.buckets = buckets
        if name is None and path is None:
            self.name, self.path = new_work_table(spark, "digests")
        else:
            self.name = name or f"digests_{uuid.uuid4().hex}"
            self.path = path or lasting_path(spark, f"digest-index-{self.name}")

    def _open(self) -> None:
        """Register the table in this session, or fail before anything is written."""
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        place = fs.makeQualified(place)
        names = [status.getPath().getName() for status in fs.listStatus(place)] if fs.exists(place) else []
        marks = [n.removeprefix(BUCKETS_MARK) for n in names if n.startswith(BUCKETS_MARK)]
        if len(marks) > 1 or (not marks and any(not n.startswith(("_", ".")) for n in names)):
            raise ValueError(f"{self.path} holds files but not the one number of buckets of a digest index")
        if self.spark.catalog.tableExists(self.name):
            described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").filter("col_name = 'Location'").first()
            known = fs.makeQualified(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(described.data_type))
            if known.toString() != place.toString():
                raise ValueError(f"table {self.name} lies in {known.toString()}, not in {self.path}")
            if not marks:
                raise ValueError(f"the folder of table {self.name} is gone or no digest index: {self.path}")
        if marks:
            self.buckets = int(marks[0])
        else:
            fs.mkdirs(place)
            fs.createNewFile(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place, f"{BUCKETS_MARK}{self.buckets}"))
        location = place.toString().replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({INDEX_SCHEMA}) USING parquet "
            f"CLUSTERED BY (text_sha256) SORTED BY (text_sha256) INTO {self.buckets} BUCKETS LOCATION '{location}'"
        )
        # another session may have appended since this one listed the files
        self.spark.catalog.refreshTable(self.name)

    def rows(self) -> DataFrame:
        self._open()
        return self.spark.table(self.name)

    def drop(self) -> None:
        """Remove the index, files and catalog entry."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        remove_folder(self.spark, self.path)

    def append(self, rows: DataFrame) -> None:
        self._open()
        (
            rows.repartition(self.buckets, "text_sha256")
            .write.format("parquet")
            .option("path", self.path)
            .bucketBy(self.buckets, "text_sha256")
            .sortBy("text_sha256")
            .mode("append")
            .saveAsTable(self.name)
        )


def deduplicate(docs: DataFrame, index: DigestIndex, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points in the original text stays,
    then the one with the smallest id. A digest that the index already has keeps
    nothing: keep_id is the id that the index holds. The new digests are
    appended to ``index``.

    Defined cases: a null text equals an empty one (and one of white space
    only). A null id sorts after all others. Rows repeated with the same id and
    length: one of them stays. group_size counts the rows of this batch and
    those of the batch that brought the digest. An empty table gives no rows.
    Further columns of ``docs`` are not read.
    """
    batch = uuid.uuid4().hex
    text = F.col(text_col)
    narrow = materialize(
        docs.select(
            F.col(id_col).cast("bigint").alias("doc_id"),
            F.length(F.coalesce(text, F.lit(""))).alias("n_points"),
            text_digest(text).alias("text_sha256"),
        ),
        "digests",
    )
    best = F.min(F.struct((-F.col("n_points")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    groups = (
        narrow.groupBy("text_sha256")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
        .select(
            "text_sha256",
            F.col("best.doc_id").alias("keep_id"),
            (-F.col("best.less")).cast("int").alias("keep_points"),
            "group_size",
            F.lit(batch).alias("batch"),
        )
    )
    fresh = groups.join(index.rows().select("text_sha256").hint("merge"), "text_sha256", "left_anti")
    index.append(fresh)

    index_rows = index.rows().select(
        "text_sha256", F.col("keep_id").alias("kept_id"), F.col("keep_points").alias("kept_points"),
        F.col("group_size").alias("first_size"), F.col("batch").alias("first_batch"),
    )
    is_new = F.col("first_batch") == batch
    decided = groups.join(index_rows, "text_sha256").select(
        "text_sha256",
        "kept_id",
        "kept_points",
        is_new.alias("is_new"),
        F.when(is_new, F.col("first_size")).otherwise(F.col("first_size") + F.col("group_size")).alias("members"),
    )
    # rows repeated with one id and length are numbered, the first of them stays
    rows = narrow.groupBy("text_sha256", "doc_id", "n_points").agg(F.count(F.lit(1)).alias("copies"))
    stays = F.col("is_new") & F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("n_points") == F.col("kept_points"))
    return (
        rows.join(decided, "text_sha256")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
        .select(
            "doc_id",
            F.col("kept_id").alias("keep_id"),
            F.col("members").alias("group_size"),
            (stays & (F.col("copy") == 1)).alias("kept"),
            "text_sha256",
        )
    )


def new_documents(docs: DataFrame, index: DigestIndex, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``deduplicate`` keeps, all columns as they are:
    one row per digest that the index does not have yet. Their digests are
    appended to ``index``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    row_id = F.col(id_col).cast("bigint")
    order = F.struct((-F.length(text)).alias("less"), row_id.isNull().alias("no_id"), row_id.alias("id"))
    keyed = docs.select(text_digest(F.col(text_col)).alias("text_sha256"), order.alias("order"), F.struct(*docs.columns).alias("row"))
    best = keyed.groupBy("text_sha256").agg(
        F.min_by("row", "order").alias("row"), F.min("order").alias("order"), F.count(F.lit(1)).alias("group_size")
    )
    fresh = materialize(best.join(index.rows().select("text_sha256").hint("merge"), "text_sha256", "left_anti"), "fresh")
    index.append(
        fresh.select(
            "text_sha256",
            F.col("order.id").alias("keep_id"),
            (-F.col("order.less")).cast("int").alias("keep_points"),
            "group_size",
            F.lit(uuid.uuid4().hex).alias("batch"),
        )
    )
    return fresh.select("row.*")
