"""Text sources with deterministic row numbers.

Every reader returns ``pos`` (dense number in scan order, from 0), ``row_id``
(the id a row gets when files are read in chunks, see ``read_parquet_texts``),
``chunk_id`` and ``text``. Parquet rows are numbered from file metadata in closed
form: one count per file is windowed, rows are neither sorted nor shuffled. Lines
are written once with their place in the split that read them and numbered from
the written rows, so numbers cannot depend on how a second scan is split; where
blank lines are left out, the rest is numbered again inside each split.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindred import config
from kindred.functions.text import as_text
from kindred.operators.sizes import shipped
from kindred.session import materialize

# The white space that stripping a whole text removes.
_SPACE = r"[\s\u001c-\u001f\u0085\p{Z}]"


def load_texts(
    spark: SparkSession,
    *,
    parquet: str | None = None,
    text: str | None = None,
    text_column: str = config.PARQUET_TEXT_COLUMN,
    limit: int = config.ALL_ROWS,
    chunk_rows: int = config.PARQUET_CHUNK_ROWS,
    null_text: str | None = None,
    keep_blank: bool = False,
) -> tuple[DataFrame, str]:
    """(texts, description of the source). A Parquet path wins over a text path."""
    if parquet is not None:
        files = parquet_reader(spark, parquet).inputFiles()
        texts = read_parquet_texts(
            spark, parquet, text_column, limit=limit, chunk_rows=chunk_rows, null_text=null_text
        )
        name = parquet.rstrip("/").rsplit("/", 1)[-1]
        many = f" ({len(files)} files)" if not files[0].rstrip("/").endswith(f"/{name}") else ""
        return texts, f"Parquet: {name}{many}"
    if text is not None:
        return read_line_texts(spark, text, limit=limit, keep_blank=keep_blank), f"text file: {text.rsplit('/', 1)[-1]}"
    raise ValueError("give a parquet path or a text path")


def parquet_reader(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet file, or the ``*.parquet`` files of one folder level."""
    paths = [path] if isinstance(path, str) else path
    try:
        return spark.read.option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "false").parquet(*paths)
    except AnalysisException as error:
        raise FileNotFoundError(f"no parquet files at {paths}: {error}") from error


def inline_texts(spark: SparkSession, texts: list[str]) -> DataFrame:
    """Texts typed in by hand, in their order."""
    return _as_source(spark.createDataFrame(list(enumerate(texts)), "pos bigint, text string"))


def check_text_column(df: DataFrame, text_column: str) -> None:
    if text_column not in df.columns:
        raise ValueError(f"no column '{text_column}'; available columns: {', '.join(df.columns)}")


def file_offsets(df: DataFrame, chunk_rows: int) -> DataFrame:
    """Per file, in path order: rows and chunks in the files before it. Reads
    no data columns; one row per file."""
    counts = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        "file",
        "n_rows",
        F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(F.ceil(F.col("n_rows") / chunk_rows)).over(before), F.lit(0)).alias("chunks_before"),
    )


def read_parquet_texts(
    spark: SparkSession,
    path: str | list[str],
    text_column: str = config.PARQUET_TEXT_COLUMN,
    *,
    limit: int = config.ALL_ROWS,
    chunk_rows: int = config.PARQUET_CHUNK_ROWS,
    null_text: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Texts of Parquet files in file-name order.

    Chunks of ``chunk_rows`` rows do not cross files, so the last chunk of a
    file may be short; ``row_id = chunk_id * chunk_rows + place in chunk``
    leaves gaps there, ``pos`` does not. With a ``limit`` the files behind it
    are not opened.
    """
    df = parquet_reader(spark, path)
    check_text_column(df, text_column)
    n_files = len(df.inputFiles())
    if n_files == 1:
        located = _located(df, text_column, keep).withColumns({"rows_before": F.lit(0), "chunks_before": F.lit(0)})
    else:
        offsets = file_offsets(df, chunk_rows)
        if limit > 0:
            # a limited scan touches a prefix of the file list; files behind it are pruned
            last = offsets.filter(F.col("rows_before") < limit).agg(F.max("file")).first()[0]
            df = df.filter(F.col("_metadata.file_path") <= F.lit(last))
        located = _located(df, text_column, keep).join(shipped(offsets.drop("n_rows"), n_files), "file")
    chunk_id = F.col("chunks_before") + F.floor(F.col("row_in_file") / chunk_rows)
    numbered = located.select(
        (F.col("rows_before") + F.col("row_in_file")).cast("bigint").alias("pos"),
        (chunk_id * chunk_rows + F.col("row_in_file") % chunk_rows).cast("bigint").alias("row_id"),
        chunk_id.cast("bigint").alias("chunk_id"),
        as_text(F.col("text"), null_text).alias("text"),
        *keep,
    )
    return numbered.filter(F.col("pos") < limit) if limit > 0 else numbered


def _located(df: DataFrame, text_column: str, keep: tuple[str, ...]) -> DataFrame:
    return df.select(
        F.col(text_column).alias("text"),
        *keep,
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row_in_file"),
    )


def read_line_texts(
    spark: SparkSession, path: str, *, limit: int = config.ALL_ROWS, keep_blank: bool = False
) -> DataFrame:
    """Lines of text files, in file order.

    The text as a whole is stripped first: white space lines at both ends go,
    the first line loses leading and the last one trailing white space. Blank
    lines in between are dropped unless ``keep_blank``; an empty source then
    still has one empty line. ``limit`` counts the lines that stay.
    """
    lines = _numbered_lines(spark, path)
    solid = F.regexp_replace("value", f"(?U)^{_SPACE}+", "") != ""
    edges = lines.filter(solid).agg(F.min("pos").alias("first"), F.max("pos").alias("last")).first()
    if edges["first"] is None:
        blank = spark.createDataFrame([(0, "")] if keep_blank else [], "pos bigint, text string")
        return _as_source(blank)
    first, last = F.lit(edges["first"]), F.lit(edges["last"])
    text = F.col("value")
    text = F.when(F.col("pos") == first, F.regexp_replace(text, f"(?U)^{_SPACE}+", "")).otherwise(text)
    text = F.when(F.col("pos") == last, F.regexp_replace(text, f"(?U){_SPACE}+$", "")).otherwise(text)
    kept = lines.filter(F.col("pos").between(first, last)).select("pos", text.alias("text"), "file", "split")
    if keep_blank:
        kept = kept.withColumn("pos", F.col("pos") - first)
    else:
        kept = _renumbered(kept.filter(F.col("text") != ""))
    return _as_source(kept.filter(F.col("pos") < limit) if limit > 0 else kept)


def _as_source(lines: DataFrame) -> DataFrame:
    return lines.select("pos", F.col("pos").alias("row_id"), F.lit(0).cast("bigint").alias("chunk_id"), "text")


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their number over all files. The generated id rises by one
    per line inside a file split, so a line's number is the lines before its
    split plus its distance from the split's first id. Lines and ids are written
    by one scan: another scan may split the files differently."""
    scanned = (
        spark.read.option("recursiveFileLookup", "false")
        .text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("line"),
        )
    )
    lines = materialize(scanned, "lines")
    splits = _with_rows_before(
        lines.groupBy("file", "split").agg(F.min("line").alias("first_line"), F.count(F.lit(1)).alias("n"))
    )
    place = F.col("rows_before") + F.col("line") - F.col("first_line")
    numbered = lines.join(shipped(splits, splits.count()), ["file", "split"])
    return numbered.select(place.cast("bigint").alias("pos"), "value", "file", "split")


def _renumbered(lines: DataFrame) -> DataFrame:
    """Dense positions after lines were left out: numbered inside each split
    (whose size is bounded by the reader) behind the counts of the splits before."""
    splits = _with_rows_before(lines.groupBy("file", "split").agg(F.count(F.lit(1)).alias("n")))
    inside = Window.partitionBy("file", "split").orderBy("pos")
    placed = lines.withColumn("place", F.row_number().over(inside) - 1)
    numbered = placed.join(shipped(splits, splits.count()), ["file", "split"])
    return numbered.select((F.col("rows_before") + F.col("place")).cast("bigint").alias("pos"), "text")


def _with_rows_before(splits: DataFrame) -> DataFrame:
    """Written once: one row per file split, read by every later step."""
    before = Window.orderBy("file", "split").rowsBetween(Window.unboundedPreceding, -1)
    summed = splits.withColumn("rows_before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return materialize(summed, "splits")
