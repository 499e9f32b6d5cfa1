"""The embedding stage: batches of texts through a pluggable model.

A model is given as a *factory*: it is called once per Python worker task and
returns ``list[str] -> array of shape (n, dim)``, so a session or weights are
loaded once and reused for all batches of the task.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred import config
from kindred.config import RetryPolicy

EmbedFn = Callable[[list[str]], np.ndarray]
EmbedFactory = Callable[[], EmbedFn]

# Fixed values of the built-in embedder: multipliers of the three characters of
# a gram, and the prime the sum is reduced by before the vector position.
GRAM_FACTORS = (73856093, 19349663, 83492791)
GRAM_PRIME = 1000003


class HashEmbedder:
    """Deterministic embedder without weights: counts of character 3-grams,
    hashed to ``dim`` positions and scaled to unit length. The text is framed
    by one space on each side and read as a whole."""

    def __init__(self, dim: int) -> None:
        self.dim = dim

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), dtype=np.float64)
        for i, text in enumerate(texts):
            codes = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
            a, b, c = GRAM_FACTORS
            grams = (codes[:-2] * a + codes[1:-1] * b + codes[2:] * c) % GRAM_PRIME % self.dim
            out[i] = np.bincount(grams, minlength=self.dim)
        norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
        return out / np.where(norm == 0, 1.0, norm)


def hash_embedder(dim: int) -> EmbedFactory:
    return lambda: HashEmbedder(dim)


def checked(vectors: np.ndarray, n: int, dim: int) -> np.ndarray:
    vectors = np.asarray(vectors)
    if vectors.shape != (n, dim):
        raise ValueError(f"the model returned shape {vectors.shape} for {n} texts and {dim} dimensions")
    return vectors.astype(np.float32)


def embed(
    df: DataFrame,
    text: str,
    factory: EmbedFactory,
    dim: int,
    *,
    prefix: str = config.ENCODE_PREFIX,
    batch_size: int = config.EMBED_BATCH_ROWS,
    out: str = "vector",
) -> DataFrame:
    """``df`` with the vector of ``prefix + text``; a null text has a null vector.

    Only the text column travels to Python, no shuffle; a model error fails the
    task (Spark retries it). See ``embed_outcomes`` for errors as data.
    """

    @F.arrow_udf(T.ArrayType(T.FloatType(), containsNull=False))
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = factory()
        for column in columns:
            texts, parts = column.drop_null(), []
            for s in range(0, len(texts), batch_size):
                some = [prefix + t for t in texts.slice(s, batch_size).to_pylist()]
                parts.append(checked(model(some), len(some), dim))
            yield _vectors(np.concatenate(parts) if parts else np.empty((0, dim), np.float32), column.is_valid())

    return df.withColumn(out, run(F.col(text)))


OUTCOME = T.StructType(
    [
        T.StructField("vector", T.ArrayType(T.FloatType())),
        T.StructField("status", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField(
            "errors",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("attempt", T.IntegerType()),
                        T.StructField("error_type", T.StringType()),
                        T.StructField("error_message", T.StringType()),
                        T.StructField("timestamp", T.TimestampType()),
                    ]
                )
            ),
        ),
        T.StructField("embed_ms", T.DoubleType()),
        T.StructField("finished_at", T.TimestampType()),
    ]
)


def embed_outcomes(
    df: DataFrame,
    factory: EmbedFactory,
    dim: int,
    *,
    text: str = "text",
    pos: str = "pos",
    prefix: str = config.ENCODE_PREFIX,
    batch_size: int = config.EMBED_BATCH_ROWS,
    retry: RetryPolicy = RetryPolicy(),
    whole_batches: bool = True,
) -> DataFrame:
    """One row per (pos, text) with what became of it, errors as data.

    A batch is ``batch_size`` consecutive positions (``batch_id`` is the first
    of them); it is tried as a whole, ``retry.max_attempts`` times, and all of
    its rows share the outcome. ``whole_batches`` shuffles rows by batch first,
    so a file split cannot cut a batch in two; without it batches are cut in
    scan order and nothing is shuffled. ``embed_ms`` stands on the first row of
    a batch only, so sums are right. Model calls are at-least-once: write the
    result before branching on it (see ``route_outcomes``).
    """
    rows = df.select(
        (F.floor(F.col(pos) / batch_size) * batch_size).cast("bigint").alias("batch_id"),
        F.col(pos).cast("bigint").alias("pos"),
        F.col(text).alias("text"),
    )
    if whole_batches:
        rows = rows.repartition("batch_id").sortWithinPartitions("batch_id", "pos")
    schema = T.StructType([*rows.schema.fields, *OUTCOME.fields])
    outcome_type = pa.struct(
        [
            ("attempt", pa.int32()),
            ("error_type", pa.string()),
            ("error_message", pa.string()),
            ("timestamp", pa.timestamp("us", tz="UTC")),
        ]
    )

    def tried(batch: pa.Table, model: EmbedFn) -> pa.Table:
        n = batch.num_rows
        texts = batch["text"].to_pylist()
        started = time.perf_counter()
        errors: list[dict] = []
        vectors = None
        attempt = 0
        while vectors is None and attempt < retry.max_attempts:
            attempt += 1
            try:
                vectors = checked(model([prefix + t for t in texts]), n, dim)
            except Exception as error:  # every model error is data here, and so is a null text
                errors.append(
                    {
                        "attempt": attempt,
                        "error_type": type(error).__name__,
                        "error_message": str(error),
                        "timestamp": datetime.now(timezone.utc),
                    }
                )
                if attempt < retry.max_attempts:
                    time.sleep(retry.wait_after(attempt))
        ms = [(time.perf_counter() - started) * 1000.0] + [0.0] * (n - 1)
        made = (
            _vectors(vectors, pa.array(np.ones(n, dtype=bool)))
            if vectors is not None
            else pa.nulls(n, pa.list_(pa.float32()))
        )
        columns = {
            "vector": made,
            "status": pa.array(["ok" if vectors is not None else "failed"] * n),
            "attempts": pa.array([attempt] * n, pa.int32()),
            "errors": pa.array([errors] * n, pa.list_(outcome_type)),
            "embed_ms": pa.array(ms),
            "finished_at": pa.array([datetime.now(timezone.utc)] * n, pa.timestamp("us", tz="UTC")),
        }
        for name, column in columns.items():
            batch = batch.append_column(name, column)
        return batch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = factory()
        held: pa.Table | None = None
        for incoming in batches:
            table = pa.Table.from_batches([incoming])
            table = table if held is None else pa.concat_tables([held, table])
            starts = [0, *(np.flatnonzero(np.diff(table["batch_id"].to_numpy())) + 1).tolist()]
            done = [tried(table.slice(a, b - a), model) for a, b in zip(starts, starts[1:])]
            held = table.slice(starts[-1])
            if done:
                yield from pa.concat_tables(done).combine_chunks().to_batches()
        if held is not None and held.num_rows:
            yield from tried(held, model).combine_chunks().to_batches()

    return rows.mapInArrow(run, schema)


def _vectors(matrix: np.ndarray, valid: pa.Array) -> pa.ListArray:
    """List column with one row of ``matrix`` per valid position, else null."""
    present = valid.to_numpy(zero_copy_only=False)
    offsets = np.zeros(len(present) + 1, dtype=np.int32)
    np.cumsum(present * matrix.shape[1], out=offsets[1:])
    mask = None if present.all() else pa.array(~present)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()), mask=mask)
