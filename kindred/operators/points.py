"""Points and documents put together from separate frames by position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred import config


def assemble_points(
    vectors: DataFrame,
    *,
    texts: DataFrame | None = None,
    ids: DataFrame | None = None,
    payloads: DataFrame | None = None,
    start_id: int = 0,
    payload_key: str = config.PAYLOAD_KEY,
) -> DataFrame:
    """``point_id, vector, payload``. Every frame has ``pos`` and its value;
    frames of another length than the vectors are an error. Without ``ids``
    points are numbered from ``start_id``, without ``payloads`` the text is the
    payload."""
    if texts is None and payloads is None:
        raise ValueError("give texts or payloads")
    joined = _paired(vectors, {"texts": None if payloads is not None else texts, "ids": ids, "payloads": payloads})
    point_id = F.col("point_id") if ids is not None else F.col("pos") + F.lit(start_id)
    payload = F.col("payload") if payloads is not None else F.create_map(F.lit(payload_key), F.col("text"))
    return joined.select(point_id.alias("point_id"), "vector", payload.alias("payload"))


def assemble_documents(
    documents: DataFrame, *, ids: DataFrame | None = None, start_id: int = 0
) -> DataFrame:
    """``_id`` as string and the body columns of ``documents`` (which has ``pos``)."""
    joined = _paired(documents, {"ids": ids})
    key = F.col("_id") if ids is not None else F.col("pos") + F.lit(start_id)
    body = [c for c in documents.columns if c != "pos"]
    return joined.select(key.cast("string").alias("_id"), *body)


def _paired(first: DataFrame, others: dict[str, DataFrame | None]) -> DataFrame:
    given = {name: df for name, df in others.items() if df is not None}
    n = first.count() if given else 0
    joined = first
    for name, df in given.items():
        n_other = df.count()
        if n_other != n:
            raise ValueError(f"{name} has {n_other} rows, expected {n}")
        joined = joined.join(df, "pos")
    n_joined = joined.count() if given else n
    if n_joined != n:
        raise ValueError(f"{n_joined} of {n} positions have a partner in {' and '.join(given)}")
    return joined
