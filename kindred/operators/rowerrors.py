"""Rows that a mapping cannot take: fail the load, or put them aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.sources.mapping import conform

ROW_ERROR_MODES = ("fail", "deadletter")


def _bad_fields(df: DataFrame, schema: T.StructType) -> Column:
    """Names of the plain fields whose value is given but has no form in the mapping's type."""
    checks = [
        F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
        for f in schema.fields
        if f.name in df.columns and isinstance(f.dataType, T.AtomicType)
    ]
    return F.filter(F.array(*checks), lambda name: name.isNotNull()) if checks else F.array().cast("array<string>")


def conform_rows(df: DataFrame, schema: T.StructType, *, on_row_error: str = "fail") -> tuple[DataFrame, DataFrame]:
    """(rows cast to the mapping, rejected rows as they came with ``bad_fields``).

    ``fail`` stops the job at the first row that does not fit, which is the rule
    for document loads; ``deadletter`` loads the others and hands the row over,
    which is the rule for links. Row-local; nothing is shuffled.
    """
    if on_row_error not in ROW_ERROR_MODES:
        raise ValueError(f"on_row_error is one of {', '.join(ROW_ERROR_MODES)}")
    marked = df.withColumn("bad_fields", _bad_fields(df, schema))
    rejected = marked.filter(F.size("bad_fields") > 0)
    if on_row_error == "fail":
        message = F.concat(F.lit("row does not fit the mapping in "), F.array_join("bad_fields", ", "))
        checked = marked.filter(F.when(F.size("bad_fields") == 0, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
        return conform(checked.drop("bad_fields"), schema), rejected.limit(0)
    return conform(marked.filter(F.size("bad_fields") == 0).drop("bad_fields"), schema), rejected
