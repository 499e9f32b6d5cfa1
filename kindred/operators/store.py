"""Keyed merges on tables: upsert, partial update, delete, change log.

Tables are unique by key. Changes are reduced to one row per key with
partially aggregated ``max_by`` first, so a key with very many changes is
folded map-side. The reduced set is written once and counted: while it is
small it is shipped to the base table, which then is neither shuffled nor
sorted; beyond that the joins shuffle by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.operators.sizes import MAX_DOCUMENT_ROWS, shipped
from kindred.session import materialize


def latest_per_key(changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The row with the highest ``order`` of every key (last write wins)."""
    body = [c for c in changes.columns if c != key]
    newest = F.max_by(F.struct(*body), F.struct(*order))
    return changes.groupBy(key).agg(newest.alias("_row")).select(key, "_row.*")


def upsert(base: DataFrame, changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``base`` with the newest change per key inserted or put in its place."""
    newest = materialize(latest_per_key(changes, key, order).select(*base.columns), "newest")
    return base.join(shipped(newest.select(key), newest.count()), key, "left_anti").unionByName(newest)


def delete_ids(base: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``base`` without the given ids; unknown ids are ignored."""
    gone = ids.select(key).distinct()
    return base.join(shipped(gone, gone.count()), key, "left_anti")


def partial_update(base: DataFrame, updates: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Set the given fields of existing rows.

    ``updates`` holds the key, the ``order`` columns, fields of ``base`` and
    optionally ``given`` (names of the fields a row sets, nulls included);
    without it the non-null fields are the given ones. Of several updates the
    newest one that gives a field decides it. Keys that are not in ``base``
    have no effect, see ``unmatched_updates``.
    """
    fields = [c for c in updates.columns if c in base.columns and c != key]
    folded = updates.groupBy(key).agg(*[_newest_given(updates, f, order).alias(f"_{f}") for f in fields])
    folded = materialize(folded, "updates")
    joined = base.join(shipped(folded, folded.count(), MAX_DOCUMENT_ROWS), key, "left")
    return joined.select(
        *[
            F.when(F.col(f"_{c}").isNotNull(), F.col(f"_{c}.value")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c)
            for c in base.columns
        ]
    )


def unmatched_updates(base: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Updates whose key is not in the table (an error in the source system)."""
    return updates.join(base.select(key), key, "left_anti")


def _newest_given(updates: DataFrame, field: str, order: list[str]) -> Column:
    given = F.array_contains("given", field) if "given" in updates.columns else F.col(field).isNotNull()
    wrapped = F.struct(F.col(field).alias("value"))
    return F.max_by(F.when(given, wrapped), F.when(given, F.struct(*order)))


def fold_changes(base: DataFrame, log: DataFrame, key: str, seq: str, fields: list[str]) -> DataFrame:
    """State of ``base`` after a log of ``op`` = index / update / delete.

    ``index`` replaces the whole document, ``delete`` removes it, ``update``
    sets the fields listed in ``given``. One pass: an index or delete gives
    every field (a delete gives nulls), so the newest giver of each field is
    its value, and the newest index or delete tells whether the document
    exists. Updates that met no document have no effect.
    """
    reset = F.col("op").isin("index", "delete")
    aggregates = [F.max_by(F.when(reset, F.col("op")), F.when(reset, F.col(seq))).alias("_reset")]
    for f in fields:
        gives = reset | F.array_contains("given", f)
        value = F.struct(F.when(F.col("op") != "delete", F.col(f)).alias("value"))
        aggregates.append(F.max_by(F.when(gives, value), F.when(gives, F.col(seq))).alias(f"_{f}"))
    folded = materialize(log.groupBy(key).agg(*aggregates), "folded")
    stored = base.withColumn("_stored", F.lit(True))
    n_folded = folded.count()
    if n_folded <= MAX_DOCUMENT_ROWS:
        # the base stays in place: changed rows by a broadcast, new keys from the log side
        known = base.select(key).join(F.broadcast(folded.select(key)), key, "left_semi")
        new = folded.join(shipped(known, n_folded), key, "left_anti")
        joined = stored.join(F.broadcast(folded), key, "left").unionByName(new, allowMissingColumns=True)
    else:
        joined = stored.join(folded, key, "full")
    lives = F.coalesce(F.col("_reset") == "index", F.col("_stored"), F.lit(False))
    merged = [
        F.when(F.col(f"_{f}").isNotNull(), F.col(f"_{f}.value")).otherwise(F.col(f)).alias(f) if f in fields else F.col(f)
        for f in base.columns
    ]
    return joined.filter(lives).select(*merged)


def rejected_updates(base: DataFrame, log: DataFrame, key: str, seq: str, *, seq_per_part: int = 1_000_000) -> DataFrame:
    """Updates of the log that met no document when it was their turn.

    The state before a change is the last index or delete ahead of it. The
    log of a key is cut into ranges of ``seq``; the last reset of each range
    is carried over in a small window, so the changes of one busy key spread
    over many tasks instead of one long window.
    """
    part = F.floor(F.col(seq) / seq_per_part)
    is_reset = F.col("op").isin("index", "delete")
    cut = log.withColumn("_part", part).withColumn("_reset", F.when(is_reset, F.col("op")))
    by_key = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        cut.groupBy(key, "_part")
        .agg(F.max_by(F.when(is_reset, F.col("op")), F.when(is_reset, F.col(seq))).alias("_last"))
        .select(key, "_part", F.last("_last", ignorenulls=True).over(by_key).alias("_carried"))
    )
    inside = Window.partitionBy(key, "_part").orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    seen = cut.withColumn("_before", F.last("_reset", ignorenulls=True).over(inside)).join(carried, [key, "_part"])
    state = seen.withColumn("_state", F.coalesce("_before", "_carried")).filter(F.col("op") == "update")
    stored = base.select(key).withColumn("_stored", F.lit(True))
    missing = (F.col("_state") == "delete") | (F.col("_state").isNull() & F.col("_stored").isNull())
    return state.join(stored, key, "left").filter(missing).select(*log.columns)
