"""Best-fit packing of token pieces into sequences of one length.

Partitions pack their pieces by best fit (longest first), put out the nearly
full bins and pass the others on as items; these are regrouped into fewer, still
bounded groups and packed again, until one group holds them all or regrouping
no longer fills bins. A group never has more than ``MAX_GROUP_ITEMS`` items, so
no task or driver gathers what grows with the data.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.bpe import load_json
from kindred.session import materialize

CAPACITY = 2048
END_ID = 0
#: Bins with at most so many free places are put out at once.
NEARLY_FULL = 8
MAX_GROUP_ITEMS = 200_000
FAN_IN = 8
#: A round over several groups that fills less than this share of its bins is the last.
LEAST_PROGRESS = 0.02

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACED = "item bigint, bin bigint, offset bigint, fill bigint"


def best_fit(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit, longest first: (bin, offset) of each item, and each bin's fill.

    Bins are kept by their free places; a number with one bit per amount of free
    places finds the fullest bin that still takes the item.
    """
    bins = np.zeros(len(sizes), np.int64)
    offsets = np.zeros(len(sizes), np.int64)
    fills: list[int] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    free_bits = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = free_bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            own = open_bins[free].pop()
            if not open_bins[free]:
                free_bits ^= 1 << free
        else:
            free, own = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = own, fills[own]
        fills[own] += size
        left = free - size
        if left:
            open_bins[left].append(own)
            free_bits |= 1 << left
    return bins, offsets, np.array(fills, np.int64)


def _pack(items: np.ndarray, sizes: np.ndarray) -> pd.DataFrame:
    """item, bin, offset, fill; a bin has the number of its first item, so numbers are unique without a counter."""
    bins, offsets, fills = best_fit(sizes)
    names = np.zeros(len(fills), np.int64)
    first = offsets == 0
    names[bins[first]] = items[first]
    return pd.DataFrame({"item": items, "bin": names[bins], "offset": offsets, "fill": fills[bins]})


def pieces_of(docs: DataFrame, tokenizer_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``CAPACITY`` tokens, and ``item``, a number per piece.

    A document is its ids and the end id; of one that is cut, the first piece
    takes what is over. Ids are those of the tokenizer file, which recognises its
    added tokens in the text.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load_json(tokenizer_path, pattern)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].array, batch["text"]):
                data = bpe.encode_with_added(text or "") + end
                n = len(data) // 4
                start = 0
                for piece in range(-(-n // CAPACITY)):
                    length = (n - 1) % CAPACITY + 1 if piece == 0 else CAPACITY
                    rows.append((doc_id, piece, start, length, zlib.crc32(data[4 * start : 4 * (start + length)])))
                    start += length
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInPandas(cut, PIECES).withColumn("item", F.monotonically_increasing_id())


def _local_round(items: DataFrame) -> DataFrame:
    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        n = 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= MAX_GROUP_ITEMS:
                block = pd.concat(held)
                yield _pack(block["item"].to_numpy(), block["size"].to_numpy())
                held, n = [], 0
        if n:
            block = pd.concat(held)
            yield _pack(block["item"].to_numpy(), block["size"].to_numpy())

    return items.mapInPandas(packed, PLACED)


def _group_round(items: DataFrame, groups: int, seed: int) -> DataFrame:
    def packed(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("item")
        return _pack(group["item"].to_numpy(), group["size"].to_numpy())

    dealt = items.withColumn("g", F.pmod(F.xxhash64("item", F.lit(seed)), F.lit(groups)))
    return dealt.groupBy("g").applyInPandas(packed, PLACED)


def pack(pieces: DataFrame) -> DataFrame:
    """``pieces`` (with item and length) with sequence_id and offset.

    Rounds read what the round before wrote, so a lost executor repeats its own
    tasks only and numbers stay as they are.
    """
    full = pieces.filter(F.col("length") == CAPACITY).withColumn("sequence_id", F.col("item")).withColumn("offset", F.lit(0).cast("bigint"))
    short = pieces.filter(F.col("length") < CAPACITY)
    placed = materialize(_local_round(short.select("item", F.col("length").alias("size"))), "packed")
    # where each piece is so far, and the bins that are still open
    where = placed.select("item", "bin", "offset")
    groups, seed = max(2, placed.rdd.getNumPartitions()), 0
    while True:
        is_open = F.col("fill") < CAPACITY - NEARLY_FULL
        open_bins = placed.filter(is_open & (F.col("offset") == 0)).select(F.col("bin").alias("item"), F.col("fill").alias("size"))
        n_open = open_bins.count()
        if n_open < 2:
            break
        groups, before = max(1, -(-groups // FAN_IN), -(-n_open // MAX_GROUP_ITEMS)), groups
        seed += 1
        placed = materialize(_group_round(open_bins, groups, seed), "packed")
        moved = placed.select(F.col("item").alias("bin"), F.col("bin").alias("new_bin"), F.col("offset").alias("shift"))
        where = materialize(
            where.join(moved, "bin", "left").select(
                "item",
                F.coalesce("new_bin", "bin").alias("bin"),
                (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
            ),
            "places",
        )
        if groups == 1:
            break
        if groups == before:
            n_left = placed.filter(F.col("offset") == 0).count()
            if n_left > (1 - LEAST_PROGRESS) * n_open:
                break
    located = short.join(where.withColumnRenamed("bin", "sequence_id"), "item")
    return located.select(*full.columns).unionByName(full)


def pack_documents(docs: DataFrame, tokenizer_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document.

    Defined cases: a null or empty text is the end id alone; a null id is kept;
    rows repeated are packed each; pieces of equal length are packed in row
    order; an empty table gives no rows; other columns are not read.
    """
    pieces = materialize(pieces_of(docs, tokenizer_path, pattern, id_col=id_col, text_col=text_col), "pieces")
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
