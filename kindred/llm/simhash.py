"""Near-duplicates by SimHash, found through an index over byte positions.

Two fingerprints of eight bytes that differ in at most three bits agree in at
least five byte positions. The index therefore lists every fingerprint under
fourteen keys, each the bytes at four positions: any five of eight positions
hold one of these position sets, so no pair can miss, and a pair that agrees in
k positions meets under a number of keys that depends on k alone. In a key of
two members the agreeing positions of the pair are tallied, a pair below five is
put aside and the others verified bit by bit. In larger keys nothing is tallied:
bits are counted for all pairs, or neighbours are looked up; the results are the
same, as pairs within three bits agree in five positions anyway.

Copies are folded before the index: it holds distinct fingerprints. A key puts
out at most one link per fingerprint (to the smallest one it reaches inside the
key), never its pairs; the components of these links are those of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.components import connected_components
from kindred.session import materialize

SHINGLE = 3
SEED = 42
MAX_BITS = 3
N_BYTES = 8
LEAST_MATCHES = N_BYTES - MAX_BITS
#: Members of a key up to which pairs are compared directly; beyond it the
#: neighbours of each member are looked up, which costs the same for each.
DIRECT_MEMBERS = 4_096


def position_sets() -> list[tuple[int, ...]]:
    """Fourteen sets of four positions such that every five positions contain one:
    both halves, and pairs of the first half with pairs of the second that stand
    in the same of the three ways to halve four into pairs."""
    low, high = (0, 1, 2, 3), (4, 5, 6, 7)
    ways = [((0, 1), (2, 3)), ((0, 2), (1, 3)), ((0, 3), (1, 2))]
    mixed = [(*(low[i] for i in a), *(high[i] for i in b)) for way in ways for a in way for b in way]
    return [low, high, *mixed]


def _mask(positions: tuple[int, ...]) -> int:
    return sum(0xFF << (8 * p) for p in positions)


def fingerprint(text: str) -> int:
    """The unsigned 64-bit fingerprint of a whole text; zero without words."""
    words = text.encode("utf-8").lower().split()  # bytes: only A-Z, only the six ASCII blanks
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    # the words once more, in one buffer, so that a shingle is a slice of it
    buffer = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    n_shingles = len(words) - SHINGLE + 1
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    for lo in range(0, n_shingles, 65_536):
        hi = min(lo + 65_536, n_shingles)
        pairs = zip(starts[lo:hi].tolist(), ends[lo + SHINGLE - 1 : hi + SHINGLE - 1].tolist())
        hashes = np.fromiter((digest(buffer[a:b], SEED) for a, b in pairs), "<u8", hi - lo)
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n_shingles, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed long) of every row."""

    def marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.array([fingerprint(text or "") for text in batch["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": found.view(np.int64)})

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInPandas(marked, "doc_id bigint, fp bigint")


def _neighbour_masks(free_bits: list[int]) -> np.ndarray:
    return np.array([sum(1 << b for b in bits) for n in range(1, MAX_BITS + 1) for bits in combinations(free_bits, n)], np.uint64)


def _verified(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the pairs agree in enough byte positions and differ in few enough bits."""
    differ = a ^ b
    matches = (np.ascontiguousarray(differ).view(np.uint8).reshape(*differ.shape, 8) == 0).sum(axis=-1)
    near = matches >= LEAST_MATCHES
    near[near] = np.bitwise_count(differ[near]) <= MAX_BITS
    return near


def _near_labels_direct(fps: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Each member's smallest label among itself and the members near to it."""
    out = label.copy()
    step = max(1, 2_000_000 // len(fps))
    for lo in range(0, len(fps), step):
        differ = fps[lo : lo + step, None] ^ fps[None, :]
        near = np.bitwise_count(differ) <= MAX_BITS
        out[lo : lo + step] = np.where(near, label[None, :], len(fps)).min(axis=1)
    return out


def _near_labels_lookup(fps: np.ndarray, label: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """The same, each neighbour being looked up among the sorted members."""
    out = label.copy()
    for m in masks:
        other = fps ^ m
        at = np.searchsorted(fps, other)
        at[at == len(fps)] = 0
        hit = np.nonzero(fps[at] == other)[0]
        out[hit] = np.minimum(out[hit], label[at[hit]])
    return out


def _member_links(fps: np.ndarray, mask: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links of the sorted members of a key: each to the smallest one that chains
    of near members lead to. Labels are passed on until nothing changes."""
    masks = _neighbour_masks([b for b in range(64) if not mask >> b & 1]) if len(fps) > DIRECT_MEMBERS else None
    label = np.arange(len(fps))
    while True:
        new = _near_labels_direct(fps, label) if masks is None else _near_labels_lookup(fps, label, masks)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = np.nonzero(label != np.arange(len(fps)))[0]
    return [(fps[moved], fps[label[moved]])] if len(moved) else []


def _key_links(fps: np.ndarray, mask: int) -> list[tuple[np.ndarray, np.ndarray]]:
    if len(fps) == 2:
        return [(fps[:1], fps[1:])] if _verified(fps[:1], fps[1:])[0] else []
    return _member_links(fps, mask)


def links(distinct: DataFrame) -> DataFrame:
    """a, b: links between the distinct fingerprints ``fp`` whose components are
    those of all pairs of at most three differing bits."""
    masks = [_mask(p) for p in position_sets()]
    signed = [int(np.uint64(m).astype(np.int64)) for m in masks]
    keyed = distinct.select(
        "fp",
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("s"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes")) for i, m in enumerate(signed)])
        ).alias("k"),
    ).select("k.s", "k.bytes", "fp")

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

        def emit(s: np.ndarray, key: np.ndarray, fp: np.ndarray, last: bool):
            """Links of the finished keys, and the rows of the one that may go on."""
            ends = np.nonzero((s[1:] != s[:-1]) | (key[1:] != key[:-1]))[0] + 1
            edges = np.concatenate([[0], ends, [len(s)]])
            if not last:
                kept = (s[edges[-2] :], key[edges[-2] :], fp[edges[-2] :])
                edges = edges[:-1]
            else:
                kept = None
            out = []
            sizes = np.diff(edges)
            # keys of two members, all at once
            two = edges[:-1][sizes == 2]
            x, y = fp[two], fp[two + 1]
            near = _verified(x, y)
            if near.any():
                out.append((x[near], y[near]))
            for k in np.nonzero(sizes > 2)[0]:
                members = np.sort(fp[edges[k] : edges[k + 1]])
                out += _key_links(members, masks[int(s[edges[k]])])
            return out, kept

        for batch in batches:
            s = batch["s"].to_numpy()
            key = batch["bytes"].to_numpy()
            fp = batch["fp"].to_numpy().view(np.uint64)
            if rest is not None:
                s, key, fp = (np.concatenate(pair) for pair in zip(rest, (s, key, fp)))
            if not len(s):
                continue
            out, rest = emit(s, key, fp, last=False)
            if out:
                a, b = (np.concatenate(side) for side in zip(*out))
                yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})
        if rest is not None:
            out, _ = emit(*rest, last=True)
            if out:
                a, b = (np.concatenate(side) for side in zip(*out))
                yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return keyed.repartition("s", "bytes").sortWithinPartitions("s", "bytes").mapInPandas(linked, "a bigint, b bigint")


def _named(distinct: DataFrame) -> DataFrame:
    """fp, root (its component's smallest fingerprint) of every distinct fingerprint."""
    components = connected_components(links(distinct))
    return distinct.join(components.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row.

    Two rows are linked if their fingerprints differ in at most three bits;
    component_id is the smallest id of all rows that links lead to.

    Defined cases: a null text has no words, and all texts without words have
    fingerprint zero and are linked. Rows with a null id are linked like others
    but never name a component, unless no row of it has an id (then null).
    Repeated rows come back each. An empty table gives no rows. Other columns
    are not read.
    """
    marked = materialize(fingerprints(docs, id_col=id_col, text_col=text_col), "fingerprints")
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    # least id of each component, then of each fingerprint
    rooted = materialize(_named(distinct), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(rooted.join(least, "root").select("fp", "component_id"), "components")
    # one row per fingerprint against all rows: a hot one is split by the adaptive join
    return marked.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` of each group of near-duplicates, the one with the
    smallest id, all columns as they are. A row without an id stays only where
    its group has no other.

    Only ids and fingerprints are written. Where ids are unique they alone find
    the rows that stay; else the rows' fingerprints are taken again."""
    text = F.pandas_udf(_fingerprint_column, "bigint")
    row_id = F.col(id_col).cast("bigint")
    wide = docs.select(row_id.alias("id"), text(F.coalesce(F.col(text_col), F.lit(""))).alias("fp"), F.struct(*docs.columns).alias("row"))
    marked = materialize(wide.select("id", "fp"), "marked")
    repeated = marked.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or id is null").limit(1).count()
    first = F.struct(F.col("id").isNull().alias("no_id"), "id")
    distinct = materialize(marked.groupBy("fp").agg(F.min(first).alias("first")), "distinct")
    rooted = _named(distinct)
    keep = rooted.groupBy("root").agg(F.min(F.struct("first", "fp")).alias("k")).select(F.col("k.fp").alias("fp"), F.col("k.first.id").alias("keep_id"))
    if not repeated:
        rows = docs.select(row_id.alias("keep_id"), F.struct(*docs.columns).alias("row"))
        return rows.join(keep, "keep_id", "left_semi").select("row.*")
    kept = wide.join(keep, (wide.fp == keep.fp) & wide.id.eqNullSafe(keep.keep_id)).select(wide.fp, "row")
    return kept.dropDuplicates(["fp"]).select("row.*")


def _fingerprint_column(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(text) for text in texts], np.uint64).view(np.int64))
