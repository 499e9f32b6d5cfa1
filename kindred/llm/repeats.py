"""Bytes covered by a 400-byte string that also starts elsewhere, by suffix order.

1. Every text is cut into runs of starts whose 400-byte strings have the same
   smallest code of 48 bytes (a minimizer). Equal strings have equal smallest
   codes, so only runs with a code that occurs twice can hold repeats; the others
   end here. Only codes and places are shuffled.
2. The bytes of the remaining runs go to partitions by code. Each bounded bucket of
   whole codes builds its collection's suffix order column by column
   (``collection_bwt``); starts that share 400 bytes with a neighbour are repeats.
   A task sends the bytes of equal runs once. A code with very many runs is dealt
   out further by three more minimizers of the same strings. A key that still has
   more text than a bucket sends a 128-bit code and the place of each start
   instead of texts; starts whose code has two places are repeats.
3. Repeated starts return to their texts by digest, and each text is cut.

Strings are judged on the input. A text that several rows have is covered whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.collection_bwt import BYTES, Strings, mixed, repeated_starts
from kindred.session import materialize, new_work_table

#: Starts in a run at most; longer runs (periodic text) are cut, which bounds the rounds of a bucket.
MAX_STARTS = 512
#: Runs of one code from which the code is dealt out further.
HOT_RUNS = 2_000
_SALTS = tuple(np.uint64(s) for s in (0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
#: Bytes of a bucket, and units of text that are hashed at once.
BUCKET_BYTES = 1 << 20
CHUNK_UNITS = 1 << 20
#: Equal runs that a task remembers at most.
REMEMBERED = 500_000

RUNS = "d binary, code bigint, start int, n int, weight int"
SEGMENTS = "key bigint, seg_hi bigint, seg_lo bigint, d binary, start int, n int, body binary"
START_CODES = "c_hi bigint, c_lo bigint, seg_hi bigint, seg_lo bigint, i int"
_SEGMENT_COLUMNS = [c.split()[0] for c in SEGMENTS.split(", ")]


def _sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    return x if n == width else np.minimum(x[: len(x) - (width - n)], x[width - n :])


def _runs(texts: list[np.ndarray], strings: Strings) -> tuple[np.ndarray, ...]:
    """(text, code, start, n, weight) of the runs of some texts of at least a
    string's units; weight is 2 if the code occurs again inside the run."""
    data = np.concatenate(texts)
    lengths = np.array([len(t) for t in texts], np.int64)
    n_starts = lengths - strings.length + 1
    codes = strings.codes(data, strings.gram)
    # every start whose string lies in one text, and the text it lies in
    first = np.cumsum(n_starts) - n_starts
    base = np.cumsum(lengths) - lengths
    at = np.arange(n_starts.sum()) + np.repeat(base - first, n_starts)
    least = _sliding_minimum(codes, strings.grams)[at]
    is_begin = np.ones(len(at), bool)
    is_begin[1:] = (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1)
    begins = np.flatnonzero(is_begin)
    sizes = np.diff(np.append(begins, len(at)))
    if (sizes > MAX_STARTS).any():
        parts = -(-sizes // MAX_STARTS)
        part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        begins = np.repeat(begins, parts) + MAX_STARTS * part
        sizes = np.diff(np.append(begins, len(at)))
    code = least[begins]
    windows = np.lib.stride_tricks.sliding_window_view(codes, strings.grams)
    weight = np.ones(len(begins), np.int32)
    head, tail = at[begins], at[begins + sizes - 1]
    for lo in range(0, len(begins), 4096):
        own = slice(lo, lo + 4096)
        leftmost = head[own] + (windows[head[own]] == code[own, None]).argmax(axis=1)
        rightmost = tail[own] + strings.grams - 1 - (windows[tail[own]][:, ::-1] == code[own, None]).argmax(axis=1)
        weight[own] += leftmost != rightmost
    text = np.repeat(np.arange(len(texts)), n_starts)[begins]
    return text, code.view(np.int64), (head - base[text]).astype(np.int32), sizes.astype(np.int32), weight


def _pieces(texts: list[np.ndarray], strings: Strings) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """(text, first start, units) in lists of bounded size. A longer text comes in
    pieces that overlap, so that each start lies in one piece with its whole string."""
    held: list[tuple[int, int, np.ndarray]] = []
    size = 0
    for i, units in enumerate(texts):
        n_starts = len(units) - strings.length + 1
        for lo in range(0, n_starts, CHUNK_UNITS):
            piece = units[lo : lo + CHUNK_UNITS + strings.length - 1]
            if held and size + len(piece) > CHUNK_UNITS:
                yield held
                held, size = [], 0
            held.append((i, lo, piece))
            size += len(piece)
    if held:
        yield held


def _find_runs(batches: Iterator[pd.DataFrame], strings: Strings = BYTES) -> Iterator[pd.DataFrame]:
    for batch in batches:
        digests = batch["d"].to_numpy()
        for lo in range(0, len(digests), 256):
            texts = [strings.units(t.encode()) for t in batch["text"].iloc[lo : lo + 256]]
            for held in _pieces(texts, strings):
                piece, code, start, n, weight = _runs([units for _, _, units in held], strings)
                first = np.array([at for _, at, _ in held], np.int32)
                text = np.array([i for i, _, _ in held])[piece] + lo
                yield pd.DataFrame({"d": digests[text], "code": code, "start": start + first[piece], "n": n, "weight": weight})


def _cut_segments(batches: Iterator[pd.DataFrame], strings: Strings = BYTES) -> Iterator[pd.DataFrame]:
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        rows = []
        for digest, text, runs in zip(batch["d"], batch["text"], batch["runs"]):
            units = strings.units(text.encode())
            for run in runs:
                start, n, code = run["start"], run["n"], run["code"]
                for key, a, k in _dealt_out(units, start, n, code, strings) if run["hot"] else ((code, start, n),):
                    body = units[a : a + k - 1 + strings.length].tobytes()
                    name = xxhash.xxh3_128_digest(body)
                    hi, lo = int.from_bytes(name[:8], "big", signed=True), int.from_bytes(name[8:], "big", signed=True)
                    if (hi, lo) in seen:
                        body = None
                    elif len(seen) < REMEMBERED:
                        seen.add((hi, lo))
                    rows.append((key, hi, lo, digest, a, k, body))
            if len(rows) >= 4096:
                yield pd.DataFrame(rows, columns=_SEGMENT_COLUMNS)
                rows = []
        if rows:
            yield pd.DataFrame(rows, columns=_SEGMENT_COLUMNS)


def _dealt_out(units: np.ndarray, start: int, n: int, code: int, strings: Strings) -> list[tuple[int, int, int]]:
    """The run's starts by three further minimizers: (key, start, n)."""
    codes = strings.codes(units[start : start + n - 1 + strings.length], strings.gram)
    key = np.full(n, code, np.int64).view(np.uint64)
    for salt in _SALTS:
        key = mixed(key * salt + _sliding_minimum(mixed(codes ^ salt), strings.grams))
    begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    ends = np.append(begins[1:], n)
    return [(int(k), start + int(a), int(b - a)) for k, a, b in zip(key[begins].view(np.int64), begins, ends)]


def _flat_runs(flags: np.ndarray) -> list[int]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges.tolist()


class _Bucket:
    """Distinct segments of whole keys, handed to the construction when enough."""

    def __init__(self, strings: Strings = BYTES):
        self.strings = strings
        self.bodies: dict[tuple[int, int], bytes] = {}
        self.size = 0

    def results(self) -> list[tuple[int, int, list[int]]]:
        names, bodies = list(self.bodies), list(self.bodies.values())
        flags = repeated_starts(bodies, self.strings)
        return [(*name, _flat_runs(own)) for name, own in zip(names, flags) if own.any()]


def _start_codes(batches: Iterator[pd.DataFrame], strings: Strings = BYTES) -> Iterator[pd.DataFrame]:
    """One row per start of each segment: the code of its string, and its place."""
    item = strings.item
    for batch in batches:
        hi, lo, bodies = batch["seg_hi"].to_numpy(), batch["seg_lo"].to_numpy(), batch["body"].to_numpy()
        for first in range(0, len(bodies), 256):
            own = bodies[first : first + 256]
            sizes = np.array([len(b) // item - strings.length + 1 for b in own])
            digest = xxhash.xxh3_128_digest
            joined = b"".join([digest(b[i * item : (i + strings.length) * item]) for b, n in zip(map(memoryview, own), sizes) for i in range(n)])
            codes = np.frombuffer(joined, ">i8").astype(np.int64).reshape(-1, 2)
            at = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            named = slice(first, first + 256)
            yield pd.DataFrame(
                {"c_hi": codes[:, 0], "c_lo": codes[:, 1], "seg_hi": np.repeat(hi[named], sizes), "seg_lo": np.repeat(lo[named], sizes), "i": at.astype(np.int32)}
            )


def _edges(found: pd.Series) -> pd.Series:
    """Sorted starts as the flat ends of their runs."""
    out = []
    for starts in found:
        starts = np.asarray(starts)
        begins = np.flatnonzero(np.diff(starts, prepend=starts[0] - 2) > 1)
        ends = np.append(begins[1:], len(starts)) - 1
        out.append(np.stack([starts[begins], starts[ends] + 1], axis=1).ravel().astype(np.int32))
    return pd.Series(out)


def _found_by_code(bodies: DataFrame, equal: DataFrame, strings: Strings) -> DataFrame:
    """seg_hi, seg_lo, found of segments, no matter how many share a key.

    Equal segments are known to be repeats as a whole, so their starts are looked
    at as places only. Both sides are dealt by code: places are reduced to two
    numbers in each task, and of the second side a hot code can be split, as the
    first has one row for it."""
    starts = bodies.mapInPandas(strings.bound(_start_codes), START_CODES)
    place = F.xxhash64("seg_hi", "seg_lo", "i")
    codes = starts.groupBy("c_hi", "c_lo").agg(F.min(place).alias("a"), F.max(place).alias("b")).filter("a != b").select("c_hi", "c_lo")
    single = bodies.join(equal.select("seg_hi", "seg_lo"), ["seg_hi", "seg_lo"], "left_anti").mapInPandas(strings.bound(_start_codes), START_CODES)
    edges = F.pandas_udf(_edges, "array<int>")
    return (
        single.join(codes, ["c_hi", "c_lo"])
        .groupBy("seg_hi", "seg_lo")
        .agg(F.array_sort(F.collect_set("i")).alias("i"))
        .select("seg_hi", "seg_lo", edges("i").alias("found"))
    )


def _suffix_order(batches: Iterator[pd.DataFrame], strings: Strings = BYTES) -> Iterator[pd.DataFrame]:
    bucket, group, key = _Bucket(strings), _Bucket(strings), None

    def close_group() -> list:
        """The finished key joins the bucket, or stands alone if it is large."""
        nonlocal bucket, group
        out: list = []
        if bucket.size and bucket.size + group.size > BUCKET_BYTES:
            out, bucket = bucket.results(), _Bucket(strings)
        bucket.bodies.update(group.bodies)
        bucket.size += group.size
        group = _Bucket(strings)
        return out

    def frame(rows: list) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["seg_hi", "seg_lo", "found"])

    for batch in batches:
        for row in batch.itertuples(index=False):
            if row.key != key:
                out = close_group()
                key = row.key
                if out:
                    yield frame(out)
            name = (row.seg_hi, row.seg_lo)
            if name not in group.bodies:
                group.bodies[name] = row.body
                group.size += len(row.body)
    out = close_group() + bucket.results()
    if out:
        yield frame(out)


def _digest(text: Column) -> Column:
    """128 bits of the text's SHA-256."""
    return F.unhex(F.substring(F.sha2(F.encode(text, "UTF-8"), 256), 1, 32))


def _distinct_texts(docs: DataFrame, text: Column, strings: Strings) -> DataFrame:
    """d, text, n_rows of the distinct texts that may hold a string, bucketed by d,
    so that neither of the two joins below shuffles texts."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, path = new_work_table(spark, "texts")
    (
        docs.select(text.alias("text"))
        .filter(F.octet_length("text") >= strings.least_bytes)
        .groupBy(_digest(F.col("text")).alias("d"))
        .agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("n_rows"))
        .write.format("parquet")
        .option("path", path)
        .option("compression", "zstd")
        .bucketBy(buckets, "d")
        .saveAsTable(name)
    )
    return spark.table(name)


def _repeated_runs(texts: DataFrame, strings: Strings) -> DataFrame:
    """d, runs: the repeated starts of every text that has some, as a flat array
    of start and number."""
    runs = materialize(texts.select("d", "text").mapInPandas(strings.bound(_find_runs), RUNS), "runs")
    # a code stands at two places if its smallest and its largest differ
    place = F.xxhash64("d", "start")
    codes = (
        runs.groupBy("code")
        .agg(F.min(place).alias("a"), F.max(place).alias("b"), F.max("weight").alias("w"), F.count(F.lit(1)).alias("n_runs"))
        .filter("a != b or w > 1")
        .select("code", (F.col("n_runs") > HOT_RUNS).alias("hot"))
    )
    lists = runs.join(codes, "code").groupBy("d").agg(F.collect_list(F.struct("start", "n", "code", "hot")).alias("runs"))
    cut = texts.select("d", "text").join(lists, "d")
    segments = materialize(cut.mapInPandas(strings.bound(_cut_segments), SEGMENTS), "segments")
    bodies = segments.filter("body is not null").select("key", "seg_hi", "seg_lo", "body")
    # keys with more text than a bucket, copies that several tasks sent included
    large = materialize(bodies.groupBy("key").agg(F.sum(F.octet_length("body")).alias("size")).filter(F.col("size") > BUCKET_BYTES).select("key"), "large")
    places = segments.select("seg_hi", "seg_lo", "d", "start", "n")
    # equal segments at several places are repeats as a whole
    equal = materialize(places.groupBy("seg_hi", "seg_lo").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "equal")
    found = (
        bodies.join(large, "key", "left_anti")
        .select("key", "seg_hi", "seg_lo", "body")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInPandas(strings.bound(_suffix_order), "seg_hi bigint, seg_lo bigint, found array<int>")
    )
    if not large.isEmpty():
        found = found.unionByName(_found_by_code(bodies.join(large, "key", "left_semi").select("seg_hi", "seg_lo", "body"), equal, strings))
    seen = found.join(equal, ["seg_hi", "seg_lo"], "full_outer")
    inside = F.expr("flatten(transform(sequence(0, size(found) - 1, 2), i -> array(start + found[i], found[i + 1] - found[i])))")
    marked = places.join(seen, ["seg_hi", "seg_lo"]).select("d", F.when(F.col("c").isNotNull(), F.array("start", "n")).otherwise(inside).alias("r"))
    return marked.groupBy("d").agg(F.flatten(F.collect_list("r")).alias("runs"))


def _removed(runs: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal ranges of units that the strings of the runs cover."""
    pairs = np.asarray(runs, np.int64).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    out: list[list[int]] = []
    for start, n in pairs.tolist():
        end = start + n - 1 + length
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _cutter(strings: Strings):
    def cut_texts(texts: pd.Series, runs: pd.Series, n_rows: pd.Series) -> pd.DataFrame:
        rows = []
        for text, own, copies in zip(texts, runs, n_rows):
            data = text.encode()
            if copies > 1:  # every string of it starts elsewhere, too
                n = len(strings.units(data))
                spans = [(0, n)] if n >= strings.length else []
            else:
                spans = _removed(own, strings.length)
            spans = strings.cuts(data, spans)
            kept, at = [], 0
            for a, b in spans:
                kept.append(data[at:a])
                at = b
            rest = b"".join(kept) + data[at:]
            rows.append((len(data) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", errors="ignore")))
        return pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept_sha256", "kept_text"])

    return cut_texts


CUT = "n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string"


def remove_repeats(docs: DataFrame, strings: Strings = BYTES, *, text_col: str = "text", with_text: bool = False) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans, kept_sha256 and, if asked for,
    ``kept_text`` (characters that a cut leaves half are dropped from it).

    Every unit goes that a string of ``strings.length`` units covers which also
    starts anywhere else, in this text or another: bytes in strings of 400, or
    words (``word_strings``), each with the white space behind it.

    Defined cases: a null text is empty (its kept_text is, too). Rows with the
    same text lose all of it, whatever their ids, unless it is shorter than a
    string; shorter texts are left alone. Ids are not read. A text of any length
    is worked on in overlapping pieces. An empty table gives no rows. Columns whose
    names begin with ``_kd_`` and the names of the added columns are taken; all
    others pass.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = _distinct_texts(docs, text, strings)
    runs = _repeated_runs(texts, strings)
    cut = F.pandas_udf(_cutter(strings), CUT)
    added = ["n_removed", "n_spans", "kept_sha256"] + ["kept_text"] * with_text
    some = texts.join(runs, "d", "left").filter("runs is not null or n_rows > 1")
    some = some.select(F.col("d").alias("_kd_d"), cut("text", "runs", "n_rows").alias("c")).filter("c.n_spans > 0")
    changed = materialize(some.select("_kd_d", *[F.col(f"c.{c}").alias(f"_kd_{c}") for c in added]), "cut")
    n_bytes = F.octet_length(text).cast("bigint")
    rows = docs.withColumns(
        {"_kd_d": F.when(n_bytes >= strings.least_bytes, _digest(text)), "_kd_n": n_bytes, "_kd_sha": F.sha2(F.encode(text, "UTF-8"), 256)}
    )
    passed = [F.col(c) for c in docs.columns if c not in {"n_bytes", *added}]
    return rows.join(changed, "_kd_d", "left").select(
        *passed,
        F.col("_kd_n").alias("n_bytes"),
        F.coalesce("_kd_n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("_kd_n_spans", F.lit(0).cast("bigint")).alias("n_spans"),
        F.coalesce("_kd_kept_sha256", "_kd_sha").alias("kept_sha256"),
        *[F.coalesce("_kd_kept_text", text).alias("kept_text")] * with_text,
    )
