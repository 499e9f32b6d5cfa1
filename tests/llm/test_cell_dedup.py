"""Near-duplicate vectors against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.llm import cell_dedup, queries

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def _table(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(parts)


def _brute(rows, threshold=0.9):
    """(vec_id, n_links, component_id, kept) of rows with distinct ids."""
    usable = [(i, v) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    unit = np.array([v for _, v in usable], dtype=np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    ids = [i for i, _ in usable]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = dict.fromkeys(root, 0)
    for x, line in enumerate(unit @ unit.T >= threshold):
        for y in np.nonzero(line)[0]:
            if x != y:
                links[ids[x]] += 1
                a, b = sorted((find(ids[x]), find(ids[y])))
                root[b] = a
    return sorted((i, links[i], find(i), find(i) == i) for i in root)


def _found(df):
    return sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in df.collect())


def _mixture(rng, dim, n_random, groups):
    """Random directions and groups around some of them: (size, spread) each."""
    parts = [rng.normal(size=(n_random, dim))]
    for size, spread in groups:
        centre = rng.normal(size=dim)
        centre /= np.linalg.norm(centre)
        parts.append(centre + spread * rng.normal(size=(size, dim)) / np.sqrt(dim))
    vectors = np.concatenate(parts)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    order = rng.permutation(len(vectors))
    return list(enumerate(vectors[order].astype("float32").tolist()))


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(cell_dedup, "BLOCK_ROWS", 40)
    monkeypatch.setattr(cell_dedup, "PRODUCT_ENTRIES", 500)


def test_one_cell_misses_nothing(spark):
    rows = _mixture(np.random.default_rng(1), 24, 300, [(40, 0.1), (30, 0.33), (20, 0.4), (25, 0.6)])
    assert _found(cell_dedup.near_duplicate_vectors(_table(spark, rows))) == _brute(rows)


def test_many_cells_and_blocks_with_full_reach(spark, small_blocks):
    """Groups wider than a ball, balls that members decide, cells of several blocks."""
    dim = 12
    rows = _mixture(np.random.default_rng(2), dim, 250, [(150, 0.1), (60, 0.33), (60, 0.45), (40, 0.6)])
    found = cell_dedup.near_duplicate_vectors(_table(spark, rows), cell_rows=40, reach=dim**0.5)
    assert _found(found) == _brute(rows)


def test_members_decide_open_pairs(spark, small_blocks):
    rng = np.random.default_rng(8)
    rows = _mixture(rng, 6, 0, [(120, 0.3), (120, 0.45)])
    df = _table(spark, rows).select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    distinct = cell_dedup.folded_vectors(df)
    centroids = cell_dedup.fit_centroids(distinct, len(rows), 4)
    members = cell_dedup.gathered(distinct, centroids, 0.9)
    found = cell_dedup.compared(cell_dedup.shown(members, centroids, 0.9, 99), 0.9)
    assert found.filter(F.col("kind") == cell_dedup.OPEN).count() > 0
    assert members.filter("v = ball and n_ball > 1").count() > 0
    assert _found(cell_dedup.near_duplicate_vectors(_table(spark, rows), cell_rows=60, reach=99)) == _brute(rows)


def test_recall_with_the_usual_reach(spark):
    """Pairs at the very threshold among random directions, cells of 100 rows."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(1_500, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    off = rng.normal(size=base.shape)
    off -= np.einsum("ij,ij->i", off, base)[:, None] * base
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    cosine = rng.uniform(0.9, 0.93, size=(len(base), 1))
    vectors = np.concatenate([base, cosine * base + np.sqrt(1 - cosine**2) * off]).astype("float32")
    rows = list(enumerate(vectors.tolist()))
    found = _found(cell_dedup.near_duplicate_vectors(_table(spark, rows, 6), cell_rows=100))
    truth = _brute(rows)
    assert all(f[1] <= t[1] for f, t in zip(found, truth))
    assert sum(f[1] for f in found) >= 0.97 * sum(t[1] for t in truth)


def test_a_third_of_all_rows_in_one_group(spark, small_blocks):
    """A dense group is counted by its balls: blocks put out few rows for it."""
    rng = np.random.default_rng(4)
    rows = _mixture(rng, 16, 400, [(400, 0.05)])
    rows += [(len(rows) + i, rows[0][1]) for i in range(400)]
    df = _table(spark, rows, 6)
    found = cell_dedup.near_duplicate_vectors(df, cell_rows=100)
    assert _found(found) == _brute(rows)
    distinct = cell_dedup.folded_vectors(df.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec")))
    assert distinct.count() == 800
    centroids = cell_dedup.fit_centroids(distinct, 800, 8)
    members = cell_dedup.gathered(distinct, centroids, 0.9)
    blocks = cell_dedup.compared(cell_dedup.shown(members, centroids, 0.9, 2.5), 0.9)
    assert blocks.count() < 2 * 800


def test_values_without_direction_ties_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [5.0, 0.0]), (4, [0.0, 0.0]), (5, [-0.0, 0.0]), (6, None), (7, [nan, 1.0]),
        (8, [inf, 1.0]), (9, [None, 1.0]), (10, [-1.0, 0.0]), (11, [1e-40, 1e-40]), (12, [1.0, 1.0]), (13, [3e38, 3e38]),
    ]
    df = _table(spark, rows)
    for name in ("id", "vec", "v", "least", "copies", "cell", "ball", "kept", "n_links", "a", "b"):
        df = df.withColumn(name, F.lit("clash"))
    assert _found(cell_dedup.near_duplicate_vectors(df)) == [
        (1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True),
        (8, 0, 8, True), (9, 0, 9, True), (10, 0, 10, True), (11, 2, 11, True), (12, 2, 11, False), (13, 2, 11, False),
    ]


def test_null_and_repeated_ids(spark):
    rows = [(None, [1.0, 0.0]), (7, [1.0, 0.01]), (None, [0.0, 1.0]), (3, [-1.0, 0.0]), (3, [-1.0, 0.0]), (None, None)]
    found = cell_dedup.near_duplicate_vectors(_table(spark, rows)).collect()
    got = sorted(((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in found))
    assert got == [(0, 0, 0, True), (0, 0, 0, True), (0, 1, 7, False), (3, 1, 3, True), (3, 1, 3, True), (7, 1, 7, True)]


def test_empty_tables_and_sizes(spark):
    assert cell_dedup.near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    assert _found(cell_dedup.near_duplicate_vectors(_table(spark, [(1, None)]))) == [(1, 0, 1, True)]
    with pytest.raises(ValueError, match="entries"):
        cell_dedup.near_duplicate_vectors(_table(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


def test_query_equals_all_pairs(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert _found(queries.op13_embedding_dedup(spark, sf_dir)) == _brute(rows)
