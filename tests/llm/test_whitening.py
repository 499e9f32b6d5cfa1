"""Whitening against dense linear algebra."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.llm import queries, whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def _table(spark, vectors, ids=None, parts=3):
    rows = [(i, v, 0) for i, v in zip(ids or range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def _check(found, ids, vectors, k=8):
    """All columns of ``found`` (collected rows) against eigh of the dense covariance."""
    c = np.array(vectors, dtype=np.float32).astype(np.float64)
    x = np.floor(1024 * c).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    centred = (n * x - s) / n
    v = centred.T @ centred / n
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1], basis[:, ::-1]
    k = min(k, int((values > len(v) * np.finfo(float).eps * np.trace(v)).sum()))
    assert len(found) == n * k
    deviation = dict(zip(ids, ((n * x - s) ** 2).sum(axis=1).tolist()))
    got = {(r["vec_id"], r["component"]): r for r in found}
    for j in range(k):
        ours = np.array([got[i, j + 1]["whitened"] for i in ids])
        theirs = centred @ basis[:, j] / np.sqrt(values[j])
        sign = np.sign(ours @ theirs)
        gap = min(abs(values[j] - values[m]) for m in range(len(values)) if m != j) / values[0] if len(values) > 1 else 1
        if gap > 1e-6:
            assert np.abs(ours - sign * theirs).max() < 1e-11 / gap
    for (i, j), r in got.items():
        assert r["n"] == n
        assert r["deviation"] == deviation[i]
        assert abs(r["explained"] / (values[j - 1] / np.trace(v)) - 1) < 1e-12
        assert r["identity_error"] < 1e-9


@pytest.mark.parametrize("n,dim", [(900, 64), (300, 40), (200, 5), (20, 48)])
def test_equals_dense_eigenvectors(spark, n, dim):
    rng = np.random.default_rng(n)
    scale = 0.2 * (1 + np.arange(dim) / dim)
    vectors = (rng.normal(size=(n, dim)) * scale).astype("float32").tolist()
    ids = list(range(n))
    _check(whitening.whiten(_table(spark, vectors, ids)).collect(), ids, vectors)


def test_query_equals_dense_eigenvectors(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    found = queries.op11_embedding_whitening(spark, sf_dir)
    assert found.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    _check(found.collect(), [r["vec_id"] for r in rows], [r["embedding"] for r in rows])


def test_bad_vectors_are_left_out_and_clashing_columns_do_no_harm(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(60, 6)).astype("float32").tolist()
    nan, inf = float("nan"), float("inf")
    bad = [None, [1.0, None, 0.0, 0.0, 0.0, 0.0], [nan] + [0.0] * 5, [0.0] * 5 + [-inf], [2.0**41] + [0.0] * 5]
    df = _table(spark, vectors + bad)
    for name in ("id", "v", "x", "n", "s", "key", "part", "component"):
        df = df.withColumn(name, F.lit("clash"))
    _check(whitening.whiten(df).collect(), list(range(60)), vectors)


def test_equal_variances_ties_and_repeated_rows(spark):
    """Unit vectors along both directions of each axis: all variances are equal."""
    dim = 40
    vectors = [[float(s) if i == j else 0.0 for j in range(dim)] for i in range(dim) for s in (1, -1)] * 2
    ids = list(range(dim * 2)) * 2
    found = whitening.whiten(_table(spark, vectors, ids)).collect()
    assert len(found) == len(vectors) * 8
    assert max(r["identity_error"] for r in found) < 1e-9
    by_id = {}
    for r in found:
        by_id.setdefault((r["vec_id"], r["component"]), set()).add(round(r["whitened"], 9))
    assert all(len(v) == 1 for v in by_id.values())


def test_nothing_to_whiten(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(_table(spark, [[1.0, 2.0]])).count() == 0
    assert whitening.whiten(_table(spark, [[1.0, 2.0]] * 5)).count() == 0
    assert whitening.whiten(_table(spark, [None, None])).count() == 0


def test_null_ids_come_back(spark):
    found = whitening.whiten(_table(spark, [[1.0, 2.0], [3.0, 1.0], [0.0, 0.5]], [1, None, 1])).collect()
    assert sorted(r["vec_id"] or 0 for r in found) == [0, 0, 1, 1, 1, 1]


def test_sizes_must_agree(spark):
    with pytest.raises(Exception, match="sizes|entries"):
        whitening.whiten(_table(spark, [[1.0, 2.0], [3.0]]))


def test_numbers_beyond_64_bits(spark):
    """Sums and deviations that need more than a long: exact or null, no wrong number."""
    big = 2.0**39
    vectors = [[big, 1.0], [-big, 2.0], [big, 3.0]]
    found = whitening.whiten(_table(spark, vectors)).collect()
    assert {r["deviation"] for r in found} == {None}
    data = np.array([[2**50, 7], [-(2**50), 8]], "<i8").tobytes()
    n, sums = 2**14, np.array([5, 9], object)
    assert whitening._deviations(data, n, sums).tolist() == [[n * 2**50 - 5, n * 7 - 9], [-n * 2**50 - 5, n * 8 - 9]]


def test_a_missed_direction_is_found(spark):
    """A start block orthogonal to the first component does not pass the check."""
    values = np.diag([9.0, 4.0, 3.0, 2.0, 1.0])
    q = np.eye(5)[:, 1:4]
    rng = np.random.default_rng(1)
    got = whitening._certified(lambda y: values @ y, q, values @ q, np.array([4.0, 3.0, 2.0]), 2, rng)
    assert got[3] is False
    assert got[2][0] == pytest.approx(9.0)
