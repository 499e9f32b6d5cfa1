"""Vector sums per key against plain arithmetic."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.operators import vectorsum
from kindred.operators.centroids import group_means

SCHEMA = "k string, v array<float>"


def _rows(n, dim, seed=3):
    rng = np.random.default_rng(seed)
    keys = rng.choice(["a", "b", None, "hot"], n, p=[0.1, 0.1, 0.1, 0.7])
    return list(zip(keys.tolist(), rng.normal(size=(n, dim)).astype("float32").tolist()))


def _expected(rows):
    out = {}
    for k, v in rows:
        if v is not None:
            n, total = out.get(k, (0, np.zeros(len(v))))
            out[k] = (n + 1, total + np.array(v, dtype=float))
    return out


@pytest.mark.parametrize("held", [vectorsum.HELD_BYTES, 1])
def test_sums_over_hot_null_and_flushed_keys(spark, monkeypatch, held):
    monkeypatch.setattr(vectorsum, "HELD_BYTES", held)
    rows = [*_rows(500, 5), ("a", None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    found = {r["key"]: (r["n"], np.array(r["total"])) for r in vectorsum.vector_sums(df, "k", "v").collect()}
    expected = _expected(rows)
    assert set(found) == set(expected)
    for k, (n, total) in expected.items():
        assert found[k][0] == n
        assert np.allclose(found[k][1], total, atol=1e-9)


def test_one_partial_row_per_key_and_task(spark):
    df = spark.createDataFrame(_rows(4_000, 3), SCHEMA).repartition(6)
    assert vectorsum.partial_sums(df, "k", "v").count() <= 4 * 6


def test_nan_is_one_key(spark):
    nan = float("nan")
    df = spark.createDataFrame([(nan, [1.0]), (nan, [2.0]), (1.0, [4.0])], "k double, v array<double>").repartition(3)
    found = vectorsum.vector_sums(df, "k", "v").select("n", F.col("total")[0].alias("s")).collect()
    assert sorted((r["n"], r["s"]) for r in found) == [(1, 4.0), (2, 3.0)]


def test_means_are_unit_vectors_and_empty_tables_stay_empty(spark):
    rows = _rows(60, 4)
    means = group_means(spark.createDataFrame(rows, SCHEMA), "k", "v").collect()
    for row in means:
        n, total = _expected(rows)[row["k"]]
        assert row["n"] == n
        assert np.allclose(row["centroid"], total / np.linalg.norm(total), atol=1e-9)
    assert group_means(spark.createDataFrame([], SCHEMA), "k", "v").count() == 0


def test_no_row_per_position_in_the_plan(spark):
    plan = group_means(spark.createDataFrame(_rows(10, 4), SCHEMA), "k", "v")._jdf.queryExecution().toString()
    assert "Generate" not in plan


def test_sizes_must_agree(spark):
    df = spark.createDataFrame([("a", [1.0]), ("a", [1.0, 2.0])], SCHEMA).coalesce(1)
    with pytest.raises(Exception, match="different sizes"):
        vectorsum.vector_sums(df, "k", "v").collect()
