"""Manifests of streamed tables against folding all rows."""

import random

import pytest
from pyspark.sql import functions as F

from kindred.sources.tables import read_table
from kindred.streaming import ingest, manifest


def _write(spark, table, batches, key_type="string"):
    for number, rows in enumerate(batches):
        df = spark.createDataFrame(rows, f"k {key_type}, v int, pos int").repartition(2)
        ingest.write_batch(df, table, number, "k")


def _newest(batches):
    out, nulls = {}, []
    for rows in batches:
        for k, v, pos in sorted(rows, key=lambda r: r[2]):
            if k is None:
                nulls.append((None, v, pos))
            else:
                out[k] = (k, v, pos)
    return sorted([*out.values(), *nulls], key=repr)


def _read(spark, table):
    return sorted((tuple(r) for r in ingest.current_rows(spark, table, "k", within="pos").select("k", "v", "pos").collect()), key=repr)


@pytest.mark.parametrize("key_type", ["string", "bigint"])
def test_newest_rows_of_overlapping_batches(spark, tmp_path, key_type):
    rng = random.Random(4)
    make = str if key_type == "string" else int
    batches = []
    for lo, hi in ((0, 40), (40, 80), (30, 50), (200, 220), (0, 300)):
        picked = rng.sample(range(lo, hi), 15)
        batches.append([(make(k), rng.randrange(10**6), i) for i, k in enumerate(picked)])
    batches[3] += [(batches[3][0][0], 7, 99), (None, 8, 100), (None, 9, 101)]
    table = f"{tmp_path}/t"
    _write(spark, table, batches, key_type)
    assert _read(spark, table) == _newest(batches)
    # a replay, also of an old batch, changes nothing
    for number in (4, 1):
        again = spark.createDataFrame(batches[number], f"k {key_type}, v int, pos int")
        ingest.write_batch(again, table, number)
        assert _read(spark, table) == _newest(batches)
    # an old batch that comes with other rows
    batches[1] = [(make(k), 1, i) for i, k in enumerate((0, 41, 299, 500))]
    ingest.write_batch(spark.createDataFrame(batches[1], f"k {key_type}, v int, pos int"), table, 1)
    assert _read(spark, table) == _newest(batches)


def test_appended_batches_are_read_without_folding(spark, tmp_path):
    table = f"{tmp_path}/t"
    _write(spark, table, [[(i, i, i) for i in range(lo, lo + 20)] for lo in (0, 20, 40)], "bigint")
    plan = ingest.current_rows(spark, table, "k", within="pos")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan
    assert manifest.superseded(spark, table).count() == 0


def test_only_touched_batches_are_joined(spark, tmp_path):
    table = f"{tmp_path}/t"
    _write(spark, table, [[(f"{c}{i}", i, i) for i in range(20)] for c in "abc"] + [[("b3", 99, 0)]])
    hit, double, _ = manifest.touched_batches(spark, table, manifest.batches(spark, table))
    assert (hit, double) == ([1], [])
    plan = ingest.current_rows(spark, table, "k", within="pos")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    assert len(_read(spark, table)) == 60


def test_the_filter_holds_every_key_and_few_others(spark, tmp_path):
    table = f"{tmp_path}/t"
    _write(spark, table, [[(f"key-{i}", i, i) for i in range(6_000)]])
    filters = read_table(spark, f"{table}/_filters")
    n_blocks = manifest.batches(spark, table).first()["n_blocks"]
    assert n_blocks == filters.count() == 3
    def held(keys):
        asked = keys.select(manifest._places(F.col("key")).alias("places"), manifest._block(F.col("key"), F.lit(n_blocks)).alias("block"))
        return asked.join(filters, "block").filter(manifest._may_hold()).count()
    assert held(spark.range(6_000).select(F.concat(F.lit("key-"), "id").alias("key"))) == 6_000
    assert held(spark.range(6_000).select(F.concat(F.lit("other-"), "id").alias("key"))) < 150


def test_numbers_follow_from_the_manifest_alone(spark, tmp_path):
    table = f"{tmp_path}/t"
    _write(spark, table, [[(5, 0, 0), (9, 0, 1)], [(9, 0, 0), (12, 0, 1)], []], "bigint")
    assert [ingest.next_id(spark, table, "k", n, "append") for n in range(4)] == [0, 10, 13, 13]
    assert [ingest.next_id(spark, table, "k", n, "count") for n in range(4)] == [0, 2, 3, 3]
    for number in range(3):  # the data itself is not opened
        (tmp_path / "t" / f"batch_id={number}").rename(tmp_path / f"gone-{number}")
    assert ingest.next_id(spark, table, "k", 2, "append") == 13


def test_a_batch_that_was_not_committed_is_not_seen(spark, tmp_path):
    table = f"{tmp_path}/t"
    _write(spark, table, [[("a", 1, 0)], [("b", 2, 0)]])
    spark.createDataFrame([("a", 3, 0)], "k string, v int, pos int").write.parquet(f"{table}/batch_id=2")
    assert _read(spark, table) == [("a", 1, 0), ("b", 2, 0)]
