"""Inputs that a user has and clean tables do not: other split sizes, odd file
names, vectors that are no numbers, null texts, gaps between positions."""

import math
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred import session
from kindred.functions.text import tokens
from kindred.operators import cells, deadletter, numbering, points
from kindred.operators.embed import embed_outcomes, hash_embedder
from kindred.operators.link import make_points, search_texts
from kindred.operators.rowerrors import conform_rows
from kindred.operators.topk import topk_join, topk_one
from kindred.sources.mapping import schema_of
from kindred.sources.text import read_line_texts, read_parquet_texts

ODD = [[math.nan] * 4, [1.0, math.inf, 0.0, 0.0], None, [1.0, None, 0.0, 0.0]]


def test_lines_survive_other_splits(spark, tmp_path):
    lines = [f"line {i}" + " x" * (i % 7) if i % 5 else "" for i in range(60_000)]
    (tmp_path / "lines.txt").write_text("\n".join(["first", *lines, "last"]))
    old = spark.conf.get("spark.sql.files.minPartitionNum", None)
    try:
        spark.conf.set("spark.sql.files.minPartitionNum", "2")
        read = read_line_texts(spark, str(tmp_path / "lines.txt"), keep_blank=True)
        dropped = read_line_texts(spark, str(tmp_path / "lines.txt"))
        spark.conf.set("spark.sql.files.minPartitionNum", "9")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
        got = [r["text"] for r in read.orderBy("pos").collect()]
        assert got == ["first", *lines, "last"]
        rows = dropped.orderBy("pos").collect()
        assert [r["text"] for r in rows] == ["first", *filter(None, lines), "last"]
        assert [r["pos"] for r in rows] == list(range(len(rows)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.minPartitionNum", old) if old else spark.conf.unset("spark.sql.files.minPartitionNum")


def test_limit_over_odd_file_names(spark, tmp_path):
    folder = tmp_path / "a b%20c"
    folder.mkdir()
    for i, name in enumerate(["one 1.parquet", "one%2.parquet", "two.parquet"]):
        spark.createDataFrame([(f"t{i}{k}",) for k in range(4)], "keyword string").coalesce(1).write.parquet(str(tmp_path / f"raw{i}"))
        part = next((tmp_path / f"raw{i}").glob("*.parquet"))
        (folder / name).write_bytes(part.read_bytes())
    for limit in (3, 6, 12):
        got = read_parquet_texts(spark, str(folder), limit=limit).orderBy("pos").collect()
        assert [r["pos"] for r in got] == list(range(min(limit, 12)))


def dirty(spark, n, n_odd, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(n)]
    rows += [(n + i, ODD[i % len(ODD)]) for i in range(n_odd)]
    return spark.createDataFrame(rows, "id bigint, vector array<float>").repartition(3), rows


def best(queries, rows, k):
    usable = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v and len(v) == 4 and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, v in queries:
        if not any(q == i for i, _ in usable):
            continue
        v = np.array(v, np.float32).astype(float)
        scored = sorted((-(v @ p) / (np.linalg.norm(v) * np.linalg.norm(p)), i) for i, p in usable)
        out |= {(q, r + 1, i) for r, (_, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("strategy", ["points", "queries", "grid", "cells"])
def test_vectors_that_are_no_numbers_take_no_place(spark, strategy):
    df, rows = dirty(spark, 100, 60)
    k = 10
    if strategy == "cells":
        index = cells.build_cells(df, cells.train_centroids(df.filter("id < 100"), 5, 4), 4, point_id="id")
        hits = cells.topk_cells(df, index, k, 1, query_id="id")
    else:
        hits = topk_join(df, df, k, 4, query_id="id", point_id="id", strategy=strategy)
    assert {(r["query_id"], r["rank"], r["point_id"]) for r in hits.collect()} == best(rows, rows, k)


def test_one_query_skips_odd_vectors(spark):
    df, rows = dirty(spark, 30, 20)
    got = [r["point_id"] for r in topk_one(df, rows[0][1], 10, point_id="id").collect()]
    assert got == [i for _, _, i in sorted(best(rows[:1], rows, 10), key=lambda x: x[1])]


def test_cluster_without_shared_folder_is_refused():
    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Session:
        sparkContext = Context()
        conf = SimpleNamespace(get=lambda key, default=None: default)

    with pytest.raises(RuntimeError):
        session.work_root(Session())
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        session.work_root(Session())


def test_null_texts_and_gaps_become_letters(spark):
    positions = [1, 3, 7, 65, 70]
    texts = spark.createDataFrame([(p, None if p in (3, 70) else f"t{p}") for p in positions], "pos bigint, text string")
    outcomes = embed_outcomes(texts, hash_embedder(8), 8, batch_size=64).cache()
    failed = outcomes.filter("status = 'failed'")
    letters = deadletter.dead_letters(failed)
    assert sorted((r["pos"], r["text"]) for r in deadletter.letters_to_texts(letters).collect()) == [
        (1, "t1"), (3, None), (7, "t7"), (65, "t65"), (70, None)
    ]
    assert deadletter.attempt_records(failed).count() == 6


def test_positions_without_partner_are_an_error(spark):
    vectors = spark.createDataFrame([(i, [1.0]) for i in range(3)], "pos bigint, vector array<float>")
    texts = spark.createDataFrame([(i, "t") for i in (0, 1, 9)], "pos bigint, text string")
    with pytest.raises(ValueError):
        points.assemble_points(vectors, texts=texts)


def test_index_is_stored_loaded_and_extended(spark, tmp_path):
    df, rows = dirty(spark, 100, 10)
    index = cells.build_cells(df.filter("id < 60"), cells.train_centroids(df, 5, 4), 4, point_id="id")
    index.save(str(tmp_path / "index"))
    grown = cells.CellIndex.load(spark, str(tmp_path / "index")).extended(df.filter("id >= 60"), point_id="id")
    hits = cells.topk_cells(df, grown, 10, 2, query_id="id")
    assert {(r["query_id"], r["rank"], r["point_id"]) for r in hits.collect()} == best(rows, rows, 10)


def test_search_through_an_index_equals_the_plain_search(spark):
    texts = spark.createDataFrame([(i, f"word{i} word{i % 7} text") for i in range(80)], "row_id bigint, text string")
    points = make_points(texts, hash_embedder(16), 16)
    queries = spark.createDataFrame([(0, "word3 text"), (1, "other"), (2, None)], "query_id bigint, query string")
    index = cells.build_cells(points, cells.train_centroids(points, 6, 16), 16)
    plain = search_texts(queries, points, hash_embedder(16), 16).orderBy("query_id", "rank").collect()
    assert search_texts(queries, points, hash_embedder(16), 16, index=index).orderBy("query_id", "rank").collect() == plain
    assert search_texts(queries, points, hash_embedder(16), 16, index=index, nprobe=1).filter("query_id = 0").count() > 0
    assert [r["rank"] for r in plain if r["query_id"] == 2] == [None]


def test_hot_values_share_the_buckets(spark):
    df = spark.range(6000).select((F.col("id") % 60).alias("v"), F.col("id").alias("t"))
    numbered = numbering.dense_positions(df, "v", tie="t", n_buckets=400)
    got = [(r["v"], r["t"]) for r in numbered.orderBy("pos").collect()]
    assert got == sorted(got) and [r["pos"] for r in numbered.select("pos").orderBy("pos").collect()] == list(range(6000))
    keyed = numbering._with_buckets(df, "v", "t", 400)
    assert keyed.select("_bucket", "_sub").distinct().count() <= 800


def test_marks_stay_with_their_letters(spark):
    df = spark.createDataFrame([("caf\u0065\u0301 \u0939\u093f\u0928\u094d\u0926\u0940",)], "t string")
    assert df.select(tokens(F.col("t"))).first()[0] == ["caf\u0065\u0301", "\u0939\u093f\u0928\u094d\u0926\u0940"]


def test_mapping_types():
    made = schema_of({"properties": {"d": {"type": "date"}, "s": {"type": "short"}, "h": {"type": "half_float"}, "o": {"type": "object"}, "n": {"type": "nested"}}})
    assert made.simpleString() == "struct<d:timestamp,s:smallint,h:float,o:map<string,string>,n:array<map<string,string>>>"


def test_row_errors_fail_or_go_aside(spark):
    df = spark.createDataFrame([(1, "5", "x"), (2, "five", "y"), (3, None, None)], "id int, n string, t string")
    schema = schema_of({"properties": {"id": {"type": "long"}, "n": {"type": "integer"}, "t": {"type": "text"}}})
    loaded, rejected = conform_rows(df, schema, on_row_error="deadletter")
    assert sorted((r["id"], r["n"]) for r in loaded.collect()) == [(1, 5), (3, None)]
    assert [(r["id"], r["n"], r["bad_fields"]) for r in rejected.collect()] == [(2, "five", ["n"])]
    with pytest.raises(Exception, match="does not fit the mapping in n"):
        conform_rows(df, schema)[0].collect()
    assert conform_rows(df.filter("id != 2"), schema)[0].count() == 2
    with pytest.raises(ValueError):
        conform_rows(df, schema, on_row_error="warn")
