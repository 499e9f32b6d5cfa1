import json

import pytest

from kindred.functions.text import payload_value, tokens, with_prefix
from kindred.sources.mapping import conform, default_mapping, link_mapping, schema_of
from kindred.sources.results import read_result_lines, result_lines, write_json_lines
from kindred.sources.tables import compact, ensure_table, get_documents, points_schema, read_table
from kindred.sources.text import load_texts, parquet_reader, read_line_texts, read_parquet_texts
from pyspark.sql import functions as F


def write_parquet(spark, path, values, column="keyword", kind="string"):
    """One file with a plain name in a folder (Spark names files itself)."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    types = {"string": pa.string(), "bigint": pa.int64()}
    pq.write_table(pa.table({column: pa.array(values, types[kind]), "extra": pa.array(range(len(values)))}), path)


@pytest.fixture
def folder(spark, tmp_path):
    for name, n in (("b.parquet", 3), ("a.parquet", 7), ("c.parquet", 6)):
        write_parquet(spark, tmp_path / name, [f"{name[0]}{i}" for i in range(n)])
    (tmp_path / "notes.txt").write_text("not parquet")
    (tmp_path / "deeper").mkdir()
    write_parquet(spark, tmp_path / "deeper" / "d.parquet", ["hidden"])
    return str(tmp_path)


def by_pos(df):
    return sorted(df.collect(), key=lambda r: r["pos"])


def test_folder_is_read_by_name_with_chunks_that_do_not_cross_files(spark, folder):
    rows = by_pos(read_parquet_texts(spark, folder, chunk_rows=4))
    assert [r["pos"] for r in rows] == list(range(16))
    assert [r["text"] for r in rows] == [f"a{i}" for i in range(7)] + [f"b{i}" for i in range(3)] + [f"c{i}" for i in range(6)]
    assert [r["row_id"] for r in rows] == [0, 1, 2, 3, 4, 5, 6, 8, 9, 10, 12, 13, 14, 15, 16, 17]
    assert [r["chunk_id"] for r in rows] == [0] * 4 + [1] * 3 + [2] * 3 + [3] * 4 + [4] * 2


@pytest.mark.parametrize("limit", [1, 7, 8, 12, 16, 99])
def test_limit_keeps_the_first_rows(spark, folder, limit):
    rows = by_pos(read_parquet_texts(spark, folder, limit=limit))
    assert [r["pos"] for r in rows] == list(range(min(limit, 16)))


def test_limit_does_not_open_files_behind_it(spark, folder):
    plan = read_parquet_texts(spark, folder, limit=7)._jdf.queryExecution().executedPlan().toString()
    locations = [line for line in plan.splitlines() if "keyword" in line and "FileScan" in line]
    assert len(locations) == 1 and "InMemoryFileIndex(1 paths)" in locations[0]
    rows = by_pos(read_parquet_texts(spark, folder, limit=7))
    assert {r["text"][0] for r in rows} == {"a"}


def test_single_file_and_description(spark, folder):
    texts, source = load_texts(spark, parquet=f"{folder}/a.parquet", chunk_rows=3)
    assert (texts.count(), source) == (7, "Parquet: a.parquet")
    _, source = load_texts(spark, parquet=folder, text="ignored")
    assert source.endswith("(3 files)")
    with pytest.raises(ValueError):
        load_texts(spark)


def test_only_needed_columns_are_read(spark, folder):
    plan = read_parquet_texts(spark, f"{folder}/a.parquet")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<keyword:string," in plan and "extra" not in plan


def test_missing_column_and_missing_path(spark, folder, tmp_path):
    with pytest.raises(ValueError, match="available columns: keyword, extra"):
        read_parquet_texts(spark, folder, "nonexistent")
    with pytest.raises(FileNotFoundError):
        parquet_reader(spark, str(tmp_path / "nowhere"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        parquet_reader(spark, str(tmp_path / "empty"))


def test_null_text(spark, tmp_path):
    write_parquet(spark, tmp_path / "n.parquet", ["x", None])
    assert [r["text"] for r in by_pos(read_parquet_texts(spark, str(tmp_path)))] == ["x", None]
    assert [r["text"] for r in by_pos(read_parquet_texts(spark, str(tmp_path), null_text="None"))] == ["x", "None"]


def test_numbers_as_text(spark, tmp_path):
    write_parquet(spark, tmp_path / "n.parquet", [3, 10], kind="bigint")
    assert [r["text"] for r in by_pos(read_parquet_texts(spark, str(tmp_path)))] == ["3", "10"]


LINES = "\n  \n　 first\r\nsecond\r\n\r\n   \rthird  \n\nlast　\n \n"


@pytest.mark.parametrize("keep_blank", [False, True])
def test_lines_like_a_stripped_text(spark, tmp_path, keep_blank):
    (tmp_path / "lines.txt").write_text(LINES, encoding="utf-8", newline="")
    expected = LINES.replace("\r\n", "\n").replace("\r", "\n").strip().split("\n")
    if not keep_blank:
        expected = [line for line in expected if line]
    rows = by_pos(read_line_texts(spark, str(tmp_path / "lines.txt"), keep_blank=keep_blank))
    assert [r["text"] for r in rows] == expected
    assert [r["pos"] for r in rows] == list(range(len(expected)))
    limited = by_pos(read_line_texts(spark, str(tmp_path / "lines.txt"), keep_blank=keep_blank, limit=3))
    assert [r["text"] for r in limited] == expected[:3]


def test_lines_over_many_splits(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 50) if i % 7 else "" for i in range(3000)]
    (tmp_path / "big.txt").write_text("\n".join(lines), encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        rows = by_pos(read_line_texts(spark, str(tmp_path / "big.txt")))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["text"] for r in rows] == [line for line in lines if line]
    assert [r["pos"] for r in rows] == list(range(len(rows)))


def test_empty_line_file(spark, tmp_path):
    (tmp_path / "blank.txt").write_text(" \n\n")
    assert read_line_texts(spark, str(tmp_path / "blank.txt")).count() == 0
    assert [r["text"] for r in read_line_texts(spark, str(tmp_path / "blank.txt"), keep_blank=True).collect()] == [""]


def test_japanese_tokens(spark):
    text = "北海道産 ラーメン Wi-Fi 6対応 Élan"
    row = spark.range(1).select(tokens(F.lit(text)).alias("t")).first()
    assert row["t"] == ["北", "海", "道", "産", "ラーメン", "wi", "fi", "6", "対", "応", "élan"]


def test_prefix_override(spark):
    row = spark.range(1).select(
        with_prefix(F.lit("x")).alias("default"), with_prefix(F.lit("x"), "").alias("none")
    ).first()
    assert row["default"] == "検索クエリ: x"
    assert row["none"] == "x"


def test_payload_null_is_not_missing(spark):
    payload = F.create_map(F.lit("a"), F.lit(None).cast("string"))
    row = spark.range(1).select(payload_value(payload, "a").alias("a"), payload_value(payload, "b").alias("b")).first()
    assert (row["a"], row["b"]) == (None, "")


def test_mapping_to_schema(spark):
    assert schema_of(default_mapping("name")).simpleString() == "struct<name:string>"
    linked = schema_of(json.dumps(link_mapping()))
    assert linked.simpleString() == (
        "struct<product_name:string,keywords:array<struct<keyword:string,keyword_id:int,score:float>>>"
    )
    df = spark.createDataFrame([(1, "a")], "extra int, product_name string")
    assert conform(df, linked).columns == ["product_name", "keywords", "extra"]
    with pytest.raises(ValueError, match="geo"):
        schema_of({"properties": {"x": {"type": "geo"}}})


def test_result_lines_keep_empty_queries_and_nulls(spark, tmp_path):
    hits = spark.createDataFrame(
        [(0, "q", 2, 0.91, "b", 8, {"name": "b"}), (0, "q", 1, 0.95, "a", 7, {"name": "a"}), (1, "none", None, None, None, None, None)],
        "query_id bigint, query string, rank int, score double, name string, point_id bigint, payload map<string,string>",
    )
    lines = result_lines(hits, payload_key="name").select("query", "results")
    write_json_lines(lines, str(tmp_path / "out"))
    back = {r["query"]: r["results"] for r in read_result_lines(spark, str(tmp_path / "out"), lines).collect()}
    assert [(h["rank"], h["name"], h["point_id"]) for h in back["q"]] == [(1, "a", 7), (2, "b", 8)]
    assert back["none"] == []
    with pytest.raises(ValueError):
        result_lines(hits, payload_key="score")


def test_create_if_absent_compact_and_get(spark, tmp_path):
    path = str(tmp_path / "points")
    assert ensure_table(spark, path, points_schema())
    assert not ensure_table(spark, path, points_schema())
    assert read_table(spark, path).count() == 0
    docs = spark.createDataFrame([(f"{i}", i) for i in range(50)], "_id string, n int")
    compact(docs, str(tmp_path / "docs"), "_id", n_files=3)
    asked = spark.createDataFrame([("7",), ("none",)], "_id string")
    found = {r["_id"]: (r["n"], r["found"]) for r in get_documents(read_table(spark, str(tmp_path / "docs")), asked, "_id").collect()}
    assert found == {"7": (7, True), "none": (None, False)}
