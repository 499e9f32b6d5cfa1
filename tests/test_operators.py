import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.config import RetryPolicy
from kindred.functions import nested, vectors
from kindred.operators import deadletter, fulltext, metrics, numbering, store
from kindred.operators.embed import HashEmbedder, embed, embed_outcomes, hash_embedder
from kindred.operators.fulltext import match
from kindred.operators.generate import Template, generate_texts, sample_texts
from kindred.operators.link import link_products, make_points, nest_links, search_distinct, search_texts
from kindred.operators.numbering import dense_positions, first_rows, running_total
from kindred.operators.points import assemble_documents, assemble_points
from kindred.plans.catalog import QUERIES
from kindred.sources.tables import read_table
from kindred.streaming import ingest


# --- vectors ---


def test_vector_report_and_split(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [1.0]), (5, None), (6, [3.0, 4.0])]
    df = spark.createDataFrame(rows, "id int, v array<float>")
    report = vectors.vector_report(df, "v", 2).first()
    assert report.asDict() == {
        "n_rows": 6, "n_null": 1, "n_wrong_dim": 1, "n_not_finite": 1, "n_zero": 1, "n_not_unit": 2
    }
    usable, rejected = vectors.split_invalid_vectors(df, "v", 2)
    assert sorted(r["id"] for r in usable.collect()) == [1, 2, 6]
    assert {r["id"]: r["reason"] for r in rejected.collect()} == {
        3: "entry is not finite", 4: "wrong dimension", 5: "null vector"
    }


def test_cosine_of_zero_vector_is_zero(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0])], "a array<double>, b array<double>")
    assert df.select(vectors.cosine(F.col("a"), F.col("b"))).first()[0] == 0.0


# --- embedding stage ---


def test_embed_keeps_nulls_and_calls_factory_per_task(spark):
    df = spark.createDataFrame([(0, "abc"), (1, None), (2, "")], "id int, text string").coalesce(1)
    rows = {r["id"]: r["vector"] for r in embed(df, "text", hash_embedder(16), 16).collect()}
    assert np.allclose(rows[0], HashEmbedder(16)(["abc"])[0], atol=1e-7)
    assert rows[1] is None
    assert rows[2] == [0.0] * 16


def test_related_texts_are_closer(spark):
    a, b, c = HashEmbedder(256)(["red winter jacket", "red winter jackets", "garlic noodle soup"])
    assert a @ b > a @ c
    assert np.allclose([a @ a, b @ b], 1.0)


def test_wrong_model_shape_is_an_error(spark):
    df = spark.createDataFrame([("a",)], "text string")
    with pytest.raises(Exception, match="shape"):
        embed(df, "text", lambda: (lambda texts: np.zeros((len(texts), 3))), 4).collect()


def fails_first(n):
    """Factory of a model that fails on its first ``n`` calls of a task."""

    def factory():
        left = [n]

        def model(texts):
            left[0] -= 1
            if left[0] >= 0:
                raise ConnectionError("down")
            return np.zeros((len(texts), 2))

        return model

    return factory


def texts_frame(spark, n, partitions=3):
    return spark.range(n).select(F.col("id").alias("pos"), F.concat(F.lit("t"), "id").alias("text")).repartition(partitions)


def test_retry_then_success(spark):
    out = embed_outcomes(
        texts_frame(spark, 10), fails_first(2), 2, batch_size=10, retry=RetryPolicy(3, 0.0)
    ).collect()
    assert {(r["status"], r["attempts"], len(r["errors"])) for r in out} == {("ok", 3, 2)}
    assert len(out) == 10


def test_final_failure_is_one_dead_letter_per_batch(spark, tmp_path):
    out = embed_outcomes(texts_frame(spark, 100), fails_first(999), 2, batch_size=64, retry=RetryPolicy(2, 0.0))
    ok, failed = deadletter.route_outcomes(out)
    assert (ok.count(), failed.count()) == (0, 100)
    letters = {r["batch_id"]: r for r in deadletter.dead_letters(failed).collect()}
    assert {k: r["count"] for k, r in letters.items()} == {0: 64, 64: 36}
    assert letters[64]["texts"] == [f"t{i}" for i in range(64, 100)]
    assert letters[0]["error_type"] == "ConnectionError"
    assert deadletter.attempt_records(failed).count() == 4
    path = str(tmp_path / "letters")
    deadletter.write_dead_letters(deadletter.dead_letters(failed), path)
    deadletter.write_dead_letters(deadletter.dead_letters(failed), path)
    assert deadletter.read_dead_letters(spark, path).count() == 4
    deadletter.write_dead_letters(deadletter.dead_letters(failed), None)
    again = deadletter.letters_to_texts(deadletter.dead_letters(failed))
    assert sorted(r["pos"] for r in again.collect()) == list(range(100))


def test_totals_and_summary(spark):
    batches = spark.createDataFrame(
        [(0, 64, 1, "ok", 20.0), (64, 36, 3, "ok", 7.0), (100, 5, 3, "failed", 1.0)],
        "batch_id bigint, n_rows bigint, attempts int, status string, embed_ms double",
    )
    totals = metrics.run_totals(batches)
    assert totals.first().asDict() == {"processed": 100, "retries": 4, "failed_count": 5, "failed_batches": 1}
    assert len(metrics.summary_rows(totals).collect()) == 4
    clean = metrics.run_totals(batches.filter("status = 'ok' and attempts = 1"))
    assert [r["metric"] for r in metrics.summary_rows(clean).collect()] == ["processed"]


def test_rates_with_nothing_to_divide_by(spark):
    row = spark.range(1).select(metrics.rate(F.lit(5), F.lit(0)), metrics.percent(F.lit(5), F.lit(0))).first()
    assert tuple(row) == (0.0, 0.0)


def test_retry_policy():
    assert [RetryPolicy().wait_after(i) for i in (1, 2, 3, 9)] == [1.0, 2.0, 4.0, 60.0]
    assert [RetryPolicy(exponential=False).wait_after(i) for i in (1, 5)] == [1.0, 1.0]
    with pytest.raises(ValueError):
        RetryPolicy(max_attempts=0)


# --- numbering ---


def test_running_total_with_a_hot_value(spark):
    rng = np.random.default_rng(1)
    order = [7 if i % 3 == 0 else int(rng.integers(0, 1000)) for i in range(2000)]
    rows = [(i, o, i % 5) for i, o in enumerate(order)]
    df = spark.createDataFrame(rows, "id bigint, at bigint, n bigint").repartition(5)
    got = {r["id"]: r["running_total"] for r in running_total(df, "at", F.col("n"), tie="id", n_buckets=16).collect()}
    total, expected = 0, {}
    for i, _, n in sorted(rows, key=lambda r: (r[1], r[0])):
        total += n
        expected[i] = total
    assert got == expected


def test_dense_positions_and_first_rows(spark):
    df = spark.createDataFrame([(x,) for x in (50, 10, 40, 20, 30)], "x bigint")
    assert {r["x"]: r["pos"] for r in dense_positions(df, "x").collect()} == {10: 0, 20: 1, 30: 2, 40: 3, 50: 4}
    assert sorted(r["x"] for r in first_rows(df, 2, "x").collect()) == [10, 20]


# --- store ---


@pytest.fixture
def base(spark):
    return spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "id int, name string, n int")


def test_upsert_last_write_wins_and_is_idempotent(spark, base):
    changes = spark.createDataFrame(
        [(2, "x", 20, 1), (2, "y", 21, 2), (9, "new", 90, 1)], "id int, name string, n int, seq int"
    )
    once = store.upsert(base, changes, "id", ["seq"])
    expected = [(1, "a", 1), (2, "y", 21), (3, "c", 3), (9, "new", 90)]
    assert sorted(map(tuple, once.collect())) == expected
    assert sorted(map(tuple, store.upsert(once, changes, "id", ["seq"]).collect())) == expected


def test_partial_update_sets_given_fields_only(spark, base):
    updates = spark.createDataFrame(
        [(1, None, 10, 1), (1, "z", None, 2), (7, "lost", 1, 3)], "id int, name string, n int, seq int"
    )
    assert sorted(map(tuple, store.partial_update(base, updates, "id", ["seq"]).collect())) == [
        (1, "z", 10), (2, "b", 2), (3, "c", 3)
    ]
    assert [r["id"] for r in store.unmatched_updates(base, updates, "id").collect()] == [7]
    nulls = spark.createDataFrame([(2, None, None, 1, ["name"])], "id int, name string, n int, seq int, given array<string>")
    assert (2, None, 2) in [tuple(r) for r in store.partial_update(base, nulls, "id", ["seq"]).collect()]


def test_delete_ignores_unknown_ids(spark, base):
    gone = spark.createDataFrame([(2,), (44,)], "id int")
    assert sorted(r["id"] for r in store.delete_ids(base, gone, "id").collect()) == [1, 3]


def replay(base, log):
    """The change log applied one by one."""
    docs = {i: {"name": name, "n": n} for i, name, n in base}
    rejected = []
    for op, i, seq, name, n, given in sorted(log, key=lambda r: r[2]):
        if op == "index":
            docs[i] = {"name": name, "n": n}
        elif op == "delete":
            docs.pop(i, None)
        elif i in docs:
            docs[i].update({f: {"name": name, "n": n}[f] for f in given})
        else:
            rejected.append((i, seq))
    return sorted((i, d["name"], d["n"]) for i, d in docs.items()), sorted(rejected)


def test_change_log_equals_one_by_one_replay(spark, base):
    rng = np.random.default_rng(11)
    log = []
    for seq in range(600):
        i = 5 if seq % 3 == 0 else int(rng.integers(0, 8))
        op = str(rng.choice(["index", "update", "update", "delete"]))
        given = [f for f in ("name", "n") if rng.random() < 0.6] if op == "update" else []
        log.append((op, i, seq, f"v{seq}", None if rng.random() < 0.2 else seq, given))
    df = spark.createDataFrame(log, "op string, id int, seq bigint, name string, n int, given array<string>")
    docs, rejected = replay([tuple(r) for r in base.collect()], log)
    folded = store.fold_changes(base, df, "id", "seq", ["name", "n"])
    assert sorted(map(tuple, folded.collect())) == docs
    missed = store.rejected_updates(base, df, "id", "seq", seq_per_part=50)
    assert sorted((r["id"], r["seq"]) for r in missed.collect()) == rejected


# --- links and search ---


@pytest.fixture
def points(spark):
    texts = ["red shoes", "blue shoes", "green tea", "black tea", "tea pot"]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id bigint, text string")
    return make_points(df, hash_embedder(64), 64)


def test_links_collapse_equal_names_and_nest_in_order(spark, points):
    products = spark.createDataFrame([(0, "tea"), (1, "shoes"), (2, "tea")], "pos bigint, product_name string")
    flat = link_products(products, points, hash_embedder(64), 64, top_k=3, prefix="")
    docs = {r["product_name"]: r["keywords"] for r in nest_links(flat).collect()}
    assert set(docs) == {"tea", "shoes"}
    for hits in docs.values():
        assert len(hits) == 3
        assert [h["score"] for h in hits] == sorted([h["score"] for h in hits], reverse=True)
        assert all(h["score"] == round(h["score"], 6) for h in hits)


def test_product_without_hits_keeps_an_empty_list(spark, points):
    products = spark.createDataFrame([(0, "tea")], "pos bigint, product_name string")
    flat = link_products(products, points.limit(0), hash_embedder(64), 64, top_k=3)
    assert [tuple(r) for r in nest_links(flat).collect()] == [("tea", [])]


def test_equal_queries_collapse_or_stay(spark, points):
    queries = spark.createDataFrame([(0, "tea"), (1, "tea")], "query_id bigint, query string")
    kept = search_texts(queries, points, hash_embedder(64), 64, top_k=2)
    assert kept.count() == 4
    assert search_distinct(queries, points, hash_embedder(64), 64, top_k=2).count() == 2
    missing = search_texts(queries, points, hash_embedder(64), 64, top_k=1, payload_key="other")
    assert {r["other"] for r in missing.collect()} == {""}


def test_nested_conditions_hold_on_one_child(spark):
    rows = [("p", [("red tea", 1, 0.9), ("blue cup", 2, 0.5)])]
    df = spark.createDataFrame(rows, "product_name string, keywords array<struct<keyword:string,keyword_id:int,score:double>>")
    k = F.col("keywords")

    def hit(*conditions):
        return df.filter(nested.any_child(k, *conditions)).count() == 1

    assert hit(nested.mentions("Tea"), nested.score_at_least(0.85))
    assert not hit(nested.mentions("cup"), nested.score_at_least(0.85))
    assert hit(nested.equals("blue cup")) and not hit(nested.equals("blue"))
    inner = df.select(nested.matching_children(k, nested.score_at_least(0.1), size=1).alias("h")).first()["h"]
    assert [h["keyword_id"] for h in inner] == [1]
    shown, more = nested.preview(k, 1)
    assert df.select(F.size(shown), more).first()[:] == (1, 1)


def test_match_any_token_ranked(spark):
    docs = spark.createDataFrame(
        [(1, "red tea"), (2, "tea tea tea"), (3, "blue cup"), (4, "北海道ラーメン")], "doc_id bigint, text string"
    )
    queries = spark.createDataFrame([(0, "TEA cup"), (1, "ラーメン"), (2, "nothing")], "query_id bigint, query string")
    found = {}
    for r in match(docs, queries).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["doc_id"])
    assert set(found[0]) == {1, 2, 3}
    assert found[1] == [4]
    assert 2 not in found
    assert match(docs, queries, size=1).filter("query_id = 0").count() == 1


def test_match_takes_documents_in_runs_of_bounded_meetings():
    before = np.array([0, 3, 6, 20, 21, 22, 22])
    runs = list(fulltext._runs(before, 7))
    assert runs == [(0, 2), (2, 3), (3, 6)]
    assert list(fulltext._runs(np.array([0]), 7)) == []


# --- generator ---


def test_generated_texts_are_distinct_repeatable_and_bounded(spark):
    words = {"a": ["x", "y", "z"], "b": ["1", "2", "3", "4"]}
    templates = [Template(("a", "b"), 3), Template(("b", "a"))]
    texts = [r["text"] for r in generate_texts(spark, 20, words, templates).orderBy("pos").collect()]
    assert len(set(texts)) == 20
    assert texts == [r["text"] for r in generate_texts(spark, 20, words, templates).orderBy("pos").collect()]
    assert texts != [r["text"] for r in generate_texts(spark, 20, words, templates, seed=1).orderBy("pos").collect()]
    with pytest.raises(ValueError, match="at most 24"):
        generate_texts(spark, 25, words, templates)


def test_generator_gives_what_its_draws_hold_where_more_is_asked_for(spark):
    words = {"a": ["x", "y", "z"], "b": ["1", "2", "3", "4"]}
    templates = [Template(("a", "b"), 3), Template(("b", "a"))]
    drawn = [r["text"] for r in sample_texts(spark, 100, words, templates, 3).orderBy("row").collect()]
    texts = generate_texts(spark, 25, words, templates, seed=3, draws=100).orderBy("pos").collect()
    assert [(r["pos"], r["text"]) for r in texts] == list(enumerate(dict.fromkeys(drawn)))
    few = generate_texts(spark, 20, words, templates, seed=3, draws=10).orderBy("pos").collect()
    assert [r["text"] for r in few] == list(dict.fromkeys(drawn[:10]))


# --- streams ---


def write_texts(spark, path, texts):
    spark.createDataFrame([(t,) for t in texts], "keyword string").coalesce(1).write.mode("append").parquet(path)


def test_incremental_vectors_continue_ids_and_replay_changes_nothing(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "points")
    model = hash_embedder(16)
    write_texts(spark, source, ["a", "b", "c"])
    ingest.run_ingest(ingest.text_stream(spark, source), table, ingest.vector_step(table, model, 16))
    write_texts(spark, source, ["d", "e"])
    ingest.run_ingest(ingest.text_stream(spark, source), table, ingest.vector_step(table, model, 16))

    def state():
        rows = ingest.current_rows(spark, table, "point_id").collect()
        return sorted((r["point_id"], r["payload"]["keyword"]) for r in rows)

    assert state() == [(0, "a"), (1, "b"), (2, "c"), (3, "d"), (4, "e")]
    again = spark.createDataFrame([("d", "f", 0), ("e", "f", 1)], "text string, file string, row_in_file bigint")
    ingest.write_batch(ingest.vector_step(table, model, 16)(again, 1), table, 1)
    assert state() == [(0, "a"), (1, "b"), (2, "c"), (3, "d"), (4, "e")]
    ingest.run_ingest(ingest.text_stream(spark, source), table, ingest.vector_step(table, model, 16))
    assert len(state()) == 5


def test_documents_get_ids_behind_the_earlier_ones(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "docs")
    for texts in (["a", "b", "c"], ["d"], ["e", "f"]):
        write_texts(spark, source, texts)
        ingest.run_ingest(ingest.text_stream(spark, source), table, ingest.document_step(table))
    rows = ingest.current_rows(spark, table, "_id", within="pos").collect()
    assert sorted((r["_id"], r["keyword"]) for r in rows) == [(str(i), t) for i, t in enumerate("abcdef")]
    with pytest.raises(ValueError):
        ingest.document_step()


def test_equal_file_names_of_two_folders_keep_their_rows(spark, tmp_path):
    for folder in ("p=1", "p=2"):
        spark.createDataFrame([(f"{folder} {i}",) for i in range(50)], "keyword string").coalesce(1).write.parquet(str(tmp_path / "raw" / folder))
        part = next((tmp_path / "raw" / folder).glob("*.parquet"))
        (tmp_path / "in" / folder).mkdir(parents=True)
        (tmp_path / "in" / folder / "same name.parquet").write_bytes(part.read_bytes())
    table = str(tmp_path / "docs")
    ingest.run_ingest(ingest.text_stream(spark, str(tmp_path / "in")), table, ingest.document_step(table))
    rows = ingest.current_rows(spark, table, "_id", within="pos")
    assert rows.count() == 100 and rows.select("keyword").distinct().count() == 100


def test_tables_that_are_files_or_folders_arrive_whole(spark, tmp_path):
    folder = tmp_path / "a b%20c"
    for i, name in enumerate(("docs", "docs", "other")):
        spark.createDataFrame([(f"{name} {i} {j}",) for j in range(3)], "keyword string").coalesce(1).write.parquet(str(tmp_path / f"raw{i}"))
        to = folder / ("other.parquet" if name == "other" else f"docs.parquet/part-{i}.parquet")
        to.parent.mkdir(parents=True, exist_ok=True)
        to.write_bytes(next((tmp_path / f"raw{i}").glob("*.parquet")).read_bytes())
    for tables, n in ((("docs",), 6), (("other",), 3), (("docs", "other"), 9)):
        table = str(tmp_path / "-".join(tables))
        ingest.run_ingest(ingest.text_stream(spark, str(folder), tables=tables), table, ingest.document_step(table))
        rows = ingest.current_rows(spark, table, "_id", within="pos").collect()
        assert sorted(int(r["_id"]) for r in rows) == list(range(n)) and len({r["keyword"] for r in rows}) == n
        if tables == ("docs",):
            assert [r["keyword"] for r in sorted(rows, key=lambda r: int(r["_id"]))] == [f"docs {i} {j}" for i in range(2) for j in range(3)]


def test_stream_queries_read_tables_that_are_folders(spark, sf_dir, tmp_path):
    for name in ("documents", "benchmark"):
        whole = spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(60)
        key = whole.columns[0]
        parts = whole.orderBy(key).repartitionByRange(2, key).sortWithinPartitions(key)
        parts.write.parquet(str(tmp_path / f"{name}.parquet"))
    docs = sorted(spark.read.parquet(str(tmp_path / "documents.parquet")).select("doc_id", F.md5("text").alias("m")).collect())
    expected = [(str(i), r["m"]) for i, r in enumerate(docs)]
    found = QUERIES["ingest_default_ids"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found), key=lambda r: int(r[0])) == expected
    named = {r["_id"]: r["source_md5"] for r in QUERIES["ingest_documents"](spark, str(tmp_path)).collect()}
    assert len(named) == len(docs) + spark.read.parquet(str(tmp_path / "benchmark.parquet")).count()
    assert {i: m for i, m in named.items() if i.startswith("documents")} == {f"documents.parquet:{i}": m for i, m in expected}


def test_documents_restart_ids_and_overwrite(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "docs")
    for texts in (["a", "b", "c"], ["d"]):
        write_texts(spark, source, texts)
        ingest.run_ingest(ingest.text_stream(spark, source), table, ingest.document_step(id_mode="restart"))
    rows = ingest.current_rows(spark, table, "_id", within="pos").collect()
    assert sorted((r["_id"], r["keyword"]) for r in rows) == [("0", "d"), ("1", "b"), ("2", "c")]
    assert read_table(spark, table).count() == 4


def test_count_and_append_id_modes(spark, tmp_path):
    table = str(tmp_path / "points")
    spark.createDataFrame([(0,), (1,), (8,)], "point_id bigint").write.parquet(f"{table}/batch_id=0")
    assert ingest.next_id(spark, table, "point_id", 1, "append") == 9
    assert ingest.next_id(spark, table, "point_id", 1, "count") == 3
    assert ingest.next_id(spark, table, "point_id", 1, "restart") == 0
    assert ingest.next_id(spark, table, "point_id", 0, "append") == 0
    with pytest.raises(ValueError):
        ingest.next_id(spark, table, "point_id", 1, "other")


# --- pairing by position ---


def test_points_and_documents_from_separate_frames(spark):
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(3)], "pos bigint, vector array<float>")
    texts = spark.createDataFrame([(i, f"t{i}") for i in range(3)], "pos bigint, text string")
    ids = spark.createDataFrame([(i, f"id{i}") for i in range(3)], "pos bigint, point_id string")
    default = {r["point_id"]: r["payload"] for r in assemble_points(vectors, texts=texts, start_id=100).collect()}
    assert default == {100: {"keyword": "t0"}, 101: {"keyword": "t1"}, 102: {"keyword": "t2"}}
    custom = assemble_points(vectors, texts=texts, ids=ids, payload_key="name").collect()
    assert {r["point_id"]: r["payload"] for r in custom} == {f"id{i}": {"name": f"t{i}"} for i in range(3)}
    with pytest.raises(ValueError, match="ids has 2 rows, expected 3"):
        assemble_points(vectors, texts=texts, ids=ids.limit(2))
    with pytest.raises(ValueError, match="payloads has 1"):
        assemble_points(vectors, payloads=ids.limit(1))
    docs = assemble_documents(texts.withColumnRenamed("text", "name"), start_id=7).collect()
    assert sorted((r["_id"], r["name"]) for r in docs) == [("7", "t0"), ("8", "t1"), ("9", "t2")]


def test_work_folder_without_a_configured_one(spark, monkeypatch):
    from kindred import session

    class Unset:
        sparkContext = spark.sparkContext

        class conf:
            @staticmethod
            def get(key, default):
                return default

    assert session.work_root(Unset) == session.work_root(Unset)


# --- the ways beyond the broadcast limits ---


@pytest.fixture
def nothing_is_small(spark, monkeypatch):
    from kindred.operators import fulltext, link

    def never(df, n_rows, max_rows=0):
        return df

    for module in (store, fulltext, link):
        monkeypatch.setattr(module, "shipped", never)
    monkeypatch.setattr(store, "MAX_DOCUMENT_ROWS", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_change_log_beyond_the_limit(spark, base, nothing_is_small):
    test_change_log_equals_one_by_one_replay(spark, base)


def test_merges_beyond_the_limit(spark, base, nothing_is_small):
    test_upsert_last_write_wins_and_is_idempotent(spark, base)
    test_partial_update_sets_given_fields_only(spark, base)
    test_delete_ignores_unknown_ids(spark, base)


def test_match_and_links_beyond_the_limit(spark, points, nothing_is_small):
    test_match_any_token_ranked(spark)
    test_links_collapse_equal_names_and_nest_in_order(spark, points)


def test_hot_value_without_tie_is_split(spark):
    """One value in all rows: numbered without gaps by several tasks, with maps and nulls among the columns."""
    rows = spark.range(5_000).select(
        F.lit(7).alias("day"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("some"), F.col("id").alias("row"), F.create_map(F.lit("k"), F.col("id")).alias("extra")
    )
    bucketed = numbering._with_buckets(rows, "day", None, 16)
    sizes = [r["count"] for r in bucketed.groupBy("_bucket", "_sub").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 5_000 / 4
    numbered = numbering.dense_positions(rows, "day", n_buckets=16)
    assert numbered.columns == [*rows.columns, "pos"]
    assert sorted(r["pos"] for r in numbered.collect()) == list(range(5_000))
    mixed = rows.withColumn("day", F.when(F.col("row") < 4_000, 7).otherwise(F.col("row") % 5 + 5))
    got = numbering.dense_positions(mixed, "day", n_buckets=16).orderBy("pos").collect()
    days = [r["day"] for r in got]
    assert days == sorted(days) and [r["pos"] for r in got] == list(range(5_000))
