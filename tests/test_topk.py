import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.errors import PythonException

from kindred.operators import topk
from kindred.operators.cells import build_cells, topk_cells, topk_probed, train_centroids
from kindred.operators.kernel import PointBlock, RunningTopK, surplus_copies
from kindred.operators.topk import topk_join, topk_one

DIM = 8


def frame(spark, ids, matrix, id_type="bigint"):
    rows = [(i, [float(x) for x in v]) for i, v in zip(ids, matrix)]
    return spark.createDataFrame(rows, f"id {id_type}, vector array<float>")


def brute_force(queries, points, k):
    """{query id: [(point id, score)]} by plain double precision loops."""
    out = {}
    for qid, q in queries:
        q = np.float32(q).astype(float)
        scored = []
        for pid, p in points:
            p = np.float32(p).astype(float)
            norms = np.sqrt((q * q).sum()) * np.sqrt((p * p).sum())
            scored.append((-(float((q * p).sum() / norms) if norms else 0.0), pid))
        scored.sort(key=lambda s: (round(s[0], 12), s[1]))
        out[qid] = [(pid, -s) for s, pid in scored[:k]]
    return out


def as_dict(df):
    out = {}
    for row in df.orderBy("query_id", "rank").collect():
        out.setdefault(row["query_id"], []).append((row["point_id"], row["score"], row["rank"]))
    return out


def assert_same(df, expected):
    found = as_dict(df)
    assert found.keys() == expected.keys()
    for qid, hits in expected.items():
        assert [h[0] for h in found[qid]] == [h[0] for h in hits], qid
        assert [h[2] for h in found[qid]] == list(range(1, len(hits) + 1))
        assert np.allclose([h[1] for h in found[qid]], [h[1] for h in hits], atol=1e-12)


@pytest.fixture(scope="module")
def data():
    """A third of the points are copies of one vector; one is the zero vector."""
    rng = np.random.default_rng(5)
    points = rng.normal(size=(300, DIM))
    points[100:200] = points[0]
    points[250] = 0
    queries = np.vstack([rng.normal(size=(38, DIM)), points[0] + 1e-3, np.zeros(DIM)])
    return list(enumerate(queries)), list(enumerate(points))


@pytest.mark.parametrize(
    "options",
    [
        {"strategy": "points"},
        {"strategy": "queries"},
        {"strategy": "grid"},
        {"strategy": "grid", "part_bytes": 4 * DIM * 20},
        {"strategy": "auto"},
        {"strategy": "auto", "broadcast_bytes": 4 * DIM * 50},
        {"strategy": "auto", "broadcast_bytes": 4 * DIM * 5},
    ],
)
def test_strategies_equal_brute_force(spark, data, options):
    queries, points = data
    q, p = frame(spark, *zip(*queries)), frame(spark, *zip(*points))
    found = topk_join(q, p, 7, DIM, query_id="id", point_id="id", **options)
    assert_same(found, brute_force(queries, points, 7))


def test_string_keys(spark, data):
    queries, points = data
    queries = [(f"q{i}", v) for i, v in queries[:5]]
    points = [(f"p{i:03d}", v) for i, v in points]
    q, p = frame(spark, *zip(*queries), "string"), frame(spark, *zip(*points), "string")
    expected = brute_force(queries, points, 4)
    for strategy in ("points", "queries", "grid"):
        assert_same(topk_join(q, p, 4, DIM, query_id="id", point_id="id", strategy=strategy), expected)


def test_fewer_points_than_k(spark, data):
    queries, points = data
    q, p = frame(spark, *zip(*queries)), frame(spark, *zip(*points[:3]))
    assert_same(topk_join(q, p, 7, DIM, query_id="id", point_id="id"), brute_force(queries, points[:3], 7))


def test_no_points(spark, data):
    q = frame(spark, *zip(*data[0]))
    empty = q.limit(0)
    for strategy in ("points", "queries", "grid"):
        assert topk_join(q, empty, 3, DIM, query_id="id", point_id="id", strategy=strategy).count() == 0


def test_side_beyond_its_bound_is_refused(spark, data):
    q, p = frame(spark, *zip(*data[0])), frame(spark, *zip(*data[1]))
    with pytest.raises(ValueError, match="grid"):
        topk_join(q, p, 3, DIM, query_id="id", point_id="id", strategy="points", broadcast_bytes=4 * DIM * 10)


def test_wrong_dimension_fails(spark, data):
    q = frame(spark, *zip(*data[0]))
    bad = spark.createDataFrame([(1, [1.0, 2.0])], "id bigint, vector array<float>")
    with pytest.raises((ValueError, PythonException)):
        topk_join(q, bad, 3, DIM, query_id="id", point_id="id").collect()


def test_nan_never_matches(spark):
    q = spark.createDataFrame([(0, [1.0, 0.0])], "id bigint, vector array<float>")
    p = spark.createDataFrame([(1, [float("nan"), 0.0]), (2, [0.0, 1.0])], "id bigint, vector array<float>")
    assert [r["point_id"] for r in topk_join(q, p, 5, 2, query_id="id", point_id="id").collect()] == [2]


def test_one_query_plan_is_a_per_task_topk(spark, data):
    p = frame(spark, *zip(*data[1]))
    asked = data[0][3]
    found = topk_one(p, list(np.float32(asked[1])), 5, point_id="id")
    expected = brute_force([asked], data[1], 5)[3]
    assert [(r["point_id"], round(r["score"], 9)) for r in found.collect()] == [(i, round(s, 9)) for i, s in expected]
    assert "TakeOrderedAndProject" in found._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(9)
    centers = rng.normal(size=(6, DIM)) * 4
    # one cluster holds a third of all points
    sizes = [200, 80, 80, 80, 80, 80]
    points = np.vstack([c + rng.normal(size=(n, DIM)) * 0.3 for c, n in zip(centers, sizes)])
    queries = np.vstack([c + rng.normal(size=(10, DIM)) * 0.6 for c in centers])
    return list(enumerate(queries)), list(enumerate(points))


def test_cell_search_is_exact_and_probing_has_recall(spark, clustered):
    queries, points = clustered
    q, p = frame(spark, *zip(*queries)), frame(spark, *zip(*points))
    index = build_cells(p, train_centroids(p, 12, DIM), DIM, point_id="id")
    expected = brute_force(queries, points, 10)
    small_parts = {"query_id": "id", "part_bytes": 4 * DIM * 40}
    assert_same(topk_cells(q, index, 10, 1, **small_parts), expected)
    probed = as_dict(topk_probed(q, index, 10, 3, **small_parts))
    found = sum(len({h[0] for h in probed[i]} & {h[0] for h in expected[i]}) for i in expected)
    assert found / (10 * len(expected)) >= 0.9


def test_copies_beyond_k_are_left_out_of_a_block():
    matrix = np.float32(np.vstack([np.ones((6, 3)), np.eye(3)]))
    ids = np.array([5, 1, 4, 0, 3, 2, 6, 7, 8])
    assert ids[surplus_copies(ids, matrix, 2)].tolist() == [5, 4, 3, 2]


def test_running_topk_over_many_blocks_equals_one_block():
    rng = np.random.default_rng(3)
    points, queries = rng.normal(size=(1000, 5)).astype(np.float32), rng.normal(size=(20, 5)).astype(np.float32)
    ids = rng.permutation(1000)
    whole, parts = RunningTopK(queries, 9), RunningTopK(queries, 9)
    whole.update(PointBlock(ids, points, 9))
    for s in range(0, 1000, 37):
        parts.update(PointBlock(ids[s : s + 37], points[s : s + 37], 9))
    assert whole.point.tolist() == parts.point.tolist()
    assert whole.score.tolist() == parts.score.tolist()


def _grid(spark, n_points, part_rows, k):
    rng = np.random.default_rng(9)
    queries = frame(spark, range(40), rng.normal(size=(40, DIM)))
    points = frame(spark, range(n_points), rng.normal(size=(n_points, DIM)))
    q = topk.query_side(queries, "id", "vector")
    p = topk.point_side(points, "id", "vector")
    return queries, points, topk.grid_hits(q, p, k, DIM, 40, n_points, part_rows)


def test_hits_that_are_shuffled_do_not_grow_with_the_parts(spark):
    """Five times the parts send the same hits: some k / share per query, not k per query and part."""
    k, n_points = 5, 3_000
    _, _, few = _grid(spark, n_points, 100, k)
    queries, points, many = _grid(spark, n_points, 20, k)
    n_few, n_many = few.count(), many.count()
    assert n_many < 1.2 * n_few
    assert n_many < 1.5 * 40 * k * topk.SAMPLE_SHARE < 40 * k * 150 / 4
    expected = {r["id"]: r["vector"] for r in points.collect()}
    truth = brute_force([(r["id"], r["vector"]) for r in queries.collect()], list(expected.items()), k)
    assert_same(topk.best_per_query(many, k), truth)


@pytest.mark.parametrize("strategy", ["queries", "grid"])
def test_floors_keep_ties_and_queries_without_enough_hits(spark, strategy):
    """Copies tie with the k-th hit of the sample; ids decide. One query has no direction, one is null."""
    rng = np.random.default_rng(4)
    matrix = np.repeat(rng.normal(size=(30, DIM)), 40, axis=0)
    points = frame(spark, range(len(matrix)), matrix)
    queries = np.vstack([matrix[::240], np.zeros(DIM)])
    asked = frame(spark, range(len(queries)), queries)
    truth = brute_force(list(enumerate(queries)), list(enumerate(matrix)), 6)
    assert_same(topk_join(asked, points, 6, DIM, query_id="id", point_id="id", strategy=strategy, part_bytes=4 * DIM * 100), truth)
    assert topk.sampled(topk.point_side(points, "id", "vector")).count() > 0


def test_a_floor_drops_what_is_below(spark):
    rng = np.random.default_rng(2)
    queries, points = rng.normal(size=(5, DIM)).astype("float32"), rng.normal(size=(200, DIM)).astype("float32")
    free, bound = RunningTopK(queries, 7), RunningTopK(queries, 7, np.full(5, 0.5))
    for running in (free, bound):
        running.update(PointBlock(np.arange(200), points, 7))
    high = free.score >= 0.5
    assert np.array_equal(bound.score, free.score[high]) and np.array_equal(bound.point, free.point[high])


def test_queries_are_shipped_in_blocks_and_of_two_small_sides_the_smaller(spark, data, monkeypatch):
    q, p = frame(spark, *zip(*data[0])), frame(spark, *zip(*data[1]))
    shipped = []
    bounded = topk._bounded
    monkeypatch.setattr(topk, "_bounded", lambda side, most: shipped.append((side.columns[0], bounded(side, most))) or shipped[-1][1])
    assert len(data[0]) < len(data[1])
    expected = brute_force(*data, 3)
    assert_same(topk_join(q, p, 3, DIM, query_id="id", point_id="id"), expected)
    assert {name for name, _ in shipped} == {"query_id"}
    shipped.clear()
    monkeypatch.setattr(topk, "BLOCK_BYTES", 4 * DIM * 5)
    assert_same(topk_join(q, p, 3, DIM, query_id="id", point_id="id", strategy="queries"), expected)
    assert len(shipped) >= len(data[0]) // 5 and max(table.num_rows for _, table in shipped) < len(data[0])


def test_rows_are_copied_no_more_often_than_tasks_need(spark, monkeypatch):
    """Parts far below what a task can hold: each row is in LEAST_PARTS groups, not in one per part of the other side."""
    asked = []
    in_cells = topk.topk_in_cells
    monkeypatch.setattr(topk, "topk_in_cells", lambda *a, **parts: asked.append(parts) or in_cells(*a, **parts))
    _grid(spark, 2_000, 10, 3)
    most = [spark.range(1).select(F.greatest(p["query_parts"], p["point_parts"])).first()[0] for p in asked]
    assert most and max(most) <= topk.LEAST_PARTS


def test_all_groups_of_queries_are_searched(spark, data, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES_AT_ONCE", 4)
    q, p = frame(spark, *zip(*data[0])), frame(spark, *zip(*data[1]))
    assert_same(topk_join(q, p, 3, DIM, query_id="id", point_id="id", strategy="grid"), brute_force(*data, 3))
