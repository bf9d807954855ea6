import glob
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import anomaly, knn
from riskspark.operators.knn import as_points, knn_join
from riskspark.session import shared_dir

PARTITIONED = {"broadcast_values": 0, "pivots": 6, "block_rows": 16}


def frame(spark, matrix, start=0):
    rows = [(start + n, *map(float, v)) for n, v in enumerate(matrix)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"x{d} double" for d in range(matrix.shape[1])))


def columns(matrix):
    return [f"x{d}" for d in range(matrix.shape[1])]


def brute(a, b, k, weights=None):
    dist = np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2))
    order = np.lexsort((np.broadcast_to(np.arange(len(b)), dist.shape), dist))[:, :k]
    return dist, order


@pytest.mark.parametrize("options", [{}, PARTITIONED])
@pytest.mark.parametrize("kind", ["spread", "clustered", "copies"])
def test_knn_equals_brute_force(spark, options, kind):
    rng = np.random.default_rng(4)
    base = {
        "spread": rng.normal(size=(150, 3)),
        "clustered": np.concatenate([rng.normal(size=(120, 3)) * 0.01, rng.normal(size=(30, 3)) * 100]),
        "copies": np.concatenate([np.zeros((70, 3)), rng.normal(size=(80, 3))]),
    }[kind]
    query = np.concatenate([rng.normal(size=(20, 3)), base[:10]])
    q, b = frame(spark, query), frame(spark, base)
    got = {}
    for r in knn_join(as_points(q, "id", columns(query)), as_points(b, "id", columns(base)), 7, **options).collect():
        got.setdefault(r["query_id"], []).append((r["distance"], r["base_id"]))
    dist, order = brute(query, base, 7)
    for n in range(len(query)):
        assert [i for _, i in sorted(got[n])] == [int(i) for i in order[n]]


def test_knn_with_fewer_rows_than_k(spark):
    m = np.arange(6.0).reshape(3, 2)
    for options in ({}, PARTITIONED):
        assert knn_join(as_points(frame(spark, m), "id", columns(m)), as_points(frame(spark, m), "id", columns(m)), 10, **options).count() == 9


def test_knn_category_cost(spark):
    df = spark.createDataFrame([(0, 0.0, "a"), (1, 1.0, "b"), (2, 2.0, "a")], "id long, x double, c string")
    points = as_points(df, "id", ["x"], ["c"])
    for options in ({}, PARTITIONED):
        got = {(r["query_id"], r["base_id"]): r["distance"] for r in knn_join(points, points, 3, 3.0, **options).collect()}
        assert got[(0, 1)] == pytest.approx(math.sqrt(1 + 9)) and got[(0, 2)] == 2.0


def numpy_lof(train, test, k, contamination=0.01):
    """Novelty LOF with the training rows scored as new data."""
    k = min(k, len(train) - 1)

    def density(dist, order, radius):
        return 1.0 / (np.maximum(np.take_along_axis(dist, order, 1), radius[order]).mean(axis=1) + 1e-10)

    dist, _ = brute(train, train, 1)
    fit = dist.copy()
    np.fill_diagonal(fit, np.inf)
    fit_order = np.lexsort((np.broadcast_to(np.arange(len(train)), fit.shape), fit))[:, :k]
    radius = np.take_along_axis(fit, fit_order, 1)[:, -1]
    lrd = density(fit, fit_order, radius)
    offset = np.quantile(-(lrd[fit_order].mean(axis=1) / lrd), contamination)
    d, order = brute(test, train, k)
    return lrd[order].mean(axis=1) / density(d, order, radius) + offset


@pytest.mark.parametrize("options", [{}, PARTITIONED])
def test_lof_equals_numpy(spark, options):
    rng = np.random.default_rng(8)
    train, test = rng.normal(size=(90, 3)), np.concatenate([rng.normal(size=(9, 3)), [[9.0, 9.0, 9.0]]])
    a, b = frame(spark, train), frame(spark, test)
    scored = anomaly.local_outlier_factor(a, [a, b], "id", columns(train), 10, **options)
    for df, rows in zip(scored, (train, test)):
        got = [r["lof_score"] for r in df.orderBy("id").collect()]
        assert got == pytest.approx(numpy_lof(train, rows, 10).tolist(), rel=1e-9)


def test_lof_with_copies_keeps_every_row(spark):
    rng = np.random.default_rng(9)
    train = np.concatenate([np.ones((60, 2)), rng.normal(size=(60, 2))])
    a = frame(spark, train)
    (scored,) = anomaly.local_outlier_factor(a, [a], "id", columns(train), 10)
    got = {r["id"]: r["lof_score"] for r in scored.collect()}
    assert len(got) == 120 and len({got[n] for n in range(60)}) == 1


def test_average_path():
    got = anomaly.average_path([0, 1, 2, 3, 256])
    harmonic = lambda n: math.log(n) + 0.5772156649015329
    assert got.tolist() == pytest.approx([0, 0, 1, 2 * harmonic(2) - 4 / 3, 2 * harmonic(255) - 2 * 255 / 256])


def test_tree_partitions_its_rows():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(64, 3))
    nodes = {n[0]: n for n in anomaly.grow_tree(rows, 6, np.random.default_rng(2))}
    assert len(nodes) <= 127 and set(nodes) == set(range(len(nodes)))
    for node, feature, _, left, right, path in nodes.values():
        assert (feature < 0 and path >= 0) or {left, right} <= set(nodes)


def test_forest_ranks_the_outlier_first(spark):
    rng = np.random.default_rng(3)
    rows = np.concatenate([rng.normal(size=(299, 4)), [[12.0, -12.0, 12.0, -12.0]]])
    df = frame(spark, rows)
    first, = anomaly.isolation_forest(df, [df], "id", columns(rows), n_trees=40)
    again, = anomaly.isolation_forest(df, [df], "id", columns(rows), n_trees=40)
    got = {r["id"]: r["iforest_score"] for r in first.collect()}
    assert all(0 < v <= 1 for v in got.values()) and max(got, key=got.get) == 299
    assert got == {r["id"]: r["iforest_score"] for r in again.collect()}


def test_forest_thins_a_large_frame(spark):
    """Above the pool size a bounded random part is used, copies of one key included."""
    df = spark.range(9000).select((F.col("id") % 3).alias("id"), F.rand(1).alias("x0"), F.rand(2).alias("x1"))
    nodes, per_tree = anomaly.fit_forest(df, "id", ["x0", "x1"], n_trees=5)
    frame_ = nodes.toPandas()
    assert per_tree == 256 and frame_.tree.nunique() == 5 and (frame_.groupby("tree").size() <= 511).all()


def test_forest_draws_from_all_rows(spark):
    """Trees share no pool, partitions do not matter, and copies of a row are drawn as often as other rows."""
    df = spark.range(20_000).select("id", F.least("id", F.lit(10_000)).cast("double").alias("x0"), F.when(F.col("id") < 10_000, F.col("id")).otherwise(-1).alias("k"))
    trees = [anomaly.draw_rows(part, "k", ["x0"], n_trees=40)[0].select("tree", "place", F.col("vec")[0].alias("x")).toPandas() for part in (df.repartition(3), df.repartition(7))]
    first, second = (t.sort_values(["tree", "place"]).reset_index(drop=True) for t in trees)
    assert first.equals(second) and (first.groupby("tree").size() == 256).all() and first.tree.nunique() == 40
    assert abs((first.x == 10_000).mean() - 0.5) < 0.03 and first.x.nunique() > 3_500
    nodes = [anomaly.fit_forest(part, "k", ["x0"], n_trees=5)[0].toPandas().sort_values(["tree", "node"]).reset_index(drop=True) for part in (df.repartition(3), df.repartition(7))]
    assert nodes[0].equals(nodes[1])


def test_numeric_columns_include_ids(spark):
    df = spark.createDataFrame([(1, 2, 0, "a", 0.5)], "cst_dim_id long, docno long, target int, kind string, x double")
    assert anomaly.anomaly_columns(df, "target") == ["cst_dim_id", "docno", "x"]


@pytest.mark.parametrize("options", [{}, {"block_rows": 13}, {"broadcast_values": 0, "pivots": 9, "block_rows": 40}])
def test_knn_far_from_the_origin_with_copies_and_categories(spark, options):
    """Coordinates of very different sizes, for which a product of whole rows would lose the small ones."""
    rng = np.random.default_rng(6)
    rows = np.concatenate([rng.normal(size=(140, 4)) * [1, 1e-3, 1e4, 1] + [1e9, 0, 1e10, 5], np.full((20, 4), 3.0)])
    kinds = rng.integers(0, 2, len(rows))
    df = frame(spark, rows).withColumn("kind", F.element_at(F.array(*[F.lit(int(v)) for v in kinds]), (F.col("id") + 1).cast("int")))
    points = as_points(df, "id", columns(rows), ["kind"], weight=F.col("id") % 3 + 1)
    got = {}
    for r in knn_join(points, points, 6, 0.5, **options).collect():
        got.setdefault(r["query_id"], []).append((r["distance"], r["base_id"], r["weight"]))
    square = ((rows[:, None, :] - rows[None, :, :]) ** 2).sum(axis=2) + 0.25 * (kinds[:, None] != kinds[None, :])
    for n in range(len(rows)):
        found, total = [], 0
        for i in np.lexsort((np.arange(len(rows)), square[n])):
            if total >= 6:
                break
            found.append((int(i), int(i) % 3 + 1))
            total += int(i) % 3 + 1
        assert [(i, w) for _, i, w in sorted(got[n])] == found


def test_knn_stores_each_query_row_once(spark):
    """Where every cell may hold a neighbour, as in many dimensions, blocks come to groups of rows; rows are not copied for each cell."""
    m = np.random.default_rng(7).normal(size=(200, 24))
    points = as_points(frame(spark, m), "id", columns(m))
    before = set(glob.glob(f"{shared_dir(spark)}/knn-query-*"))
    assert knn_join(points, points, 5, broadcast_values=0, pivots=12, block_rows=64).count() == 1000
    (stored,) = set(glob.glob(f"{shared_dir(spark)}/knn-query-*")) - before
    assert spark.read.parquet(stored).count() == 200


def test_blocks_of_a_larger_base_stay_small_and_few_come_to_a_group(spark, monkeypatch):
    """Cells follow the base's size, whatever its widest column looks like; a group gets the blocks that can hold a neighbour only."""
    monkeypatch.setattr(knn, "CELL_ROWS", 4)
    rng = np.random.default_rng(11)
    m = np.stack([rng.pareto(0.5, 4000) * 1e6, rng.normal(size=4000) * 1e3, np.arange(4000.0)], axis=1)
    points = as_points(frame(spark, m), "id", columns(m))
    before = set(glob.glob(f"{shared_dir(spark)}/knn-*"))
    got = {}
    for r in knn_join(points, points, 3, broadcast_values=0).collect():
        got.setdefault(r["query_id"], []).append((r["distance"], r["base_id"]))
    _, order = brute(m, m, 3)
    assert [[i for _, i in sorted(got[n])] for n in range(4000)] == order.tolist()
    stored = {p.split("knn-")[1].split("-")[0]: spark.read.parquet(p) for p in set(glob.glob(f"{shared_dir(spark)}/knn-*")) - before}
    blocks, visits = stored["blocks"], stored["visits"]
    assert blocks.count() > 512 and blocks.agg(F.max(F.length("ids") / 8)).first()[0] < 100
    assert blocks.count() * visits.agg(F.countDistinct("grp")).first()[0] > 4 * visits.count()


def test_cells_hold_any_points():
    rng = np.random.default_rng(12)
    odd = np.array([[np.inf, 1.0], [-np.inf, 2.0], [np.nan, np.nan], [1e300, -1e300]])
    for points in (np.empty((0, 0)), np.zeros((50, 2)), odd, np.concatenate([odd, rng.normal(size=(60, 2))]), np.repeat(rng.normal(size=(5, 2)), 20, axis=0)):
        tree = knn._Cells.of(points, 8)
        cells = tree.find(points)
        assert len(cells) == len(points) and set(cells) <= set(range((tree.feature < 0).sum()))
    assert len(set(cells)) == 5  # equal points are in one cell


def test_lof_of_train_rows_needs_one_search(spark, monkeypatch):
    m = np.random.default_rng(8).normal(size=(60, 3))
    a, calls = frame(spark, m), []
    monkeypatch.setattr(anomaly, "knn_join", lambda *args, **kw: calls.append(1) or knn_join(*args, **kw))
    (scored,) = anomaly.local_outlier_factor(a, [a], "id", columns(m), 10)
    assert len(calls) == 1
    assert [r["lof_score"] for r in scored.orderBy("id").collect()] == pytest.approx(numpy_lof(m, m, 10).tolist(), rel=1e-9)


def test_a_broadcast_base_is_searched_in_boxes(spark, monkeypatch):
    """Parts hold all points once, no point is nearer than its box, and the join over many boxes equals brute force."""
    rng = np.random.default_rng(9)
    base, query = rng.normal(size=(300, 4)) * [1, 30, 1e-3, 5], rng.normal(size=(40, 4)) * [2, 50, 1, 5]
    parts = knn._near_parts(base, 16)
    assert sorted(np.concatenate(parts)) == list(range(300)) and max(map(len, parts)) <= 16
    away = knn._box_distances(query, np.array([base[p].min(axis=0) for p in parts]), np.array([base[p].max(axis=0) for p in parts]))
    dist, order = brute(query, base, 7)
    assert all((away[:, i] <= dist[:, p].min(axis=1)).all() for i, p in enumerate(parts))
    monkeypatch.setattr(knn, "BOX_ROWS", 16)
    got = {}
    for r in knn_join(as_points(frame(spark, query), "id", columns(query)), as_points(frame(spark, base), "id", columns(base)), 7).collect():
        got.setdefault(r["query_id"], []).append((r["distance"], r["base_id"]))
    assert [[i for _, i in sorted(got[n])] for n in range(len(query))] == order.tolist()


def test_fitted_anomaly_models_score_any_number_of_frames(spark, monkeypatch):
    m = np.random.default_rng(10).normal(size=(60, 3))
    train, more, calls = frame(spark, m).withColumn("target", F.lit(0)), frame(spark, m[:9] + 0.1, 100).withColumn("target", F.lit(0)), []
    both = anomaly.add_anomaly_features(train, more, "id", n_trees=20, neighbours=10)[1].select("id", "iforest_score", "lof_score")
    expected = {tuple(r) for r in both.collect()}
    monkeypatch.setattr(anomaly, "knn_join", lambda *args, **kw: calls.append(1) or knn_join(*args, **kw))
    models, _ = anomaly.fit_anomaly_models(train, "id", n_trees=20, neighbours=10)
    assert len(calls) == 1
    for _ in range(2):
        assert {tuple(r) for r in models.score(more, "id").select("id", "iforest_score", "lof_score").collect()} == expected
    assert len(calls) == 3
