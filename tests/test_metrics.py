import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import decision, metrics, ranking

BY = ["model"]
SCHEMA = "model string, y_true int, y_proba double"


def scores(spark, labels, probabilities, model="m"):
    return spark.createDataFrame([(model, int(y), float(p)) for y, p in zip(labels, probabilities)], SCHEMA)


def test_stored_run(spark):
    """17 / 73 / 16 / 2516 at grid index 74 gives the recorded metrics to all digits."""
    high, low = metrics.GRID_TRAIN[74], metrics.GRID_TRAIN[73]
    labels = [1] * 17 + [0] * 73 + [1] * 16 + [0] * 2516
    values = [high] * 90 + [low] * 2532
    best = metrics.best_threshold(metrics.threshold_sweep(scores(spark, labels, values), metrics.GRID_TRAIN, BY), BY)
    row = best.withColumns(metrics.derived_metrics()).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (2516, 73, 16, 17)
    assert row["best_thr"] == 0.37442211055276386 and row["thr_index"] == 74
    assert (row["precision"], row["recall"], row["fpr"]) == (0.18888888888888888, 0.5151515151515151, 0.028196214754731556)
    assert row["fbeta"] == pytest.approx(0.38288288288288286, abs=1e-16)


def test_grids_equal_numpy():
    for grid, args in ((metrics.GRID_TRAIN, (0.01, 0.99, 200)), (metrics.GRID_EVALUATE, (0.01, 0.99, 99)), (metrics.GRID_WEIGHTED, (0.05, 0.95, 50))):
        assert grid == np.linspace(*args).tolist()


def test_auc_with_ties(spark):
    df = scores(spark, [0, 0, 1, 1, 0, 1], [0.1, 0.4, 0.4, 0.8, 0.8, 0.9])
    assert metrics.roc_auc(df, BY).first()["roc_auc"] == pytest.approx(0.7777777777777777)


def test_auc_of_one_class_is_null(spark):
    assert metrics.roc_auc(scores(spark, [1, 1], [0.1, 0.2]), BY).first()["roc_auc"] is None


@pytest.mark.parametrize("grid", [metrics.GRID_TRAIN, metrics.GRID_EVALUATE, metrics.GRID_WEIGHTED])
def test_sweep_equals_brute_force(spark, grid):
    rng = np.random.default_rng(5)
    near = [np.nextafter(g, d) for g in grid[::7] for d in (0, 1)]
    p = np.concatenate([rng.random(300), grid, near, [0.0, 1.0, 0.00999]])
    y = (rng.random(len(p)) < 0.3).astype(int)
    rows = {r["thr_index"]: r for r in metrics.threshold_sweep(scores(spark, y, p), grid, BY).collect()}
    assert len(rows) == len(grid)
    for n, t in enumerate(grid):
        hit = p >= t
        expected = (((y == 0) & ~hit).sum(), ((y == 0) & hit).sum(), ((y == 1) & ~hit).sum(), ((y == 1) & hit).sum())
        assert (rows[n]["tn"], rows[n]["fp"], rows[n]["fn"], rows[n]["tp"]) == expected


def test_lowest_threshold_wins_ties(spark):
    best = metrics.best_threshold(metrics.threshold_sweep(scores(spark, [0, 1], [0.2, 0.9]), metrics.GRID_EVALUATE, BY), BY).first()
    first = next(n for n, t in enumerate(metrics.GRID_EVALUATE) if t > 0.2)
    assert best["thr_index"] == first and best["fbeta"] == 1.0


def test_curves_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    p, y = np.round(rng.random(400), 2), (rng.random(400) < 0.4).astype(int)
    rows = {r["thr"]: r for r in metrics.roc_curve(scores(spark, y, p), BY).collect()}
    pr = {r["thr"]: r for r in metrics.pr_curve(scores(spark, y, p), BY).collect()}
    assert set(rows) == set(p.tolist())
    for t in rows:
        hit = p >= t
        assert rows[t]["tpr"] == pytest.approx((hit & (y == 1)).sum() / (y == 1).sum())
        assert rows[t]["fpr"] == pytest.approx((hit & (y == 0)).sum() / (y == 0).sum())
        assert pr[t]["precision"] == pytest.approx((hit & (y == 1)).sum() / hit.sum())


def test_running_sums_have_no_global_sort(spark):
    df = spark.range(5000).select(F.floor(F.col("id") / 1e9).cast("string").alias("g"), (F.col("id") % 977).cast("double").alias("v"), F.lit(1).alias("n"))
    counted = df.groupBy("g", "v").agg(F.sum("n").alias("n"))
    out = ranking.running_sums(counted, ["g"], "v", ["n"], ranges=8)
    rows = sorted((r["v"], r["cum_n"]) for r in out.collect())
    assert rows[0][1] == 5000 and rows[-1][1] == counted.where("v = 976").first()["n"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_report_and_zero_denominators(spark):
    counts = metrics.confusion(scores(spark, [0, 0, 1], [0.1, 0.2, 0.3]), 0.5, BY)
    rows = {r["label"]: r for r in metrics.classification_report(counts, BY).collect()}
    assert rows["1"]["precision"] == 0.0 and rows["0"]["recall"] == 1.0 and rows["accuracy"]["f1"] == pytest.approx(2 / 3)
    shares = {(r["actual"], r["predicted"]): r["share"] for r in metrics.normalised_confusion(counts, BY).collect()}
    assert shares == {(0, 0): 1.0, (0, 1): 0.0, (1, 0): 1.0, (1, 1): 0.0}


def test_routing(spark):
    df = spark.createDataFrame([(0.1,), (0.4,), (0.7,), (1.0,), (None,)], "p double")
    got = [tuple(r) for r in df.select(decision.route_decision(F.col("p"), "threshold", 0.4, 0.7), decision.route_decision(F.col("p"), "reference")).collect()]
    assert [g[0] for g in got] == ["APPROVE", "REVIEW", "DECLINE", "DECLINE", "REVIEW"]
    assert [g[1] for g in got] == ["DECLINE"] * 3 + ["APPROVE", "DECLINE"]


def test_champion_ties_by_name(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", None)], "model string, F2 double")
    assert ranking.champion(df).first()["model"] == "a"
    assert [r["model"] for r in ranking.rank_models(df).collect()] == ["a", "b", "c"]
