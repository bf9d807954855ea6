"""Histogram boosting, ordered category means, attributions and the scorer against plain numpy."""

from dataclasses import replace
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.functions.hashing import hash_rank
from riskspark.operators import metrics
from riskspark.operators.target_means import apply_target_means, fit_target_means, mean_column, ordered_target_means
from riskspark.plans import scoring, training, trees
from riskspark.plans.trees import BINS, Boosting, TreeModel


def numbers(n, seed=0, width=6):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 9, (n, width)).astype(float)
    x[rng.random((n, width)) < 0.05] = np.nan
    y = (np.nan_to_num(x[:, 0]) * np.nan_to_num(x[:, 1]) + rng.normal(0, 4, n) > 16).astype(float)
    return x, y


def frame(spark, x, y, watched=None):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], float(t), 1.0 + i % 2, bool(watched is not None and watched[i])) for i, (r, t) in enumerate(zip(x, y))]
    names = [f"f{j}" for j in range(x.shape[1])]
    return spark.createDataFrame(rows, "docno long, " + ", ".join(f"{n} double" for n in names) + ", target double, w double, held boolean").repartition(3), names


def plain_boosting(x, y, w, setup):
    """The same trees, with every cut between values tried on all rows."""
    x = np.where(np.isnan(x), -np.inf, x)
    share = (y * w).sum() / w.sum()
    margin = np.full(len(y), np.log(share / (1 - share)))
    gains = []
    for _ in range(setup.rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        leaves = [np.arange(len(y))]
        for _ in range(setup.depth):
            after = []
            for rows in leaves:
                best = (1e-9, None)
                score = lambda r: g[r].sum() ** 2 / (h[r].sum() + setup.penalty)
                for f in range(x.shape[1]):
                    for cut in np.unique(x[rows, f])[:-1]:
                        left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                        gain = 0.5 * (score(left) + score(right) - score(rows))
                        if min(w[left].sum(), w[right].sum()) >= setup.least_cover and gain > best[0] + 1e-9:
                            best = (gain, (left, right))
                if best[1] is None:
                    after.append(rows)
                else:
                    gains.append(best[0])
                    after += best[1]
            leaves = after
        for rows in leaves:
            margin[rows] -= setup.rate * g[rows].sum() / (h[rows].sum() + setup.penalty)
    return margin, sorted(gains)


def test_trees_equal_plain_numpy(spark):
    x, y = numbers(400)
    df, names = frame(spark, x, y)
    setup = Boosting(rounds=3, depth=3, rate=0.3, row_share=1.1, feature_share=1.0)
    fitted, base, losses = trees.fit_trees(df, names, "target", "w", "held", setup)
    margin, gains = plain_boosting(x, y, 1.0 + np.arange(400) % 2, setup)
    assert losses == [] and len(fitted) == 3
    assert base + fitted.margin(x) == pytest.approx(margin)
    assert sorted(fitted.gain[fitted.feature >= 0]) == pytest.approx(gains)


def test_margins_are_carried(spark, monkeypatch):
    x, y = numbers(300, 1)
    df, names = frame(spark, x, y)
    setup = Boosting(rounds=5, depth=2, rate=0.3)
    whole = trees.fit_trees(df.coalesce(1), names, "target", "w", "held", setup)[0]
    monkeypatch.setattr(trees, "CARRY", 2)
    again = trees.fit_trees(df.coalesce(1), names, "target", "w", "held", setup)[0]
    assert again.margin(x) == pytest.approx(whole.margin(x)) and len(np.unique(whole.margin(x))) > 5


def test_rows_of_several_tasks_and_blocks_make_the_same_trees(spark, monkeypatch):
    x, y = numbers(400, 4)
    df, names = frame(spark, x, y)
    setup = Boosting(rounds=3, depth=3, rate=0.3, row_share=1.1, feature_share=1.0)
    whole = trees.fit_trees(df, names, "target", "w", "held", setup)[0]
    monkeypatch.setattr(trees, "LEAST_ROWS", 90)
    monkeypatch.setattr(trees, "CARRY", 1)
    made = []
    monkeypatch.setattr(trees, "drop_path", lambda spark, path: made.append(spark.read.parquet(path).count()))
    parts, _, _ = trees.fit_trees(df, names, "target", "w", "held", setup)
    assert len(made) == 4 and min(made) >= 4  # blocks of four tasks or more
    assert parts.margin(x) == pytest.approx(whole.margin(x))
    assert (parts.feature == whole.feature).all()


def test_few_rows_are_trained_on_in_one_task_with_the_same_trees(spark, monkeypatch):
    x, y = numbers(600, 8)
    df, names = frame(spark, x, y, np.arange(600) % 4 == 0)
    df = df.coalesce(1)  # row ids, which choose the rows of a round, are the same both times
    setup = Boosting(rounds=6, depth=3, rate=0.3, patience=3)
    jobs = []
    level = trees._Training.level
    monkeypatch.setattr(trees._Training, "level", lambda self, *a: jobs.append(a[0]) or level(self, *a))
    alone, base, losses = trees.fit_trees(df, names, "target", "w", "held", setup)
    assert jobs == []
    monkeypatch.setattr(trees, "LEAST_ROWS", 100)
    monkeypatch.setattr(trees, "CARRY", 4)
    many, same, parts = trees.fit_trees(df, names, "target", "w", "held", setup)
    assert len(jobs) > len(many) and len(alone) == len(many) > 0 and base == same
    assert losses == pytest.approx(parts) and many.margin(x) == pytest.approx(alone.margin(x))


def test_boosting_ends_when_watched_rows_gain_nothing(spark):
    x, y = numbers(600, 2)
    watched = np.arange(600) % 4 == 0
    y[watched] = np.random.default_rng(0).integers(0, 2, watched.sum())  # nothing to learn for them
    df, names = frame(spark, x, y, watched)
    fitted, base, losses = trees.fit_trees(df, names, "target", "w", "held", Boosting(rounds=40, depth=3, rate=0.5, patience=4))
    best = int(np.argmin(losses)) + 1
    assert len(losses) < 40 and len(losses) - best == 4 and len(fitted) == best
    w = (1.0 + np.arange(600) % 2)[watched]
    for k in (1, best):
        m, t = base + fitted.first(k).margin(x)[watched], y[watched]
        assert losses[k - 1] == pytest.approx((w * (np.logaddexp(0, m) - t * m)).sum() / w.sum())


def test_degenerate_tables(spark):
    x, y = numbers(50)
    df, names = frame(spark, x, y)
    setup = Boosting(rounds=2, depth=2, rate=0.3)
    assert len(trees.fit_trees(df.where("false"), names, "target", "w", "held", setup)[0]) == 0
    one_class, _, _ = trees.fit_trees(df.withColumn("target", F.lit(1.0)), names, "target", "w", "held", setup)
    assert np.isfinite(one_class.margin(x)).all()
    constant, _, _ = trees.fit_trees(df.select(F.lit(1.0).alias("f0"), "target", "w", "held"), ["f0"], "target", "w", "held", setup)
    assert (constant.feature == -1).all()
    assert all(len(c) < BINS for c in trees.cuts_of(df.select(*trees.doubles(names)), names))


@pytest.fixture(scope="module")
def model(spark):
    x, y = numbers(800, 3)
    df, names = frame(spark, x, y)
    fitted, base, _ = trees.fit_trees(df, names, "target", "w", "held", Boosting(rounds=6, depth=4, rate=0.3))
    return TreeModel(names, [], fitted, base, 0.0)


def expected_value(model, row, known):
    """The margin of a row of which only the features in ``known`` are known: unknown ones split by cover."""
    t = model.trees

    def walk(tree, at):
        f = t.feature[tree, at]
        if f < 0:
            return t.value[tree, at]
        if f in known:
            return walk(tree, 2 * at + 1 + int(row[f] > t.cut[tree, at]))
        left, right = t.cover[tree, 2 * at + 1], t.cover[tree, 2 * at + 2]
        return (left * walk(tree, 2 * at + 1) + right * walk(tree, 2 * at + 2)) / t.cover[tree, at]

    return sum(walk(tree, 0) for tree in range(len(t)))


def test_attributions_equal_brute_force_over_subsets(spark, model):
    x, y = numbers(40, 5)
    df, names = frame(spark, x, y)
    got = {r["docno"]: (np.array(r["values"]), r["expected"]) for r in trees.attributions(model, df, "docno").collect()}
    d = len(names)
    for i, row in enumerate(x):
        assert got[i][0].sum() + got[i][1] == pytest.approx(model.margin(x[i : i + 1])[0])
    for i in range(8):
        for f in range(d):
            others = [j for j in range(d) if j != f]
            want = 0.0
            for k in range(d):
                for s in combinations(others, k):
                    want += factorial(k) * factorial(d - k - 1) / factorial(d) * (expected_value(model, x[i], {*s, f}) - expected_value(model, x[i], set(s)))
            assert got[i][0][f] == pytest.approx(want, abs=1e-9)
    means = {r["feature"]: r["mean_abs"] for r in trees.mean_attributions(model, df, "docno").collect()}
    assert [means[n] for n in names] == pytest.approx(np.abs([got[i][0] for i in range(40)]).mean(axis=0))
    assert trees.attributions(model, df.where("false"), "docno").count() == 0


def test_saved_models_score_the_same(spark, model, tmp_path):
    x, y = numbers(30, 6)
    df, names = frame(spark, x, y)
    model.save(spark, str(tmp_path / "m"))
    again = TreeModel.load(spark, str(tmp_path / "m"))
    assert again.numeric == names and (again.margin(x) == model.margin(x)).all()


def test_a_failing_batch_leaves_other_models_whole(spark, model):
    x, y = numbers(100, 7)
    x[40:60, 0] = 1_000.0  # the third batch
    df, names = frame(spark, x, y)
    df = df.coalesce(1).orderBy("docno").coalesce(1)
    # A damaged model: rows beyond 100 come to a node that asks a feature which does not exist.
    feature, cut = np.array([[0, -1, 99, -1, -1, -1, -1]], np.int32), np.array([[100.0, *[0.0] * 6]])
    damaged = trees.Trees(feature, cut, np.zeros((1, 7), np.int32), np.ones((1, 7)), np.ones((1, 7)), np.ones((1, 7)))
    bad = replace(model, trees=damaged)
    ready = [scoring.ModelVariant("good", "decision", model, names), scoring.ModelVariant("bad", "shadow", bad, names)]
    lacking = scoring.ModelVariant("lacking", "shadow", replace(model, numeric=[*names[:-1], "absent"]), names)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        rows = scoring.score_batch(df, [*ready, lacking]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sum(r["score"] is not None for r in rows if r["model"] == "good") == 100
    failed = [r for r in rows if r["model"] == "bad" and r["error"] is not None]
    assert {r["docno"] for r in failed} == set(range(40, 60)) and all("index 99" in r["error"] and r["score"] is None for r in failed)
    assert {r["error"] for r in rows if r["model"] == "lacking"} == {"missing columns: absent"}


def test_ordered_means_see_earlier_rows_only(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i) if i % 50 else None, ["a", "a", "a", "b", None, f"c{i}"][i % 6], "hot", int(rng.integers(0, 2)) if i % 7 else None) for i in range(600)]
    rows += rows[3:9]  # rows that share a key
    df = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "docno long, kind string, one string, target int, row int").repartition(4)
    got = {r["row"]: r for r in ordered_target_means(df, ["kind", "one"], "target", "docno", 0.3, block_rows=40).collect()}
    ranks = dict(df.select("row", F.coalesce(hash_rank(F.col("docno"), 42), F.lit(-1))).collect())
    for n, (_, kind, one, _) in enumerate(rows):
        for name, value, place in (("kind", kind, 1), ("one", one, 2)):
            before = [r[3] or 0 for m, r in enumerate(rows) if r[place] == value and ranks[m] < ranks[n]]
            assert got[n][mean_column(name)] == pytest.approx((sum(before) + 3.0) / (len(before) + 10))
    means = fit_target_means(df, ["kind"], "target")
    seen = apply_target_means(spark.createDataFrame([("b",), (None,), ("new",)], "kind string"), means, ["kind"], 0.3).collect()
    want = [[r[3] or 0 for r in rows if r[1] == k] for k in ("b", None, "new")]
    assert [r["kind__mean"] for r in seen] == pytest.approx([(sum(v) + 3.0) / (len(v) + 10) for v in want])


def test_a_noise_category_teaches_nothing(spark):
    """Every value occurs about twice: a plain mean would give its own label away."""
    df = spark.range(3_000).selectExpr("id AS docno", "CAST(xxhash64(id, 1) % 1500 AS STRING) AS noise", "1.0D AS flat", "CAST(pmod(xxhash64(id, 2), 2) AS DOUBLE) AS target")
    fitted = training.train_balanced(df.where("docno % 3 <> 0"), ["flat"], ["noise"], rounds=8, depth=3, patience=8)
    scored = training.positive_probability(fitted, df.where("docno % 3 = 0"))
    rows = scored.select(F.lit("m").alias("model"), F.col("target").cast("int").alias("y_true"), "y_proba")
    assert abs(metrics.roc_auc(rows, ["model"]).first()["roc_auc"] - 0.5) < 0.05
