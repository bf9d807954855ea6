import pytest
from pyspark.sql import functions as F

from riskspark import schemas
from riskspark.operators import metrics, scenarios
from riskspark.plans import contract, scoring, training
from riskspark.registry import queries_models as registered
from riskspark.registry.core import Inputs
from riskspark.session import cut_lineage
from riskspark.streaming import score_stream as streaming

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs.of(spark, SF)


def test_models_beat_chance(spark, inputs):
    test, _, _ = contract.prepare_matrices(inputs.model_frames[1])
    for which in ("balanced", "numeric"):
        scored = training.positive_probability(registered.model(inputs, which), test)
        auc = metrics.roc_auc(scored.select(F.lit(which).alias("model"), F.col("target").alias("y_true"), "y_proba"), ["model"]).first()["roc_auc"]
        assert auc > 0.6


def test_registered_models_are_trained_in_full(spark, monkeypatch):
    class Own:
        frame = spark.createDataFrame([(1, 0, 1.0, "a"), (2, 1, 2.0, "b")], "docno long, target int, amount double, direction string")
        model_frames = frame, frame

        def _once(self, name, make):
            return make()

    monkeypatch.setattr(training, "_fit", lambda *a: a[-1])
    stored = {"balanced": training.BALANCED, "numeric": training.NUMERIC, "weighted": training.WEIGHTED}
    assert [s.rounds for s in stored.values()] == [1200, 600, 1800]
    assert {n: registered.model(Own(), n) for n in stored} == stored


def test_validation_rows_come_from_train(inputs):
    assert inputs.train.join(inputs.test, "docno").count() == 0


def test_importances(spark, inputs):
    rows = training.feature_importance(registered.model(inputs, "balanced"), spark).collect()
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)
    assert [r["importance"] for r in rows] == sorted((r["importance"] for r in rows), reverse=True)
    assert {r["feature"] for r in rows} == set(schemas.FEATURE_COLUMNS)


def test_permutation_of_unused_feature_loses_nothing(inputs):
    model = registered.model(inputs, "balanced")
    test, numeric, text = contract.prepare_matrices(inputs.model_frames[1])
    lost = {r["feature"]: r["value"] for r in training.permutation_importance(model, test, [*numeric, *text], rows=200).collect()}
    unused = [f for k, f in enumerate(model.features) if k not in set(model.trees.feature.ravel())]
    assert unused and all(lost[f] == 0.0 for f in unused) and len(lost) == 77


def test_failing_model_is_isolated(inputs):
    good = registered.variants(inputs)[0]
    bad = scoring.ModelVariant("bad", "shadow", "/nonexistent/model", good.feature_cols)
    few = inputs.test_features.limit(5)
    rows = scoring.score_batch(few, [good, bad]).collect()
    assert len(rows) == 10
    assert all(r["score"] is not None and r["error"] is None for r in rows if r["model"] == good.name)
    assert all(r["score"] is None and r["error"] for r in rows if r["model"] == "bad")


def test_scoring_equals_model_output(inputs):
    variant = registered.variants(inputs)[0]
    direct = training.positive_probability(variant.load(), inputs.test_features).select("docno", "y_proba")
    both = scoring.score_batch(inputs.test_features, [variant]).join(direct, "docno")
    assert both.where("score <> y_proba").count() == 0 and both.count() == inputs.test_features.count()


def test_scenarios(spark):
    df = spark.createDataFrame([(1, "2024-01-05 13:45:00", "2", "x"), (2, "bad", None, "-1")], "docno long, transdatetime string, amount string, burstiness_login_interval string")
    assert [r["transdatetime"] for r in scenarios.all_at_night(df).orderBy("docno").collect()] == ["2024-01-05 02:00:00", None]
    assert [r["amount"] for r in scenarios.amount_x3(df).orderBy("docno").collect()] == [6.0, 0.0]
    assert [r["burstiness_login_interval"] for r in scenarios.burst_x3(df).orderBy("docno").collect()] == [0.0, -3.0]
    assert scenarios.burst_x3(df.drop("burstiness_login_interval")).columns == ["docno", "transdatetime", "amount"]


def test_stress_suite_base_equals_plain_evaluation(inputs):
    variant = registered.variants(inputs)[0]
    suite = {r["scenario"]: r for r in scoring.stress_suite(inputs.test, inputs.offline_stats, [variant], add_scores=inputs.with_anomaly_scores).collect()}
    assert set(suite) == set(scenarios.SCENARIOS)
    scored = training.positive_probability(variant.load(), inputs.model_frames[1])
    plain = metrics.evaluate(scored.select(F.lit(variant.name).alias("model"), F.lit("s").alias("scenario"), F.col("target").alias("y_true"), "y_proba")).first()
    base = suite["unchanged"]
    assert [base[n] for n in ("tn", "fp", "fn", "tp", "best_thr")] == [plain[n] for n in ("tn", "fp", "fn", "tp", "best_thr")]
    assert base["roc_auc"] == pytest.approx(plain["roc_auc"])


def test_stream_equals_batch(spark, inputs):
    """Late rows, repeats and second rows of a document number are all answered, by the version in force."""
    out, rejects = registered.run_stream(inputs)
    rows = cut_lineage(registered.arrivals(inputs), "test-arrivals")
    answered = spark.read.parquet(out).where("role = 'decision'")
    assert answered.count() + spark.read.parquet(rejects).count() == rows.count()
    streamed = {r["request"]: (r["score"], r["decision"], r["config_version"]) for r in streaming.final_decisions(spark, out).collect()}
    assert answered.count() > len(streamed) > answered.select("docno").distinct().count()
    seen = set()
    for part, body in (("v1", "0.4;0.7"), ("v2", "0.3;0.6")):
        mine = rows.where(F.col("part") == part).drop("part").distinct()
        batch, _ = streaming.score_transactions(mine, inputs.behaviour, registered._bundle(inputs, part, body))
        for r in batch.where("role = 'decision'").collect():
            score, decision, version = streamed[r["request"]]
            assert score == pytest.approx(r["score"]) and (decision, version) == (r["decision"], part)
            seen.add(r["request"])
    assert seen == streamed.keys()


def test_repeats_within_a_delay_are_answered_once(spark, tmp_path):
    rows = [(1, "2024-01-01", "2024-01-01 10:00:00", 5, "x"), (1, "2024-01-01", "2024-01-01 10:00:00", 6, "x")]
    columns = "docno long, transdate string, transdatetime string, amount int, direction string"
    spark.createDataFrame([*rows, rows[0]], columns).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(columns).parquet(str(tmp_path / "in"))
    query = streaming.deduplicated(stream, "1 day").writeStream.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start(str(tmp_path / "out"), "parquet")
    query.awaitTermination()
    assert sorted(r["amount"] for r in spark.read.schema(columns).parquet(str(tmp_path / "out")).collect()) == [5, 6]
    assert streaming.deduplicated(stream) is stream


def test_hot_swap_keeps_the_previous_bundle(spark):
    versions = [[("k", "v1", 1, True, True, "one")], [("k", "v2", 2, False, True, "boom")], [("k", "v3", 3, False, True, "three")]]
    schema = "key string, version_id string, last_modified int, stable boolean, valid boolean, body string"
    turn = iter(versions)

    def build(version, body):
        if body == "boom":
            raise ValueError("cannot build")
        return streaming.Bundle(version, None, [])

    swap = streaming.HotSwap(lambda: spark.createDataFrame(next(turn), schema), build, "k")
    assert [swap.bundle().version for _ in range(3)] == ["v1", "v1", "v3"]
    assert swap.errors == ["cannot build"]
    empty = streaming.HotSwap(lambda: spark.createDataFrame([], schema), build, "k")
    with pytest.raises(LookupError):
        empty.bundle()


def test_models_learn_from_anomaly_scores(inputs):
    train, test = inputs.model_frames
    for frame in (train, test):
        assert all(frame.agg(F.countDistinct(n)).first()[0] > 50 for n in ("iforest_score", "lof_score"))
    assert {"iforest_score", "lof_score"} <= set(registered.model(inputs, "balanced").features)


def test_trained_models_are_ranked(spark):
    from riskspark.registry import QUERIES

    rows = {r["model"]: r for r in QUERIES["T10_trained_champion"](spark, SF).collect()}
    assert set(rows) == {"balanced", "numeric", "weighted", "ensemble"} and all(r["roc_auc"] > 0.6 for r in rows.values())


def test_top_attributions_come_from_the_model(spark, inputs):
    from riskspark.registry import QUERIES

    per_row = QUERIES["T9_row_attributions"](spark, SF)
    want = {r["feature"]: r["m"] for r in per_row.groupBy("feature").agg(F.avg(F.abs("value")).alias("m")).collect()}
    top = QUERIES["W4_model_attributions"](spark, SF).collect()
    assert len(top) == 25 and all(r["mean_abs"] == pytest.approx(want[r["feature"]], rel=1e-5) for r in top)
    assert min(r["mean_abs"] for r in top) >= max(v for n, v in want.items() if n not in {r["feature"] for r in top}) - 1e-9
