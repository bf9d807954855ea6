import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import decision, oversample, sampling


def labelled(spark, n, positives):
    return spark.range(n).select(F.col("id").alias("docno"), (F.col("id") < positives).cast("int").alias("target"))


@pytest.mark.parametrize("n,positives,expected", [(13106, 165, (2622, 33)), (10, 3, (2, 1)), (7, 0, (2, 0))])
def test_split_sizes(spark, n, positives, expected):
    df = labelled(spark, n, positives)
    train, test = sampling.stratified_split(df, "target", "docno")
    row = test.agg(F.count("*"), F.coalesce(F.sum("target"), F.lit(0))).first()
    assert tuple(row) == expected
    assert train.count() == n - expected[0]
    assert train.join(test, "docno").count() == 0


def test_split_with_tied_keys(spark):
    """Rows of one key are cut by content; exact copies stay together."""
    df = spark.range(300).select(F.lit(1).alias("docno"), (F.col("id") % 100).alias("x"), F.lit(0).alias("target"))
    marked = sampling.mark_test_rows(df, "target", "docno")
    sides = marked.groupBy("x").agg(F.count_distinct("is_test").alias("n")).agg(F.max("n")).first()[0]
    assert sides == 1 and abs(marked.where("is_test").count() - 60) < 3


def test_weights_take_five_values(spark):
    schema = "docno long, target int, amount_clipped double, cust_txn_count double, logins_last_30_days double, is_night int, is_high_burst int"
    rows = [(n, 0, 1.0, 1.0, 5.0, 0, 0) for n in range(30)]  # ordinary: 1
    rows += [(100, 1, 1.0, 1.0, 5.0, 0, 0)]  # fraud: 3
    rows += [(101, 1, 90.0, 1.0, 5.0, 1, 0)]  # high at night, light customer: 6
    rows += [(102, 1, 90.0, 9.0, 5.0, 1, 0)]  # both boosts: 12
    rows += [(103, 0, 1.0, 9.0, 25.0, 0, 0)]  # easy legitimate: 0.5
    rows += [(104, 0, 90.0, 1.0, 5.0, 0, 0)]
    light = [(200 + n, 0, 1.0, 1.0, 5.0, 0, 0) for n in range(5)]
    df = spark.createDataFrame(rows + light, schema)
    heavy = [(300 + n, 0, 90.0, 2.0, 5.0, 0, 0) for n in range(6)]
    df = df.unionByName(spark.createDataFrame(heavy, schema))
    pdf = df.toPandas()
    a, c = np.quantile(pdf.amount_clipped, 0.9), np.quantile(pdf.cust_txn_count, 0.75)
    got = {r["docno"]: r["weight"] for r in sampling.scenario_weights(df).collect()}
    for r in pdf.itertuples():
        w = 3.0 if r.target else 1.0
        high = r.amount_clipped >= a
        if r.target and high and r.cust_txn_count >= c:
            w *= 2
        if r.target and high and (r.logins_last_30_days <= 2 or r.is_high_burst or r.is_night):
            w *= 2
        if not r.target and not high and r.cust_txn_count > c and r.logins_last_30_days > 20:
            w *= 0.5
        assert got[r.docno] == w
    assert {0.5, 1.0, 3.0, 12.0} <= set(got.values())


def test_class_weights(spark):
    df = labelled(spark, 100, 20)
    assert {r["target"]: r["class_weight"] for r in sampling.class_weights(df).collect()} == {1: 4.0, 0: 1.0}
    assert {r["target"]: r["class_weight"] for r in sampling.class_weights(df, mode="balanced").collect()} == {1: 2.5, 0: 0.625}


@pytest.mark.parametrize("options", [{}, {"broadcast_values": 0, "pivots": 4, "block_rows": 8}])
def test_smotenc_invariants(spark, options):
    rng = np.random.default_rng(2)
    rows = [(n, int(n < 20), *rng.normal(size=2).tolist(), "abc"[n % 3], "kept") for n in range(120)]
    rows += [(500 + n, 1, 3.0, 3.0, "a", "kept") for n in range(10)]  # copies of one minority vector
    df = spark.createDataFrame(rows, "docno long, target int, x double, y double, kind string, other string")
    out = oversample.smotenc(df, "docno", "target", ["x", "y"], ["kind"], **options).toPandas()
    assert (out.target == 1).sum() == (out.target == 0).sum() == 100
    kept = out[out.is_synthetic == 0].sort_values("docno")
    assert len(kept) == 130 and np.allclose(kept.x, df.toPandas().sort_values("docno").x)
    made, real = out[out.is_synthetic == 1], kept[kept.target == 1]
    assert len(made) == 70 and made.docno.isna().all() and set(made.kind) <= set("abc")
    for c in ("x", "y"):
        assert made[c].between(real[c].min(), real[c].max()).all()
    # Each synthetic point lies on a segment between two minority points.
    points = real[["x", "y"]].to_numpy()
    for p in made[["x", "y"]].to_numpy():
        a = points[:, None, :] - p
        b = points[None, :, :] - p
        cross = a[..., 0] * b[..., 1] - a[..., 1] * b[..., 0]
        between = (a * b).sum(axis=2) <= 1e-9
        assert (np.abs(cross) < 1e-9)[between].any()


def test_smotenc_without_need(spark):
    df = labelled(spark, 10, 5).withColumn("x", F.lit(1.0))
    assert oversample.smotenc(df, "docno", "target", ["x"], []).count() == 10


def test_equal_rows_and_missing_keys_are_split_exactly(spark):
    equal = spark.createDataFrame([(7, 0)] * 1_000, "docno long, target int").repartition(5)
    assert sampling.mark_test_rows(equal, "target", "docno").where("is_test").count() == 200
    rows = [(None if i % 5 < 3 else i, None if i % 10 == 0 else i % 2) for i in range(400)]
    marked = sampling.mark_test_rows(spark.createDataFrame(rows, "docno long, target int"), "target", "docno", test_size=0.5)
    counts = {r["target"]: (r["n"], r["t"]) for r in marked.groupBy("target").agg(F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect()}
    assert counts == {None: (40, 20), 0: (160, 80), 1: (200, 100)}
    assert 0 < marked.where("docno is null and is_test").count() < 240


def test_a_key_with_several_scores_is_an_error_of_the_ensemble(spark):
    rows = [(1, "a", 1, 0.1), (1, "a", 0, 0.9), (1, "b", 1, 0.2)]
    scores = spark.createDataFrame(rows, "docno long, model string, y_true int, y_proba double")
    with pytest.raises(Exception, match="several scores"):
        decision.ensemble_scores(scores, "a", "b", "docno").collect()
