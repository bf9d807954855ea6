import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from riskspark.operators.quantiles import long_metric, order_statistics

PS = [0.0, 0.2, 0.75, 0.9, 0.99, 1.0]


def disc(values, p):
    return sorted(values)[max(math.ceil(p * len(values)), 1) - 1]


def fit(spark, values, **options):
    df = spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "v double")
    request = [(m, p) for m in ("disc", "linear") for p in PS]
    return order_statistics(long_metric(df, "m", F.col("v")), {"m": request}, **options)["m"]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 100])
def test_small(spark, n):
    values = np.random.default_rng(n).normal(size=n).tolist()
    found = fit(spark, values + [None])
    for p in PS:
        assert found.discrete(p) == disc(values, p)
        assert found.linear(p) == pytest.approx(float(np.quantile(values, p)), rel=1e-12)


def test_refinement_rounds(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([np.full(900, 5.0), rng.pareto(1.0, 1500), rng.normal(size=600) * 1e6, [1e300, -1e300]]).tolist()
    found = fit(spark, values, finish_rows=10, buckets=16)
    for p in PS:
        assert found.discrete(p) == disc(values, p)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e9, 1e9), min_size=1, max_size=40))
def test_any_values(spark, values):
    found = fit(spark, values, finish_rows=2, buckets=4)
    assert [found.discrete(p) for p in PS] == [disc(values, p) for p in PS]


def test_weights_and_absent_metric(spark):
    df = spark.createDataFrame([("a", 1.0, 10**12), ("a", 2.0, 10**12 - 1), ("a", 3.0, 1)], "metric string, value double, weight long")
    found = order_statistics(df, {"a": [("disc", 0.5), ("disc", 0.75), ("disc", 1.0)], "none": [("disc", 0.5)]}, finish_rows=5)
    assert [found["a"].discrete(p) for p in (0.5, 0.75, 1.0)] == [1.0, 2.0, 3.0]
    assert found["none"].n == 0 and found["none"].discrete(0.5) is None


def test_clipped_quantile(spark):
    found = fit(spark, [1, 2, 3, 4, 100])
    assert found.linear(1.0, (0.0, 4.0)) == 4.0


def test_extreme_values_end(spark):
    tiny = 5e-324
    found = fit(spark, [0.0, tiny] * 20 + [float("nan")], finish_rows=3, buckets=4)
    assert found.n == 40 and found.discrete(0.2) == 0.0 and found.discrete(0.75) == tiny
    found = fit(spark, [float("-inf"), 1.0, 2.0, 3.0, float("inf")], finish_rows=1, buckets=4)
    assert found.discrete(0.2) < -1e308 and found.discrete(0.75) == 3.0 and found.discrete(1.0) > 1e308
