import contextlib
import io
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from riskspark.operators.asof import asof_join

T0 = datetime(2024, 1, 1)
LEFT = "id long, k long, ts timestamp_ntz"
RIGHT = "k long, rts timestamp_ntz, v string, n int"


def at(hours):
    return T0 + timedelta(hours=hours)


def joined(left, right, **options):
    out = asof_join(left, right, "k", "ts", "rts", ["v", "n"], **options)
    return {r["id"]: (r["v"], r["n"]) for r in out.collect()}


def test_edges(spark):
    left = spark.createDataFrame(
        [(1, 1, at(5)), (2, 1, at(4)), (3, 1, at(0)), (4, None, at(5)), (5, 1, None), (6, 2, at(9)), (7, 3, at(1)), (8, 1, at(7))], LEFT
    )
    right = spark.createDataFrame(
        [(1, at(5), "a", 1), (1, at(5), "b", 2), (1, at(2), "c", 3), (None, at(1), "x", 9), (2, None, "y", 9), (3, at(2), "late", 9), (1, at(6), None, None)],
        RIGHT,
    )
    found = joined(left, right)
    assert found[1] == ("b", 2)  # inclusive, the greatest payload wins the tie
    assert found[2] == ("c", 3)
    assert found[3] == (None, None)
    assert found[4] == (None, None) and found[5] == (None, None)
    assert found[6] == (None, None) and found[7] == (None, None)
    assert found[8] == (None, None)  # matched a row of NULLs, not the older one
    assert len(found) == 8


def test_empty_right(spark):
    left = spark.createDataFrame([(1, 1, at(5))], LEFT)
    assert joined(left, spark.createDataFrame([], RIGHT)) == {1: (None, None)}


def _skewed(spark):
    rng = random.Random(7)
    left = [(n, 1 if n % 3 else rng.randrange(2, 30), at(rng.randrange(400))) for n in range(3000)]
    left += [(3000 + n, 1, at(200)) for n in range(800)]  # a burst at one instant
    left += [(4000 + n, None, at(1)) for n in range(5)]
    right = [(1 if n % 2 else rng.randrange(2, 40), at(rng.randrange(400)), f"v{n}", n) for n in range(600)]
    right += [(1, at(200), "tie", n) for n in range(50)]
    return spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), left, right


def test_hot_keys_equal_brute_force(spark):
    left, right, rows, others = _skewed(spark)
    expected = {}
    for n, k, ts in rows:
        best = max(((r[1], r[2], r[3]) for r in others if r[0] == k and r[1] <= ts), default=None) if k is not None else None
        expected[n] = (best[1], best[2]) if best else (None, None)
    assert joined(left, right) == expected
    assert joined(left, right, hot_rows=100) == expected
    assert joined(left, right, hot_rows=None) == expected


def test_hot_key_groups_are_split(spark):
    """No (key, range, salt) group of the hot key keeps more than a fraction of its rows."""
    left, right, _, _ = _skewed(spark)
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        asof_join(left, right, "k", "ts", "rts", ["v", "n"], hot_rows=100).explain("formatted")
    assert "_lane" in text.getvalue() and "_range" in text.getvalue()


def test_plan_has_no_nested_loop(spark):
    left, right, _, _ = _skewed(spark)
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        asof_join(left, right, "k", "ts", "rts", ["v", "n"]).explain("formatted")
    plan = text.getvalue()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.count("Exchange hashpartitioning") <= 2  # the tree and its details list


def test_left_count_is_kept(spark, sf_dir):
    from riskspark.sources import fixtures

    tx = fixtures.transactions(spark, sf_dir)
    assert fixtures.training_set(spark, sf_dir).count() == tx.count() == 202
    assert fixtures.behaviour(spark, sf_dir).agg(F.count("*")).first()[0] == 265


def test_merged_set_reads_the_stored_snapshots(spark, tmp_path, monkeypatch):
    """The snapshots are derived once in a session, not again for the merged set."""
    from riskspark.registry.core import Inputs
    from riskspark.sources import fixtures

    rows = [(n, at(7 * n), n % 2, ("click", "view", "purchase")[n % 3], 10.0 + n, f'{{"k": {n}}}') for n in range(40)]
    rows += [(100, None, 0, "purchase", 1.0, None), (101, at(50), None, "purchase", 2.0, "{}"), (102, at(60), 1, "purchase", 3.0, "{}"), (102, at(60), 1, "purchase", 3.0, "{}")]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    expected = sorted(map(str, fixtures.training_set(spark, str(tmp_path)).collect()))
    calls, derive = [], fixtures.behaviour
    monkeypatch.setattr(fixtures, "behaviour", lambda *a: calls.append(a) or derive(*a))
    inputs = Inputs(spark, str(tmp_path))
    assert inputs.behaviour.count() and sorted(map(str, inputs.merged.collect())) == expected
    assert len(expected) == 17 and len(calls) == 1
