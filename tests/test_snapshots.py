"""Statistics merged from parts equal those of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from riskspark.operators import stats
from riskspark.operators.snapshots import StatsSnapshot
from riskspark.operators.stats import RARE_SOURCES


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(0)
    amounts = [None, 0.0, 5.0, *[rng.uniform(1, 1e6) for _ in range(40)]]
    tx = [(rng.choice([None, 1, 1, 1, 2, 3, 4]), rng.choice(amounts), d) for d in range(600)] + [(9, None, 1), (9, None, 2)]
    beh = [(c, rng.choice([None, float("nan"), rng.uniform(-1, 1)]), rng.choice([None, "a", "b", f"r{c}"]), rng.choice(["x", "y"])) for c in range(200)]
    columns = ", ".join(f"{c} string" for c in RARE_SOURCES)
    return spark.createDataFrame(tx, "cst_dim_id long, amount double, docno long"), spark.createDataFrame(beh, f"cst_dim_id long, burstiness_login_interval double, {columns}")


@pytest.mark.parametrize("days", [1, 2, 5])
def test_merged_parts_equal_the_whole(spark, tables, tmp_path, days):
    tx, beh = tables
    merged = None
    for d in range(days):
        part = StatsSnapshot.of(tx.where(F.col("docno") % days == d), beh.where(F.col("cst_dim_id") % days == d))
        merged = part if merged is None else merged.merge(part)
        merged.save(str(tmp_path / str(d)))
        merged = StatsSnapshot.load(spark, str(tmp_path / str(d)))
    whole = stats.fit_online(tx, beh)
    got = merged.fit()
    assert got.scalars == pytest.approx(whole.scalars)
    rows = lambda s: {r["cst_dim_id"]: tuple(r)[1:] for r in s.customers.collect()}
    mine, want = rows(got), rows(whole)
    assert mine.keys() == want.keys() and None not in mine
    for c, row in want.items():
        assert mine[c] == pytest.approx(row, rel=1e-9) if None not in row else mine[c] == row
    for c in RARE_SOURCES:
        assert sorted(map(tuple, merged.rare(40)[c].collect())) == sorted(map(tuple, stats.rare_values(beh, c, 40).collect()))


def test_empty_snapshots(tables):
    tx, beh = tables
    nothing, all_rows = StatsSnapshot.of(tx.where("false"), beh.where("false")), StatsSnapshot.of(tx, beh)
    assert nothing.merge(all_rows).fit().scalars == pytest.approx(stats.fit_online(tx, beh).scalars)
    assert nothing.fit().scalars == stats.fit_online(tx.where("false"), beh.where("false")).scalars
