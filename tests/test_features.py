from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskspark import schemas
from riskspark.operators.stats import FeatureStats, amount_bin_edges, fit_offline, fit_online, rare_values
from riskspark.plans.catalogue import bin_labels
from riskspark.plans.features import attach_globals, features_offline, features_online, fit_and_build_offline

BEHAVIOUR_SCHEMA = schemas.BEHAVIOUR


def txns(spark, rows):
    """rows: (customer, 'YYYY-mm-dd HH:MM', amount)"""
    from decimal import Decimal

    data = []
    for n, (who, when, amount) in enumerate(rows):
        ts = datetime.strptime(when, "%Y-%m-%d %H:%M") if when else None
        data.append((who, ts.date() if ts else None, ts, None if amount is None else Decimal(str(amount)), n, "d", n % 2))
    return spark.createDataFrame(data, schemas.TRANSACTIONS)


def snapshots(spark, rows):
    names = [f.name for f in BEHAVIOUR_SCHEMA.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], BEHAVIOUR_SCHEMA)


def by_doc(df):
    return {r["docno"]: r for r in df.collect()}


WEEK = [(1, f"2024-01-{day:02d} {hour:02d}:30", 10) for day, hour in zip(range(1, 9), (0, 6, 7, 11, 12, 17, 18, 23))]


def test_calendar_in_both_profiles(spark):
    tx = txns(spark, WEEK)
    online = by_doc(features_online(tx, snapshots(spark, [])))
    _, (built,) = fit_and_build_offline(tx.select(*tx.columns, *[F.lit(None).cast("double").alias(n) for n in schemas.BEHAVIOUR_NUMERIC]))
    offline = by_doc(built)
    for n, (_, when, _) in enumerate(WEEK):
        day = pd.Timestamp(when)
        assert online[n]["weekday"] == (day.weekday() + 1) % 7 and offline[n]["weekday"] == day.weekday()
        assert online[n]["is_weekend"] == int(day.day_name() in ("Friday", "Saturday"))
        assert offline[n]["is_weekend"] == int(day.day_name() in ("Saturday", "Sunday"))
        for got in (online[n], offline[n]):
            assert got["hour"] == day.hour
            assert (got["is_night"], got["is_morning"], got["is_evening"]) == (day.hour <= 6, 6 <= day.hour <= 11, day.hour >= 18)


def test_unparseable_time_and_bad_amounts_offline(spark):
    df = spark.createDataFrame(
        [(0, 1, "not a time", "abc"), (1, 1, "2024-01-06 03:00:00", "-5"), (2, 1, "2024-01-06 03:00:00", "1d"), (3, 1, None, " 7.5 ")],
        "docno long, cst_dim_id long, transdatetime string, amount string",
    )
    rows = by_doc(features_offline(df, fit_offline(df)))
    assert (rows[0]["hour"], rows[0]["weekday"], rows[0]["is_night"]) == (-1, -1, 0)
    assert (rows[1]["hour"], rows[1]["weekday"], rows[1]["is_weekend"]) == (3, 5, 1)
    assert [rows[n]["amount"] for n in range(4)] == [0.0, -5.0, 0.0, 7.5]
    assert rows[1]["amount_clipped"] == 0.0


def test_empty_behaviour_and_single_transaction(spark):
    rows = by_doc(features_online(txns(spark, [(1, "2024-01-01 10:00", 5), (2, "2024-01-01 10:00", None)]), snapshots(spark, [])))
    assert rows[0]["is_high_burst"] == 0 and rows[0]["night_and_high_burst"] == 0  # no burst level
    assert rows[0]["cust_amount_std"] == 0.0
    assert rows[0]["login_freq_ratio_7_30"] is None and rows[0]["interval_cv_30d"] is None
    assert rows[1]["amount"] is None and rows[1]["amount_clipped"] == 0.0 and rows[1]["cust_txn_count"] == 1.0


def test_equal_amounts(spark):
    tx = txns(spark, [(1, "2024-01-01 10:00", 5)] * 3)
    online = by_doc(features_online(tx, snapshots(spark, [])))
    assert online[0]["amount_z_overall"] is None  # deviation 0
    stats = fit_offline(tx)
    assert stats.scalars["amount_std"] == 1.0
    assert by_doc(features_offline(tx, stats))[0]["amount_z_overall"] == 0.0
    assert by_doc(features_offline(tx, stats))[0]["amount_bin"] == "ALL"  # one edge is no bin


def test_unseen_customer(spark):
    train = txns(spark, [(1, "2024-01-01 10:00", 5), (1, "2024-01-02 10:00", 15)])
    other = txns(spark, [(9, "2024-01-03 10:00", 5)])
    row = features_offline(other, fit_offline(train)).first()
    assert row["cust_txn_count"] == 0.0
    assert row["amount_vs_cust_mean"] == pytest.approx(5 / 1e-6) and row["atypical_amount_vs_mean"] == 1
    online = features_online(other, snapshots(spark, []), fit_online(train, snapshots(spark, []))).first()
    assert online["amount_vs_cust_mean"] is None and online["atypical_amount_vs_mean"] == 0


def test_std_and_percentile_kinds(spark):
    tx = txns(spark, [(1, "2024-01-01 10:00", a) for a in (1, 2, 3, 4)])
    on, off = fit_online(tx, snapshots(spark, [])), fit_offline(tx)
    assert on.scalars["amount_q99"] == 4.0 and off.scalars["amount_q99"] == pytest.approx(np.quantile([1, 2, 3, 4], 0.99))
    assert on.customers.first()["cust_amount_std"] == pytest.approx(np.std([1, 2, 3, 4]))
    assert off.customers.first()["cust_amount_std"] == pytest.approx(np.std([1, 2, 3, 4], ddof=1))
    assert on.scalars["amount_std"] == pytest.approx(np.std([1, 2, 3, 4]))


def test_zero_divisors(spark):
    zero = {n: 0.0 for n in schemas.BEHAVIOUR_MEASURES} | {n: 0 for n in schemas.BEHAVIOUR_COUNTS}
    who = zero | {"transdate": datetime(2024, 1, 1), "cst_dim_id": 1, "std_login_interval_30d": 2.0, "login_frequency_7d": 3.0, "logins_last_7_days": 4}
    tx = txns(spark, [(1, "2024-01-02 10:00", 5)])
    ratios = ["login_freq_ratio_7_30", "logins_ratio_7_30", "interval_cv_30d", "interval_fano_30d", "ewm_vs_avg_interval"]
    row = features_online(tx, snapshots(spark, [who])).first()
    assert all(row[n] is None for n in ratios)
    merged = tx.withColumns({n: F.lit(who[n]) for n in schemas.BEHAVIOUR_NUMERIC})
    row = features_offline(merged, fit_offline(merged)).first()
    assert [row[n] for n in ratios] == pytest.approx([3.0 / 1e-6, 4.0, 2.0 / 1e-6, 0.0, 0.0])


@pytest.mark.parametrize("values", [[1, 2, 3, 4, 5, 6], [0, 0, 0, 10.55555, 20.123456, 1000], [-3, 0.0001234, 0.0001239, 5, 7], [1.5, 2, 2, 3, 100000.4567]])
def test_bin_labels_match_pandas(spark, values):
    edges = sorted(set(np.quantile(values, [0, 0.2, 0.4, 0.6, 0.8, 1.0]).tolist()))
    expected = pd.cut(pd.Series(values, dtype=float), bins=edges, include_lowest=True).astype(str).tolist()
    df = spark.createDataFrame([(n, float(v)) for n, v in enumerate(values)], "n int, v double")
    from riskspark.plans.catalogue import OFFLINE

    got = [r["b"] for r in df.select("n", OFFLINE.amount_bin(F.col("v"), edges).alias("b")).orderBy("n").collect()]
    assert got == expected
    assert len(bin_labels(edges)) == len(edges) - 1


def test_few_edges_fall_back_to_equal_width():
    assert amount_bin_edges([0.0, 0.0, 0.0, 0.0, 0.0, 10.0], 0.0, 10.0) == [0.0, 2.0, 4.0, 6.0, 8.0, 10.0]


def test_rare_grouping(spark):
    rows = [(n, "common") for n in range(30)] + [(30 + n, "seldom") for n in range(29)] + [(60 + n, None) for n in range(30)]
    df = spark.createDataFrame(rows, "docno long, last_os_categorical string")
    assert {r["value"] for r in rare_values(df, "last_os_categorical").collect()} == {"seldom"}
    unseen = df.unionByName(spark.createDataFrame([(99, "new")], df.schema))
    got = {r["docno"]: r["last_os_categorical"] for r in features_offline(unseen, fit_offline(df)).collect()}
    assert (got[0], got[30], got[60], got[99]) == ("common", "OTHER", "nan", "new")


def test_offline_rows_are_kept_and_finite(spark, sf_dir):
    from riskspark.sources.fixtures import training_set

    merged = training_set(spark, sf_dir)
    stats, (built,) = fit_and_build_offline(merged)
    frame = built.select(*schemas.FEATURE_COLUMNS).toPandas()
    assert len(frame) == 202 and frame.notna().all().all()
    assert np.isfinite(frame.select_dtypes("number")).all().all()


def test_offline_matches_pandas_rebuild(spark, sf_dir):
    """Independent check of a cross-section against pandas arithmetic."""
    from riskspark.sources.fixtures import training_set

    merged = training_set(spark, sf_dir)
    raw = merged.toPandas().sort_values("docno").reset_index(drop=True)
    _, (built,) = fit_and_build_offline(merged)
    got = built.toPandas().sort_values("docno").reset_index(drop=True)
    amount = raw["amount"].astype(float)
    clip = amount.clip(0, amount.quantile(0.99))
    customer = amount.groupby(raw["cst_dim_id"])
    assert np.allclose(got["amount_clipped"], clip)
    assert np.allclose(got["cust_amount_std"], customer.transform("std").fillna(0))
    heavy = customer.transform("count") >= customer.count().quantile(0.75)
    assert (got["cust_is_heavy_q75"] == heavy.astype(int)).all()
    burst = raw["burstiness_login_interval"].fillna(0).abs()
    assert (got["is_high_burst"] == (burst >= burst.quantile(0.9)).astype(int)).all()
    assert np.allclose(got["amount_z_overall"], (clip - clip.mean()) / (clip.std(ddof=0) + 1e-6))
    edges = np.unique(np.quantile(clip, [0, 0.2, 0.4, 0.6, 0.8, 1.0]))
    assert (got["amount_bin"] == pd.cut(clip, bins=edges, include_lowest=True).astype(str)).all()


def test_contract(spark, sf_dir):
    from riskspark.sources import fixtures

    view = features_online(fixtures.transactions(spark, sf_dir), fixtures.behaviour(spark, sf_dir))
    assert view.columns == ["cst_dim_id", "transdate", *schemas.FEATURE_COLUMNS] and len(view.columns) == 79


def test_stats_round_trip(spark, sf_dir, tmp_path):
    from riskspark.sources.fixtures import training_set

    stats = fit_offline(training_set(spark, sf_dir))
    stats.save(spark, str(tmp_path / "stats"))
    back = FeatureStats.load(spark, str(tmp_path / "stats"))
    assert back.scalars == stats.scalars and back.amount_bins == stats.amount_bins
    assert back.customers.count() == stats.customers.count() and set(back.rare) == set(stats.rare)


def test_globals_are_one_subquery(spark):
    stats = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert [tuple(r) for r in attach_globals(spark.range(2), stats, ["a", "b"]).collect()] == [(0, 1.0, 2.0), (1, 1.0, 2.0)]


def test_customer_join_can_be_split_at_a_hot_customer(spark):
    """Both join inputs are plain shuffles, so AQE splits the hot customer's partition."""
    from riskspark.operators.stats import customer_agg_online, stored_customers
    from riskspark.plans.features import attach_customers

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        tx = spark.range(60_000).repartition(8).select(
            F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("cst_dim_id"), F.rand(1).alias("amount"), F.sha2(F.col("id").cast("string"), 256).alias("docno")
        )
        joined = attach_customers(tx, stored_customers(customer_agg_online(tx)))
        rows = joined.agg(F.count("docno"), F.sum((F.col("cst_dim_id") == 1).cast("int")), F.max("docno"), F.max("cust_amount_mean"))
        assert tuple(rows.collect()[0])[:2] == (60_000, 20_001)
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
