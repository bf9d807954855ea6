"""Running sums over huge ordered groups, and small top-k reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from riskspark.functions.hashing import hash_rank
from riskspark.functions.search import cuts_below, double_array

RANGES = 256


def running_sums(df: DataFrame, group: list[str], order: str, sums: list[str], ranges: int = RANGES, splits: list[float] | None = None) -> DataFrame:
    """``cum_<name>``: sums over rows with ``order`` at or above the row's, per group; ``total_<name>``: group sums.

    ``df`` holds one row per (group, order value). The value axis is cut at
    about even row counts; each range is summed in its own task and the totals
    of the higher ranges, one row per (group, range), are added.
    """
    if splits is None:
        points = [i / ranges for i in range(1, ranges)]
        found = df.agg(F.percentile_approx(order, double_array(points), F.lit(10_000)).alias("s")).first()["s"]
        splits = sorted(set(found or []))
    ranged = df.withColumn("_range", cuts_below(double_array(splits), F.col(order), len(splits), inclusive=True))
    totals = ranged.groupBy(*group, "_range").agg(*[F.sum(n).alias(f"_t_{n}") for n in sums])
    higher = Window.partitionBy(*group).orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = totals.select(
        *group,
        "_range",
        *[F.coalesce(F.sum(f"_t_{n}").over(higher), F.lit(0)).alias(f"_o_{n}") for n in sums],
        *[F.sum(f"_t_{n}").over(whole).alias(f"total_{n}") for n in sums],
    )
    inside = Window.partitionBy(*group, "_range").orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumns({f"_l_{n}": F.sum(n).over(inside) for n in sums})
    return (
        local.join(F.broadcast(offsets), [*group, "_range"])
        .withColumns({f"cum_{n}": F.col(f"_l_{n}") + F.col(f"_o_{n}") for n in sums})
        .drop("_range", *[f"_l_{n}" for n in sums], *[f"_o_{n}" for n in sums])
    )


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` of each key, by partial aggregation."""
    rest = [n for n in df.columns if n != key]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(key, "_r.*")


def rank_models(metrics: DataFrame, by: str = "F2", name: str = "model") -> DataFrame:
    """Models by metric, best first; equal metrics in name order."""
    return metrics.orderBy(F.col(by).desc_nulls_last(), F.col(name))


def champion(metrics: DataFrame, by: str = "F2", name: str = "model") -> DataFrame:
    return rank_models(metrics, by, name).limit(1)


def top_attributions(attributions: DataFrame, k: int = 25) -> DataFrame:
    """The ``k`` features with the greatest mean absolute attribution of a (feature, value) frame."""
    return (
        attributions.groupBy("feature")
        .agg(F.avg(F.abs("value")).alias("mean_abs"))
        .orderBy(F.col("mean_abs").desc(), F.col("feature"))
        .limit(k)
    )


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement, chosen by a hash of the key (a distributed top-n)."""
    return df.withColumn("_h", hash_rank(F.col(key), seed)).orderBy("_h", key).limit(n).drop("_h")


def usable_version(versions: DataFrame) -> DataFrame:
    """Per configuration key the version to use: the newest when valid, else the newest stable one if valid.

    ``versions``: key, version_id, last_modified, stable, valid, body. A key
    without a usable version has status ``error``.
    """
    packed = F.struct("version_id", "valid", "stable", "body")
    recency = F.struct("last_modified", "version_id")
    per_key = versions.groupBy("key").agg(
        F.max_by(packed, recency).alias("newest"),
        F.max_by(F.when(F.col("stable"), packed), F.when(F.col("stable"), recency)).alias("fallback"),
    )
    chosen = F.when(F.col("newest.valid"), F.col("newest")).when(F.col("fallback.valid"), F.col("fallback"))
    status = (
        F.when(F.col("newest.valid"), F.lit("latest")).when(F.col("fallback.valid"), F.lit("stable")).otherwise(F.lit("error"))
    )
    return per_key.select("key", status.alias("status"), chosen.alias("v")).select(
        "key", "status", F.col("v.version_id").alias("version_id"), F.col("v.body").alias("body")
    )
