"""Stored feature view and statistics snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_feature_view(features: DataFrame, path: str, view: str | None = None) -> DataFrame:
    """Materialise features partitioned by ``transdate``; optionally register a view on the files.

    Rows are brought together by date before writing, so that a date has few
    files; AQE cuts a date with many rows into several tasks of even size.
    """
    spark = features.sparkSession
    features.hint("rebalance", "transdate").write.partitionBy("transdate").parquet(path)
    stored = spark.read.parquet(path)
    if view:
        stored.createOrReplaceTempView(view)
    return stored


def upsert(snapshot: DataFrame, new: DataFrame, key: str = "model_name") -> DataFrame:
    """Rows of ``new`` replace rows of ``snapshot`` with the same key; other rows stay."""
    columns = snapshot.columns
    return snapshot.join(new.select(key), key, "left_anti").select(*columns).unionByName(new.select(*columns))


def upsert_stats(spark: SparkSession, current: str | None, new: DataFrame, target: str) -> DataFrame:
    """Write the merged snapshot to a new path and return it; the old one stays readable."""
    merged = new if current is None else upsert(spark.read.parquet(current), new)
    merged.coalesce(1).write.parquet(target)
    return spark.read.parquet(target)
