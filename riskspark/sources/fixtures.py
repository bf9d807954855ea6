"""Adapters: the engine's input tables derived from the generic test tables.

Purchases of the ``events`` table become transactions, its clicks and views
become logins, rolled up to one behaviour snapshot per customer and active day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskspark import schemas
from riskspark.functions.hashing import hash_uniform

EWM_DECAY = 0.7
MODEL_SEEDS = {"balanced_trees": 11, "numeric_trees": 22, "ensemble": 33}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.hour("ts")
    suspicious = ((hour <= 6) & (F.col("event_id") % 7 == 0)) | (F.col("value") > 200)
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "purchase")
        .select(
            F.col("user_id").alias("cst_dim_id"),
            F.to_date("ts").alias("transdate"),
            F.col("ts").cast("timestamp_ntz").alias("transdatetime"),
            (F.col("value") * 100).cast("decimal(18,2)").alias("amount"),
            F.col("event_id").alias("docno"),
            F.md5("props").alias("direction"),
            F.when(suspicious, 1).otherwise(0).alias("target"),
        )
    )


def behaviour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot per customer and day with a login, stamped the next midnight."""
    days = _daily_logins(spark, sf_dir)
    per_user = Window.partitionBy("user_id").orderBy("day_no")
    week, month = per_user.rangeBetween(-6, 0), per_user.rangeBetween(-29, 0)

    def over(frame, name: str) -> Column:
        return F.sum(name).over(frame)

    rolled = days.select(
        "user_id",
        "day",
        over(week, "logins").alias("l7"),
        over(month, "logins").alias("l30"),
        over(month, "gaps").alias("n30"),
        over(month, "gap_sum").cast("double").alias("s30"),
        over(month, "gap_squares").cast("double").alias("q30"),
        over(week, "gaps").alias("n7"),
        over(week, "gap_sum").cast("double").alias("s7"),
        F.collect_list(F.struct("day_no", "gaps", "gap_sum")).over(week).alias("recent"),
        F.size(F.array_distinct(F.flatten(F.collect_list("os_set").over(month)))).alias("oses"),
        F.size(F.array_distinct(F.flatten(F.collect_list("phone_set").over(month)))).alias("phones"),
        "day_no",
        "last_k",
    )

    def ratio(a: Column, b: Column) -> Column:
        return a / F.nullif(b, F.lit(0.0))

    n30 = F.col("n30")
    mean_us = ratio(F.col("s30"), n30.cast("double"))
    second_us = ratio(F.col("q30"), n30.cast("double"))
    variance = F.when(n30 == 1, F.lit(0.0)).when(
        n30 > 1, F.greatest(second_us - mean_us * mean_us, F.lit(0.0)) / 1e12
    )
    decay = lambda d: F.pow(F.lit(EWM_DECAY), (F.col("day_no") - d["day_no"]).cast("double"))
    weighted = F.aggregate("recent", F.lit(0.0), lambda acc, d: acc + decay(d) * d["gap_sum"].cast("double"))
    weights = F.aggregate("recent", F.lit(0.0), lambda acc, d: acc + decay(d) * d["gaps"].cast("double"))

    measured = rolled.withColumns(
        {
            "avg_i": mean_us / 1e6,
            "var_i": variance,
            "std_i": F.sqrt(variance),
            "avg7": ratio(F.col("s7"), F.col("n7").cast("double")) / 1e6,
            "ewm": ratio(weighted, weights) / 1e6,
            "f7": F.col("l7") / F.lit(7.0),
            "f30": F.col("l30") / F.lit(30.0),
        }
    )
    c = F.col
    return measured.select(
        F.date_add("day", 1).cast("timestamp_ntz").alias("transdate"),
        c("user_id").alias("cst_dim_id"),
        (c("oses") - 1).cast("int").alias("monthly_os_changes"),
        (c("phones") - 1).cast("int").alias("monthly_phone_model_changes"),
        F.concat(F.lit("phone_"), (c("last_k") % 7).cast("string")).alias("last_phone_model_categorical"),
        F.concat(F.lit("os_"), (c("last_k") % 5).cast("string")).alias("last_os_categorical"),
        c("l7").cast("int").alias("logins_last_7_days"),
        c("l30").cast("int").alias("logins_last_30_days"),
        c("f7").alias("login_frequency_7d"),
        c("f30").alias("login_frequency_30d"),
        ratio(c("f7") - c("f30"), c("f30")).alias("freq_change_7d_vs_mean"),
        ratio(c("l7").cast("double"), c("l30").cast("double")).alias("logins_7d_over_30d_ratio"),
        c("avg_i").alias("avg_login_interval_30d"),
        c("std_i").alias("std_login_interval_30d"),
        c("var_i").alias("var_login_interval_30d"),
        c("ewm").alias("ewm_login_interval_7d"),
        ratio(c("std_i") - c("avg_i"), c("std_i") + c("avg_i")).alias("burstiness_login_interval"),
        ratio(c("var_i"), c("avg_i")).alias("fano_factor_login_interval"),
        ratio(c("avg7") - c("avg_i"), c("std_i")).alias("zscore_avg_login_interval_7d"),
    )


def _daily_logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer and day: login count and sums of the gaps to the previous login.

    Gaps are taken inside (customer, hour) groups; an hour's first login reads
    the previous active hour's last login from a per-hour summary, so that no
    task holds all logins of a busy customer.
    """
    logins = (
        table(spark, sf_dir, "events")
        .where(F.col("event_type").isin("click", "view"))
        .select(
            "user_id",
            "event_id",
            F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
            F.to_date("ts").alias("day"),
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        )
        .withColumn("hour_no", F.expr("us div 3600000000"))
    )
    hours = logins.groupBy("user_id", "hour_no").agg(F.max("us").alias("last_us"))
    before = F.lag("last_us").over(Window.partitionBy("user_id").orderBy("hour_no"))
    carried = hours.select("user_id", "hour_no", before.alias("carried_us"))
    in_hour = F.lag("us").over(Window.partitionBy("user_id", "hour_no").orderBy("us", "event_id"))
    gap = F.col("us") - F.coalesce("previous_us", "carried_us")
    wide_gap = F.col("gap").cast("decimal(18,0)")
    return (
        logins.withColumn("previous_us", in_hour)
        .join(carried, ["user_id", "hour_no"])
        .withColumn("gap", gap)
        .groupBy("user_id", "day")
        .agg(
            F.count("*").alias("logins"),
            F.count("gap").alias("gaps"),
            F.coalesce(F.sum("gap"), F.lit(0)).alias("gap_sum"),
            F.coalesce(F.sum((wide_gap * wide_gap).cast("decimal(28,0)")), F.lit(0).cast("decimal(38,0)")).alias("gap_squares"),
            F.collect_set(F.col("k") % 5).alias("os_set"),
            F.collect_set(F.col("k") % 7).alias("phone_set"),
            F.max_by("k", F.struct("us", "event_id")).alias("last_k"),
        )
        .withColumn("day_no", F.unix_date("day"))
    )


def training_set(spark: SparkSession, sf_dir: str, stored: DataFrame | None = None) -> DataFrame:
    """Transactions with the behaviour columns in force, as the training step reads them; ``stored``: the snapshots, if they are there already."""
    from riskspark.operators.asof import asof_join

    snapshots = (behaviour(spark, sf_dir) if stored is None else stored).withColumnRenamed("transdate", "snapshot_ts")
    return asof_join(
        transactions(spark, sf_dir), snapshots, "cst_dim_id", "transdatetime", "snapshot_ts", schemas.BEHAVIOUR_COLUMNS
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic scores of three models with many ties: (docno, model, y_true, y_proba)."""
    models = F.array(
        *[F.struct(F.lit(m).alias("model"), hash_uniform(F.col("docno"), s).alias("u")) for m, s in MODEL_SEEDS.items()]
    )
    return (
        transactions(spark, sf_dir)
        .select("docno", F.col("target").alias("y_true"), F.inline(models))
        .select("docno", "model", "y_true", F.round((F.col("u") + F.col("y_true")) / 2, 2).alias("y_proba"))
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
