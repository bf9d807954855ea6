"""Stress scenarios on raw test rows, applied before features are built."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskspark.functions.numeric import coerce_to_zero, to_timestamp_or_null

FACTOR = 3.0
NIGHT_HOUR = 2
STAMP = "yyyy-MM-dd HH:mm:ss"


def amount_x3(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", coerce_to_zero(df, "amount") * F.lit(FACTOR))


def all_at_night(df: DataFrame) -> DataFrame:
    """Every valid time moved to 02:00 of its day, as text; invalid times become NULL."""
    if "transdatetime" not in df.columns:
        return df
    moment = to_timestamp_or_null(df, "transdatetime")
    night = F.to_date(moment).cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(NIGHT_HOUR))
    return df.withColumn("transdatetime", F.date_format(night, STAMP))


def burst_x3(df: DataFrame) -> DataFrame:
    if "burstiness_login_interval" not in df.columns:
        return df
    return df.withColumn("burstiness_login_interval", coerce_to_zero(df, "burstiness_login_interval") * F.lit(FACTOR))


SCENARIOS = {
    "unchanged": lambda df: df,
    "amounts tripled": amount_x3,
    "all at night": all_at_night,
    "burstiness tripled": burst_x3,
}
