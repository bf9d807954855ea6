"""Feature frames: the online view, the offline builder and the report of their differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskspark import schemas
from riskspark.functions.numeric import coerce_to_zero, column_types, fill_non_finite, to_timestamp_or_null
from riskspark.operators.asof import HOT_ROWS, asof_join
from riskspark.operators.stats import MISSING, FeatureStats, fit_offline, fit_online
from riskspark.plans.catalogue import OFFLINE, ONLINE, Profile, derived_layers

CUSTOMER_COLUMNS = ["cust_amount_mean", "cust_amount_std", "cust_amount_max", "cust_txn_count"]
OTHER_LABEL = "OTHER"


def _derive(df: DataFrame, profile: Profile, stats: FeatureStats) -> DataFrame:
    for layer in derived_layers(profile, stats.scalars, stats.amount_bins):
        df = df.withColumns(layer)
    return df


def attach_customers(df: DataFrame, customers: DataFrame | None) -> DataFrame:
    """Left join of the per-customer aggregates; AQE splits a hot customer or broadcasts a small side."""
    if customers is None or "cst_dim_id" not in df.columns:
        return df.withColumns({n: F.lit(None).cast("double") for n in CUSTOMER_COLUMNS})
    return df.join(customers.select("cst_dim_id", *CUSTOMER_COLUMNS), "cst_dim_id", "left")


def attach_globals(df: DataFrame, stats: DataFrame, columns: list[str]) -> DataFrame:
    """Columns of a one-row statistics frame on every row, as one scalar subquery."""
    packed = stats.select(F.struct(*columns).alias("g")).scalar()
    return df.withColumn("_g", packed).select("*", *[F.col("_g")[n].alias(n) for n in columns]).drop("_g")


def merge_behaviour(txns: DataFrame, behaviour: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Transactions with the behaviour snapshot in force at their time (NULL without one)."""
    snapshots = behaviour.withColumnRenamed("transdate", "snapshot_ts")
    return asof_join(
        txns, snapshots, "cst_dim_id", "transdatetime", "snapshot_ts", schemas.BEHAVIOUR_COLUMNS, hot_rows=hot_rows
    )


def online_from_merged(merged: DataFrame, stats: FeatureStats, keep: list[str] | None = None) -> DataFrame:
    """Online features of transactions that already carry their behaviour snapshot."""
    filled = {n: F.coalesce(n, F.lit(0.0)) for n in schemas.BEHAVIOUR_MEASURES}
    for n in schemas.BEHAVIOUR_COUNTS:
        kind = "double" if n.startswith("logins_") else "int"
        filled[n] = F.coalesce(n, F.lit(0)).cast(kind)
    filled["amount"] = F.col("amount").cast("double")
    based = attach_customers(merged.withColumns(filled), stats.customers)
    columns = ["cst_dim_id", "transdate", *schemas.FEATURE_COLUMNS]
    return _derive(based, ONLINE, stats).select(*columns, *[k for k in keep or [] if k not in columns])


def features_online(
    txns: DataFrame,
    behaviour: DataFrame,
    stats: FeatureStats | None = None,
    keep: list[str] | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """The 79-column feature view: two keys and the 77 contract features.

    ``keep`` names further transaction columns to carry along. Without ``stats``
    they are fitted on the whole tables, as the view does.
    """
    stats = stats or fit_online(txns, behaviour)
    return online_from_merged(merge_behaviour(txns, behaviour, hot_rows), stats, keep)


def group_rare(df: DataFrame, column: str, rare: DataFrame) -> DataFrame:
    """Replace values of the rare table by 'OTHER'; missing values read 'nan'.

    The fitted table is stored, so its size is known: Spark broadcasts it below
    its threshold and otherwise joins by value, splitting frequent values.
    """
    text = F.coalesce(F.col(column).cast("string"), F.lit(MISSING))
    keys = rare.select(F.col("value").alias("_value"), F.lit(True).alias("_rare"))
    marked = df.withColumn("_value", text).join(keys, "_value", "left")
    return marked.withColumn(column, F.when(F.col("_rare"), F.lit(OTHER_LABEL)).otherwise(F.col("_value"))).drop(
        "_value", "_rare"
    )


def coerce_inputs(df: DataFrame) -> DataFrame:
    """Training-profile typing: a timestamp, a numeric amount and numeric behaviour columns; absent ones are added."""
    has = column_types(df)
    out: dict[str, Column] = {}
    if "transdatetime" in has:
        out["transdatetime"] = to_timestamp_or_null(df, "transdatetime", has)
    else:
        out["transdatetime"] = F.lit(None).cast("timestamp_ntz")
    for name in ["amount", *schemas.BEHAVIOUR_NUMERIC]:
        out[name] = coerce_to_zero(df, name, has) if name in has else F.lit(0.0)
    return df.withColumns(out)


def features_offline(df: DataFrame, stats: FeatureStats) -> DataFrame:
    """Training-profile features of a merged frame, with statistics learnt elsewhere."""
    typed = coerce_inputs(df)
    for column, rare in stats.rare.items():
        if column in typed.columns:
            typed = group_rare(typed, column, rare)
    based = attach_customers(typed, stats.customers)
    based = based.withColumns({n: F.coalesce(n, F.lit(0.0)) for n in CUSTOMER_COLUMNS})
    derived = _derive(based, OFFLINE, stats)
    flat = _without_inputs(derived, df, stats)
    return fill_non_finite(flat, [n for n in flat.columns if n not in ("target", "transdate", "transdatetime")])


def _without_inputs(derived: DataFrame, df: DataFrame, stats: FeatureStats) -> DataFrame:
    """Constant defaults for features whose input column is absent."""
    has = set(df.columns)
    constants: dict[str, Column] = {}
    if "amount" not in has:
        constants.update({"amount_bin": F.lit("ALL"), "is_high_amount": F.lit(0)})
        zero = ["night_and_high_amount", "weekend_and_high_amount", "high_burst_and_high_amount", "high_amount_and_no_logins30"]
        constants.update({n: F.lit(0) for n in zero})
    if "cst_dim_id" not in has or stats.customers is None:
        names = ["cust_is_heavy_q75", "cust_is_heavy_q90", "cust_heavy_q75_x_night", "cust_heavy_q75_x_burst"]
        constants.update({n: F.lit(0) for n in [*names, "atypical_amount_vs_mean", "atypical_amount_vs_max"]})
        constants.update({n: F.lit(0.0) for n in ["amount_vs_cust_mean", "amount_vs_cust_max", "cust_heavy_q75_x_amount"]})
    return derived.withColumns(constants)


def fit_and_build_offline(train: DataFrame, *others: DataFrame) -> tuple[FeatureStats, list[DataFrame]]:
    """Fit on ``train`` and build features of ``train`` and the other frames."""
    stats = fit_offline(train)
    return stats, [features_offline(frame, stats) for frame in (train, *others)]


def paired_features(merged: DataFrame, online: FeatureStats, offline: FeatureStats) -> DataFrame:
    """Offline features of every row, and its online features in the struct ``online``.

    Both profiles are computed on the row itself, so no join on a document key is needed.
    """
    raw = merged.withColumn("_raw", F.struct(*merged.columns))
    packed = online_from_merged(raw, online, keep=["_raw"])
    both = packed.select(F.struct(*schemas.FEATURE_COLUMNS).alias("online"), "_raw.*")
    return features_offline(both, offline)


def skew_report(paired: DataFrame, features: list[str], tolerance: float = 1e-9) -> DataFrame:
    """Per feature: compared rows, rows that differ, their share, and the mean absolute difference.

    ``paired`` is the frame of ``paired_features``. Map-side aggregation leaves
    one row per feature and task to shuffle.
    """
    types = column_types(paired)
    cells = []
    for n in features:
        if isinstance(types[n], T.StringType):
            gap, differs = "CAST(NULL AS DOUBLE)", f"NOT (online.`{n}` <=> `{n}`)"
        else:
            gap = f"abs(CAST(online.`{n}` AS DOUBLE) - CAST(`{n}` AS DOUBLE))"
            scale = f"greatest(1D, abs(CAST(online.`{n}` AS DOUBLE)))"
            differs = f"coalesce({gap} > {tolerance}D * {scale}, NOT (online.`{n}` IS NULL AND `{n}` IS NULL))"
        cells.append(f"struct('{n}' AS feature, {gap} AS gap, CAST({differs} AS INT) AS differs)")
    return (
        paired.select(F.expr(f"inline(array({', '.join(cells)}))"))
        .groupBy("feature")
        .agg(F.count("*").alias("n_rows"), F.sum("differs").alias("n_different"), F.avg("gap").alias("mean_abs_diff"), F.avg("differs").alias("share_different"))
    )
