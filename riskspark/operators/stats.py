"""Fitted statistics: what the feature expressions need to know about the population."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riskspark import schemas
from riskspark.functions.numeric import coerce_to_zero
from riskspark.operators.quantiles import long_metric, order_statistics
from riskspark.session import cut_lineage

RARE_THRESHOLD = 30
RARE_SOURCES = {"last_phone_model_categorical": "rare_phone_models", "last_os_categorical": "rare_oses"}
BIN_EDGES = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]
MISSING = "nan"

# Values used when the fitted frame lacks the column.
DEFAULT_SCALARS = {
    "amount_q99": 0.0,
    "amount_high_thresh": 0.0,
    "amount_mean": 0.0,
    "amount_std": 1.0,
    "burst_q90": 0.0,
    "cust_txn_q75": 0.0,
    "cust_txn_q90": 0.0,
}


@dataclass
class FeatureStats:
    """Scalars and bin edges as numbers, per-customer and rare-value tables as DataFrames."""

    scalars: dict[str, float | None]
    amount_bins: list[float] = field(default_factory=lambda: [0.0, 1.0])
    customers: DataFrame | None = None
    rare: dict[str, DataFrame] = field(default_factory=dict)

    def row(self, spark: SparkSession, model_name: str, best_thr: float = 0.0) -> DataFrame:
        """The scalars as one row of the global-statistics table."""
        values = {**self.scalars, "best_thr": best_thr}
        return spark.createDataFrame(
            [(model_name, *[values.get(c) for c in schemas.STATS_COLUMNS])], schemas.GLOBAL_STATS
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the artefact below ``path`` (scalars, customers, rare values)."""
        schema = T.StructType(
            [T.StructField(c, T.DoubleType()) for c in self.scalars]
            + [T.StructField("amount_bins", T.ArrayType(T.DoubleType()))]
        )
        head = spark.createDataFrame([(*self.scalars.values(), self.amount_bins)], schema)
        head.coalesce(1).write.parquet(f"{path}/scalars")
        if self.customers is not None:
            self.customers.write.parquet(f"{path}/customers")
        for column, values in self.rare.items():
            values.write.parquet(f"{path}/rare/{column}")

    @staticmethod
    def load(spark: SparkSession, path: str, rare_columns: list[str] | None = None) -> "FeatureStats":
        head = spark.read.parquet(f"{path}/scalars").first().asDict()
        bins = list(head.pop("amount_bins"))
        rare_columns = list(RARE_SOURCES) if rare_columns is None else rare_columns
        rare = {c: spark.read.parquet(f"{path}/rare/{c}") for c in rare_columns}
        return FeatureStats(head, bins, spark.read.parquet(f"{path}/customers"), rare)


# --- online profile: whole tables, discrete percentiles, population deviation -------------


def customer_agg_online(txns: DataFrame) -> DataFrame:
    amount = F.col("amount").cast("double")
    return txns.where(F.col("cst_dim_id").isNotNull()).groupBy("cst_dim_id").agg(
        F.avg(amount).alias("cust_amount_mean"),
        F.coalesce(F.stddev_pop(amount), F.lit(0.0)).alias("cust_amount_std"),
        F.max(amount).alias("cust_amount_max"),
        F.count("*").cast("double").alias("cust_txn_count"),
    )


def stored_customers(customers: DataFrame) -> DataFrame:
    """The per-customer table, written once.

    Spark then knows its size, and a join with it reads a plain shuffle, which
    AQE can split at a hot customer (it cannot above an aggregate).
    """
    return cut_lineage(customers, "customers")


def customer_counts(txns: DataFrame) -> DataFrame:
    """Transactions per customer; rows without a customer form one group, as in SQL."""
    return txns.groupBy("cst_dim_id").agg(F.count("*").cast("double").alias("n"))


def fit_online(txns: DataFrame, behaviour: DataFrame) -> FeatureStats:
    customers = stored_customers(customer_agg_online(txns))
    long = (
        long_metric(txns, "amount", F.col("amount"))
        .unionByName(long_metric(behaviour, "burst", F.abs("burstiness_login_interval")))
        .unionByName(long_metric(customer_counts(txns), "cust_txn", F.col("n")))
    )
    found = order_statistics(
        long,
        {
            "amount": [("disc", 0.99), ("disc", 0.90)],
            "burst": [("disc", 0.90)],
            "cust_txn": [("disc", 0.75), ("disc", 0.90)],
        },
    )
    amount, burst, counts = found["amount"], found["burst"], found["cust_txn"]
    scalars = {
        "amount_q99": amount.discrete(0.99),
        "amount_high_thresh": amount.discrete(0.90),
        "amount_mean": amount.mean,
        "amount_std": 1.0 if amount.std_pop is None else amount.std_pop,
        "burst_q90": burst.discrete(0.90),
        "cust_txn_q75": counts.discrete(0.75),
        "cust_txn_q90": counts.discrete(0.90),
    }
    return FeatureStats(scalars, customers=customers)


# --- offline profile: train rows only, interpolated percentiles, sample deviation ----------


def customer_agg_offline(df: DataFrame) -> DataFrame:
    rows = df.where(F.col("cst_dim_id").isNotNull()).select("cst_dim_id", coerce_to_zero(df, "amount").alias("amount"))
    return rows.groupBy("cst_dim_id").agg(
        F.avg("amount").alias("cust_amount_mean"),
        F.coalesce(F.stddev_samp("amount"), F.lit(0.0)).alias("cust_amount_std"),
        F.max("amount").alias("cust_amount_max"),
        F.count("*").cast("double").alias("cust_txn_count"),
    )


def rare_values(df: DataFrame, column: str, threshold: int = RARE_THRESHOLD) -> DataFrame:
    """Values of ``column`` seen fewer than ``threshold`` times (missing counts as 'nan')."""
    value = F.coalesce(F.col(column).cast("string"), F.lit(MISSING))
    return df.groupBy(value.alias("value")).agg(F.count("*").alias("n")).where(F.col("n") < threshold)


def amount_bin_edges(cuts: list[float], low: float, high: float) -> list[float]:
    """Distinct quantile edges, or six equal-width edges when fewer than three differ."""
    edges = sorted(set(cuts))
    if len(edges) >= 3:
        return edges
    return [low + (high - low) * i / 5 for i in range(6)]


def fit_offline(df: DataFrame, rare_threshold: int = RARE_THRESHOLD) -> FeatureStats:
    """Everything learnt from the training rows, in one pass per quantile round plus one.

    The customer and rare-value tables are stored in the shared folder, so that
    using them does not scan the training rows again.
    """
    scalars = dict(DEFAULT_SCALARS)
    bins = [0.0, 1.0]
    has = set(df.columns)
    parts, requests = [], {}
    if "amount" in has:
        parts.append(long_metric(df, "amount", coerce_to_zero(df, "amount")))
        requests["amount"] = [("linear", p) for p in (0.99, 0.90, *BIN_EDGES)]
    if "burstiness_login_interval" in has:
        parts.append(long_metric(df, "burst", F.abs(coerce_to_zero(df, "burstiness_login_interval"))))
        requests["burst"] = [("linear", 0.90)]
    customers = None
    if "cst_dim_id" in has and "amount" in has:
        customers = stored_customers(customer_agg_offline(df))
        parts.append(long_metric(customers, "cust_txn", F.col("cust_txn_count")))
        requests["cust_txn"] = [("linear", 0.75), ("linear", 0.90)]
    if parts:
        long = parts[0]
        for part in parts[1:]:
            long = long.unionByName(part)
        found = order_statistics(long, requests)
        if "amount" in found and found["amount"].n:
            amount = found["amount"]
            q99 = amount.linear(0.99)
            limits = (0.0, q99)
            cuts = [amount.linear(p, limits) for p in BIN_EDGES]
            bins = amount_bin_edges(cuts, cuts[0], cuts[-1])
            clipped = F.least(F.greatest(coerce_to_zero(df, "amount"), F.lit(0.0)), F.lit(q99))
            moments = df.agg(F.avg(clipped).alias("m"), F.stddev_pop(clipped).alias("s")).first()
            scalars.update(
                amount_q99=q99,
                amount_high_thresh=amount.linear(0.90, limits),
                amount_mean=moments["m"],
                amount_std=moments["s"] if moments["s"] > 0 else 1.0,
            )
        if "burst" in found and found["burst"].n:
            scalars["burst_q90"] = found["burst"].linear(0.90)
        if "cust_txn" in found and found["cust_txn"].n:
            scalars["cust_txn_q75"] = found["cust_txn"].linear(0.75)
            scalars["cust_txn_q90"] = found["cust_txn"].linear(0.90)
    rare = {c: cut_lineage(rare_values(df, c, rare_threshold), "rare") for c in RARE_SOURCES if c in has}
    return FeatureStats(scalars, bins, customers, rare)


def class_balance(df: DataFrame, label: str = "target") -> DataFrame:
    """One row: class counts, positive share and ``scale_pos_weight`` = negatives / positives."""
    positives = F.sum(F.when(F.col(label) == 1, 1).otherwise(0))
    negatives = F.sum(F.when(F.col(label) == 0, 1).otherwise(0))
    counted = df.agg(negatives.alias("negatives"), positives.alias("positives"))
    total = (F.col("negatives") + F.col("positives")).cast("double")
    return counted.select(
        "negatives",
        "positives",
        (F.col("positives") / F.nullif(total, F.lit(0.0))).alias("positive_share"),
        (F.col("negatives") / F.nullif(F.col("positives").cast("double"), F.lit(0.0))).alias("scale_pos_weight"),
    )
