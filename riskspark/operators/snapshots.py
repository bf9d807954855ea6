"""Statistics that a day's rows can be merged into: only the new rows are scanned."""

from __future__ import annotations

from dataclasses import dataclass
from math import sqrt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskspark.operators.quantiles import order_statistics
from riskspark.operators.stats import RARE_SOURCES, RARE_THRESHOLD, MISSING, FeatureStats, stored_customers
from riskspark.session import cut_lineage

_MOMENTS = "cst_dim_id, n_rows, n, mean, m2, high"


def _merged_moments(both: DataFrame) -> DataFrame:
    """One row per customer: counts add up; the deviation of the parts' means joins the sums of squares inside the parts."""
    parts = both.groupBy("cst_dim_id").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"), F.max("high").alias("high"), F.sum(F.col("n") * F.col("mean")).alias("total"),
        F.collect_list(F.struct("n", "mean", "m2")).alias("parts"),  # as many as snapshots are merged
    )
    mean = F.col("total") / F.nullif(F.col("n"), F.lit(0))
    square = lambda p: p["m2"] + p["n"] * (p["mean"] - F.col("mean")) * (p["mean"] - F.col("mean"))
    present = F.filter("parts", lambda p: p["n"] > 0)
    summed = F.aggregate(present, F.lit(0.0), lambda acc, p: acc + square(p))
    return parts.withColumn("mean", mean).withColumn("m2", summed).selectExpr(*_MOMENTS.split(", "))


@dataclass
class StatsSnapshot:
    """What the online statistics need of the rows seen so far.

    ``customers``: (cst_dim_id, n_rows, n, mean, m2, high), one row per customer, with a row for NULL; ``counts``: (metric, value, n) of
    amounts and bursts; ``labels``: (column, value, n) of the columns with rare values. All three are sums over rows, so
    that snapshots of disjoint rows merge into that of all rows, in any order. Quantiles are exact, from the counts.
    """

    customers: DataFrame
    counts: DataFrame
    labels: DataFrame

    @classmethod
    def of(cls, txns: DataFrame, behaviour: DataFrame) -> "StatsSnapshot":
        amount = F.col("amount").cast("double")
        n = F.count(amount)
        # Of no amounts the sum of squares is 0, not NULL.
        customers = txns.groupBy("cst_dim_id").agg(
            F.count("*").alias("n_rows"), n.alias("n"), F.avg(amount).alias("mean"), F.coalesce(F.var_pop(amount) * n, F.lit(0.0)).alias("m2"), F.max(amount).alias("high")
        )
        value = lambda df, metric, x: df.select(F.lit(metric).alias("metric"), x.cast("double").alias("value"))
        values = value(txns, "amount", amount).unionByName(value(behaviour, "burst", F.abs("burstiness_login_interval"))).where("value is not null and not isnan(value)")
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias("value")) for c in RARE_SOURCES]))
        labels = behaviour.select(cells.alias("x")).groupBy("x.column", "x.value").agg(F.count("*").alias("n"))
        return cls(customers, values.groupBy("metric", "value").agg(F.count("*").alias("n")), labels)

    def merge(self, other: "StatsSnapshot") -> "StatsSnapshot":
        add = lambda a, b, keys: a.unionByName(b).groupBy(*keys).agg(F.sum("n").alias("n"))
        return StatsSnapshot(
            _merged_moments(self.customers.unionByName(other.customers)), add(self.counts, other.counts, ["metric", "value"]), add(self.labels, other.labels, ["column", "value"])
        )

    def save(self, path: str) -> None:
        """Write to a new path: a snapshot that is read is never written over."""
        for name in ("customers", "counts", "labels"):
            getattr(self, name).write.parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "StatsSnapshot":
        return cls(*(spark.read.parquet(f"{path}/{name}") for name in ("customers", "counts", "labels")))

    def stored(self) -> "StatsSnapshot":
        return StatsSnapshot(*(cut_lineage(df, "snapshot") for df in (self.customers, self.counts, self.labels)))

    def customer_table(self) -> DataFrame:
        std: Column = F.sqrt(F.col("m2") / F.nullif(F.col("n"), F.lit(0)))
        return self.customers.where("cst_dim_id is not null").select(
            "cst_dim_id", F.col("mean").alias("cust_amount_mean"), F.coalesce(std, F.lit(0.0)).alias("cust_amount_std"),
            F.col("high").alias("cust_amount_max"), F.col("n_rows").cast("double").alias("cust_txn_count"),
        )

    def rare(self, threshold: int = RARE_THRESHOLD) -> dict[str, DataFrame]:
        return {c: self.labels.where((F.col("column") == c) & (F.col("n") < threshold)).select("value", "n") for c in RARE_SOURCES}

    def fit(self) -> FeatureStats:
        """The same statistics as a fit over all rows of the snapshot."""
        weighted = self.counts.withColumnRenamed("n", "weight").unionByName(
            self.customers.select(F.lit("cust_txn").alias("metric"), F.col("n_rows").cast("double").alias("value"), F.lit(1).cast("long").alias("weight"))
        )
        found = order_statistics(weighted, {"amount": [("disc", 0.99), ("disc", 0.90)], "burst": [("disc", 0.90)], "cust_txn": [("disc", 0.75), ("disc", 0.90)]})
        amount, burst, counts = found["amount"], found["burst"], found["cust_txn"]
        total = self.customers.where("n > 0").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("mean")).alias("s")).first()
        mean = total["s"] / total["n"] if total["n"] else None
        std = 1.0
        if mean is not None:
            m2 = self.customers.where("n > 0").agg(F.sum(F.col("m2") + F.col("n") * (F.col("mean") - mean) * (F.col("mean") - mean)).alias("m2")).first()["m2"]
            std = sqrt(max(m2, 0.0) / total["n"])
        scalars = {
            "amount_q99": amount.discrete(0.99),
            "amount_high_thresh": amount.discrete(0.90),
            "amount_mean": mean,
            "amount_std": std,
            "burst_q90": burst.discrete(0.90),
            "cust_txn_q75": counts.discrete(0.75),
            "cust_txn_q90": counts.discrete(0.90),
        }
        return FeatureStats(scalars, customers=stored_customers(self.customer_table()))
