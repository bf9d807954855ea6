"""Splitting and weighting of labelled rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from riskspark.functions.hashing import hash_rank
from riskspark.functions.numeric import coerce_to_zero
from riskspark.operators.quantiles import long_metric, order_statistics
from riskspark.session import cut_lineage

# The weighting rules.
FRAUD_BOOST = 3.0
HARD_FRAUD_BOOST = 2.0
EASY_LEGIT_DAMP = 0.5
FEW_LOGINS = 2
MANY_LOGINS = 20


#: The class of rows without a label.
NO_LABEL = "\x00"


def test_shares(counts: dict, test_size: float) -> dict:
    """Test rows per class: ceil(share of all rows), dealt out by largest remainder."""
    total = sum(counts.values())
    wanted = math.ceil(total * test_size)
    exact = {k: n * wanted / total for k, n in counts.items()}
    shares = {k: math.floor(v) for k, v in exact.items()}
    by_remainder = sorted(counts, key=lambda k: (-(exact[k] - shares[k]), str(k)))
    for k in by_remainder[: wanted - sum(shares.values())]:
        shares[k] += 1
    return shares


def mark_test_rows(df: DataFrame, label: str, key: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test``: in each class the rows with the smallest key hash, to the exact class share."""
    metric = F.coalesce(F.col(label).cast("string"), F.lit(NO_LABEL))
    counts = {r["metric"]: r["n"] for r in df.groupBy(metric.alias("metric")).agg(F.count("*").alias("n")).collect()}
    return mark_lowest(df, metric, test_shares(counts, test_size), key, seed, "is_test")


def mark_lowest(df: DataFrame, metric: Column, wanted: dict, key: str, seed: int, output: str) -> DataFrame:
    """Flag, per value of ``metric``, the ``wanted[value]`` rows with the smallest key hash.

    The cut is a hash value found by distributed rank selection, so no class is
    sorted. A row without key goes by its content. Rows that tie at the cut are cut again by a hash of their
    content; of exact copies of a row any may be taken, so they are stored once and cut by their place.
    """
    wanted = {k: n for k, n in wanted.items() if n > 0}
    content = hash_rank(F.to_json(F.struct(*df.columns)), seed)
    hashed = df.withColumn("_h", F.coalesce(hash_rank(F.col(key), seed), content)).withColumn("_m", metric)
    m = F.col("_m")
    first = order_statistics(
        hashed.select(m.alias("metric"), F.col("_h").cast("double").alias("value")),
        {k: [("rank", n - 1)] for k, n in wanted.items()},
    )
    cuts = {k: int(first[k].values[n - 1]) for k, n in wanted.items()}
    at_cut = _per_class(m, cuts, lambda cut: F.col("_h") == cut)
    below = _per_class(m, cuts, lambda cut: F.col("_h") < cut)
    tally = {
        r["_m"]: r for r in hashed.groupBy("_m").agg(F.sum(below.cast("int")).alias("below"), F.sum(at_cut.cast("int")).alias("level")).collect()
    }
    left = {k: n - tally[k]["below"] for k, n in wanted.items()}
    split = {k: n for k, n in left.items() if n < tally[k]["level"]}
    taken = F.lit(True)
    if split:
        tied = hashed.where(at_cut).select(m.alias("metric"), content.cast("double").alias("value"))
        found = order_statistics(tied, {k: [("rank", n - 1)] for k, n in split.items()})
        ties = {k: int(found[k].values[n - 1]) for k, n in split.items()}
        # Only rows at a cut that has to be split are hashed by content.
        taken = ~m.isin(list(split)) | _per_class(m, ties, lambda cut: content <= cut)
        level = _per_class(m, ties, lambda cut: content == cut)
        under = _per_class(m, ties, lambda cut: content < cut)
        sums = [F.sum((at_cut & c).cast("int")) for c in (under, level)]
        counts = {r["_m"]: (r["under"], r["level"]) for r in hashed.where(m.isin(list(split))).groupBy("_m").agg(sums[0].alias("under"), sums[1].alias("level")).collect()}
        copies = {k: n - counts[k][0] for k, n in split.items() if n - counts[k][0] < counts[k][1]}
        if copies:
            hashed = cut_lineage(hashed.withColumn("_row", F.monotonically_increasing_id()), "copies")
            equal = hashed.where(at_cut & level & m.isin(list(copies))).select(m.alias("metric"), F.col("_row").cast("double").alias("value"))
            places = order_statistics(equal, {k: [("rank", n - 1)] for k, n in copies.items()})
            last = {k: int(places[k].values[n - 1]) for k, n in copies.items()}
            taken = taken & (~level | ~m.isin(list(copies)) | _per_class(m, last, lambda cut: F.col("_row") <= cut))
    chosen = F.when(below, F.lit(True)).when(at_cut, taken).otherwise(F.lit(False))
    return hashed.withColumn(output, chosen).drop("_h", "_m", "_row")


def _per_class(metric: Column, cuts: dict, test) -> Column:
    chosen = F.lit(False)
    for k, cut in cuts.items():
        chosen = F.when(metric == k if k is not None else metric.isNull(), test(F.lit(cut))).otherwise(chosen)
    return chosen


def stratified_split(df: DataFrame, label: str, key: str, test_size: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) with the class proportions of ``df``; disjoint and complete."""
    marked = mark_test_rows(df, label, key, test_size, seed)
    return marked.where(~F.col("is_test")).drop("is_test"), marked.where("is_test").drop("is_test")


def scenario_weights(df: DataFrame, label: str = "target") -> DataFrame:
    """Add ``weight``: fraud counts more, hard fraud more still, easy legitimate rows less.

    The amount and activity levels are exact interpolated quantiles of ``df``.
    """
    has = set(df.columns)

    def number(name: str, default: float = 0.0) -> Column:
        return coerce_to_zero(df, name) if name in has else F.lit(default)

    amount = number("amount_clipped") if "amount_clipped" in has else number("amount")
    txns, logins = number("cust_txn_count"), number("logins_last_30_days")
    levels = order_statistics(
        long_metric(df, "amount", amount).unionByName(long_metric(df, "txns", txns)),
        {"amount": [("linear", 0.90)], "txns": [("linear", 0.75)]},
    )
    high = amount >= F.lit(levels["amount"].linear(0.90) or 0.0)
    typical = F.lit(levels["txns"].linear(0.75) or 0.0)
    fraud = F.col(label) == 1
    unusual = (logins <= FEW_LOGINS) | (number("is_high_burst") == 1) | (number("is_night") == 1)

    def factor(condition: Column, value: float) -> Column:
        return F.when(condition, F.lit(value)).otherwise(F.lit(1.0))

    weight = (
        factor(fraud, FRAUD_BOOST)
        * factor(fraud & high & (txns >= typical), HARD_FRAUD_BOOST)
        * factor(fraud & high & unusual, HARD_FRAUD_BOOST)
        * factor(~fraud & ~high & (txns > typical) & (logins > MANY_LOGINS), EASY_LEGIT_DAMP)
    )
    return df.withColumn("weight", weight)


def weight_summary(df: DataFrame, weight: str = "weight") -> DataFrame:
    return df.agg(F.min(weight).alias("min_weight"), F.max(weight).alias("max_weight"), F.avg(weight).alias("mean_weight"))


def class_weights(df: DataFrame, label: str = "target", mode: str = "scale_pos_weight") -> DataFrame:
    """Add ``class_weight``: negatives/positives on positives, or n / (2 n_c) with mode ``balanced``."""
    row = df.agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("p"), F.count("*").alias("n")).first()
    positives, total = row["p"] or 0, row["n"]
    negatives = total - positives
    if mode == "balanced":
        on_pos = total / (2.0 * positives) if positives else 1.0
        on_neg = total / (2.0 * negatives) if negatives else 1.0
    elif mode == "scale_pos_weight":
        on_pos, on_neg = (negatives / positives if positives else 1.0), 1.0
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return df.withColumn("class_weight", F.when(F.col(label) == 1, F.lit(on_pos)).otherwise(F.lit(on_neg)))
