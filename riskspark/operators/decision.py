"""Ensembling, model roles and routing of scored transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Soft-voting weights.
ENSEMBLE_WEIGHTS = (0.7, 0.3)


def ensemble_score(first: Column, second: Column, weights: tuple[float, float] = ENSEMBLE_WEIGHTS) -> Column:
    return F.lit(weights[0]) * first + F.lit(weights[1]) * second


def ensemble_scores(scores: DataFrame, first: str, second: str, key: str, weights: tuple[float, float] = ENSEMBLE_WEIGHTS) -> DataFrame:
    """Blend two models of a long (key, model, y_true, y_proba) frame.

    One pass that pivots by conditional aggregation; no self-join. ``key`` has to tell rows apart: where a model has
    several scores of one key, they cannot be paired, and the query fails rather than lose a row. Scores
    that stand side by side on a row are blended by ``ensemble_score``, which needs no key.
    """

    def of(m):
        mine = F.when(F.col("model") == m, F.col("y_proba"))
        several = F.raise_error(F.concat(F.lit(f"model {m} has several scores of one {key}: "), F.col(key).cast("string")))
        return F.when(F.count(F.when(F.col("model") == m, F.lit(1))) > 1, several.cast("double")).otherwise(F.max(mine))

    return (
        scores.where(F.col("model").isin(first, second))
        .groupBy(key)
        .agg(F.max("y_true").alias("y_true"), of(first).alias("_a"), of(second).alias("_b"))
        .select(key, F.lit("ensemble").alias("model"), "y_true", ensemble_score(F.col("_a"), F.col("_b"), weights).alias("y_proba"))
    )


def with_roles(scores: DataFrame, roles: dict[str, str]) -> DataFrame:
    """Add each model's role (``decision`` or ``shadow``); roles do not alter scores."""
    role = F.lit(None).cast("string")
    for model, name in roles.items():
        role = F.when(F.col("model") == model, F.lit(name)).otherwise(role)
    return scores.withColumn("role", role)


def decision_scores(scores: DataFrame) -> DataFrame:
    return scores.where(F.col("role") == "decision")


def route_decision(score: Column, mode: str = "threshold", low: float | None = None, high: float = 0.5) -> Column:
    """APPROVE, REVIEW or DECLINE.

    ``threshold``: from ``high`` up DECLINE, from ``low`` up REVIEW, else
    APPROVE. ``reference``: the inherited rule, APPROVE only when the
    prediction equals 1.
    """
    if mode == "reference":
        return F.when(score == 1, F.lit("APPROVE")).otherwise(F.lit("DECLINE"))
    low = high if low is None else low
    return F.when(score >= high, F.lit("DECLINE")).when(score >= low, F.lit("REVIEW")).when(score.isNotNull(), F.lit("APPROVE")).otherwise(F.lit("REVIEW"))
