"""Batch scoring by several configured models, and the stress suite."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskspark.operators.metrics import BETA, GRID_EVALUATE, evaluate
from riskspark.operators.scenarios import SCENARIOS
from riskspark.operators.stats import FeatureStats
from riskspark.plans.contract import project_contract
from riskspark.plans.features import features_offline
from riskspark.plans.training import score_models
from riskspark.plans.trees import TreeModel


@dataclass
class ModelVariant:
    """A configured model: a fitted one, or the path of a saved one."""

    name: str
    role: str
    model: TreeModel | str
    feature_cols: list[str]

    def load(self, spark: SparkSession | None = None) -> TreeModel:
        if isinstance(self.model, str):
            return TreeModel.load(spark or SparkSession.active(), self.model)
        return self.model


def score_batch(features: DataFrame, variants: list[ModelVariant], key: str = "docno") -> DataFrame:
    """(key, model, role, score, error), one row per input row and model.

    The columns are those of the first model's contract, for all models. All models score in one pass. One that cannot be
    loaded, or lacks a column, yields its error instead of a score for all rows; one that fails on some rows yields
    its error for the batch that holds them, and the other models go on.
    """
    contract = variants[0].feature_cols
    keyed = features.withColumn("_key", F.col(key))
    rows = project_contract(keyed, contract, keep=["_key"]).drop("missing_features")
    loaded, cells = [], []
    for variant in variants:
        score, error = F.lit(None).cast("double"), F.lit(None).cast("string")
        try:
            model = variant.load(features.sparkSession)
            if absent := [n for n in model.features if n not in rows.columns]:
                raise LookupError(f"missing columns: {', '.join(absent)}")
            score, error = F.col(f"_score_{len(loaded)}"), F.col(f"_error_{len(loaded)}")
            loaded.append(model)
        except Exception as problem:  # isolation of one model's failure is the contract
            error = F.lit((str(problem).splitlines() or [type(problem).__name__])[0][:500])
        cells.append(
            F.struct(F.lit(variant.name).alias("model"), F.lit(variant.role).alias("role"), score.alias("score"), error.alias("error"))
        )
    scored = score_models(rows, loaded, ["_key"]) if loaded else rows
    return scored.select(F.col("_key").alias(key), F.inline(F.array(*cells)))


def stress_frames(test: DataFrame) -> DataFrame:
    """All scenarios of the raw test rows in one frame, told apart by ``scenario``."""
    frames = []
    for name, change in SCENARIOS.items():
        changed = change(test)
        stamped = changed.withColumns(
            {"scenario": F.lit(name), "transdatetime": F.col("transdatetime").cast("string"), "amount": F.col("amount").cast("double")}
        )
        frames.append(stamped)
    return reduce(lambda a, b: a.unionByName(b), frames)


def stress_suite(test: DataFrame, stats: FeatureStats, variants: list[ModelVariant], label: str = "target", add_scores=None, grid=GRID_EVALUATE, beta: float = BETA) -> DataFrame:
    """Evaluation record per (model, scenario); features are built and scored once for all scenarios.

    ``add_scores`` may add anomaly scores to the feature frame; the anomaly
    model is fitted once by the caller.
    """
    built = features_offline(stress_frames(test), stats)
    if add_scores is not None:
        built = add_scores(built)
    keyed = built.withColumn("_row", F.struct("docno", "scenario", label))
    scored = score_batch(keyed, variants, "_row")
    scores = scored.where(F.col("error").isNull()).select(
        "model", F.col("_row.scenario").alias("scenario"), F.col(f"_row.{label}").alias("y_true"), F.col("score").alias("y_proba")
    )
    return evaluate(scores, ["model", "scenario"], grid, beta)
