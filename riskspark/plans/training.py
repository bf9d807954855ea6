"""Gradient-boosted models on the feature frame, their importances and attributions."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from riskspark.functions.hashing import hash_rank
from riskspark.operators.metrics import roc_auc
from riskspark.operators.ranking import sample_rows
from riskspark.operators.sampling import class_weights, mark_test_rows, scenario_weights
from riskspark.operators.target_means import apply_target_means, fit_target_means, mean_column, ordered_target_means
from riskspark.plans.trees import Boosting, TreeModel, doubles, fit_trees, matrix
from riskspark.session import cut_lineage

# Hyper-parameters of the three training set-ups.
BALANCED = Boosting(rounds=1200, depth=6, rate=0.035, penalty=5.0)
NUMERIC = Boosting(rounds=600, depth=5, rate=0.05)
WEIGHTED = replace(BALANCED, rounds=1800)
SEED = 42
#: Rows that exchange values with each other when a column is shuffled.
DONOR_ROWS = 20_000


def _fit(train: DataFrame, numeric: list[str], categorical: list[str], label: str, key: str, weight: str, setup: Boosting) -> TreeModel:
    """The best round is chosen on a tenth of the training rows, which nothing else is fitted to; never on the test set.

    A training row's category means come from rows before it in a hashed order; watched rows, like all later ones, get
    the means over all rows that are trained on.
    """
    marked = mark_test_rows(train, label, key, 0.1, SEED).withColumn(label, F.col(label).cast("double"))
    marked = cut_lineage(marked.select(*{n: None for n in [*numeric, *categorical, label, key, weight, "is_test"]}), "train-rows")
    fitted, watched = marked.where("not is_test"), marked.where("is_test")
    prior, means = 0.0, None
    if categorical:
        prior = fitted.agg(F.avg(label)).first()[0] or 0.0
        means = cut_lineage(fit_target_means(fitted, categorical, label), "target-means")
        fitted = ordered_target_means(fitted, categorical, label, key, prior, seed=SEED)
        watched = apply_target_means(watched, means, categorical, prior)
    names = [*numeric, *[mean_column(c) for c in categorical]]
    kept = list({n: None for n in [*names, label, weight, "is_test"]})
    trees, base, losses = fit_trees(fitted.select(*kept).unionByName(watched.select(*kept)), names, label, weight, "is_test", setup)
    return TreeModel(numeric, categorical, trees, base, prior, means, losses)


def train_balanced(train: DataFrame, numeric: list[str], categorical: list[str], label: str = "target", key: str = "docno", **setup) -> TreeModel:
    """Mixed features, positives weighted by negatives / positives."""
    return _fit(class_weights(train, label), numeric, categorical, label, key, "class_weight", replace(BALANCED, **setup))


def train_numeric(train: DataFrame, numeric: list[str], label: str = "target", key: str = "docno", **setup) -> TreeModel:
    """Numeric features only, same class weight."""
    return _fit(class_weights(train, label), numeric, [], label, key, "class_weight", replace(NUMERIC, **setup))


def train_weighted(train: DataFrame, numeric: list[str], categorical: list[str], label: str = "target", key: str = "docno", **setup) -> TreeModel:
    """Balanced class weights times scenario weights."""
    both = class_weights(scenario_weights(train, label), label, "balanced").withColumn("train_weight", F.col("weight") * F.col("class_weight"))
    return _fit(both, numeric, categorical, label, key, "train_weight", replace(WEIGHTED, **setup))


def score_models(df: DataFrame, models: list[TreeModel], keep: list[str]) -> DataFrame:
    """``keep`` and, for each model i, ``_score_i`` and ``_error_i``: one Arrow pass over the rows, no shuffle but for category means.

    An error in one model, for a batch of rows, is the error of those rows; other batches and models are scored.
    """
    rows, names = df, []
    for i, model in enumerate(models):
        rows = model.with_inputs(rows, f"_m{i}_")
        names.append(model.inputs(f"_m{i}_"))
    held = df.sparkSession.sparkContext.broadcast([replace(m, means=None) for m in models])
    every = list({n: None for part in names for n in part})
    place = [[every.index(n) for n in part] for part in names]
    rows = rows.select(*keep, *doubles(every))
    schema = df.select(*keep).schema
    for i in range(len(models)):
        schema = schema.add(f"_score_{i}", "double").add(f"_error_{i}", "string")

    def run(batches):
        for batch in batches:
            columns, n = batch.columns[: len(keep)], batch.num_rows
            x = matrix(batch.columns[len(keep) :]) if every else np.empty((n, 0))
            for model, at in zip(held.value, place):
                try:
                    score, error = pa.array(model.probability(x[:, at])), pa.nulls(n, pa.string())
                except Exception as problem:  # isolation of one model's failure is the contract
                    said = (str(problem).splitlines() or [type(problem).__name__])[0][:500]
                    score, error = pa.nulls(n, pa.float64()), pa.array([said] * n, pa.string())
                columns += [score, error]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def positive_probability(model: TreeModel, df: DataFrame, output: str = "y_proba") -> DataFrame:
    """``df`` with the probability of the positive class."""
    kept = [n for n in df.columns if n != output]
    scored = score_models(df, [model], kept)
    failed = F.raise_error(F.col("_error_0")).cast("double")
    return scored.select(*kept, F.when(F.col("_error_0").isNull(), F.col("_score_0")).otherwise(failed).alias(output))


def feature_importance(model: TreeModel, spark) -> DataFrame:
    """(feature, importance): each feature's share of all gain, greatest first."""
    gain = np.zeros(len(model.features))
    inner = model.trees.feature >= 0
    np.add.at(gain, model.trees.feature[inner], model.trees.gain[inner])
    rows = [(n, float(v)) for n, v in zip(model.features, gain / (gain.sum() or 1.0))]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


def permutation_importance(model: TreeModel, df: DataFrame, features: list[str], label: str = "target", key: str = "docno", rows: int | None = None, seed: int = SEED) -> DataFrame:
    """AUC lost when one column is shuffled, over all rows, or over a sample of ``rows`` where that is asked for.

    Rows take the values of the next one in the order of a hash, in a circle, within groups of about DONOR_ROWS that the hash
    makes; so a shuffle is one exchange, whatever the number of rows. All shuffled copies are scored in a single pass.
    """
    every = df.select(key, label, *[f for f in features if f not in (key, label)])
    if rows is not None:
        every = sample_rows(every, key, rows, seed)
    groups = 1 + every.count() // DONOR_ROWS
    place = F.coalesce(hash_rank(F.to_json(F.struct("*")), f"{seed}|shuffle"), F.lit(0))
    hashed = every.withColumn("_h", place).withColumn("_g", F.pmod(F.col("_h"), F.lit(groups)))
    circle = Window.partitionBy("_g").orderBy("_h")
    whole = F.struct(*[F.col(f) for f in features])
    first = F.first(whole).over(circle.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    paired = hashed.withColumn("_p", F.coalesce(F.lead(whole).over(circle), first))
    names = F.array(F.lit("(none)"), *[F.lit(f) for f in features])
    copies = paired.select("*", F.explode(names).alias("feature"))
    mixed = copies.withColumns({f: F.when(F.col("feature") == f, F.col("_p")[f]).otherwise(F.col(f)) for f in features})
    scored = positive_probability(model, mixed.select("feature", label, *features, *[key for _ in [0] if key not in features]))
    auc = roc_auc(scored.select("feature", F.col(label).alias("y_true"), "y_proba"), ["feature"])
    base = auc.where("feature = '(none)'").select("roc_auc").scalar()
    return auc.where("feature <> '(none)'").select("feature", (base - F.col("roc_auc")).alias("value"))
