"""Evaluation of scores: one row per score, columns (model, scenario, ..., y_true, y_proba)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskspark.functions.search import double_array
from riskspark.operators.ranking import running_sums
from riskspark.session import cut_lineage

BETA = 2.0


def linspace(start: float, stop: float, n: int) -> list[float]:
    step = (stop - start) / (n - 1)
    return [i * step + start for i in range(n - 1)] + [stop]


# The three threshold grids in use.
GRID_TRAIN = linspace(0.01, 0.99, 200)
GRID_EVALUATE = linspace(0.01, 0.99, 99)
GRID_WEIGHTED = linspace(0.05, 0.95, 50)


def _share(num: Column, den: Column) -> Column:
    return F.coalesce(num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0)), F.lit(0.0))


def precision(tp="tp", fp="fp") -> Column:
    return _share(F.col(tp), F.col(tp) + F.col(fp))


def recall(tp="tp", fn="fn") -> Column:
    return _share(F.col(tp), F.col(tp) + F.col(fn))


def false_positive_rate(smooth: bool = False) -> Column:
    """fp / (fp + tn), 0 without negatives; ``smooth`` adds 1e-9 to the divisor instead."""
    if smooth:
        return F.col("fp").cast("double") / (F.col("fp") + F.col("tn") + F.lit(1e-9))
    return _share(F.col("fp"), F.col("fp") + F.col("tn"))


def accuracy() -> Column:
    return _share(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"))


def fbeta(beta: float = BETA) -> Column:
    weight = beta * beta
    return _share(F.lit(1.0 + weight) * F.col("tp"), F.lit(1.0 + weight) * F.col("tp") + F.lit(weight) * F.col("fn") + F.col("fp"))


def derived_metrics() -> dict[str, Column]:
    return {"precision": precision(), "recall": recall(), "fpr": false_positive_rate(), "accuracy": accuracy(), "f1": fbeta(1.0)}


def confusion(scores: DataFrame, threshold, by: list[str]) -> DataFrame:
    """tn, fp, fn, tp per group; ``threshold`` is a number or a column."""
    predicted = F.col("y_proba") >= (threshold if isinstance(threshold, Column) else F.lit(threshold))
    actual = F.col("y_true") == 1
    n = lambda cond: F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0))
    return scores.groupBy(*by).agg(
        n(~actual & ~predicted).alias("tn"), n(~actual & predicted).alias("fp"), n(actual & ~predicted).alias("fn"), n(actual & predicted).alias("tp")
    )


def threshold_index(score: Column, grid: list[float]) -> Column:
    """Number of grid values at or below the score; the grid is ascending and even.

    The even spacing gives the place to within one; the neighbours decide it.
    """
    n = len(grid)
    step = (grid[-1] - grid[0]) / (n - 1)
    values = double_array(grid)
    guess = F.greatest(F.least(F.floor((score - F.lit(grid[0])) / F.lit(step)).cast("int"), F.lit(n)), F.lit(0))
    reached = lambda offset: (F.coalesce(F.get(values, guess + offset), F.lit(float("inf"))) <= score).cast("int")
    below = F.greatest(guess - 1, F.lit(0))
    return below + F.when(guess > 0, reached(-1)).otherwise(0) + reached(0) + reached(1)


def threshold_sweep(scores: DataFrame, grid: list[float], by: list[str], beta: float = BETA) -> DataFrame:
    """Confusion counts and F-beta at every grid threshold, from one scan.

    Scores are counted per grid cell (at most len(grid) + 1 groups per model);
    the sums over higher cells run on those few counts.
    """
    return _sweep(scores.select(*by, "y_proba", *_labels()), grid, by, beta)


def _labels() -> list[Column]:
    positive = F.when(F.col("y_true") == 1, F.lit(1)).otherwise(F.lit(0))
    return [positive.alias("pos"), (F.lit(1) - positive).alias("neg")]


def _sweep(counts: DataFrame, grid: list[float], by: list[str], beta: float) -> DataFrame:
    """The sweep of a frame with ``pos`` and ``neg`` per score."""
    cells = (
        counts.withColumn("cell", threshold_index(F.col("y_proba"), grid))
        .groupBy(*by, "cell")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .groupBy(*by)
        .agg(F.collect_list(F.struct("cell", "pos", "neg")).alias("cells"))
    )
    # A score in cell c reaches the first c thresholds.
    rows = cells.select(*by, "cells", F.explode(F.sequence(F.lit(0), F.lit(len(grid) - 1))).alias("thr_index"))

    def total(name: str, reached: bool) -> Column:
        mine = F.filter("cells", lambda c: (c["cell"] > F.col("thr_index")) if reached else (c["cell"] <= F.col("thr_index")))
        return F.aggregate(mine, F.lit(0).cast("bigint"), lambda acc, c: acc + c[name]).alias({("pos", True): "tp", ("neg", True): "fp", ("pos", False): "fn", ("neg", False): "tn"}[name, reached])

    values = double_array(grid)
    swept = rows.select(
        *by, "thr_index", F.get(values, F.col("thr_index")).alias("thr"), total("neg", False), total("neg", True), total("pos", False), total("pos", True)
    )
    return swept.withColumn("fbeta", fbeta(beta))


def best_threshold(sweep: DataFrame, by: list[str]) -> DataFrame:
    """The sweep row with the greatest F-beta per group; the lowest threshold wins ties."""
    rest = [n for n in sweep.columns if n not in by]
    order = F.struct(F.col("fbeta"), -F.col("thr_index"))
    return sweep.groupBy(*by).agg(F.max_by(F.struct(*rest), order).alias("_b")).select(*by, "_b.*").withColumnsRenamed({"thr": "best_thr"})


def score_counts(scores: DataFrame, by: list[str]) -> DataFrame:
    """Positives and negatives per distinct score, stored: everything after it reads this small table."""
    counted = scores.select(*by, "y_proba", *_labels()).groupBy(*by, "y_proba").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return cut_lineage(counted, "score-counts")


def cumulative_counts(counts: DataFrame, by: list[str]) -> DataFrame:
    """Per distinct score: positives and negatives at or above it."""
    return running_sums(counts, by, "y_proba", ["pos", "neg"])


def roc_auc(scores: DataFrame, by: list[str]) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties counting half."""
    return _auc(score_counts(scores, by), by)


def _auc(counts: DataFrame, by: list[str]) -> DataFrame:
    # Pairs won at a score: its positives against the negatives below, and half of those level.
    won = F.col("pos") * (F.col("total_neg") - F.col("cum_neg") + F.col("neg") / F.lit(2.0))
    pairs = F.col("total_pos").cast("double") * F.col("total_neg")
    return (
        cumulative_counts(counts, by)
        .groupBy(*by, "total_pos", "total_neg")
        .agg(F.sum(won).alias("won"))
        .select(*by, (F.col("won") / F.nullif(pairs, F.lit(0.0))).alias("roc_auc"))
    )


def roc_curve(scores: DataFrame, by: list[str]) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score."""
    return cumulative_counts(score_counts(scores, by), by).select(
        *by,
        F.col("y_proba").alias("thr"),
        _share(F.col("cum_neg"), F.col("total_neg")).alias("fpr"),
        _share(F.col("cum_pos"), F.col("total_pos")).alias("tpr"),
    )


def both_curves(scores: DataFrame, by: list[str]) -> DataFrame:
    """(threshold, fpr, tpr, precision, recall) at every distinct score, from one running count."""
    return cumulative_counts(score_counts(scores, by), by).select(
        *by,
        F.col("y_proba").alias("thr"),
        _share(F.col("cum_neg"), F.col("total_neg")).alias("fpr"),
        _share(F.col("cum_pos"), F.col("total_pos")).alias("tpr"),
        _share(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        _share(F.col("cum_pos"), F.col("total_pos")).alias("recall"),
    )


def pr_curve(scores: DataFrame, by: list[str]) -> DataFrame:
    """(threshold, precision, recall) at every distinct score."""
    return cumulative_counts(score_counts(scores, by), by).select(
        *by,
        F.col("y_proba").alias("thr"),
        _share(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        _share(F.col("cum_pos"), F.col("total_pos")).alias("recall"),
    )


def classification_report(counts: DataFrame, by: list[str]) -> DataFrame:
    """Per class and averaged precision, recall, f1 and support from tn, fp, fn, tp."""
    c = lambda n: F.col(n).cast("double")

    def entry(label: str, tp: str, fp: str, fn: str) -> Column:
        p, r = _share(F.col(tp), F.col(tp) + F.col(fp)), _share(F.col(tp), F.col(tp) + F.col(fn))
        f1 = _share(2 * F.col(tp), 2 * F.col(tp) + F.col(fp) + F.col(fn))
        return F.struct(F.lit(label).alias("label"), p.alias("precision"), r.alias("recall"), f1.alias("f1"), (c(tp) + c(fn)).alias("support"))

    total = c("tn") + c("fp") + c("fn") + c("tp")
    paired = counts.select(*by, entry("0", "tn", "fn", "fp").alias("a"), entry("1", "tp", "fp", "fn").alias("b"), total.alias("n"), accuracy().alias("acc"))

    def mean(label: str, weigh: bool) -> Column:
        cells = []
        for part in ("precision", "recall", "f1"):
            x, y = F.col(f"a.{part}"), F.col(f"b.{part}")
            both = (x * F.col("a.support") + y * F.col("b.support")) / F.col("n") if weigh else (x + y) / 2
            cells.append(both.alias(part))
        return F.struct(F.lit(label).alias("label"), *cells, F.col("n").alias("support"))

    overall = F.struct(F.lit("accuracy").alias("label"), *[F.col("acc").alias(p) for p in ("precision", "recall", "f1")], F.col("n").alias("support"))
    rows = F.array(F.col("a"), F.col("b"), overall, mean("macro avg", False), mean("weighted avg", True))
    return paired.select(*by, F.inline(rows))


def normalised_confusion(counts: DataFrame, by: list[str]) -> DataFrame:
    """(actual, predicted, share of the actual class)."""
    cell = lambda a, p, n, other: F.struct(
        F.lit(a).alias("actual"), F.lit(p).alias("predicted"), _share(F.col(n), F.col(n) + F.col(other)).alias("share")
    )
    return counts.select(*by, F.inline(F.array(cell(0, 0, "tn", "fp"), cell(0, 1, "fp", "tn"), cell(1, 0, "fn", "tp"), cell(1, 1, "tp", "fn"))))


def evaluate(scores: DataFrame, by: list[str] = ["model", "scenario"], grid: list[float] = GRID_EVALUATE, beta: float = BETA) -> DataFrame:
    """The evaluation record of every group: best threshold, its metrics, and ROC-AUC, from one scan of the scores."""
    counts = score_counts(scores, by)
    best = best_threshold(_sweep(counts, grid, by, beta), by)
    rates = {k: v for k, v in derived_metrics().items() if k != "f1"}
    return (
        best.withColumns(rates)
        .join(_auc(counts, by), by)
        .select(*by, "best_thr", F.col("fbeta").alias("Fbeta"), F.lit(beta).alias("beta"), "roc_auc", "precision", "recall", "fpr", "accuracy", "tn", "fp", "fn", "tp")
    )
