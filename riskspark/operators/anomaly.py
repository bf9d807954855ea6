"""Anomaly features: isolation forest (Liu, Ting, Zhou 2008) and novelty LOF (Breunig et al. 2000)."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from riskspark.operators.knn import as_points, knn_join
from riskspark.operators.quantiles import order_statistics
from riskspark.session import cut_lineage

N_TREES = 200
TREE_ROWS = 256
LOF_NEIGHBOURS = 50
CONTAMINATION = 0.01
SEED = 42
_TINY = 1e-10


def average_path(n) -> np.ndarray:
    """Mean depth of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    long_form = 2.0 * (np.log(big - 1.0) + np.euler_gamma) - 2.0 * (big - 1.0) / big
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, long_form))


def grow_tree(rows: np.ndarray, max_depth: int, rng: np.random.Generator) -> list[tuple]:
    """Nodes (node, feature, threshold, left, right, path): leaves have feature -1."""
    nodes: list[tuple] = []
    waiting = [(rows, 0, 0)]
    issued = 1
    while waiting:
        part, node, depth = waiting.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        movable = np.flatnonzero(high > low)
        if depth >= max_depth or len(part) <= 1 or not len(movable):
            nodes.append((node, -1, 0.0, node, node, float(depth + average_path(len(part)))))
            continue
        feature = int(rng.choice(movable))
        threshold = float(rng.uniform(low[feature], high[feature]))
        goes_left = part[:, feature] <= threshold
        if goes_left.all():
            threshold = float(low[feature])
            goes_left = part[:, feature] <= threshold
        left, right = issued, issued + 1
        issued += 2
        nodes.append((node, feature, threshold, left, right, 0.0))
        waiting += [(part[goes_left], left, depth + 1), (part[~goes_left], right, depth + 1)]
    return nodes


def draw_rows(train: DataFrame, key: str, columns: list[str], n_trees: int = N_TREES, tree_rows: int = TREE_ROWS, seed: int = SEED) -> tuple[DataFrame, int]:
    """(tree, place, vec) of ``tree_rows`` rows per tree, drawn from all rows, and the rows per tree.

    A hash of a row's content and the tree lets it through with a small probability, so that about twice the wanted rows are
    left per tree; of these the least hashes are taken. Neither partitions nor the order of rows matter. Equal rows
    (key and values) are one row with a count, whose copies are drawn one by one.
    """
    total = train.count()
    per_tree = min(tree_rows, total)
    # So many that a tree with fewer than it wants does not occur (11 standard deviations at 256 rows).
    chance = min(1.0, (2 * per_tree + 64) / max(total, 1))
    vec = F.array(*[F.col(c).cast("double") for c in columns])
    rows = train.select(F.col(key).cast("string").alias("k"), vec.alias("vec")).groupBy("k", "vec").agg(F.count("*").alias("n"))
    salts = np.random.default_rng(seed).integers(0, 2**64, n_trees, dtype=np.uint64)

    def drawn(batches):
        for batch in batches:
            h, n = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            once, row, tree, rank = np.flatnonzero(n == 1), [], [], []
            for t, salt in enumerate(salts):
                u = _uniform(h[once] ^ salt)
                hit = np.flatnonzero(u < chance)
                row.append(once[hit])
                tree.append(np.full(len(hit), t))
                rank.append(u[hit])
            for i in np.flatnonzero(n > 1):
                rng = np.random.default_rng([seed, int(h[i])])
                copies = rng.binomial(n[i], chance, n_trees)
                tree.append(np.repeat(np.arange(n_trees), copies))
                row.append(np.full(len(tree[-1]), i))
                rank.append(rng.uniform(0, chance, len(tree[-1])))
            at = pa.array(np.concatenate(row))
            columns = [pa.array(np.concatenate(tree).astype(np.int32)), pa.array(np.concatenate(rank)), batch.column(0).take(at), batch.column(2).take(at)]
            yield pa.RecordBatch.from_arrays(columns, names=["tree", "rank", "h", "vec"])

    hashed = rows.select(F.xxhash64("k", "vec").alias("h"), "n", "vec")
    picked = cut_lineage(hashed.mapInArrow(drawn, "tree int, rank double, h long, vec array<double>"), "forest-rows")
    place = F.row_number().over(Window.partitionBy("tree").orderBy("rank", "h", "vec"))  # a tree has a few hundred rows
    return picked.withColumn("place", place).where(F.col("place") <= per_tree).select("tree", "place", "vec"), per_tree


def _uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from 64-bit integers, by the last steps of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53


def fit_forest(train: DataFrame, key: str, columns: list[str], n_trees: int = N_TREES, tree_rows: int = TREE_ROWS, seed: int = SEED) -> tuple[DataFrame, int]:
    """(node table, rows per tree). Each tree draws its rows from all of ``train``; trees are grown in parallel, one bounded group each."""
    sampled, per_tree = draw_rows(train, key, columns, n_trees, tree_rows, seed)
    depth = max(1, math.ceil(math.log2(max(per_tree, 2))))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        ordered = group.sort_values("place")
        matrix = np.array([np.asarray(v, dtype=float) for v in ordered["vec"]])
        nodes = grow_tree(matrix, depth, np.random.default_rng([seed, tree]))
        frame = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left", "right", "path"])
        frame.insert(0, "tree", tree)
        return frame

    schema = "tree int, node int, feature int, threshold double, left int, right int, path double"
    return sampled.groupBy("tree").applyInPandas(grow, schema), per_tree


def pack_forest(nodes: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """Node arrays of shape (trees, nodes)."""
    trees, width = nodes["tree"].nunique(), int(nodes["node"].max()) + 1
    tree_pos = nodes["tree"].rank(method="dense").astype(int).to_numpy() - 1
    packed = []
    for name, kind in (("feature", "int32"), ("threshold", "float64"), ("left", "int32"), ("right", "int32"), ("path", "float64")):
        grid = np.zeros((trees, width), dtype=kind)
        grid[tree_pos, nodes["node"].to_numpy()] = nodes[name].to_numpy()
        packed.append(grid)
    return tuple(packed)


def forest_score(matrix: np.ndarray, packed: tuple[np.ndarray, ...], per_tree: int) -> np.ndarray:
    """2 ** (-mean path / average_path(per_tree)); greater is more anomalous."""
    feature, threshold, left, right, path = packed
    trees = len(feature)
    total = np.zeros(len(matrix))
    rows = np.arange(len(matrix))
    for t in range(trees):
        at = np.zeros(len(matrix), dtype=np.int32)
        while True:
            f = feature[t, at]
            inner = f >= 0
            if not inner.any():
                break
            goes_left = matrix[rows, np.maximum(f, 0)] <= threshold[t, at]
            at = np.where(inner, np.where(goes_left, left[t, at], right[t, at]), at)
        total += path[t, at]
    scale = float(average_path(per_tree))
    return 2.0 ** (-(total / trees) / scale) if scale > 0 else np.full(len(matrix), 0.5)


def score_forest(df: DataFrame, columns: list[str], nodes: DataFrame, per_tree: int, output: str = "iforest_score") -> DataFrame:
    """Add the forest score. The node table is at most trees x (2 x rows per tree) entries, broadcast."""
    shared = df.sparkSession.sparkContext.broadcast(pack_forest(nodes.toPandas()))

    @F.pandas_udf(T.DoubleType())
    def score(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        packed = shared.value
        for batch in values:
            matrix = np.array([np.asarray(v, dtype=float) for v in batch]).reshape(len(batch), -1)
            yield pd.Series(forest_score(matrix, packed, per_tree) if len(batch) else [], dtype=float)

    return df.withColumn(output, score(F.array(*[F.col(c).cast("double") for c in columns])))


def isolation_forest(train: DataFrame, frames: list[DataFrame], key: str, columns: list[str], n_trees: int = N_TREES, tree_rows: int = TREE_ROWS, seed: int = SEED) -> list[DataFrame]:
    """Fit on ``train`` and add ``iforest_score`` to every frame."""
    nodes, per_tree = fit_forest(train, key, columns, n_trees, tree_rows, seed)
    stored = cut_lineage(nodes, "forest")
    return [score_forest(f, columns, stored, per_tree) for f in frames]


# --- local outlier factor -------------------------------------------------------------------


def _distinct_points(points: DataFrame) -> DataFrame:
    """Copies of a vector as one weighted point, so that a popular vector costs one row."""
    return points.groupBy("vec").agg(F.min("id").alias("id"), F.sum("weight").alias("weight")).select("id", "vec", F.array().cast("array<bigint>").alias("cats"), "weight")


def _take(pairs: DataFrame, k: int) -> DataFrame:
    """Cut the neighbour weights of every query to ``k`` in total, nearest first."""
    ranked = Window.partitionBy("query_id").orderBy("distance", "base_id").rowsBetween(Window.unboundedPreceding, -1)
    room = F.lit(k) - F.coalesce(F.sum("weight").over(ranked), F.lit(0))
    return pairs.withColumn("used", F.greatest(F.least(F.col("weight"), room), F.lit(0))).where("used > 0")


def _density(pairs: DataFrame, radii: DataFrame, k: int) -> DataFrame:
    """(query_id, lrd): inverse mean reachability distance."""
    reach = F.greatest("distance", "radius") * F.col("used")
    return (
        pairs.join(radii, "base_id")
        .groupBy("query_id")
        .agg((F.lit(1.0) / (F.sum(reach) / F.lit(float(k)) + F.lit(_TINY))).alias("lrd"))
    )


def _factor(pairs: DataFrame, own: DataFrame, fitted: DataFrame, k: int) -> DataFrame:
    """(query_id, lof): mean density of the neighbours over the own density."""
    neighbours = fitted.select(F.col("query_id").alias("base_id"), F.col("lrd").alias("base_lrd"))
    mean = pairs.join(neighbours, "base_id").groupBy("query_id").agg((F.sum(F.col("base_lrd") * F.col("used")) / F.lit(float(k))).alias("m"))
    return mean.join(own, "query_id").select("query_id", (F.col("m") / F.col("lrd")).alias("lof"))


@dataclass
class OutlierModel:
    """What a novelty LOF needs of its training rows: the distinct points, their neighbours, radii and densities, and the offset."""

    k: int
    base: DataFrame
    own: DataFrame
    radii: DataFrame
    density: DataFrame
    offset: float
    options: dict

    def score(self, frame: DataFrame, key: str, vector, output: str = "lof_score", trained_on: bool = False) -> DataFrame:
        """``frame`` with ``output``; ``trained_on``: it has just the training rows."""
        if trained_on:  # the k + 1 nearest of its points are known, and hold the k nearest
            single, near = self.base, self.own
        else:
            single = cut_lineage(_distinct_points(as_points(frame, key, vector)), "lof-query")
            near = knn_join(single, self.base, self.k, **self.options)
        pairs = cut_lineage(_take(near, self.k), "lof-score")
        lof = _factor(pairs, _density(pairs, self.radii, self.k), self.density, self.k)
        by_vector = single.join(lof, single["id"] == lof["query_id"]).select("vec", (F.col("lof") + F.lit(self.offset)).alias(output))
        vec = F.array(*[F.col(n).cast("double") for n in vector]) if isinstance(vector, list) else vector.cast("array<double>")
        kept = [n for n in frame.columns if n != output]
        # Few distinct vectors are broadcast, many are spread over the join keys; AQE decides by size.
        return frame.select(*kept, vec.alias("vec")).join(by_vector, "vec", "left").select(*kept, output)


def fit_outliers(train: DataFrame, key: str, vector, k: int = LOF_NEIGHBOURS, contamination: float = CONTAMINATION, **knn_options) -> OutlierModel:
    """The novelty LOF of ``train``. The offset is the ``contamination`` percentile of the negative outlier factors of its rows."""
    points = as_points(train, key, vector)
    total = points.count()
    k = min(k, total - 1)
    base = cut_lineage(_distinct_points(points), "lof-base")
    own = cut_lineage(knn_join(base, base, k + 1, **knn_options), "lof-pairs")
    is_self = F.col("query_id") == F.col("base_id")
    fit_pairs = cut_lineage(_take(own.withColumn("weight", F.when(is_self, F.col("weight") - 1).otherwise(F.col("weight"))), k), "lof-fit")
    radii = fit_pairs.groupBy("query_id").agg(F.max("distance").alias("radius")).select(F.col("query_id").alias("base_id"), "radius")
    radii = cut_lineage(radii, "lof-radii")
    fitted = cut_lineage(_density(fit_pairs, radii, k), "lof-density")
    factors = _factor(fit_pairs, fitted, fitted, k)
    weighted = factors.join(base.select(F.col("id").alias("query_id"), "weight"), "query_id")
    # Each round of the percentile reads them.
    weighted = cut_lineage(weighted.select((-F.col("lof")).alias("value"), "weight"), "lof-factors")
    return OutlierModel(k, base, own, radii, fitted, _weighted_percentile(weighted, contamination), knn_options)


def local_outlier_factor(train: DataFrame, frames: list[DataFrame], key: str, vector, k: int = LOF_NEIGHBOURS, contamination: float = CONTAMINATION, output: str = "lof_score", **knn_options) -> list[DataFrame]:
    """Add the novelty LOF score, ``LOF(x) + offset``, to every frame.

    The model is fitted on ``train``; every frame, ``train`` included, is scored
    as new data. ``vector`` is an array column or a
    list of numeric columns; ``key`` must be unique within each frame.
    """
    model = fit_outliers(train, key, vector, k, contamination, **knn_options)
    return [model.score(frame, key, vector, output, frame is train) for frame in frames]


def _weighted_percentile(values: DataFrame, p: float) -> float:
    """Interpolated percentile of a (value, weight) frame."""
    long = values.select(F.lit("lof").alias("metric"), "value", "weight")
    return order_statistics(long, {"lof": [("linear", p)]})["lof"].linear(p)


@dataclass
class AnomalyModels:
    """An isolation forest and a LOF of the same training rows, which score any number of frames."""

    columns: list[str]
    nodes: DataFrame
    per_tree: int
    outliers: OutlierModel

    def score(self, frame: DataFrame, key: str) -> DataFrame:
        scored = cut_lineage(score_forest(frame, self.columns, self.nodes, self.per_tree), "forest-frame")
        return self.outliers.score(scored, key, self.columns)


def fit_anomaly_models(train: DataFrame, key: str, label: str = "target", categorical: list[str] | None = None, n_trees: int = N_TREES, neighbours: int = LOF_NEIGHBOURS) -> tuple[AnomalyModels, DataFrame]:
    """The models of ``train``, on all numeric columns but the label (ids included), and ``train`` with their scores."""
    columns = anomaly_columns(train, label, categorical)
    nodes, per_tree = fit_forest(train, key, columns, n_trees)
    nodes = cut_lineage(nodes, "forest")
    scored = cut_lineage(score_forest(train, columns, nodes, per_tree), "forest-train")
    outliers = fit_outliers(scored, key, columns, neighbours)
    return AnomalyModels(columns, nodes, per_tree, outliers), outliers.score(scored, key, columns, trained_on=True)


def add_anomaly_features(train: DataFrame, test: DataFrame, key: str, label: str = "target", categorical: list[str] | None = None, n_trees: int = N_TREES, neighbours: int = LOF_NEIGHBOURS) -> tuple[DataFrame, DataFrame]:
    """Isolation-forest and LOF scores on all numeric columns but the label (ids included)."""
    models, scored = fit_anomaly_models(train, key, label, categorical, n_trees, neighbours)
    return scored, models.score(test, key)


def anomaly_columns(df: DataFrame, label: str, categorical: list[str] | None = None) -> list[str]:
    skip = {label, *(categorical or []), "iforest_score", "lof_score"}
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]
