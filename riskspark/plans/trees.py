"""Second-order boosted trees on histograms: training, scoring, exact attributions."""

from __future__ import annotations

from dataclasses import dataclass, field
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskspark.functions.search import double_array
from riskspark.operators.target_means import apply_target_means, mean_column
from riskspark.session import bounded_batches, cut_lineage, drop_path, scratch_path

#: Bins of a feature.
BINS = 64
#: Training rows of one task: as many tasks as there are cores, if each has LEAST_ROWS, and twice as many or more where they would have over TASK_ROWS.
TASK_ROWS, LEAST_ROWS = 100_000, 75_000
#: So many times LEAST_ROWS are trained on in one task: jobs for their levels would take longer than the work.
ALONE = 4
#: Training rows of one block, which is one row of the stored table.
BLOCK_ROWS = 32_768
#: Rounds whose trees are in the held blocks only, before the margins are written anew.
CARRY = 10
_MIX, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x9E3779B97F4A7C15)


def _uniform(ids: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in [0, 1) from row ids, the same wherever a row is read."""
    x = (ids.view(np.uint64) + np.uint64(salt + 1) * _STEP) * _MIX
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)


@dataclass
class Trees:
    """Complete binary trees in heap order, one row per tree: a row goes left if its value is at most the cut, or missing."""

    feature: np.ndarray  # -1: leaf
    cut: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> "Trees":
        shape = (0, (2 << depth) - 1)
        return cls(np.empty(shape, np.int32), *(np.empty(shape) for _ in range(1)), np.empty(shape, np.int32), *(np.empty(shape) for _ in range(3)))

    def __len__(self) -> int:
        return len(self.feature)

    def parts(self) -> list[np.ndarray]:
        return [self.feature, self.cut, self.bin, self.value, self.cover, self.gain]

    def first(self, n: int) -> "Trees":
        return Trees(*(p[:n] for p in self.parts()))

    def last(self, n: int) -> "Trees":
        return Trees(*(p[len(self) - n :] for p in self.parts()))

    def plus(self, other: "Trees") -> "Trees":
        return Trees(*(np.concatenate([a, b]) for a, b in zip(self.parts(), other.parts())))

    def nodes(self, tree: int, x: np.ndarray, binned: bool) -> np.ndarray:
        """The node at which each row of ``x`` ends."""
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        limit = (self.bin if binned else self.cut)[tree]
        for _ in range((self.feature.shape[1] + 1).bit_length() - 2):
            f = self.feature[tree, at]
            inner = f >= 0
            at = np.where(inner, 2 * at + 1 + (x[rows, np.maximum(f, 0)] > limit[at]), at)
        return at

    def margin(self, x: np.ndarray, binned: bool = False) -> np.ndarray:
        out = np.zeros(len(x))
        for t in range(len(self)):
            out += self.value[t, self.nodes(t, x, binned)]
        return out


@dataclass
class TreeModel:
    """A boosted model on numeric columns and category means; its size is bounded by trees x nodes, but for the table of means."""

    numeric: list[str]
    categorical: list[str]
    trees: Trees
    base: float
    prior: float
    means: DataFrame | None = None
    losses: list[float] = field(default_factory=list)

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    def with_inputs(self, df: DataFrame, prefix: str = "") -> DataFrame:
        return apply_target_means(df, self.means, self.categorical, self.prior, prefix=prefix) if self.categorical else df

    def inputs(self, prefix: str = "") -> list[str]:
        return [*self.numeric, *[prefix + mean_column(c) for c in self.categorical]]

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.base + self.trees.margin(x)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))

    def save(self, spark: SparkSession, path: str) -> None:
        """Two tables: the nodes (with the set-up in one row) and the category means."""
        t = self.trees
        row = [self.numeric, self.categorical, self.base, self.prior, self.losses, t.feature.shape[1], *[p.ravel().tolist() for p in t.parts()]]
        schema = "numeric array<string>, categorical array<string>, base double, prior double, losses array<double>, width int"
        schema += ", feature array<int>, cut array<double>, bin array<int>, value array<double>, cover array<double>, gain array<double>"
        spark.createDataFrame([row], schema).write.parquet(f"{path}/trees")
        if self.means is not None:
            self.means.write.parquet(f"{path}/means")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TreeModel":
        r = spark.read.parquet(f"{path}/trees").first()
        shaped = [np.array(r[n], np.int32 if n in ("feature", "bin") else np.float64).reshape(-1, r["width"]) for n in ("feature", "cut", "bin", "value", "cover", "gain")]
        means = spark.read.parquet(f"{path}/means") if r["categorical"] else None
        return cls(list(r["numeric"]), list(r["categorical"]), Trees(*shaped), r["base"], r["prior"], means, list(r["losses"]))


def matrix(columns: list[pa.Array]) -> np.ndarray:
    """Rows as float64, NULL as NaN."""
    return np.column_stack([np.asarray(c.cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64) for c in columns]) if columns else np.empty((0, 0))


def doubles(names: list[str]):
    return [F.col(f"`{n}`").cast("double").alias(f"x{i}") for i, n in enumerate(names)]


# --- training ------------------------------------------------------------------------------------


@dataclass
class Boosting:
    """Set-up of a training. ``patience``: rounds without a better loss on the watched rows after which it ends."""

    rounds: int
    depth: int
    rate: float
    row_share: float = 0.9
    feature_share: float = 0.9
    penalty: float = 1.0
    least_cover: float = 1.0
    patience: int = 100
    seed: int = 42


def cuts_of(rows: DataFrame, names: list[str]) -> list[np.ndarray]:
    """At most BINS - 1 cuts of each feature, at even shares of all rows, in one aggregate."""
    share = double_array([i / BINS for i in range(1, BINS)])
    found = rows.agg(*[F.percentile_approx(F.when(~F.isnan(f"x{i}"), F.col(f"x{i}")), share, F.lit(2_000)).alias(f"q{i}") for i in range(len(names))]).first()
    return [np.unique(np.array(found[f"q{i}"] or [], np.float64)) for i in range(len(names))]


def _binned(cuts: list[np.ndarray], base: float):
    """mapInArrow function over (rid, y, w, watched, x0, ...): blocks of rows, with the features as one byte each, feature by feature."""

    def block(parts: list) -> pa.RecordBatch:
        rid, y, w, watched, bins = (np.concatenate(p, axis=-1) for p in zip(*parts))
        columns = [rid, y, w, watched, bins, np.full(len(y), base)]
        return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in columns], names=_COLUMNS)

    def run(batches):
        parts, n = [], 0
        for batch in batches:
            x = matrix(batch.columns[4:])
            bins = np.empty(x.T.shape, np.uint8)
            for f, c in enumerate(cuts):
                bins[f] = np.where(np.isnan(x[:, f]), 0, np.searchsorted(c, x[:, f], side="left"))
            parts.append((*[c.to_numpy(zero_copy_only=False) for c in batch.columns[:4]], bins))
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield block(parts)
                parts, n = [], 0
        if n:
            yield block(parts)

    return run


#: A block of training rows: arrays as bytes.
_COLUMNS = ["rid", "y", "w", "watched", "bins", "margin"]
_ROWS = ", ".join(f"{n} binary" for n in _COLUMNS)
_KINDS = [np.int64, float, float, bool, np.uint8, float]


def _block(row) -> tuple[np.ndarray, ...]:
    """rid, y, w, watched, bins (features x rows) and margin of a stored block."""
    rid, y, w, watched, bins, margin = (np.frombuffer(bytes(v), kind) for v, kind in zip(row, _KINDS))
    return rid, y, w, watched, bins.reshape(-1, len(y)), margin


def _with_margins(pending: Trees):
    """Function over a block: the block with the margins of ``pending`` added."""

    def run(block: tuple) -> tuple:
        return *block[:5], block[5] + pending.margin(block[4].T, binned=True)

    return run


def _histograms(growing: Trees | None, level: int, chosen: np.ndarray, setup: Boosting, number: int):
    """Function over a task's blocks: (feature, (task, sums)) of gradient, hessian and weight per (node of the level, bin).

    At the first level also the loss of the watched rows, as feature -1.
    """
    nodes, first = 1 << level, (1 << level) - 1

    def run(task, blocks):
        sums = np.zeros((len(chosen), 3, nodes * BINS))
        loss = np.zeros(2)
        for rid, y, w, watched, bins, margin in blocks:
            if level == 0 and watched.any():
                m, t = margin[watched], y[watched]
                loss += (w[watched] * (np.logaddexp(0, m) - t * m)).sum(), w[watched].sum()
            at = growing.nodes(0, bins.T, binned=True) - first if growing is not None else np.zeros(len(y), np.int64)
            keep = np.flatnonzero(~watched & (_uniform(rid, setup.seed * 100_003 + number) < setup.row_share) & (at >= 0))
            y, w, at = y[keep], w[keep], at[keep] * BINS
            p = 1 / (1 + np.exp(-margin[keep]))
            parts = w * (p - y), w * p * (1 - p), w
            for i, f in enumerate(chosen):
                place = at + bins[f, keep]
                for k, what in enumerate(parts):
                    sums[i, k] += np.bincount(place, weights=what, minlength=nodes * BINS)
        yield from ((int(f), (task, s.ravel())) for f, s in zip(chosen, sums))
        if level == 0:
            yield -1, (task, loss)

    return run


_SPLIT = ["gain", "left_g", "left_h", "left_c", "all_g", "all_h", "all_c"]


def best_splits(sums: np.ndarray, penalty: float, least_cover: float) -> list[tuple]:
    """For each node of (3, nodes, bins) sums the bin after which a cut gains most: (node, bin, gain, ...)."""
    left = sums.cumsum(axis=2)
    total = left[:, :, -1:]
    right = total - left
    score = lambda s: s[0] ** 2 / (s[1] + penalty)
    gain = 0.5 * (score(left) + score(right) - score(total))
    gain = np.where((left[2] >= least_cover) & (right[2] >= least_cover), gain, -1.0)
    at = gain.argmax(axis=1)
    return [(n, int(b), float(gain[n, b]), *left[:, n, b].tolist(), *total[:, n, 0].tolist()) for n, b in enumerate(at)]


def _reduced(nodes: int, penalty: float, least_cover: float):
    """Function over (feature, (task, sums)): sum of all tasks' histograms of each feature, and the best cut of each node.

    Tasks are summed in their order, so that equal features get equal sums.
    """

    def run(parts):
        tasks: dict[int, list] = {}
        for feature, part in parts:
            tasks.setdefault(feature, []).append(part)
        for feature in sorted(tasks):
            s = sum(part for _, part in sorted(tasks.pop(feature), key=lambda p: p[0]))
            found = best_splits(s.reshape(3, nodes, BINS), penalty, least_cover) if feature >= 0 else [(0, 0, *s.tolist(), *[0.0] * 5)]
            yield from (dict(zip(["feature", "node", "bin", *_SPLIT], (feature, *r))) for r in found)

    return run


class _Ensemble:
    """One boosted ensemble in the making. What grows it sees the best cut of each (feature, node) only."""

    def __init__(self, cuts: list[np.ndarray], setup: Boosting):
        self.setup, self.cuts, self.width = setup, cuts, len(cuts)
        self.trees = Trees.empty(setup.depth)

    def level(self, level: int, growing: Trees | None, chosen: np.ndarray, number: int) -> list[dict]:
        """The best cut of each chosen feature and node of a level; at the first level the loss too, as feature -1."""
        raise NotImplementedError

    def grown(self) -> None:
        """A tree has been added."""

    def round(self, number: int) -> float | None:
        """Grow a tree; the loss of the watched rows before it, None without watched rows."""
        setup = self.setup
        rng = np.random.default_rng([setup.seed, number])
        chosen = np.sort(rng.permutation(self.width)[: max(1, round(self.width * setup.feature_share))])
        size = (2 << setup.depth) - 1
        tree = Trees(np.full((1, size), -1, np.int32), np.zeros((1, size)), np.zeros((1, size), np.int32), *(np.zeros((1, size)) for _ in range(3)))
        loss = None
        for level in range(setup.depth):
            found = self.level(level, tree if level else None, chosen, number)
            best: dict[int, tuple] = {}
            for r in found:
                if r["feature"] < 0:
                    loss = r["gain"] / r["left_g"] if r["left_g"] > 0 else None
                    continue
                known = best.get(r["node"])
                if known is None or (-r["gain"], r["feature"]) < (-known["gain"], known["feature"]):
                    best[r["node"]] = r
            split = False
            for n, r in best.items():
                at = (1 << level) - 1 + n
                if level == 0:
                    tree.value[0, 0], tree.cover[0, 0] = -setup.rate * r["all_g"] / (r["all_h"] + setup.penalty), r["all_c"]
                if tree.cover[0, at] <= 0 or r["gain"] <= 1e-9 or r["bin"] >= len(self.cuts[r["feature"]]):
                    continue
                split = True
                tree.feature[0, at], tree.bin[0, at], tree.cut[0, at] = r["feature"], r["bin"], self.cuts[r["feature"]][r["bin"]]
                tree.gain[0, at], tree.value[0, at] = r["gain"], 0.0
                for child, g, h, c in ((2 * at + 1, *(r[f"left_{x}"] for x in "ghc")), (2 * at + 2, *(r[f"all_{x}"] - r[f"left_{x}"] for x in "ghc"))):
                    tree.value[0, child], tree.cover[0, child] = -setup.rate * g / (h + setup.penalty), c
            if not split:
                break
        self.trees = self.trees.plus(tree)
        return loss

    def run(self) -> tuple[Trees, list[float]]:
        """The trees up to the round of least loss on the watched rows, and the loss after each round."""
        setup, losses = self.setup, []
        for number in range(setup.rounds):
            before = self.round(number)
            if number and before is not None:
                losses.append(before)
            if losses and len(losses) - 1 - int(np.argmin(losses)) >= setup.patience:
                break
            self.grown()
        else:
            # What the last tree brought.
            if setup.rounds and (last := [r for r in self.level(0, None, np.arange(1), setup.rounds) if r["feature"] < 0 and r["left_g"] > 0]):
                losses.append(last[0]["gain"] / last[0]["left_g"])
        return (self.trees.first(int(np.argmin(losses)) + 1) if losses else self.trees), losses


class _Alone(_Ensemble):
    """Few rows: a task that has all blocks grows the trees by itself."""

    def __init__(self, blocks: list[tuple], cuts: list[np.ndarray], setup: Boosting):
        super().__init__(cuts, setup)
        self.blocks = blocks

    def level(self, level: int, growing: Trees | None, chosen: np.ndarray, number: int) -> list[dict]:
        parts = _histograms(growing, level, chosen, self.setup, number)(0, self.blocks)
        return list(_reduced(1 << level, self.setup.penalty, self.setup.least_cover)(parts))

    def grown(self) -> None:
        self.blocks = list(map(_with_margins(self.trees.last(1)), self.blocks))


class _Training(_Ensemble):
    """There is a job for every level of every tree, so blocks of rows are held by the executors between jobs, with the margins of all
    trees so far; what is lost is read again from the stored blocks.
    """

    def __init__(self, rows: DataFrame, names: list[str], cuts: list[np.ndarray], base: float, setup: Boosting):
        super().__init__(cuts, setup)
        self.spark = rows.sparkSession
        bounded_batches(self.spark)
        n, cores = rows.count(), self.spark.sparkContext.defaultParallelism
        self.alone = n <= ALONE * LEAST_ROWS
        tasks = 1 if self.alone else min(ceil(n / LEAST_ROWS), cores * ceil(n / TASK_ROWS / cores))
        self.carried, self.path, self.blocks = 0, "", None
        self._store(rows.repartition(tasks, "rid").mapInArrow(_binned(cuts, float(base)), _ROWS))

    def _store(self, df: DataFrame) -> None:
        old, path = (self.path, self.blocks), scratch_path(self.spark, "margins")
        df.write.parquet(path)
        self.path, self.stored = path, self.spark.read.schema(_ROWS).parquet(path)
        self.blocks = self.stored.rdd.map(_block)
        if not self.alone:
            self.blocks.persist(StorageLevel.MEMORY_AND_DISK)
        self.held = self.carried
        self._drop(*old)

    def _drop(self, path: str, blocks) -> None:
        if path:
            blocks.unpersist()
            drop_path(self.spark, path)

    def _carry(self) -> None:
        """Write the margins with all trees so far."""
        add, at = _with_margins(self.trees.last(len(self.trees) - self.carried)), _COLUMNS.index("margin")

        def run(batches):
            for batch in batches:
                blocks = [_block(row) for row in zip(*[[v.as_buffer() for v in c] for c in batch.columns])]
                margins = [add(b)[5].tobytes() for b in blocks]
                yield batch.set_column(at, "margin", pa.array(margins, pa.binary()))

        self.carried = len(self.trees)
        self._store(self.stored.mapInArrow(run, _ROWS))

    def grown(self) -> None:
        if len(self.trees) - self.carried >= CARRY:
            self._carry()

    def level(self, level: int, growing: Trees | None, chosen: np.ndarray, number: int) -> list[dict]:
        setup, spent = self.setup, None
        if self.held < len(self.trees):
            spent = self.blocks
            self.blocks = spent.map(_with_margins(self.trees.last(len(self.trees) - self.held))).persist(StorageLevel.MEMORY_AND_DISK)
            self.held = len(self.trees)
        local = self.blocks.mapPartitionsWithIndex(_histograms(growing, level, chosen, setup, number))
        tasks = self.blocks.getNumPartitions()
        met = local if tasks == 1 else local.partitionBy(min(tasks, len(chosen)), int)
        found = met.mapPartitions(_reduced(1 << level, setup.penalty, setup.least_cover)).collect()
        if spent is not None:
            spent.unpersist()
        return found

    def run(self) -> tuple[Trees, list[float]]:
        if self.alone:
            cuts, setup = self.cuts, self.setup

            def grow(blocks):
                trees, losses = _Alone(list(blocks), cuts, setup).run()
                yield trees.parts(), losses

            ((parts, losses),) = self.blocks.coalesce(1).mapPartitions(grow).collect()
            found = Trees(*parts), losses
        else:
            found = super().run()
        self._drop(self.path, self.blocks)
        return found


def fit_trees(rows: DataFrame, names: list[str], label: str, weight: str, watched: str, setup: Boosting) -> tuple[Trees, float, list[float]]:
    """(trees, base margin, losses). Rows are binned once; each level of a tree is one aggregate.

    A task sums gradients and hessians per (feature, node, bin); the sums meet per feature, where the best cut of every node
    is found; the driver takes the best feature of each node. Margins are carried in the held blocks, which are written
    anew every CARRY rounds. Few rows are one task, which grows all trees. Rows and features of a round are drawn by hash. No watched rows: all rounds count.
    """
    chosen = rows.select(
        F.monotonically_increasing_id().alias("rid"), F.col(label).cast("double").alias("y"), F.col(weight).cast("double").alias("w"), F.col(watched).alias("watched"), *doubles(names)
    ).where("y is not null and w is not null")
    stored = cut_lineage(chosen, "training-rows")
    total = stored.where("not watched").agg(F.sum(F.col("y") * F.col("w")).alias("y"), F.sum("w").alias("w")).first()
    if not total["w"]:
        return Trees.empty(setup.depth), 0.0, []
    share = min(max(total["y"] / total["w"], 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    training = _Training(stored, names, cuts_of(stored.where("not watched"), names), base, setup)
    trees, losses = training.run()
    return trees, base, losses


# --- attributions --------------------------------------------------------------------------------


def _paths(trees: Trees, t: int) -> list[tuple[float, dict[int, tuple[float, float, float]]]]:
    """(value, {feature: (above, up to, share of cover)}) for each leaf; shares multiply where a path asks a feature twice."""
    out, stack = [], [(0, {})]
    while stack:
        at, path = stack.pop()
        f = int(trees.feature[t, at])
        if f < 0:
            out.append((float(trees.value[t, at]), path))
            continue
        low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
        cut, cover = float(trees.cut[t, at]), trees.cover[t, at]
        for child, bounds in ((2 * at + 1, (low, min(high, cut))), (2 * at + 2, (max(low, cut), high))):
            stack.append((child, {**path, f: (*bounds, share * float(trees.cover[t, child] / cover))}))
    return out


def _shapley(shares: np.ndarray) -> np.ndarray:
    """(2^d, d): each feature's part of a leaf of value 1, for each pattern of features whose conditions a row meets.

    A feature in a coalition multiplies by 1 or 0, one outside by its share of the cover; the weights of coalitions are those of
    Shapley, summed by size.
    """
    d = len(shares)
    met = (np.arange(1 << d)[:, None] >> np.arange(d)) & 1
    out = np.zeros((1 << d, d))
    weights = np.array([1 / (d * comb(d - 1, k)) for k in range(d)])
    for f in range(d):
        sizes = np.zeros((1 << d, d))
        sizes[:, 0] = 1
        for j in range(d):
            if j != f:
                more = sizes[:, :-1] * met[:, j : j + 1]
                sizes *= shares[j]
                sizes[:, 1:] += more
        out[:, f] = (met[:, f] - shares[f]) * (sizes @ weights)
    return out


class Attribution:
    """Exact Shapley values of the margin, by the cover of the training rows. Built once in a task, applied to whole batches.

    A leaf's table of patterns is made when a batch asks for it: those of a thousand trees would take hundreds of MB.
    """

    def __init__(self, trees: Trees, width: int):
        self.width, self.leaves, self.expected = width, [], 0.0
        for t in range(len(trees)):
            for value, path in _paths(trees, t):
                names = list(path)
                shares = np.array([path[f][2] for f in names])
                self.expected += value * float(shares.prod())
                if names and value:
                    bounds = np.array([path[f][:2] for f in names])
                    self.leaves.append((names, bounds, value, shares))

    def values(self, x: np.ndarray) -> np.ndarray:
        """(rows, features); a row's sum is its margin less the expected margin."""
        x = np.where(np.isnan(x), -np.inf, x)
        out = np.zeros((len(x), self.width))
        for names, bounds, value, shares in self.leaves:
            pattern = np.zeros(len(x), np.int64)
            for j, f in enumerate(names):
                inside = (x[:, f] <= bounds[j, 1]) & ((x[:, f] > bounds[j, 0]) | (bounds[j, 0] == -np.inf))
                pattern |= inside.astype(np.int64) << j
            out[:, names] += (value * _shapley(shares))[pattern]
        return out


def attributions(model: TreeModel, df: DataFrame, key: str) -> DataFrame:
    """(key, values, expected): the exact Shapley values of each row's margin, in the order of ``model.features``; one pass, no shuffle."""
    held = df.sparkSession.sparkContext.broadcast(model.trees)
    names, base = model.inputs(), model.base
    rows = model.with_inputs(df).select(F.col(key), *doubles(names))

    def run(batches):
        parts = Attribution(held.value, len(names))
        for batch in batches:
            values = parts.values(matrix(batch.columns[1:])) if batch.num_rows else np.empty((0, len(names)))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, len(names), dtype=np.int32)), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), flat, pa.array(np.full(len(values), base + parts.expected))], names=[key, "values", "expected"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, values array<double>, expected double")


def mean_attributions(model: TreeModel, df: DataFrame, key: str) -> DataFrame:
    """(feature, mean_abs) over all rows: one row of sums per task, not one per row and feature."""
    names = model.features

    def run(batches):
        sums, n = np.zeros(len(names)), 0
        for batch in batches:
            if batch.num_rows:
                values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(names))
                sums, n = sums + np.abs(values).sum(axis=0), n + len(values)
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(sums), pa.array(np.full(len(names), n))], names=["feature", "total", "n"])

    parts = attributions(model, df, key).select("values").mapInArrow(run, "feature string, total double, n long")
    return parts.groupBy("feature").agg((F.sum("total") / F.greatest(F.sum("n"), F.lit(1))).alias("mean_abs"))
