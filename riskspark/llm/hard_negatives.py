"""Hard-negative mining by best-first search in STR-packed R-trees."""

from __future__ import annotations

import heapq
from bisect import insort
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskspark.session import cut_lineage

#: Rows of a tile (the part of the tree that one row of the index holds), of a leaf, and children of an inner node.
TILE_ROWS, LEAF_ROWS, FANOUT = 8_192, 128, 8
#: Rows that the tiles' cuts are drawn from; cuts only steer the cost, every row is indexed.
SAMPLE_ROWS = 20_000
#: Bytes of anchors that are broadcast together.
BLOCK_BYTES = 32 << 20
_ANY = 1 << 62


def quantised(df: DataFrame, id_col: str, vector_col: str, label_col: str, shift_every: int, labels: int) -> DataFrame:
    """(id, label, v) of the rows that take part, each different row once."""
    vector = F.col(f"`{vector_col}`")
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x.cast("double")))
    rows = df.where(F.col(f"`{label_col}`").isNotNull() & vector.isNotNull() & finite)
    label, key = F.col(f"`{label_col}`").cast("long"), F.col(f"`{id_col}`")
    label = F.when(key % shift_every == 0, (label + 1) % labels).otherwise(label)
    v = F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("long"))
    return rows.select(key.cast("long").alias("id"), label.alias("label"), v.alias("v")).distinct()


def str_order(values: np.ndarray, leaf_rows: int, dims: int = 3) -> np.ndarray:
    """Sort-tile-recursive order: slices along the widest coordinate, in each slices along the next one, then leaves."""
    order = np.arange(len(values))
    if not values.shape[1]:
        return order
    widest = np.argsort(-values.std(axis=0), kind="stable")[:dims]

    def tile(part: np.ndarray, left: np.ndarray) -> np.ndarray:
        part = part[np.argsort(values[part, left[0]], kind="stable")]
        leaves = ceil(len(part) / leaf_rows)
        if len(left) == 1 or leaves <= 1:
            return part
        size = leaf_rows * ceil(leaves / ceil(leaves ** (1 / len(left))))
        return np.concatenate([tile(part[i : i + size], left[1:]) for i in range(0, len(part), size)])

    return tile(order, widest) if len(order) else order


class Cuts:
    """Slabs of the widest coordinates of a sample: the upper part of the tree, which gives every row its tile."""

    def __init__(self, sample: np.ndarray, tiles: int):
        self.axes = np.argsort(-sample.std(axis=0), kind="stable")[:2] if sample.size else np.empty(0, np.int64)
        self.slabs = ceil(tiles ** (1 / max(len(self.axes), 1)))
        self.outer, self.inner = np.empty(0), [np.empty(0)]
        if tiles > 1 and len(self.axes) == 2:
            share = np.arange(1, self.slabs) / self.slabs
            self.outer = np.quantile(sample[:, self.axes[0]], share)
            of = np.searchsorted(self.outer, sample[:, self.axes[0]], side="right")
            self.inner = [np.quantile(x, share) if len(x) else np.empty(0) for i in range(self.slabs) for x in [sample[of == i, self.axes[1]]]]

    def tile(self, values: np.ndarray) -> np.ndarray:
        if not len(self.outer):
            return np.zeros(len(values), np.int64)
        slab = np.searchsorted(self.outer, values[:, self.axes[0]], side="right")
        within = np.zeros(len(values), np.int64)
        for i in np.unique(slab):
            within[slab == i] = np.searchsorted(self.inner[i], values[slab == i, self.axes[1]], side="right")
        return slab * self.slabs + within


def _matrix(lists, dims: int) -> np.ndarray:
    """Vectors as rows of one matrix; shorter ones are filled up with zeros."""
    out = np.zeros((len(lists), dims), np.int64)
    for row, v in zip(out, lists):
        row[: len(v)] = v
    return out


class Tree:
    """The boxes of one tile: leaves are runs of rows, inner nodes runs of FANOUT nodes; bounds of all for many anchors at once."""

    def __init__(self, ids, known, labels, values: np.ndarray):
        self.ids, self.known, self.labels = np.asarray(ids, np.int64), np.asarray(known, bool), np.asarray(labels, np.int64)
        self.values = values.astype(np.float64)
        starts = np.arange(0, len(values), LEAF_ROWS)
        low, high = np.minimum.reduceat(self.values, starts, axis=0), np.maximum.reduceat(self.values, starts, axis=0)
        first, last = np.minimum.reduceat(self.labels, starts), np.maximum.reduceat(self.labels, starts)
        self.leaves, self.children = len(starts), {}
        boxes, level, number = [(low, high, first, last)], np.arange(len(starts)), len(starts)
        while len(level) > 1:
            at = np.arange(0, len(level), FANOUT)
            low, high = np.minimum.reduceat(low, at, axis=0), np.maximum.reduceat(high, at, axis=0)
            first, last = np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)
            boxes.append((low, high, first, last))
            for i in at:
                self.children[number + i // FANOUT] = level[i : i + FANOUT].tolist()
            level = np.arange(number, number + len(at))
            number += len(at)
        self.root = int(level[0])
        self.low, self.high, self.first, self.last = (np.concatenate(x) for x in zip(*boxes))

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of each anchor with any point of each box: the sum of the coordinates' intervals."""
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T


class Search:
    """Best rows of each of an anchor's score windows, over all trees that a task reads."""

    def __init__(self, anchors: list, dims: int, same: bool, k: int):
        self.ids, self.known = [r["id"] if r["id"] is not None else _ANY for r in anchors], [r["id"] is not None for r in anchors]
        self.names, self.labels = [r["a"] for r in anchors], np.array([r["label"] for r in anchors], np.int64)
        self.q = _matrix([r["v"] for r in anchors], dims).astype(np.float64)
        self.windows = [[(w["low"], w["high"]) for w in r["windows"]] for r in anchors]
        self.floor = [[max(w["low"], w["least"]) for w in r["windows"]] for r in anchors]
        self.top = [[[] for _ in w] for w in self.windows]
        self.high = [max((h for _, h in w), default=-_ANY) for w in self.windows]
        self.same, self.k = same, k

    def visit(self, tree: Tree) -> None:
        least, most = tree.bounds(self.q)
        for i, windows in enumerate(self.windows):
            if windows:
                self._anchor(i, tree, least[i].tolist(), most[i].tolist())

    def _anchor(self, i: int, tree: Tree, least: list, most: list) -> None:
        label, floor, high, q = self.labels[i], self.floor[i], self.high[i], self.q[i]

        def possible(node: int) -> bool:
            first, last = tree.first[node], tree.last[node]
            labelled = first <= label <= last if self.same else not first == label == last
            return labelled and most[node] >= min(floor) and least[node] <= high

        queue = [(-most[tree.root], tree.root)] if possible(tree.root) else []
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < min(floor):  # every box that is left is strictly below the last kept row
                break
            if node >= tree.leaves:
                for child in tree.children[node]:
                    if possible(child):
                        heapq.heappush(queue, (-most[child], child))
                continue
            rows = slice(node * LEAF_ROWS, (node + 1) * LEAF_ROWS)
            score = tree.values[rows] @ q
            ids, known = tree.ids[rows], tree.known[rows]
            fits = (tree.labels[rows] == label) == self.same
            fits &= (score >= min(floor)) & (score <= high)
            if self.same:
                fits &= (ids != self.ids[i]) | (known != self.known[i])
            if fits.any():
                self._keep(i, np.flatnonzero(fits), score, ids, known)

    def _keep(self, i: int, at: np.ndarray, score: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        for w, (_, high) in enumerate(self.windows[i]):
            mine = at[(score[at] >= self.floor[i][w]) & (score[at] <= high)]
            mine = mine[np.lexsort((ids[mine], ~known[mine], -score[mine]))][: self.k]
            top = self.top[i][w]
            for r in mine:
                insort(top, (-int(score[r]), not known[r], int(ids[r])))
            del top[self.k :]
            if len(top) == self.k:
                self.floor[i][w] = max(self.floor[i][w], -top[-1][0])

    def found(self) -> pa.RecordBatch:
        rows = [(a, w, None if unknown else i, -s) for a, tops in zip(self.names, self.top) for w, top in enumerate(tops) for s, unknown, i in top]
        columns = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate([pa.int64(), pa.int32(), pa.int64(), pa.int64()])]
        return pa.RecordBatch.from_arrays(columns, names=["a", "w", "id", "score"])


_FOUND = "a long, w int, id long, score long"


def _trees(batches, dims: int):
    for batch in batches:
        for ids, labels, blob in zip(batch.column("ids"), batch.column("labels"), batch.column("blob")):
            known = np.array([x is not None for x in ids.as_py()])
            values = np.frombuffer(blob.as_buffer(), "<i8").reshape(len(known), dims)
            yield Tree([x if x is not None else _ANY for x in ids.as_py()], known, labels.as_py(), values), values


class Index:
    """All rows in STR-packed tiles, one row of a stored table per tile."""

    def __init__(self, rows: DataFrame, anchor_every: int):
        self.spark, self.anchor_every = rows.sparkSession, anchor_every
        # One tile a batch, so that a task holds one tree at a time.
        self.rows = cut_lineage(rows, "vectors")
        facts = self.rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dims"), F.max(F.array_max(F.transform("v", F.abs))).alias("most")).first()
        self.n, self.dims = facts["n"], facts["dims"] or 0
        if self.dims * (facts["most"] or 0) ** 2 >= 1 << 53:
            raise ValueError("vectors are too long for exact scores: components must be below 2^26 / sqrt(dimensions), after scaling by 256")
        self.tiles = cut_lineage(self._packed(), "tiles")

    def _packed(self) -> DataFrame:
        dims, mix = self.dims, F.xxhash64(F.col("id"), F.col("v"))
        share = min(1.0, SAMPLE_ROWS / max(self.n, 1))
        sample = self.rows.where(F.pmod(mix, F.lit(1 << 20)) < int(share * (1 << 20))).select("v").collect()
        cuts = Cuts(_matrix([r["v"] for r in sample], dims).astype(np.float64), min(ceil(self.n / TILE_ROWS), max(len(sample) // 8, 1)))

        def placed(batches):
            for batch in batches:
                tile = cuts.tile(_matrix(batch.column("v").to_pylist(), dims).astype(np.float64))
                yield batch.append_column("tile", pa.array(tile))

        rows = cut_lineage(self.rows.mapInArrow(placed, "id long, label long, v array<long>, tile long"), "placed")
        # A tile that took in too many rows, as one with a very common vector does, is cut by a hash.
        parts = {r["tile"]: ceil(r["count"] / TILE_ROWS) for r in rows.groupBy("tile").count().collect()}
        table = self.spark.createDataFrame(list(parts.items()), "tile long, parts int")
        rows = rows.join(F.broadcast(table), "tile").withColumn("part", F.pmod(mix, F.col("parts")).cast("int"))

        def packed(frame: pd.DataFrame) -> pd.DataFrame:
            values = _matrix(frame["v"].tolist(), dims)
            labels = frame["label"].to_numpy()
            order = np.concatenate([at[str_order(values[at], LEAF_ROWS)] for label in np.unique(labels) for at in [np.flatnonzero(labels == label)]])
            ids = [None if pd.isna(x) else int(x) for x in frame["id"].astype(object).iloc[order]]
            return pd.DataFrame({"ids": [ids], "labels": [labels[order].tolist()], "blob": [values[order].astype("<i8").tobytes()]})

        ordered = rows.select("tile", "part", F.col("id").cast("string").alias("id"), "label", "v")
        return ordered.groupBy("tile", "part").applyInPandas(packed, "ids array<long>, labels array<long>, blob binary")

    def best(self, anchors: DataFrame, same: bool, k: int) -> DataFrame:
        """(a, w, id, score, rank) of the k best rows of each window of ``anchors`` (a, id, label, v, windows).

        Anchors go through all tiles in blocks of bounded size; a task keeps k rows for each window over the tiles it reads.
        """
        dims, size = self.dims, 8 * (self.dims + 16)
        blocks = max(1, ceil(anchors.count() * size / BLOCK_BYTES))
        found = None
        for block in range(blocks):
            part = anchors.where(F.pmod(F.xxhash64("a"), F.lit(blocks)) == block).collect()
            held = self.spark.sparkContext.broadcast(part)

            def run(batches):
                search = Search(held.value, dims, same, k)
                for tree, _ in _trees(batches, dims):
                    search.visit(tree)
                yield search.found()

            one = cut_lineage(self.tiles.mapInArrow(run, _FOUND), "found")
            held.destroy()
            found = one if found is None else found.unionByName(one)
        order = Window.partitionBy("a", "w").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def least(self, k: int) -> DataFrame:
        """(id, label, v, least): each anchor's k-th best score in its own tile, a lower bound of its k-th best of all."""
        dims, every = self.dims, self.anchor_every

        def run(batches):
            for tree, values in _trees(batches, dims):
                own = np.flatnonzero(tree.known & (tree.ids % every == 0))
                window = [{"low": -_ANY, "high": _ANY, "least": -_ANY}]
                mine = [{"a": int(r), "id": int(tree.ids[r]), "label": int(tree.labels[r]), "v": values[r], "windows": window} for r in own]
                search = Search(mine, dims, True, k)
                search.visit(tree)
                rows = [(m["id"], m["label"], m["v"].tolist(), f[0]) for m, f in zip(mine, search.floor)]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate([pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64()])], names=["id", "label", "v", "least"])

        padded = self.tiles.mapInArrow(run, "id long, label long, v array<long>, least long")
        return cut_lineage(padded.withColumn("a", F.monotonically_increasing_id()), "anchors")


def _window(low: Column, high: Column, least: Column) -> Column:
    return F.struct(low.cast("long").alias("low"), high.cast("long").alias("high"), least.cast("long").alias("least"))


def hard_negatives(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    anchor_every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    shift_every: int = 7,
    labels: int = 10,
) -> DataFrame:
    """For each anchor and each of its positives, the best rows of other labels inside the positive's score window.

    Components become floor(256 x); a score is the whole-number inner product. Anchors are rows whose id is divisible by
    ``anchor_every``, positives the best ``positives`` other rows of an anchor's label, negatives the best ``negatives`` rows of
    other labels with low_percent * positive_score <= 100 * negative_score <= high_percent * positive_score. Returns
    (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Rows are packed into tiles by sort-tile-recursive order; a tile is a small R-tree over runs of rows. An anchor's own
    tile gives a lower bound of its positives' scores; then blocks of anchors go through all tiles, and a best-first
    queue leaves out boxes whose interval of inner products lies outside the windows or strictly below the k-th row so far.
    The result is exact.

    Rows with a NULL label, vector or component or a component that is not finite take no part. Equal rows count as one. A row
    with the anchor's id is not an "other" row. A row with a NULL id is no anchor but may be a positive or negative, behind
    all others of its score. Shorter vectors count as filled up with zeros. Components whose scores could pass 2^53 are an error.
    """
    index = Index(quantised(vectors, id_col, vector_col, label_col, shift_every, labels), anchor_every)
    anchors = index.least(positives)
    every = _window(F.lit(-_ANY), F.lit(_ANY), F.col("least"))
    best = index.best(anchors.withColumn("windows", F.array(every)), True, positives)
    best = cut_lineage(best.select("a", (F.col("rank") - 1).alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # Whole-number bounds: the least score is rounded up, the greatest down.
    low = F.expr(f"-floor(-{low_percent}L * positive_score / 100.0BD)")
    high = F.expr(f"floor({high_percent}L * positive_score / 100.0BD)")
    # An empty window stands where the bounds exclude each other, so that windows keep their numbers.
    listed = best.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("w", _window(low, high, F.lit(-_ANY)).alias("x")))).alias("s"))
    wanted = anchors.drop("least").join(listed.select("a", F.transform("s", lambda s: s["x"]).alias("windows")), "a")
    mined = index.best(wanted, False, negatives)
    out = mined.join(best, ["a", "w"]).join(anchors.select("a", F.col("id").alias("anchor_id")), "a")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
