"""Exact k-nearest-neighbour join (Euclidean, optionally with category mismatches).

A base of a checked, bounded size is broadcast, in blocks of rows near each
other: a query row first looks into the block nearest to it, then only into those
whose bounding box is within the distance found. A larger one is cut into cells by
halving a sample along its widest columns, as many as its size asks for, and
packed into blocks of bounded size with a bounding box each. Query rows of
neighbouring cells form groups of bounded size; each group is one unit of work.
It first searches the cells of its own rows, which gives each row a distance
within which its neighbours are; then the blocks whose box is within that distance
of one of its rows come to it one by one, nearest first. So a task holds one
group, one block and the neighbours found so far, whatever the number of rows.

Within a block, squared distances by a matrix product, with a bound of their
rounding error, pick the rows that may be neighbours; the distances of those
are then taken by direct differences, so the product decides nothing.

Both sides: ``id`` (bigint), ``vec`` (array<double>), ``cats`` (array<bigint>);
the base also ``weight`` (bigint), the positive number of copies of the row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from riskspark.session import bounded_batches, cut_lineage

BROADCAST_VALUES = 8_000_000  # doubles in a broadcast base (64 MB)
MAX_CELLS = 16_384
BLOCK_ROWS = 8192
#: Base rows of a cell, where that gives fewer cells than allowed, and sampled ones; query groups, where those have GROUP_ROWS to BLOCK_ROWS rows.
CELL_ROWS, SAMPLE_ROWS, GROUP_ROWS, GROUPS = 2048, 16, 256, 32
#: Rows of a block of a broadcast base, where that gives no more blocks than allowed.
BOX_ROWS, BOXES = 512, 256
_CHUNK_VALUES = 1_000_000
_ROOM = 1 + 1e-9  # for rounding, where a distance from a box rules it out
_NO_ID = np.iinfo(np.int64).max  # stands for a NULL id, last among equal distances

_PAIR_SCHEMA = "query_id long, base_id long, distance double, weight long"
_BLOCK_SCHEMA = "cell int, block long, ids binary, vec binary, cats binary, more binary, low binary, high binary"
#: More rows than this leave a task in several batches.
_OUT_ROWS = 65_536
#: Numbers of blocks of a cell.
_PARTS = 1 << 24


def as_points(df: DataFrame, key: str, vector, cats=None, weight=None, keep=()) -> DataFrame:
    """The columns the join takes; ``vector`` is an array column or a list of numeric columns."""
    vec = F.array(*[F.col(n).cast("double") for n in vector]) if isinstance(vector, list) else vector.cast("array<double>")
    codes = F.array(*[F.xxhash64(F.col(n).cast("string")) for n in cats]) if cats else F.array().cast("array<bigint>")
    return df.select(
        F.col(key).cast("bigint").alias("id"),
        vec.alias("vec"),
        codes.alias("cats"),
        (weight if weight is not None else F.lit(1)).cast("bigint").alias("weight"),
        *keep,
    )


class Neighbours:
    """The nearest base rows, among those of the blocks visited so far, of a few thousand query rows.

    A row keeps the nearest until their weights reach ``k`` (ties by id). ``edge`` is the distance beyond which it needs none.
    """

    def __init__(self, ids: np.ndarray, vec: np.ndarray, cats: np.ndarray, k: int, cat_cost: float, edge: np.ndarray | None = None):
        self.query, self.vec, self.cats, self.k, self.cost = ids, vec, cats, k, cat_cost**2
        self.edge = np.full(len(ids), np.inf) if edge is None else edge.copy()
        self.dist, self.ids = np.zeros((len(ids), k)), np.zeros((len(ids), k), np.int64)
        self.weights = np.zeros((len(ids), k), np.int64)  # 0: no neighbour at that place yet

    @np.errstate(all="ignore")
    def visit(self, rows: np.ndarray, ids: np.ndarray, vec: np.ndarray, cats: np.ndarray, weights: np.ndarray) -> None:
        """Look for neighbours of ``rows`` in a block of the base."""
        centre = vec.mean(axis=0)
        block = vec - centre
        norm = np.einsum("ij,ij->i", block, block)
        turned = -2.0 * block.T
        step = max(1, _CHUNK_VALUES // len(ids))
        for s in range(0, len(rows), step):
            part = rows[s : s + step]
            r, c = self._close(part, self.vec[part] - centre, turned, norm, cats)
            if not len(r):
                continue
            r, dist = part[r], np.empty(len(r))
            for t in range(0, len(r), small := max(1, _CHUNK_VALUES // max(1, vec.shape[1]))):
                q, b = r[t : t + small], c[t : t + small]
                diff = self.vec[q] - vec[b]
                square = np.einsum("ij,ij->i", diff, diff)
                if cats.shape[1]:
                    square += self.cost * (self.cats[q] != cats[b]).sum(axis=1)
                dist[t : t + small] = np.sqrt(square)
            use = dist <= self.edge[r]
            self._merge(r[use], dist[use], ids[c[use]], weights[c[use]])

    def _close(self, part: np.ndarray, x: np.ndarray, turned: np.ndarray, norm: np.ndarray, cats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places (in ``part``, in the block) of the pairs that may be near enough; rows that need all they get look for k by themselves."""
        own = np.einsum("ij,ij->i", x, x)
        square = x @ turned
        square += norm
        square += own[:, None]
        for j in range(cats.shape[1]):
            square += self.cost * (self.cats[part, j][:, None] != cats[:, j])
        error = (4 * len(turned) + 64) * np.finfo(float).eps * (own + norm.max() + self.cost * cats.shape[1])
        limit = self.edge[part] ** 2 * (1 + 1e-9)
        free = np.flatnonzero(np.isinf(limit))
        if len(free) and square.shape[1] > self.k:
            limit[free] = np.partition(square[free], self.k - 1, axis=1)[:, self.k - 1] + error[free]
        return np.nonzero(~(square > (limit + error)[:, None]))

    def _merge(self, rows: np.ndarray, dist: np.ndarray, ids: np.ndarray, weights: np.ndarray) -> None:
        hit = np.unique(rows)
        if not len(hit):
            return
        held = self.weights[hit] > 0
        row = np.concatenate([np.repeat(hit, held.sum(axis=1)), rows])
        dist = np.concatenate([self.dist[hit][held], dist])
        ids = np.concatenate([self.ids[hit][held], ids])
        weights = np.concatenate([self.weights[hit][held], weights])
        order = np.lexsort((ids, dist, row))
        row, dist, ids, weights = row[order], dist[order], ids[order], weights[order]
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        size = np.diff(np.append(first, len(row)))
        before = np.cumsum(weights) - weights
        before -= np.repeat(before[first], size)
        place = np.arange(len(row)) - np.repeat(first, size)
        kept = before < self.k
        self.weights[hit] = 0
        at = row[kept], place[kept]
        self.dist[at], self.ids[at], self.weights[at] = dist[kept], ids[kept], weights[kept]
        full = kept & (before + weights >= self.k)
        self.edge[row[full]] = np.minimum(self.edge[row[full]], dist[full])

    def batches(self) -> Iterator[pa.RecordBatch]:
        found = self.pairs()
        for start in range(0, found.num_rows, _OUT_ROWS):
            yield found.slice(start, _OUT_ROWS)

    def pairs(self) -> pa.RecordBatch:
        row, place = np.nonzero(self.weights > 0)
        ids = [_nullable(x) for x in (self.query[row], self.ids[row, place])]
        columns = [*ids, pa.array(self.dist[row, place]), pa.array(self.weights[row, place])]
        return pa.RecordBatch.from_arrays(columns, names=["query_id", "base_id", "distance", "weight"])


def _nullable(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, mask=ids == _NO_ID)


def _ids(column) -> np.ndarray:
    return column.fill_null(_NO_ID).to_numpy(zero_copy_only=False)


def _rows(column, kind) -> np.ndarray:
    """A list column, all of one length, as a matrix; NULL elements are NaN."""
    if column.null_count:
        raise ValueError("a point without a vector")
    if not len(column):
        return np.empty((0, 0), kind)
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def knn_join(query: DataFrame, base: DataFrame, k: int, cat_cost: float = 0.0, broadcast_values: int = BROADCAST_VALUES, pivots: int = MAX_CELLS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, base_id, distance, weight): the nearest base rows until their weights sum to ``k``.

    The last neighbour may carry the sum past ``k``. Equal distances rank by base id. A base that is not broadcast has at
    most ``pivots`` cells.
    """
    bounded_batches(query.sparkSession)
    size = base.agg(F.count("*").alias("n"), F.max(F.size("vec") + F.size("cats")).alias("d")).first()
    if size["n"] == 0 or k < 1:
        return query.sparkSession.createDataFrame([], _PAIR_SCHEMA)
    if size["n"] * (size["d"] + 2) <= broadcast_values:
        return _broadcast_join(query, base, k, cat_cost, block_rows)
    return _cell_join(query, base, k, cat_cost, size["n"], pivots, block_rows)


def _broadcast_join(query: DataFrame, base: DataFrame, k: int, cat_cost: float, block_rows: int) -> DataFrame:
    rows = base.toArrow().combine_chunks()
    ids, vec, cats, weights = (rows.column(n).combine_chunks() for n in ("id", "vec", "cats", "weight"))
    vec = _rows(vec, float)
    parts = _near_parts(vec, min(block_rows, max(BOX_ROWS, -(-len(vec) // BOXES))))
    order, ends = np.concatenate(parts), np.cumsum([len(p) for p in parts])
    boxes = np.array([vec[p].min(axis=0) for p in parts]), np.array([vec[p].max(axis=0) for p in parts])
    table = [part[order] for part in (_ids(ids), vec, _rows(cats, np.int64), weights.to_numpy(zero_copy_only=False))]
    shared = query.sparkSession.sparkContext.broadcast((table, ends, boxes))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, ends, boxes = shared.value
        blocks = [[part[end - n : end] for part in table] for end, n in zip(ends, np.diff(ends, prepend=0))]
        for batch in batches:
            if not batch.num_rows:
                continue
            found = Neighbours(_ids(batch.column(0)), _rows(batch.column(1), float), _rows(batch.column(2), np.int64), k, cat_cost)
            away = _box_distances(found.vec, *boxes)
            home = away.argmin(axis=1)
            for i, block in enumerate(blocks):
                if len(mine := np.flatnonzero(home == i)):
                    found.visit(mine, *block)
            for i, block in enumerate(blocks):
                # What cannot be compared is looked at.
                if len(near := np.flatnonzero((home != i) & ~(away[:, i] > found.edge * _ROOM))):
                    found.visit(near, *block)
            yield from found.batches()

    # The work is in the search, so few bytes are spread over all cores.
    spread = query.select("id", "vec", "cats").repartition(query.sparkSession.sparkContext.defaultParallelism)
    return spread.mapInArrow(search, _PAIR_SCHEMA)


@np.errstate(all="ignore")
def _box_distances(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The distance of each row of ``x`` from each box, which no point in the box is nearer than."""
    out = np.empty((len(x), len(low)))
    for i in range(len(low)):
        gap = np.maximum(low[i] - x, x - high[i])
        np.maximum(gap, 0.0, out=gap)
        out[:, i] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    return out


@np.errstate(all="ignore")
def _near_parts(points: np.ndarray, most: int) -> list[np.ndarray]:
    """Parts of at most ``most`` points that are mostly near each other, by halving along the widest column."""

    def halved(rows: np.ndarray) -> list[np.ndarray]:
        if len(rows) <= most:
            return [rows]
        part = points[rows]
        rows = rows[np.argsort(part[:, np.ptp(part, axis=0).argmax()], kind="stable")]
        return [*halved(rows[: len(rows) // 2]), *halved(rows[len(rows) // 2 :])]

    return halved(np.arange(len(points)))


@dataclass
class _Cells:
    """A tree of cuts, each along the widest column of its sampled points; cells are numbered so that neighbours are mostly near each other."""

    feature: np.ndarray  # -1: a cell
    cut: np.ndarray
    left: np.ndarray  # at a cell its number
    right: np.ndarray

    @classmethod
    @np.errstate(all="ignore")
    def of(cls, points: np.ndarray, cells: int) -> "_Cells":
        nodes, most, made = [], max(1, -(-len(points) // cells)), 0

        def grow(rows: np.ndarray) -> int:
            nonlocal made
            at, part = len(nodes), points[rows]
            nodes.append([-1, 0.0, 0, 0])
            spread = part.std(axis=0) if len(rows) > most else np.zeros(1)
            spread[~np.isfinite(spread)] = 0.0
            if not (spread > 0).any():
                nodes[at][2], made = made, made + 1
                return at
            f = int(spread.argmax())
            values = np.sort(part[:, f])
            below = values[values < values[len(values) // 2]]
            cut = below[-1] if len(below) else values[0]
            goes_left = part[:, f] <= cut
            if goes_left.all():
                nodes[at][2], made = made, made + 1
                return at
            nodes[at][:2] = f, float(cut)
            nodes[at][2] = grow(rows[goes_left])
            nodes[at][3] = grow(rows[~goes_left])
            return at

        grow(np.arange(len(points)))
        return cls(*(np.array(c, kind) for c, kind in zip(zip(*nodes), (np.int32, float, np.int32, np.int32))))

    def find(self, x: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(x), np.int32), np.arange(len(x))
        while (inner := self.feature[at] >= 0).any():
            beyond = x[rows, np.maximum(self.feature[at], 0)] > self.cut[at]
            at = np.where(inner, np.where(beyond, self.right[at], self.left[at]), at)
        return self.left[at]


def _pack(table: pa.Table, more: str, kind) -> list[bytes]:
    columns = [table.column(n).combine_chunks() for n in ("id", "vec", "cats", more)]
    vec, rest = _rows(columns[1], float), columns[3].to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return [part.tobytes() for part in (_ids(columns[0]), vec, _rows(columns[2], np.int64), rest, vec.min(axis=0), vec.max(axis=0))]


def _unpack(batch: pa.RecordBatch, row: int, kind) -> tuple[np.ndarray, ...]:
    """ids, vec, cats, more of a packed block or group."""
    ids, vec, cats, more = (np.frombuffer(batch.column(n)[row].as_buffer(), t) for n, t in (("ids", np.int64), ("vec", float), ("cats", np.int64), ("more", kind)))
    return ids, vec.reshape(len(ids), -1), cats.reshape(len(ids), -1), more


def _cell_join(query: DataFrame, base: DataFrame, k: int, cat_cost: float, n_base: int, pivots: int, block_rows: int) -> DataFrame:
    spark = query.sparkSession
    wanted = min(pivots, max(16, n_base // CELL_ROWS))
    parts_of = 1 << 20
    share = min(parts_of, -(-parts_of * wanted * SAMPLE_ROWS // n_base))
    sample = base.where(F.pmod(F.xxhash64("id", "vec"), F.lit(parts_of)) < share).select("vec").toArrow().column(0).combine_chunks()
    tree = spark.sparkContext.broadcast(_Cells.of(_rows(sample, float), wanted))

    def to_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = tree.value.find(_rows(batch.column(1), float))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    def celled(df: DataFrame, names: list[str], kinds: str, stage: str) -> tuple[DataFrame, dict[int, int]]:
        """The rows with their cells, and the rows of each cell."""
        numbered = df.select(*names, F.monotonically_increasing_id().alias("row"))
        stored = cut_lineage(numbered.mapInArrow(to_cell, f"{kinds}, row long, cell int"), stage)
        return stored, {r["cell"]: r["n"] for r in stored.groupBy("cell").agg(F.count("*").alias("n")).collect()}

    kinds = "id long, vec array<double>, cats array<long>"
    rows, sizes = celled(base, ["id", "vec", "cats", "weight"], f"{kinds}, weight long", "knn-base")
    parts = spark.createDataFrame([(c, -(-n // block_rows)) for c, n in sizes.items()], "cell int, parts int")

    def pack(table: pa.Table) -> pa.Table:
        cell, part = table.column("cell")[0].as_py(), table.column("part")[0].as_py()
        return _packed(cell, cell * _PARTS + part, _pack(table, "weight", np.int64))

    split = rows.join(F.broadcast(parts), "cell").withColumn("part", F.pmod("row", "parts").cast("long"))
    blocks = cut_lineage(split.groupBy("cell", "part").applyInArrow(pack, _BLOCK_SCHEMA), "knn-blocks")
    boxes = sorted(blocks.select("block", "low", "high").collect(), key=lambda r: r["block"])  # one of each block
    low, high = (np.array([np.frombuffer(r[n]) for r in boxes]) for n in ("low", "high"))
    limits = spark.sparkContext.broadcast((np.array([r["block"] for r in boxes]), low, high))

    asked, asking = celled(query, ["id", "vec", "cats"], kinds, "knn-query")
    most = min(block_rows, max(GROUP_ROWS, sum(asking.values()) // GROUPS))
    table, groups, filled = [], 0, most
    for cell, n in sorted(asking.items()):
        whole = -(-n // most)
        if whole > 1 or filled + n > most:
            groups, filled = groups + whole, 0
        table.append((cell, groups - whole, whole))
        filled = most if whole > 1 else filled + n
    if not table:
        return spark.createDataFrame([], _PAIR_SCHEMA)
    at_home = spark.createDataFrame([(cell, first + n) for cell, first, whole in table for n in range(whole)], "cell int, grp int")
    table = spark.createDataFrame(table, "cell int, first int, parts int")
    asked = asked.join(F.broadcast(table), "cell").withColumn("grp", (F.col("first") + F.pmod("row", "parts")).cast("int"))

    def pack_query(table: pa.Table) -> pa.Table:
        grp = pa.array([table.column("grp")[0].as_py()], pa.int32())
        return _packed(-1, -1, _pack(table, "cell", np.int32)).append_column("grp", grp).append_column("at", pa.array([-1.0]))

    own = asked.select("id", "vec", "cats", "cell", "grp").groupBy("grp").applyInArrow(pack_query, f"{_BLOCK_SCHEMA}, grp int, at double")
    homes = blocks.join(F.broadcast(at_home), "cell").select(*own.columns[:-1], F.lit(0.0).alias("at"))

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups with the distance within which each row's neighbours are, and the blocks that are within it."""
        numbers, low, high = limits.value

        def ended(batch: pa.RecordBatch, found: Neighbours, home: np.ndarray) -> pa.RecordBatch:
            near = np.full(len(numbers), np.inf)
            for cell in np.unique(home):
                mine = np.flatnonzero(home == cell)
                x, edge = found.vec[mine], found.edge[mine]
                hit = np.flatnonzero(~(_boxes_apart(x.min(axis=0), x.max(axis=0), low, high) > edge.max() * _ROOM))
                for i in hit:
                    away = _box_distances(x, low[i : i + 1], high[i : i + 1])[:, 0]
                    if (reached := ~(away > edge * _ROOM)).any():
                        near[i] = min(near[i], np.nan_to_num(away[reached], nan=0.0).min())
            hit = np.flatnonzero(np.isfinite(near))
            rest = [pa.array([found.edge.tobytes()]), *[pa.array([v[hit]]) for v in (numbers, near)]]
            return pa.RecordBatch.from_arrays([*[batch.column(n) for n in ("grp", "ids", "vec", "cats")], *rest], names=["grp", "ids", "vec", "cats", "more", "hits", "ats"])

        group = None
        for batch in batches:
            cells = batch.column("cell").to_pylist()
            for row, cell in enumerate(cells):
                if cell < 0:
                    if group is not None:
                        yield ended(*group)
                    ids, vec, cats, home = _unpack(batch, row, np.int32)
                    group = batch.slice(row, 1), Neighbours(ids, vec, cats, k, cat_cost), home
                elif len(mine := np.flatnonzero(group[2] == cell)):
                    group[1].visit(mine, *_unpack(batch, row, np.int64))
        if group is not None:
            yield ended(*group)

    def to_groups(df: DataFrame) -> DataFrame:
        return df.repartitionById(groups, "grp").sortWithinPartitions("grp", "at")

    schema = "grp int, ids binary, vec binary, cats binary, more binary, hits array<long>, ats array<double>"
    bounded = cut_lineage(to_groups(own.unionByName(homes)).mapInArrow(bound, schema), "knn-groups")
    visits = cut_lineage(bounded.select("grp", F.inline(F.arrays_zip(F.col("hits").alias("block"), F.col("ats").alias("at")))), "knn-visits")
    names = ["block", "ids", "vec", "cats", "more", "low", "high", "grp", "at"]
    nothing = F.lit(None).cast("binary")
    asking_rows = bounded.withColumns({"block": F.lit(-1).cast("long"), "at": F.lit(-1.0), "low": nothing, "high": nothing}).select(*names)
    sent = blocks.join(visits, "block").select(*names)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            for row, block in enumerate(batch.column("block").to_pylist()):
                if block < 0:
                    if found is not None:
                        yield from found.batches()
                    ids, vec, cats, edge = _unpack(batch, row, float)
                    found = Neighbours(ids, vec, cats, k, cat_cost, edge)
                    continue
                box = [np.frombuffer(batch.column(n)[row].as_buffer())[None] for n in ("low", "high")]
                near_enough = np.flatnonzero(~(_box_distances(found.vec, *box)[:, 0] > found.edge * _ROOM))
                if len(near_enough):
                    found.visit(near_enough, *_unpack(batch, row, np.int64))
        if found is not None:
            yield from found.batches()

    pairs = to_groups(asking_rows.unionByName(sent)).mapInArrow(search, _PAIR_SCHEMA)
    if not asked.groupBy("id").count().where("count > 1").limit(1).count():
        return pairs
    # Rows that share an id share their neighbours.
    pairs = cut_lineage(pairs, "knn-pairs")
    ranked = Window.partitionBy("query_id").orderBy("distance", "base_id")
    before = F.coalesce(F.sum("weight").over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return pairs.withColumn("_before", before).where(F.col("_before") < k).drop("_before")


def _packed(cell: int, block: int, parts: list[bytes]) -> pa.Table:
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 6]
    return pa.table([pa.array([v], t) for v, t in zip([cell, block, *parts], kinds)], names=["cell", "block", "ids", "vec", "cats", "more", "low", "high"])


@np.errstate(all="ignore")
def _boxes_apart(least: np.ndarray, most: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The distance of one box from each of many."""
    gap = np.maximum(np.maximum(low - most, least - high), 0.0)
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))
