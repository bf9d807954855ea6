"""Target means of categories: ordered ones for training rows, whole ones for all other rows."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskspark.functions.hashing import hash_rank
from riskspark.session import cut_lineage

#: Rows of one block of the hash order; a category's rows of a block are summed in one task.
BLOCK_ROWS = 100_000
SMOOTHING = 10.0
_SPAN = float(16**13)


def mean_column(name: str) -> str:
    return f"{name}__mean"


def smoothed(total: Column, count: Column, prior: float, smoothing: float = SMOOTHING) -> Column:
    return (total + F.lit(smoothing * prior)) / (count + F.lit(smoothing))


def ordered_target_means(rows: DataFrame, categories: list[str], label: str, key: str, prior: float, smoothing: float = SMOOTHING, seed=42, block_rows: int | None = None) -> DataFrame:
    """``rows`` with ``<category>__mean``: the smoothed mean of the label over the category's rows before the row.

    "Before" is by a hash of ``key``, so that a row's own label never enters its value. Rows that share a key do not see each
    other. A NULL category is a category, a NULL label counts as 0, and NULL keys come first, without seeing each other.

    The hash order is cut into blocks. Per (column, category, block) there is one partial sum; sums of earlier
    blocks are carried into a block, where a running sum adds the rest. So a category that holds any share of all rows is
    summed in as many tasks as it has blocks. Rows move twice, as (row, column, category, label).
    """
    if not categories:
        return rows
    stored = cut_lineage(rows.withColumn("_rid", F.monotonically_increasing_id()), "ordered-rows")
    blocks = max(1, ceil(stored.count() / (block_rows or BLOCK_ROWS)))
    place = F.coalesce(hash_rank(F.col(f"`{key}`"), seed), F.lit(-1))
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"`{c}`").cast("string").alias("category")) for i, c in enumerate(categories)]))
    long = stored.select("_rid", place.alias("at"), F.coalesce(F.col(f"`{label}`").cast("double"), F.lit(0.0)).alias("y"), cells.alias("x"))
    long = long.select("_rid", "at", "y", "x.f", F.coalesce(F.concat(F.lit("="), "x.category"), F.lit("")).alias("category"))
    long = long.withColumn("block", F.greatest(F.floor(F.col("at") / F.lit(_SPAN) * blocks), F.lit(0)).cast("int"))

    earlier = Window.partitionBy("f", "category").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = long.groupBy("f", "category", "block").agg(F.sum("y").alias("y"), F.count("*").alias("n"))
    carried = sums.select("f", "category", "block", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"c{c}") for c in ("y", "n")])
    carried = cut_lineage(carried, "carried-sums")

    running = Window.partitionBy("f", "category", "block").orderBy("at")  # by value: with the row's peers
    peers = Window.partitionBy("f", "category", "block", "at")
    before = lambda what: F.sum(what).over(running) - F.sum(what).over(peers)
    local = long.select("_rid", "f", "category", "block", before(F.col("y")).alias("y"), before(F.lit(1)).alias("n"))
    summed = local.join(carried, ["f", "category", "block"])
    value = smoothed(F.col("y") + F.col("cy"), F.col("n") + F.col("cn"), prior, smoothing)
    wide = summed.select("_rid", "f", value.alias("v")).groupBy("_rid").agg(*[F.max(F.when(F.col("f") == i, F.col("v"))).alias(mean_column(c)) for i, c in enumerate(categories)])
    return stored.join(wide, "_rid").drop("_rid")


def fit_target_means(rows: DataFrame, categories: list[str], label: str) -> DataFrame:
    """(f, category, y, n): sums of the label and row counts per value of each column, of any number of values."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("f"), F.col(f"`{c}`").cast("string").alias("category")) for c in categories]))
    long = rows.select(F.coalesce(F.col(f"`{label}`").cast("double"), F.lit(0.0)).alias("y"), cells.alias("x"))
    return long.groupBy("x.f", F.coalesce(F.concat(F.lit("="), "x.category"), F.lit("")).alias("category")).agg(F.sum("y").alias("y"), F.count("*").alias("n"))


def apply_target_means(rows: DataFrame, means: DataFrame, categories: list[str], prior: float, smoothing: float = SMOOTHING, prefix: str = "") -> DataFrame:
    """``rows`` with ``<prefix><category>__mean`` over all fitted rows; an unseen value has the prior."""

    def one(df: DataFrame, name: str) -> DataFrame:
        table = means.where(F.col("f") == name).select(F.col("category").alias("_category"), smoothed(F.col("y"), F.col("n"), prior, smoothing).alias("_mean"))
        marked = df.withColumn("_value", F.coalesce(F.concat(F.lit("="), F.col(f"`{name}`").cast("string")), F.lit("")))
        joined = marked.join(table, F.col("_value") == F.col("_category"), "left")
        return joined.withColumn(prefix + mean_column(name), F.coalesce("_mean", F.lit(prior))).drop("_value", "_category", "_mean")

    return reduce(one, categories, rows)
