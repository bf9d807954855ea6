"""SMOTE-NC oversampling (Chawla et al. 2002): synthetic minority rows up to class parity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from riskspark.functions.hashing import hash_uniform
from riskspark.operators.knn import as_points, knn_join
from riskspark.operators.sampling import mark_lowest
from riskspark.session import cut_lineage

NEIGHBOURS = 5


def category_cost(minority: DataFrame, numeric: list[str]) -> float:
    """Distance of a category mismatch: the median of the minority's numeric deviations."""
    row = minority.agg(*[F.coalesce(F.stddev_pop(F.col(n).cast("double")), F.lit(0.0)).alias(n) for n in numeric]).first()
    values = sorted(row)
    half = len(values) // 2
    return values[half] if len(values) % 2 else (values[half - 1] + values[half]) / 2


def smotenc(df: DataFrame, key: str, label: str, numeric: list[str], categorical: list[str], minority=1, k: int = NEIGHBOURS, seed: int = 42, **knn_options) -> DataFrame:
    """``df`` with synthetic minority rows added (``is_synthetic``), numeric columns as double.

    A synthetic row lies between a minority row and one of its k nearest
    minority neighbours; its categories are the most frequent among all k.
    Columns that are neither numeric, categorical nor the label are NULL in it.
    Only the minority class is searched; the majority is passed through.
    """
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}
    m = sizes.get(minority, 0)
    missing = max(n for n in sizes.values()) - m
    originals = df.withColumns({n: F.col(n).cast("double") for n in numeric}).withColumn("is_synthetic", F.lit(0))
    if m < 2 or missing <= 0:
        return originals
    rare = cut_lineage(df.where(F.col(label) == minority).select(key, *numeric, *categorical), "smote-minority")
    k = min(k, m - 1)
    cost = category_cost(rare, numeric) if categorical and numeric else 0.0

    labelled = as_points(rare, key, numeric, categorical, keep=categorical)
    distinct = cut_lineage(
        labelled.groupBy("vec", "cats").agg(F.min("id").alias("id"), F.sum("weight").alias("weight"), *[F.min(c).alias(c) for c in categorical]),
        "smote-points",
    )
    pairs = knn_join(distinct, distinct, k + 1, cost, **knn_options)
    others = pairs.withColumn("weight", F.col("weight") - (F.col("query_id") == F.col("base_id")).cast("int")).where("weight > 0")
    ordered = Window.partitionBy("query_id").orderBy("distance", "base_id")
    before = F.coalesce(F.sum("weight").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # Places 0 .. k-1; a neighbour with copies fills several.
    placed = (
        others.withColumn("before", before)
        .where(F.col("before") < k)
        .select("query_id", "base_id", F.explode(F.sequence(F.col("before"), F.least(F.col("before") + F.col("weight"), F.lit(k)) - 1)).alias("place"))
    )
    around = (
        placed.join(distinct.select(F.col("id").alias("base_id"), F.col("vec").alias("near"), *categorical), "base_id")
        .groupBy("query_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("place", "near"))).alias("near"), *[F.mode(c, True).alias(c) for c in categorical])
    )
    per_vector = distinct.select("vec", "cats", F.col("id").alias("query_id")).join(around, "query_id")

    each, extra = divmod(missing, m)
    seeds = mark_lowest(rare, F.lit("minority"), {"minority": extra}, key, seed, "extra")
    counted = seeds.withColumn("copies", F.lit(each) + F.col("extra").cast("int")).where("copies > 0")
    keyed = as_points(counted, key, numeric, categorical, weight=F.col("copies")).join(per_vector, ["vec", "cats"])
    # A key that occurs several times draws the same numbers for each of its rows.
    drawn = keyed.select("*", F.explode(F.sequence(F.lit(1), F.col("weight"))).alias("copy"))
    name = F.concat(F.col("id").cast("string"), F.lit("#"), F.col("copy").cast("string"))
    place = F.floor(hash_uniform(name, f"{seed}|place") * k)
    gap = hash_uniform(name, f"{seed}|gap")
    mixed = F.zip_with("vec", F.element_at("near", place), lambda a, b: a + F.col("gap") * (b - a))
    made = drawn.withColumn("gap", gap).withColumn("mixed", mixed)
    columns = {n: F.get("mixed", F.lit(i)) for i, n in enumerate(numeric)}
    kinds = {f.name: f.dataType for f in originals.schema.fields}
    out = []
    for name_ in originals.columns:
        if name_ in columns:
            value = columns[name_]
        elif name_ in categorical:
            value = F.col(name_)
        elif name_ == label:
            value = F.lit(minority)
        elif name_ == "is_synthetic":
            value = F.lit(1)
        else:
            value = F.lit(None)
        out.append(value.cast(kinds[name_]).alias(name_))
    return originals.unionByName(made.select(*out))
