"""Rendezvous hashing of records over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from riskspark.session import cut_lineage


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0, 1, ...) with the highest score ``-weight / ln(u(key, shard))``.

    A further shard only takes keys for which it scores highest, and leaves all others where they are;
    a shard's share is in proportion to its weight. A NULL key is one key.
    """
    shards = F.array(*[F.struct(F.lit(i).alias("shard"), F.lit(float(w)).alias("weight")) for i, w in enumerate(weights)])

    def score(s: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key.cast("string"), s["shard"]), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((-s["weight"] / F.log(u)).alias("score"), s["shard"].alias("shard"))

    return F.array_max(F.transform(shards, score))["shard"]


def number_within(df: DataFrame, group: str, name: str = "slot") -> DataFrame:
    """Add gapless numbers from 0 within every value of the integer column ``group``.

    Each task numbers its own rows; the counts per (group, task) give every task its first number. No group is
    gathered anywhere, so one group may hold any share of the rows. The numbered rows are stored once, which
    makes the result the same on every later read.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("_task", T.LongType()), T.StructField("_local", T.LongType())])

    def numbered(batches):
        task, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            groups = batch.column(batch.schema.get_field_index(group)).to_numpy(zero_copy_only=False)
            local = np.empty(len(groups), np.int64)
            for g in np.unique(groups):
                at = np.flatnonzero(groups == g)
                first = seen.get(int(g), 0)
                local[at] = np.arange(first, first + len(at))
                seen[int(g)] = first + len(at)
            columns = [*batch.columns, pa.array(np.full(len(groups), task, np.int64)), pa.array(local)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_task", "_local"])

    stored = cut_lineage(df.mapInArrow(numbered, schema), "numbered")
    before = Window.partitionBy(group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored.groupBy(group, "_task").agg(F.count("*").alias("_n"))
    firsts = counts.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return stored.join(firsts, [group, "_task"]).withColumn(name, F.col("_first") + F.col("_local")).drop("_task", "_local", "_first")


def shard(docs: DataFrame, weights: Sequence[float], id_col: str = "doc_id", text_col: str = "text", grown: Sequence[float] | None = None) -> DataFrame:
    """Put every row into a shard by its id alone: (id, size, text_crc32, shard, slot, grown_shard).

    ``size`` is the UTF-8 length of the text plus 16; ``grown`` are the weights of a later set of shards, by
    default one more of the mean weight, and ``grown_shard`` the shard it would give. Rows are numbered
    gaplessly within a shard. A NULL text has no bytes and the checksum 0; rows with equal or NULL ids go to one
    shard and get a slot each; an empty table gives no rows.
    """
    grown = grown or [*weights, sum(weights) / len(weights)]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    key = F.col(f"`{id_col}`")
    placed = docs.select(
        key.alias("id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        rendezvous(key, weights).alias("shard"),
        rendezvous(key, grown).alias("grown_shard"),
    )
    return number_within(placed, "shard").select("id", "size", "text_crc32", "shard", "slot", "grown_shard")
