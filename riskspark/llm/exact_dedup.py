"""Exact duplicates by an extendible-hash index in the shared folder."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.text import ascii_lower, begin_task, bounded_batches
from riskspark.session import cut_lineage

#: The directory has at most 2^MAX_DEPTH entries, whatever the input; its histogram is all the driver sees.
MAX_DEPTH = 14
#: A bucket holds at least so many distinct hashes before it splits.
LEAST_BUCKET = 2_048


def directory(histogram: dict[int, int], capacity: int, max_depth: int = MAX_DEPTH) -> tuple[int, list[int]]:
    """Global depth and the bucket of each directory entry.

    ``histogram`` counts distinct hashes by their first ``max_depth`` bits. It starts with one bucket; an overfull
    bucket splits on its next bit, and the directory doubles when that bit lies beyond its depth.
    """
    sums = [defaultdict(int) for _ in range(max_depth + 1)]
    for prefix, n in histogram.items():
        for depth in range(max_depth + 1):
            sums[depth][prefix >> (max_depth - depth)] += n
    done, open_buckets, depth = [], [(0, 0)], 0
    while open_buckets:
        local, prefix = open_buckets.pop()
        if sums[local][prefix] > capacity and local < max_depth:
            depth = max(depth, local + 1)
            open_buckets += [(local + 1, prefix << 1 | 1), (local + 1, prefix << 1)]
        else:
            done.append((local, prefix))
    entries: list[int] = []
    for bucket, (local, _) in enumerate(done):  # in key order: a bucket owns a range of entries
        entries += [bucket] * (1 << (depth - local))
    return depth, entries


def _combine(batches):
    """Map side: equal texts of an Arrow batch become one entry with the list of their ids."""
    begin_task()
    for batch in batches:
        groups = pa.Table.from_batches([batch]).group_by(["bucket", "h", "norm"]).aggregate([("id", "list"), ("text_sha256", "min")])
        columns = [groups.column(n) for n in ("bucket", "h", "norm", "id_list", "text_sha256_min")]
        yield from pa.Table.from_arrays(columns, names=["bucket", "h", "norm", "ids", "text_sha256"]).combine_chunks().to_batches()


def _chain(batches):
    """Owner task: rows come by hash; texts of one hash form a chain, and a row gets the place of its equal bytes."""
    begin_task()
    hash_now, chain, entry = None, [], TaskContext.get().partitionId() << 36
    for batch in batches:
        places, entries = [], np.arange(entry, entry + batch.num_rows)
        entry += batch.num_rows
        for h, norm in zip(batch.column(1).to_pylist(), batch.column(2)):
            text = norm.as_buffer().to_pybytes()
            if h != hash_now:
                hash_now, chain = h, []
            if text not in chain:
                chain.append(text)
            places.append(chain.index(text))
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array(places, pa.int32()), pa.array(entries), batch.column(3), batch.column(4)],
            names=["h", "place", "entry", "ids", "text_sha256"],
        )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group texts that are equal after lower-casing A-Z: (id, keep_id, group_size, kept, text_sha256).

    The largest id of a group stays. Texts go to the buckets of an extendible-hash index; the copies within an Arrow batch
    become one entry first, so that a group of any size brings few entries. A task owns whole buckets, reads their
    key ranges in order of the hash, chains different texts of one hash and compares bytes. The index stays
    as files in the shared folder, and a group's total is an aggregate over its entries.

    A NULL text is an empty one. NULL ids rank below all others. Of several rows with the largest id of their group, and
    of a group of NULL ids only, one row is kept. Every input row, repeated or not, gets a row.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    norm = ascii_lower(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), norm.alias("norm")).withColumn("h", F.xxhash64("norm"))

    prefix = F.shiftrightunsigned("h", 64 - MAX_DEPTH).cast("int")
    counts = rows.select("h").distinct().groupBy(prefix.alias("p")).count().collect()
    histogram = {r["p"]: r["count"] for r in counts}
    capacity = max(LEAST_BUCKET, sum(histogram.values()) >> (MAX_DEPTH - 2))
    depth, entries = directory(histogram, capacity)

    at = F.shiftrightunsigned("h", 64 - depth).cast("int") if depth else F.lit(0)
    table = spark.createDataFrame(list(enumerate(entries)), "entry int, bucket int")
    addressed = rows.withColumn("entry", at).join(F.broadcast(table), "entry")
    addressed = addressed.select("bucket", "h", F.col("norm").cast("binary").alias("norm"), "id", F.sha2("norm", 256).alias("text_sha256"))

    id_type = rows.schema["id"].dataType
    fields = f"ids array<{id_type.simpleString()}>, text_sha256 string"
    combined = addressed.mapInArrow(_combine, f"bucket int, h long, norm binary, {fields}")
    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    owned = combined.repartition(owners, "bucket").sortWithinPartitions("bucket", "h")
    index = cut_lineage(owned.mapInArrow(_chain, f"h long, place int, entry long, {fields}"), "hash-index")

    largest = F.max(F.struct(F.array_max("ids").alias("id"), "entry")).alias("keep")
    totals = cut_lineage(index.groupBy("h", "place").agg(largest, F.sum(F.size("ids")).cast("long").alias("group_size")), "hash-index-totals")
    members = index.join(totals, ["h", "place"])
    first = F.coalesce(F.array_position("ids", F.col("keep.id")), F.lit(1)) - 1
    kept = (F.col("entry") == F.col("keep.entry")) & (F.col("pos") == F.col("first"))
    each = members.select("*", first.alias("first"), F.posexplode("ids").alias("pos", "id"))
    return each.select("id", F.col("keep.id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256")
