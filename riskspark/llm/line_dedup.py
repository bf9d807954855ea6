"""Dropping lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskspark.llm.text import SPACE, ascii_lower, row_key
from riskspark.session import cut_lineage


def line_keys(lines: Column, min_chars: int) -> Column:
    """Per line 128 bits of its key (stripped, A-Z lower-cased), or NULL where the key is too short to count."""
    keys = F.transform(lines, lambda x: ascii_lower(F.btrim(x, F.lit(SPACE))))
    pair = lambda k: F.struct(F.xxhash64(k).alias("a"), F.xxhash64(F.lit(7), k).alias("b"))
    return F.transform(keys, lambda k: F.when(F.char_length(k) >= min_chars, pair(k)))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Drop every line whose key occurs in at least ``min_docs`` documents.

    Returns (id, text, n_lines, n_dropped), one row per input row; other columns are left out. Lines are
    exploded and hashed, documents counted per hash with partial aggregation, and the positions of frequent
    lines taken back to their documents. Texts move once, hashes twice. A line that a third of all
    documents share is one group of counts, and AQE splits it in the join.

    A NULL text is an empty one, which is one empty line. Every row counts as a document, so that repeated
    rows count as often as they occur; a NULL id is allowed. Keys shorter than ``min_chars`` always stay.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.select("id", row_key(F.col("id"), F.col("text")).alias("key"), F.split("text", "\n", -1).alias("lines"))
    keyed = rows.select("key", line_keys(F.col("lines"), min_chars).alias("keys"))

    once = keyed.select(F.explode(F.array_distinct("keys")).alias("h")).where("h is not null").select("h.a", "h.b")
    # Stored, so that its size is known and both sides of the join are exchanges that AQE may split.
    frequent = cut_lineage(once.groupBy("a", "b").count().where(F.col("count") >= min_docs).select("a", "b"), "frequent-lines")

    every = keyed.select("key", F.posexplode("keys").alias("pos", "h")).where("h is not null").select("key", "pos", "h.a", "h.b")
    dropped = every.join(frequent, ["a", "b"], "left_semi").groupBy("key").agg(F.collect_set("pos").alias("gone"))

    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone")), lambda i: F.get("lines", i))
    return rows.join(dropped, "key", "left").select(
        "id",
        F.array_join(F.when(F.col("gone").isNull(), F.col("lines")).otherwise(kept), "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
