"""One query per operator, with the columns that its contract fixes, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskspark.llm import conversations, language_model, odd_sketches
from riskspark.llm.decontaminate import decontaminate
from riskspark.llm.exact_dedup import exact_dedup
from riskspark.llm.hard_negatives import hard_negatives
from riskspark.llm.jaccard_join import near_duplicates
from riskspark.llm.language_id import fit, identify
from riskspark.llm.line_dedup import line_dedup
from riskspark.llm.packing import pack
from riskspark.llm.sharding import shard
from riskspark.llm.tokens import token_counts
from riskspark.llm.warc import round_trip

VOCABULARY = "word_bpe_49k.json"
SHARDS = 40


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return out.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, UNNEST(string_split(COALESCE(text, ''), chr(10))) AS line,
         UNNEST(RANGE(LEN(string_split(COALESCE(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT *, TRANSLATE(TRIM(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
frequent AS (
  SELECT key FROM keyed WHERE LENGTH(key) >= 1 GROUP BY key HAVING COUNT(DISTINCT doc_id) >= 10)
SELECT doc_id, COUNT(*) AS n_lines, COUNT(f.key) AS n_dropped,
       SHA256(COALESCE(STRING_AGG(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN frequent f ON k.key = f.key
GROUP BY doc_id"""


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts(table(spark, sf_dir, "documents"), vocabulary_path(), limit=2048)
    return out.withColumnRenamed("id", "doc_id")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return out.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), "contaminated"
    )


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


OP4_SQL = """
WITH rows AS (
  SELECT doc_id, TRANSLATE(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
groups AS (SELECT norm, MAX(doc_id) AS keep_id, COUNT(*) AS group_size FROM rows GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, SHA256(norm) AS text_sha256
FROM rows JOIN groups USING (norm)"""


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = round_trip(table(spark, sf_dir, "pages"), min_bytes=0)
    return out.select(
        F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to")
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack(table(spark, sf_dir, "documents"), vocabulary_path(), longest=2048, end_id=1).withColumnRenamed("id", "doc_id")
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), n=4, percent=85).withColumnRenamed("id", "doc_id")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(table(spark, sf_dir, "documents"), [1.0] * SHARDS)
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    out = identify(docs, model).withColumnRenamed("id", "doc_id")
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_model.score(docs, language_model.fit(docs)).withColumnRenamed("id", "doc_id")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    out = conversations.repair(conversations.damage(turns), turns.select(F.col("conv_id").alias("conv")))
    return out.withColumnRenamed("conv", "conv_id")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"), anchor_every=50, positives=5, negatives=3, low_percent=50, high_percent=95)


OP12_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         [FLOOR(256 * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND LEN([x FOR x IN embedding IF x IS NULL OR NOT ISFINITE(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(LIST_INNER_PRODUCT(a.q, r.q) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id % 50 = 0 AND r.vec_id IS DISTINCT FROM a.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
mined AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, n.vec_id AS negative_id, n.score AS negative_score,
         CAST(ROW_NUMBER() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM mined WHERE rank <= 3"""


def op13_minhash_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketches.near_duplicates(table(spark, sf_dir, "documents"), n=4, percent=80).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_token_counts, op3_decontamination, op4_exact_dedup, op5_warc, op6_packing, op7_jaccard_join, op8_sharding,
        op9_language_id, op10_lm_scoring, op11_conversation_repair, op12_hard_negatives, op13_minhash_odd_sketch,
    )
}
ORACLES: dict[str, str] = {"op1_line_dedup": OP1_SQL, "op4_exact_dedup": OP4_SQL, "op12_hard_negatives": OP12_SQL}
