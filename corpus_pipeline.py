"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last return the columns of
documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskspark.llm.decontaminate import decontaminate
from riskspark.llm.exact_dedup import exact_dedup
from riskspark.llm.jaccard_join import near_duplicates
from riskspark.llm.language_id import fit, in_known_language
from riskspark.llm.packing import pack
from riskspark.llm.queries import held_out, table, vocabulary_path
from riskspark.llm.text import BATCH_BYTES, ascii_lower, row_key
from riskspark.session import cut_lineage

def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    while name in docs.columns:
        name += "_"
    return name


def _keep(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the ids in ``ids``; rows without an id are kept if ``ids`` has a NULL."""
    name = _fresh(docs, "_kept_id")
    marked = ids.select(F.col("id").alias(name)).distinct()
    return docs.join(marked, F.col("doc_id").eqNullSafe(F.col(name)), "left_semi")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are in no language: a NULL text or one without a letter. Nothing else is judged, whatever the id.

    If no document has a language label, nothing can be told and all documents go.
    """
    return in_known_language(docs, fit(docs.where(~held_out())))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased, NULL as an empty one) one row with the largest id stays; NULL ids rank below all others."""
    key = _fresh(docs, "_key")
    kept = exact_dedup(docs).where("kept").select(row_key(F.col("id"), F.col("text_sha256")).alias(key))
    norm = F.sha2(ascii_lower(F.coalesce("text", F.lit(""))), 256)
    rows = docs.withColumn(key, row_key(F.col("doc_id"), norm)).join(kept, key, "left_semi")
    # Rows that share their id and their text in lower case have one key.
    return rows.dropDuplicates([key]).drop(key)


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a similarity of 0.8 over five-word shingles the one with the smallest id stays.

    Rows that share an id are one document. A NULL text or id is linked with nothing, so its row stays.
    """
    return _keep(docs, near_duplicates(docs, n=5, percent=80).where("id <=> component_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rows with a window of the benchmark, each judged by its own text, whatever its id; a NULL text has none."""
    key = _fresh(docs, "_key")
    rows = docs.withColumn(key, row_key(F.col("doc_id"), F.coalesce("text", F.lit(""))))
    found = decontaminate(rows, table(spark, sf_dir, "benchmark"), window=10, id_col=key)
    return rows.join(found.where("contaminated").select(F.col("id").alias(key)), key, "left_anti").drop(key)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their ids and a CRC of them, each a sequence of its own."""
    return pack(docs, vocabulary_path(), longest=2048, end_id=1).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("jaccard_join", near_duplicate_groups),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: No SQL gives a language model's predictions or a tokenizer's ids; the tests hold each stage against plain Python.
ORACLE_SQL = None


#: Bytes of an Arrow batch of the pipeline: what its stages leave in the JVM and the workers adds up, and a task holds several batches.
PIPELINE_BATCH_BYTES = 4 << 20


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of PIPELINE_BATCH_BYTES within; a user's own setting stands, and afterwards all is as before."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.getAll.get(name)
    if before not in (None, str(BATCH_BYTES)):
        yield
        return
    spark.conf.set(name, str(PIPELINE_BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; each result is stored in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    with _small_batches(spark):
        for name, stage in STAGES:
            docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
