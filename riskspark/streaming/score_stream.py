"""Structured Streaming: score arriving transactions with the batch functions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from riskspark import schemas
from riskspark.operators.decision import decision_scores, route_decision
from riskspark.operators.lookup import validate_requests
from riskspark.operators.ranking import usable_version
from riskspark.operators.stats import FeatureStats
from riskspark.plans.features import features_online
from riskspark.plans.scoring import ModelVariant, score_batch

BROADCAST_CUSTOMERS = 1_000_000
# The label is not known when a payment arrives.
REQUIRED = ["cst_dim_id", "transdate", "transdatetime", "amount", "docno", "direction"]


@dataclass
class Bundle:
    """What one configuration version scores with."""

    version: str
    stats: FeatureStats
    variants: list[ModelVariant]
    low: float = 0.5
    high: float = 0.5


@dataclass
class HotSwap:
    """Keeps the bundle in use; changes it when the version table names another usable version.

    ``versions`` reads the version table (a few rows per key), ``build`` turns a
    version into a bundle. A failing read or build leaves the previous bundle.
    """

    versions: Callable[[], DataFrame]
    build: Callable[[str, str], Bundle]
    key: str
    current: Bundle | None = None
    errors: list[str] = field(default_factory=list)

    def bundle(self) -> Bundle:
        try:
            row = usable_version(self.versions().where(F.col("key") == self.key)).first()
            if row is None or row["status"] == "error":
                raise LookupError(f"no usable version for {self.key!r}")
            if self.current is None or self.current.version != row["version_id"]:
                self.current = self.build(row["version_id"], row["body"])
        except Exception as problem:
            self.errors.append(str(problem).splitlines()[0])
            if self.current is None:
                raise
        return self.current


def read_transactions(spark: SparkSession, path: str, schema: StructType = schemas.TRANSACTIONS, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def request_key(columns: list[str]) -> Column:
    """A hash of a whole row: only a repeat that is equal in every column has the same one."""
    return F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"}))


def deduplicated(stream: DataFrame, delay: str | None = None) -> DataFrame:
    """The stream itself: every row is answered, late rows and repeats included.

    With ``delay`` repeats of a whole row that arrive within that time of each other are answered once. The state this takes is
    bounded by a watermark, which also drops rows that are later than ``delay``: set it only where such rows need no
    answer. Rows without a time count as arriving now.
    """
    if delay is None:
        return stream
    timed = stream.withColumns(
        {"event_time": F.coalesce(F.col("transdatetime").cast("timestamp"), F.current_timestamp()), "request": request_key(stream.columns)}
    )
    return timed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["request"]).drop("event_time", "request")


def score_transactions(batch: DataFrame, behaviour: DataFrame, bundle: Bundle) -> tuple[DataFrame, DataFrame]:
    """(decisions, rejects) of one batch: validate, enrich, build features, score, route.

    Both carry ``request``, the row's own hash: several rows may have one document number. Every row of the batch is in one
    of them, as often as it came. The big tables are first cut to the customers of the batch, so that a small
    batch never shuffles them.
    """
    valid, rejected = validate_requests(batch.withColumn("request", request_key(batch.columns)), REQUIRED)
    customers = valid.select("cst_dim_id").distinct()
    if customers.count() <= BROADCAST_CUSTOMERS:
        customers = F.broadcast(customers)
    stats = replace(bundle.stats, customers=bundle.stats.customers.join(customers, "cst_dim_id", "left_semi"))
    features = features_online(valid, behaviour.join(customers, "cst_dim_id", "left_semi"), stats, keep=["request"])
    scored = score_batch(features.withColumn("_who", F.struct("docno", "request")), bundle.variants, "_who").select("_who.*", "model", "role", "score", "error")
    routed = scored.withColumn(
        "decision", F.when(F.col("role") == "decision", route_decision(F.col("score"), "threshold", bundle.low, bundle.high))
    ).withColumn("config_version", F.lit(bundle.version))
    return routed, rejected


def score_stream(stream: DataFrame, behaviour: Callable[[], DataFrame], swap: HotSwap, out: str, rejects: str, checkpoint: str, once: bool = True, delay: str | None = None) -> StreamingQuery:
    """Start the scoring query.

    Each micro-batch overwrites its own ``batch_id=`` folder in both sinks, so a
    batch that is run again after a failure leaves no duplicates.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            decisions, bad = score_transactions(held, behaviour(), swap.bundle())
            decisions.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
            bad.write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")
        finally:
            held.unpersist()

    writer = deduplicated(stream, delay).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def final_decisions(spark: SparkSession, out: str) -> DataFrame:
    """The decision model's answer to every request of everything written so far; a repeated request has its first answer."""
    rows = decision_scores(spark.read.parquet(out))
    rest = [n for n in rows.columns if n not in ("request", "batch_id")]
    first = F.min_by(F.struct(*rest), F.col("batch_id"))
    return rows.groupBy("request").agg(first.alias("r")).select("request", "r.*")
