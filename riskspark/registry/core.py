"""Registry of queries, their oracles, and the inputs they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riskspark import schemas
from riskspark.operators.anomaly import AnomalyModels, fit_anomaly_models
from riskspark.operators.sampling import mark_test_rows
from riskspark.operators.stats import FeatureStats, fit_offline, fit_online
from riskspark.plans.features import features_offline, features_online, paired_features
from riskspark.session import cut_lineage
from riskspark.sources import fixtures

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, its oracle."""

    def keep(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: tidy(fn(Inputs.of(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def tidy(df: DataFrame) -> DataFrame:
    """Comparable output: doubles to single precision, flags to int."""
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            col = col.cast("float").cast("double")
        elif isinstance(f.dataType, T.BooleanType):
            col = col.cast("int")
        out.append(col.alias(f.name))
    return df.select(*out)


class Inputs:
    """The input tables of one data directory; the expensive ones are stored once per session."""

    _held: dict[tuple[str, str], "Inputs"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._stored: dict[str, object] = {}
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Inputs":
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._held:
            cls._held[key] = cls(spark, sf_dir)
        return cls._held[key]

    def _once(self, name: str, make):
        if name not in self._stored:
            self._stored[name] = make()
        return self._stored[name]

    def table(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.sf_dir, name)

    @property
    def tx(self) -> DataFrame:
        return fixtures.transactions(self.spark, self.sf_dir)

    @property
    def behaviour(self) -> DataFrame:
        return self._once("behaviour", lambda: cut_lineage(fixtures.behaviour(self.spark, self.sf_dir), "behaviour"))

    @property
    def merged(self) -> DataFrame:
        return self._once("merged", lambda: cut_lineage(fixtures.training_set(self.spark, self.sf_dir, self.behaviour), "merged"))

    @property
    def predictions(self) -> DataFrame:
        return fixtures.predictions(self.spark, self.sf_dir)

    @property
    def online_stats(self) -> FeatureStats:
        return self._once("online_stats", lambda: fit_online(self.tx, self.behaviour))

    @property
    def split(self) -> DataFrame:
        """The merged set with its ``is_test`` flag."""
        return self._once("split", lambda: cut_lineage(mark_test_rows(self.merged, "target", "docno"), "split"))

    @property
    def train(self) -> DataFrame:
        return self.split.where(~F.col("is_test")).drop("is_test")

    @property
    def test(self) -> DataFrame:
        return self.split.where("is_test").drop("is_test")

    @property
    def offline_stats(self) -> FeatureStats:
        return self._once("offline_stats", lambda: fit_offline(self.train))

    def online(self, keep: list[str] | None = None) -> DataFrame:
        return features_online(self.tx, self.behaviour, self.online_stats, keep)

    def offline(self, df: DataFrame | None = None) -> DataFrame:
        return features_offline(self.merged if df is None else df, self.offline_stats)

    @property
    def paired_table(self) -> DataFrame:
        """Both profiles of every transaction; offline statistics from the train rows."""
        make = lambda: cut_lineage(paired_features(self.merged, self.online_stats, self.offline_stats), "paired")
        return self._once("paired_table", make)

    @property
    def online_table(self) -> DataFrame:
        return self.paired_table.select("cst_dim_id", "transdate", "online.*")

    @property
    def offline_table(self) -> DataFrame:
        return self.paired_table.drop("online")

    @property
    def train_features(self) -> DataFrame:
        return self._once("train_features", lambda: cut_lineage(self.offline(self.train), "train-features"))

    @property
    def test_features(self) -> DataFrame:
        return self._once("test_features", lambda: cut_lineage(self.offline(self.test), "test-features"))

    @property
    def anomaly_models(self) -> tuple[AnomalyModels, DataFrame]:
        """Anomaly models fitted on the train rows, and those rows with their scores."""
        return self._once("anomaly_models", lambda: fit_anomaly_models(self.train_features, "docno", "target", schemas.CATEGORICAL_FEATURES))

    def with_anomaly_scores(self, frame: DataFrame) -> DataFrame:
        """``frame`` with the scores of anomaly models that are fitted on the train rows."""
        # The scores need a key of their own: scenarios share document numbers.
        numbered = cut_lineage(frame.withColumn("_k", F.monotonically_increasing_id()), "anomaly-frame")
        return self.anomaly_models[0].score(numbered, "_k").drop("_k")

    @property
    def model_frames(self) -> tuple[DataFrame, DataFrame]:
        """Train and test features as models see them: with anomaly scores instead of the catalogue's constants."""

        def make() -> tuple[DataFrame, DataFrame]:
            models, train = self.anomaly_models
            return tuple(cut_lineage(df, "model-frame") for df in (train, models.score(self.test_features, "docno")))

        return self._once("model_frames", make)
