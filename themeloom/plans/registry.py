"""Versions and stages of models, kept as tables under one root folder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from themeloom.operators.membership import DensityModel
from themeloom.plans.fit import TopicModel
from themeloom.sources.documents import write_table
from themeloom.sources.logs import append, create_if_absent, read_log

# Fixed values
MODEL_NAME = "topic-model"
PRODUCTION, STAGING = "Production", "Staging"
VERSION_SCHEMA = (
    "model_name string, version int, created_at timestamp, "
    "params map<string,string>, metrics map<string,double>"
)
STAGE_SCHEMA = "model_name string, version int, stage string, ts timestamp"
MODEL_TABLES = ("info", "words", "centroids")
DENSITY_TABLES = ("points", "topics", "axes")  # of models fitted by density
INFERENCE, BY_DENSITY = "inference", "density"


def next_version(versions: DataFrame, name: str) -> int:
    found = versions.filter(F.col("model_name") == name).agg(F.coalesce(F.max("version"), F.lit(0)) + 1)
    return found.head()[0]


def current_stages(events: DataFrame) -> DataFrame:
    """The stage each version is in now: its latest event."""
    latest = events.groupBy("model_name", "version").agg(
        F.max(F.struct("ts", "stage")).alias("last")
    )
    return latest.select("model_name", "version", F.col("last.stage").alias("stage"), F.col("last.ts").alias("ts"))


def resolve_versions(versions: DataFrame, events: DataFrame, stage: str) -> DataFrame:
    """Version to use per model: the newest one in ``stage``, else the newest of all."""
    staged = current_stages(events).filter(F.col("stage") == stage).groupBy("model_name").agg(
        F.max("version").alias("staged")
    )
    newest = versions.groupBy("model_name").agg(F.max("version").alias("newest"))
    return newest.join(staged, "model_name", "left").select(
        "model_name", F.coalesce("staged", "newest").alias("version")
    )


@dataclass(frozen=True)
class Registry:
    """A model registry in a shared folder."""

    spark: SparkSession
    root: str

    def versions(self) -> DataFrame:
        return read_log(self.spark, f"{self.root}/model_versions", VERSION_SCHEMA)

    def stage_events(self) -> DataFrame:
        return read_log(self.spark, f"{self.root}/stage_events", STAGE_SCHEMA)

    def _tables(self, name: str, version: int) -> str:
        return f"{self.root}/models/{name}/version={version}"

    def _claim(self, name: str) -> int:
        """The next version that nobody else has: whoever creates its empty file first."""
        version = next_version(self.versions(), name)
        while not create_if_absent(self.spark, f"{self.root}/claims/{name}/version={version}"):
            version += 1
        return version

    def register(self, model: TopicModel, score: float, name: str = MODEL_NAME, params: dict | None = None) -> int:
        """Store the tables of a model and its row; returns the new version number."""
        version = self._claim(name)
        for table in MODEL_TABLES:
            write_table(getattr(model, table), f"{self._tables(name, version)}/{table}")
        settings = {**model.params, "n_topics": model.info.count(), **(params or {})}
        if model.density is not None:
            for table in DENSITY_TABLES:
                write_table(getattr(model.density, table), f"{self._tables(name, version)}/density_{table}")
            settings[INFERENCE] = BY_DENSITY
        row = self.spark.createDataFrame(
            [(name, version, {k: str(v) for k, v in settings.items()}, {"coherence_score": float(score)})],
            "model_name string, version int, params map<string,string>, metrics map<string,double>",
        ).select("model_name", "version", F.current_timestamp().alias("created_at"), "params", "metrics")
        append(row, f"{self.root}/model_versions")
        return version

    def move_to_stage(self, version: int, stage: str, name: str = MODEL_NAME) -> None:
        row = self.spark.createDataFrame([(name, version, stage)], "model_name string, version int, stage string")
        append(row.withColumn("ts", F.current_timestamp()), f"{self.root}/stage_events")

    def resolve(self, stage: str, name: str = MODEL_NAME) -> int:
        """Version in a stage, else the latest one; a ``LookupError`` when there is none."""
        one = resolve_versions(
            self.versions().filter(F.col("model_name") == name),
            self.stage_events().filter(F.col("model_name") == name), stage,
        ).head()
        if one is None:
            raise LookupError(f"no version of {name} is registered")
        return one["version"]

    def load(self, version: int, name: str = MODEL_NAME) -> TopicModel:
        read = {t: self.spark.read.parquet(f"{self._tables(name, version)}/{t}") for t in MODEL_TABLES}
        row = self.versions().filter((F.col("model_name") == name) & (F.col("version") == version)).head()
        nobody = self.spark.createDataFrame([], "doc_id bigint, topic int, prob double")
        density = None
        if row["params"].get(INFERENCE) == BY_DENSITY:
            place = self._tables(name, version)
            density = DensityModel(*(self.spark.read.parquet(f"{place}/density_{t}") for t in DENSITY_TABLES))
        return TopicModel(nobody, read["info"], read["words"], read["centroids"], dict(row["params"]), density)
