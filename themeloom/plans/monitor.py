"""Monitored inference: drift, coherence and run metrics as append-only tables."""

from __future__ import annotations

import json
import time
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from themeloom.operators import coherence
from themeloom.operators.drift import detect_drift
from themeloom.operators.terms import words_by_topic
from themeloom.operators.tokens import with_tokens
from themeloom.plans.fit import TopicModel
from themeloom.plans.registry import MODEL_NAME
from themeloom.plans.train import transform
from themeloom.session import materialize
from themeloom.sources import logs


def metric_row(
    counts: DataFrame, seconds: Column, score: Column, drift_detected: Column, level: Column,
    model_name: str = MODEL_NAME, timestamp: Column | None = None,
) -> DataFrame:
    """Run metrics from a table with ``n_documents`` and ``n_topics``; a score of 0 is stored as null."""
    return counts.select(
        (timestamp if timestamp is not None else F.current_timestamp()).alias("timestamp"),
        F.col("n_documents").cast("bigint"), F.col("n_topics").cast("bigint"),
        seconds.cast("double").alias("inference_time_sec"),
        F.nullif(score.cast("double"), F.lit(0.0)).alias("coherence_score"),
        F.coalesce(drift_detected, F.lit(False)).alias("drift_detected"),
        F.coalesce(level, F.lit("LOW")).alias("drift_level"),
        F.lit(model_name).alias("model_name"),
    )


def latest_drift(history: DataFrame) -> DataFrame:
    """The newest drift record per model, of several at one time the largest; no rows without history."""
    columns = [c for c in history.columns if c != "model_name"]
    maps = {f.name for f in history.schema if f.dataType.typeName() == "map"}  # maps have no order
    order = F.struct("timestamp", *(c for c in columns if c != "timestamp" and c not in maps))
    newest = history.groupBy("model_name").agg(F.max_by(F.struct(*columns), order).alias("r"))
    return newest.select("model_name", *[F.col(f"r.{c}").alias(c) for c in columns])


@dataclass(frozen=True)
class Inference:
    status: str
    seconds: float
    topics: DataFrame | None = None
    drift: DataFrame | None = None
    metric: DataFrame | None = None
    coherence_score: float | None = None
    error_message: str | None = None


@dataclass(frozen=True)
class InferenceMonitor:
    """Runs a model on new documents against a baseline and keeps the history under ``root``.

    ``baseline`` is ``(topic, words)``.
    """

    spark: SparkSession
    root: str
    model: TopicModel
    baseline: DataFrame
    model_name: str = MODEL_NAME

    def drift_history(self) -> DataFrame:
        return logs.read_log(self.spark, f"{self.root}/drift_history", logs.DRIFT_SCHEMA)

    def coherence_trend(self) -> DataFrame:
        return logs.read_log(self.spark, f"{self.root}/coherence", logs.COHERENCE_SCHEMA).orderBy("timestamp")

    def performance_report(self) -> DataFrame:
        return logs.read_log(self.spark, f"{self.root}/performance", logs.PERFORMANCE_SCHEMA).orderBy("timestamp")

    def run_inference(self, docs: DataFrame, stopwords=None, with_coherence: bool = True) -> Inference:
        """Assign topics, compare the model's words with the baseline, score, log.

        A failure of the coherence is a warning and a missing score; any other is reported as status ``error``
        with its message and the time spent. Logs are written last, so a failed run leaves no entry.
        """
        started = time.monotonic()
        try:
            topics = materialize(transform(docs, self.model, stopwords), "inference")
            seconds = time.monotonic() - started
            words = words_by_topic(self.model.words)
            drift = materialize(
                detect_drift(self.baseline, words, F.current_timestamp(), F.current_timestamp())
                .withColumns({"batch_id": F.lit(None).cast("bigint"), "model_name": F.lit(self.model_name)}),
                "drift",
            )
            trend = self._coherence(docs, topics, stopwords) if with_coherence else None
            score = trend.head()["coherence_score"] if trend is not None else None
            counts = topics.agg(F.count("*").alias("n_documents")).withColumn(
                "n_topics", words.agg(F.count("*")).scalar()
            )
            state = drift.select(F.struct("has_drift", "drift_level")).scalar()
            metric = materialize(
                metric_row(
                    counts, F.lit(seconds), F.lit(score), state["has_drift"], state["drift_level"], self.model_name
                ),
                "metric",
            )
            logs.append(drift, f"{self.root}/drift_history")
            if trend is not None:
                logs.append(trend, f"{self.root}/coherence")
            logs.append(metric, f"{self.root}/performance")
            return Inference("success", seconds, topics, drift, metric, score)
        except Exception as error:
            return Inference("error", time.monotonic() - started, error_message=str(error))

    def _coherence(self, docs: DataFrame, topics: DataFrame, stopwords) -> DataFrame | None:
        """Coherence of the assigned topics' words on the new texts, a row; None with one topic or a failure."""
        try:
            return self._scored(docs, topics, stopwords)
        except Exception as error:  # the run goes on without a score
            warnings.warn(f"coherence could not be computed: {error}", stacklevel=2)
            return None

    def _scored(self, docs: DataFrame, topics: DataFrame, stopwords) -> DataFrame | None:
        if stopwords is None:
            stopwords = json.loads(self.model.params.get("stopwords", "[]"))
        used = topics.select("topic").distinct()
        n = used.count()
        if n < coherence.MIN_TOPICS:
            return None
        words = self.model.words.join(used, "topic", "left_semi")
        texts = materialize(with_tokens(docs, "doc", stopwords), "inference-tokens")
        per_topic = coherence.topic_coherence(texts, words)
        return materialize(
            coherence.model_coherence(per_topic, 0.0).select(
                F.current_timestamp().alias("timestamp"), "coherence_score",
                F.lit(n).cast("bigint").alias("n_topics"), F.lit(self.model_name).alias("model_name"),
            ),
            "coherence",
        )

    def dashboard(self) -> DataFrame:
        """One row per model: latest drift, drift history, coherence trend and performance report."""
        return dashboard(self.drift_history(), self.coherence_trend(), self.performance_report())


def dashboard(history: DataFrame, trend: DataFrame, report: DataFrame) -> DataFrame:
    """Monitoring tables of a model side by side; each log has one entry per run."""

    def packed(log: DataFrame, name: str) -> DataFrame:
        fields = ["timestamp"] + [
            c for c in log.columns if c not in ("timestamp", "model_name", "topic_similarities")
        ]
        return log.groupBy("model_name").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name))

    drift = packed(history, "drift_history").withColumn("latest_drift", F.element_at("drift_history", -1))
    return (
        packed(report, "performance_report")
        .join(packed(trend, "coherence_trend"), "model_name", "full")
        .join(drift, "model_name", "full")
        .select("model_name", "latest_drift", "drift_history", "coherence_trend", "performance_report")
    )
