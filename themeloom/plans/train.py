"""Baseline and tuned training, and prediction by stage."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.operators import assign, membership
from themeloom.operators.corpus import combine_docs, preprocess
from themeloom.operators.tokens import with_tokens
from themeloom.operators.vectors import VECTOR_WIDTH, Encoder, embed, hash_encoder, project
from themeloom.plans.fit import HASHED, TopicModel, build_components, fit_topics
from themeloom.plans.registry import MODEL_NAME, PRODUCTION, STAGING, Registry
from themeloom.plans.tuning import TRIALS, TuningResult, largest_trial, tune
from themeloom.session import materialize
from themeloom.sources.documents import with_doc_id, write_table

# Fixed values
BASELINE_SIZE = 15
BASELINE_SCORE = 0.5


@dataclass(frozen=True)
class Training:
    baseline: TopicModel
    baseline_version: int
    tuned: TopicModel
    tuned_version: int
    tuning: TuningResult


def _documents(df: DataFrame) -> DataFrame:
    return combine_docs(preprocess(with_doc_id(df)))


def train_blue_green(
    df: DataFrame, registry: Registry, max_trials: int | None = TRIALS, name: str = MODEL_NAME,
    stopwords=(), output_dir: str | None = None, lemmas: DataFrame | None = None,
) -> Training:
    """Fit a baseline with a fixed size for production and a tuned model for staging.

    ``df`` has ``Title`` and ``Abstract``. Both models are registered; their topic tables are also
    written under ``output_dir`` if that is given.
    """
    docs = materialize(_documents(df).select("doc_id", "doc"), "documents")
    parts = build_components(docs, max(BASELINE_SIZE, largest_trial(docs, max_trials)), stopwords)  # for both models
    baseline = fit_topics(docs, BASELINE_SIZE, components=parts, stopwords=stopwords)
    first = registry.register(baseline, BASELINE_SCORE, name)
    registry.move_to_stage(first, PRODUCTION, name)
    tuning = tune(docs, max_trials, stopwords, lemmas=lemmas, components=parts)
    tuned = fit_topics(docs, tuning.best_size, components=tuning.components, stopwords=stopwords)
    second = registry.register(tuned, tuning.best_score, name)
    registry.move_to_stage(second, STAGING, name)
    if output_dir is not None:
        write_table(baseline.info, f"{output_dir}/blue_topics", "csv")
        write_table(tuned.info, f"{output_dir}/green_topics", "csv")
    return Training(baseline, first, tuned, second, tuning)


def model_vectors(
    docs: DataFrame, model: TopicModel, stopwords=None, encoder: Encoder | None = None
) -> DataFrame:
    """``(doc_id, embedding)`` of new documents ``(doc_id, doc)`` as the model was fitted on.

    Stop words and encoder are the model's own. A model fitted on vectors of another encoder needs that
    ``encoder``, over token arrays; vectors of another width than the model's are an error.
    """
    if stopwords is None:
        stopwords = json.loads(model.params.get("stopwords", "[]"))
    width, name = int(model.params.get("width", VECTOR_WIDTH)), model.params.get("encoder", HASHED)
    if encoder is None:
        if name != HASHED:
            raise ValueError(f"the model was fitted on vectors of the encoder {name!r}: pass it")
        encoder = hash_encoder(width)
    vectors = embed(with_tokens(docs, "doc", stopwords), "tokens", encoder)
    return vectors.withColumn("embedding", F.when(F.size("embedding") == width, F.col("embedding")).otherwise(
        F.raise_error(F.lit(f"the model's vectors have {width} numbers")).cast("array<double>")
    ))


def _points(docs: DataFrame, model: TopicModel, stopwords=None, encoder: Encoder | None = None) -> DataFrame:
    """New documents as points ``(id, embedding)`` of the model's density space, written."""
    points = project(model_vectors(docs, model, stopwords, encoder), model.density.axes)
    return materialize(points.select(F.col("doc_id").cast("bigint").alias("id"), "embedding"), "points")


def transform(
    docs: DataFrame, model: TopicModel, stopwords=None, encoder: Encoder | None = None
) -> DataFrame:
    """Topics of new documents ``(doc_id, doc)``: ``(doc_id, topic, prob)``.

    A model fitted by density places them by their nearest fitted document. Streams, and models described for given
    topics, go by the nearest centroid; ``streaming.assign.assign_stream_by_density`` places streams batch by batch.
    """
    if model.density is None or docs.isStreaming:
        vectors = model_vectors(docs, model, stopwords, encoder)
        return assign.assign_topics(vectors, model.centroids, model.centroids.select("topic", "threshold"))
    found = membership.locate(_points(docs, model, stopwords, encoder), model.density)
    return found.select(F.col("id").alias("doc_id"), "topic", "prob")


def transform_probabilities(
    docs: DataFrame, model: TopicModel, stopwords=None, encoder: Encoder | None = None
) -> DataFrame:
    """``(doc_id, topic, prob)`` of new documents for every topic, from a model fitted by density."""
    if model.density is None:
        raise ValueError("the model was not fitted by density")
    points = _points(docs, model, stopwords, encoder)
    found = membership.locate(points, model.density).select("id", "anchor", "density")
    rows = membership.memberships(points.join(found, "id"), model.density.topics)
    return rows.withColumnRenamed("id", "doc_id")


def predict(
    df: DataFrame, registry: Registry, stage: str = PRODUCTION, name: str = MODEL_NAME, encoder: Encoder | None = None
) -> DataFrame:
    """Clean new documents and assign topics with the model of a stage: ``(doc_id, doc, topic, prob)``."""
    docs = materialize(_documents(df).select("doc_id", "doc"), "documents")  # cleaned and deduplicated once
    model = registry.load(registry.resolve(stage, name), name)
    return docs.join(transform(docs, model, encoder=encoder), "doc_id").select(
        "doc_id", "doc", F.col("topic"), "prob"
    )
