"""Fit topics end to end."""

from __future__ import annotations

import json

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.functions.words import OUTLIER_TOPIC, simple_label
from themeloom.operators import assign, density, membership, terms
from themeloom.operators.neighbours import knn_graph, undirected_pairs
from themeloom.operators.profile import topic_frequency
from themeloom.operators.rerank import rerank_keywords
from themeloom.operators.tokens import with_ngrams, with_tokens
from themeloom.operators.topic_ngrams import numbered, top_ngrams_and_scores, wanted_ngrams
from themeloom.operators.vectors import Encoder, attach_embeddings, axes_table, centroids, embed, fit_pca, reduce_pca
from themeloom.session import fits_one_task, materialize

NGRAMS = (1, 3)


@dataclass(frozen=True)
class Components:
    """What all fits over one corpus share; every table is written once."""

    docs: DataFrame  # doc_id, doc
    tokens: DataFrame  # doc_id, tokens
    vectors: DataFrame  # doc_id, embedding
    reduced: DataFrame  # id, embedding
    neighbours: DataFrame  # src, rank, dst, distance
    n_documents: int
    largest_size: int
    settings: dict = field(default_factory=dict)  # how texts become vectors, for serving
    axes: DataFrame | None = None  # axis, weights: how vectors become the reduced ones
    pairs: DataFrame | None = None  # u, v, d: the neighbours' pairs, each once


@dataclass(frozen=True)
class TopicModel:
    """A fitted model: tables only."""

    topics: DataFrame  # doc_id, topic, prob
    info: DataFrame  # topic, count, name, representation, representative_docs
    words: DataFrame  # topic, rank, term, weight
    centroids: DataFrame  # topic, centroid, threshold
    params: dict = field(default_factory=dict)
    density: membership.DensityModel | None = None  # absent in models described for given topics

    def probabilities(self) -> DataFrame:
        """``(doc_id, topic, prob)`` of every fitted document and topic."""
        if self.density is None:
            raise ValueError("the model was not fitted by density")
        found = membership.memberships(self.density.points, self.density.topics)
        return found.withColumnRenamed("id", "doc_id")


HASHED = "hashed"


def vector_settings(stopwords, width: int, encoder: str = HASHED) -> dict:
    """What a served model must know to turn texts into the vectors it was fitted on."""
    return {"stopwords": json.dumps(sorted(set(stopwords))), "width": int(width), "encoder": encoder}


def build_components(
    docs: DataFrame, largest_size: int, stopwords=(), embeddings: DataFrame | None = None,
    encoder: Encoder | None = None, encoder_column: str = "tokens", encoder_name: str = "own",
) -> Components:
    """Tokens, vectors, reduced vectors and neighbours of ``(doc_id, doc)``.

    ``embeddings`` brings pre-computed vectors; otherwise ``encoder`` (default: hashed projection of
    the tokens) makes them from ``encoder_column``; ``encoder_name`` is what a served model asks for then.
    The neighbour graph has ``largest_size`` ranks,
    enough for every cluster size up to that.
    """
    texts = materialize(docs.select("doc_id", "doc"), "docs")
    tokens = materialize(with_tokens(texts, "doc", stopwords), "tokens")
    if embeddings is not None:
        vectors = attach_embeddings(texts.select("doc_id"), embeddings)
    else:
        source = tokens if encoder_column == "tokens" else texts
        vectors = embed(source, encoder_column, encoder)
    vectors = materialize(vectors, "vectors")
    axes = fit_pca(vectors)
    reduced = materialize(
        reduce_pca(vectors, model=axes).select(F.col("doc_id").alias("id"), "embedding"), "reduced"
    )
    neighbours = materialize(knn_graph(reduced, largest_size), "neighbours")
    pairs = materialize(undirected_pairs(neighbours), "pairs")
    first = vectors.select(F.size("embedding")).head()
    name = encoder_name if embeddings is not None or encoder is not None else HASHED
    settings = vector_settings(stopwords, first[0] if first else 0, name)
    table = axes_table(docs.sparkSession, axes)
    return Components(texts, tokens, vectors, reduced, neighbours, texts.count(), largest_size, settings, table, pairs)


def _check_size(components: Components, min_cluster_size: int) -> None:
    if min_cluster_size > components.largest_size:
        raise ValueError(f"neighbour graph only reaches sizes up to {components.largest_size}")


def cluster_model(components: Components, min_cluster_size: int) -> membership.DensityModel:
    """Topics of one cluster size with what soft membership and inference need."""
    _check_size(components, min_cluster_size)
    tree = density.spanning_tree(components.reduced, components.neighbours, min_cluster_size, pairs=components.pairs)
    found = density.cluster_trees(components.reduced, tree, min_cluster_size)
    model = membership.density_model(components.reduced, found, density.cluster_numbers(found.clusters), min_cluster_size)
    return replace(model, axes=components.axes)


def cluster(components: Components, min_cluster_size: int) -> DataFrame:
    """``(doc_id, topic)`` for one cluster size."""
    _check_size(components, min_cluster_size)
    found = density.density_clusters(components.reduced, min_cluster_size, components.neighbours, pairs=components.pairs)
    return found.select(F.col("id").alias("doc_id"), "topic")


def topic_weights(tokens: DataFrame, topics: DataFrame, ngrams: tuple[int, int] = NGRAMS) -> DataFrame:
    """Class TF-IDF of the n-grams of each topic: ``(topic, term, tf, weight)``."""
    grams = with_ngrams(tokens.join(topics, "doc_id"), *ngrams, keep=("doc_id", "topic"))
    return terms.ctfidf(terms.class_tf(grams))


def describe_topics(
    components: Components, topics: DataFrame, labels: DataFrame | None = None,
    ngrams: tuple[int, int] = NGRAMS, rerank: bool = True,
) -> TopicModel:
    """Words, names, representative documents and centroids of given topics ``(doc_id, topic)``.

    ``labels(topic, label)`` replaces the simple labels.
    """
    placed_tokens = materialize(numbered(components.tokens.join(topics, "doc_id")), "topic-tokens")
    kept = terms.RERANK_CANDIDATES if rerank else terms.WORDS_PER_TOPIC
    ranked, scores = top_ngrams_and_scores(placed_tokens, ngrams, kept)
    representative = materialize(terms.representative_docs(scores), "representative")
    if rerank:
        candidates = materialize(ranked, "candidates")
        wanted = candidates.select("term").distinct()
        if fits_one_task(wanted):
            grams = wanted_ngrams(placed_tokens, [r["term"] for r in wanted.collect()])
        else:
            grams = with_ngrams(placed_tokens, *ngrams)  # several times the tokens, so not written
        ranked = rerank_keywords(candidates, grams, components.vectors, representative)
    words = materialize(ranked, "words")
    texts = representative.join(components.docs, "doc_id")
    docs_by_topic = texts.groupBy("topic").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "doc"))), lambda d: d["doc"]).alias("docs")
    )
    by_topic = terms.words_by_topic(words)
    frequency = topic_frequency(topics)
    if labels is None:
        labels = frequency.join(by_topic, "topic", "left").select(
            "topic",
            simple_label(F.col("topic"), F.coalesce("words", F.array().cast("array<string>"))).alias("label"),
        )
    info = materialize(terms.topic_info(frequency, by_topic, docs_by_topic, labels), "info")
    placed = topics.join(components.vectors, "doc_id")
    centres = materialize(centroids(placed.filter(F.col("topic") != OUTLIER_TOPIC)).drop("n"), "centroids")
    own = materialize(assign.own_topic_similarity(placed, centres), "similarity")
    cuts = assign.topic_thresholds(own)
    members = topics.join(own.select("doc_id", "similarity"), "doc_id", "left").select(
        "doc_id", "topic", F.coalesce("similarity", F.lit(0.0)).alias("prob")
    )
    settings = {**components.settings, "ngrams": json.dumps(ngrams)}
    return TopicModel(members, info, words, materialize(centres.join(cuts, "topic"), "centroids"), settings)


def fit_topics(
    docs: DataFrame, min_cluster_size: int, embeddings: DataFrame | None = None,
    components: Components | None = None, labels: DataFrame | None = None, stopwords=(),
    ngrams: tuple[int, int] = NGRAMS,
) -> TopicModel:
    """Fit a topic model over ``(doc_id, doc)``.

    Without ``components`` everything is computed; with the components of a tuning run they are
    reused and only the clustering and the descriptions are new. ``prob`` of ``topics`` is the share of the topic's peak
    density that a document has, 0 for outliers; ``probabilities()`` gives all topics.
    """
    parts = components or build_components(docs, min_cluster_size, stopwords, embeddings)
    found = cluster_model(parts, min_cluster_size)
    topics = found.points.select(F.col("id").alias("doc_id"), "topic")
    model = describe_topics(parts, topics, labels, ngrams)
    params = {**model.params, "min_cluster_size": min_cluster_size, "n_documents": parts.n_documents}
    reach = F.least(F.col("density") / F.col("peak"), F.lit(1.0))
    members = found.points.join(found.topics.select("topic", "peak"), "topic", "left").select(
        F.col("id").alias("doc_id"), "topic", F.coalesce(reach, F.lit(0.0)).alias("prob")
    )
    return replace(model, topics=members, params=params, density=found)
