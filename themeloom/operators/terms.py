"""What a topic is about: class term counts, class TF-IDF, top words, representative documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from themeloom.functions.words import OUTLIER_TOPIC
from themeloom.operators.tokens import bag_of_words, token_rows
from themeloom.session import fits_one_task, materialize

# Fixed values
WORDS_PER_TOPIC = 10
DOCS_PER_TOPIC = 3
RERANK_CANDIDATES = 30


def class_tf(topic_tokens: DataFrame) -> DataFrame:
    """Term counts per topic from ``(doc_id, topic, tokens)``: ``(topic, term, tf)``."""
    rows = token_rows(topic_tokens, keep=("topic",))
    return rows.groupBy("topic", F.col("token").alias("term")).agg(F.count("*").alias("tf"))


def ctfidf(tf: DataFrame) -> DataFrame:
    """Class-based TF-IDF: ``tf / words(topic) * ln(1 + A / f(term))``.

    ``A`` is the mean number of words per topic and ``f`` the count of the term over all topics. The
    counts are read three times and written once, so that the tokens behind them are not. The term
    total is a window over the few topics of one term, so counts shuffle once by term; topic totals
    are one row per topic.
    """
    tf = materialize(tf, "class-tf")
    per_topic = materialize(tf.groupBy("topic").agg(F.sum("tf").alias("words")), "topic-words")
    mean_words = per_topic.agg(F.avg("words")).scalar()
    if fits_one_task(per_topic):  # else the counts would shuffle by topic, of which there are few
        per_topic = F.broadcast(per_topic)
    with_total = tf.withColumn("f", F.sum("tf").over(Window.partitionBy("term")))
    return with_total.join(per_topic, "topic").select(
        "topic", "term", "tf",
        (F.col("tf") / F.col("words") * F.log1p(mean_words / F.col("f"))).alias("weight"),
    )


def weighted_rows(topic_tokens: DataFrame) -> DataFrame:
    """Class TF-IDF beside the counts of every document: ``(doc_id, topic, term, n, tf, weight, first)``.

    The weights of ``ctfidf``, for those who need the rows of ``document_term_rows`` as well: these are sent by term
    once, where both totals are windows over the same sort, instead of meeting the weights in a join.
    Rows with ``first`` hold each topic and term once. The result is read more than once and written.
    """
    sizes = topic_tokens.groupBy("topic").agg(F.sum(F.size("tokens")).alias("words"))
    per_topic = materialize(sizes.filter("words > 0"), "topic-words")
    mean_words = per_topic.agg(F.avg("words")).scalar()
    totals = F.broadcast(per_topic) if fits_one_task(per_topic) else per_topic
    rows = document_term_rows(topic_tokens).withColumn("n", F.col("n").cast("int")).repartition("term")
    place = F.row_number().over(Window.partitionBy("term", "topic").orderBy("doc_id"))
    counted = (
        rows.withColumn("first", place == 1)
        .withColumn("tf", F.sum("n").over(Window.partitionBy("term", "topic")))
        .withColumn("f", F.sum("n").over(Window.partitionBy("term")))
    )
    weight = F.col("tf") / F.col("words") * F.log1p(mean_words / F.col("f"))
    return materialize(
        counted.join(totals, "topic").select("doc_id", "topic", "term", "n", "tf", weight.alias("weight"), "first"),
        "weighted-rows",
    )


def row_weights(rows: DataFrame) -> DataFrame:
    """The weights among ``weighted_rows``, as ``ctfidf`` gives them: ``(topic, term, tf, weight)``."""
    return rows.filter("first").select("topic", "term", "tf", "weight")


def top_terms(weights: DataFrame, k: int = WORDS_PER_TOPIC) -> DataFrame:
    """The ``k`` heaviest terms per topic, ties by term: ``(topic, rank, term, weight)``.

    Spark prunes to ``k`` rows per topic before the shuffle.
    """
    w = Window.partitionBy("topic").orderBy(F.desc("weight"), "term")
    return weights.select("topic", F.row_number().over(w).alias("rank"), "term", "weight").filter(
        F.col("rank") <= k
    )


def words_by_topic(ranked: DataFrame, name: str = "words") -> DataFrame:
    """Ranked terms as one array per topic; a topic has at most the ranked ``k`` rows."""
    pairs = F.sort_array(F.collect_list(F.struct("rank", "term")))
    return ranked.groupBy("topic").agg(F.transform(pairs, lambda p: p["term"]).alias(name))


def document_term_rows(topic_tokens: DataFrame) -> DataFrame:
    """``(doc_id, topic, term, n)`` without a shuffle."""
    return bag_of_words(topic_tokens, keep=("doc_id", "topic"))


def representative_scores(topic_tokens: DataFrame, weights: DataFrame) -> DataFrame:
    """Cosine between a document's term counts and its topic's term weights."""
    terms = document_term_rows(topic_tokens)
    return _scores(terms.join(weights.select("topic", "term", "weight"), ["topic", "term"]), weights)


def row_scores(rows: DataFrame) -> DataFrame:
    """``representative_scores`` of ``weighted_rows``, without a join."""
    return _scores(rows, row_weights(rows))


def _scores(scored: DataFrame, weights: DataFrame) -> DataFrame:
    topic_norm = weights.groupBy("topic").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("topic_norm"))
    return (
        scored.groupBy("doc_id", "topic")
        .agg(
            F.sum(F.col("n") * F.col("weight")).alias("product"),
            F.sqrt(F.sum(F.col("n").cast("double") * F.col("n"))).alias("doc_norm"),
        )
        .join(topic_norm, "topic")
        .select(
            "doc_id", "topic",
            (F.col("product") / (F.col("doc_norm") * F.col("topic_norm"))).alias("similarity"),
        )
    )


def representative_docs(scores: DataFrame, k: int = DOCS_PER_TOPIC, digits: int = 9) -> DataFrame:
    """The ``k`` documents closest to their topic: ``(topic, rank, doc_id, similarity)``.

    Similarities equal to ``digits`` digits are a tie and go by id.
    """
    scores = scores.withColumn("similarity", F.round("similarity", digits))
    w = Window.partitionBy("topic").orderBy(F.desc("similarity"), "doc_id")
    return scores.select(
        "topic", F.row_number().over(w).alias("rank"), "doc_id", "similarity"
    ).filter(F.col("rank") <= k)


def topic_info(
    frequency: DataFrame, words: DataFrame, representative: DataFrame, labels: DataFrame | None = None
) -> DataFrame:
    """One row per topic, outliers first: ``topic, count, name, representation, representative_docs``.

    ``words`` is ``(topic, words)``, ``representative`` ``(topic, docs)``. A label from ``labels``
    replaces the default name.
    """
    from themeloom.functions.words import default_name

    nothing = F.array().cast("array<string>")
    info = (
        frequency.join(words, "topic", "left")
        .join(representative, "topic", "left")
        .withColumn("words", F.coalesce("words", nothing))
        .withColumn("name", default_name(F.col("topic"), F.col("words")))
    )
    if labels is not None:
        info = apply_labels(info, labels)
    return info.select(
        "topic", "count", "name", F.col("words").alias("representation"),
        F.coalesce("docs", nothing).alias("representative_docs"),
    ).orderBy("topic")


def apply_labels(info: DataFrame, labels: DataFrame) -> DataFrame:
    """Take the name from ``labels(topic, label)`` where it has one."""
    return (
        info.join(labels.select("topic", "label"), "topic", "left")
        .withColumn("name", F.coalesce("label", "name"))
        .drop("label")
    )


def display_names(info: DataFrame) -> DataFrame:
    """``Topik {id}: {name}`` for every topic but the outliers."""
    return info.filter(F.col("topic") != OUTLIER_TOPIC).select(
        "topic", F.concat(F.lit("Topik "), F.col("topic").cast("string"), F.lit(": "), "name").alias("display")
    )
