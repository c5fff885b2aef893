"""Topic drift: how far the words of today's topics are from a baseline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from themeloom.functions.words import WORDS_COMPARED, first_words, jaccard

# Fixed values
DRIFT_BELOW = 0.6
HIGH_BELOW = 0.4


def topic_similarities(baseline: DataFrame, current: DataFrame, n: int = WORDS_COMPARED) -> DataFrame:
    """Jaccard similarity per baseline topic from ``(topic, words)`` tables.

    A baseline topic that has gone counts 0; a topic that is new is ignored.
    """
    now = current.select("topic", F.col("words").alias("now"))
    return baseline.join(now, "topic", "left").select(
        "topic", jaccard(first_words(F.col("words"), n), first_words(F.col("now"), n)).alias("similarity")
    )


def drift_level(mean_similarity: Column) -> Column:
    return (
        F.when(mean_similarity < HIGH_BELOW, "HIGH").when(mean_similarity < DRIFT_BELOW, "MEDIUM").otherwise("LOW")
    )


def drift_summary(similarities: DataFrame) -> DataFrame:
    """One row: mean and smallest similarity, the similarity of every topic, flag and level.

    An empty baseline has mean 0 and level HIGH.
    """
    entries = F.sort_array(F.collect_list(F.struct("topic", "similarity")))
    totals = similarities.agg(
        F.coalesce(F.avg("similarity"), F.lit(0.0)).alias("mean_similarity"),
        F.coalesce(F.min("similarity"), F.lit(0.0)).alias("min_similarity"),
        F.map_from_entries(entries).alias("topic_similarities"),
    )
    return totals.withColumns({
        "has_drift": F.col("mean_similarity") < DRIFT_BELOW,
        "drift_level": drift_level(F.col("mean_similarity")),
    })


def detect_drift(
    baseline: DataFrame, current: DataFrame, timestamp: Column, baseline_timestamp: Column, n: int = WORDS_COMPARED
) -> DataFrame:
    """Drift record with both times, ready for the drift history."""
    return drift_summary(topic_similarities(baseline, current, n)).select(
        timestamp.alias("timestamp"), baseline_timestamp.alias("baseline_timestamp"),
        "mean_similarity", "min_similarity", "topic_similarities", "has_drift", "drift_level",
    )
