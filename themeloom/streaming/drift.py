"""Drift of the topic words of each micro-batch against a baseline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from themeloom.operators import terms
from themeloom.operators.drift import detect_drift
from themeloom.operators.tokens import with_tokens
from themeloom.plans.registry import MODEL_NAME
from themeloom.session import temporary_tables
from themeloom.sources import logs


def batch_words(docs: DataFrame, topics: DataFrame, stopwords=()) -> DataFrame:
    """Top words per topic of some documents: ``(topic, words)``."""
    tokens = with_tokens(docs, "doc", stopwords).join(topics.select("doc_id", "topic"), "doc_id")
    return terms.words_by_topic(terms.top_terms(terms.ctfidf(terms.class_tf(tokens))))


def drift_stream(
    docs: DataFrame, assign: Callable[[DataFrame], DataFrame], baseline: DataFrame, history_path: str,
    checkpoint: str, stopwords=(), model_name: str = MODEL_NAME, trigger: dict | None = None,
) -> StreamingQuery:
    """Append one drift record per micro-batch to a history partitioned by batch id.

    ``assign`` gives ``(doc_id, topic)`` for the documents of a batch. A batch that is replayed
    after a failure overwrites its own partition, so the history never holds it twice.
    """

    def record(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            with temporary_tables(batch.sparkSession):
                words = batch_words(kept, assign(kept), stopwords)
                row = detect_drift(baseline, words, F.current_timestamp(), F.current_timestamp()).withColumns(
                    {"model_name": F.lit(model_name)}
                )
                row.write.mode("overwrite").parquet(f"{history_path}/batch_id={batch_id}")
        finally:
            kept.unpersist()

    return (
        docs.writeStream.foreachBatch(record).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def read_drift_history(spark, history_path: str) -> DataFrame:
    return logs.read_log(spark, history_path, logs.DRIFT_SCHEMA)
