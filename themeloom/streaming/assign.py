"""Topics for documents that arrive as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from themeloom.plans.fit import TopicModel
from themeloom.plans.train import transform
from themeloom.session import temporary_tables


def assign_stream(docs: DataFrame, model: TopicModel, stopwords=None) -> DataFrame:
    """Streaming ``(doc_id, doc)`` to ``(doc_id, topic, prob)``.

    Stateless and append-only: centroids and settings are the model's when the query starts; one join with
    the topics' thresholds, no state.
    """
    return transform(docs, model, stopwords)


def assign_stream_by_density(
    docs: DataFrame, model: TopicModel, path: str, checkpoint: str, stopwords=None, **trigger
) -> StreamingQuery:
    """Start a query that places every micro-batch of ``(doc_id, doc)`` by the nearest fitted document.

    Rows ``(doc_id, topic, prob)`` go to Parquet under ``path``, one folder per batch, so a batch that is run again
    after a failure replaces its own rows.
    """

    def place(batch: DataFrame, number: int) -> None:
        with temporary_tables(batch.sparkSession):
            transform(batch, model, stopwords).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return docs.writeStream.foreachBatch(place).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
