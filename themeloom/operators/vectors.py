"""Document vectors: attach, encode, reduce, centroids."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from themeloom.functions.vectors import as_doubles, dot, matrix, unit_rows

# Fixed values
VECTOR_WIDTH = 64
REDUCED_WIDTH = 5

SLICE_TOKENS = 1 << 18  # tokens whose signs are held at a time

Encoder = Callable[[pd.Series], np.ndarray]


def attach_embeddings(
    docs: DataFrame, embeddings: DataFrame, width: int | None = None, missing: str = "error"
) -> DataFrame:
    """Join pre-computed vectors ``(doc_id, embedding)`` to documents; a wrong width is an error.

    No document is lost: one without a vector is an error too, or with ``missing="zero"`` stands at the
    origin of the ``width`` dimensions, similar to nothing.
    """
    if missing not in ("error", "zero"):
        raise ValueError(f"missing is 'error' or 'zero', not {missing}")
    if missing == "zero" and width is None:
        raise ValueError("zero vectors need a width")
    vector = as_doubles(F.col("embedding"))
    if width is not None:
        vector = F.when(F.size("embedding") == width, vector).otherwise(
            F.raise_error(F.lit(f"embedding width is not {width}")).cast("array<double>")
        )
    found = docs.join(embeddings.select("doc_id", vector.alias("embedding")), "doc_id", "left")
    if missing == "zero":
        instead = F.array_repeat(F.lit(0.0), width)
    else:
        instead = F.raise_error(F.concat(F.lit("no embedding for document "), F.col("doc_id").cast("string"))).cast("array<double>")
    return found.withColumn("embedding", F.coalesce("embedding", instead))


def _term_signs(terms, width: int) -> np.ndarray:
    """+1 or -1 per term and dimension: the top bit of the matching hex digit of md5(term:block)."""
    blocks = range((width + 31) // 32)
    digests = b"".join(hashlib.md5(f"{t}:{b}".encode()).digest() for t in terms for b in blocks)
    octets = np.frombuffer(digests, dtype=np.uint8).reshape(len(terms), -1)
    digits = np.stack([octets & 0x80, octets & 0x08], axis=2).reshape(len(terms), -1)[:, :width]
    return np.where(digits > 0, 1, -1).astype(np.int8)


def hash_encoder(width: int = VECTOR_WIDTH) -> Encoder:
    """Signed random projection of term counts, by hash: no training, no vocabulary, no state.

    Signs are made once per distinct term of a batch.
    """

    def encode(token_arrays: pd.Series) -> np.ndarray:
        sizes = np.fromiter((len(t) for t in token_arrays), dtype=np.int64, count=len(token_arrays))
        out = np.zeros((len(sizes), width))
        if sizes.sum():
            codes, terms = pd.factorize(np.concatenate(token_arrays.to_numpy()))
            signs = _term_signs(terms, width)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            for at in range(0, len(codes), SLICE_TOKENS):  # a long document spans slices, its sums add up
                own = owner[at : at + SLICE_TOKENS]
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                out[own[first]] += np.add.reduceat(signs[codes[at : at + SLICE_TOKENS]], first, axis=0, dtype=np.int64)
        return unit_rows(out)

    return encode


def embed(docs: DataFrame, column: str, encoder: Encoder | None = None, keep=("doc_id",)) -> DataFrame:
    """Encode one column batch by batch: ``(doc_id, embedding)``, no shuffle.

    ``encoder`` maps a pandas Series of the column's values to a matrix with one row each; the
    default works on token arrays.
    """
    encode = encoder or hash_encoder()
    slim = docs.select(*keep, column)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.select(*keep).schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[list(keep)].copy()
            out["embedding"] = list(encode(batch[column]))
            yield out

    return slim.mapInPandas(run, f"{fields}, embedding array<double>")


def fit_pca(vectors: DataFrame, k: int = REDUCED_WIDTH) -> PCAModel | None:
    """The first ``k`` principal components, or nothing for narrower input.

    The covariance is a width x width sum over the rows; only that small matrix is solved at once.
    """
    first = vectors.select(F.size("embedding")).head()
    if first is None or first[0] <= k:
        return None
    return PCA(k=k, inputCol="features", outputCol="reduced").fit(vectors.select(array_to_vector("embedding").alias("features")))


def reduce_pca(vectors: DataFrame, k: int = REDUCED_WIDTH, keep=("doc_id",), model: PCAModel | None = None) -> DataFrame:
    """Project to the first ``k`` principal components, given or fitted here; narrower input passes through."""
    model = model or fit_pca(vectors, k)
    if model is None:
        return vectors.select(*keep, "embedding")
    table = vectors.select(*keep, array_to_vector("embedding").alias("features"))
    return model.transform(table).select(*keep, vector_to_array("reduced").alias("embedding"))


def axes_table(spark: SparkSession, model: PCAModel | None) -> DataFrame:
    """``(axis, weights)``: one row per principal component, none if vectors pass through."""
    rows = [] if model is None else [(i, [float(x) for x in w]) for i, w in enumerate(model.pc.toArray().T)]
    return spark.createDataFrame(rows, "axis int, weights array<double>")


def project(vectors: DataFrame, axes: DataFrame, keep=("doc_id",)) -> DataFrame:
    """Vectors on stored axes: what ``reduce_pca`` gave for the vectors the axes were fitted on."""
    weights = [r["weights"] for r in axes.orderBy("axis").collect()]  # one row per component
    if not weights:
        return vectors.select(*keep, "embedding")
    return vectors.select(*keep, F.array(*(dot(F.col("embedding"), F.array(*map(F.lit, w))) for w in weights)).alias("embedding"))


def centroids(topic_vectors: DataFrame) -> DataFrame:
    """Mean vector per topic, combined inside the map tasks first: ``(topic, centroid, n)``."""
    return (
        topic_vectors.select("topic", array_to_vector("embedding").alias("features"))
        .groupBy("topic")
        .agg(Summarizer.mean(F.col("features")).alias("mean"), F.count("*").alias("n"))
        .select("topic", vector_to_array("mean").alias("centroid"), "n")
    )


__all__ = [
    "attach_embeddings", "hash_encoder", "embed", "reduce_pca", "centroids", "matrix", "unit_rows",
]
