"""Exact top-k by inner product over an index of pivots and distances.

Vectors are keyed by their nearest pivot and their distance to it. The distances of a pivot's vectors are
cut into annuli, the annuli into chunks; a chunk is one row of the index. For a query q at distance d
of a pivot, a vector x of the annulus [low, high] is at least ``gap`` away, the distance of d from that
range (triangle inequality), and so

    q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2  <=  (|q|^2 + longest^2 - gap^2) / 2,

also at most |q| times the longest. A query first searches the chunk it lies in, then annuli in the order of these bounds, more with each
round, and stops when the next bound is below its k-th best score. Rounds are joins on the chunk, so
queries travel to the chunks that can still hold something for them and to no others.

Pivots are a bounded sample of the vectors; every vector is indexed and the result is exact.

Nulls and odd rows: vectors that are null or hold null or non-finite components take no part, nor do those
whose length is not the most frequent one (the smaller of two). Rows without id take no part; of several
vectors of an id the smallest counts. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from themeloom.session import materialize

K, GRID = 20, 64
MOST_PIVOTS, ANNULI = 512, 16  # of the index and of each pivot, whatever the size of the table
CHUNK = 2048  # vectors of a chunk, on average
SLICE = 8192  # queries that meet a chunk in one group, on average
ROUNDS = (4, 32)  # annuli a query has searched after the first rounds; the last takes the rest
EXACT = 2.0**52  # products below this are exact in doubles
CHUNK_SCHEMA = "cell int, ring int, chunk int, n bigint, low double, high double, longest double, ids binary, vectors binary"
QUERY_SCHEMA = "query_id bigint, vector binary, least double"


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", grid: int = GRID) -> DataFrame:
    """``vec_id, v``: the integers floor(grid * x) of every vector that takes part."""
    x = vectors[vector_col].cast("array<double>")
    own = vectors.select(vectors[id_col].cast("bigint").alias("vec_id"), x.alias("x")).filter(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0)
        & ~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    )
    own = own.select("vec_id", F.transform("x", lambda c: F.floor(c * grid)).alias("v"))
    own = materialize(own.groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    widths = own.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    return own.filter(F.size("v") == (widths[0]["w"] if widths else 0))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = a.astype(float), b.astype(float)
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if top < EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


class Index:
    """Chunks in the shared folder, the pivots, and a summary of every annulus (bounded by pivots and annuli)."""

    def __init__(self, chunks: DataFrame, pivots: np.ndarray, rings: np.ndarray, members: DataFrame):
        self.chunks, self.pivots, self.rings, self.members = chunks, pivots, rings, members


def build(own: DataFrame, most_pivots: int = MOST_PIVOTS, annuli: int = ANNULI, chunk: int = CHUNK) -> Index:
    """Index all of ``vec_id, v``."""
    n = own.count()
    n_pivots = min(most_pivots, max(1, math.isqrt(n) // 8))
    sample = own.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n_pivots).collect()
    width = len(sample[0]["v"]) if sample else 0
    pivots = np.array([r["v"] for r in sample], np.int64).reshape(len(sample), width)

    def assign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            far = distances(_matrix(batch.column(1), width), pivots)
            cell = far.argmin(axis=1)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(cell.astype(np.int32)), pa.array(far[np.arange(len(cell)), cell])],
                ["vec_id", "v", "cell", "far"],
            )

    keyed = materialize(own.select("vec_id", "v").mapInArrow(assign, "vec_id bigint, v array<bigint>, cell int, far double"), "keyed")
    steps = F.array(*(F.lit((k + 1) / annuli) for k in range(annuli - 1)))
    edges = keyed.groupBy("cell").agg(F.percentile_approx("far", steps, 1000).alias("edges"))
    placed = keyed.join(F.broadcast(edges), "cell").withColumn(  # rows: the pivots
        "ring", F.size(F.filter("edges", lambda e: e < F.col("far"))).cast("int")
    )
    sizes = placed.groupBy("cell", "ring").agg(F.count("*").alias("_n"))
    members = materialize(
        placed.join(F.broadcast(sizes), ["cell", "ring"]).select(  # rows: pivots times annuli
            "cell", "ring", F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("_n") / chunk)).cast("int").alias("chunk"), "vec_id", "v", "far",
        ), "members",
    )

    def gather(key, table):
        ids, v = table.column("vec_id").combine_chunks().to_numpy(), _matrix(table.column("v"), width)
        far = table.column("far").combine_chunks().to_numpy()
        order = np.argsort(far, kind="stable")
        ids, v, far = ids[order], v[order], far[order]
        longest = float(np.sqrt((v.astype(float) ** 2).sum(axis=1).max()))
        row = [*(k.as_py() for k in key), len(ids), float(far[0]), float(far[-1]), longest, ids.tobytes(), v.tobytes()]
        return pa.Table.from_pylist([dict(zip(names, row))], schema)

    names = [f.split()[0] for f in CHUNK_SCHEMA.split(", ")]
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in CHUNK_SCHEMA.split(", ")])
    chunks = materialize(members.groupBy("cell", "ring", "chunk").applyInArrow(gather, CHUNK_SCHEMA), "chunks")
    summary = chunks.groupBy("cell", "ring").agg(
        F.max("chunk").alias("last"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("longest").alias("longest")
    ).orderBy("cell", "ring").collect()
    return Index(chunks, pivots, np.array([tuple(r) for r in summary], float).reshape(-1, 6), members)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best columns of a row: higher scores, then smaller ids."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def bounds(q: np.ndarray, pivots: np.ndarray, rings: np.ndarray) -> np.ndarray:
    """The highest score that each annulus can hold for each query."""
    far = distances(q, pivots)[:, rings[:, 0].astype(int)]
    gap = np.maximum(0, np.maximum(far - rings[:, 4], rings[:, 3] - far))
    length = np.sqrt((q.astype(float) ** 2).sum(axis=1))[:, None]
    top = np.minimum((length**2 + rings[:, 5] ** 2 - gap**2) / 2, length * rings[:, 5])
    return top + 1e-6 * (1 + np.abs(top))  # more than the rounding of the distances


def search(index: Index, queries: DataFrame, k: int = K, rounds: tuple[int, ...] = ROUNDS) -> DataFrame:
    """``query_id, vec_id, score, rank`` of each query's ``k`` best; ``queries`` holds ``vec_id`` of the index."""
    width, pivots, rings = index.pivots.shape[1], index.pivots, index.rings
    asked = index.members.join(queries.select("vec_id").distinct(), "vec_id").select(
        F.col("vec_id").alias("query_id"), "v", F.lit(None).cast("double").alias("least"), "cell", "ring", "chunk"
    )

    def pack(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column(1), width)
            yield pa.record_batch(
                [batch.column(0), pa.array([r.tobytes() for r in v], pa.binary()), *batch.columns[2:]],
                ["query_id", "vector", "least", "cell", "ring", "chunk"],
            )

    target = ", cell int, ring int, chunk int"
    home = asked.mapInArrow(pack, QUERY_SCHEMA + target)
    state = materialize(home.select("query_id", "vector", "least"), "queries")
    n_slices = max(1, -(-state.count() // SLICE))  # so no group holds more than a slice of the queries

    def visit(begin: int, end: int | None):
        def run(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    q = np.frombuffer(b"".join(part.column(1).to_pylist()), np.int64).reshape(-1, width)
                    least = part.column(2).fill_null(-math.inf).to_numpy()
                    top = bounds(q, pivots, rings)
                    order = np.argsort(-top, axis=1, kind="stable")[:, begin:end]
                    row = np.repeat(np.arange(len(q)), order.shape[1])
                    ring = order.ravel()
                    open_ = top[row, ring] >= least[row]
                    row, ring = row[open_], ring[open_]
                    repeat = rings[ring, 2].astype(int) + 1  # chunks of the annulus
                    row, ring = np.repeat(row, repeat), np.repeat(ring, repeat)
                    chunk = np.arange(len(row)) - np.repeat(np.cumsum(repeat) - repeat, repeat)
                    take = pa.array(row)
                    yield pa.record_batch(
                        [
                            *(part.column(c).take(take) for c in range(3)), pa.array(rings[ring, 0].astype(np.int32)),
                            pa.array(rings[ring, 1].astype(np.int32)), pa.array(chunk.astype(np.int32)),
                        ],
                        ["query_id", "vector", "least", "cell", "ring", "chunk"],
                    )

        return run

    def compare(key, queries_here, chunk_here):
        q_ids = queries_here.column("query_id").combine_chunks().to_numpy()
        out: list[list[np.ndarray]] = [[], [], []]
        if chunk_here.num_rows and len(q_ids):
            vectors = queries_here.column("vector").to_pylist()
            least = queries_here.column("least").combine_chunks().fill_null(-math.inf).to_numpy()
            for ids, v in zip(chunk_here.column("ids").to_pylist(), chunk_here.column("vectors").to_pylist()):
                ids, v = np.frombuffer(ids, np.int64), np.frombuffer(v, np.int64).reshape(-1, width)
                for at in range(0, len(q_ids), 512):
                    q = np.frombuffer(b"".join(vectors[at : at + 512]), np.int64).reshape(-1, width)
                    for i, scores in enumerate(products(q, v)):
                        good = np.flatnonzero((scores >= least[at + i]) & (ids != q_ids[at + i]))
                        best = good[_best(scores[good], ids[good], k)]
                        for column, value in zip(out, (np.full(len(best), q_ids[at + i]), ids[best], scores[best])):
                            column.append(value)
        none = np.zeros(0, np.int64)
        return pa.table([pa.array(np.concatenate(c) if c else none) for c in out], ["query_id", "vec_id", "score"])

    def meet(wanted: DataFrame) -> DataFrame:
        keys = ("cell", "ring", "chunk", "slice")
        sliced = wanted.withColumn("slice", F.pmod(F.xxhash64("query_id"), F.lit(n_slices)).cast("int"))
        copies = index.chunks.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))))
        return sliced.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInArrow(
            compare, "query_id bigint, vec_id bigint, score bigint"
        )

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best_of(found: DataFrame) -> DataFrame:
        distinct = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return materialize(distinct.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), "best")

    best = best_of(meet(home))
    for begin, end in zip((0, *rounds), (*rounds, None)):
        least = best.filter(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("least"))
        now = state.drop("least").join(least, "query_id", "left").select("query_id", "vector", "least")
        found = meet(now.mapInArrow(visit(begin, end), QUERY_SCHEMA + target))
        best = best_of(best.drop("rank").unionByName(found))
    return best
