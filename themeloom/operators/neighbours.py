"""Exact nearest neighbours by metric pruning, and the mutual-reachability graph.

Points are put into the cells of sampled pivots (a Voronoi partition, as in the published
MapReduce k-NN join of Lu et al., 2012). Every point first searches its own cell, which bounds the
distance to its k-th neighbour; it then visits only the cells the triangle inequality cannot rule
out. For that, near cells make a tile, and a point is sent once to every tile with a cell still open, not once
to every cell. Crowded cells are cut into blocks of bounded size and each pair of blocks is one task-sized group, so
no cell, however crowded, ends in one task. Equal vectors are searched once: copies are answered
from their common vector. The result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from themeloom.functions.vectors import matrix
from themeloom.session import materialize

CELL_ROWS = 1024  # wanted points per cell
MAX_CELLS = 65_536  # the pivots live on the driver and travel to the tasks
BLOCK_ROWS = 4096  # points per block inside a crowded cell
CHUNK_CELLS = 1 << 22  # numbers of a distance matrix held at a time
SEARCH_CELLS = 1 << 20  # the same in the search, whose matrices are read several times
TILE_ROWS, TILE_NUMBERS = 16_384, 1 << 20  # most points of a tile, and most numbers in them
SENT_NUMBERS = 1 << 19  # numbers of the vectors handed on at a time
DISTANCE_DIGITS = 9


def _distinct_vectors(points: DataFrame, keep: int) -> DataFrame:
    """One row per distinct vector: smallest id ``rep`` and its ``keep`` smallest ids.

    More ids than that can never be among the neighbours of anything, since equal distances go by
    id. The rank limit is applied before the shuffle, so a vector with very many copies is harmless.
    """
    keyed = points.select("id", "embedding", F.xxhash64("embedding").alias("h"))
    w = Window.partitionBy("h", "embedding").orderBy("id")
    few = keyed.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= keep)
    return few.groupBy("h", "embedding").agg(
        F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids")
    )


def _pivots(points: DataFrame, n: int, cell_rows: int) -> np.ndarray:
    """A reproducible sample of vectors, at most ``MAX_CELLS``; crowded regions get more of them."""
    cells = max(1, min(MAX_CELLS, -(-n // cell_rows)))
    rows = points.select("embedding").orderBy(F.xxhash64("rep"), "rep").limit(cells).collect()
    return np.array([r[0] for r in rows], dtype=np.float64)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0.0))


def _to_cells(points: DataFrame, pivots) -> DataFrame:
    """Add the nearest pivot ``cell`` and the distance to it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres = pivots.value
        step = max(1, CHUNK_CELLS // len(centres))
        for batch in batches:
            vectors = matrix(batch["embedding"])
            cell, away = np.zeros(len(batch), np.int32), np.zeros(len(batch))
            for at in range(0, len(batch), step):
                d = _distances(vectors[at:at + step], centres)
                cell[at:at + step] = d.argmin(1)
                away[at:at + step] = d.min(1)
            yield batch.assign(cell=cell, away=away)

    return points.select("rep", "embedding").mapInPandas(
        run, "rep bigint, embedding array<double>, cell int, away double"
    )


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = a @ b.T
    square *= -2.0
    square += (a * a).sum(1)[:, None]
    square += (b * b).sum(1)[None, :]
    return square


def _closest(
    ids: np.ndarray, all_queries: np.ndarray, reps: np.ndarray, vectors: np.ndarray, k: int, digits: int,
    within: np.ndarray | None = None,
) -> pd.DataFrame:
    """The ``k`` nearest points of a block for each query, ordered by rounded distance, then id.

    Points farther than ``within`` of their query may be left out.
    """
    found = []
    kept = min(k, len(reps))
    step = max(1, SEARCH_CELLS // len(reps))
    for at in range(0, len(ids), step):
        q = all_queries[at:at + step]
        square = _squares(q, vectors)
        limit = np.full(len(q), np.inf) if within is None else within[at:at + step]
        # every candidate that rounding or cancellation could put in front, then exact differences
        near = square <= _reach(limit, digits)[:, None]
        if np.count_nonzero(near) > 2 * kept * len(q):
            kth = np.sqrt(np.maximum(np.partition(square, kept - 1, axis=1)[:, kept - 1], 0.0))
            near = square <= _reach(np.minimum(limit, kth), digits)[:, None]
        row, col = np.nonzero(near)
        exact = np.round(np.sqrt(((q[row] - vectors[col]) ** 2).sum(1)), digits)
        order = np.lexsort((reps[col], exact, row))
        row, col, exact = row[order], col[order], exact[order]
        place = np.arange(len(row)) - np.searchsorted(row, row, side="left")
        take = place < kept
        found.append(pd.DataFrame(
            {"src": ids[at:at + step][row[take]], "dst": reps[col[take]], "distance": exact[take]}
        ))
    return pd.concat(found, ignore_index=True)


def _reach(limit: np.ndarray, digits: int) -> np.ndarray:
    """Square of ``limit`` with room for rounding and cancellation."""
    return (limit + 2.0 * 10.0 ** -digits + 1e-6 * (1.0 + limit)) ** 2


def _nothing() -> pd.DataFrame:
    return pd.DataFrame({"src": [], "dst": [], "distance": []}).astype(
        {"src": "int64", "dst": "int64", "distance": "float64"}
    )


def _search(queries: DataFrame, points: DataFrame, sizes: dict[int, int], k: int, digits: int) -> DataFrame:
    """Search each query in the cell named by its column ``cell``.

    Queries and points of one cell are cut into chunks; each pair of chunks is a group of bounded
    size. ``sizes`` has one entry per cell.
    """
    spark = queries.sparkSession
    asked = {r["cell"]: r["n"] for r in queries.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    plan = [
        (cell, -(-sizes[cell] // BLOCK_ROWS), -(-n // BLOCK_ROWS)) for cell, n in asked.items() if cell in sizes
    ]
    cuts = F.broadcast(spark.createDataFrame(plan, "cell int, n_sub int, n_chunk int"))  # rows: cells
    left = queries.join(cuts, "cell").select(
        "rep", "embedding", "cell",
        F.pmod(F.xxhash64("rep"), "n_chunk").alias("chunk"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_sub").cast("bigint") - 1)).alias("sub"),
    )
    # fresh names for the same table on both sides
    right = points.join(cuts, "cell").select(
        *[F.col(c).alias(c) for c in ("rep", "embedding", "cell")],
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_chunk").cast("bigint") - 1)).alias("chunk"),
        F.pmod(F.xxhash64("rep"), "n_sub").alias("sub"),
    )

    def run(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(p):
            return _nothing()
        return _closest(
            q["rep"].to_numpy(), matrix(q["embedding"]), p["rep"].to_numpy(), matrix(p["embedding"]), k, digits
        )

    key = ["cell", "chunk", "sub"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        run, "src bigint, dst bigint, distance double"
    )


def _tiles(pivots: np.ndarray, counts: np.ndarray, rows: int) -> np.ndarray:
    """The tile of every cell: the pivots are halved along their widest side until a tile has at most ``rows`` points
    or one cell."""
    tile, last, todo = np.zeros(len(pivots), np.int32), 0, [np.arange(len(pivots))]
    while todo:
        cells = todo.pop()
        if len(cells) > 1 and counts[cells].sum() > rows:
            sides = pivots[cells]
            cells = cells[np.argsort(sides[:, np.ptp(sides, axis=0).argmax()], kind="stable")]
            todo += [cells[:len(cells) // 2], cells[len(cells) // 2:]]
        else:
            tile[cells], last = last, last + 1
    return tile


def _open(vectors, own, bound, cells, centres, radius, filled) -> np.ndarray:
    """Which of ``cells`` besides the own one may hold something nearer than ``bound``: points by cells.

    A cell is ruled out by the ball around its pivot or by the plane between the two pivots.
    """
    d = _distances(vectors, centres[cells])
    mine = np.sqrt(((vectors - centres[own]) ** 2).sum(1))
    between = _distances(centres[own], centres[cells])
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = np.where(between > 0, (d ** 2 - mine[:, None] ** 2) / (2 * between), 0.0)
    least = np.maximum(d - radius[cells][None, :], plane)
    open_ = (least <= bound[:, None] + 1e-6 * (1.0 + d)) & filled[cells][None, :]
    return open_ & (own[:, None] != cells[None, :])


def _open_tiles(batch: pd.DataFrame, pivots, stats) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows of a batch and the tiles with a cell still open to them, some rows at a time, after the first one's place."""
    centres, (radius, filled, tile) = pivots.value, stats.value
    order = np.argsort(tile, kind="stable")  # the cells of a tile side by side
    first = np.flatnonzero(np.diff(tile[order], prepend=-1))
    step = max(1, CHUNK_CELLS // len(centres))
    own, bound = batch["cell"].to_numpy(), batch["bound"].to_numpy()
    for at in range(0, len(batch), step):
        part = slice(at, at + step)
        open_ = _open(matrix(batch["embedding"].iloc[part]), own[part], bound[part], order, centres, radius, filled)
        row, place = np.nonzero(np.logical_or.reduceat(open_, first, axis=1))
        yield at, row, tile[order][first][place]


def _search_tiles(
    queries: DataFrame, points: DataFrame, pivots, stats, sizes: dict[int, int], rows: int, k: int, digits: int
) -> DataFrame:
    """Search each query, a row with its ``cell`` and ``bound``, in all cells of ``points`` still open.

    A query goes to a tile once. Queries and points of a tile are cut into chunks of at most ``rows``; each pair
    of chunks is a group of bounded size.
    """
    spark = queries.sparkSession
    tile_of = stats.value[2]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, _, tile in _open_tiles(batch, pivots, stats):
                name, n = np.unique(tile, return_counts=True)
                yield pd.DataFrame({"tile": name.astype(np.int32), "n": n})

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            some = max(1, SENT_NUMBERS // max(1, len(batch["embedding"].iloc[0]))) if len(batch) else 1
            for first, row, tile in _open_tiles(batch, pivots, stats):
                for at in range(0, len(row), some):
                    yield batch.iloc[first + row[at:at + some]].assign(tile=tile[at:at + some].astype(np.int32))

    asked = queries.mapInPandas(count, "tile int, n bigint").groupBy("tile").agg(F.sum("n").alias("n")).collect()
    held = np.bincount(tile_of[list(sizes)], weights=list(sizes.values()), minlength=int(tile_of.max()) + 1)
    plan = [(r["tile"], -(-int(held[r["tile"]]) // rows), -(-r["n"] // rows)) for r in asked]
    cuts = F.broadcast(spark.createDataFrame(plan, "tile int, n_sub int, n_chunk int"))  # rows: tiles
    tiles = F.broadcast(spark.createDataFrame(list(enumerate(tile_of.tolist())), "cell int, tile int"))  # rows: cells
    slots = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n).cast("bigint") - 1))
    sent = queries.mapInPandas(send, "rep bigint, embedding array<double>, cell int, bound double, tile int")
    left = sent.join(cuts, "tile").select(
        "rep", "embedding", "cell", "bound", "tile",
        F.pmod(F.xxhash64("rep"), "n_chunk").alias("chunk"), slots("n_sub").alias("sub"),
    )
    right = points.join(tiles, "cell").join(cuts, "tile").select(
        *[F.col(c).alias(c) for c in ("rep", "embedding", "cell", "tile")],
        slots("n_chunk").alias("chunk"), F.pmod(F.xxhash64("rep"), "n_sub").alias("sub"),
    )

    def run(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(p):
            return _nothing()
        centres, (radius, filled, _) = pivots.value, stats.value
        asking, known = matrix(q["embedding"]), matrix(p["embedding"])
        ids, own, bound = q["rep"].to_numpy(), q["cell"].to_numpy(), q["bound"].to_numpy()
        reps, cell = p["rep"].to_numpy(), p["cell"].to_numpy()
        cells = np.unique(cell)
        step = max(1, CHUNK_CELLS // len(cells))
        best = _nothing()
        for at in range(0, len(ids), step):
            part = slice(at, at + step)
            open_ = _open(asking[part], own[part], bound[part], cells, centres, radius, filled)
            for i, c in enumerate(cells):
                row, col = at + np.flatnonzero(open_[:, i]), np.flatnonzero(cell == c)
                if len(row):
                    found = _closest(ids[row], asking[row], reps[col], known[col], k, digits, bound[row])
                    best = _merge(best, found, k)
        return best

    key = ["tile", "chunk", "sub"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        run, "src bigint, dst bigint, distance double"
    )


def _merge(best: pd.DataFrame, found: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` first of each query in both, by distance, then id."""
    both = pd.concat([best, found], ignore_index=True) if len(best) else found
    src, dst, distance = (both[c].to_numpy() for c in ("src", "dst", "distance"))
    order = np.lexsort((dst, distance, src))
    place = np.arange(len(order)) - np.searchsorted(src[order], src[order], side="left")
    return both.iloc[order[place < k]]


def _join(queries: DataFrame | None, points: DataFrame, k: int, digits: int, cell_rows: int) -> DataFrame:
    """The ``k`` nearest ``points`` of each query as ``(src, dst, distance)``.

    Both inputs are ``(rep, embedding)`` with distinct vectors; without ``queries`` the points
    search each other and find themselves as well.
    """
    sc = points.sparkSession.sparkContext
    n = points.count()
    if n == 0:
        return points.sparkSession.createDataFrame([], "src bigint, dst bigint, distance double")
    pivots = sc.broadcast(_pivots(points, n, cell_rows))
    placed = materialize(_to_cells(points, pivots), "cells")
    seeking = placed if queries is None else materialize(_to_cells(queries, pivots), "queries")
    stats = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("r")).collect()
    sizes = {s["cell"]: s["n"] for s in stats}  # one entry per pivot
    own = _search(seeking, placed, sizes, k, digits)
    if len(sizes) == 1 and len(pivots.value) == 1:
        return _best(own, k)
    own = materialize(own, "own-cell")
    radius, filled = np.zeros(len(pivots.value)), np.zeros(len(pivots.value), dtype=bool)
    counts = np.zeros(len(pivots.value), dtype=np.int64)
    for s in stats:
        radius[s["cell"]], filled[s["cell"]], counts[s["cell"]] = s["r"], True, s["n"]
    rows = max(cell_rows, min(TILE_ROWS, TILE_NUMBERS // max(1, pivots.value.shape[1])))
    tile = _tiles(pivots.value, counts, rows)
    reached = _best(own, k).groupBy("src").agg(F.max("distance").alias("d"), F.count("*").alias("found"))
    bound = F.when(F.col("found") >= k, F.col("d")).otherwise(F.lit(float("inf")))
    bounded = seeking.join(reached.withColumnRenamed("src", "rep"), "rep", "left").select(
        "rep", "embedding", "cell", F.coalesce(bound, F.lit(float("inf"))).alias("bound")
    )
    bounded, shared = materialize(bounded, "bounded"), sc.broadcast((radius, filled, tile))
    others = _search_tiles(bounded, placed, pivots, shared, sizes, rows, k, digits)
    return _best(own.unionByName(others), k)


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("src").orderBy("distance", "dst")
    return found.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k).drop("r")


def nearest_points(
    queries: DataFrame, points: DataFrame, k: int, digits: int = DISTANCE_DIGITS, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """The ``k`` nearest points of each query: ``(src, dst, distance, rank)``, ties by id.

    Both tables are ``(id, embedding)``; a query is never left out of its own result here.
    """
    asked = materialize(_distinct_vectors(queries, 1), "asked")
    known = materialize(_distinct_vectors(points, k), "known")
    pairs = _join(asked.select("rep", "embedding"), known.select("rep", "embedding"), k, digits, cell_rows)
    ids = known.select(F.col("rep").alias("dst"), "ids")
    spread = pairs.join(ids, "dst").select("src", F.explode("ids").alias("dst"), "distance")
    copies = _copies(queries, asked)
    return _ranked(copies.join(_best(spread, k), "src").select(F.col("id").alias("src"), "dst", "distance"), k)


def _copies(points: DataFrame, distinct: DataFrame) -> DataFrame:
    """``(id, src)``: each row with the representative of its vector."""
    keyed = points.select("id", "embedding", F.xxhash64("embedding").alias("h"))
    return keyed.join(distinct.select("h", "embedding", F.col("rep").alias("src")), ["h", "embedding"]).select(
        "id", "src"
    )


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("src").orderBy("distance", "dst")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select(
        "src", "rank", "dst", "distance"
    )


def knn_graph(points: DataFrame, k: int, digits: int = DISTANCE_DIGITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """The ``k`` nearest other points of every point ``(id, embedding)``: ``(src, rank, dst, distance)``.

    Euclidean distance rounded to ``digits``, ties by id.
    """
    known = materialize(_distinct_vectors(points, k + 1), "known")
    pairs = _join(None, known.select("rep", "embedding"), k + 1, digits, cell_rows)
    ids = known.select(F.col("rep").alias("dst"), "ids")
    spread = pairs.join(ids, "dst").select("src", F.explode("ids").alias("dst"), "distance")
    near = _best(spread, k + 1)
    rows = _copies(points, known).join(near, "src").filter(F.col("id") != F.col("dst"))
    return _ranked(rows.select(F.col("id").alias("src"), "dst", "distance"), k)


def core_distances(neighbours: DataFrame, k: int) -> DataFrame:
    """Distance to the ``k``-th neighbour (the last one there is, if fewer): ``(id, core)``."""
    return neighbours.filter(F.col("rank") <= k).groupBy(F.col("src").alias("id")).agg(
        F.max("distance").alias("core")
    )


def undirected_pairs(neighbours: DataFrame) -> DataFrame:
    """Pairs ``(u, v, d)`` of the graph, each once, with their distance."""
    return neighbours.groupBy(
        F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v")
    ).agg(F.min("distance").alias("d"))


def mutual_reachability(neighbours: DataFrame, k: int, pairs: DataFrame | None = None) -> DataFrame:
    """Undirected edges ``(u, v, w)`` with ``w = max(core(u), core(v), distance)``, each once.

    ``pairs`` can be the graph's ``undirected_pairs`` made before.
    """
    core = core_distances(neighbours, k)
    edges = undirected_pairs(neighbours) if pairs is None else pairs
    with_u = edges.join(core.select(F.col("id").alias("u"), F.col("core").alias("cu")), "u")
    return with_u.join(core.select(F.col("id").alias("v"), F.col("core").alias("cv")), "v").select(
        "u", "v", F.greatest("cu", "cv", "d").alias("w")
    )
