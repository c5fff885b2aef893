"""Density clusters with an outlier topic, from a minimum spanning forest.

The merge tree of the forest is condensed for a smallest cluster size and the most stable clusters
are selected by excess of mass (Campello et al. 2013, McInnes and Healy 2017). Edges are numbered by
weight. If they are more than one task may hold, ranges of ranks are halved again and again: the
lower half of a range falls into components, which become vertices of the upper half. Ranges are contracted in one
group each as soon as their halves are small enough, all at once before. All pieces are independent, bounded in size, and solved in parallel, one group each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.functions.words import OUTLIER_TOPIC
from themeloom.operators.connect import connect_trees
from themeloom.operators.forest import components, joined, minimum_spanning_forest
from themeloom.operators.neighbours import CELL_ROWS, core_distances, knn_graph, mutual_reachability
from themeloom.session import ONE_TASK_ROWS, fits_one_task, materialize, with_dense_index

CLOSEST = 1e-9  # floor of a distance, so that copies have a finite density
NO_EDGE = -1

MERGES = (
    "edge bigint, w double, left_size bigint, right_size bigint, left_top bigint, right_top bigint, "
    "left_vertex bigint, right_vertex bigint, up bigint, res bigint, top boolean"
)
CONTRACTED = "low bigint, vertex bigint, name bigint, total bigint, last bigint"


def _merge_piece(pdf: pd.DataFrame, min_size: int) -> pd.DataFrame:
    """Merge tree of one bounded piece: union by rank order.

    Vertices may be whole components of a lower piece; then they bring their size and last edge.
    ``up`` is the edge that merges the result of an edge further, ``res`` the edge whose condensed
    cluster it belongs to (as far as this piece can tell), ``top`` marks the last edge of a tree.
    """
    pdf = pdf.sort_values("edge", kind="stable")
    n = len(pdf)
    edge = pdf["edge"].to_numpy()
    labels, ends = np.unique(pdf[["a", "b"]].to_numpy(), return_inverse=True)
    ends = ends.reshape(-1, 2)
    size, last = np.ones(len(labels), np.int64), np.full(len(labels), NO_EDGE, np.int64)
    for side, j in (("a", 0), ("b", 1)):
        size[ends[:, j]] = pdf[f"{side}_size"].to_numpy()
        last[ends[:, j]] = pdf[f"{side}_top"].to_numpy()
    size, last, parent = size.tolist(), last.tolist(), list(range(len(labels)))
    local = [NO_EDGE] * len(labels)  # position of the last merge inside this piece
    sizes, tops, lows = np.zeros((n, 2), np.int64), np.full((n, 2), NO_EDGE, np.int64), np.full((n, 2), NO_EDGE)
    fresh = np.zeros((n, 2), dtype=bool)

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, (a, b) in enumerate(ends.tolist()):
        roots = (find(a), find(b))
        for j, r in enumerate(roots):
            sizes[i, j], tops[i, j], lows[i, j] = size[r], last[r], local[r]
            fresh[i, j] = last[r] == NO_EDGE
        keep, gone = roots if size[roots[0]] >= size[roots[1]] else roots[::-1]
        parent[gone] = keep
        size[keep] += size[gone]
        last[keep], local[keep] = int(edge[i]), i
    up = np.full(n, NO_EDGE, np.int64)
    for j in (0, 1):
        inside = lows[:, j] >= 0
        up[lows[inside, j]] = np.flatnonzero(inside)
    total, split = sizes.sum(1), (sizes >= min_size).all(1)
    res = edge.copy()
    for i in range(n - 1, -1, -1):
        p = up[i]
        if p >= 0 and not (total[i] >= min_size and split[p]):
            res[i] = res[p]
    names = labels[ends]
    return pd.DataFrame({
        "edge": edge, "w": pdf["w"].to_numpy(),
        "left_size": sizes[:, 0], "right_size": sizes[:, 1], "left_top": tops[:, 0], "right_top": tops[:, 1],
        "left_vertex": pd.array(np.where(fresh[:, 0], names[:, 0], 0), dtype="Int64").copy(),
        "right_vertex": pd.array(np.where(fresh[:, 1], names[:, 1], 0), dtype="Int64").copy(),
        "up": np.where(up >= 0, edge[np.maximum(up, 0)], NO_EDGE), "res": res, "top": up < 0,
    }).assign(
        left_vertex=lambda d: d["left_vertex"].mask(~fresh[:, 0]),
        right_vertex=lambda d: d["right_vertex"].mask(~fresh[:, 1]),
    )


def _pieces(forest: DataFrame, one_task_rows: int) -> tuple[DataFrame, bool]:
    """Edges with vertices, grouped into independent pieces of at most ``one_task_rows`` ranks."""
    order = [F.col("w"), F.col("u"), F.col("v")]
    n = forest.count()
    numbered = with_dense_index(forest, order, "edge", one_task_rows, n)
    edges = numbered.select(
        F.lit(0).cast("bigint").alias("low"), "edge", "w",
        F.col("u").alias("a"), F.lit(1).cast("bigint").alias("a_size"), F.lit(NO_EDGE).cast("bigint").alias("a_top"),
        F.col("v").alias("b"), F.lit(1).cast("bigint").alias("b_size"), F.lit(NO_EDGE).cast("bigint").alias("b_top"),
    )
    width = 1
    while width < n:
        width *= 2
    whole = n <= one_task_rows
    while not whole and width > one_task_rows:
        width //= 2
        edges = _halve(edges, width, one_task_rows)
    return edges, whole


def _contract_range(pdf: pd.DataFrame) -> pd.DataFrame:
    """Components of the lower half of one range, of bounded size: ``CONTRACTED`` for every vertex."""
    labels, ends = np.unique(pdf[["a", "b"]].to_numpy(), return_inverse=True)
    ends = ends.reshape(-1, 2)
    _, root = joined(ends, len(labels))
    size, total = np.ones(len(labels), np.int64), np.zeros(len(labels), np.int64)
    for j, side in enumerate(("a", "b")):
        size[ends[:, j]] = pdf[f"{side}_size"].to_numpy()
    np.add.at(total, root, size)
    last = np.full(len(labels), NO_EDGE, np.int64)
    np.maximum.at(last, root[ends[:, 0]], pdf["edge"].to_numpy())
    return pd.DataFrame({
        "low": pdf["low"].iloc[0], "vertex": labels, "name": labels[root], "total": total[root], "last": last[root]
    })


def _contract_ranges(edges: DataFrame, lower: DataFrame, one_task_rows: int) -> DataFrame:
    """The same for ranges of any size, all at once."""
    ends = [
        edges.select("low", F.col(s).alias("vertex"), F.col(f"{s}_size").alias("size")) for s in ("a", "b")
    ]
    # one id per (range, vertex): the same original vertex can stand for itself in one range only,
    # and for its component in a higher one
    vertices = ends[0].unionByName(ends[1]).groupBy("low", "vertex").agg(F.max("size").alias("size"))
    order = [F.col("low"), F.col("vertex")]
    ids = materialize(with_dense_index(vertices, order, "vid", one_task_rows), "vertices")

    def tag(df: DataFrame, side: str) -> DataFrame:
        names = ids.select("low", F.col("vertex").alias(side), F.col("vid").alias(f"{side}_vid"))
        return df.join(names, ["low", side])

    linked = materialize(tag(tag(lower, "a"), "b"), "lower")
    roots = components(linked.select(F.col("a_vid").alias("a"), F.col("b_vid").alias("b")))
    member = materialize(
        ids.join(roots.select(F.col("a").alias("vid"), "root"), "vid"), "members"
    )
    size = member.groupBy("root").agg(F.sum("size").alias("size"), F.min("vertex").alias("name"))
    last = linked.join(roots.select(F.col("a").alias("a_vid"), "root"), "a_vid").groupBy("root").agg(
        F.max("edge").alias("last")
    )
    return member.join(size.withColumnRenamed("size", "total"), "root").join(last, "root").select(
        "low", "vertex", "name", "total", "last"
    )


def _halve(edges: DataFrame, half: int, one_task_rows: int) -> DataFrame:
    """Split each rank range in two; the lower part's components become the upper part's vertices."""
    upper_part = F.col("edge") >= F.col("low") + half
    lower = edges.filter(~upper_part)
    if half <= ONE_TASK_ROWS:  # a lower part holds at most ``half`` ranks
        merged = lower.groupBy("low").applyInPandas(_contract_range, CONTRACTED)
    else:
        merged = _contract_ranges(edges, lower, one_task_rows)
    merged = materialize(merged, "merged")
    upper = edges.filter(upper_part)
    for s in ("a", "b"):
        names = merged.select(
            "low", F.col("vertex").alias(s), F.col("name").alias("n_"), F.col("total").alias("t_"), F.col("last").alias("l_")
        )
        upper = upper.join(names, ["low", s], "left").withColumns({
            f"{s}_size": F.coalesce("t_", f"{s}_size"), f"{s}_top": F.coalesce("l_", f"{s}_top"),
            s: F.coalesce("n_", s),
        }).drop("n_", "t_", "l_")
    raised = upper.withColumn("low", F.col("low") + half)
    return materialize(lower.unionByName(raised.select(*lower.columns)), "halved")


def merge_tree(forest: DataFrame, min_size: int, one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """All merges of the forest with sizes, next merge ``up`` and condensed cluster ``res``."""
    edges, whole = _pieces(forest, one_task_rows)
    # a range holds at most one_task_rows ranks, so its group is bounded
    merges = materialize(
        edges.groupBy("low").applyInPandas(lambda pdf: _merge_piece(pdf, min_size), MERGES), "merges"
    )
    return merges if whole else _stitch(merges, min_size)


def _stitch(merges: DataFrame, min_size: int) -> DataFrame:
    """Connect pieces: the last edge of a piece goes on in the piece its component is a vertex of."""
    big = (F.col("left_size") >= min_size) & (F.col("right_size") >= min_size)
    sides = [
        merges.filter(F.col(f"{s}_top") != NO_EDGE).select(
            F.col(f"{s}_top").alias("edge"), F.col("edge").alias("over"), F.col("res").alias("over_res"),
            big.alias("over_split"),
        )
        for s in ("left", "right")
    ]
    over = sides[0].unionByName(sides[1])
    size = F.col("left_size") + F.col("right_size")
    tops = merges.filter("top").select("edge", size.alias("size")).join(over, "edge", "left")
    stays = F.col("over").isNull() | ((F.col("size") >= min_size) & F.col("over_split"))
    link = materialize(
        tops.select(
            "edge", F.coalesce("over", F.lit(NO_EDGE)).alias("over"),
            F.when(stays, F.col("edge")).otherwise(F.col("over_res")).alias("to"),
        ),
        "links",
    )
    while True:  # pointer jumping over piece tops; the way of a pointer doubles each time
        nxt = link.select(F.col("edge").alias("to"), F.col("to").alias("then"))
        jumped = materialize(
            link.join(nxt, "to", "left").select(
                "edge", "over", F.coalesce("then", "to").alias("to"),
                (F.col("then").isNotNull() & (F.col("then") != F.col("to"))).alias("moved"),
            ),
            "links",
        )
        link = jumped.drop("moved")
        if not jumped.filter("moved").take(1):
            break
    resolved = link.select(F.col("edge").alias("res"), F.col("to").alias("final"))
    above = link.select("edge", "over")
    return materialize(
        merges.join(resolved, "res", "left").join(above, "edge", "left").withColumns({
            "res": F.coalesce("final", "res"),
            "up": F.when(F.col("up") != NO_EDGE, F.col("up")).otherwise(F.coalesce("over", F.lit(NO_EDGE))),
            "top": F.coalesce(F.col("over") == NO_EDGE, F.lit(False)),
        }).select(*merges.columns),
        "stitched",
    )


def condensed_tree(merges: DataFrame, min_size: int) -> DataFrame:
    """One row per condensed cluster: ``(cluster, parent, size, birth, stability, is_root)``.

    Density is one over distance. At each merge of a cluster the side that is too small leaves it;
    at a true split both sides do. Trees that no edge connects stay apart: several
    large trees are clusters born at density 0, a single one is the root, which is not selectable.
    """
    density = 1.0 / F.greatest(F.col("w"), F.lit(CLOSEST))
    size = F.col("left_size") + F.col("right_size")
    left, right = F.col("left_size") >= min_size, F.col("right_size") >= min_size
    leaving = (
        F.when(left & right, size)
        .otherwise(F.when(~left, F.col("left_size")).otherwise(0) + F.when(~right, F.col("right_size")).otherwise(0))
    )
    big = merges.filter(size >= min_size)
    mass = big.groupBy(F.col("res").alias("cluster")).agg(F.sum(leaving * density).alias("mass"))
    heads = big.filter("edge = res").select(F.col("edge").alias("cluster"), "up", size.alias("size"))
    above = merges.select(F.col("edge").alias("up"), F.col("res").alias("parent"), density.alias("birth"))
    tree = (
        heads.join(above, "up", "left").join(mass, "cluster")
        .withColumn("birth", F.coalesce("birth", F.lit(0.0)))
        .select(
            "cluster", F.coalesce("parent", F.lit(NO_EDGE)).alias("parent"), "size", "birth",
            (F.col("mass") - F.col("size") * F.col("birth")).alias("stability"),
        )
    )
    tree = materialize(tree, "condensed")
    trees = tree.filter(F.col("parent") == NO_EDGE).agg(F.count("*")).scalar()
    return tree.withColumn("is_root", (F.col("parent") == NO_EDGE) & (trees == 1))


def _select_small(pdf: pd.DataFrame) -> pd.DataFrame:
    """Excess of mass over a condensed tree of checked size, children before parents."""
    # a child consists of earlier edges than its parent, so ids order the tree
    pdf = pdf.sort_values("cluster")
    ids, parents = pdf["cluster"].to_numpy(), pdf["parent"].to_numpy()
    own = np.where(pdf["is_root"], -np.inf, pdf["stability"])
    at = {c: i for i, c in enumerate(ids.tolist())}
    below, wins = np.zeros(len(ids)), np.zeros(len(ids), dtype=bool)
    for i, p in enumerate(parents.tolist()):
        wins[i] = own[i] >= below[i]
        if p in at:
            below[at[p]] += own[i] if wins[i] else below[i]
    chosen = np.full(len(ids), NO_EDGE)
    for i in range(len(ids) - 1, -1, -1):
        p = at.get(int(parents[i]), -1)
        above = chosen[p] if p >= 0 else NO_EDGE
        chosen[i] = above if above != NO_EDGE else (ids[i] if wins[i] else NO_EDGE)
    return pd.DataFrame({"cluster": ids, "selected": chosen})


def _select_large(tree: DataFrame) -> DataFrame:
    """The same choice level by level as joins, for trees of any size."""
    own = F.when(F.col("is_root"), F.lit(float("-inf"))).otherwise(F.col("stability"))
    kids = tree.groupBy(F.col("parent").alias("cluster")).agg(F.count("*").alias("kids"))
    open_ = materialize(
        tree.join(kids, "cluster", "left").select(
            "cluster", "parent", own.alias("own"), F.coalesce("kids", F.lit(0)).alias("waits"), F.lit(0.0).alias("below")
        ),
        "open",
    )
    done = None
    while open_.take(1):
        ready = open_.filter("waits = 0").select(
            "cluster", "parent", (F.col("own") >= F.col("below")).alias("wins"),
            F.greatest("own", "below").alias("best"),
        )
        ready = materialize(ready, "ready")
        done = ready if done is None else done.unionByName(ready)
        gained = ready.groupBy(F.col("parent").alias("cluster")).agg(
            F.sum("best").alias("g"), F.count("*").alias("c")
        )
        open_ = materialize(
            open_.filter("waits > 0").join(gained, "cluster", "left").select(
                "cluster", "parent", "own", (F.col("waits") - F.coalesce("c", F.lit(0))).alias("waits"),
                (F.col("below") + F.coalesce("g", F.lit(0.0))).alias("below"),
            ),
            "open",
        )
    # highest winner on the way up, the way doubling each time
    way = materialize(
        done.select("cluster", F.col("parent").alias("to"), F.when(F.col("wins"), F.col("cluster")).alias("win")), "way"
    )
    while way.filter(F.col("to") != NO_EDGE).take(1):
        nxt = way.select(F.col("cluster").alias("to"), F.col("to").alias("to2"), F.col("win").alias("win2"))
        way = materialize(
            way.join(nxt, "to", "left").select(
                "cluster", F.coalesce("to2", F.lit(NO_EDGE)).alias("to"), F.coalesce("win2", "win").alias("win")
            ),
            "way",
        )
    return way.select("cluster", F.coalesce("win", F.lit(NO_EDGE)).alias("selected"))


def select_clusters(tree: DataFrame, one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """Selected cluster above or at each condensed cluster (or -1): ``(cluster, selected)``."""
    if not fits_one_task(tree, one_task_rows):
        return _select_large(tree)
    # counted above: at most one_task_rows rows
    return tree.groupBy(F.lit(0).alias("all")).applyInPandas(_select_small, "cluster bigint, selected bigint")


@dataclass(frozen=True)
class Clustering:
    """Clusters of points, and the trees they come from; all tables are written."""

    merges: DataFrame
    tree: DataFrame  # cluster, parent, size, birth, stability, is_root
    selected: DataFrame  # cluster, selected
    clusters: DataFrame  # id, cluster


def cluster_trees(points: DataFrame, forest: DataFrame, min_size: int, one_task_rows: int = ONE_TASK_ROWS) -> Clustering:
    """Cluster of every point ``(id)``, or -1, with the merge tree and the condensed tree; cluster ids are arbitrary."""
    merges = materialize(merge_tree(forest, min_size, one_task_rows), "merges")
    tree = condensed_tree(merges, min_size)
    selected = materialize(select_clusters(tree, one_task_rows), "selected")
    members = [
        merges.filter(F.col(f"{s}_vertex").isNotNull()).select(
            F.col(f"{s}_vertex").alias("id"), F.col("res").alias("cluster")
        )
        for s in ("left", "right")
    ]
    found = members[0].unionByName(members[1]).join(selected, "cluster").select("id", "selected")
    clusters = points.select("id").join(found, "id", "left").select(
        "id", F.coalesce("selected", F.lit(OUTLIER_TOPIC)).cast("bigint").alias("cluster")
    )
    return Clustering(merges, tree, selected, materialize(clusters, "clusters"))


def cluster_forest(points: DataFrame, forest: DataFrame, min_size: int, one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """Cluster of every point ``(id)``, or -1: ``(id, cluster)``; cluster ids are arbitrary."""
    return cluster_trees(points, forest, min_size, one_task_rows).clusters


def cluster_numbers(clusters: DataFrame) -> DataFrame:
    """``(cluster, topic)``: topic ids 0, 1, ... by falling size, ties by smallest member.

    Sorts the table of clusters, which has one row per cluster.
    """
    sizes = clusters.filter(F.col("cluster") != OUTLIER_TOPIC).groupBy("cluster").agg(
        F.count("*").alias("n"), F.min("id").alias("first")
    )
    return with_dense_index(sizes, [F.desc("n"), F.col("first")], "topic").select("cluster", "topic")


def renumber(clusters: DataFrame) -> DataFrame:
    """``(id, topic)`` by ``cluster_numbers``; -1 stays."""
    return clusters.join(cluster_numbers(clusters), "cluster", "left").select(
        "id", F.coalesce("topic", F.lit(OUTLIER_TOPIC)).cast("int").alias("topic")
    )


def spanning_tree(
    points: DataFrame, neighbours: DataFrame, k: int, cell_rows: int = CELL_ROWS, one_task_rows: int = ONE_TASK_ROWS,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Spanning tree under mutual reachability of order ``k``: the neighbour graph's forest, made one tree.

    ``pairs`` can be the graph's undirected pairs made before.
    """
    forest = materialize(minimum_spanning_forest(mutual_reachability(neighbours, k, pairs), one_task_rows), "forest")
    return connect_trees(points, forest, core_distances(neighbours, k), cell_rows)


def density_clusters(
    points: DataFrame, min_cluster_size: int, neighbours: DataFrame | None = None, cell_rows: int = CELL_ROWS,
    one_task_rows: int = ONE_TASK_ROWS, pairs: DataFrame | None = None,
) -> DataFrame:
    """Density clusters of ``(id, embedding)`` as ``(id, topic)``, outliers -1.

    ``neighbours`` can be a neighbour graph of at least ``min_cluster_size`` ranks made before, ``pairs`` its undirected pairs.
    """
    if neighbours is None:
        neighbours = materialize(knn_graph(points, min_cluster_size, cell_rows=cell_rows), "neighbours")
    forest = spanning_tree(points, neighbours, min_cluster_size, cell_rows, one_task_rows, pairs)
    return renumber(cluster_forest(points, forest, min_cluster_size, one_task_rows))
