import numpy as np
import pytest
from pyspark.sql import functions as F

from themeloom.operators import density, forest, neighbours, vectors
from themeloom.operators.assign import nearest_topics


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(3)
    return np.vstack([
        rng.normal(0, 0.3, (40, 3)), rng.normal(5, 0.3, (25, 3)), rng.normal([0, 8, 0], 0.3, (15, 3)),
        rng.uniform(-15, 15, (10, 3)),
    ])


@pytest.fixture(scope="module")
def points(spark, cloud):
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(cloud)]
    return spark.createDataFrame(rows, "id bigint, embedding array<double>")


def brute_knn(p, k, digits=9):
    d = np.round(np.sqrt(((p[:, None] - p[None]) ** 2).sum(-1)), digits)
    return {
        (i, r + 1): (j, d[i, j]) for i in range(len(p))
        for r, j in enumerate(sorted((j for j in range(len(p)) if j != i), key=lambda j: (d[i, j], j))[:k])
    }


def as_map(df):
    return {(r.src, r["rank"]): (r.dst, r.distance) for r in df.collect()}


def test_neighbours_are_exact_with_many_cells(spark, cloud, points, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 7)  # several blocks per cell
    got, want = as_map(neighbours.knn_graph(points, 5, cell_rows=12)), brute_knn(cloud, 5)
    assert got.keys() == want.keys()
    assert all(got[i][0] == want[i][0] and abs(got[i][1] - want[i][1]) < 1e-8 for i in want)


def test_many_copies_of_one_vector(spark):
    p = np.array([[1.0, 1.0]] * 60 + [[float(i), 0.0] for i in range(20)])
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(p)], "id bigint, embedding array<double>")
    assert as_map(neighbours.knn_graph(df, 4, cell_rows=5)) == brute_knn(p, 4)


def test_nearest_points_between_tables(spark, cloud, points):
    queries = points.filter("id % 3 = 0").select((F.col("id") + 1000).alias("id"), "embedding")
    got = as_map(neighbours.nearest_points(queries, points, 2, cell_rows=10))
    assert all(got[(1000 + i, 1)] == (i, 0.0) for i in range(0, 90, 3))


def forest_weight(cloud, k):
    d = np.sqrt(((cloud[:, None] - cloud[None]) ** 2).sum(-1))
    core = np.sort(d, axis=1)[:, k]
    w = np.maximum(np.maximum(core[:, None], core[None]), d)
    seen, best, total = {0}, w[0].copy(), 0.0
    while len(seen) < len(d):
        i = min((i for i in range(len(d)) if i not in seen), key=lambda i: best[i])
        total += best[i]
        seen.add(i)
        best = np.minimum(best, w[i])
    return total


def test_forest_in_rounds_equals_one_task_and_brute_force(spark, cloud, points):
    edges = neighbours.mutual_reachability(neighbours.knn_graph(points, 89).cache(), 5)
    small = sorted(map(tuple, forest.minimum_spanning_forest(edges).collect()))
    rounds = sorted(map(tuple, forest.minimum_spanning_forest(edges, 0).collect()))
    assert small == rounds and len(small) == 89
    assert abs(sum(e[2] for e in small) - forest_weight(cloud, 5)) < 1e-6


def test_clusters_of_planted_blobs(spark, points):
    near = neighbours.knn_graph(points, 8).cache()
    tree = density.spanning_tree(points, near, 8)
    one = density.renumber(density.cluster_forest(points, tree, 8))
    topics = [r.topic for r in one.orderBy("id").collect()]
    for part, topic in ((topics[:40], 0), (topics[40:65], 1), (topics[65:80], 2)):
        assert set(part) == {topic}
    pieces = density.renumber(density.cluster_forest(points, tree, 8, one_task_rows=16))
    assert [r.topic for r in pieces.orderBy("id").collect()] == topics


def prim(x, k):
    """Edges of the spanning tree of the complete mutual-reachability graph."""
    d = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), 9)
    core = np.sort(d, axis=1)[:, k]
    w = np.maximum(np.maximum(core[:, None], core[None]), d)
    inside, best, via, edges = [0], w[0].copy(), np.zeros(len(x), int), []
    best[0] = np.inf
    for _ in range(len(x) - 1):
        i = int(best.argmin())
        edges.append((min(i, int(via[i])), max(i, int(via[i])), float(best[i])))
        inside.append(i)
        nearer = w[i] < best
        nearer[inside] = False
        best[nearer], via[nearer] = w[i][nearer], i
        best[inside] = np.inf
    return edges


def blobs(seed, far, sizes=(25, 25, 25, 25)):
    """Pairs of blobs, the pairs ``far`` apart, so that the neighbour graph falls apart."""
    rng = np.random.default_rng(seed)
    centres = [(0, 0), (1.5 + rng.random(), 0), (far, far), (far + 1.5 + rng.random(), far)]
    return np.vstack([rng.normal(c, 0.25 + 0.1 * rng.random(), (n, 2)) for c, n in zip(centres, sizes)])


@pytest.mark.parametrize("seed, far, cell_rows", [(1, 60, 1024), (2, 60, 10), (3, 8, 20), (4, 300, 15)])
def test_trees_of_a_disconnected_graph_are_joined(spark, seed, far, cell_rows):
    x = blobs(seed, far)
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(x)], "id bigint, embedding array<double>")
    near = neighbours.knn_graph(df, 8, cell_rows=cell_rows).cache()
    tree = density.spanning_tree(df, near, 8, cell_rows).collect()
    full = prim(x, 8)
    assert len(tree) == len(x) - 1
    assert sorted(r.w for r in tree) == pytest.approx(sorted(e[2] for e in full), abs=1e-9)
    if seed < 3:  # the clusters of the complete graph's tree
        complete = spark.createDataFrame(full, "u bigint, v bigint, w double")
        want = density.renumber(density.cluster_forest(df, complete, 8)).orderBy("id").collect()
        got = density.renumber(density.cluster_forest(df, spark.createDataFrame(tree), 8)).orderBy("id").collect()
        assert [r.topic for r in got] == [r.topic for r in want]


def test_copies_in_a_tree_of_their_own(spark):
    rows = [(i, [0.0, 0.0]) for i in range(30)] + [(30 + i, [5.0 + i % 5, float(i // 5)]) for i in range(25)]
    df = spark.createDataFrame(rows, "id bigint, embedding array<double>")
    tree = density.spanning_tree(df, neighbours.knn_graph(df, 5).cache(), 5).collect()
    assert len(tree) == 54
    assert sum(r.w for r in tree) == pytest.approx(sum(e[2] for e in prim(np.array([r[1] for r in rows]), 5)))


def test_noise_only(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.uniform(0, 1, 4)]) for i in range(20)]
    df = spark.createDataFrame(rows, "id bigint, embedding array<double>")
    assert {r.topic for r in density.density_clusters(df, 15).collect()} == {-1}


def test_selection_by_levels_equals_one_task(spark):
    rows = [(9, -1, 100, 0.0, 1.0, True), (7, 9, 60, 1.0, 5.0, False), (8, 9, 40, 1.0, 9.0, False),
            (5, 7, 30, 2.0, 4.0, False), (6, 7, 30, 2.0, 3.0, False), (3, 8, 20, 2.0, 4.0, False), (4, 8, 20, 2.0, 4.0, False)]
    tree = spark.createDataFrame(
        rows, "cluster bigint, parent bigint, size bigint, birth double, stability double, is_root boolean"
    )
    want = {9: -1, 7: -1, 8: 8, 5: 5, 6: 6, 3: 8, 4: 8}
    for limit in (1000, 1):
        assert {r.cluster: r.selected for r in density.select_clusters(tree, limit).collect()} == want


def test_hash_encoder_and_pca(spark):
    df = spark.createDataFrame([(1, ["aa", "bb", "aa"]), (2, []), (3, ["bb"])], "doc_id bigint, tokens array<string>")
    out = {r.doc_id: np.array(r.embedding) for r in vectors.embed(df, "tokens").collect()}
    assert abs(np.linalg.norm(out[1]) - 1) < 1e-12 and not out[2].any() and len(out[3]) == 64
    own = vectors.embed(df, "tokens", lambda s: np.array([[float(len(t)), 1.0] for t in s]))
    assert {r.doc_id: r.embedding for r in own.collect()}[1] == [3.0, 1.0]
    assert len(vectors.reduce_pca(vectors.embed(df, "tokens")).head().embedding) == 5


def test_blocks_of_topics_change_nothing(spark, points):
    from themeloom.operators import assign

    zero = spark.createDataFrame([(900, [0.0] * len(points.head()["embedding"]))], "id bigint, embedding array<double>")
    docs = points.select("id", "embedding").unionByName(zero).selectExpr("concat('d', id) as doc_id", "embedding")
    centres = points.filter("id < 12").select(F.col("id").cast("int").alias("topic"), F.col("embedding").alias("centroid"))
    centres = centres.unionByName(centres.filter("topic = 3").withColumn("topic", F.lit(40)))  # a tie
    centres = centres.unionByName(zero.select(F.lit(50).alias("topic"), F.col("embedding").alias("centroid")))
    one, many = (sorted(map(tuple, nearest_topics(docs, centres, block_numbers=n).collect())) for n in (10**6, 1))
    assert one == many and len(one) == docs.count()
    assert ("d900", 0, 0.0) in one and not [r for r in one if r[1] == 40]
    one, many = (
        {(r.doc_id, r.topic): r.prob for r in assign.topic_probabilities(docs, centres, block_numbers=n).collect()} for n in (10**6, 7)
    )
    assert set(one) == set(many) and all(abs(one[k] - many[k]) < 1e-12 for k in one)
    assert len(one) == docs.count() * 14
    assert {r.topic for r in nearest_topics(docs, centres.limit(0)).collect()} == {-1}
    assert assign.topic_probabilities(docs, centres.limit(0)).count() == 0
