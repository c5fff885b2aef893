import math

import numpy as np
import pytest

from themeloom.operators import coherence, density, neighbours
from themeloom.plans import tuning


def brute(texts, words, size, measure):
    if measure == "u_mass":
        units = [set(t) for t in texts]
    else:
        units = [set(t[i:i + size]) for t in texts for i in range(max(1, len(t) - size + 1))]
    n = len(units)
    known = [w for w in words if any(w in u for u in units)]
    p = {(a, b): sum(a in u and b in u for u in units) / n for a in known for b in known}
    pmi = {(a, b): math.log((p[a, b] + 1e-12) / (p[a, a] * p[b, b])) for a, b in p}
    pairs = [(known[i], known[j]) for i in range(len(known)) for j in range(i)]
    if measure == "u_mass":
        return np.mean([math.log((p[a, b] + 1e-12) / p[b, b]) for a, b in pairs])
    if measure == "c_uci":
        return np.mean([pmi[x] for x in pairs])
    npmi = {x: pmi[x] / -math.log(p[x] + 1e-12) for x in p}
    if measure == "c_npmi":
        return np.mean([npmi[x] for x in pairs])
    m = np.array([[npmi[a, b] for b in known] for a in known])
    total = m.sum(0)
    return np.mean([v @ total / np.linalg.norm(v) / np.linalg.norm(total) for v in m])


@pytest.mark.parametrize("measure", ["c_v", "c_npmi", "c_uci", "u_mass"])
def test_measures_against_unrolled_windows(spark, measure):
    rng = np.random.default_rng(1)
    texts = [[f"w{x}" for x in rng.integers(0, 14, n)] for n in (0, 1, 5, 9, 10, 11, 60, 150, 260)]
    topics = {0: [f"w{i}" for i in range(6)] + ["absent"], 1: [f"w{i}" for i in range(5, 14)]}
    tokens = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, tokens array<string>")
    terms = spark.createDataFrame(
        [(t, r + 1, w) for t, ws in topics.items() for r, w in enumerate(ws)], "topic int, rank int, term string"
    )
    got = {r.topic: r.coherence for r in coherence.topic_coherence(tokens, terms, measure).collect()}
    for t, ws in topics.items():
        assert got[t] == pytest.approx(brute(texts, ws, coherence.WINDOW.get(measure), measure), abs=1e-9)
    with pytest.raises(ValueError):
        coherence.topic_coherence(tokens, terms, "other")


def test_too_few_topics(spark):
    one = spark.createDataFrame([(0, 0.4)], "topic int, coherence double")
    assert math.isnan(coherence.model_coherence(one, float("nan")).head()[0])
    assert coherence.model_coherence(one, 0.0).head()[0] == 0.0


def grid(spark, n, trials):
    df = spark.createDataFrame([(n,)], "n bigint")
    return [r.min_cluster_size for r in tuning.trial_grid(df, trials).collect()]


def test_trial_grid(spark):
    assert grid(spark, 20, 10) == [4, 5, 6, 7, 8, 9]
    assert grid(spark, 200, 10) == list(range(5, 15))
    assert grid(spark, 1361, None) == list(range(13, 30))
    assert grid(spark, 1361, 15) == [*range(13, 20), *range(21, 28), 29]
    assert grid(spark, 10_000, 1) == [20]


def test_best_trial_and_ties(spark):
    nan = float("nan")
    # Part of a recorded tuning report, with its tie at 24 and 25
    report = [(13, 0.583422670789254), (24, 0.6146801418657843), (25, 0.6146801418657843), (29, 0.624026423814915)]
    df = spark.createDataFrame(report, "min_cluster_size int, coherence_score double")
    assert tuple(tuning.best_trial(df).head()) == (29, 0.624026423814915)
    tied = df.filter("min_cluster_size < 29")
    assert tuple(tuning.select_min_cluster(tied).head()) == (24, 0.6146801418657843)
    none = spark.createDataFrame([(7, nan), (5, nan)], "min_cluster_size int, coherence_score double")
    assert tuple(tuning.select_min_cluster(none).head()) == (5, 0.0)
    mixed = spark.createDataFrame([(9, 0.1), (5, nan), (7, 0.2)], "min_cluster_size int, coherence_score double")
    assert tuning.valid_sizes(mixed).head()[0] == [7, 9]


def test_trials_share_the_pairs_of_the_neighbour_graph(spark, monkeypatch):
    rng = np.random.default_rng(7)
    points = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(60, 3)))], "id bigint, embedding array<double>")
    near = neighbours.knn_graph(points, 6).cache()
    pairs = neighbours.undirected_pairs(near).cache()
    alone = [sorted(map(tuple, density.density_clusters(points, k, near).collect())) for k in (3, 5)]
    monkeypatch.setattr(neighbours, "undirected_pairs", None)  # made for every trial before
    assert [sorted(map(tuple, density.density_clusters(points, k, near, pairs=pairs).collect())) for k in (3, 5)] == alone
