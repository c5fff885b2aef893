"""What is written and sent on the way stays in proportion to the input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from themeloom.operators import coherence, neighbours, rerank, terms
from themeloom.plans import fit


@pytest.fixture
def written(monkeypatch):
    """Rows of every table that the named modules write, by name."""
    found = {}

    def watch(*modules):
        for module in modules:
            keep = module.materialize

            def noted(df, name="table", keep=keep):
                out = keep(df, name)
                found[name] = max(found.get(name, 0), out.count())
                return out

            monkeypatch.setattr(module, "materialize", noted)
        return found

    return watch


def test_neighbours_of_even_points_are_not_written_once_a_cell(spark, written):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(400, 16))
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id bigint, embedding array<double>")
    rows = written(neighbours)
    got = {(r["src"], r["rank"]): (r["dst"], r["distance"]) for r in neighbours.knn_graph(points, 4, cell_rows=20).collect()}
    assert max(rows.values()) <= 5 * 400  # the k + 1 nearest in the own cell
    distances = np.round(np.sqrt(((vectors[:, None] - vectors[None]) ** 2).sum(2)), 9)
    for i, row in enumerate(distances):
        best = [j for j in np.lexsort((np.arange(400), row)) if j != i][:4]
        assert [got[(i, r + 1)] for r in range(4)] == [(j, pytest.approx(row[j])) for j in best]


def test_tiles_hold_near_cells_up_to_their_size():
    pivots = np.array([[0.0, 0], [10, 0], [0.1, 0], [10.1, 0]])
    tile = neighbours._tiles(pivots, np.array([5, 5, 5, 5]), 10)
    assert tile[0] == tile[2] != tile[1] == tile[3]
    assert len(set(neighbours._tiles(pivots, np.array([5, 5, 5, 50]), 10).tolist())) == 3


def _topic_tokens(spark):
    rows = [
        (0, 0, "ant bee ant cow".split()), (1, 0, "bee bee dog".split()), (2, 1, "ant dog dog elk".split()),
        (3, 1, []), (4, 2, []), (5, -1, "elk fox".split()), (6, 1, ["ant"]),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, topic int, tokens array<string>")


def test_weighted_rows_hold_weights_and_scores(spark):
    own = _topic_tokens(spark)
    rows = terms.weighted_rows(own)
    weights = terms.ctfidf(terms.class_tf(own))
    flat = lambda df: [x for row in sorted(map(tuple, df.collect())) for x in row if not isinstance(x, str)]
    assert len(flat(weights)) == 27 and flat(terms.row_weights(rows)) == pytest.approx(flat(weights))
    assert flat(terms.row_scores(rows)) == pytest.approx(flat(terms.representative_scores(own, weights)))


def test_description_writes_tokens_not_ngrams(spark, written, monkeypatch):
    own = _topic_tokens(spark)
    vectors = own.select("doc_id", F.array(F.lit(1.0), F.col("doc_id").cast("double")).alias("embedding"))
    docs = own.select("doc_id", F.array_join("tokens", " ").alias("doc"))
    parts = fit.Components(docs, own.select("doc_id", "tokens"), vectors, vectors, vectors, 0, 0)
    arrays = []
    keep = fit.materialize

    def noted(df, name="table"):
        if "tokens" in df.columns:
            arrays.append(df.agg(F.sum(F.size("tokens"))).head()[0])
        return keep(df, name)

    monkeypatch.setattr(fit, "materialize", noted)
    fit.describe_topics(parts, own.select("doc_id", "topic"))
    assert arrays == [14]  # the tokens of all documents, without their runs


def test_only_candidate_terms_meet_vectors(spark):
    own = _topic_tokens(spark)
    vectors = own.select("doc_id", F.array(F.lit(1.0), F.col("doc_id").cast("double")).alias("embedding"))
    best = spark.createDataFrame([(0, 0), (1, 2)], "topic int, doc_id bigint")
    candidates = spark.createDataFrame([(0, "ant"), (1, "dog")], "topic int, term string")
    joined = []
    mean = rerank._mean_vector
    try:
        rerank._mean_vector = lambda df, *keys: (joined.append((keys, df)), mean(df, *keys))[1]
        rerank.rerank_keywords(candidates, own.select("doc_id", "tokens"), vectors, best).collect()
    finally:
        rerank._mean_vector = mean
    rows = next(df for keys, df in joined if keys == ("term",))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    # the join with the candidates lies below the join with the vectors
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert "doc_id" in joins[0] and "term" in joins[1]


def test_window_pairs_are_neither_sorted_nor_sent(spark, monkeypatch):
    rng = np.random.default_rng(5)
    texts = [(int(i) // 2 if i < 6 else int(i), [f"w{x}" for x in rng.integers(0, 12, rng.integers(0, 40))]) for i in range(30)]
    texts.append((None, ["w1", "w2"]))  # ids may repeat or be missing: such rows are one document, as before
    docs = spark.createDataFrame(texts, "doc_id bigint, tokens array<string>")
    words = [(t, r + 1, f"w{(3 * t + r) % 12}") for t in (-1, 0, 1, 2) for r in range(5)] + [(3, 1, "unknown")]
    listed = spark.createDataFrame(words, "topic int, rank int, term string")
    plain = coherence._joined_unions(docs, coherence._scored_terms(listed, 4), 7)
    monkeypatch.setattr(coherence, "PAIR_ROWS", 40)
    found = coherence.window_unions(docs, listed, 7, 4)
    assert found.schema["rank_a"].dataType == plain.schema["rank_a"].dataType
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
