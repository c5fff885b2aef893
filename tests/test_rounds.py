"""Clusterings take few written tables, and the same result whichever way ranges and remainders are solved."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from themeloom import session
from themeloom.operators import density, forest


@pytest.fixture(scope="module")
def tree():
    """A random tree of 400 vertices with some equal weights."""
    rng = np.random.default_rng(7)
    ends = [(int(rng.integers(0, i)), i, float(rng.integers(1, 90))) for i in range(1, 400)]
    return ends


def _counting(monkeypatch):
    written = []
    for module in (forest, density):
        plain = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, name="table", plain=plain: written.append(name) or plain(df, name))
    return written


def _parts(labels):
    groups = {}
    for r in labels.collect():
        groups.setdefault(r.root, set()).add(r.a)
    return sorted(map(sorted, groups.values()))


def test_a_long_chain_takes_three_tables(spark, monkeypatch):
    chain = spark.range(500).selectExpr("id as a", "id + 1 as b").unionByName(spark.range(3).selectExpr("1000 + id as a", "2000 as b"))
    written = _counting(monkeypatch)
    found = _parts(forest.components(chain))
    assert len(written) <= 3
    assert found == [list(range(501)), [1000, 1001, 1002, 2000]]


def test_components_by_rounds_and_in_one_task(spark):
    rng = np.random.default_rng(5)
    edges = spark.createDataFrame([tuple(map(int, p)) for p in rng.integers(0, 300, (200, 2))], "a bigint, b bigint")
    one = _parts(forest.components(edges))
    assert _parts(forest.components(edges, 0)) == one
    assert _parts(forest.components(edges, 40)) == one
    assert forest.components(edges.limit(0)).count() == 0


def test_ranges_are_contracted_in_two_tables_each(spark, tree, monkeypatch):
    edges = spark.createDataFrame(tree, "u bigint, v bigint, w double")

    def merges(rows):
        found = density.merge_tree(edges, 4, rows).select("edge", "w", F.least("left_size", "right_size"), "up", "res", "top")
        return sorted(map(tuple, found.collect()))

    whole = merges(1000)
    with monkeypatch.context() as m:
        m.setattr(density, "ONE_TASK_ROWS", 64)  # larger ranges all at once
        assert merges(16) == whole
    written = _counting(monkeypatch)
    assert merges(16) == whole
    assert len([n for n in written if n != "links"]) <= 2 * 5 + 2  # 399 ranks are halved five times


def test_written_tables_are_packed_with_zstd(spark):
    table = session.materialize(spark.range(10), "packed")
    assert all(".zstd." in f for f in table.inputFiles()) and table.count() == 10
