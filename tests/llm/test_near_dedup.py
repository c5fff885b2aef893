"""Rows that the near-dedup stage keeps, where ids are missing or repeated."""

from collections import Counter

from themeloom.llm import simhash

from helpers import odd_docs


def kept_texts(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row_number string").repartition(3)
    out = simhash.one_of_each(docs)
    assert out.columns == docs.columns
    return Counter((r.doc_id, r.text) for r in out.collect())


def test_rows_without_id_and_repeated_ids(spark):
    a, b, c, d = (" ".join(f"{name}{i}" for i in range(40)) for name in "pqrs")
    rows = [
        (5, a), (None, a), (None, b),  # a copy without id goes, the other row without id stays
        (7, c), (3, c), (7, d),  # one text of a repeated id goes, its other text stays
        (None, "x y z"), (None, "x y z"), (1, "u v w"), (1, "u v w"),  # repeated rows are one
    ]
    kept = kept_texts(spark, [(*r, "k") for r in rows])
    assert kept == Counter([(5, a), (None, b), (3, c), (7, d), (None, "x y z"), (1, "u v w")])


def test_odd_rows_keep_one_of_each_component(spark):
    docs = odd_docs(spark)
    kept = simhash.one_of_each(docs).collect()
    fps = [simhash.fingerprint(r.text or "") for r in docs.collect()]
    root = list(range(len(fps)))
    for _ in fps:  # smallest position that is reached
        root = [min(root[j] for j in range(len(fps)) if bin(fps[i] ^ fps[j]).count("1") <= 3) for i in range(len(fps))]
    assert len(kept) == len(set(root))
    found = {simhash.fingerprint(r.text or "") for r in kept}
    assert len(found) == len(kept)
    assert {r.doc_id for r in kept if r.text and r.text.startswith("Third: ends here")} == {None}
    assert simhash.one_of_each(odd_docs(spark, [])).count() == 0
