import glob
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow.parquet as pq

from themeloom.llm import collocations as c


def test_windows_travel_packed_and_end_where_they_are_rare(spark):
    rng = np.random.default_rng(11)
    streams = [np.append(rng.integers(0, 6, 900), 0).astype("<i4") for _ in range(5)]
    for s in streams:
        for at in range(0, 880, 50):
            s[at : at + 4] = [1, 2, 3, 4]
    table = spark.createDataFrame([(s.tobytes(),) for s in streams], "stream binary")
    plain = Counter()
    for s in streams:
        for at in range(len(s)):
            for k in range(3, 6):
                if at + k <= len(s) and (s[at : at + k] > 0).all():
                    plain[tuple(s[at : at + k].tolist())] += 1
    wanted = {k: v for k, v in plain.items() if v >= 15}
    found, rows = Counter(), 0
    for r in c.window_counts(table, 5, 15, least=3, bucket_words=100).collect():
        ids = [x for x in r[:5] if x]
        rows += 1
        for k in range(3, len(ids) + 1):
            found[tuple(ids[:k])] += r.n
    assert {len(k) for k in wanted} >= {3, 4} and rows <= len(wanted)  # every window was a row before
    assert found == wanted


def test_no_windows(spark):
    table = spark.createDataFrame([(b"",), (np.zeros(3, "<i4").tobytes(),)], "stream binary")
    assert c.window_counts(table, 5, 2, least=3).count() == 0
    assert c.window_counts(table.limit(0), 2, 2).count() == 0


def test_a_full_bucket_is_counted_in_bounded_memory():
    rng = np.random.default_rng(12)
    records = []
    for _ in range(40):
        words = (rng.zipf(1.3, c.BUCKET_WORDS // 40) % 40_000 + 1).astype("<i4")
        columns, n = c._summed(c.lead_windows(words, 5, least=3))
        records += [(record, size) for _, size, record in c._dealt(columns, n, 3, 1)]
    tracemalloc.start()
    columns, n = c._shortened(*c._added_up(iter(records), 5), 3, 100)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(n) and (n >= 100).all() and peak < 300 << 20  # some 1,100 MB for the bucket of before


def test_windows_are_added_up_in_parts(monkeypatch):
    rng = np.random.default_rng(13)
    streams = [rng.integers(1, 5, 200).astype("<i4") for _ in range(6)]
    records = [(r, size) for s in streams for _, size, r in c._dealt(*c._summed(c.lead_windows(s, 4)), 2, 1)]
    monkeypatch.setattr(c, "ADDED_ROWS", 10)
    columns, n = c._added_up(iter(records), 4)
    plain = Counter(w for s in streams for w in zip(*(x.tolist() for x in c.lead_windows(s, 4))))
    assert list(zip(*(x.tolist() for x in columns), n.tolist())) == sorted((*w, k) for w, k in plain.items())
    assert c._added_up(iter([]), 4)[1].tolist() == []


def test_rows_of_whole_batches_are_written_in_small_row_groups(spark, monkeypatch):
    docs = spark.createDataFrame([("one long text " * 100_000, "en")] * 30, "text string, lang string").coalesce(1)
    monkeypatch.setattr(c, "spread", lambda df: df)  # as with a large table: many batches in one file
    at = c.numbered_batches(docs).inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    metadata = pq.ParquetFile(glob.glob(f"{at}/*.parquet")[0]).metadata
    rows = [metadata.row_group(i).num_rows for i in range(metadata.num_row_groups)]
    assert sum(rows) > c.GROUP_ROWS and max(rows) <= c.GROUP_ROWS
