import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import odd_docs
from pyspark.sql import types as T

from themeloom.llm import collocations as c

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_count, top):
    """The collocations of ``(lang, text)`` rows by counting every phrase."""
    counts, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    wanted = {p: f for p, f in counts.items() if len(p[1]) > 1 and f >= min_count}
    gone = set()
    for (lang, p), f in wanted.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                if f >= counts[lang, p[i : i + size]]:
                    gone.add((lang, p[i : i + size]))
    out = []
    for (lang, p), a in wanted.items():
        if (lang, p) not in gone:
            cuts = [(counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p))]
            score, _, l, r = min((1000 * a * n[lang] // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
            out.append((lang, " ".join(p), a, l, r, n[lang], score))
    ranked = []
    for lang in n:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(x[0], i + 1, *x[1:]) for i, x in enumerate(own[:top])]
    return sorted(ranked)


def random_rows():
    rng = random.Random(3)
    words = ["The", "the", "naïve", "漢", "x", "y-z", "İ", "\x00", "new", "york", "city"]
    rows = []
    for _ in range(150):
        text = "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", ". ", "\n", " ", " "]) for _ in range(rng.randrange(60)))
        rows.append((rng.choice([None, "en", "de", "und"]), text + " New York city" * rng.randrange(3)))
    return rows + [("fr", None), (None, ""), ("fr", " .. \n"), ("en", "same words " * 200)]


@pytest.mark.parametrize("broadcast_rows", [c.VOCABULARY_ROWS, 0])
def test_collocations_equal_plain_counting(spark, broadcast_rows):
    rows = random_rows()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, text string, phrase string, n int").repartition(3)
    got = c.collocations(docs, min_count=4, top=50, broadcast_rows=broadcast_rows)
    assert sorted(map(tuple, got.collect())) == plain(rows, 4, 50)


def test_windows_without_the_broadcast_pairs_are_the_same(spark, monkeypatch):
    rows = random_rows()
    docs = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(c, "BROADCAST_ROWS", -1)
    assert sorted(map(tuple, c.collocations(docs, min_count=4, top=50).collect())) == plain(rows, 4, 50)


def test_collocations_of_odd_and_empty_tables(spark):
    docs = odd_docs(spark)
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, c.collocations(docs, min_count=2).collect())) == plain(rows, 2, c.TOP)
    none = spark.createDataFrame([], T.StructType([T.StructField("lang", T.StringType()), T.StructField("text", T.StringType())]))
    assert c.collocations(none).collect() == []


def test_words_of_rows_do_not_run_together():
    words, rows, leads = c.words_of(pa.array(["ab", "cd E", "", "f.g h"]))
    assert words.to_pylist() == ["ab", "cd", "e", "f", "g", "h"]
    assert rows.tolist() == [0, 1, 1, 3, 3, 3] and leads.tolist() == [True, True, False, True, True, False]


def test_lead_windows_end_at_pairs_that_are_not_allowed():
    stream = np.array([0, 1, 2, 3, 0, 1, 2], np.int32)
    columns = c.lead_windows(stream, 3, np.array([1 << 32 | 2]))
    assert [x.tolist() for x in columns] == [[1, 1], [2, 2], [0, 0]]
    assert [x.tolist() for x in c.lead_windows(stream, 3, least=3)] == [[1], [2], [3]]
