"""Column functions on long texts and odd white space."""

import time

from pyspark.sql import functions as F

from themeloom.functions import text as X
from themeloom.functions import words as W


def test_count_words_is_the_number_of_words(spark):
    breaks = ["", " ", "\t", "\u00a0", "  \n", "\x1c", "\u3000", "\u2003 ", "\u200b", "$1", "\x85"]
    texts = [None] + [f"{a}one{b}two{c}" for a in breaks for b in breaks for c in breaks] + breaks
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = rows.select("t", X.count_words(F.col("t")).alias("n"), X.whitespace_words(F.col("t")).alias("w")).collect()
    for r in found:
        words = None if r.t is None else r.t.split()
        assert (r.n, r.w) == (None if words is None else len(words), words)
    plan = rows.select(X.count_words(F.col("t")))._jdf.queryExecution().toString()
    assert "extract_all" not in plan  # kept every word in an array


def test_first_spellings_keep_order_and_drop_nulls(spark):
    rows = spark.createDataFrame([(["b", "A", None, "a", "B ", "b", "", "B"],), ([],), (None,)], "w array<string>")
    got = [r.x for r in rows.select(W.representation_words(rows, "w").alias("x")).collect()]
    assert got == [["b", "A", "B", ""], [], []]


def test_representation_of_a_long_text_is_not_quadratic(spark):
    words = F.transform(F.sequence(F.lit(1), F.lit(60_000)), lambda i: F.concat(F.lit("Word"), (i % 30_000).cast("string")))
    rows = spark.range(1).select(words.alias("w"))
    started = time.monotonic()
    assert rows.select(F.size(W.representation_words(rows, "w"))).head()[0] == 30_000
    assert time.monotonic() - started < 60
