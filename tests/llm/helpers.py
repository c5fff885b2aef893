"""Small tables with every odd case, and plain versions of what the operators compute."""

import re
from collections import Counter

from pyspark.sql import types as T

WORDS = re.compile(r"[^\x20\x09-\x0D]+")

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    # names that the operators use for their own columns
    *(T.StructField(n, T.StringType()) for n in ("start", "score", "_gone", "_key", "shard", "fp", "kept", "ids", "bucket", "h1")),
])


def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    lines = ["The first line of a text that is long enough.", "Another line with ordinary words, long enough.", "Third: ends here with some words too."]
    long = " ".join(f"word{i % 997} and{i % 31}" for i in range(30_000))
    texts = [
        (1, "\n".join(lines)), (2, "\n".join(lines)), (2, "\n".join(lines)), (3, lines[0] + "\n" + lines[1].replace("words", "wards")),
        (4, ""), (5, None), (None, None), (None, lines[2]), (6, " \t\n\x0b\f\r "), (7, long), (8, "\n\n\n"), (9, "a"),
        (10, "<|endoftext|> naïve 漢字 😀 \x00 don't  two   blanks\r\n"), (11, "same words " * 40), (12, "#" * 500 + " " + "|" * 50),
        (9, "another text of the same id, which is long enough"), (13, "ﬁ x y ▁z"), (14, "A B C D E F G H I J K"),
    ]
    return [(i, t, None if k % 5 == 0 else "en", *["x"] * 10) for k, (i, t) in enumerate(texts)]


def odd_docs(spark, rows=None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, DOCS).repartition(3)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def base_measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


def smallest_reachable(ids, linked):
    """The smallest id that each id reaches; ``linked(i, j)`` takes positions."""
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        least[r] = min(x for x in (least.get(r), d) if x is not None) if (d is not None or r in least) and not (d is None and least.get(r) is None) else None
    return [least[find(i)] for i in range(len(ids))]
