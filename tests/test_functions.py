import re

from pyspark.sql import functions as F

from themeloom.functions import text as X
from themeloom.functions import words as W


def one(spark, values, expr, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr).collect()]


def python_clean(text):
    if text is None:
        return ""
    for pattern, to, flags in (
        ("©.*", "", 0), ("Keywords?:.*", "", re.I), (r"[^\x00-\x7F]+", " ", 0), (r"\s+", " ", 0)
    ):
        text = re.sub(pattern, to, text, flags=flags)
    return text.strip()


def test_clean_text_matches_the_rule(spark):
    texts = [
        "Plain", "", None, "  two   spaces\t\ttab ", "kept © gone\nnext line", "a KEYWORDS: x, y\nb keyword: z",
        "café naïve über", "\x1c odd \x0b spaces \x1f", "no keyword here", "Keywords : not a tail", "日本語 text",
        "Keywords: kelvin", "line\r\nbreak", "::keyWord:: tail © x",
    ]
    assert one(spark, texts, X.clean_text(F.col("x"))) == [python_clean(t) for t in texts]
    assert one(spark, [None], X.clean_text(F.col("x"), "nan")) == ["nan"]


def test_tokens_delete_instead_of_splitting(spark):
    texts = ["State-of-the-art don't x2y THE end", "", "of the", "no break space cafés"]
    assert one(spark, texts, X.tokens(F.col("x"), ["the"])) == [
        ["stateoftheart", "dont", "end"], [], [], ["break", "space", "cafs"]
    ]


def test_title_case_follows_python(spark):
    texts = ["state-of-the-art", "don't stop", "3d models", "ALL caps", ""]
    assert one(spark, texts, X.title_case(F.col("x"))) == [t.title() for t in texts]


def test_word_counts(spark):
    texts = ["a b  c", " lead\n and tail ", "", "one"]
    assert one(spark, texts, X.count_words(F.col("x"))) == [len(t.split()) for t in texts]
    assert one(spark, texts, X.whitespace_words(F.col("x"))) == [t.split() for t in texts]


def test_jaccard(spark):
    df = spark.createDataFrame(
        [(["w1", "w2"], ["w1", "w3"]), ([], ["a"]), (["a"], None), (["a", "a"], ["a"])], "a array<string>, b array<string>"
    )
    got = [r[0] for r in df.select(W.jaccard(F.col("a"), F.col("b"))).collect()]
    assert got == [1 / 3, 0.0, 0.0, 1.0]


def test_representation_of_every_type(spark):
    df = spark.createDataFrame(
        [("5a, b ,B", ["x1", "X1", " y "], [("word", 0.5), ("Word", 0.4), ("other", 0.1)], 7), (None, None, None, None)],
        "s string, a array<string>, p array<struct<w:string,v:double>>, n int",
    )
    got = df.select(*[W.representation_words(df, c).alias(c) for c in df.columns]).collect()
    assert list(got[0]) == [["5a", "b"], ["x1", "y"], ["word", "other"], ["7"]]
    assert list(got[1]) == [[], [], [], []]


def test_labels_and_names(spark):
    rows = [
        (0, ["learning algorithms applications", "machine learning including", "machine learning fundamentals", "predictive analytics", "machine learning"]),
        (1, ["data", "system", "study", "alpha", "beta", "gamma"]), (2, []), (-1, ["a"]),
    ]
    df = spark.createDataFrame(rows, "topic int, words array<string>")
    got = df.select(
        W.simple_label(F.col("topic"), F.col("words")), W.default_name(F.col("topic"), F.col("words"))
    ).collect()
    assert got[0][0] == "Learning Algorithms Applications Machine Learning Including Machine Learning Fundamentals Predictive Analytics"
    assert got[1][0] == "Data System Study Alpha"
    assert got[2][0] == "Topic 2"
    assert got[3][0] is None
    assert got[1][1] == "1_data_system_study_alpha"


def test_external_label(spark):
    assert one(spark, ["  \"It's\" good "], W.clean_external_label(F.col("x"))) == ["Its good"]
