import pytest
from pyspark.sql import functions as F

from themeloom.operators import corpus, profile, tokens
from themeloom.plans.profile import profile_report
from themeloom.sources import documents, lexicons, logs

FIVE = [(i, f"Title {i}", f"Body number {i} of five") for i in range(5)]
SCHEMA = "doc_id bigint, Title string, Abstract string"


def test_preprocess_keeps_a_good_corpus(spark):
    df = spark.createDataFrame(FIVE, SCHEMA)
    out = corpus.preprocess(df)
    assert out.columns == df.columns and out.count() == 5
    assert sorted(r.doc for r in corpus.combine_docs(out).collect())[0] == "Title 0 Body number 0 of five"


def test_preprocess_drops_nulls_empties_and_copies(spark):
    rows = FIVE + [(9, "Title 1", "Body  number 1 of five"), (10, None, "x"), (11, "t", "© all gone")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r.doc_id for r in corpus.preprocess(df).collect()) == [0, 1, 2, 3, 4]
    kept = corpus.preprocess(df, null_text="nan").filter("doc_id = 10").head()
    assert kept.Title == "nan"
    extra = df.withColumn("extra", F.when(F.col("doc_id") != 3, "e"))
    assert 3 not in [r.doc_id for r in corpus.prepare(extra).collect()]


def test_too_small_and_missing_column(spark):
    with pytest.raises(ValueError, match="Minimal 5 dokumen"):
        corpus.preprocess(spark.createDataFrame([], SCHEMA))
    many_copies = spark.createDataFrame([(i, "same", "text") for i in range(300)], SCHEMA)
    with pytest.raises(ValueError):
        corpus.preprocess(many_copies)
    late = many_copies.unionByName(spark.createDataFrame([(400 + i, f"t{i}", "x") for i in range(4)], SCHEMA))
    assert corpus.preprocess(late).count() == 5
    with pytest.raises(KeyError):
        corpus.preprocess(spark.createDataFrame([("a", "b")], "Title string, Content string"))


def test_csv_round_trip(spark, tmp_path):
    rows = [("A, quoted", 'line one\nline "two"'), (" lead", "plain")]
    path = tmp_path / "docs.csv"
    path.write_text('Title,Abstract\n"A, quoted","line one\nline ""two"""\n" lead",plain\n')
    df = documents.read_documents(spark, str(path))
    assert sorted(tuple(r) for r in df.collect()) == sorted(rows)
    assert documents.default_text_column(df) == "Abstract"
    assert documents.text_columns(spark.createDataFrame([(1, 2)], "Body int, id int")) == ["Body"]
    with_ids = documents.with_doc_id(df)
    assert len({r.doc_id for r in with_ids.collect()}) == 2
    with pytest.raises(ValueError):
        documents.read_documents(spark, str(tmp_path / "nothing.csv"))
    nested = spark.createDataFrame([(0, ["a", "b"])], "topic int, representation array<string>")
    documents.write_table(nested, str(tmp_path / "info"), "csv")
    assert spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "info")).head()[1] == '["a","b"]'
    documents.write_predictions(spark.createDataFrame([("d", 1)], "doc string, topic int"), str(tmp_path / "p"))
    assert spark.read.option("header", True).csv(str(tmp_path / "p")).columns == ["Document", "Topic"]


def test_logs(spark, tmp_path):
    path = str(tmp_path / "log")
    assert logs.read_experiments(spark, path).count() == 0
    for size in (4, 5):
        logs.log_experiment(spark, path, {"size": size}, {"score": 0.5})
    rows = logs.read_experiments(spark, path).collect()
    assert sorted(r.params["size"] for r in rows) == ["4", "5"] and rows[0].metrics == {"score": 0.5}


def test_lexicons_and_lemmas(spark, tmp_path):
    (tmp_path / "exc").write_text("went go\nwas be\nodd oddity\n")
    (tmp_path / "index").write_text("  1 licence line\ngo v 1\nbe v 1\ntry v 1\nbake v 1\nwalk v 2\nas v 1\n")
    exceptions, verbs = lexicons.read_verb_lexicon(spark, str(tmp_path / "exc"), str(tmp_path / "index"))
    found = {r.word: r.lemma for r in lexicons.lemma_map(exceptions, verbs).collect()}
    for word, lemma in {"went": "go", "was": "be", "tries": "try", "baked": "bake", "baking": "bake", "walks": "walk", "goes": "go"}.items():
        assert found[word] == lemma
    assert "odd" not in found and "walk" not in found
    docs = spark.createDataFrame([(1, "She went baking, tries walks! the END"), (2, "")], "doc_id bigint, doc string")
    lemmas = lexicons.lemma_map(exceptions, verbs)
    out = {r.doc_id: r.tokens for r in tokens.simple_tokenizer(docs, "doc", ["the"], lemmas).collect()}
    assert out == {1: ["she", "go", "bake", "try", "walk", "end"], 2: []}
    assert "the" in lexicons.words_of(lexicons.read_stopwords(spark))


def test_bags_and_vocabulary(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (2, ["b"]), (3, [])], "doc_id bigint, tokens array<string>")
    assert sorted(tuple(r) for r in tokens.bag_of_words(df).collect()) == [(1, "a", 1), (1, "b", 2), (2, "b", 1)]
    assert sorted(tuple(r) for r in tokens.vocabulary(df).collect()) == [("a", 1, 1), ("b", 2, 3)]
    grams = {r.doc_id: r.tokens for r in tokens.with_ngrams(df, 1, 3).collect()}
    assert grams[1] == ["b", "a", "b", "b a", "a b", "b a b"] and grams[3] == []


def test_profile(spark):
    df = spark.createDataFrame([("t", "a b c"), ("t", "a b c"), ("u", None)], "Title string, Abstract string")
    row = profile_report(df, ["u"]).head()
    assert (row.total_records, row.duplicates, row.missing_values) == (3, 1, {"Title": 0, "Abstract": 1})
    assert row.text_statistics.mean_word_count == 3.0 and row.text_column == "Abstract"
    none = profile_report(spark.createDataFrame([(1,)], "other int")).head()
    assert none.text_statistics is None and none.top_words == []
    same = spark.createDataFrame([(i, 4) for i in range(3)], "doc_id int, n_words bigint")
    bins = profile.length_histogram(same, 4).orderBy("bin").collect()
    assert [b.n for b in bins] == [0, 0, 3, 0]
