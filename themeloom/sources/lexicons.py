"""Stop-word lists and the verb lexicon behind lemmatising."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Verb endings and what replaces them, in the order they are tried.
VERB_ENDINGS = (
    ("s", ""), ("ies", "y"), ("es", "e"), ("es", ""),
    ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", ""),
)
# A lexicon describes a language, not the corpus; a file beyond this size is not one.
LEXICON_ROWS = 100_000


def builtin_stopwords(language: str = "english") -> list[str]:
    """Spark's own stop-word list for a language."""
    return StopWordsRemover.loadDefaultStopWords(language)


def read_stopwords(spark: SparkSession, path: str | None = None, language: str = "english") -> DataFrame:
    """Stop words as a table ``word``: one per line of a file, or Spark's list."""
    if path is None:
        return spark.createDataFrame([(w,) for w in builtin_stopwords(language)], "word string")
    lines = spark.read.text(path).select(F.trim("value").alias("word"))
    return lines.filter(F.col("word") != "").distinct()


def words_of(lexicon: DataFrame, column: str = "word") -> list[str]:
    """A lexicon as a list on the driver; refuses tables that are too long to be one."""
    rows = lexicon.select(column).limit(LEXICON_ROWS + 1).collect()
    if len(rows) > LEXICON_ROWS:
        raise ValueError(f"a lexicon may hold {LEXICON_ROWS} words at most")
    return [r[0] for r in rows]


def read_verb_lexicon(spark: SparkSession, exceptions_path: str, index_path: str):
    """Verb lexicon files as two tables: ``(word, lemma)`` exceptions and ``(lemma)`` verbs.

    Exception lines read "inflected base"; index lines start with the verb, and licence lines
    start with two blanks.
    """
    parts = F.split(F.trim("value"), " ")
    exceptions = spark.read.text(exceptions_path).filter(F.trim("value") != "").select(
        parts[0].alias("word"), parts[1].alias("lemma")
    )
    verbs = spark.read.text(index_path).filter(
        (F.trim("value") != "") & ~F.col("value").startswith("  ")
    ).select(F.split("value", " ")[0].alias("lemma"))
    return exceptions, verbs


def lemma_map(exceptions: DataFrame, verbs: DataFrame) -> DataFrame:
    """Every inflected form the lexicon can explain: ``(word, lemma)``, changed words only.

    The rules run backwards, from verb to possible forms, so the result is bounded by the lexicon
    (eight forms per verb plus the exceptions) and never depends on the corpus. A listed exception
    comes first; otherwise the shortest known verb wins, earlier rules first. A form that is itself
    a verb competes with its own length.
    """
    known = verbs.select("lemma").distinct()
    forms = None
    for rank, (ending, replacement) in enumerate(VERB_ENDINGS):
        stem = (
            F.expr(f"substring(lemma, 1, length(lemma) - {len(replacement)})")
            if replacement else F.col("lemma")
        )
        rows = known.filter(F.col("lemma").endswith(replacement)) if replacement else known
        step = rows.select(
            F.concat(stem, F.lit(ending)).alias("word"), "lemma", F.lit(rank + 1).alias("rule")
        )
        forms = step if forms is None else forms.unionByName(step)
    itself = known.select(F.col("lemma").alias("word"), "lemma", F.lit(0).alias("rule"))
    listed = exceptions.join(known, "lemma", "left_semi").select(
        "word", "lemma", F.lit(1).alias("rule"), F.lit(0).alias("source")
    )
    self_listed = itself.join(exceptions.select("word").distinct(), "word", "left_semi").withColumn(
        "source", F.lit(0)
    )
    by_rule = itself.unionByName(forms).withColumn("source", F.lit(1))
    best = (
        listed.unionByName(self_listed).unionByName(by_rule)
        .groupBy("word")
        .agg(F.min(F.struct("source", F.length("lemma").alias("n"), "rule", "lemma")).alias("b"))
    )
    # words listed as exceptions never reach the rules, even when the base is no known verb
    unknown_base = exceptions.join(known, "lemma", "left_anti").select("word").distinct()
    changed = best.select("word", F.col("b.lemma").alias("lemma"), F.col("b.source").alias("source"))
    blocked = changed.join(unknown_base, "word", "left_anti").unionByName(
        changed.filter("source = 0").join(unknown_base, "word", "left_semi")
    )
    return blocked.filter("word <> lemma").select("word", "lemma")
