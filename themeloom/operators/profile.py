"""Corpus profile: counts, missing values, copies, lengths, frequent words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from themeloom.functions.text import count_words
from themeloom.operators.tokens import term_counts
from themeloom.session import materialize

# Fixed values
TOP_WORDS = 20
CHART_WORDS = 15
CLOUD_WORDS = 100
REPORT_BINS = 30
DENSITY_POINTS = 200


def record_count(df: DataFrame) -> DataFrame:
    """Number of rows and the column names."""
    names = F.array(*[F.lit(c) for c in df.columns])
    return df.agg(F.count("*").alias("total_records")).withColumn("columns", names)


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, all columns in one pass: ``(column, missing)``."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in df.columns]
    )
    return counts.select(F.inline(pairs))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows; nulls are equal to each other."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def text_statistics(df: DataFrame, column: str) -> DataFrame:
    """Mean, largest and smallest word count and mean length of a text column, nulls left out."""
    words = count_words(F.col(column))
    return df.filter(F.col(column).isNotNull()).agg(
        F.avg(words).alias("mean_word_count"),
        F.max(words).cast("bigint").alias("max_word_count"),
        F.min(words).cast("bigint").alias("min_word_count"),
        F.avg(F.length(column)).alias("mean_char_count"),
    )


def doc_lengths(df: DataFrame, column: str) -> DataFrame:
    """Words per document: ``(doc_id, n_words)``."""
    present = df.filter(F.col(column).isNotNull())
    return present.select("doc_id", count_words(F.col(column)).cast("bigint").alias("n_words"))


def _length_counts(lengths: DataFrame) -> DataFrame:
    """One row per distinct length, written once, so the texts are read once whatever uses it."""
    return materialize(lengths.groupBy("n_words").agg(F.count("*").alias("n")), "length-counts")


def length_histogram(lengths: DataFrame, bins: int = REPORT_BINS) -> DataFrame:
    """Equal-width bins between the smallest and the largest length, empty bins included.

    The last bin holds its right edge; if all lengths are equal the range is one wide around them.
    Works on one row per distinct length.
    """
    counts = _length_counts(lengths)
    ends = counts.agg(
        F.min("n_words").cast("double").alias("lo"), F.max("n_words").cast("double").alias("hi")
    ).select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    span = ends.select(F.struct("lo", "hi")).scalar()
    placed = counts.withColumn("span", span).select(
        F.least(
            F.floor((F.col("n_words") - F.col("span.lo")) * bins / (F.col("span.hi") - F.col("span.lo"))),
            F.lit(bins - 1),
        ).cast("int").alias("bin"),
        "n",
    )
    filled = placed.groupBy("bin").agg(F.sum("n").alias("n"))
    edges = ends.select(
        "lo", ((F.col("hi") - F.col("lo")) / bins).alias("width"),
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
    )
    return edges.join(filled, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def length_density(lengths: DataFrame, points: int = DENSITY_POINTS) -> DataFrame:
    """Gaussian density of the lengths on an even grid, bandwidth by Scott's rule.

    Every distinct length adds to ``points`` grid values, so work follows the number of distinct
    lengths, not the number of documents.
    """
    counts = _length_counts(lengths)
    x, n = F.col("n_words").cast("double"), F.col("n")
    sums = counts.agg(
        F.sum("n").alias("total"), F.sum(n * x).alias("sx"),
        F.min(x).alias("lo"), F.max(x).alias("hi"),
    )
    centred = counts.withColumn("s", sums.select(F.struct("*")).scalar())
    mean = F.col("s.sx") / F.col("s.total")
    spread = centred.agg(
        F.first("s").alias("s"),
        F.sqrt(F.sum(n * (x - mean) * (x - mean)) / (F.first("s.total") - 1)).alias("sigma"),
    ).select(
        "s.total", "s.lo", "s.hi",
        (F.col("sigma") * F.pow(F.col("s.total").cast("double"), F.lit(-0.2))).alias("h"),
    )
    grid = counts.withColumn("p", spread.select(F.struct("*")).scalar()).select(
        "n", x.alias("x"), "p", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    )
    at = F.col("p.lo") + F.col("point") * (F.col("p.hi") - F.col("p.lo")) / (points - 1)
    z = (at - F.col("x")) / F.col("p.h")
    kernel = F.exp(-0.5 * z * z) / (F.col("p.h") * F.lit((2 * 3.141592653589793) ** 0.5))
    return grid.groupBy("point").agg(
        F.first(at).alias("length"), (F.sum(F.col("n") * kernel) / F.first("p.total")).alias("density")
    )


def top_words(docs: DataFrame, text: str = "doc", stopwords=(), k: int = TOP_WORDS) -> DataFrame:
    """The ``k`` most frequent terms, ties by term: each task sends at most ``k`` rows on."""
    return term_counts(docs, text, stopwords).orderBy(F.desc("n"), "term").limit(k)


def cloud_weights(docs: DataFrame, text: str = "doc", stopwords=(), k: int = CLOUD_WORDS) -> DataFrame:
    """The ``k`` most frequent terms with their weight relative to the most frequent one."""
    words = top_words(docs, text, stopwords, k)
    largest = words.agg(F.max("n")).scalar()
    return words.withColumn("weight", F.col("n") / largest)


def topic_frequency(assignments: DataFrame) -> DataFrame:
    """Documents per topic: ``(topic, count)``."""
    return assignments.groupBy("topic").agg(F.count("*").alias("count"))


def topic_count(frequency: DataFrame) -> DataFrame:
    """Number of topics without the outlier topic."""
    return frequency.agg(F.count_if(F.col("topic") != -1).alias("n_topics"))


def assigned_topic_count(assignments: DataFrame) -> DataFrame:
    """Number of distinct assigned topics, the outlier topic included."""
    return assignments.agg(F.countDistinct("topic").alias("n_topics"))


def profile_target(df: DataFrame) -> str | None:
    """The profiled column: ``Abstract``, else ``Title``, else none."""
    return next((c for c in ("Abstract", "Title") if c in df.columns), None)


def profile_text(df: DataFrame) -> Column:
    """Title and abstract together; a column that is missing or null counts as empty."""
    parts = [
        F.coalesce(F.col(c), F.lit("")) if c in df.columns else F.lit("") for c in ("Title", "Abstract")
    ]
    return F.concat_ws(" ", *parts)
