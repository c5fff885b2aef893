"""Corpus preparation: clean, filter, drop copies, combine, sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.functions.text import clean_text
from themeloom.functions.words import OUTLIER_TOPIC
from themeloom.sources.documents import REQUIRED_COLUMNS, require_columns

# Fixed values
MIN_CORPUS_ROWS = 5
MIN_CORPUS_MESSAGE = "Minimal 5 dokumen"
PREVIEW_CHARS = 400
SAMPLE_ROWS = 5000
SAMPLE_SEED = 42
VALID_TOPIC_DOCS = 3
GUARD_ROWS = 100


def clean_documents(df: DataFrame, columns=REQUIRED_COLUMNS, null_text: str = "") -> DataFrame:
    """Clean the text columns; nulls become ``null_text`` ("nan" keeps such rows alive)."""
    require_columns(df, tuple(columns))
    return df.withColumns({c: clean_text(F.col(c).cast("string"), null_text) for c in columns})


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Drop rows with a null in any column, extra ones included."""
    return df.na.drop("any")


def non_empty(df: DataFrame, columns=REQUIRED_COLUMNS) -> DataFrame:
    for c in columns:
        df = df.filter(F.col(c) != "")
    return df


def drop_copies(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Keep the row with the smallest id of every group that is equal in all other columns.

    A hash aggregate over the content: copies meet inside each map task first, so a text that
    makes up a third of the table still sends one row per task through the shuffle.
    """
    content = [c for c in df.columns if c != id_col]
    return df.groupBy(*content).agg(F.min(id_col).alias(id_col)).select(*df.columns)


def require_min_corpus(df: DataFrame, rows: int = MIN_CORPUS_ROWS) -> DataFrame:
    """Fail when fewer than ``rows`` rows are left; never counts the whole table."""
    if len(df.take(rows)) < rows:
        raise ValueError(MIN_CORPUS_MESSAGE)
    return df


def _once(df: DataFrame) -> DataFrame:
    """Keep Spark from copying costly columns into the filters above them.

    A filter is pushed through a projection by repeating its expressions; it is not pushed through a
    generator, so wrapping the row into a one-element array evaluates them once.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def _kept_rows(df: DataFrame, columns, null_text: str) -> DataFrame:
    return non_empty(drop_null_rows(_once(clean_documents(df, columns, null_text))), columns)


def prepare(df: DataFrame, columns=REQUIRED_COLUMNS, null_text: str = "") -> DataFrame:
    """The lazy part of preprocessing: clean, drop nulls, drop empties, drop copies."""
    return drop_copies(_kept_rows(df, columns, null_text))


def preprocess(df: DataFrame, columns=REQUIRED_COLUMNS, null_text: str = "") -> DataFrame:
    """``prepare`` plus the guard against a corpus that is too small; columns stay the same.

    A look at a few rows settles the guard for any real corpus; only if those hold fewer than five
    different texts is the prepared table itself asked.
    """
    prepared = prepare(df, columns, null_text)
    look = _kept_rows(df, columns, null_text).select(F.xxhash64(*columns)).take(GUARD_ROWS)
    if len({r[0] for r in look}) < MIN_CORPUS_ROWS:
        require_min_corpus(prepared)
    return prepared


def combine_docs(df: DataFrame, columns=REQUIRED_COLUMNS, name: str = "doc") -> DataFrame:
    """Add the text of a document: its columns joined by a blank."""
    return df.withColumn(name, F.concat_ws(" ", *[F.col(c) for c in columns]))


def sample_documents(df: DataFrame, n: int = SAMPLE_ROWS, seed: int = SAMPLE_SEED) -> DataFrame:
    """A uniform sample of ``n`` rows, the same at any partitioning.

    Rows are ordered by a hash of id and seed; only ``n`` rows per task reach the final merge.
    """
    key = F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(f":{seed}")))
    return df.orderBy(key, "doc_id").limit(n)


def valid_topics(frequency: DataFrame, min_docs: int = VALID_TOPIC_DOCS) -> DataFrame:
    """Topics with enough documents, outliers left out."""
    return frequency.filter((F.col("count") >= min_docs) & (F.col("topic") != OUTLIER_TOPIC))


def topic_list(topic_info: DataFrame) -> DataFrame:
    """Topics for display, without outliers."""
    return topic_info.filter(F.col("topic") != OUTLIER_TOPIC).select(
        "topic", F.col("name").alias("label"), F.col("count").alias("n_documents")
    )


def topic_documents(docs: DataFrame, assignments: DataFrame, topic: int | None = None) -> DataFrame:
    """All documents of a topic (of every topic if none is named) with a preview of the body."""
    chosen = assignments if topic is None else assignments.filter(F.col("topic") == topic)
    preview = F.concat(F.substring("Abstract", 1, PREVIEW_CHARS), F.lit("..."))
    return (
        docs.select("doc_id", F.col("Title").alias("title"), preview.alias("summary"))
        .join(chosen.select("doc_id", "topic"), "doc_id")
    )
