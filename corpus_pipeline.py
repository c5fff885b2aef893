"""Corpus pipeline: quality rules, quality classifier, line dedup, near-dedup and packing, in this order.

Every stage takes what the one before it kept, written as Parquet and read again. All but the last return the
columns of ``documents``. Nulls, empty texts and repeated rows are treated as each operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from themeloom.llm import crf, editjoin, packing, rules, simhash
from themeloom.llm.common import table
from themeloom.llm.queries import OP4_END_ID, byte_bpe
from themeloom.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a certified cutoff go."""
    return rules.passing(docs, table(spark, sf_dir, "labels"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field over their lines scores below the cutoff go."""
    return crf.passing(docs, crf.train(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one up to two edits go; their documents stay, with ``n_chars`` counted anew."""
    kept = editjoin.dedup_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in windows."""
    # smaller steps and fewer remembered units than the operator's own: the stages before have their memory still
    pieces = packing.pack(docs, byte_bpe(), OP4_END_ID, special=True, cache_units=100_000, step_bytes=2 << 20)
    return packing.digests(*pieces)


STAGES = [
    ("quality_rules", quality_rules), ("quality_classifier", quality_classifier), ("line_dedup", line_dedup),
    ("near_dedup", near_dedup), ("packing", pack),
]

# Certified cutoffs, the fitted field, edit distances and XXH64 fingerprints have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
