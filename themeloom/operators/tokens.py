"""Tokens, stop words, lemmas, n-grams, vocabulary."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from themeloom.functions.text import drop_words, tokens, word_terms
from themeloom.sources.lexicons import LEXICON_ROWS

LEMMA_FORMS = 10 * LEXICON_ROWS  # bound of a lemma map: a few forms per lexicon entry


def with_tokens(
    docs: DataFrame, text: str = "doc", stopwords=(), name: str = "tokens", keep=("doc_id",)
) -> DataFrame:
    """One token array per document; a document without tokens keeps an empty array."""
    return docs.select(*keep, tokens(F.col(text), stopwords).alias(name))


def token_rows(token_arrays: DataFrame, keep=("doc_id",), outer: bool = False) -> DataFrame:
    """Long form ``(doc_id, pos, token)``; positions count the kept tokens from 0."""
    explode = F.posexplode_outer if outer else F.posexplode
    return token_arrays.select(*keep, explode("tokens").alias("pos", "token"))


def drop_stopword_rows(rows: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Long-form stop-word filter against a lexicon table (anti join)."""
    return rows.join(lexicon.select(F.col("word").alias("token")), "token", "left_anti")


def lemmatize_rows(rows: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Replace tokens by their lemma; words the map does not know stay.

    The map is bounded by the lexicon (checked), so it is broadcast and the tokens never shuffle.
    """
    size = lemmas.limit(LEMMA_FORMS + 1).count()
    table = lemmas.select(F.col("word").alias("token"), "lemma")
    if size <= LEMMA_FORMS:
        table = F.broadcast(table)
    columns = [F.coalesce("lemma", "token").alias("token") if c == "token" else c for c in rows.columns]
    return rows.join(table, "token", "left").select(*columns)


def _map_tokens(arrays: DataFrame, forms: pa.Table) -> DataFrame:
    """Replace the tokens that ``forms (word, lemma)`` knows."""
    kind = arrays.schema["doc_id"].dataType.simpleString()

    def run(batches):
        words, lemmas = forms.column("word").combine_chunks(), forms.column("lemma").combine_chunks()
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten()
            at = pc.index_in(flat, value_set=words.cast(flat.type))
            flat = pc.coalesce(lemmas.cast(flat.type).take(at), flat)
            ends = pa.array(np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())]), pa.int32())
            yield pa.record_batch([batch.column(0), pa.ListArray.from_arrays(ends, flat)], ["doc_id", "tokens"])

    return arrays.mapInArrow(run, f"doc_id {kind}, tokens array<string>")


def simple_tokenizer(
    docs: DataFrame, text: str = "doc", stopwords=(), lemmas: DataFrame | None = None
) -> DataFrame:
    """Tokens for evaluation: ``(doc_id, tokens)`` in text order, duplicates kept.

    Without lemmas this is a plain projection. With lemmas the arrays are mapped batch by batch through a
    dictionary of the lexicon's size, without a shuffle. A larger map (checked) is joined instead: tokens are
    exploded and put back in order, one document per group. Empty documents stay.
    """
    arrays = with_tokens(docs, text, stopwords)
    if lemmas is None:
        return arrays
    forms = lemmas.select("word", "lemma").limit(LEMMA_FORMS + 1).toArrow()
    if forms.num_rows <= LEMMA_FORMS:
        return _map_tokens(arrays, forms)
    rows = lemmatize_rows(token_rows(arrays, outer=True), lemmas)
    pairs = F.sort_array(
        F.collect_list(F.when(F.col("token").isNotNull(), F.struct("pos", "token")))
    )
    return rows.groupBy("doc_id").agg(F.transform(pairs, lambda p: p["token"]).alias("tokens"))


def vocabulary(token_arrays: DataFrame) -> DataFrame:
    """Distinct tokens with document frequency ``df`` and corpus frequency ``cf``.

    Each array is sorted in place, so the first copy of a token in its document is marked without a
    shuffle by document; one aggregation by token then gives both counts.
    """
    ordered = token_arrays.select(F.sort_array("tokens").alias("s"))
    marked = ordered.select(
        F.explode(
            F.transform(
                "s",
                lambda w, i: F.struct(
                    w.alias("token"),
                    F.when((i > 0) & (F.get("s", i - 1) == w), 0).otherwise(1).alias("first"),
                ),
            )
        ).alias("t")
    )
    return marked.groupBy(F.col("t.token").alias("token")).agg(
        F.sum("t.first").alias("df"), F.count("*").alias("cf")
    )


def bag_of_words(token_arrays: DataFrame, keep=("doc_id",), tokens_col: str = "tokens") -> DataFrame:
    """Term counts per document, ``(doc_id, term, n)``, without a shuffle.

    The sorted array is cut where the term changes; the distance to the next cut is the count.
    """
    ordered = token_arrays.select(*keep, F.sort_array(tokens_col).alias("s")).filter(F.size("s") > 0)
    cut = ordered.withColumn(
        "starts",
        F.filter(
            F.sequence(F.lit(0), F.size("s") - 1),
            lambda i: (i == 0) | (F.get("s", i) != F.get("s", i - 1)),
        ),
    )
    runs = F.transform(
        "starts",
        lambda at, j: F.struct(
            F.get("s", at).alias("term"),
            (F.coalesce(F.get("starts", j + 1), F.size("s")) - at).alias("n"),
        ),
    )
    return cut.select(*keep, F.explode(runs).alias("r")).select(*keep, "r.term", "r.n")


def word_term_rows(docs: DataFrame, text: str = "doc", stopwords=(), keep=("doc_id",)) -> DataFrame:
    """Terms of two or more word characters, any script, stop words removed: long form."""
    return docs.select(*keep, F.explode(drop_words(word_terms(F.col(text)), stopwords)).alias("term"))


def term_counts(docs: DataFrame, text: str = "doc", stopwords=()) -> DataFrame:
    """Corpus count of every term: ``(term, n)``."""
    return word_term_rows(docs, text, stopwords, keep=()).groupBy("term").agg(F.count("*").alias("n"))


def _runs(words: Column, n: int) -> Column:
    """Every run of ``n`` neighbouring words, joined by blanks."""
    if n == 1:
        return words
    starts = F.sequence(F.lit(1), F.size(words) - (n - 1))
    runs = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.when(F.size(words) >= n, runs).otherwise(F.array().cast("array<string>"))


def ngram_array(words: Column, n_min: int, n_max: int) -> Column:
    """All runs of ``n_min`` to ``n_max`` neighbouring words, shorter ones first."""
    return F.concat(*[_runs(words, n) for n in range(n_min, n_max + 1)])


def with_ngrams(token_arrays: DataFrame, n_min: int = 1, n_max: int = 3, keep=("doc_id",)) -> DataFrame:
    """Token arrays replaced by their n-grams in the column ``tokens``."""
    return token_arrays.select(*keep, ngram_array(F.col("tokens"), n_min, n_max).alias("tokens"))
