"""Functions over arrays of topic words: representations, labels, names, similarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from themeloom.functions.text import title_case

# Words left out of simple labels, and how many words are looked at.
LABEL_SKIPPED_WORDS = ("research", "study", "analysis", "method", "based", "data", "system")
LABEL_WORDS_READ = 5
LABEL_WORDS_KEPT = 4
LABEL_WORDS_NEEDED = 3
KEYWORDS_FOR_LABEL = 8
WORDS_COMPARED = 10
OUTLIER_TOPIC = -1


def jaccard(left: Column, right: Column) -> Column:
    """Shared words over all words; 0 when either side is empty or null."""
    shared = F.size(F.array_intersect(left, right))
    either = F.size(F.array_union(left, right))
    both_filled = (F.size(left) > 0) & (F.size(right) > 0)
    return F.when(both_filled, shared / either).otherwise(F.lit(0.0))


def first_words(words: Column, n: int = WORDS_COMPARED) -> Column:
    return F.slice(words, 1, n)


def _first_spellings(words: Column) -> Column:
    """Words sorted by lower case, the first of equal ones kept and put back in order.

    The sorted array is bound to a variable: an expression inside a lambda is computed again for every element.
    """
    known = F.filter(words, lambda w: w.isNotNull())
    keyed = F.sort_array(F.transform(known, lambda w, i: F.struct(F.lower(w).alias("key"), i.alias("i"), w.alias("w"))))
    kept = F.transform(
        F.array(keyed),
        lambda s: F.filter(s, lambda x, j: (j == 0) | (F.get(s, j - 1)["key"] != x["key"])),
    )[0]
    ordered = F.sort_array(F.transform(kept, lambda x: F.struct(x["i"].alias("i"), x["w"].alias("w"))))
    return F.transform(ordered, lambda x: F.trim(x["w"]))


def representation_words(df: DataFrame, column: str) -> Column:
    """Words of a topic representation, whatever its Spark type.

    A comma-separated string, an array of strings, an array of (word, weight) structs, or any
    scalar. Words that differ only in case keep their first spelling. Null gives an empty array.
    """
    kind = df.schema[column].dataType
    col = F.col(column)
    nothing = F.array().cast("array<string>")
    if isinstance(kind, T.StringType):
        words = F.when(col != "", F.transform(F.split(col, ","), lambda w: F.trim(w)))
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        first = kind.elementType.fieldNames()[0]
        words = F.transform(col, lambda item: item[first].cast("string"))
    elif isinstance(kind, T.ArrayType):
        words = F.transform(col, lambda item: item.cast("string"))
    else:
        words = F.when(col.isNotNull(), F.array(col.cast("string")))
    return F.coalesce(_first_spellings(words), nothing)


def simple_label(topic: Column, words: Column) -> Column:
    """Title-cased label of up to four of the first five words, general words skipped.

    With fewer than three words left the first four are used as they are; a topic without words
    is called ``Topic {id}``; the outlier topic gets no label (null).
    """
    specific = F.filter(
        F.slice(words, 1, LABEL_WORDS_READ), lambda w: ~F.lower(w).isin(*LABEL_SKIPPED_WORDS)
    )
    chosen = F.when(F.size(specific) >= LABEL_WORDS_NEEDED, specific).otherwise(words)
    label = title_case(F.array_join(F.slice(chosen, 1, LABEL_WORDS_KEPT), " "))
    empty = F.concat(F.lit("Topic "), topic.cast("string"))
    return F.when(
        topic != OUTLIER_TOPIC, F.when(F.size(words) > 0, label).otherwise(empty)
    )


def default_name(topic: Column, words: Column) -> Column:
    """``{id}_{w1}_{w2}_{w3}_{w4}``."""
    return F.concat_ws("_", topic.cast("string"), F.slice(words, 1, LABEL_WORDS_KEPT))


def label_keywords(words: Column) -> Column:
    """The words a label is written from: the first eight, joined by blanks."""
    return F.array_join(F.slice(words, 1, KEYWORDS_FOR_LABEL), " ")


def clean_external_label(label: Column) -> Column:
    """Trim a label from outside and take its quotes away."""
    return F.translate(F.trim(label), "\"'", "")
