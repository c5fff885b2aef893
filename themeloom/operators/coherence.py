"""Topic coherence from sliding windows or documents (Roeder, Both and Hinneburg 2015).

Window counts never unroll the windows. A token at position p lies in the window starts
``max(0, p - size + 1) .. min(p, max(0, n - size))``, an interval; the windows that hold a word, or
one of two words, are the length of a union of intervals, and the windows that hold both follow from
``|A and B| = |A| + |B| - |A or B|``. A document travels as one row with the places of its topic words; the
pairs are made and added up batch by batch, so they are neither sorted nor sent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from themeloom.session import fits_one_task, materialize

# Fixed values of the published measures
WINDOW = {"c_v": 110, "c_npmi": 10, "c_uci": 10}
WORDS_SCORED = 10
SMALL = 1e-12
MIN_TOPICS = 2

PAIR_ROWS = 1 << 20  # pairs of topic words with a place that are held at a time


def _scored_terms(topic_terms: DataFrame, k: int) -> DataFrame:
    return topic_terms.filter(F.col("rank") <= k).select("topic", "rank", "term")


def _pairs(terms: DataFrame) -> DataFrame:
    """Ordered pairs inside a topic, a word with itself included; at most k * (k + 1) / 2 per topic."""
    other = terms.select("topic", F.col("rank").alias("rank_b"), F.col("term").alias("b"))
    return terms.withColumnsRenamed({"rank": "rank_a", "term": "a"}).join(other, "topic").filter(
        F.col("rank_a") <= F.col("rank_b")
    )


def _places(token_arrays: DataFrame, words: list[str]) -> DataFrame:
    """``(doc_id, n, pos, code)``: tokens of a document, places of those among ``words`` and their numbers."""
    kind = token_arrays.schema["doc_id"].dataType.simpleString()
    shared = token_arrays.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(shared.value, pa.string())
        for batch in batches:
            lists = batch.column(1)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten()
            code = pc.index_in(flat, value_set=known.cast(flat.type)).fill_null(-1).to_numpy(zero_copy_only=False)
            at = np.flatnonzero(code >= 0)
            first = np.cumsum(sizes) - sizes
            doc = np.searchsorted(first + sizes, at, side="right")
            held = np.bincount(doc, minlength=len(sizes))
            ends = pa.array(np.concatenate([[0], np.cumsum(held)]), pa.int32())
            pos = pa.ListArray.from_arrays(ends, pa.array((at - first[doc]).astype(np.int32)))
            codes = pa.ListArray.from_arrays(ends, pa.array(code[at].astype(np.int32)))
            rows = pa.record_batch(
                [batch.column(0), pa.array(sizes.astype(np.int32)), pos, codes], ["doc_id", "n", "pos", "code"]
            )
            yield rows.filter(pa.array(held > 0))

    slim = token_arrays.select("doc_id", "tokens")
    return slim.mapInArrow(run, f"doc_id {kind}, n int, pos array<int>, code array<int>")


def _united(doc, pos, n, code, words: pd.DataFrame, size: int) -> pd.DataFrame:
    """Windows with a word of each pair, summed over some documents; ``words`` has ``code, group, rank``."""
    order = np.argsort(words["code"].to_numpy(), kind="stable")
    owner, group, rank = (words[c].to_numpy()[order] for c in ("code", "group", "rank"))
    low, high = np.maximum(0, pos - (size - 1)), np.minimum(pos, np.maximum(0, n - size))
    # every place once for each topic of its word, then once for each word of that topic
    first, past = np.searchsorted(owner, code, side="left"), np.searchsorted(owner, code, side="right")
    place, member = _runs(first, past)
    mine, other = _runs(*(np.searchsorted(words["group"].to_numpy(), group[member], side=s) for s in ("left", "right")))
    place, member = place[mine], member[mine]
    ranks = words["rank"].to_numpy()[other]
    a, b = np.minimum(rank[member], ranks), np.maximum(rank[member], ranks)
    rows = pd.DataFrame({"doc": doc[place], "group": group[member], "rank_a": a, "rank_b": b, "high": high[place], "low": low[place]})
    order = np.lexsort([rows[c] for c in ("low", "high", "doc", "rank_b", "rank_a", "group")])
    rows = rows.iloc[order].reset_index(drop=True)
    keys = rows[["group", "rank_a", "rank_b", "doc"]].to_numpy()
    same = np.concatenate([[False], (keys[1:] == keys[:-1]).all(1)]) if len(keys) else np.zeros(0, bool)
    start = np.maximum(rows["low"], np.where(same, rows["high"].shift(fill_value=0) + 1, 0))
    rows["either"] = np.maximum(0, rows["high"] - start + 1).astype(np.int64)
    return rows.groupby(["group", "rank_a", "rank_b"], as_index=False)["either"].sum()


def _runs(first: np.ndarray, past: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from each ``first`` to before its ``past``, after the place of the pair."""
    sizes = past - first
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[owner]


def window_unions(token_arrays: DataFrame, topic_terms: DataFrame, size: int, k: int = WORDS_SCORED) -> DataFrame:
    """Windows holding at least one word of each pair: ``(topic, rank_a, rank_b, either)``.

    The places of topic words are sent to their document once, a row for each; pairs are made after that, some
    documents at a time, and only their sums leave the task. The topic words, if counted few, travel to the tasks;
    more of them are joined.
    """
    terms = materialize(_scored_terms(topic_terms, k), "scored-terms")
    if not fits_one_task(terms):
        return _joined_unions(token_arrays, terms, size)
    # counted above: k words of each topic; a missing topic or term meets nothing
    words = terms.dropna(subset=["topic", "term"]).toPandas()
    names, words["code"] = np.unique(words["term"].to_numpy(dtype=object), return_inverse=True) if len(words) else ([], [])
    topics = terms.schema["topic"].dataType.simpleString()
    listed = list(dict.fromkeys(words["topic"].tolist()))
    words["group"] = words["topic"].map({t: i for i, t in enumerate(listed)})
    words = words[["code", "group", "rank"]].astype("int64").sort_values(["group", "rank"], kind="stable")
    groups = len(listed)
    most = max(1, int((words.groupby("group")["rank"].transform("size")).groupby(words["code"]).sum().max())) if groups else 1
    shared = token_arrays.sparkSession.sparkContext.broadcast(words)
    by_document = _places(token_arrays, list(names)).groupBy("doc_id").agg(
        F.collect_list(F.struct("n", "pos", "code")).alias("parts")
    )
    flat = by_document.select(
        F.flatten(F.transform("parts", lambda p: F.transform(p["pos"], lambda x: p["n"]))).alias("n"),
        F.flatten("parts.pos").alias("pos"), F.flatten("parts.code").alias("code"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            ends = np.cumsum(batch.column(1).value_lengths().to_numpy(zero_copy_only=False))
            n, pos, code = (batch.column(i).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
            doc, at = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0)), 0
            while at < len(ends):  # whole documents up to a bounded number of pairs, one at least
                begin = ends[at - 1] if at else 0
                past = max(at + 1, int(np.searchsorted(ends, begin + PAIR_ROWS // most, side="right")))
                part, at = slice(begin, ends[past - 1]), past
                found = _united(doc[part], pos[part], n[part], code[part], known, size)
                yield pa.RecordBatch.from_pandas(found, preserve_index=False)

    sums = flat.mapInArrow(run, "group bigint, rank_a bigint, rank_b bigint, either bigint")
    summed = sums.groupBy("group", "rank_a", "rank_b").agg(F.sum("either").alias("either"))
    named = token_arrays.sparkSession.createDataFrame(list(enumerate(listed)), f"group bigint, topic {topics}")
    return summed.join(F.broadcast(named), "group").select(  # rows: topics of the words counted above
        "topic", F.col("rank_a").cast("int").alias("rank_a"), F.col("rank_b").cast("int").alias("rank_b"), "either"
    )


def _joined_unions(token_arrays: DataFrame, terms: DataFrame, size: int) -> DataFrame:
    """The same for any number of topic words.

    Occurrences of topic words are sent to their document once; the pairs are made after that
    shuffle, where the sort for the running interval end takes place.
    """
    pairs = _pairs(terms)
    n = F.col("n")
    occurrences = token_arrays.select(
        "doc_id", F.size("tokens").alias("n"), F.posexplode("tokens").alias("pos", "term")
    ).join(terms.select("term").distinct(), "term", "left_semi")
    located = occurrences.select(
        "doc_id", "term",
        F.greatest(F.lit(0), F.col("pos") - (size - 1)).alias("low"),
        F.least("pos", F.greatest(F.lit(0), n - size)).alias("high"),
    ).repartition("doc_id")
    keyed = pairs.select("topic", "rank_a", "rank_b", F.col("a").alias("term")).unionByName(
        pairs.filter("rank_a <> rank_b").select("topic", "rank_a", "rank_b", F.col("b").alias("term"))
    )
    order = Window.partitionBy("doc_id", "topic", "rank_a", "rank_b").orderBy("high", "low")
    start = F.greatest("low", F.coalesce(F.lag("high").over(order) + 1, F.lit(0)))
    return (
        located.join(keyed, "term")
        .withColumn("added", F.greatest(F.lit(0), F.col("high") - start + 1))
        .groupBy("topic", "rank_a", "rank_b").agg(F.sum("added").alias("either"))
    )


def document_unions(token_arrays: DataFrame, topic_terms: DataFrame, k: int = WORDS_SCORED) -> DataFrame:
    """The same with whole documents instead of windows.

    A document counts once for every pair with at least one of its words: all pairs less those
    among its missing words. So the words present, at most ``k`` per topic, make the rows.
    """
    terms = _scored_terms(topic_terms, k)
    present = token_arrays.select("doc_id", F.explode(F.array_distinct("tokens")).alias("term")).join(terms, "term")
    in_doc = present.groupBy("doc_id", "topic").agg(F.collect_set("rank").alias("here"))
    pairs = _pairs(terms).select("topic", "rank_a", "rank_b")
    hit = F.array_contains("here", F.col("rank_a")) | F.array_contains("here", F.col("rank_b"))
    # documents with the same words present are one row from here on
    kinds = in_doc.groupBy("topic", F.sort_array("here").alias("here")).agg(F.count("*").alias("n"))
    return kinds.join(pairs, "topic").filter(hit).groupBy("topic", "rank_a", "rank_b").agg(F.sum("n").alias("either"))


def joint_counts(unions: DataFrame) -> DataFrame:
    """Both orders of each pair of known words: ``(topic, rank_a, rank_b, both, of_a, of_b)``.

    A topic has at most k * k rows; they meet once by topic and stay there.
    """
    both_ways = unions.unionByName(
        unions.filter("rank_a <> rank_b").select(
            "topic", F.col("rank_b").alias("rank_a"), F.col("rank_a").alias("rank_b"), "either"
        )
    ).repartition("topic")
    single = F.when(F.col("rank_a") == F.col("rank_b"), F.col("either"))
    counted = both_ways.withColumns({
        "of_a": F.max(single).over(Window.partitionBy("topic", "rank_a")),
        "of_b": F.max(single).over(Window.partitionBy("topic", "rank_b")),
    })
    both = F.when(F.col("rank_a") == F.col("rank_b"), F.col("either")).otherwise(
        F.col("of_a") + F.col("of_b") - F.col("either")
    )
    return counted.filter("of_a > 0 AND of_b > 0").select("topic", "rank_a", "rank_b", both.alias("both"), "of_a", "of_b")


def total_windows(token_arrays: DataFrame, size: int) -> DataFrame:
    """Number of windows; a shorter document, even an empty one, is one window."""
    return token_arrays.agg(
        F.sum(F.greatest(F.lit(1), F.size("tokens") - (size - 1))).cast("bigint").alias("windows")
    )


def _pmi() -> Column:
    """log((p + small) / (p_a p_b)); 0 for words that never occur."""
    return F.when(
        (F.col("p_a") > 0) & (F.col("p_b") > 0),
        F.log((F.col("p") + SMALL) / (F.col("p_a") * F.col("p_b"))),
    ).otherwise(F.lit(0.0))


def _npmi() -> Column:
    return _pmi() / -F.log(F.col("p") + SMALL)


def topic_coherence(
    token_arrays: DataFrame, topic_terms: DataFrame, measure: str = "c_v", k: int = WORDS_SCORED
) -> DataFrame:
    """Coherence of each topic: ``(topic, coherence)``.

    ``topic_terms`` is ``(topic, rank, term)``. Measures: ``c_v`` (cosine of normalised PMI vectors,
    window 110), ``c_npmi`` and ``c_uci`` (pair means, window 10), ``u_mass`` (documents). Words that
    do not occur in the texts do not count.
    """
    if measure == "u_mass":
        unions = document_unions(token_arrays, topic_terms, k)
        total = token_arrays.agg(F.count("*")).scalar()
    elif measure in WINDOW:
        unions = window_unions(token_arrays, topic_terms, WINDOW[measure], k)
        total = total_windows(token_arrays, WINDOW[measure]).scalar()
    else:
        raise ValueError(f"unknown coherence measure: {measure}")
    # one small row per topic and pair, read twice below
    counts = joint_counts(materialize(unions, "unions"))
    pairs = counts.select(
        "topic", "rank_a", "rank_b", (F.col("both") / total).alias("p"),
        (F.col("of_a") / total).alias("p_a"), (F.col("of_b") / total).alias("p_b"),
    )
    if measure == "c_v":
        return _c_v(pairs)
    value = {"c_npmi": _npmi(), "c_uci": _pmi(), "u_mass": F.log((F.col("p") + SMALL) / F.col("p_b"))}[measure]
    return pairs.filter("rank_a > rank_b").groupBy("topic").agg(F.avg(value).alias("coherence"))


def _c_v(pairs: DataFrame) -> DataFrame:
    """Mean cosine between each word's vector and the sum of all vectors of the topic."""
    summed = pairs.select("topic", "rank_a", "rank_b", _npmi().alias("x")).withColumn(
        "s", F.sum("x").over(Window.partitionBy("topic", "rank_b"))
    )
    own = F.when(F.col("rank_a") == F.col("rank_b"), F.col("s") * F.col("s"))
    sized = summed.withColumn("ls", F.sqrt(F.sum(own).over(Window.partitionBy("topic"))))
    per_word = sized.groupBy("topic", "rank_a").agg(
        F.sum(F.col("x") * F.col("s")).alias("product"), F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("lx"),
        F.first("ls").alias("ls"),
    )
    norm = F.col("lx") * F.col("ls")
    cosine = F.when(norm > 0, F.col("product") / norm).otherwise(F.lit(0.0))
    return per_word.groupBy("topic").agg(F.avg(cosine).alias("coherence"))


def model_coherence(per_topic: DataFrame, too_few: float | None) -> DataFrame:
    """Mean over topics; with fewer than two topics the score is ``too_few`` (NaN or 0)."""
    return per_topic.agg(
        F.when(F.count("*") >= MIN_TOPICS, F.avg("coherence")).otherwise(F.lit(too_few)).alias("coherence_score"),
        F.count("*").alias("n_topics"),
    )
