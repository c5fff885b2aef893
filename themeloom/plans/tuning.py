"""Choose the cluster size by topic coherence."""

from __future__ import annotations

import warnings
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.operators import coherence, terms
from themeloom.operators.corpus import MIN_CORPUS_MESSAGE, MIN_CORPUS_ROWS, valid_topics
from themeloom.operators.profile import topic_frequency
from themeloom.operators.tokens import simple_tokenizer
from themeloom.operators.topic_ngrams import top_ngrams
from themeloom.plans.fit import NGRAMS, Components, build_components, cluster
from themeloom.session import materialize, temporary_tables
from themeloom.sources.documents import write_table
from themeloom.sources.logs import TUNING_SCHEMA, log_experiment

# Below this many documents, first and one past the last size tried.
SIZE_RANGES = ((200, 4, 10), (500, 5, 15), (1000, 10, 25), (1500, 13, 30), (2500, 16, 35))
SIZE_RANGE_BEYOND = (20, 50)
TRIALS = 10
DASHBOARD_TRIALS = 15

TRIALS_AT_ONCE = 4  # jobs of different trials share the cluster


@dataclass(frozen=True)
class TuningResult:
    best_size: int
    best_score: float
    valid_sizes: list[int]
    trials: DataFrame  # min_cluster_size, coherence_score, n_topics
    components: Components


def size_range(counts: DataFrame, n: str = "n") -> DataFrame:
    """Add the candidate sizes of a corpus of ``n`` documents as the array ``sizes``."""
    below, first, past = SIZE_RANGES[0]
    lo, hi = F.when(F.col(n) < below, first), F.when(F.col(n) < below, past)
    for below, first, past in SIZE_RANGES[1:]:
        lo, hi = lo.when(F.col(n) < below, first), hi.when(F.col(n) < below, past)
    lo, hi = lo.otherwise(SIZE_RANGE_BEYOND[0]), hi.otherwise(SIZE_RANGE_BEYOND[1])
    return counts.withColumn("sizes", F.sequence(lo, hi - 1))


def trial_grid(counts: DataFrame, max_trials: int | None = TRIALS, n: str = "n") -> DataFrame:
    """Sizes to try, one row each; more than ``max_trials`` are thinned evenly, rounding down."""
    ranged = size_range(counts, n)
    total = F.size("sizes")
    if not max_trials:
        return ranged.select(*counts.columns, F.explode("sizes").alias("min_cluster_size"))
    steps = F.sequence(F.lit(0), F.lit(max_trials - 1))
    at = F.transform(steps, lambda i: F.floor(i * (total - 1) / F.lit(max(max_trials - 1, 1))).cast("int"))
    thinned = F.transform(at, lambda i: F.get("sizes", i))
    chosen = F.when(total > max_trials, thinned).otherwise(F.col("sizes"))
    return ranged.withColumn("chosen", chosen).select(*counts.columns, F.explode("chosen").alias("min_cluster_size"))


def select_min_cluster(trials: DataFrame) -> DataFrame:
    """Best size and score: NaN is skipped, ties go to the smaller size.

    Without a valid score the smallest size is taken with score 0.
    """
    score, size = F.col("coherence_score"), F.col("min_cluster_size")
    valid = score.isNotNull() & ~F.isnan(score)
    best = F.max(F.when(valid, F.struct(score.alias("s"), (-size).alias("m"))))
    return trials.agg(best.alias("b"), F.min(size).alias("smallest")).select(
        F.coalesce(-F.col("b.m"), F.col("smallest")).alias("min_cluster_size"),
        F.coalesce("b.s", F.lit(0.0)).alias("coherence_score"),
    )


def best_trial(trials: DataFrame, score: str = "coherence_score") -> DataFrame:
    """The row with the highest score, ties to the smaller size."""
    return trials.orderBy(F.desc(score), "min_cluster_size").limit(1).select(
        F.col("min_cluster_size").alias("best_min_cluster"), F.col(score).alias("best_coherence")
    )


def valid_sizes(trials: DataFrame) -> DataFrame:
    """Sizes with a score, ascending, as one array."""
    scored = trials.filter(F.col("coherence_score").isNotNull() & ~F.isnan("coherence_score"))
    return scored.agg(F.array_sort(F.collect_list("min_cluster_size")).alias("valid_sizes"))


def run_trial(
    components: Components, texts: DataFrame, min_cluster_size: int,
    measure: str = "c_v", ngrams: tuple[int, int] = NGRAMS,
) -> tuple[int, float, int, str | None]:
    """Cluster with one size and score its valid topics; a failure or fewer than two topics is NaN.

    The last value is the message of a failure.
    """
    try:
        with temporary_tables(components.docs.sparkSession):
            topics = materialize(cluster(components, min_cluster_size), "trial")
            enough = valid_topics(topic_frequency(topics)).select("topic")
            ranked = top_ngrams(components.tokens.join(topics, "doc_id"), ngrams, terms.WORDS_PER_TOPIC)
            top = ranked.join(enough, "topic", "left_semi")
            per_topic = coherence.topic_coherence(texts, materialize(top, "trial-words"), measure)
            row = coherence.model_coherence(per_topic, float("nan")).head()
        return min_cluster_size, row["coherence_score"], row["n_topics"], None
    except Exception as error:  # one bad trial must not end the search
        return min_cluster_size, float("nan"), 0, f"{type(error).__name__}: {error}"


def largest_trial(docs: DataFrame, max_trials: int | None = TRIALS) -> int:
    """The largest size that a search over ``docs`` tries."""
    return trial_grid(docs.agg(F.count("*").alias("n")), max_trials).agg(F.max("min_cluster_size")).head()[0]


def tune(
    docs: DataFrame, max_trials: int | None = TRIALS, stopwords=(), embeddings: DataFrame | None = None,
    lemmas: DataFrame | None = None, report_path: str | None = None, log_path: str | None = None,
    ngrams: tuple[int, int] = NGRAMS, components: Components | None = None,
) -> TuningResult:
    """Grid search over the cluster size.

    ``components`` made before are used again. Failed trials are reported with a warning; if all fail, so
    does the search.

    The driver only loops over at most thirty sizes, a few at a time; every trial runs as Spark
    jobs over tables computed once. The valid trials can be written as a report, the run to a log.
    """
    spark = docs.sparkSession
    docs = components.docs if components is not None else materialize(docs.select("doc_id", "doc"), "documents")
    n = docs.count()
    counted = spark.createDataFrame([(n,)], "n bigint")
    grid = [r["min_cluster_size"] for r in trial_grid(counted, max_trials).collect()]
    if n < MIN_CORPUS_ROWS:
        raise ValueError(MIN_CORPUS_MESSAGE)
    parts = components or build_components(docs, max(grid), stopwords, embeddings)
    texts = parts.tokens
    if lemmas is not None:
        texts = materialize(simple_tokenizer(parts.docs, "doc", stopwords, lemmas), "evaluation-tokens")
    task = inheritable_thread_target(spark)(lambda size: run_trial(parts, texts, size, ngrams=ngrams))
    with ThreadPoolExecutor(TRIALS_AT_ONCE) as pool:
        rows = list(pool.map(task, grid))
    failed = {size: message for size, *_, message in rows if message}
    if len(failed) == len(rows):
        raise RuntimeError(f"all trials failed: {failed}")
    if failed:
        warnings.warn(f"trials failed: {failed}", stacklevel=2)
    trials = spark.createDataFrame([r[:3] for r in rows], TUNING_SCHEMA)
    best = select_min_cluster(trials).head()
    valid = valid_sizes(trials).head()["valid_sizes"]
    if report_path is not None:
        scored = trials.filter(~F.isnan("coherence_score")).select("min_cluster_size", "coherence_score")
        write_table(scored.orderBy("min_cluster_size").coalesce(1), report_path, "csv")
    if log_path is not None:
        log_experiment(
            spark, log_path,
            {"n_documents": n, "best_min_cluster_size": best["min_cluster_size"]},
            {"best_coherence_score": best["coherence_score"]},
        )
    return TuningResult(best["min_cluster_size"], best["coherence_score"], valid, trials, parts)
