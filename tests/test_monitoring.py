import datetime as dt

import pytest
from pyspark.sql import functions as F

from themeloom.operators import drift
from themeloom.plans import monitor, registry
from themeloom.plans.fit import TopicModel
from themeloom.streaming.drift import drift_stream, read_drift_history
from themeloom.streaming.windows import window_counts

WORDS = "topic int, words array<string>"


def summary(spark, before, after):
    sims = drift.topic_similarities(spark.createDataFrame(before, WORDS), spark.createDataFrame(after, WORDS))
    return drift.drift_summary(sims).head()


def test_drift(spark):
    same = [(0, ["a", "b"]), (1, ["c", "d"])]
    row = summary(spark, same, same)
    assert (row.mean_similarity, row.has_drift, row.drift_level) == (1.0, False, "LOW")
    row = summary(spark, same, [(0, ["a", "b"]), (7, ["new"])])
    assert row.topic_similarities == {0: 1.0, 1: 0.0} and row.mean_similarity == 0.5 and row.drift_level == "MEDIUM"
    row = summary(spark, [], same)
    assert (row.mean_similarity, row.min_similarity, row.drift_level) == (0.0, 0.0, "HIGH")
    levels = spark.createDataFrame([(0.39,), (0.4,), (0.59,), (0.6,)], "m double").select(drift.drift_level(F.col("m")))
    assert [r[0] for r in levels.collect()] == ["HIGH", "MEDIUM", "MEDIUM", "LOW"]


def test_metric_row(spark):
    counts = spark.createDataFrame([(10, 5)], "n_documents bigint, n_topics bigint")

    def row(score):
        return monitor.metric_row(counts, F.lit(0.5), F.lit(score), F.lit(None).cast("boolean"), F.lit(None).cast("string")).head()

    got = row(0.7)
    assert (got.n_documents, got.n_topics, got.inference_time_sec, got.coherence_score) == (10, 5, 0.5, 0.7)
    assert got.drift_detected is False and got.drift_level == "LOW"
    assert row(0.0).coherence_score is None and row(None).coherence_score is None


@pytest.fixture
def model(spark):
    words = spark.createDataFrame([(0, 1, "alpha", 0.5), (0, 2, "beta", 0.4), (1, 1, "gamma", 0.5)], "topic int, rank int, term string, weight double")
    info = spark.createDataFrame([(0, 3, "n0", ["alpha"], ["d"]), (1, 2, "n1", ["gamma"], ["d"])],
                                 "topic int, count bigint, name string, representation array<string>, representative_docs array<string>")
    centres = spark.createDataFrame([(0, [1.0] * 64, -1.0), (1, [-1.0] * 64, -1.0)], "topic int, centroid array<double>, threshold double")
    none = spark.createDataFrame([], "doc_id bigint, topic int, prob double")
    return TopicModel(none, info, words, centres, {"min_cluster_size": 15})


def test_registry_and_stages(spark, model, tmp_path):
    store = registry.Registry(spark, str(tmp_path / "registry"))
    with pytest.raises(LookupError):
        store.resolve("Production")
    first = store.register(model, 0.5)
    second = store.register(model, 0.6)
    assert (first, second) == (1, 2)
    assert store.resolve("Staging") == 2
    store.move_to_stage(1, "Production")
    assert store.resolve("Production") == 1 and store.resolve("Staging") == 2
    loaded = store.load(1)
    assert loaded.params["min_cluster_size"] == "15" and loaded.info.count() == 2


def test_monitor_keeps_history(spark, model, tmp_path):
    baseline = spark.createDataFrame([(0, ["alpha", "beta"]), (1, ["gamma"])], WORDS)
    watcher = monitor.InferenceMonitor(spark, str(tmp_path / "m"), model, baseline)
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, "beta gamma"), (3, "gamma alpha other")], "doc_id bigint, doc string")
    for _ in range(2):
        result = watcher.run_inference(docs)
        assert result.status == "success", result.error_message
    assert watcher.drift_history().count() == 2 and watcher.performance_report().count() == 2
    row = watcher.dashboard().head()
    assert row.latest_drift.drift_level == "LOW" and len(row.performance_report) == 2
    broken = watcher.run_inference(docs.drop("doc"))
    assert broken.status == "error" and broken.error_message


def test_drift_stream_is_idempotent_per_batch(spark, tmp_path):
    docs = spark.createDataFrame([(i, i % 2, f"alpha{'x' * (i % 2)} beta gamma") for i in range(6)], "doc_id bigint, topic int, doc string")
    docs.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(docs.schema).parquet(str(tmp_path / "in"))
    baseline = spark.createDataFrame([(0, ["alpha", "beta", "gamma"]), (1, ["alphax", "beta", "gamma"])], WORDS)
    for checkpoint in ("c1", "c2"):  # a lost checkpoint replays the batch
        drift_stream(
            stream, lambda b: b.select("doc_id", "topic"), baseline, str(tmp_path / "history"), str(tmp_path / checkpoint)
        ).awaitTermination()
    rows = read_drift_history(spark, str(tmp_path / "history")).collect()
    assert len(rows) == 1 and rows[0].mean_similarity == 1.0


def test_windows_on_a_stream_drop_late_rows(spark, tmp_path):
    t = dt.datetime(2024, 1, 1, 12)

    def part(name, rows):
        spark.createDataFrame(rows, "ts timestamp, kind string").coalesce(1).write.parquet(str(tmp_path / "in" / name))

    part("a", [(t, "x"), (t + dt.timedelta(days=3), "x")])
    schema = "ts timestamp, kind string"
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
        window_counts(stream, "kind").writeStream.format("parquet").outputMode("append").option("path", out).option(
            "checkpointLocation", mark
        ).trigger(availableNow=True).start().awaitTermination()

    run()
    part("b", [(t, "x"), (t + dt.timedelta(days=6), "x")])  # the first row is three days late
    run()
    counts = {r.window_start.day: r.n for r in spark.read.parquet(out).collect()}
    assert counts[1] == 1 and counts[4] == 1


def test_latest_drift_has_one_result_for_records_of_one_time(spark):
    rows = [("m", 5, 0.2), ("m", 5, 0.7), ("m", 4, 0.9), ("n", 1, None), ("n", 1, 0.1)]
    for order in (rows, rows[::-1]):
        history = spark.createDataFrame(order, "model_name string, timestamp long, mean_similarity double").repartition(3)
        history = history.withColumn("topic_similarities", F.create_map(F.lit(1), "mean_similarity"))
        assert {tuple(r)[:3] for r in monitor.latest_drift(history).collect()} == {("m", 5, 0.7), ("n", 1, 0.1)}
