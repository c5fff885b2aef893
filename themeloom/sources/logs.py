"""Append-only tables: experiment log, monitoring log, drift and coherence history."""

from __future__ import annotations

import os

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXPERIMENT_SCHEMA = "timestamp timestamp, params map<string,string>, metrics map<string,double>"
PERFORMANCE_SCHEMA = (
    "timestamp timestamp, n_documents bigint, n_topics bigint, inference_time_sec double, "
    "coherence_score double, drift_detected boolean, drift_level string, model_name string"
)
DRIFT_SCHEMA = (
    "timestamp timestamp, baseline_timestamp timestamp, mean_similarity double, "
    "min_similarity double, topic_similarities map<int,double>, has_drift boolean, "
    "drift_level string, batch_id bigint, model_name string"
)
COHERENCE_SCHEMA = "timestamp timestamp, coherence_score double, n_topics bigint, model_name string"
TUNING_SCHEMA = "min_cluster_size int, coherence_score double, n_topics int"


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Add rows to a log table."""
    df.write.mode("append").format(fmt).save(path)


def read_log(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """A log table; a path that does not exist yet is an empty table."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], schema)
        raise


def log_experiment(spark: SparkSession, path: str, params: dict, metrics: dict) -> None:
    """Append one run as a JSON line."""
    row = spark.createDataFrame(
        [({k: str(v) for k, v in params.items()}, {k: float(v) for k, v in metrics.items()})],
        "params map<string,string>, metrics map<string,double>",
    )
    append(row.select(F.current_timestamp().alias("timestamp"), "params", "metrics"), path, "json")


def read_experiments(spark: SparkSession, path: str) -> DataFrame:
    return read_log(spark, path, EXPERIMENT_SCHEMA, "json")


def create_if_absent(spark: SparkSession, path: str) -> bool:
    """Create an empty file; whether it was not there. Of several at once, one succeeds."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.getScheme() == "file":  # whose Hadoop form looks first and then creates
        local = system.makeQualified(place).toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            os.close(os.open(local, os.O_CREAT | os.O_EXCL))
        except FileExistsError:
            return False
        return True
    if system.exists(place):
        return False
    try:
        system.create(place, False).close()
    except Py4JJavaError:
        if system.exists(place):
            return False
        raise
    return True
