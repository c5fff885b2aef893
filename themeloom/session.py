"""Session helpers: the shared work folder, written intermediates, dense numbering."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Tables whose size was counted first and found at or below this many rows may be
# handled by one task. Everything larger takes the distributed way.
ONE_TASK_ROWS = 100_000

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A folder of this machine is only made up when the setting is absent and the master is
    local, as in tests.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="themeloom-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark)}/themeloom/{name}-{uuid.uuid4().hex}"


_scope = threading.local()


@contextmanager
def temporary_tables(spark: SparkSession):
    """Delete what ``materialize`` writes inside, at the end: for work whose result is taken out of Spark or
    written elsewhere. Scopes belong to a thread; an inner one keeps its own list.
    """
    outer, _scope.paths = getattr(_scope, "paths", None), []
    try:
        yield
    finally:
        written, _scope.paths = _scope.paths, outer
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in written:
            place = hadoop.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def materialize(df: DataFrame, name: str = "table", group_rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Cuts the lineage, survives the loss of executors, and fixes values such as generated ids. Written with zstd, which
    takes less of the shared disk than the default. ``group_rows`` is for rows of megabytes: no more of them are then buffered by
    a writer or read at once, where Parquet would hold a hundred.
    """
    path = work_path(df.sparkSession, name)
    if getattr(_scope, "paths", None) is not None:
        _scope.paths.append(path)
    writer = df.write if group_rows is None else df.write.option("parquet.block.row.count.limit", group_rows)
    writer.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a scan with fewer partitions than cores to all cores.

    Only touches small inputs in few files; a large table has more splits than that and stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def fits_one_task(df: DataFrame, rows: int = ONE_TASK_ROWS) -> bool:
    """Whether ``df`` has at most ``rows`` rows; stops counting beyond that."""
    return df.limit(rows + 1).count() <= rows


def with_dense_index(
    df: DataFrame, order: list[Column], name: str, one_task_rows: int = ONE_TASK_ROWS, rows: int | None = None
) -> DataFrame:
    """Add a gap-free, zero-based index that follows ``order``, which must be a total order.

    A range-partitioned sort numbers the rows inside each partition; the offsets of the
    partitions come from a table with one row per partition. Only a table whose size was checked
    is numbered by a single-partition window. ``rows`` is the count, if it is known already.
    """
    if rows <= one_task_rows if rows is not None else fits_one_task(df, one_task_rows):
        place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))
        return df.withColumn(name, (place - 1).cast("bigint"))
    ranked = materialize(
        df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()), "index"
    )
    part = F.shiftright("_mid", _ROW_BITS)
    counts = sorted(
        (r["p"], r["n"]) for r in ranked.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()
    )
    offsets, total = [], 0
    for p, n in counts:  # one entry per sorted partition, never per row
        offsets.append((p, total))
        total += n
    table = df.sparkSession.createDataFrame(offsets, "_p long, _offset long")
    row_in_part = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        ranked.withColumn("_p", part)
        .join(F.broadcast(table), "_p")  # rows: partitions of the sort
        .withColumn(name, F.col("_offset") + row_in_part)
        .drop("_p", "_mid", "_offset")
    )
