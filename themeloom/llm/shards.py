"""Shards through fixed virtual slots: records hash into slots, slots are mapped to shards.

The number of slots never changes; only the slot-to-shard map does. A map is a table ``version, slot,
shard``; rebalancing writes the next version and moves as few slots as the balance of bytes needs.
Column functions and SQL only.

Nulls and odd rows: a null text has no bytes, a record without id hashes by its checksum, rows of
one id share a slot and are told apart by their checksum. An empty table gives maps of empty slots and
no records. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from themeloom.session import materialize

SLOTS = 4096


def slot_of(doc_id: Column, otherwise: Column, slots: int = SLOTS) -> Column:
    """Slot of an id; records without one are spread by ``otherwise``."""
    return F.pmod(F.xxhash64(doc_id, F.when(doc_id.isNull(), otherwise)), F.lit(slots)).cast("int")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot``: the bytes of the text plus one, and its slot."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary")
    doc_id = docs[id_col].cast("bigint")
    return docs.select(
        doc_id.alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"), slot_of(doc_id, F.crc32(text), slots).alias("virtual_slot"),
    )


def slot_bytes(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``slot, bytes, n`` of every slot, empty ones too; combined in the map tasks first."""
    held = records.groupBy(F.col("virtual_slot").alias("slot")).agg(
        F.sum("size").alias("bytes"), F.count("*").alias("n")
    )
    every = records.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot"))
    return every.join(held, "slot", "left").fillna(0, ["bytes", "n"])


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 1: slots dealt in turn, whatever they will hold."""
    slot = F.col("id").cast("int")
    return spark.range(slots).select(F.lit(1).alias("version"), slot.alias("slot"), F.pmod(slot, F.lit(shards)).alias("shard"))


def rebalance(current: DataFrame, sizes: DataFrame, shards: int, version: int) -> DataFrame:
    """The next version of a map: every shard keeps its largest slots up to the mean, the rest moves.

    What no shard keeps goes, largest first, to the shard with the fewest bytes so far. Both steps work
    on the table of slots, whose size is fixed: a window over a shard's slots, then one fold over
    an array of the moved slots. Growing to more shards only needs the larger ``shards``: they keep nothing.
    """
    slots = current.join(sizes, "slot").select("slot", "shard", "bytes")
    order = Window.partitionBy("shard").orderBy(F.desc("bytes"), "slot").rowsBetween(Window.unboundedPreceding, 0)
    mean = F.sum("bytes").over(Window.partitionBy(F.lit(0))) / shards  # slots are a fixed number of rows
    marked = slots.withColumn("_mean", mean).withColumn("_filled", F.sum("bytes").over(order)).withColumn(
        # a slot larger than the mean stays where it is first in its shard
        "_stays", (F.col("shard") < shards) & ((F.col("_filled") <= F.col("_mean")) | (F.col("_filled") == F.col("bytes")))
    )
    spark = current.sparkSession
    loads = (
        spark.range(shards).select(F.col("id").cast("int").alias("shard"))
        .join(marked.filter("_stays").groupBy("shard").agg(F.sum("bytes").alias("load")), "shard", "left")
        .select(F.struct(F.coalesce("load", F.lit(0)).cast("bigint").alias("load"), "shard").alias("s"))
        .agg(F.sort_array(F.collect_list("s")).alias("loads"))
    )
    moved = marked.filter("not _stays").agg(
        F.sort_array(F.collect_list(F.struct(F.col("bytes").alias("bytes"), F.col("slot").alias("slot"))), asc=False).alias("moved")
    )
    dealt = loads.join(moved, F.lit(True)).select(  # one row each
        F.expr(
            """
            aggregate(
                moved,
                named_struct('loads', loads, 'out', cast(array() as array<struct<slot:int,shard:int>>)),
                (state, x) -> named_struct(
                    'loads', transform(state.loads, (l, i) -> if(
                        l = array_min(state.loads), named_struct('load', l.load + x.bytes, 'shard', l.shard), l)),
                    'out', concat(state.out, array(named_struct('slot', x.slot, 'shard', array_min(state.loads).shard)))
                ),
                state -> state.out
            )
            """
        ).alias("out")
    )
    new = marked.filter("_stays").select("slot", "shard").unionByName(dealt.select(F.inline("out")))
    return new.select(F.lit(version).alias("version"), "slot", "shard")


def append_version(current: DataFrame, path: str) -> None:
    """Add a version to a stored map; earlier ones stay."""
    current.write.mode("append").parquet(path)


def latest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of a stored map, the newest by default."""
    maps = spark.read.schema("version int, slot int, shard int").parquet(path)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.filter(F.col("version") == version)


def place(records: DataFrame, slot_map: DataFrame, sizes: DataFrame) -> DataFrame:
    """Records with ``shard`` and ``place``, the gap-free number of a record in its shard.

    Records are numbered inside their virtual slot, which holds one of thousands of parts of the table;
    where a slot begins in its shard follows from the counts of the slots.
    """
    before = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.join(sizes, "slot").select(
        F.col("slot").alias("virtual_slot"), "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start")
    )
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        records.withColumn("_n", F.row_number().over(within)).join(F.broadcast(starts), "virtual_slot")  # rows: the slots
        .withColumn("place", (F.col("_start") + F.col("_n") - 1).cast("bigint")).drop("_start", "_n")
    )


def shard_by_bytes(docs: DataFrame, shards: int, map_path: str, slots: int = SLOTS) -> DataFrame:
    """Shard a table so that bytes are near equal; map versions 1 and 2 are stored in ``map_path``."""
    spark = docs.sparkSession
    records = materialize(sized(docs, slots=slots), "sized")
    sizes = materialize(slot_bytes(records, slots), "slots")
    append_version(first_map(spark, shards, slots), map_path)
    append_version(rebalance(latest(spark, map_path, 1), sizes, shards, 2), map_path)
    return place(records, latest(spark, map_path), sizes)
