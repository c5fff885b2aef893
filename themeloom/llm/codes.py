"""Token ids as directly addressable codes: any token is read without decoding a block.

An id is split into chunks of eight bits. Level k holds the k-th chunk of every id that has one, a
bitmap that says which of them go on at level k + 1, and a rank directory: the number of set bits
before every 512th place. Token i is chunk i of level 0; if its bit is set, the rest is found at the
place given by the rank of i at the next level.

A segment is one binary value: header, document ids, document ends, then the levels. Segments are
rows of a Parquet table, in ascending order of document id; a document is never cut.

Nulls: a null text is empty (its end id alone), a document without id comes first. Rows of one id are
ordered by their text. An empty table gives an empty store. Other columns are ignored.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from themeloom.llm.bpe import unit_encoder
from themeloom.llm.common import crc32_ids, keyed_texts, slices
from themeloom.session import work_path

# Fixed values of the format.
MAGIC, VERSION = b"TLDC", 1
HEADER = "<4sHHQQ"  # magic, version, levels, documents, tokens
CHUNK_BITS, BLOCK_BITS = 8, 512
NO_ID = -(2**63)  # stands for a missing document id

SEGMENT_TOKENS = 1 << 20
SEGMENT_SCHEMA = "part int, seq int, before bigint, n_docs bigint, n_tokens bigint, body binary"


def _level(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bytes of one level, and what is left of the ids that go on."""
    more = values >> CHUNK_BITS
    goes_on = more > 0
    n_words = -(-len(values) // BLOCK_BITS) * (BLOCK_BITS // 64)
    bitmap = np.zeros(n_words * 8, np.uint8)
    packed = np.packbits(goes_on, bitorder="little")
    bitmap[: len(packed)] = packed
    per_block = np.bitwise_count(bitmap.view("<u8")).reshape(-1, BLOCK_BITS // 64).sum(axis=1)
    ranks = np.concatenate([[0], np.cumsum(per_block)[:-1]]).astype("<u8") if n_words else np.zeros(0, "<u8")
    chunks = (values & ((1 << CHUNK_BITS) - 1)).astype(np.uint8)
    return struct.pack("<Q", len(values)) + chunks.tobytes() + bitmap.tobytes() + ranks.tobytes(), more[goes_on]


def write_segment(doc_ids: np.ndarray, ends: np.ndarray, ids: np.ndarray) -> bytes:
    """One segment of whole documents; ``ends[i]`` is where document i ends."""
    levels, rest = [], np.asarray(ids, dtype=np.uint32)
    while True:
        block, rest = _level(rest)
        levels.append(block)
        if not len(rest):
            break
    head = struct.pack(HEADER, MAGIC, VERSION, len(levels), len(doc_ids), len(ids))
    return b"".join([head, np.asarray(doc_ids, "<i8").tobytes(), np.asarray(ends, "<u8").tobytes(), *levels])


class Segment:
    """Reader of one segment; nothing is decoded before it is asked for."""

    def __init__(self, body: bytes):
        magic, version, n_levels, n_docs, self.n_tokens = struct.unpack_from(HEADER, body)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a segment of this format")
        at = struct.calcsize(HEADER)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(body, kind, n, at)
            at += out.nbytes
            return out

        self.doc_ids, self.ends = take("<i8", n_docs), take("<u8", n_docs).astype(np.int64)
        self.levels = []
        for _ in range(n_levels):
            n = int(take("<u8", 1)[0])
            blocks = -(-n // BLOCK_BITS)
            self.levels.append((take("u1", n), take("<u8", blocks * (BLOCK_BITS // 64)), take("<u8", blocks)))

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Set bits before each place: the directory, then at most eight words."""
        block, word = at // BLOCK_BITS, at // 64
        out = ranks[block].astype(np.int64)
        first = block * (BLOCK_BITS // 64)
        for k in range(BLOCK_BITS // 64 - 1):
            out += np.where(first + k < word, np.bitwise_count(bits[first + k]), 0)
        low = (np.uint64(1) << (at % 64).astype(np.uint64)) - np.uint64(1)
        return out + np.bitwise_count(bits[word] & low)

    def get(self, places) -> np.ndarray:
        """Ids at given places of the segment."""
        at = np.asarray(places, np.int64)
        out, live = np.zeros(len(at), np.int64), np.arange(len(at))
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            if not len(live):
                break
            out[live] |= chunks[at].astype(np.int64) << (CHUNK_BITS * k)
            on = (bits[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1) == 1
            live, at = live[on], self._rank(bits, ranks, at[on])
        return out

    def all(self) -> np.ndarray:
        """All ids, level by level."""
        rest = np.zeros(0, np.int64)
        for chunks, bits, _ in reversed(self.levels):
            on = np.unpackbits(bits.view(np.uint8), bitorder="little")[: len(chunks)].astype(bool)
            own = chunks.astype(np.int64)
            own[on] |= rest << CHUNK_BITS
            rest = own
        return rest


def write_store(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, partitions: int | None = None,
    segment_tokens: int = SEGMENT_TOKENS, special: bool = False,
) -> None:
    """Encode whole texts and write them to ``path`` in ascending order of ``doc_id``; ``special`` as in ``bpe``.

    Ranges of ids are dealt to tasks before encoding, so texts move once and ids never do. Each
    range is one file whose segments follow each other.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def encode(batches):
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        encoder, doc_ids, lengths, parts = unit_encoder(tokenizer, special), [], [], []

        def segment():
            nonlocal seq, before, doc_ids, lengths, parts
            ids = np.concatenate(parts)
            body = write_segment(np.concatenate(doc_ids), np.cumsum(np.concatenate(lengths)), ids)
            row = [[part], [seq], [before], [sum(map(len, doc_ids))], [len(ids)], [body]]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            seq, before, doc_ids, lengths, parts = seq + 1, before + len(ids), [], [], []
            return pa.record_batch(
                [pa.array(v, k) for v, k in zip(row, kinds)], ["part", "seq", "before", "n_docs", "n_tokens", "body"]
            )

        held = 0
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                ids, ends = encoder.encode(batch.column(1), end_id)
                keys = batch.column(0).fill_null(NO_ID).to_numpy()
                at = 0
                while at < len(keys):  # as many documents as fill the segment
                    room = segment_tokens - held
                    upto = int(np.searchsorted(ends, ends[at] + room, side="right")) - 1
                    if upto <= at and held:
                        yield segment()
                        held = 0
                        continue
                    upto = max(upto, at + 1)
                    doc_ids.append(keys[at:upto])
                    lengths.append(np.diff(ends[at : upto + 1]))
                    parts.append(ids[ends[at] : ends[upto]])
                    held += int(ends[upto] - ends[at])
                    at = upto
        if doc_ids:
            yield segment()

    (
        keyed_texts(docs).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
        .mapInArrow(encode, SEGMENT_SCHEMA).write.option("compression", "uncompressed").parquet(path)
    )


def _with_starts(spark: SparkSession, path: str) -> DataFrame:
    """Segments with ``start``, the tokens of all segments before; one row per file is summed on the driver."""
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    totals = sorted(map(tuple, segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()))
    bases, total = [], 0
    for part, n in totals:
        bases.append((part, total))
        total += n
    table = spark.createDataFrame(bases, "part int, base bigint")
    return segments.join(F.broadcast(table), "part").withColumn("start", F.col("base") + F.col("before"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of a store; ``ids`` are little-endian unsigned 32-bit integers."""

    def decode(batches):
        for batch in batches:
            for start, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                segment = Segment(body)
                ids, ends = segment.all().astype("<u4"), segment.ends
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                yield pa.record_batch(
                    [
                        pa.array(segment.doc_ids, mask=segment.doc_ids == NO_ID), pa.array(begins + start),
                        pa.array(ends - begins), pa.array([ids[a:b].tobytes() for a, b in zip(begins, ends)], pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return _with_starts(spark, path).select("start", "body").mapInArrow(
        decode, "doc_id bigint, start bigint, n_tokens bigint, ids binary"
    )


def read_tokens(spark: SparkSession, path: str, positions: DataFrame, group: int = 1 << 16) -> DataFrame:
    """``position, id`` for corpus-wide token positions; only the asked tokens are decoded.

    Positions join the segments' ranges through blocks of ``SEGMENT_TOKENS``; those outside the store
    and nulls are left out, repeated ones come back as often. A hot segment's positions are cut into
    groups, so no group holds more than one segment and a bounded range of its places.
    """
    segments = _with_starts(spark, path)
    block = F.explode(F.sequence(F.floor(F.col("start") / SEGMENT_TOKENS), F.floor((F.col("start") + F.col("n_tokens") - 1) / SEGMENT_TOKENS)))
    ranges = segments.filter("n_tokens > 0").select("part", "seq", "start", "n_tokens", block.alias("block"))
    wanted = positions.select(F.col("position").cast("bigint")).withColumn("block", F.floor(F.col("position") / SEGMENT_TOKENS))
    found = (
        wanted.join(ranges, "block").filter("position >= start and position < start + n_tokens")
        .withColumn("place", F.col("position") - F.col("start"))
        .groupBy("part", "seq", "start", F.floor(F.col("place") / group).alias("_g"), F.pmod(F.xxhash64("place"), F.lit(16)).alias("_s"))
        .agg(F.collect_list("place").alias("places"))
    )

    def fetch(batches):
        for batch in batches:
            for start, places, body in zip(*(batch.column(k).to_pylist() for k in range(3))):
                at = np.array(places, np.int64)
                yield pa.record_batch([pa.array(at + start), pa.array(Segment(body).get(at))], ["position", "id"])

    joined = found.join(segments.select("part", "seq", "body"), ["part", "seq"])
    return joined.select("start", "places", "body").mapInArrow(fetch, "position bigint, id bigint")


def encode_and_read(docs: DataFrame, tokenizer: str, end_id: int, special: bool = False) -> DataFrame:
    """Write a store into the shared folder and read its documents back."""
    path = work_path(docs.sparkSession, "codes")
    write_store(docs, path, tokenizer, end_id, special=special)
    return read_documents(docs.sparkSession, path)


__all__ = ["Segment", "write_segment", "write_store", "read_documents", "read_tokens", "encode_and_read", "crc32_ids"]
