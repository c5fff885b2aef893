"""Shared helpers of the training-data operators: inputs, batches, checksums, numbering."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 8 << 20  # text that one step of a Python task works on; every row is kept
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches handed to Python by bytes as well as by rows."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name, str(2**31 - 1)).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


BROADCAST_ROWS = 1_000_000  # of a few numbers each, counted before such a side is broadcast


def bounded_side(side: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a side of narrow rows if its count allows it; its join shuffles otherwise."""
    return F.broadcast(side) if side.limit(rows + 1).count() <= rows else side


def fresh_name(docs: DataFrame, name: str) -> str:
    """``name``, or it with underscores, so that no column of ``docs`` is called so."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` and text hash, ``doc_id, doc_key``, are not among ``gone``."""
    side = bounded_side(gone.select(F.col("doc_id").alias("_id"), F.col("doc_key").alias("_key")))
    same = (doc_key(docs) == side["_key"]) & docs["doc_id"].cast("bigint").eqNullSafe(side["_id"])
    return docs.join(side, same, "left_anti")


def doc_key(docs: DataFrame):
    """Hash of a row's id and text, by which rows of one id are told apart."""
    return F.xxhash64(docs["doc_id"].cast("bigint"), docs["text"].cast("string"))


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: tuple[Column, ...] = ()) -> DataFrame:
    """``doc_id, text`` and ``more``, so that other columns and their names do not matter; a null text is empty."""
    bounded_batches(docs.sparkSession)
    return docs.select(
        docs[id_col].cast("bigint").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"), *more
    )


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the offsets of its rows in them."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch where its texts reach ``limit`` bytes; a longer text stands alone."""
    if batch.num_rows == 0:
        return
    _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def of_worker(name: str, make):
    """An object that a Python worker makes once and keeps for all its tasks; it must bound itself."""
    import sys
    import types

    kept = sys.modules.setdefault("_themeloom_worker", types.ModuleType("_themeloom_worker")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


class IdPool:
    """Ids of units already encoded, side by side in one array that grows by doubling; at most ``cache_units`` are kept."""

    def __init__(self, cache_units: int):
        self.cache_units = cache_units
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.ends = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64)

    def _remember(self, units: list[bytes], lengths: np.ndarray, flat: np.ndarray) -> None:
        first = len(self.known)
        kept = min(max(0, self.cache_units - first), len(units))
        if not kept:
            return
        begin, grown = int(self.ends[first]), int(lengths[:kept].sum())
        if len(self.ids) < begin + grown:
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), grown), np.int32)])
        if len(self.ends) < first + kept + 1:
            self.ends = np.concatenate([self.ends, np.zeros(max(len(self.ends), kept), np.int64)])
        self.ids[begin : begin + grown] = flat[:grown]
        self.ends[first + 1 : first + kept + 1] = begin + np.cumsum(lengths[:kept])
        self.known.update(zip(units[:kept], range(first, first + kept)))

    def ids_of(self, units: list[bytes], encode) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units one after the other, and where each begins, with the end.

        ``encode`` gives the ids of the units not known yet, one after the other, and how many each has.
        """
        codes = np.fromiter(map(self.known.get, units, repeat(-1)), np.int64, len(units))
        lengths = self.ends[codes + 1] - self.ends[np.maximum(codes, 0)]
        at = np.flatnonzero(codes < 0)
        fresh = [units[i] for i in at.tolist()]
        flat, lengths[at] = encode(fresh)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        out = np.empty(int(ends[-1]), np.int32)
        out[ragged(ends[at], lengths[at])] = flat
        old = np.flatnonzero(codes >= 0)
        out[ragged(ends[old], lengths[old])] = self.ids[ragged(self.ends[codes[old]], lengths[old])]
        self._remember(fresh, lengths[at], flat)
        return out, ends


def dictionary_of(data: np.ndarray, bounds: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Distinct units of bytes cut at ``bounds``, and each unit's place among them."""
    units = pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)]
    ).dictionary_encode()
    return units.dictionary.to_pylist(), units.indices.to_numpy().astype(np.int64)


def crc32_ids(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + lengths[i] - 1`` of every i, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
