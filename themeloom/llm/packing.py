"""Packing token streams into windows by multiway differencing.

Documents are cut into full windows and a remainder, the remainder into a half and two quarters:
pieces of many sizes balance better than equal ones. Groups of some hundred documents are dealt by a
hash, and each group's pieces are spread over m windows by the differencing method of Karmarkar and
Karp: every piece begins as a partial partition (its size and m - 1 zeros), the two partitions with the widest spread are merged, the fullest window
of one with the emptiest of the other, until one is left. If its fullest window holds more than the
capacity, m rises and the group is spread again.

Nulls: a null text is empty, so its end id is all there is. A document without id is packed like any
other. Rows of one id are packed each. An empty table gives no pieces. Other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.llm.bpe import CACHE_UNITS, unit_encoder
from themeloom.llm.common import keyed_texts, ragged, slices
from themeloom.session import work_path

WINDOW = 1024
PIECES_OF_REST, LEAST_PIECE = 3, 8  # a remainder's pieces, and the tokens below which none is halved
GROUP_DOCS = 256  # documents spread together, on average
STEP_BYTES = 4 << 20  # of texts encoded at once
SEQUENCE_BITS = 36  # a sequence id is the group's number and, in these low bits, the window's
PIECES = "doc_key bigint, doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary"


def cut(n: int, window: int = WINDOW) -> tuple[int, list[int]]:
    """Full windows of a document of ``n`` tokens, and the sizes of its remaining pieces."""
    full, rest = divmod(n, window)
    pieces: list[int] = []
    while rest >= 2 * LEAST_PIECE and len(pieces) < PIECES_OF_REST - 1:
        pieces.append(rest // 2)
        rest -= rest // 2
    return full, pieces + [rest] * (rest > 0)


def difference(sizes: np.ndarray, m: int) -> np.ndarray:
    """The window of every piece: multiway differencing of ``sizes`` over ``m`` windows."""
    n = len(sizes)
    sums = np.zeros((n, m), np.int64)  # of each partial partition, fullest window first, less its emptiest
    head, tail = np.full((n, m), -1), np.full((n, m), -1)  # chains of the pieces of each window
    after = np.full(n, -1)
    sums[:, 0] = sizes
    head[:, 0] = tail[:, 0] = np.arange(n)
    widest = [(-int(s), i) for i, s in enumerate(sizes)] if m > 1 else [(0, i) for i in range(n)]
    heapq.heapify(widest)
    while len(widest) > 1:
        _, a = heapq.heappop(widest)
        _, b = heapq.heappop(widest)
        together = sums[a] + sums[b][::-1]
        other_head, other_tail = head[b][::-1], tail[b][::-1]
        joint = (tail[a] >= 0) & (other_head >= 0)
        after[tail[a][joint]] = other_head[joint]
        heads = np.where(head[a] >= 0, head[a], other_head)
        tails = np.where(other_tail >= 0, other_tail, tail[a])
        order = np.argsort(-together, kind="stable")
        sums[a], head[a], tail[a] = together[order], heads[order], tails[order]
        spread = int(sums[a, 0] - sums[a, -1])
        sums[a] -= sums[a, -1]
        heapq.heappush(widest, (-spread, a))
    window = np.empty(n, np.int64)
    for w, piece in enumerate(head[widest[0][1]].tolist()):
        while piece >= 0:
            window[piece] = w
            piece = after[piece]
    return window


def spread(sizes: np.ndarray, capacity: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of every piece; as many windows as the differencing needs to stay within capacity."""
    total = int(sizes.sum())
    m = max(1, -(-total // capacity), total // (capacity - capacity // 512))  # full to the last token hardly ever works
    while True:
        window = difference(sizes, m)
        fullest = int(np.bincount(window, sizes, minlength=m).max())
        if fullest <= capacity:
            break
        # as many windows as bring the fullest down to the capacity if it stays as far above the mean
        m = max(m + 1, -(-total // max(1, capacity - (fullest - total // m))))
    order = np.argsort(window, kind="stable")
    filled = np.cumsum(sizes[order]) - sizes[order]
    first = np.searchsorted(window[order], np.arange(m))
    offset = np.empty(len(sizes), np.int64)
    offset[order] = filled - filled[first][window[order]]
    return window, offset


def write_pieces(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, window: int = WINDOW, special: bool = False,
    cache_units: int = CACHE_UNITS, step_bytes: int = STEP_BYTES,
) -> None:
    """Encode whole texts, close each with ``end_id`` and write its pieces with their ids; ``special`` as in ``bpe``.

    A worker remembers ``cache_units`` encoded units, some 200 bytes each, and encodes ``step_bytes`` of texts at once.
    """

    def encode(batches):
        encoder = unit_encoder(tokenizer, special, cache_units)
        for whole in batches:
            for batch in slices(whole, "text", step_bytes):
                ids, ends = encoder.encode(batch.column(2), end_id)
                tokens = np.diff(ends)
                sizes = [[window] * full + rest for full, rest in (cut(int(n), window) for n in tokens)]
                count = np.fromiter(map(len, sizes), np.int64, len(sizes))
                length = np.fromiter((s for own in sizes for s in own), np.int64, int(count.sum()))
                stop = np.cumsum(length)
                begin = stop - length
                raw = ids.astype("<u4").tobytes()
                row = np.repeat(np.arange(len(count)), count)
                rows = pa.array(row)
                yield pa.record_batch(
                    [
                        batch.column(0).take(rows), batch.column(1).take(rows), pa.array(begin - ends[row]),
                        pa.array(length), pa.array(tokens[row]),
                        pa.array([raw[4 * a : 4 * b] for a, b in zip(begin.tolist(), stop.tolist())], pa.binary()),
                    ],
                    ["doc_key", "doc_id", "start", "length", "doc_tokens", "ids"],
                )

    keyed = keyed_texts(docs).select(F.monotonically_increasing_id().alias("doc_key"), "doc_id", "text")
    keyed.mapInArrow(encode, PIECES).write.option("compression", "zstd").parquet(path)


def placement(pieces: DataFrame, window: int = WINDOW, group_docs: int = GROUP_DOCS) -> DataFrame:
    """``doc_key, start, sequence_id, offset`` of every piece; only the counts of documents move."""
    counts = pieces.filter("start = 0").select("doc_key", "doc_tokens")
    groups = max(1, -(-counts.count() // group_docs))

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_key")
        tokens = group["doc_tokens"].to_numpy()
        full = tokens // window
        rest = [cut(int(n), window)[1] for n in tokens]
        n_rest = np.fromiter(map(len, rest), np.int64, len(rest))
        sizes = np.fromiter((s for own in rest for s in own), np.int64, int(n_rest.sum()))
        begin = np.cumsum(sizes) - sizes
        first_piece = np.cumsum(n_rest) - n_rest
        row = np.repeat(np.arange(len(rest)), n_rest)
        start = full[row] * window + begin - (begin[first_piece[row]] if len(begin) else 0)
        at, offset = spread(sizes, window) if len(sizes) else (sizes, sizes)
        whole = np.repeat(np.arange(len(full)), full)
        number = np.arange(len(whole))
        base = int(group["group"].iloc[0]) << SEQUENCE_BITS
        return pd.DataFrame({
            "doc_key": group["doc_key"].to_numpy()[np.concatenate([whole, row])],
            "start": np.concatenate([ragged(np.zeros(len(full), np.int64), full) * window, start]),
            "sequence_id": base + np.concatenate([number, len(whole) + at]),
            "offset": np.concatenate([np.zeros(len(whole), np.int64), offset]),
        })

    grouped = counts.withColumn("group", F.pmod(F.xxhash64("doc_key"), F.lit(groups)))
    return grouped.groupBy("group").applyInPandas(solve, "doc_key bigint, start bigint, sequence_id bigint, offset bigint")


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, special: bool = False,
    cache_units: int = CACHE_UNITS, step_bytes: int = STEP_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Written pieces with their ids, and where each goes; join them on ``doc_key, start``."""
    spark = docs.sparkSession
    path = work_path(spark, "pieces")
    write_pieces(docs, path, tokenizer, end_id, window, special, cache_units, step_bytes)
    pieces = spark.read.schema(PIECES).parquet(path)
    return pieces, placement(pieces, window)


def digests(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """One row per piece with the checksum of its ids, taken before anything moves."""
    own = pieces.select("doc_key", "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return own.join(placed, ["doc_key", "start"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
