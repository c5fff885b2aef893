"""Near-duplicates by SimHash and the generalised pigeonhole principle.

A fingerprint's 64 bits are grouped into partitions of correlated bits. If two fingerprints differ in at
most ``tau`` bits, and thresholds t_1 .. t_m (each -1 or more) add up to ``tau - m + 1``, then some
partition i differs in at most t_i bits. Every fingerprint chooses its own thresholds: a dynamic program
takes the cheapest ones by the counts of fingerprints within 0, 1, 2 .. bits of its partition values, so
crowded values are not probed (-1) when looser thresholds elsewhere cost less. Probes meet the
partition values of all fingerprints, and every meeting is verified on all 64 bits.

Equal fingerprints are one row from the start. What a bucket returns are links, or from a crowded
bucket one link per fingerprint to the smallest one it is connected to there; pairs of a group are
never listed. Documents then get the smallest id of their connected component.

Nulls: a null or wordless text has fingerprint zero, linked like any other. A document without id stands
under the ids of its component; a component of such documents alone has none. Rows of one id are
fingerprinted each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.llm.common import bounded_side, doc_key, fresh_name, keyed_texts
from themeloom.llm.components import components
from themeloom.session import materialize

SEED, BITS = 42, 64
SHINGLE, TAU, PARTITIONS = 3, 3, 4
STEP = 200_000  # shingles hashed at once
CROWDED = 64  # members from which a bucket is searched as a graph
PROBE_COST = 2  # a probe costs as much as so many candidates


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of the words of a text, letters A to Z in lower case; repeated shingles count."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = ends[-n:].tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, STEP):
        hashes = np.array(
            [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[at : at + STEP], ends[at : at + STEP])], "<u8"
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for k in range(0, len(bits), 255):  # a byte holds the sum of 255 bits
            ones += np.add.reduce(bits[k : k + 255], axis=0, dtype=np.uint8)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, row_col: str | None = None) -> DataFrame:
    """``doc_id, fp`` of whole texts; ``fp`` holds the 64 bits as a signed number.

    With a column of row numbers, ``row`` and ``doc_key`` as well.
    """
    more = (F.col(row_col).alias("row"), doc_key(docs).alias("doc_key")) if row_col else ()
    names = ["doc_id", "fp", *(("row", "doc_key") if more else ())]

    def run(batches):
        for batch in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.record_batch([batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]], names)

    return keyed_texts(docs, more=more).mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def _bits_of(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def correlated_groups(fps: DataFrame, m: int = PARTITIONS) -> list[list[int]]:
    """Bits in ``m`` groups of near-equal size: each grows by the bit that goes along with it most.

    Joint counts of bit pairs cover all fingerprints; 64 x 64 sums reach the driver.
    """

    def joint(batches):
        total = np.zeros((BITS, BITS))
        for batch in batches:
            bits = _bits_of(batch.column(0).to_numpy()).astype(np.float32)
            for at in range(0, len(bits), 65536):
                total += bits[at : at + 65536].T @ bits[at : at + 65536]
        i, j = np.indices((BITS, BITS))
        yield pa.record_batch([pa.array(x.ravel()) for x in (i, j, total.astype(np.int64))], ["i", "j", "n"])

    sums = fps.select("fp").mapInArrow(joint, "i bigint, j bigint, n bigint").groupBy("i", "j").agg(F.sum("n").alias("n"))
    both = np.zeros((BITS, BITS))
    for i, j, n in sums.collect():
        both[i, j] = n
    rows = max(1, fps.count())
    p = np.diag(both) / rows
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    along = np.abs(both / rows - np.outer(p, p)) / np.outer(spread, spread)
    free, groups = set(range(BITS)), []
    for k in range(m):
        size = -(-len(free) // (m - k))
        first = max(sorted(free), key=lambda b: along[b, sorted(free - {b})].sum() if len(free) > 1 else 0)
        group = [first]
        free.remove(first)
        while len(group) < size:
            nxt = max(sorted(free), key=lambda b: along[b, group].sum())
            group.append(nxt)
            free.remove(nxt)
        groups.append(sorted(group))
    return groups


def partition_values(fps: np.ndarray, group: list[int]) -> np.ndarray:
    out = np.zeros(len(fps), np.int64)
    for k, bit in enumerate(group):
        out |= ((fps >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << k
    return out


def within_counts(counts: np.ndarray, tau: int) -> list[np.ndarray]:
    """Fingerprints whose partition value differs in at most 0, 1 .. ``tau`` bits from each value."""
    exact = [counts.astype(np.int64)] + [np.zeros_like(counts, dtype=np.int64) for _ in range(tau)]
    places = np.arange(len(counts))
    for bit in range(int(len(counts)).bit_length() - 1):
        flipped = places ^ (1 << bit)
        for d in range(tau, 0, -1):
            exact[d] = exact[d] + exact[d - 1][flipped]
    return list(np.cumsum(exact, axis=0))


def allocate(values: list[np.ndarray], costs: list[list[np.ndarray]], tau: int) -> np.ndarray:
    """Thresholds of every fingerprint and partition, at the least estimated cost.

    ``costs[i][t]`` is the cost of threshold t at each value of partition i; -1 costs nothing.
    """
    m, n = len(values), len(values[0])
    target = tau - m + 1
    best = {0: np.zeros(n)}
    chosen: list[dict[int, np.ndarray]] = []
    for i in range(m):
        after, picks = {}, {}
        for done, cost in best.items():
            for t in range(-1, tau + 1):
                total = done + t
                left = m - i - 1
                if not -left <= target - total <= left * tau:
                    continue
                offer = cost if t < 0 else cost + costs[i][t][values[i]]
                if total not in after:
                    after[total], picks[total] = offer.copy(), np.full(n, t)
                else:
                    lower = offer < after[total]
                    after[total][lower], picks[total][lower] = offer[lower], t
        best = after
        chosen.append(picks)
    out, sums = np.empty((m, n), np.int64), np.full(n, target)
    for i in range(m - 1, -1, -1):
        for total, t in chosen[i].items():
            here = sums == total
            out[i, here] = t[here]
        sums = sums - out[i]
    return out


def _flips(width: int, d: int) -> np.ndarray:
    from itertools import combinations

    return np.array([sum(1 << b for b in c) for c in combinations(range(width), d)], np.int64)


def bucket_links(fps: np.ndarray, probes: np.ndarray, runs: np.ndarray, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links inside buckets; ``runs`` are the starts of the buckets and the end of all.

    Small buckets give their links, crowded ones a link from each fingerprint to the smallest it reaches there.
    """
    left, right = [], []
    sizes = np.diff(runs)
    ends = np.repeat(runs[1:], sizes)
    small = np.repeat(sizes <= CROWDED, sizes)
    live = np.flatnonzero(small)
    for d in range(1, CROWDED):
        live = live[live + d < ends[live]]
        if not len(live):
            break
        near = (np.bitwise_count(fps[live] ^ fps[live + d]) <= tau) & (probes[live] | probes[live + d])
        left.append(fps[live[near]])
        right.append(fps[live[near] + d])
    for k in np.flatnonzero(sizes > CROWDED):
        own, asks = fps[runs[k] : runs[k + 1]], probes[runs[k] : runs[k + 1]]
        if not asks.any():
            continue
        open_ = np.arange(len(own))
        while len(open_):
            group, front, open_ = [open_[:1]], open_[:1], open_[1:]
            while len(front) and len(open_):
                step, front = front[:256], front[256:]
                near = np.bitwise_count(own[step][:, None] ^ own[open_][None, :]) <= tau
                near &= asks[step][:, None] | asks[open_][None, :]
                hit = near.any(axis=0)
                group.append(open_[hit])
                front, open_ = np.concatenate([front, open_[hit]]), open_[~hit]
            members = own[np.concatenate(group)]
            if len(members) > 1:
                left.append(np.full(len(members) - 1, members.view(np.int64).min()).view(np.uint64))
                right.append(members[members.view(np.int64) != members.view(np.int64).min()])
    if not left:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(left), np.concatenate(right)


def links(fps: DataFrame, tau: int = TAU, m: int = PARTITIONS) -> DataFrame:
    """``a, b``: enough verified links between distinct fingerprints ``fp`` to connect all within ``tau`` bits."""
    groups = correlated_groups(fps, m)
    widths = [len(g) for g in groups]

    def histogram(batches):
        counts = [np.zeros(1 << w, np.int64) for w in widths]
        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            for i, group in enumerate(groups):
                counts[i] += np.bincount(partition_values(own, group), minlength=len(counts[i]))
        for i, c in enumerate(counts):
            at = np.flatnonzero(c)
            yield pa.record_batch([pa.array(np.full(len(at), i)), pa.array(at), pa.array(c[at])], ["i", "v", "n"])

    held = (
        fps.select("fp").mapInArrow(histogram, "i bigint, v bigint, n bigint").groupBy("i", "v").agg(F.sum("n").alias("n"))
    ).toArrow()  # at most m * 2^16 rows, whatever the size of the table
    counts = [np.zeros(1 << w, np.int64) for w in widths]
    part, value, n = (held.column(c).to_numpy() for c in ("i", "v", "n"))
    for i in range(m):
        counts[i][value[part == i]] = n[part == i]

    def probe(batches):
        flips = [[_flips(w, d) for d in range(tau + 1)] for w in widths]
        costs = [
            [c + PROBE_COST * sum(len(f) for f in flips[i][: t + 1]) for t, c in enumerate(within_counts(counts[i], tau))]
            for i in range(m)
        ]
        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            values = [partition_values(own, g) for g in groups]
            thresholds = allocate(values, costs, tau)
            for i in range(m):
                keys, sent, asks = [values[i]], [own], [thresholds[i] >= 0]
                for d in range(1, tau + 1):
                    wide = thresholds[i] >= d
                    keys.append((values[i][wide][:, None] ^ flips[i][d][None, :]).ravel())
                    sent.append(np.repeat(own[wide], len(flips[i][d])))
                    asks.append(np.ones(len(keys[-1]), bool))
                bucket = np.concatenate(keys) | (i << 32)
                yield pa.record_batch(
                    [pa.array(bucket), pa.array(np.concatenate(sent).view(np.int64)), pa.array(np.concatenate(asks))],
                    ["bucket", "fp", "asks"],
                )

    def verify(batches):
        kept = None

        def solve(bucket, own, asks):
            runs = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
            a, b = bucket_links(own, asks, runs, tau)
            return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            now = [batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy(zero_copy_only=False)]
            if kept is not None:
                now = [np.concatenate(x) for x in zip(kept, now)]
            last = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0
            if last:
                yield solve(*(x[:last] for x in now))
            kept = [x[last:] for x in now]
        if kept is not None and len(kept[0]):
            yield solve(*kept)

    return (
        fps.select("fp").mapInArrow(probe, "bucket bigint, fp bigint, asks boolean")
        .repartition("bucket").sortWithinPartitions("bucket")
        .mapInArrow(verify, "a bigint, b bigint").distinct()
    )


def rooted(own: DataFrame, tau: int = TAU, m: int = PARTITIONS) -> DataFrame:
    """``fp, first_doc, root`` of the distinct fingerprints in ``doc_id, fp``; a component has one root."""
    fps = materialize(own.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "distinct-fingerprints")
    roots = materialize(components(links(fps, tau, m)).withColumnRenamed("node", "fp"), "roots")
    return fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, tau: int = TAU, m: int = PARTITIONS, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest document id reachable through links of at most ``tau`` bits."""
    own = materialize(fingerprints(docs, shingle), "fingerprints")
    placed = rooted(own, tau, m)
    least = placed.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    labelled = materialize(placed.join(least, "root").select("fp", "component_id"), "labelled")
    return own.join(labelled, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of every component, with all its columns: the first by id, rows without id last, then by ``doc_key``.

    Rows are numbered and written, so that rows of one id, rows without id and repeated rows are told apart; of rows
    equal in id and text any one stays.
    """
    number = fresh_name(docs, "row_number")
    rows = materialize(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    own = materialize(fingerprints(rows, row_col=number), "fingerprints")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc_key", "row")
    firsts = own.groupBy("fp").agg(F.min(rank).alias("rank"))
    kept = rooted(own).join(firsts, "fp").groupBy("root").agg(F.min("rank").alias("rank")).select("rank.row")
    gone = materialize(own.join(kept, "row", "left_anti").select(F.col("row").alias("_row")), "gone")
    side = bounded_side(gone)
    return rows.join(side, rows[number] == side["_row"], "left_anti").drop(number)
