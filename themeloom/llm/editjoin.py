"""Line dedup by a segment-partition edit join.

Lines are compared as code points; two are near when at most ``tau`` insertions, deletions or
substitutions turn one into the other. A line of length l is split into ``tau + 1`` segments, and each is
stored under its number, l and its text. A line of length r >= l that is near has one of these segments
as a substring at a place that the lengths and the edits left on both sides allow, so it probes those
few substrings only. What meets under a key is verified by a banded bit-parallel edit distance.

Of all lines of at least ``min_chars`` code points, in the order of document id and line number, the first of
each text stays unless its text is near one that first stands earlier; all others go. Of shorter lines, for which
``tau`` edits are too many, the first of each text stays (no edit is allowed). Blank lines all stay.

Few lines under a key give candidate pairs; a crowded key gives its members in blocks of bounded size,
each compared in place, and only the lines to drop come out. Texts of lines that met nothing never move.

Nulls: a null text stays null. Documents without id come first. Rows that repeat both id and text are
treated as one and keep the same lines; rows of one id with different texts are ordered by a hash of
them. A text may become empty, its row stays. An empty table gives no rows. Other columns are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.llm.common import BROADCAST_ROWS, bounded_batches, bounded_side, doc_key, fresh_name, slices
from themeloom.session import materialize

TAU, MIN_CHARS = 2, 16
BLANKS = " \t\n\x0b\f\r"
CROWDED, BLOCK = 24, 1024  # lines under a key that are listed as pairs; lines of a block


def segments(length: int, tau: int = TAU) -> list[tuple[int, int]]:
    """Start and size of the ``tau + 1`` segments; sizes differ by one at most."""
    size, longer = divmod(length, tau + 1)
    out, at = [], 0
    for i in range(tau + 1):
        own = size + (i >= tau + 1 - longer)
        out.append((at, own))
        at += own
    return out


def probes(length: int, tau: int = TAU) -> list[tuple[int, int, int, int]]:
    """``(segment, stored length, start, size)`` of the substrings that a line of ``length`` looks up."""
    out = []
    for other in range(max(tau + 1, length - tau), length + 1):
        longer = length - other
        for i, (at, size) in enumerate(segments(other, tau)):
            low = max(0, at - i, at + longer - (tau - i))
            high = min(length - size, at + i, at + longer + (tau - i))
            out += [(i, other, start, size) for start in range(low, high + 1)]
    return out


def line_keys(line: str, tau: int = TAU, memo: dict | None = None) -> tuple[list[int], list[bool]]:
    """Keys of a line, and which of them are its own segments."""
    from xxhash import xxh64_intdigest

    n = len(line)
    plan = memo.get(n) if memo is not None else None
    if plan is None:
        own = {(i, n, at, size) for i, (at, size) in enumerate(segments(n, tau))}
        plan = [(start, start + size, i * 0x9E3779B1 + other, (i, other, start, size) in own) for i, other, start, size in probes(n, tau)]
        if memo is not None:
            memo[n] = plan
    if line.isascii():
        raw = line.encode()
        return [xxh64_intdigest(raw[a:b], seed) for a, b, seed, _ in plan], [s for *_, s in plan]
    return [xxh64_intdigest(line[a:b].encode("utf-8", "surrogatepass"), seed) for a, b, seed, _ in plan], [s for *_, s in plan]


def codes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of lines, one after the other, and their offsets."""
    flat = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4")
    return flat, np.concatenate([[0], np.cumsum([len(x) for x in lines])]).astype(np.int64)


def near(flat: np.ndarray, offsets: np.ndarray, a: np.ndarray, b: np.ndarray, tau: int = TAU) -> np.ndarray:
    """Whether lines a[k] and b[k] are within ``tau`` edits, all pairs side by side.

    One word per pair holds the vertical differences of a band of 2 tau + 1 diagonals; every step takes one
    more character of the longer line, adds up the lowest diagonal's cost and shifts the band.
    """
    la, lb = offsets[a + 1] - offsets[a], offsets[b + 1] - offsets[b]
    swap = la > lb
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    la, lb = np.where(swap, lb, la), np.where(swap, la, lb)
    out = lb - la <= tau
    live = np.flatnonzero(out)
    if not len(live):
        return out
    live = live[np.argsort(-lb[live], kind="stable")]
    a, b, la, lb = a[live], b[live], la[live], lb[live]
    width = 2 * tau + 1
    one = np.uint64(1)
    full = np.uint64((1 << width) - 1)
    # bit k at column j stands for row j + 1 - tau + k; rows above the first count as costs j
    vp = np.full(len(a), full & ~np.uint64((1 << tau) - 1))
    vn = np.zeros(len(a), np.uint64)
    low = np.uint64(tau)  # the main diagonal's bit
    cost = np.zeros(len(a), np.int64)
    starts_a, starts_b = offsets[a], offsets[b]
    places = np.arange(width) - tau
    powers = one << np.arange(width).astype(np.uint64)
    done = np.zeros(len(a), bool)
    final = np.full(len(a), tau + 1)
    longest = int(lb[0])
    for j in range(longest):
        n = int(np.searchsorted(-lb, -j, side="left"))  # pairs with a character at place j
        row = j + places[None, :]
        inside = (row >= 0) & (row < la[:n, None])
        left = flat[np.where(inside, starts_a[:n, None] + row, 0)]
        match = ((left == flat[starts_b[:n] + j][:, None]) & inside) @ powers
        p, q = vp[:n], vn[:n]
        d0 = (((match & p) + p) ^ p) | match | q
        hp = q | (~(d0 | p) & full)
        hn = d0 & p
        cost[:n] += ((d0 >> low) & one == 0).astype(np.int64)
        down = (d0 & full) >> one
        vp[:n] = (hn | (~(down | hp) & full)) & full
        vn[:n] = down & hp
        ends = np.flatnonzero(lb[:n] == j + 1)
        if len(ends):  # from the main diagonal up to the last row of the shorter line
            total = cost[ends].copy()
            for k in range(1, tau + 1):
                step = lb[ends] - la[ends] >= k
                bit = np.uint64(tau - k)
                total -= np.where(step, ((vp[ends] >> bit) & one).astype(np.int64) - ((vn[ends] >> bit) & one).astype(np.int64), 0)
            final[ends] = total
            done[ends] = True
    out[live] = final <= tau
    return out


def lines_of(docs: DataFrame) -> DataFrame:
    """``doc_id, doc_key, line_no, line, h1, h2`` of all lines that are not blank."""
    keyed = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    keyed = keyed.select("doc_id", F.xxhash64("doc_id", "text").alias("doc_key"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return keyed.filter(F.btrim("line", F.lit(BLANKS)) != "").withColumns({"h1": F.xxhash64("line"), "h2": F.hash("line")})


def candidates(lines: DataFrame, tau: int = TAU, crowded: int = CROWDED, block: int = BLOCK) -> DataFrame:
    """``key, b1, b2, a, b``: pairs of line hashes that met, or one member ``a`` of a crowded key's blocks b1 and b2."""
    bounded_batches(lines.sparkSession)

    def keys(batches):
        memo: dict = {}
        for whole in batches:
            for batch in slices(whole, "line"):
                hashes, at = np.unique(batch.column(0).to_numpy(), return_index=True)
                texts = batch.column(1).take(pa.array(at)).to_pylist()
                found = [line_keys(t, tau, memo) for t in texts]
                count = [len(k) for k, _ in found]
                if len(memo) > 20_000:
                    memo.clear()
                yield pa.record_batch(
                    [
                        pa.array(np.array([k for own, _ in found for k in own], np.uint64).view(np.int64)),
                        pa.array(np.repeat(hashes, count)), pa.array([s for _, own in found for s in own], pa.bool_()),
                    ],
                    ["key", "h1", "stored"],
                )

    def meet(batches):
        kept = None

        def solve(key, h, stored):
            order = np.lexsort((~stored, h, key))
            key, h, stored = key[order], h[order], stored[order]
            fresh = np.ones(len(key), bool)
            fresh[1:] = (key[1:] != key[:-1]) | (h[1:] != h[:-1])
            key, h, stored = key[fresh], h[fresh], stored[fresh]
            runs = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
            sizes = np.diff(runs)
            useful = (sizes > 1) & (np.add.reduceat(stored.astype(np.int64), runs[:-1]) > 0)
            few = np.repeat(useful & (sizes <= crowded), sizes)
            ends = np.repeat(runs[1:], sizes)
            live, rows = np.flatnonzero(few), []
            for d in range(1, crowded):
                live = live[live + d < ends[live]]
                if not len(live):
                    break
                on = live[stored[live] | stored[live + d]]
                zero = np.zeros(len(on), np.int32)
                rows.append((np.zeros(len(on), np.int64), zero, zero, np.minimum(h[on], h[on + d]), np.maximum(h[on], h[on + d])))
            for r in np.flatnonzero(useful & (sizes > crowded)):
                own = h[runs[r] : runs[r + 1]]
                blocks = -(-len(own) // block)
                mine = (np.arange(len(own)) % blocks).astype(np.int32)
                for other in range(blocks):
                    low, high = np.minimum(mine, other), np.maximum(mine, other)
                    rows.append((np.full(len(own), key[runs[r]]), low, high, own, np.full(len(own), None)))
            return rows

        def out(rows):
            for k, b1, b2, a, b in rows:
                yield pa.record_batch(
                    [pa.array(k), pa.array(b1), pa.array(b2), pa.array(a), pa.array(b, pa.int64())], ["key", "b1", "b2", "a", "b"]
                )

        for batch in batches:
            now = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)]
            if kept is not None:
                now = [np.concatenate(x) for x in zip(kept, now)]
            last = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0
            if last:
                yield from out(solve(*(x[:last] for x in now)))
            kept = [x[last:] for x in now]
        if kept is not None and len(kept[0]):
            yield from out(solve(*kept))

    keyed = lines.select("h1", "line").mapInArrow(keys, "key bigint, h1 bigint, stored boolean")
    met = keyed.repartition("key").sortWithinPartitions("key").mapInArrow(meet, "key bigint, b1 int, b2 int, a bigint, b bigint")
    return materialize(met.distinct(), "candidates")


def later_lines(lines: DataFrame, firsts: DataFrame, tau: int = TAU) -> DataFrame:
    """``h1, h2`` of texts that are near a text that first stands earlier."""
    met = candidates(lines, tau)
    wanted = materialize(met.select(F.col("a").alias("h1")).union(met.filter("b is not null").select("b")).distinct(), "met")
    texts = lines.join(bounded_side(wanted), "h1", "left_semi").select("h1", "h2", "line").dropDuplicates(["h1", "h2"])
    texts = materialize(texts.join(firsts.select("h1", "h2", "first"), ["h1", "h2"]), "met-lines")

    def side(name: str) -> DataFrame:
        return texts.select(F.col("h1").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in ("h2", "line", "first")))

    pairs = met.filter("b is not null").select("a", "b").distinct().join(side("a"), "a").join(side("b"), "b")
    pairs = pairs.select("a", "a_h2", "a_line", "b", "b_h2", "b_line", (F.col("a_first") < F.col("b_first")).alias("a_leads"))

    def verify(batches):
        for batch in batches:
            left, right = batch.column(2).to_pylist(), batch.column(5).to_pylist()
            flat, offsets = codes(left + right)
            n = len(left)
            good = near(flat, offsets, np.arange(n), np.arange(n) + n, tau)
            leads = batch.column(6).to_numpy(zero_copy_only=False)
            h1 = np.where(leads, batch.column(3).to_numpy(), batch.column(0).to_numpy())[good]
            h2 = np.where(leads, batch.column(4).to_numpy(), batch.column(1).to_numpy())[good]
            yield pa.record_batch([pa.array(h1), pa.array(h2)], ["h1", "h2"])

    members = met.filter("b is null").select("key", "b1", "b2", F.col("a").alias("h1")).distinct().join(texts, "h1")
    members = members.repartition("key", "b1", "b2").sortWithinPartitions("key", "b1", "b2", "first", "h2")

    def compare(batches):
        held: list = []
        now = None

        def solve():
            n = len(held)
            flat, offsets = codes([line for *_, line in held])
            bag = np.zeros((n, 64), np.int16)
            np.add.at(bag, (np.repeat(np.arange(n), np.diff(offsets)), flat % 64), 1)
            length = np.diff(offsets)
            drop = np.zeros(n, bool)
            waiting: list = []

            def settle():
                before, at = (np.concatenate(x) for x in zip(*waiting))
                drop[at[near(flat, offsets, before, at, tau)]] = True
                waiting.clear()

            for at in range(1, n):  # each against all before it that can be near by length and letters
                before = np.flatnonzero(np.abs(length[:at] - length[at]) <= tau)
                before = before[np.abs(bag[before] - bag[at]).sum(axis=1) <= 2 * tau]
                if len(before):
                    waiting.append((before, np.full(len(before), at)))
                    if sum(len(w[0]) for w in waiting) > 8192:
                        settle()
            if waiting:
                settle()
            on = np.flatnonzero(drop)
            return pa.record_batch(
                [pa.array([held[i][0] for i in on], pa.int64()), pa.array([held[i][1] for i in on], pa.int32())], ["h1", "h2"]
            )

        for batch in batches:
            for *group, h1, h2, line in zip(*(c.to_pylist() for c in batch.columns)):
                if group != now:
                    if len(held) > 1:
                        yield solve()
                    held, now = [], group
                held.append((h1, h2, line))
        if len(held) > 1:
            yield solve()

    crowded = members.select("key", "b1", "b2", "h1", "h2", "line").mapInArrow(compare, "h1 bigint, h2 int")
    return pairs.mapInArrow(verify, "h1 bigint, h2 int").union(crowded).distinct()


def dedup_lines(
    docs: DataFrame, tau: int = TAU, min_chars: int = MIN_CHARS, counts: tuple[str, str] | None = None
) -> DataFrame:
    """All columns of ``docs`` with the kept lines in ``text``; ``counts`` names columns for lines and removed lines."""
    lines = lines_of(docs)
    long = lines.filter(F.char_length("line") >= min_chars)
    at = F.struct("doc_id", "doc_key", "line_no")
    places = materialize(lines.select("h1", "h2", "doc_id", "doc_key", "line_no"), "line-places")
    firsts = places.groupBy("h1", "h2").agg(F.min(at).alias("first"), F.count("*").alias("n"))
    firsts = materialize(firsts, "first-lines")
    later = materialize(later_lines(long, firsts, tau), "later-lines").withColumn("later", F.lit(True))
    marked = firsts.join(later, ["h1", "h2"], "left").filter("n > 1 or later").select("h1", "h2", "first", "later")
    removed = places.join(marked, ["h1", "h2"]).filter(F.col("later") | (at != F.col("first"))).select("doc_id", "doc_key", "line_no")
    removed = materialize(removed.groupBy("doc_id", "doc_key").agg(F.collect_set("line_no").alias("gone")), "removed-lines")
    key, gone, id_, split = (fresh_name(docs, n) for n in ("_key", "_gone", "_id", "_split"))
    own = docs.withColumn(key, doc_key(docs))
    found = removed.select(F.col("doc_id").alias(id_), F.col("doc_key").alias("_found_key"), F.col("gone").alias(gone))
    found = bounded_side(found, BROADCAST_ROWS // 4)
    same = (own[key] == found["_found_key"]) & own["doc_id"].cast("bigint").eqNullSafe(found[id_])
    # the split is a column of its own, made once a row; inside a lambda it would be made once a line
    met = own.join(found, same, "left").select(
        *(own[c] for c in docs.columns), found[gone], F.split(own["text"].cast("string"), "\n").alias(split)
    )
    kept = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(gone)))
    text = F.when(F.col(gone).isNotNull(), F.array_join(F.transform(kept, lambda i: F.get(F.col(split), i)), "\n")).otherwise(F.col("text"))
    sizes = (F.when(F.col("text").isNotNull(), F.size(split)).otherwise(0), F.when(F.col(gone).isNotNull(), F.size(gone)).otherwise(0))
    return met.select(*(text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns), *(n.alias(c) for n, c in zip(sizes, counts or ())))
