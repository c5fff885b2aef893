"""Prefix trie of conversations: a z-fast trie, filled in batches.

A conversation is a sequence of turns; the signature of a prefix is a 128-bit hash of its turns, taken turn after turn.
Equal sequences are one string with a count. The trie is compacted: a node stands for the turns between two places
where strings part or end, and is found by the signature of its handle, the prefix whose length is the two-fattest
number among the node's depths. A string looks for its exit node by fat binary search: it probes the two-fattest length
of the lengths still open, goes on below a node whose turns it has all, and above the length if nothing is there. So
the number of joins grows with the logarithm of its length. The node's turns then tell the exact place where
the string leaves.

A batch inserts one string at every place and next turn where strings leave, the one with the smallest hash; the
others start from that place in the next batch. Hashes choose at random, so some logarithm of the number of strings
is enough batches. An inserted string is a chain of nodes below its place, and later strings cut its
nodes where they leave them. Sums of subtrees go along chains, the last batch first, and from the top
of each chain to the place where it hangs. Nodes are expanded to one row per depth at the end.

Nulls: rows without ``conv_id`` belong to no conversation and are left out; a null role or text is empty, a null turn comes
first. Turns of one number are ordered by a hash of role and text, repeated rows are turns of their own. An empty table
gives no rows. Other columns are ignored. A conversation's signatures, 24 bytes a turn, are one row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from themeloom.llm.common import bounded_batches
from themeloom.session import materialize

SIG = 16  # bytes of a signature
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_lists(rows: DataFrame) -> DataFrame:
    """``conv_id, turns``: hash and code points of every turn, in order."""
    role, text = (F.coalesce(rows[c].cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)))
    turns = rows.select(
        rows["conv_id"].cast("bigint").alias("conv_id"),
        F.struct(rows["turn"].cast("bigint").alias("turn"), digest.alias("digest"), F.char_length(text).cast("bigint").alias("chars")).alias("t"),
    )
    return turns.filter("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def branched(lists: DataFrame, every: int = 100, most: int = 5) -> DataFrame:
    """Every conversation after the first turns, up to ``most``, of the one whose id is the next lower multiple of ``every``.

    How many turns are taken is the crc32 of the decimal id modulo ``most + 1``; as many of its own are replaced.
    """
    bases = lists.filter(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("lead")
    )
    own = lists.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).withColumn(
        "h", (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int")
    )
    lead = F.expr("slice(lead, 1, h)")
    rest = F.expr("slice(turns, h + 1, greatest(size(turns) - h, 0))")
    return own.join(bases, "base", "left").select(
        "conv_id", F.when(F.col("lead").isNull(), rest).otherwise(F.concat(lead, rest)).alias("turns")
    )


def signed(lists: DataFrame) -> DataFrame:
    """``conv_id, key, path, cum``: signatures of all prefixes one after the other, the last of them, code points up to each turn."""
    bounded_batches(lists.sparkSession)

    def run(batches):
        for batch in batches:
            digests, chars = batch.column(1), batch.column(2)
            keys, paths, sums = [], [], []
            for r in range(batch.num_rows):
                now, path = b"", []
                for digest in digests[r].as_py():
                    now = hashlib.blake2b(now + digest, digest_size=SIG).digest()
                    path.append(now)
                keys.append(now)
                paths.append(b"".join(path))
                sums.append(np.cumsum(chars[r].values.to_numpy(zero_copy_only=False), dtype=np.int64))
            yield pa.record_batch(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(paths, pa.binary()), pa.array(sums, pa.list_(pa.int64()))],
                ["conv_id", "key", "path", "cum"],
            )

    given = lists.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.chars").alias("chars"))
    return given.mapInArrow(run, "conv_id bigint, key binary, path binary, cum array<bigint>")


def end_hashes(members: DataFrame) -> DataFrame:
    """``key, ends_sha256`` of the ascending ids of each string; sorted ids stream through, none are gathered."""

    def run(batches):
        now, state = None, None
        for batch in batches:
            done_keys, done = [], []
            for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != now:
                    if state is not None:
                        done_keys.append(now)
                        done.append(state.hexdigest())
                    now, state = key, hashlib.sha256(str(conv).encode())
                else:
                    state.update(b",%d" % conv)
            yield pa.record_batch([pa.array(done_keys, pa.binary()), pa.array(done, pa.string())], ["key", "ends_sha256"])
        if state is not None:
            yield pa.record_batch([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends_sha256"])

    ordered = members.select("key", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id")
    return ordered.mapInArrow(run, "key binary, ends_sha256 string")


def two_fattest(low: str, high: str) -> Column:
    """The number in ``(low, high]`` that the largest power of two divides."""
    bits = f"length(bin({low} ^ {high})) - 1"
    return F.expr(f"shiftleft(shiftright({high}, {bits}), {bits})")


def signature(path: str, place: str) -> Column:
    """The signature at a place, from 1, of a path."""
    return F.expr(f"substring({path}, {SIG} * (({place}) - 1) + 1, {SIG})")


def _node(rows: DataFrame) -> DataFrame:
    """Nodes from ``chain, born, lo, hi, path``, the path being that of their own depths."""
    return rows.withColumn("fat", two_fattest("lo", "hi")).select(
        signature("path", "1").alias("name"), signature("path", "fat - lo").alias("handle"),
        signature("path", "hi - lo").alias("extent"), "chain", "born", "lo", "hi", "path",
    )


NODES = "name binary, handle binary, extent binary, chain binary, born int, lo int, hi int, path binary"


def locate(active: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """Where each string leaves the trie: ``chain, depth`` of the place, and the node it leaves inside.

    Strings come with the place they left before; ``longest`` is the greatest number of turns any has beyond it.
    """
    found = active.withColumn("lo", F.col("depth")).withColumn("hi", F.col("size"))
    at = nodes.select(
        "handle", F.col("extent").alias("n_extent"), F.col("chain").alias("n_chain"), F.col("lo").alias("n_lo"), F.col("hi").alias("n_hi")
    )
    for _ in range(longest.bit_length() + 1):
        # a string that is through asks for a key of its own that no node has, so that these rows do not meet in one task
        asked = found.withColumn("fat", F.when(F.expr("lo < hi"), two_fattest("lo", "hi"))).withColumn(
            "probe", F.when(F.expr("lo < hi"), signature("path", "fat")).otherwise(F.concat("key", "key"))
        )
        met = asked.join(at, asked["probe"] == at["handle"], "left").withColumn(
            "through", (F.col("n_hi") <= F.col("size")) & (signature("path", "n_hi") == F.col("n_extent"))
        )
        found = met.select(
            "key", "size", "path",
            F.expr("if(handle is not null and through, n_chain, chain)").alias("chain"),
            F.expr("case when handle is null then lo when through then n_hi else greatest(lo, n_lo) end").alias("lo"),
            F.expr("case when handle is not null and not through then greatest(lo, n_lo) when handle is null and lo < hi then fat - 1 else hi end").alias("hi"),
        )
    child = nodes.select(F.col("name"), F.col("chain").alias("n_chain"), F.col("lo").alias("n_lo"), F.col("hi").alias("n_hi"), F.col("path").alias("n_path"))
    asked = found.withColumn("probe", F.when(F.expr("lo < size"), signature("path", "lo + 1")).otherwise(F.concat("key", "key")))
    shared = F.expr(
        f"size(filter(sequence(1, least(size, n_hi) - lo), i -> substring(path, {SIG} * (lo + i - 1) + 1, {SIG})"
        f" = substring(n_path, {SIG} * (i - 1) + 1, {SIG})))"
    )
    met = asked.join(child, asked["probe"] == child["name"], "left").withColumn(
        "shared", F.when(F.col("name").isNull(), 0).otherwise(shared)
    )
    return met.select(
        "key", "size", "path", F.when(F.col("name").isNull(), F.col("chain")).otherwise(F.col("n_chain")).alias("chain"),
        (F.col("lo") + F.col("shared")).alias("depth"), F.when(F.expr("lo + shared < n_hi"), F.col("name")).alias("inside"),
    )


def build(strings: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """The trie of ``key, size, path``: its nodes, ``key, parent, depth, born`` of every chain, the ``key, chain, depth`` where each string ends, and the number of batches."""
    spark = strings.sparkSession
    nodes = spark.createDataFrame([], NODES)
    active = strings.filter("size > 0").select("key", "size", "path", F.lit(b"").alias("chain"), F.lit(0).alias("depth"))
    chains = spark.createDataFrame([], "key binary, parent binary, depth int, born int")
    ends = strings.filter("size = 0").select("key", F.lit(b"").alias("chain"), F.lit(0).alias("depth"))
    born = 0
    while True:
        longest = active.agg(F.max(F.col("size") - F.col("depth"))).first()[0]
        if longest is None:
            return nodes, chains, ends, born
        born += 1
        placed = materialize(locate(active, nodes, longest), "placed")
        leaving = placed.filter("depth < size")
        chosen = leaving.groupBy(signature("path", "depth + 1").alias("next")).agg(F.min("key").alias("key"))
        fresh = materialize(leaving.join(chosen.select("key"), "key", "left_semi"), "fresh-chains")
        cuts = placed.filter("inside is not null").select(F.col("inside").alias("name"), "depth").distinct()
        cuts = cuts.groupBy("name").agg(F.sort_array(F.collect_list("depth")).alias("cuts"))  # depths inside one node
        grown = _node(fresh.select(
            F.col("key").alias("chain"), F.lit(born).alias("born"), F.col("depth").alias("lo"), F.col("size").alias("hi"),
            F.expr(f"substring(path, {SIG} * depth + 1, {SIG} * (size - depth))").alias("path"),
        ))
        bounds = F.expr("concat(array(lo), coalesce(cuts, array()), array(hi))")
        parts = nodes.join(cuts, "name", "left").withColumn("bounds", bounds).select(
            "chain", "born", F.col("lo").alias("from"), "path", "bounds", F.explode(F.expr("sequence(1, size(bounds) - 1)")).alias("i")
        ).select(
            "chain", "born", F.expr("bounds[i - 1]").alias("lo"), F.expr("bounds[i]").alias("hi"),
            F.expr(f"substring(path, {SIG} * (bounds[i - 1] - from) + 1, {SIG} * (bounds[i] - bounds[i - 1]))").alias("path"),
        )
        nodes = materialize(_node(parts).unionByName(grown), "nodes")
        chains = chains.unionByName(fresh.select("key", F.col("chain").alias("parent"), "depth", F.lit(born).alias("born")))
        ends = ends.unionByName(placed.filter("depth = size").select("key", "chain", "depth")).unionByName(
            fresh.select("key", F.col("key").alias("chain"), F.col("size").alias("depth"))
        )
        active = leaving.join(fresh.select("key"), "key", "left_anti").select("key", "size", "path", "chain", "depth")


def prefix_nodes(lists: DataFrame) -> DataFrame:
    """One row per prefix of the conversations ``conv_id, turns``: its members, children, leaves, saved tokens and ends."""
    members = materialize(signed(lists), "signed-conversations")
    strings = materialize(
        members.groupBy("key").agg(
            F.count("*").alias("m"), F.min("conv_id").alias("least"), F.first("path").alias("path"), F.first("cum").alias("cum")
        ).withColumn("size", F.size("cum")), "strings",
    )
    nodes, chains, ends, batches = build(strings)
    chains = materialize(chains, "chains")
    # what comes in at a place: the string that ends there, and the chains that hang there
    given = ends.join(strings.select("key", "m", "least"), "key").join(end_hashes(members), "key").select(
        "chain", "depth", F.col("m").alias("n"), "least", F.lit(0).cast("bigint").alias("leaves"), F.lit(0).cast("bigint").alias("saved"),
        F.lit(0).cast("bigint").alias("kids"), "ends_sha256",
    )
    given = materialize(given, "ends")

    def at_places(rows: DataFrame) -> DataFrame:
        return rows.groupBy("chain", F.col("depth").alias("hi")).agg(
            F.sum("n").alias("n"), F.min("least").alias("least"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
            F.sum("kids").alias("kids"), F.max("ends_sha256").alias("ends_sha256"),
        )

    sized = nodes.join(strings.select(F.col("key").alias("chain"), "cum"), "chain").select(
        "chain", "born", "lo", "hi", F.expr("concat(array(if(lo = 0, 0, cum[lo - 1])), slice(cum, lo + 1, hi - lo))").alias("cum")
    )
    sized = materialize(sized, "sized-nodes")
    up = Window.partitionBy("chain").orderBy(F.desc("hi"))  # no more rows than the longest conversation has turns
    filled = None
    for born in range(batches, 0, -1):
        own = sized.filter(F.col("born") == born).join(at_places(given), ["chain", "hi"], "left").fillna(0, ["n", "leaves", "saved", "kids"])
        last = F.row_number().over(up) == 1
        sums = (
            own.withColumn("last", last)
            .withColumn("leaves", F.sum(F.col("leaves") + F.expr("int(last and kids = 0)")).over(up))
            .withColumn("n", F.sum("n").over(up)).withColumn("least", F.min("least").over(up))
            .withColumn("saved", F.sum(F.expr("saved + (n - 1) * (cum[hi - lo] - cum[0])")).over(up))
        )
        done = materialize(sums.select("chain", "lo", "hi", "cum", "n", "least", "leaves", "saved", "kids", "last", "ends_sha256"), "filled")
        tops = done.join(chains.filter(F.col("born") == born).select(F.col("key").alias("chain"), "parent", F.col("depth").alias("lo")), ["chain", "lo"])
        given = given.unionByName(tops.select(
            F.col("parent").alias("chain"), F.col("lo").alias("depth"), "n", "least", "leaves", "saved", F.lit(1).cast("bigint").alias("kids"),
            F.lit(None).cast("string").alias("ends_sha256"),
        ))
        filled = done if filled is None else filled.unionByName(done)
    root = at_places(given.filter("length(chain) = 0")).select(
        F.col("least").alias("conv_id"), F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.col("kids").alias("n_children"), F.greatest("leaves", F.expr("bigint(kids = 0)")).alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    root = materialize(root, "root")
    if filled is None:
        return root
    top = chains.select(F.col("key").alias("chain"), F.col("depth").alias("lo"), "parent")
    above = filled.select(F.col("chain").alias("above"), F.col("hi").alias("lo"), F.col("least").alias("above_least")).unionByName(
        root.select(F.lit(b"").alias("above"), F.lit(0).alias("lo"), F.col("conv_id").alias("above_least"))
    )
    joined = (
        filled.join(top, ["chain", "lo"], "left").withColumn("above", F.coalesce("parent", "chain")).join(above, ["above", "lo"])
        .withColumn("depth", F.explode(F.expr("sequence(lo + 1, hi)")))
    )
    return joined.select(
        F.col("least").alias("conv_id"), F.col("depth").cast("bigint").alias("depth"),
        F.expr("if(depth = lo + 1, above_least, least)").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.expr("if(depth < hi, 1, kids + int(not last))").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.expr("saved - (n - 1) * (cum[depth - 1 - lo] - cum[0])").alias("saved_tokens"),
        F.expr(f"if(depth = hi, coalesce(ends_sha256, '{NO_ENDS}'), '{NO_ENDS}')").alias("ends_sha256"),
    ).unionByName(root)
