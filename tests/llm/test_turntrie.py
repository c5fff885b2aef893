import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from themeloom.llm import turntrie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, key string, depth int"


def plain(convs):
    """Rows of every prefix of ``{conv_id: [(role, text), ...]}``."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p in members:
        own = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += own
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), kids[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def rows_of(frame):
    return sorted(tuple(-1 if v is None else v for v in r) for r in frame.collect())


def test_branched_conversations_equal_plain_prefixes(spark):
    rng = random.Random(5)
    rows = []
    for c in [*range(0, 30), *range(100, 130), 250, 251, -7, -100, -130, 10_007]:
        for turn in range(rng.choice([1, 2, 3, 6, 7, 12])):
            rows.append((c, None if turn == 0 and c % 3 == 0 else turn, rng.choice(["user", None, ""]), rng.choice(["a", "bb", "😀é", None, "x" * 50])))
    rows += [(None, 1, "user", "nobody"), (None, None, None, None)]
    given = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA).repartition(5)
    got = turntrie.prefix_nodes(turntrie.branched(turntrie.turn_lists(given)))
    assert rows_of(got) == plain(rebuilt(rows))


@pytest.mark.parametrize("shape", ["random", "caterpillar", "prefixes", "copies"])
def test_tries_of_many_shapes(spark, shape):
    rng = random.Random(1)
    if shape == "random":
        convs = {c: [("u", rng.choice("ab")) for _ in range(rng.randrange(12))] for c in range(120)}
    elif shape == "caterpillar":
        convs = {c: [("u", "s")] * c + [("u", f"end {c}")] for c in range(40)}
    elif shape == "prefixes":
        convs = {c: [("u", str(d)) for d in range(c)] for c in range(30)}
    else:
        convs = {c: [("u", "hot"), ("a", str(c) if c % 3 else "same"), ("u", "x" * (c % 4))] for c in range(150)}
    rows = [(c, d, r, t, "k", 1) for c, turns in convs.items() for d, (r, t) in enumerate(turns)]
    got = turntrie.prefix_nodes(turntrie.turn_lists(spark.createDataFrame(rows, SCHEMA)))
    assert rows_of(got) == plain({c: t for c, t in convs.items() if t})


def test_tables_without_conversations(spark):
    assert turntrie.prefix_nodes(turntrie.turn_lists(spark.createDataFrame([], SCHEMA))).collect() == []
    lonely = spark.createDataFrame([(102, 0, "user", "only turn, replaced by none", "k", 1)], SCHEMA)  # crc32("102") % 6 is not 0
    got = turntrie.prefix_nodes(turntrie.branched(turntrie.turn_lists(lonely)))
    assert rows_of(got) == plain(rebuilt([(102, 0, "user", "only turn, replaced by none")]))


def test_two_fattest_numbers(spark):
    pairs = [(a, b) for a in range(20) for b in range(a + 1, 40)]
    got = spark.createDataFrame(pairs, "lo int, hi int").select("lo", "hi", turntrie.two_fattest("lo", "hi").alias("f")).collect()
    for r in got:
        assert r["f"] == max(range(r["lo"] + 1, r["hi"] + 1), key=lambda x: x & -x)
