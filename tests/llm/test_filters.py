"""Rules, field, edit join, SimHash, search, shards and the pipeline against plain versions."""

import importlib
import math
import random
import sys
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import check
import corpus_pipeline
from themeloom.llm import components, crf, editjoin, pivots, rules, shards, simhash
from themeloom.llm import queries as Q
from themeloom.session import work_path

from helpers import base_measures, edit_distance, labels_of, odd_docs, smallest_reachable

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


# quality rules


def check_base(rows, texts):
    for r in rows:
        n, chars, symbols, same, repeats = base_measures(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, same, repeats)
        assert r.base_failed == (n < 10 or 100 * repeats > 20 * n)
        assert not (r.base_failed and r.kept)


def test_op3_query(spark, texts):
    rows = Q.op3_certified_rules(spark, SF).collect()
    assert len(rows) == len(texts)
    check_base(rows, texts)


def test_measures_of_odd_rows(spark):
    docs = odd_docs(spark)
    rows = rules.judged(docs, labels_of(spark, [(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, 0), (3, 7, 0)])).collect()
    got = sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert got == sorted((r.doc_id or -1, *base_measures(r.text)) for r in docs.collect())
    assert rules.judged(odd_docs(spark, []), labels_of(spark, [])).count() == 0
    assert rules.passing(docs, labels_of(spark, [])).columns == docs.columns


def test_binomial_tail_is_exact(spark):
    cases = [(n, k) for n in (1, 5, 40, 300, 5000) for k in (0, 1, 2, 5, 30) if k <= n]
    rows = spark.createDataFrame(cases, "n bigint, k bigint").select("n", "k", rules.binomial_tail(F.col("n"), F.col("k"), 0.02).alias("p"))
    for n, k, p in rows.collect():
        exact = sum(math.comb(n, j) * 0.02**j * 0.98 ** (n - j) for j in range(k + 1)) if n <= 300 else None
        if k >= 0.02 * n:
            assert p == 1.0
        elif exact is not None:
            assert p == pytest.approx(exact, rel=1e-9)


def test_cutoffs_are_certified_and_reject_bad_texts(spark):
    rng = random.Random(3)
    rows = [(i, "en" if i % 3 else "de", rng.random() * 0.1, 1) for i in range(6000)]
    rows += [(6000 + i, "en", 0.5 + rng.random(), 0) for i in range(1500)]
    table = spark.createDataFrame(rows, "doc_id bigint, stratum string, v double, quality int").withColumns(
        {c: F.lit(1).cast("bigint") for c in rules.MEASURES}
    ).withColumn("n_symbols", F.col("v"))
    only = {"symbols": "n_symbols / word_chars"}
    chosen = {r.stratum: r.cutoff for r in rules.cutoffs(table, 0.02, 0.05, 20, only).collect()}
    assert 0.09 < chosen["en"] <= 0.11 + 0.4
    for stratum, cutoff in chosen.items():
        good = [v for _, s, v, q in rows if s == stratum and q == 1]
        assert sum(v > cutoff for v in good) <= 0.02 * len(good)
    assert rules.cutoffs(table.limit(20), 0.02, 0.05, 20, only).count() == 0  # too few labels certify nothing


def plain_cutoffs(rows, names, alpha, delta, steps):
    """Certified cutoffs of ``(stratum, offers, quality, values)`` rows, by loops over all of them."""
    strata = sorted({s for s, offers, q, _ in rows if offers and q == 1})
    mild = steps // 2
    shares = [rules.MILDEST * (rules.STRICTEST / rules.MILDEST) ** (k / (steps - mild - 1)) for k in range(steps - mild)]
    out = {}
    for stratum in strata:
        part = {(o, q): [v for s, oo, qq, v in rows if (s, oo, qq) == (stratum, o, q)] for o in (True, False) for q in (0, 1)}
        path = [[None] * len(names) for _ in range(steps)]
        for r in range(len(names)):
            good, bad = sorted(v[r] for v in part[True, 1]), [v[r] for v in part[True, 0]]
            spread = max(0.0, max(good + bad) - good[-1])
            grid = [good[-1] + spread * (1 - (k + 1) / mild) for k in range(mild)]
            grid += [good[max(0, math.ceil((1 - x) * len(good)) - 1)] for x in shares]
            for i, c in enumerate(grid):
                above_good, above_bad = sum(v > c for v in good), sum(v > c for v in bad)
                if above_bad and above_bad * (len(good) + 1) >= rules.LIFT * (above_good + 1) * len(bad):
                    path[i][r] = c

        def hits(docs, cuts):
            return sum(any(c is not None and v > c for v, c in zip(doc, cuts)) for doc in docs)

        best, n = (0.0, 0, None), len(part[False, 1])
        for i, cuts in enumerate(path):
            k = hits(part[False, 1], cuts)
            tail = sum(math.comb(n, j) * alpha**j * (1 - alpha) ** (n - j) for j in range(k + 1)) if k < n * alpha else 1.0
            if tail > delta / len(strata):
                break
            gain = hits(part[True, 0], cuts) / max(1, len(part[True, 0])) - hits(part[True, 1], cuts) / len(part[True, 1])
            if gain > best[0]:
                best = (gain, -i, cuts)
        if best[2]:
            out.update({(stratum, name): c for name, c in zip(names, best[2]) if c is not None})
    return out


def planted_measures(seed, sizes):
    """``doc_id, stratum, quality, n_symbols, word_chars, n_words``: bad documents in two kinds, few good ones that look like them."""
    rng, rows = random.Random(seed), []
    for stratum, n in sizes:
        for _ in range(n):
            quality = int(rng.random() > 0.2)
            odd = rng.random() < (0.004 if quality else 0.8)
            kind = rng.random() < 0.5
            symbols = rng.randrange(200, 400) if odd and kind else rng.randrange(0, 12)
            chars = rng.randrange(700, 900) if odd and not kind else rng.randrange(450, 560)
            rows.append((len(rows), stratum, quality, symbols, chars, 100))
    return rows


def measures_table(spark, rows):
    table = spark.createDataFrame(rows, "doc_id bigint, stratum string, quality int, n_symbols bigint, word_chars bigint, n_words bigint")
    return table.withColumns({c: F.lit(0).cast("bigint") for c in rules.MEASURES if c not in table.columns})


def test_certified_cutoffs_equal_a_plain_version_and_hold_on_fresh_documents(spark):
    sizes = [("en", 2000), ("de", 1500), ("fr", 420), ("xx", 60)]
    names = ["symbols", "long_words", "same_lines"]
    only = {n: rules.RULES[n] for n in names}
    fresh = planted_measures(99, [(s, 4000) for s, _ in sizes])

    def values(r):
        return (r[3] / r[4], r[4] / r[5], 0.0)

    for seed in (1, 2):
        rows = planted_measures(seed, sizes)
        table = measures_table(spark, rows)
        part = {r.doc_id: r.p == 0 for r in table.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(rules.OFFERING)).alias("p")).collect()}
        got = {(r.stratum, r.rule): r.cutoff for r in rules.cutoffs(table, rules=only).collect()}
        plain = plain_cutoffs([(r[1], part[r[0]], r[2], values(r)) for r in rows], names, rules.ALPHA, rules.DELTA, rules.CANDIDATES)
        assert got.keys() == plain.keys() and all(got[k] == pytest.approx(plain[k], rel=1e-12) for k in got)
        assert {s for s, _ in got} >= {"en", "de"} and not any(s == "xx" for s, _ in got)
        for stratum in {s for s, _ in got}:
            of = {q: [r for r in fresh if r[1] == stratum and r[2] == q] for q in (0, 1)}
            lost = {
                q: sum(any(v > got.get((stratum, n), math.inf) for n, v in zip(names, values(r))) for r in docs) / len(docs)
                for q, docs in of.items()
            }
            assert lost[1] <= rules.ALPHA and lost[0] > (0.5 if stratum == "en" else 0)  # few labels find less


def test_copies_are_one_label(spark):
    """A thousand copies of one good text certify nothing."""
    rows = [(i, "en", 1, 1, 500, 100) for i in range(1000)] + [(2000 + i, "en", 0, 300, 500 + i, 100) for i in range(50)]
    table = measures_table(spark, rows).withColumn("text_key", F.when(F.col("quality") == 1, F.lit(7)).otherwise(F.col("doc_id")))
    assert rules.cutoffs(table, by="text_key").count() == 0


def test_kept_of_op3_is_what_the_cutoffs_say(spark):
    """Planted texts: symbols and long words go, ordinary texts stay, and repeats of one id are judged by their own text."""
    rng = random.Random(5)
    rows = []
    for i in range(1200):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 7))) for _ in range(40)]
        rows.append((i, " ".join(w + "$$$" if i % 4 == 0 else w for w in words), "en", *["x"] * 10))
    rows.append((1, "### " + " ".join(f"w{i}###" for i in range(40)), "en", *["x"] * 10))
    docs = odd_docs(spark, rows)
    labels = labels_of(spark, [(i, int(i % 4 > 0), 0) for i in range(0, 1200)])
    got = {(r.doc_id, r.n_symbols > 5): r.kept for r in rules.judged(docs, labels).filter("not base_failed").collect()}
    assert all(kept == (not symbols) for (_, symbols), kept in got.items()) and len(got) == 1201
    assert sorted(r.doc_id for r in rules.passing(docs, labels).collect()) == [i for i in range(1200) if i % 4]


# line field


def test_line_measures_and_neighbours():
    import pyarrow as pa

    own, weight, first = crf.line_measures(pa.array(["one two\n\nTHREE!!", "", "a a a\na a a"]))
    assert first.tolist() == [0, 3, 4, 6]
    assert weight.tolist() == [9, 2, 8, 1, 7, 6]  # with the line feed, plus one
    assert own[2, 0] == pytest.approx(5 / 7) and own[1, -1] == 1
    assert own[5, 12] == 1 and own[4, 12] == 0  # the second line repeats the first
    wide = crf.with_neighbours(own, first)
    assert (wide[0, crf.N_OWN : 2 * crf.N_OWN] == 0).all() and (wide[2, crf.N_OWN : 2 * crf.N_OWN] == own[1]).all()
    assert (wide[2, 2 * crf.N_OWN :] == 0).all()


def test_messages_equal_enumeration():
    rng = np.random.default_rng(2)
    e, first, stay = rng.normal(size=9), np.array([0, 4, 5, 9]), (0.7, -0.3)
    forward, backward = crf.messages(e, first, stay)
    for a, b in zip(first, first[1:]):
        n = b - a
        total, good = 0.0, np.zeros(n)
        for state in range(2**n):
            y = [state >> k & 1 for k in range(n)]
            s = sum(e[a + k] for k in range(n) if y[k]) + sum(stay[y[k]] for k in range(1, n) if y[k] == y[k - 1])
            total += math.exp(s)
            good += np.array(y) * math.exp(s)
        assert crf._sigmoid(forward[a:b] + backward[a:b]) == pytest.approx(good / total)


def test_op7_query(spark, texts):
    sf = "/root/testdata/sf0.01"
    rows = Q.op7_line_field(spark, sf).collect()
    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == 1000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out and r.doc_id in known]
    assert sum(r.predicted == known[r.doc_id] for r in held) >= 0.95 * len(held)


def test_field_on_odd_rows(spark):
    docs = odd_docs(spark)
    rows = crf.classify(docs, labels_of(spark, [(1, 1, 0), (12, 0, 0), (12, 1, 0), (4, 1, 0), (None, 0, 0), (3, None, 0)])).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in crf.classify(docs, labels_of(spark, [])).collect()} == {0.5}
    assert crf.classify(odd_docs(spark, []), labels_of(spark, [])).count() == 0
    assert crf.passing(docs, crf.train(docs, labels_of(spark, []))).count() == docs.count()


# line dedup


@given(st.text(alphabet="abé", min_size=4, max_size=30), st.lists(st.tuples(st.integers(0, 2), st.integers(0, 40), st.sampled_from("abé")), max_size=5), st.integers(1, 3))
@settings(max_examples=200, deadline=None)
def test_near_lines_are_found_and_verified(line, edits, tau):
    other = list(line)
    for kind, at, c in edits:
        at %= len(other) + 1
        if kind == 0:
            other.insert(at, c)
        elif at < len(other):
            other[at : at + 1] = [] if kind == 1 else [c]
    other = "".join(other)
    flat, offsets = editjoin.codes([line, other])
    near = bool(editjoin.near(flat, offsets, np.array([0]), np.array([1]), tau)[0])
    assert near == (edit_distance(line, other) <= tau)
    short, long = sorted((line, other), key=len)
    if near and len(short) > tau:
        keys, stored = editjoin.line_keys(short, tau)
        assert {k for k, s in zip(keys, stored) if s} & set(editjoin.line_keys(long, tau)[0])


def plain_line_dedup(docs, tau=2, min_chars=16):
    """``docs``: (doc_id, doc_key, text) in order; the texts with the kept lines."""
    first = {}
    for d in docs:
        for i, line in enumerate((d[2] or "").split("\n")):
            if line.strip(" \t\n\x0b\f\r"):
                first.setdefault(line, (*d[:2], i))
    lines = [x for x in first if len(x) >= min_chars]
    later = {
        b for k, b in enumerate(lines)
        if any(abs(len(a) - len(b)) <= tau and len(set(a) ^ set(b)) <= 2 * tau and edit_distance(a, b) <= tau for a in lines[:k])
    }
    return [
        None if t is None else "\n".join(
            x for i, x in enumerate(t.split("\n")) if x not in first or (first[x] == (d, k, i) and x not in later)
        ) for d, k, t in docs
    ]


@pytest.mark.parametrize("crowded, block", [(24, 1024), (2, 3)])
def test_line_dedup_of_near_lines(spark, monkeypatch, crowded, block):
    monkeypatch.setattr(editjoin.candidates, "__defaults__", (2, crowded, block))
    rng = random.Random(7)
    base = ["".join(rng.choice("abcd ") for _ in range(rng.randint(18, 30))) for _ in range(12)]
    rows = []
    for d in range(60):
        own = []
        for _ in range(3):
            line = list(rng.choice(base))
            for _ in range(rng.randint(0, 3)):
                line[rng.randrange(len(line))] = rng.choice("abcd ")
            own.append("".join(line))
        rows.append((d, "\n".join(own)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = dict(map(tuple, editjoin.dedup_lines(docs).collect()))
    assert [got[d] for d, _ in rows] == plain_line_dedup([(d, 0, t) for d, t in rows])


def test_line_dedup_of_odd_rows(spark):
    docs = odd_docs(spark)
    keyed = docs.filter("doc_id <> 7 or doc_id is null").withColumn("k", F.xxhash64("doc_id", "text"))
    order = sorted({(r.doc_id, r.k, r.text) for r in keyed.collect()}, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected = {(d, k): t for (d, k, _), t in zip(order, plain_line_dedup(order))}
    out = editjoin.dedup_lines(docs, counts=("n_lines", "n_removed"))
    assert out.columns == [*docs.columns, "n_lines", "n_removed"] and out.count() == docs.count()
    kept = sorted((r.doc_id or -1, r.text or "") for r in out.collect() if r.doc_id != 7)
    assert kept == sorted((r.doc_id or -1, expected[r.doc_id, r.k] or "") for r in keyed.collect())
    assert editjoin.dedup_lines(odd_docs(spark, [])).count() == 0


def test_short_lines_go_only_if_equal_and_blank_lines_stay(spark):
    """Short lines have no edits to spare; empty texts and lines of blanks are left as they are."""
    rows = [(1, "Yes.\n\n \t\nNo."), (2, "Yes.\n\nYes!\nno."), (3, "No.\nNo."), (4, ""), (5, None), (6, "\n\n")]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id bigint, text string, _split string, _gone string")
    out = editjoin.dedup_lines(docs, counts=("n_lines", "n_removed"))
    assert out.columns == ["doc_id", "text", "_split", "_gone", "n_lines", "n_removed"]
    got = {r.doc_id: (r.text, r._split, r.n_lines, r.n_removed) for r in out.collect()}
    assert got == {
        1: ("Yes.\n\n \t\nNo.", "x", 4, 0), 2: ("\nYes!\nno.", "x", 4, 1), 3: ("", "x", 2, 2), 4: ("", "x", 1, 0),
        5: (None, "x", 0, 0), 6: ("\n\n", "x", 3, 0),
    }


def test_op9_query(spark, texts):
    rows = Q.op9_line_edit_join(spark, SF).collect()
    keys = {r.doc_id: r.k for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.xxhash64("doc_id", "text").alias("k")).collect()}
    order = sorted((d, keys[d], t) for d, t in texts.items())
    assert {r.doc_id: r.text for r in rows} == {d: t for (d, _, _), t in zip(order, plain_line_dedup(order))}


# SimHash


def plain_fingerprint(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=12), st.integers(1, 4), st.integers(0, 10**6))
@settings(max_examples=60, deadline=None)
def test_allocation_loses_no_pair(fps, m, seed):
    rng = random.Random(seed)
    fps = np.array(fps + [f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for f in fps], np.uint64)
    bits = list(range(64))
    rng.shuffle(bits)
    m += 3  # sixteen bits a partition at most
    groups = [bits[k::m] for k in range(m)]
    values = [simhash.partition_values(fps, g) for g in groups]
    costs = [
        [np.array([rng.random() for _ in range(1 << len(g))]) for _ in range(4)] for g in groups
    ]
    t = simhash.allocate(values, costs, 3)
    assert (t.sum(axis=0) == 3 - m + 1).all()
    for a in range(len(fps)):
        for b in range(len(fps)):
            if np.bitwise_count(fps[a] ^ fps[b]) <= 3:
                assert any(np.bitwise_count(np.uint64(values[i][a] ^ values[i][b])) <= t[i, a] for i in range(m))


def test_within_counts():
    counts = np.random.default_rng(1).integers(0, 5, 64)
    for t, c in enumerate(simhash.within_counts(counts, 3)):
        assert c.tolist() == [sum(counts[v] for v in range(64) if bin(u ^ v).count("1") <= t) for u in range(64)]


def test_links_of_crowded_buckets(spark, monkeypatch):
    rng = random.Random(11)
    centres = [rng.getrandbits(64) for _ in range(3)]
    fps = list({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centres for _ in range(120)})
    table = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp bigint").repartition(3)
    roots = {r.node: r.root for r in components.components(simhash.links(table)).collect()}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    expected = smallest_reachable(signed, lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 3)
    assert [roots.get(f, f) for f in signed] == expected


def test_op5_query(spark, texts):
    rows = {r.doc_id: r for r in Q.op5_simhash_components(spark, SF).collect()}
    ids = sorted(texts)
    fps = [plain_fingerprint(texts[i]) for i in ids]
    assert [rows[i].fingerprint for i in ids] == [f"{f:016x}" for f in fps]
    assert [rows[i].component_id for i in ids] == smallest_reachable(ids, lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 3)


def test_simhash_of_odd_rows(spark):
    docs = odd_docs(spark)
    rows = simhash.near_duplicates(docs).collect()
    fps = [r.fp % (1 << 64) for r in rows]
    assert sorted(fps) == sorted(plain_fingerprint(r.text) for r in docs.collect())
    expected = smallest_reachable([r.doc_id for r in rows], lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 3)
    assert [r.component_id for r in rows] == expected
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert simhash.near_duplicates(odd_docs(spark, [])).count() == 0


def test_components_of_a_long_chain(spark):
    chain = spark.range(300).selectExpr("id as a", "id + 1 as b")
    assert {r.root for r in components.components(chain).collect()} == {0}
    assert components.components(chain.limit(0)).count() == 0


# search


def plain_top(vectors, queries, k=20):
    out = set()
    for q in queries:
        scored = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)}
    return out


@pytest.mark.parametrize("chunk, annuli, most", [(2048, 16, 512), (7, 3, 4)])
def test_search_equals_brute_force(spark, chunk, annuli, most):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.5, 0.0, 0.25, 3.0]) * rng.choice([1, 40]) for _ in range(3)]) for i in range(230)]
    rows += [(1000 + i, [0.25, 0.25, 0.25]) for i in range(60)]
    bad = [(2000, None), (2001, [1.0, None, 2.0]), (2002, [1.0, float("nan"), 0.0]), (2003, [float("inf")] * 3), (None, [1.0, 1.0, 1.0]), (2004, [1.0]), (2005, [])]
    table = spark.createDataFrame([(*r, "x") for r in rows + bad + rows[:5]], "vec_id bigint, embedding array<double>, score string").repartition(3)
    own = pivots.quantised(table)
    found = pivots.search(pivots.build(own, most, annuli, chunk), own.filter("vec_id % 10 = 0"), k=6, rounds=(1, 3)).collect()
    vectors = {i: [math.floor(64 * x) for x in v] for i, v in rows}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in found} == plain_top(vectors, [i for i in vectors if i % 10 == 0], 6)


def test_bounds_hold():
    rng = np.random.default_rng(4)
    v, q = rng.integers(-60, 60, (300, 8)), rng.integers(-60, 60, (40, 8))
    p = v[:5]
    far = pivots.distances(v, p)
    cell = far.argmin(axis=1)
    near = far[np.arange(300), cell]
    length = np.sqrt((v**2).sum(axis=1))
    rings = np.array([(c, 0, 0, near[cell == c].min(), near[cell == c].max(), length[cell == c].max()) for c in range(5)])
    top = pivots.bounds(q, p, rings)
    for c in range(5):
        assert (top[:, c] >= (q @ v[cell == c].T).max(axis=1)).all()


def test_search_of_small_tables(spark):
    schema = "vec_id bigint, embedding array<float>"
    for rows in ([], [(20, [1.0, 2.0])], [(20, None)], [(20, [1.0, 2.0]), (3, [0.5, 0.5])]):
        own = pivots.quantised(spark.createDataFrame(rows, schema))
        found = pivots.search(pivots.build(own), own.filter("vec_id % 20 = 0")).collect()
        assert len(found) == (1 if len(rows) == 2 else 0)


def test_op2_query_equals_sql(spark):
    ok, note = check.compare(spark, check.database(SF), SF, "op2_pivot_topk")
    assert ok, note


# shards


def check_shards(rows, n_shards=16):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return {s: sum(r.size for r in own) for s, own in by.items()}


def test_op8_query(spark, texts):
    rows = Q.op8_slot_shards(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
    loads = check_shards(rows)
    assert len(loads) == 16 and max(loads.values()) < 1.05 * sum(loads.values()) / 16


def test_shards_of_odd_rows_and_versions(spark):
    docs = odd_docs(spark)
    path = work_path(spark, "slot-map")
    placed = shards.shard_by_bytes(docs, 4, path, slots=64)
    check_shards(placed.withColumnRenamed("place", "slot").collect())
    assert placed.count() == docs.count()
    sizes = shards.slot_bytes(shards.sized(docs, slots=64), 64)
    second = shards.latest(spark, path)
    shards.append_version(shards.rebalance(second, sizes, 5, 3), path)
    third = {r.slot: r.shard for r in shards.latest(spark, path).collect()}
    assert sorted(third) == list(range(64)) and set(third.values()) <= set(range(5))
    assert {r.version for r in spark.read.parquet(path).select("version").distinct().collect()} == {1, 2, 3}
    assert {r.slot: r.shard for r in shards.latest(spark, path, 2).collect()} == {r.slot: r.shard for r in second.collect()}
    assert shards.shard_by_bytes(odd_docs(spark, []), 4, work_path(spark, "slot-map"), slots=64).count() == 0


def test_rebalance_moves_little_and_evens_out(spark):
    rng = random.Random(1)
    sizes = spark.createDataFrame([(s, rng.randint(1, 100), 1) for s in range(256)], "slot int, bytes bigint, n bigint")
    first = shards.first_map(spark, 8, 256)
    second = shards.rebalance(first, sizes, 8, 2).join(sizes, "slot").collect()
    before = {r.slot: r.shard for r in first.collect()}
    assert sum(before[r.slot] != r.shard for r in second) < 64
    loads = [sum(r.bytes for r in second if r.shard == s) for s in range(8)]
    assert max(loads) - min(loads) <= 20


# the pipeline


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "line_dedup", "near_dedup", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "packing":
            assert out.columns == docs.columns
        before, after = ({r.doc_id for r in x.select("doc_id").collect()} for x in (docs, out))
        assert after <= before
        if name == "quality_rules":
            rows = {r.doc_id: r for r in rules.judged(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()}
            assert after == {d for d in before if rows[d].kept}
        if name == "quality_classifier":
            assert not [d for d in before - after if known.get(d) == 1]
        if name in ("line_dedup", "packing"):
            assert after == before
        if name == "near_dedup":
            ids = sorted(before)
            texts = {r.doc_id: r.text for r in docs.collect()}
            fps = [simhash.fingerprint(texts[i]) for i in ids]
            assert after == set(smallest_reachable(ids, lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 3))
        path = work_path(spark, name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)


def test_registry_without_the_subpackage():
    """The other queries stay when the subpackage is gone, and only then."""
    import subprocess

    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('themeloom.llm'): raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) > 80 and not [q for q in e.queries() if q.startswith('op')]\n"
    )
    root = importlib.import_module("__spark_entry__").__file__.rsplit("/", 1)[0]
    assert subprocess.run([sys.executable, "-B", "-c", code], cwd=root).returncode == 0
