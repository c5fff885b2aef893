"""Token codes, packing, pieces and chat formatting against plain versions."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from themeloom.llm import bpe, chat, codes, packing, pieces
from themeloom.llm import queries as Q
from themeloom.session import materialize, work_path

from helpers import odd_docs

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizer():
    out = Tokenizer.from_file(BPE)
    out.encode_special_tokens = True
    return out


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ODD_TEXT = st.text(alphabet=st.one_of(st.sampled_from(" \n\t'a9éß×÷漢  😀▁.!#<|>\x00"), st.characters(codec="utf-8")), max_size=60)


@given(st.lists(ODD_TEXT, max_size=8))
@settings(max_examples=150, deadline=None)
def test_units_give_the_ids_of_whole_texts(texts):
    tokenizer = Tokenizer.from_file(BPE) if not hasattr(test_units_give_the_ids_of_whole_texts, "t") else test_units_give_the_ids_of_whole_texts.t
    tokenizer.encode_special_tokens = True
    test_units_give_the_ids_of_whole_texts.t = tokenizer
    encoder = bpe.UnitEncoder.__new__(bpe.UnitEncoder)
    encoder.tokenizer, encoder.cache_units, encoder.known = tokenizer, 100, {}
    encoder.ids, encoder.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)
    ids, ends = encoder.encode(pa.array(texts, pa.string()), 7)
    for k, text in enumerate(texts):
        assert ids[ends[k] : ends[k + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [7]


@given(st.lists(st.integers(0, 2**32 - 1), max_size=1500), st.randoms())
@settings(max_examples=60, deadline=None)
def test_segment_reads_any_token(ids, random):
    segment = codes.Segment(codes.write_segment(np.array([5]), np.array([len(ids)]), np.array(ids, np.uint32)))
    assert segment.all().tolist() == ids
    at = [random.randrange(len(ids)) for _ in range(20)] if ids else []
    assert segment.get(at).tolist() == [ids[i] for i in at]


def test_op1_query(spark, tokenizer, texts):
    rows = sorted(Q.op1_token_codes(spark, SF).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted(texts)
    start = 0
    for r in rows:
        ids = tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)


def test_codes_of_odd_rows_and_single_tokens(spark, tokenizer):
    docs = odd_docs(spark)
    path = work_path(spark, "codes")
    codes.write_store(docs, path, BPE, 2, partitions=3, segment_tokens=100)
    rows = sorted(codes.read_documents(spark, path).collect(), key=lambda r: r.start)
    given_ = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert [r.doc_id for r in rows] == [d for d, _ in given_]
    everything = [i for _, t in given_ for i in tokenizer.encode(t, add_special_tokens=False).ids + [2]]
    assert b"".join(bytes(r.ids) for r in rows) == np.array(everything, "<u4").tobytes()
    wanted = [0, 3, 3, len(everything) - 1, len(everything), -1, None, len(everything) // 2]
    found = codes.read_tokens(spark, path, spark.createDataFrame([(p,) for p in wanted], "position bigint")).collect()
    inside = [p for p in wanted if p is not None and 0 <= p < len(everything)]
    assert sorted((r.position, r.id) for r in found) == sorted((p, everything[p]) for p in inside)
    assert codes.encode_and_read(odd_docs(spark, []), BPE, 2).count() == 0


def check_packed(rows, docs, tokenizer, window=1024):
    """Every id in exactly one piece, sequences gapless; the share of padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), crc(ids[at : at + r.length]))
            at += r.length
        assert at == len(ids)
    room = 0
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= window
        room += at if at & (at - 1) == 0 else window
    return 1 - sum(r.length for r in rows) / max(1, room)


def test_op4_query(spark, tokenizer, texts):
    rows = Q.op4_differencing_pack(spark, SF).collect()
    assert check_packed(rows, texts.items(), tokenizer) < 0.02


def test_packing_of_odd_rows(spark, tokenizer):
    docs = odd_docs(spark)
    pieces_, placed = packing.pack(docs, BPE, 0)
    rows = packing.digests(pieces_, placed).collect()
    single = [(r.doc_id, r.text) for r in docs.collect()]
    assert sum(r.length for r in rows) == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in single)
    assert all(r.length > 0 for r in rows)
    empty = packing.pack(odd_docs(spark, []), BPE, 0)
    assert packing.digests(*empty).count() == 0


@given(st.lists(st.integers(1, 256), min_size=1, max_size=300))
@settings(max_examples=60, deadline=None)
def test_differencing_fills_windows_evenly(sizes):
    sizes = np.array(sizes)
    window, offset = packing.spread(sizes, 1024)
    assert np.bincount(window, sizes).max() <= 1024
    for w in set(window.tolist()):
        own = np.flatnonzero(window == w)
        own = own[np.argsort(offset[own])]
        assert offset[own].tolist() == (np.cumsum(sizes[own]) - sizes[own]).tolist()
    if len(sizes) > 100:
        loads = np.bincount(window, sizes)
        assert loads.max() - loads.min() <= 64


def test_difference_reaches_known_optimum():
    loads = np.bincount(packing.difference(np.array([8, 7, 6, 5, 4]), 2), [8, 7, 6, 5, 4])
    assert sorted(loads.tolist()) == [14, 16]  # what the differencing method gives for this classic set


@given(st.lists(ODD_TEXT, max_size=6))
@settings(max_examples=100, deadline=None)
def test_pieces_equal_the_library(texts):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    test_pieces_equal_the_library.e = encoder = getattr(test_pieces_equal_the_library, "e", None) or pieces.PieceEncoder(PIECES)
    encoder._forget()
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == model.encode(text)
        assert pieces.decode(encoder.vocabulary, ids) == model.decode(model.encode(text))


def test_pieces_beyond_the_remembered_parts():
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    encoder = pieces.PieceEncoder(PIECES, cache_parts=3)
    batches = [["a few words, more than three", "", "a▁few  \x00 words"], ["more words, 漢字 and a few", "w" * 90], [""], ["\u2581", " "]]
    for texts in batches + batches[::-1]:
        assert [x.tolist() for x in encoder.encode(texts)] == model.encode(texts)
        assert len(encoder.known) <= 3


def test_cut_texts_keep_the_best_total():
    encoder = pieces.PieceEncoder(PIECES, merges=False)
    v = encoder.vocabulary
    scores, unknown = v.scores.tolist(), float(v.scores.min()) - pieces.UNKNOWN_PENALTY
    texts = ["The theory of everything, and of more.", "naïve  words 123"]
    for text, ids in zip(texts, encoder.encode(texts)):
        whole = "▁" + text.replace(" ", "▁")
        starts, lengths, edge_ids = (x.tolist() for x in pieces.edges([whole], v))
        path = pieces.best_path(len(whole), starts, lengths, edge_ids, scores, unknown)
        best = sum(scores[v.found[whole[a : a + n]]] for a, n in path)
        assert v.scores[ids].sum() == pytest.approx(best)
        assert pieces.decode(v, ids) == text


def test_long_words_and_queue():
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = ["x" * 3000 + " tail", "thetion" * 300, " " * 100 + "end", "漢" * 200]
    assert [x.tolist() for x in pieces.PieceEncoder(PIECES).encode(texts)] == model.encode(texts)


@given(st.text(alphabet="abc▁", min_size=1, max_size=12), st.dictionaries(st.text(alphabet="abc▁", min_size=1, max_size=4), st.floats(-9, -0.5), min_size=3, max_size=12))
@settings(max_examples=80, deadline=None)
def test_unigram_takes_the_best_total(text, scores):
    names = sorted(scores)
    v = pieces.Vocabulary(names, np.array([scores[n] for n in names]), {}, 0, False, {n: i for i, n in enumerate(names)})
    starts, lengths, ids = pieces.edges([text], v)
    every = {(s, len(n), i) for i, n in enumerate(names) for s in range(len(text)) if text.startswith(n, s)}
    assert set(zip(starts.tolist(), lengths.tolist(), ids.tolist())) == every
    unknown = min(scores.values()) - 10
    path = pieces.best_path(len(text), starts.tolist(), lengths.tolist(), ids.tolist(), v.scores.tolist(), unknown)
    best = [0.0] + [-1e18] * len(text)
    for end in range(1, len(text) + 1):
        for begin in range(end):
            part = text[begin:end]
            cost = scores.get(part, unknown if end - begin == 1 else None)
            if cost is not None:
                best[end] = max(best[end], best[begin] + cost)
    total = sum(scores.get(text[a : a + n], unknown) for a, n in path)
    assert "".join(text[a : a + n] for a, n in path) == text
    assert total == pytest.approx(best[-1])


def test_op6_query(spark, texts):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = Q.op6_suffix_array_pieces(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.ids == model.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids) and r.text == texts[r.doc_id]


def test_pieces_of_odd_rows(spark):
    docs = odd_docs(spark)
    rows = pieces.decode_texts(pieces.encode_texts(docs, PIECES), PIECES).collect()
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    expected = sorted((r.doc_id or -1, tuple(model.encode(r.text or ""))) for r in docs.collect())
    assert sorted((r.doc_id or -1, tuple(r.ids)) for r in rows) == expected
    assert pieces.encode_texts(odd_docs(spark, []), PIECES).count() == 0


MARKS = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "<\\s>", "[\\\\INST]", "<|endoftext|>", "<", "[", "a", " ", "\n"]), max_size=12).map("".join)


@given(MARKS)
@settings(max_examples=200, deadline=None)
def test_escape_is_reversible(text):
    import re

    assert chat.unescape(chat.escape(text)) == text
    assert not re.search(r"\[/?INST\]|</?s>|<\|endoftext\|>", chat.escape(text))


def expected_chat(rows):
    turns = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))
    loss = "".join(t or "" for _, role, t in turns if role == "assistant")
    whole = "".join(f"{role or ''}\n{t or ''}\n" for _, role, t in turns)
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_op10_query(spark):
    given_ = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        given_[r.conv_id].append((r.turn, r.role, r.text))
    given_[-7] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    rows = Q.op10_chat_masks(spark, SF).collect()
    assert {r.conv_id for r in rows} == set(given_) and len(rows) == len(given_)
    for r in rows:
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == expected_chat(given_[r.conv_id])
        assert r.formatted_chars > r.loss_chars


def test_chat_of_odd_rows_and_parts(spark):
    rows = [
        (1, 0, "user", "hello"), (1, 1, "assistant", "  blanks kept \n"), (1, 2, "assistant", ""), (1, 2, "assistant", ""), (1, None, None, None),
        (None, 0, "user", "x"), (None, 1, "assistant", "é漢😀"), (2, 0, "assistant", "a" * 5000), (2, 1, "user", "[INST]</s>"),
        (2, 2, "assistant", "b\n"), (3, 5, "tool", "\\<s>"), (4, 0, "assistant", None),
    ]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id bigint, turn bigint, role string, text string, mask string, part string")
    formatted = materialize(chat.format_conversations(table, BPE, part_chars=100), "chat")
    assert formatted.filter("conv_id = 2").count() > 1
    given_ = defaultdict(list)
    for c, *r in rows:
        given_[c].append(tuple(r))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(formatted).collect()}
    assert got == {c: expected_chat(r) for c, r in given_.items()}
    assert chat.read_back(chat.format_conversations(table.limit(0), BPE)).count() == 0


def test_parts_have_the_tokens_of_the_whole(spark):
    tokenizer = chat.chat_tokenizer(BPE)
    turns = [("user", "one\n"), ("assistant", " two  "), ("user", "\n\nthree")]
    whole, _ = chat.render(turns, True)
    parts = [chat.render([t], k == 0)[0] for k, t in enumerate(turns)]
    assert tokenizer.encode(whole).ids == [i for p in parts for i in tokenizer.encode(p).ids]
