"""Ids of texts that hold an added token's string, against an unmodified tokenizer."""

import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from themeloom.llm import bpe
from themeloom.llm import queries as Q

from helpers import odd_rows
from test_tokens import check_packed, crc

BPE = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(BPE)
ENCODER = bpe.UnitEncoder(BPE, 100, special=True)
PARTS = st.lists(
    st.sampled_from(["<|endoftext|>", "<|endof", "text|>", "<", "|", ">", "'s", " ", "  ", "\n", "a", "Zé", "9", "!", "漢"]), max_size=14
).map("".join)


def plain_ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@given(st.lists(PARTS, max_size=8))
@settings(max_examples=400, deadline=None)
def test_units_end_at_added_tokens(texts):
    ids, ends = ENCODER.encode(pa.array(texts, pa.string()), 7)
    for k, text in enumerate(texts):
        assert ids[ends[k] : ends[k + 1]].tolist() == plain_ids(text) + [7]


def folder(spark, tmp_path):
    rows = [(k, t) for k, (_, t, *_) in enumerate(odd_rows())]
    rows += [(100, "a <|endoftext|> b"), (101, "<|endof"), (102, "text|>"), (103, "x<|endoftext|><|endoftext|>'s \n y")]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return rows, str(tmp_path)


def test_queries_give_the_ids_of_the_plain_call(spark, tmp_path):
    assert plain_ids("a <|endoftext|> b") == [64, 220, 50256, 275]
    docs, sf = folder(spark, tmp_path)
    start = 0
    found = {r.doc_id: r for r in Q.op1_token_codes(spark, sf).collect()}
    assert len(found) == len(docs)
    for doc_id, text in docs:
        ids = plain_ids(text) + [2]
        assert (found[doc_id].start, found[doc_id].n_tokens, found[doc_id].ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)
    check_packed(Q.op4_differencing_pack(spark, sf).collect(), docs, PLAIN)
    given_ = spark.read.parquet(f"{sf}/documents.parquet")
    check_packed(corpus_pipeline.pack(spark, given_, sf).collect(), docs, PLAIN)
