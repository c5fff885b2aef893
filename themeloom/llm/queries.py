"""Registered queries of the training-data operators: each runs one over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from themeloom.llm import chat, codes, collocations, crf, editjoin, packing, pieces, pivots, rules, shards, simhash, smallworld, turntrie
from themeloom.llm.common import table
from themeloom.session import materialize, work_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

OP1_END_ID = 2
OP4_END_ID = 0
SHARDS = 16


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as directly addressable codes, written and read back."""
    read = codes.encode_and_read(table(spark, sf_dir, "documents"), byte_bpe(), OP1_END_ID, special=True)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_slot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sixteen shards of near-equal bytes."""
    placed = shards.shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS, work_path(spark, "slot-map"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("place").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )


@query
def op5_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and near-duplicate components of all documents."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_differencing_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1,024 tokens."""
    return packing.digests(*packing.pack(table(spark, sf_dir, "documents"), byte_bpe(), OP4_END_ID, special=True))


@query
def op10_chat_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made of control strings, formatted, written and read back."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    formatted = chat.format_conversations(given.unionByName(marks), byte_bpe())
    return chat.read_back(materialize(formatted, "chat"))


@query
def op3_certified_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules with certified cutoffs over all documents."""
    return rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("doc_key")


@query
def op7_line_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by a conditional random field over their lines."""
    return crf.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty highest inner products of every twentieth vector against all others."""
    own = pivots.quantised(table(spark, sf_dir, "embeddings"))
    found = pivots.search(pivots.build(own), own.filter("vec_id % 20 = 0"))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLES["op2_pivot_topk"] = """
with own as (
    select vec_id, [cast(floor(64 * cast(x as double)) as bigint) for x in embedding] as v
    from embeddings
    where embedding is not null and vec_id is not null
      and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), pairs as (
    select q.vec_id as query_id, c.vec_id, cast(list_sum([p[1] * p[2] for p in list_zip(q.v, c.v)]) as bigint) as score
    from own q join own c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from pairs
qualify rank <= 20
"""


@query
def op9_line_edit_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that repeat an earlier line up to two edits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return editjoin.dedup_lines(docs, counts=("n_lines", "n_removed"))


@query
def op6_suffix_array_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of all documents, and the texts decoded from them."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    decoded = pieces.decode_texts(pieces.encode_texts(table(spark, sf_dir, "documents"), model), model)
    return decoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "text")


@query
def op11_rollup_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collocations of every language in all documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op11_rollup_collocations"] = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents
), words as (
    select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces
), starts as (
    select lang, ws, unnest(range(1, len(ws) + 1)) as i from words
), sized as (
    select lang, ws, i, unnest(range(1, 6)) as k from starts
), phrases as materialized (
    select lang, ws[i : i + k - 1] as p, k, count(*) as f
    from sized where i + k - 1 <= len(ws)
    group by all having count(*) >= 100
), totals as (
    select lang, sum(len(ws)) as n from words group by lang
), candidates as (
    select lang, p, k, f as a from phrases where k >= 2
), placed as (
    select lang, p, k, a, unnest(range(1, k)) as j from candidates
), halves as materialized (
    select lang, p, a, j, p[1 : j] as left_p, p[j + 1 : k] as right_p from placed
), with_left as materialized (
    select h.*, f as l from halves h join phrases x on x.lang = h.lang and x.p = h.left_p
), with_both as materialized (
    select h.*, f as r from with_left h join phrases x on x.lang = h.lang and x.p = h.right_p
), cuts as (
    select c.*, t.n, cast((1000::hugeint * a * t.n::hugeint) // (l::hugeint * r) as bigint) as score
    from with_both c join totals t on t.lang = c.lang
), lowest as (
    select * from cuts qualify row_number() over (partition by lang, p order by score, j) = 1
), inner_phrases as (
    select lang, p[s : s + m - 1] as p, max(a) as longest
    from (select *, unnest(range(1, k - m + 2)) as s from (select *, unnest(range(2, k)) as m from candidates))
    group by all
)
select x.lang, row_number() over (partition by x.lang order by score desc, a desc, array_to_string(x.p, ' ')) as rank,
    array_to_string(x.p, ' ') as phrase, a, l, r, cast(n as bigint) as n, score
from lowest x left join inner_phrases i on i.lang = x.lang and i.p = x.p
where i.longest is null or 100 * i.longest < 100 * a
qualify rank <= 2000
"""


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every prefix of the branched conversations, with its members and what sharing it saves."""
    lists = materialize(turntrie.turn_lists(table(spark, sf_dir, "conversations")), "turn-lists")
    return turntrie.prefix_nodes(turntrie.branched(lists))


ORACLES["op12_prefix_trie"] = """
with own as (
    select conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
        order by turn nulls first, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as turns
    from conversations where conv_id is not null group by conv_id
), hashed as (
    select *, xor(list_reduce(list_concat([4294967295], [ord(c)::bigint for c in string_split(cast(conv_id as varchar), '')]),
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 6 as h
    from own
), convs as materialized (
    select o.conv_id, list_concat(coalesce(b.turns, [])[1 : o.h], o.turns[o.h + 1 :]) as turns
    from hashed o left join own b on b.conv_id = o.conv_id - o.conv_id % 100
), prefixes as (
    select conv_id, turns, unnest(range(0, len(turns) + 1)) as depth from convs
), nodes as materialized (
    select turns[1 : depth] as p, depth, min(conv_id) as conv_id, count(*) as n_convs,
        sha256(coalesce(string_agg(case when len(turns) = depth then cast(conv_id as varchar) end, ',' order by conv_id), '')) as ends_sha256
    from prefixes group by all
), children as (
    select p[1 : depth - 1] as p, count(*) as n_children from nodes where depth > 0 group by all
), whole as materialized (
    select n.*, coalesce(c.n_children, 0) as n_children, case when depth = 0 then 0 else (n_convs - 1) * length(n.p[depth].text) end as own_saved
    from nodes n left join children c on c.p = n.p
), below as (
    select p[1 : d] as p, sum(case when n_children = 0 then 1 else 0 end) as n_leaves, sum(own_saved) as saved_tokens
    from (select *, unnest(range(0, depth + 1)) as d from whole) group by all
)
select w.conv_id, cast(w.depth as bigint) as depth, u.conv_id as parent_conv_id, w.n_convs, w.n_children,
    cast(b.n_leaves as bigint) as n_leaves, cast(b.saved_tokens as bigint) as saved_tokens, w.ends_sha256
from whole w join below b on b.p = w.p left join nodes u on w.depth > 0 and u.p = w.p[1 : w.depth - 1]
"""


@query
def op13_small_world_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all vectors at a cosine of 0.9."""
    return smallworld.near_vectors(table(spark, sf_dir, "embeddings"))


ORACLES["op13_small_world_components"] = """
with recursive own as materialized (
    select vec_id, list_transform(embedding, lambda x: cast(x as double)) as v,
        embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0
            and len([x for x in embedding if x <> 0]) > 0 as usable
    from embeddings
), pairs as materialized (
    select a.vec_id as a, b.vec_id as b from own a join own b on a.usable and b.usable and a.vec_id <> b.vec_id
        and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.9
), reach as (
    select vec_id as a, vec_id as b from own union select r.a, p.b from reach r join pairs p on p.a = r.b
), found as (
    select a as vec_id, min(b) as component_id from reach group by a
)
select f.vec_id, coalesce(n.n, 0) as n_links, f.component_id, f.vec_id = f.component_id as kept
from found f left join (select a, count(*) as n from pairs group by a) n on n.a = f.vec_id
"""
