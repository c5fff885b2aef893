"""Phrase collocations by top-order marginalisation.

Texts are cut into pieces at signs and line ends, pieces into words. At every word the next words stand in lead
columns, zero beyond the piece: the padded longest window. Only these windows are counted, and ROLLUP over the
columns sums them to every shorter prefix, so one table holds the counts of all phrases of two words and more. Windows
travel packed to the bucket of their first words, which counts them and drops ends that are not frequent.

Texts are read once. Each batch writes its words as numbers of a dictionary of its own; the dictionaries give the
counts of words. Words that are frequent get their final numbers from a vocabulary whose size is counted: one that
is small enough is broadcast, a larger one is joined to the dictionaries. A phrase can only be frequent if its words are, and each two neighbours in it; windows
therefore end before a word, or between two words, that is not. No frequent phrase loses an occurrence by this. The
frequent pairs are broadcast when their count allows it; beyond that windows only end at words.

A candidate is cut in two at every place; the lowest ``floor(scale * a * n / (l * r))``, in decimals of 38 digits, is
its score. Candidates inside a longer one that is as frequent go.

Nulls: a null text is empty, a null language is ``und``. Repeated rows count each. Ties in score and count are broken
by the phrase in byte order. Empty tables, and languages without a frequent phrase, give no rows. Other columns
are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from themeloom.llm.common import BROADCAST_ROWS, bounded_batches, bounded_side, slices, text_bytes
from themeloom.session import materialize, spread, with_dense_index

ORDER, MIN_COUNT, TOP, SCALE = 5, 100, 2000, 1000
NO_LANG = "und"
VOCABULARY_ROWS = 4_000_000  # frequent words sent to every task, counted before; some 100 MB
ONE_TASK_WORDS = 10_000  # frequent words numbered by one task
BUCKET_WORDS = 2_000_000  # words of the texts whose windows one bucket counts, on average
ADDED_ROWS = 1 << 19  # windows of a bucket that are opened before they are added up
GROUP_ROWS = 8  # batches of texts in a Parquet row group, which is read at once
WORD, BLANK, SIGN = 0, 1, 2
BATCHES = "uid bigint, stream binary, langs array<string>, words array<string>, counts array<bigint>"


def _tables() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[ord("A") : ord("Z") + 1] += 32
    kind = np.full(256, WORD, np.uint8)
    kind[[0x20, 0x09]] = BLANK
    kind[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = SIGN
    return lower, kind


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of all rows, the row of each, and whether it stands first in its piece."""
    data, offsets = text_bytes(texts)
    lower, kinds = _tables()
    data = lower[data]
    kind = kinds[data]
    inside = kind == WORD
    first_byte = offsets[:-1][offsets[:-1] < len(data)]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[first_byte] = inside[first_byte]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, bool)
    lengths = np.add.reduceat(inside, starts, dtype=np.int64)
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data[inside])])
    cuts = kind == SIGN
    cuts[first_byte] = True
    piece = np.cumsum(cuts, dtype=np.int32)[starts]
    leads = np.ones(len(starts), bool)
    leads[1:] = piece[1:] != piece[:-1]
    return words, np.searchsorted(offsets, starts, side="right") - 1, leads


def numbered_batches(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One written row per batch of texts: its distinct words by language with counts, and its words as numbers.

    ``stream`` holds 32-bit numbers from 1 into these lists; a zero stands before each piece.
    """
    bounded_batches(docs.sparkSession)

    def number(batches):
        for whole in batches:
            for batch in slices(whole, "text", 2 << 20):
                words, rows, leads = words_of(batch.column(1))
                if not len(words):
                    continue
                coded, spoken = words.dictionary_encode(), batch.column(0).dictionary_encode()
                n_langs = len(spoken.dictionary)
                both = coded.indices.to_numpy().astype(np.int64) * n_langs + spoken.indices.to_numpy()[rows]
                pairs, local, counts = np.unique(both, return_inverse=True, return_counts=True)
                stream = np.zeros(len(local) + int(leads.sum()), "<i4")
                stream[np.arange(len(local)) + np.cumsum(leads)] = local + 1
                lists = [
                    spoken.dictionary.take(pa.array(pairs % n_langs)), coded.dictionary.take(pa.array(pairs // n_langs)),
                    pa.array(counts.astype(np.int64)),
                ]
                yield pa.record_batch(
                    [
                        pa.array([uuid.uuid4().int >> 65]), pa.array([stream.tobytes()], pa.binary()),
                        *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists),
                    ],
                    ["uid", "stream", "langs", "words", "counts"],
                )

    texts = spread(docs.select(
        F.coalesce(docs[lang_col].cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    ))
    return materialize(texts.mapInArrow(number, BATCHES), "numbered-words", GROUP_ROWS)


def frequent_words(batches: DataFrame, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Dictionary rows ``uid, local, lang, word, n``; frequent words ``lang, word, f, id``; words of each ``lang``, ``n``."""
    entries = batches.select(
        "uid", F.posexplode(F.arrays_zip("langs", "words", "counts")).alias("local", "e")
    ).select("uid", (F.col("local") + 1).alias("local"), F.col("e.langs").alias("lang"), F.col("e.words").alias("word"),
             F.col("e.counts").alias("n"))
    counts = entries.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= min_count)
    vocab = with_dense_index(materialize(counts, "frequent-words"), [F.col("lang"), F.col("word")], "id", ONE_TASK_WORDS)
    vocab = materialize(vocab.withColumn("id", (F.col("id") + 1).cast("int")), "vocabulary")
    totals = batches.select(F.explode(F.arrays_zip("langs", "counts")).alias("e"))
    totals = totals.groupBy(F.col("e.langs").alias("lang")).agg(F.sum("e.counts").alias("n"))
    return entries, vocab, materialize(totals, "words-by-language")


def _frequent_only(stream: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """The stream in the numbers ``place`` gives, without frequent words that have no frequent neighbour."""
    now = place[stream]
    beside = np.zeros(len(now), bool)  # words with a frequent neighbour, and the zero after them
    beside[1:] |= now[:-1] > 0
    beside[:-1] |= (now[:-1] > 0) & (now[1:] > 0)
    return pa.record_batch([pa.array([now[beside].tobytes()], pa.binary())], ["stream"])


def frequent_streams(batches: DataFrame, entries: DataFrame, vocab: DataFrame, broadcast_rows: int = VOCABULARY_ROWS) -> DataFrame:
    """``stream``: the batches in numbers of frequent words, zero for all else.

    A vocabulary of at most ``broadcast_rows`` words goes to every task; a larger one is joined to the dictionaries.
    """
    if vocab.count() <= broadcast_rows:
        held = vocab.select("lang", "word", "id").toArrow().combine_chunks()
        by_lang = {
            lang: held.filter(pc.equal(held.column(0), lang)).select(["word", "id"]).combine_chunks()
            for lang in pc.unique(held.column(0)).to_pylist()
        }

        def look_up(rows):
            for batch in rows:
                for r in range(batch.num_rows):
                    langs, words = batch.column(1)[r].values, batch.column(2)[r].values
                    place = np.zeros(len(words) + 1, "<i4")
                    for lang in pc.unique(langs).to_pylist():
                        own = by_lang.get(lang)
                        if own is None:
                            continue
                        at = np.flatnonzero(pc.equal(langs, lang).to_numpy(zero_copy_only=False))
                        known = pc.index_in(words.take(pa.array(at)), own.column(0).combine_chunks())
                        place[at + 1] = pc.fill_null(own.column(1).combine_chunks().take(known), 0).to_numpy()
                    yield _frequent_only(np.frombuffer(batch.column(0)[r].as_py(), "<i4"), place)

        rows = batches.select("stream", "langs", "words")
        return materialize(rows.mapInArrow(look_up, "stream binary"), "frequent-streams", GROUP_ROWS)

    known = entries.select("uid", "local", "lang", "word").join(vocab, ["lang", "word"]).groupBy("uid").agg(
        F.collect_list(F.struct("local", "id")).alias("known")  # no more than one batch's words
    )

    def renumber(rows):
        for batch in rows:
            for r in range(batch.num_rows):
                stream = np.frombuffer(batch.column(0)[r].as_py(), "<i4")
                place = np.zeros(int(stream.max(initial=0)) + 1, "<i4")
                place[batch.column(1)[r].values.field(0).to_numpy()] = batch.column(1)[r].values.field(1).to_numpy()
                yield _frequent_only(stream, place)

    joined = batches.select("uid", "stream").join(known, "uid").select("stream", "known")
    return materialize(joined.mapInArrow(renumber, "stream binary"), "frequent-streams", GROUP_ROWS)


def _summed(columns: list[np.ndarray], n: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of number columns, sorted, and their counts added up."""
    n = np.ones(len(columns[0]), np.int64) if n is None else n
    if not len(n):
        return columns, n
    if len(columns) == 2:
        order = np.argsort(columns[0].astype(np.int64) << 32 | columns[1], kind="stable")
    else:
        order = np.lexsort(columns[::-1])
    n = n[order]
    fresh = np.zeros(len(n), bool)
    fresh[:1] = True
    for c in columns:  # one column at a time is held in order
        own = c[order]
        fresh[1:] |= own[1:] != own[:-1]
    at = np.flatnonzero(fresh)
    order = order[at]
    return [c[order] for c in columns], np.add.reduceat(n, at)


def _added_up(records: Iterator[tuple[bytes | pa.Buffer, int]], width: int) -> tuple[list[np.ndarray], np.ndarray]:
    """All windows of packed records, sorted, and their counts; what is open grows with the distinct windows."""
    held, n = [np.zeros(0, "<i4")] * width, np.zeros(0, np.int64)
    parts, rows = [], 0

    def merged() -> tuple[list[np.ndarray], np.ndarray]:
        columns = [np.concatenate([held[i], *(p[i] for p in parts)]) for i in range(width)]
        counts = np.concatenate([n, *(p[width] for p in parts)])
        parts.clear()
        return _summed(columns, counts)

    for record, size in records:
        parts.append(_opened(record, size, width + 1))
        rows += parts[-1].shape[1]
        if rows >= max(ADDED_ROWS, len(n)):
            held, n = merged()
            rows = 0
    return merged() if parts else (held, n)


def _fresh(columns: list[np.ndarray]) -> np.ndarray:
    """Whether a sorted row differs from the one before."""
    fresh = np.zeros(len(columns[0]), bool)
    fresh[:1] = True
    for c in columns:
        fresh[1:] |= c[1:] != c[:-1]
    return fresh


def _dealt(columns: list[np.ndarray], n: np.ndarray, lead: int, buckets: int):
    """``bucket, size, record``: sorted rows by the hash of their first ``lead`` numbers, packed column by column."""
    mixed = np.zeros(len(n), np.uint64)
    for c in columns[:lead]:
        mixed = (mixed ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    bucket = mixed % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
    table = np.stack([*columns, np.minimum(n, np.iinfo(np.int32).max)]).astype("<i4")[:, order]  # a batch holds fewer words
    codec = pa.Codec("zstd")
    for b in np.flatnonzero(np.diff(ends)).tolist():
        part = table[:, ends[b] : ends[b + 1]]
        part = np.concatenate([np.diff(part[:1], axis=1, prepend=0), part[1:]]).astype("<i4")  # the first number hardly changes
        raw = np.ascontiguousarray(np.ascontiguousarray(part).view(np.uint8).reshape(*part.shape, 4).transpose(0, 2, 1))
        yield b, raw.size, codec.compress(raw.tobytes(), asbytes=True)


def _opened(record: bytes | pa.Buffer, size: int, width: int) -> np.ndarray:
    raw = np.frombuffer(pa.Codec("zstd").decompress(record, size, asbytes=True), np.uint8).reshape(width, 4, -1)
    table = np.ascontiguousarray(raw.transpose(0, 2, 1)).view("<i4")[:, :, 0].copy()
    table[0] = np.cumsum(table[0], dtype="<i4")
    return table


def _shortened(columns: list[np.ndarray], n: np.ndarray, least: int, min_count: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted windows up to their longest beginning that occurs ``min_count`` times, if that has ``least`` words or more.

    All windows with a common beginning of ``least`` words have to be given.
    """
    columns = list(columns)
    for k in range(len(columns), least - 1, -1):
        at = np.flatnonzero(_fresh(columns[:k]))
        rare = np.repeat(np.add.reduceat(n, at) < min_count, np.diff(at, append=len(n)))
        if k > least:
            columns[k - 1] = np.where(rare, 0, columns[k - 1])
        else:
            columns, n = [c[~rare] for c in columns], n[~rare]
        if not len(n):
            break
        columns, n = _summed(columns, n)
    return columns, n


def lead_windows(stream: np.ndarray, order: int, pairs: np.ndarray | None = None, least: int = 2) -> list[np.ndarray]:
    """Lead columns of every window of ``least`` words or more; ``pairs`` are those that may stand in one, sorted."""
    padded = np.concatenate([stream, np.zeros(order, stream.dtype)])
    goes_on = (padded[:-1] > 0) & (padded[1:] > 0)
    if pairs is not None:
        at = np.flatnonzero(goes_on)
        keys = padded[at].astype(np.int64) << 32 | padded[at + 1]
        place = np.searchsorted(pairs, keys)
        goes_on[at] = (place < len(pairs)) & (pairs[np.minimum(place, len(pairs) - 1)] == keys) if len(pairs) else False
    starts = goes_on
    for k in range(1, least - 1):
        starts = starts & np.append(goes_on[k:], np.zeros(k, bool))
    at = np.flatnonzero(starts)
    columns, open_ = [padded[at]], np.ones(len(at), bool)
    for k in range(1, order):
        open_ = open_ & goes_on[at + k - 1]
        columns.append(np.where(open_, padded[at + k], 0))
    return columns


def window_counts(
    streams: DataFrame, order: int, min_count: int, pairs: np.ndarray | None = None, least: int = 2, bucket_words: int = BUCKET_WORDS
) -> DataFrame:
    """``c0`` to the last lead column and ``n``: every padded longest window of ``least`` words or more, and its count.

    Batches deal their windows, packed, to buckets by the first ``least`` words; the number of buckets follows the words. A
    window is shortened there to its longest beginning that occurs ``min_count`` times, or goes if that is too short.
    """
    names = [f"c{i}" for i in range(order)]
    words = (streams.agg(F.sum(F.length("stream"))).head()[0] or 0) // 4
    buckets = max(streams.sparkSession.sparkContext.defaultParallelism, -(-words // bucket_words))

    def deal(batches):
        for batch in batches:
            for value in batch.column(0):
                columns, n = _summed(lead_windows(np.frombuffer(value.as_py(), "<i4"), order, pairs, least))
                rows = list(_dealt(columns, n, least, buckets)) if len(n) else []
                if rows:
                    yield pa.record_batch(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary()))], ["bucket", "size", "record"]
                    )

    def count(group: pa.Table) -> pa.Table:
        records = zip((r.as_buffer() for r in group.column("record")), group.column("size").to_pylist())
        columns, n = _shortened(*_added_up(records, order), least, min_count)
        return pa.table([*(pa.array(c, pa.int32()) for c in columns), pa.array(n, pa.int64())], [*names, "n"])

    dealt = streams.mapInArrow(deal, "bucket int, size bigint, record binary")
    return dealt.groupBy("bucket").applyInArrow(count, ", ".join(f"{c} int" for c in names) + ", n bigint")


def phrase_counts(streams: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT) -> DataFrame:
    """``ids, f`` of all frequent phrases of 2 to ``order`` words: windows counted once, summed by ROLLUP.

    Pairs are counted first, as windows of two; the longest windows then need not hold those that end after two words.
    """
    pairs = materialize(window_counts(streams, 2, min_count), "frequent-pairs")
    phrases = pairs.select(F.array("c0", "c1").alias("ids"), F.col("n").alias("f"))
    if order < 3:
        return phrases
    allowed = None
    if pairs.count() <= BROADCAST_ROWS:
        held = pairs.select("c0", "c1").toArrow()
        allowed = np.sort(held.column(0).to_numpy().astype(np.int64) << 32 | held.column(1).to_numpy())
    names = [f"c{i}" for i in range(order)]
    windows = window_counts(streams, order, min_count, allowed, least=3)
    summed = windows.rollup(*names).agg(F.sum("n").alias("f"), F.grouping_id().alias("gid"))
    levels = [(2 ** (order - k) - 1, k) for k in range(3, order + 1)]
    ids = F.coalesce(*(
        F.when((F.col("gid") == gid) & (F.col(f"c{k - 1}") > 0), F.array(*names[:k])) for gid, k in levels
    ))
    longer = summed.filter(F.col("f") >= min_count).select(ids.alias("ids"), "f").filter("ids is not null")
    return phrases.unionByName(longer)


def scored(phrases: DataFrame, vocab: DataFrame, totals: DataFrame, scale: int = SCALE) -> DataFrame:
    """``lang, phrase, ids, a, l, r, n, score`` of every candidate, by its lowest cut."""
    parts = phrases.unionByName(vocab.select(F.array("id").alias("ids"), "f"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = (
        phrases.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
        .withColumn("left", F.expr("slice(ids, 1, k)")).withColumn("right", F.expr("slice(ids, k + 1, size(ids) - k)"))
        .join(parts.select(F.col("ids").alias("left"), F.col("f").alias("l")), "left")
        .join(parts.select(F.col("ids").alias("right"), F.col("f").alias("r")), "right")
    )
    spelled = (
        phrases.select("ids", F.posexplode("ids").alias("at", "id"))
        .join(bounded_side(vocab.select("id", "lang", "word")), "id")
        .groupBy("ids").agg(F.min("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w"))
        .select("ids", "lang", F.concat_ws(" ", F.col("w.word")).alias("phrase"))
    )
    rated = (
        cuts.join(spelled, "ids").join(totals, "lang")
        .withColumn("above", F.lit(scale).cast("decimal(10,0)") * (wide("a") * wide("n")))
        .withColumn("below", wide("l") * wide("r"))
        .withColumn("score", F.expr("above div below"))
    )
    return rated.groupBy("lang", "phrase", "ids", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best")).select(
        "lang", "phrase", "ids", "a", "best.l", "best.r", "n", "best.score"
    )


def within_longer(phrases: DataFrame) -> DataFrame:
    """``ids, longest_f``: phrases inside longer ones, and the largest count of those."""
    inner = F.expr(
        "flatten(transform(sequence(2, size(ids) - 1), m -> transform(sequence(1, size(ids) - m + 1), s -> slice(ids, s, m))))"
    )
    inside = phrases.filter("size(ids) > 2").select(F.explode(inner).alias("ids"), "f")
    return inside.groupBy("ids").agg(F.max("f").alias("longest_f"))


def collocations(
    docs: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT, top: int = TOP, scale: int = SCALE, covered: int = 100,
    broadcast_rows: int = VOCABULARY_ROWS,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` collocations of every language.

    A candidate goes if a longer one around it has ``covered`` per cent of its count or more.
    """
    batches = numbered_batches(docs)
    entries, vocab, totals = frequent_words(batches, min_count)
    streams = frequent_streams(batches, entries, vocab, broadcast_rows)
    phrases = materialize(phrase_counts(streams, order, min_count), "phrases")
    kept = scored(phrases, vocab, totals, scale).join(within_longer(phrases), "ids", "left").filter(
        f"longest_f is null or 100 * longest_f < {covered} * a"
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return kept.withColumn("rank", place).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
