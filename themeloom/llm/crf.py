"""Document quality by a linear-chain conditional random field over lines.

Every line of a text is good or bad. Its score depends on its own measures and those of the lines before and
after it; neighbouring labels have a weight for staying the same. Forward and backward passes give
each line's probability of being good; a document's quality is their mean weighted by line length.

The field is fitted on whole documents whose lines take the document's label, at most ``SAMPLE_DOCS`` of the
labelled ones that are not held out, chosen by a hash of their ids. Texts of more than
``SAMPLE_TEXT`` bytes are scored but not sampled. Nothing but the text is an input of the score.

Nulls: a null text is one empty line and gets a score like any other. A document without id is never
held out. Rows of one id are scored each; of several labels of an id the lowest counts. Without labels
all scores are 0.5. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from themeloom.llm.common import bounded_batches, keyed_texts, slices, text_bytes
from themeloom.session import materialize

SAMPLE_DOCS, SAMPLE_TEXT = 6000, 1 << 20
STEPS, RATE, RIDGE = 160, 0.1, 1e-3
FOLDS, CUTOFF = 5, 0.3

LOWER, UPPER, DIGIT, BLANK, BANG, BAR, SYMBOL, STOP, WIDE = range(9)
N_KINDS = 9
N_OWN = 16


def _kinds() -> np.ndarray:
    kinds = np.full(256, STOP, np.uint8)
    kinds[ord("a") : ord("z") + 1] = LOWER
    kinds[ord("A") : ord("Z") + 1] = UPPER
    kinds[ord("0") : ord("9") + 1] = DIGIT
    kinds[list(b" \t\n\x0b\x0c\r")] = BLANK
    kinds[ord("!")], kinds[ord("|")] = BANG, BAR
    kinds[list(b"#*$%&<>")] = SYMBOL
    kinds[0x80:] = WIDE
    return kinds


def line_measures(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Measures of every line of a batch, the lines' weights, and where each text's lines begin and end."""
    data, offsets = text_bytes(texts)
    size = len(data)
    breaks = np.flatnonzero(data == 10) + 1
    row_of_break = np.searchsorted(offsets, breaks - 1, side="right") - 1
    # a line begins with its text or after a line feed; texts without bytes are one empty line
    begin = np.concatenate([offsets[:-1], breaks])
    order = np.lexsort((begin, np.concatenate([np.arange(len(texts)), row_of_break])))
    begin = begin[order]
    rows = np.concatenate([np.arange(len(texts)), row_of_break])[order]
    first = np.searchsorted(rows, np.arange(len(texts) + 1))
    end = np.concatenate([begin[1:], [size]])
    n = len(begin)
    length = end - begin
    line = np.repeat(np.arange(n), length)
    kind = _kinds()[data]
    counts = np.bincount(line * N_KINDS + kind, minlength=n * N_KINDS).reshape(n, N_KINDS).astype(np.float64)
    solid = np.maximum(1, length - counts[:, BLANK])
    inside = kind != BLANK
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | (line[1:] != line[:-1])
    word = np.flatnonzero(opens)
    of_line = line[word]
    n_words = np.bincount(of_line, minlength=n).astype(np.float64)
    # words by their first eight bytes and the place where they end
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    closes = np.flatnonzero(inside & np.concatenate([~inside[1:] | (line[1:] != line[:-1]), [True]])) if size else word
    width = closes - word + 1
    head = np.zeros(len(word), np.uint64)
    for k in range(8):
        head |= np.where(k < width, padded[word + k], 0).astype(np.uint64) << np.uint64(8 * k)
    mixed = (head + width.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)
    key = np.sort((of_line.astype(np.uint64) << np.uint64(32)) | mixed)
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[fresh] >> np.uint64(32)).astype(np.int64), minlength=n)
    repeated = np.zeros(len(word), bool)
    repeated[1:] = (mixed[1:] == mixed[:-1]) & (of_line[1:] == of_line[:-1])
    again = np.bincount(of_line[repeated], minlength=n)
    mark = np.bincount(of_line, weights=mixed.astype(np.float64), minlength=n) + solid
    by_mark = np.lexsort((mark, rows))
    twin = np.zeros(n)
    pair = (rows[by_mark][1:] == rows[by_mark][:-1]) & (mark[by_mark][1:] == mark[by_mark][:-1])
    twin[by_mark[1:][pair]] = 1
    per_word = np.maximum(1, n_words)
    out = np.column_stack([
        counts[:, UPPER] / solid, counts[:, DIGIT] / solid, counts[:, BANG] / solid, counts[:, BAR] / solid,
        counts[:, SYMBOL] / solid, counts[:, STOP] / solid, counts[:, WIDE] / solid, counts[:, BANG] / per_word,
        (counts[:, BAR] + counts[:, SYMBOL]) / per_word, solid / per_word / 10, distinct / per_word, again / per_word,
        twin, np.log1p(n_words), np.log1p(length), n_words == 0,
    ]).astype(np.float32)
    return out, (length + 1).astype(np.float64), first


def with_neighbours(own: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Measures of a line, of the one before and the one after it; zeros beyond the text's ends."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    held = first[:-1][np.diff(first) > 0]
    before[held] = 0
    after[first[1:][np.diff(first) > 0] - 1] = 0
    return np.hstack([own, before, after])


class Field:
    """Weights of the lines' measures, and of two neighbours being both bad or both good."""

    def __init__(self, centre, scale, weights, bias: float, stay):
        self.centre, self.scale, self.weights, self.bias, self.stay = centre, scale, weights, bias, stay

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre) / self.scale @ self.weights + self.bias


def _steps(first: np.ndarray):
    """Texts from the longest on, and for every place how many have a line there."""
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    ordered = lengths[order]
    longest = int(ordered[0]) if len(ordered) else 0
    active = np.searchsorted(-ordered, -np.arange(longest), side="left")
    return first[:-1][order], active


def messages(e: np.ndarray, first: np.ndarray, stay) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of good passed on from the lines before (own score included) and from those after."""
    bad, good = stay
    forward, backward = e.copy(), np.zeros_like(e)
    starts, active = _steps(first)
    for t in range(1, len(active)):
        at = starts[: active[t]] + t
        a = forward[at - 1]
        forward[at] += np.logaddexp(good + a, 0) - np.logaddexp(a, bad)
    for t in range(len(active) - 1, 0, -1):
        at = starts[: active[t]] + t
        b = e[at] + backward[at]
        backward[at - 1] = np.logaddexp(good + b, 0) - np.logaddexp(b, bad)
    return forward, backward


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(own: np.ndarray, first: np.ndarray, labels: np.ndarray, steps: int = STEPS) -> Field:
    """Maximum likelihood with a ridge, by adaptive gradient steps; every text counts alike."""
    width = 3 * N_OWN
    if not len(labels):
        return Field(np.zeros(width), np.ones(width), np.zeros(width), 0.0, (0.0, 0.0))
    x = with_neighbours(own, first).astype(np.float64)
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    z = (x - centre) / scale
    lengths = np.diff(first)
    y = np.repeat(labels.astype(np.float64), lengths)
    weight = np.repeat(1 / np.maximum(1, lengths), lengths) / len(labels)
    linked = np.ones(len(z), bool)
    linked[first[:-1]] = False  # lines that have one before
    theta = np.zeros(width + 3)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        stay = theta[-2], theta[-1]
        e = z @ theta[:width] + theta[width]
        forward, backward = messages(e, first, stay)
        miss = (y - _sigmoid(forward + backward)) * weight
        at = np.flatnonzero(linked)
        a, b = forward[at - 1], e[at] + backward[at]
        pairs = np.stack([np.full(len(at), stay[0]), b, a, a + b + stay[1]])
        pairs = np.exp(pairs - pairs.max(axis=0))
        pairs /= pairs.sum(axis=0)
        both = y[at]  # a text's lines share its label
        slope = np.concatenate([
            z.T @ miss, [miss.sum()], [((1 - both - pairs[0]) * weight[at]).sum(), ((both - pairs[3]) * weight[at]).sum()]
        ]) - RIDGE * np.concatenate([theta[:width], [0], theta[-2:]])
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta = theta + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(centre, scale, theta[:width], float(theta[width]), (float(theta[-2]), float(theta[-1])))


def score(field: Field, texts: pa.Array) -> np.ndarray:
    """Length-weighted mean of the lines' probabilities, per text."""
    own, weight, first = line_measures(texts)
    forward, backward = messages(field.emissions(with_neighbours(own, first)), first, field.stay)
    good = _sigmoid(forward + backward) * weight
    return np.clip(np.add.reduceat(good, first[:-1]) / np.add.reduceat(weight, first[:-1]), 0, 1)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Field:
    """Fit on a bounded sample of labelled documents; their line measures are what reaches the driver."""
    known = labels.select(labels["doc_id"].cast("bigint").alias("doc_id"), labels["quality"].cast("int").alias("quality"))
    known = known.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    sample = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id")).limit(sample_docs)
    sample = materialize(sample, "sample")
    texts = keyed_texts(docs).filter(F.octet_length("text") <= SAMPLE_TEXT).join(F.broadcast(sample), "doc_id")  # rows: the sample

    def measure(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                own, _, first = line_measures(batch.column(1))
                blobs = [own[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.record_batch([batch.column(0), batch.column(2), pa.array(blobs, pa.binary())], ["doc_id", "quality", "own"])

    rows = (
        texts.select("doc_id", "text", "quality").mapInArrow(measure, "doc_id bigint, quality int, own binary")
        .dropDuplicates(["doc_id"]).orderBy("doc_id").toArrow()
    )
    parts = [np.frombuffer(b, np.float32).reshape(-1, N_OWN) for b in rows.column("own").to_pylist()]
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    own = np.concatenate(parts) if parts else np.zeros((0, N_OWN), np.float32)
    return fit(own, first, np.array(rows.column("quality").to_pylist()))


def scored(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id, score`` of whole texts."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                yield pa.record_batch([batch.column(0), pa.array(score(field, batch.column(1)))], ["doc_id", "score"])

    return keyed_texts(docs).mapInArrow(run, "doc_id bigint, score double")


def passing(docs: DataFrame, field: Field, cutoff: float = CUTOFF) -> DataFrame:
    """The documents that score ``cutoff`` or more, with all their columns; nothing is joined or moved."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = batch.column(at).fill_null("")
                yield batch.filter(pa.array(score(field, texts) >= cutoff))

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    return scored(docs, train(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted")
    )
