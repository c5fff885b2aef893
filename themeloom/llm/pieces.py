"""Encoding and decoding with a SentencePiece vocabulary by suffix-array matching.

The distinct parts of a batch's texts are laid end to end and indexed by a suffix array, sorted as far as the longest piece
reaches. Every piece of the vocabulary is found by two binary searches; each occurrence is an edge from its
first to its last place. Edges are sorted by place and length, and the text is relaxed over them:

- a merge vocabulary (BPE) starts from characters and keeps joining the neighbours whose joint edge has the
  best score, the leftmost of equals, until no edge joins two neighbours;
- a unigram vocabulary takes, place by place, the edges that give the best total score to each end.

A text is cut where no piece can cross, between characters that no piece holds side by side (so before runs of
blanks, unless a piece spans words); the parts are independent, and equal ones are relaxed once. Characters that no edge covers are spelled in byte pieces.

Nulls: a null or empty text has no ids. A document without id is encoded like any other, rows of one id
each. Surrogates cannot occur in Spark strings. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.llm.common import IdPool, dictionary_of, keyed_texts, of_worker, ragged, slices, text_bytes

SPACE = "▁"  # fixed value: stands for a blank in pieces
CACHE_PARTS = 150_000  # parts a Python worker remembers between batches and tasks
LOW_CODES = 1024  # characters whose pairs are looked up by place
BLOCK_CHARS = 1 << 18  # characters indexed at once; a longer word stands alone
SLICE_TOKENS = 1 << 19  # ids decoded at once
LONG_WORD = 64  # characters from which a word is merged by a queue
UNKNOWN_PENALTY = 10.0  # below the worst score, for characters outside a unigram vocabulary


@dataclass
class Vocabulary:
    """Pieces of a model file: texts, scores, byte pieces, and the form they are searched in."""

    pieces: list[str]
    scores: np.ndarray
    bytes_: dict[int, int]  # byte -> id
    unknown: int
    merges: bool
    found: dict[str, int]  # piece -> id, without special and byte pieces

    def __post_init__(self):
        self.longest = max(map(len, self.found), default=1)
        self.ids = np.array(list(self.found.values()), np.int64)
        self.sizes = np.array([len(p) for p in self.found], np.int64)
        padded = "".join(p.ljust(self.longest, "\0") for p in self.found)
        self.letters = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64).reshape(-1, self.longest)
        self.top = int(self.letters.max(initial=0))

    @staticmethod
    def load(path: str, merges: bool = True) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        bytes_ = {int(pieces[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        found = {p: i for i, p in enumerate(pieces) if not special[i] and not model.is_byte(i)}
        scores = np.array([model.get_score(i) for i in range(n)])
        return Vocabulary(pieces, scores, bytes_, model.unk_id(), merges, found)


def _packed(columns, width: int, per_key: int) -> np.ndarray:
    """Rows of codes, given column by column, as rows of sortable numbers."""
    keys = []
    for at in range(0, len(columns), per_key):
        key = np.zeros(len(columns[0]), np.int64)
        for k in range(per_key):
            key = (key << width) | (columns[at + k] if at + k < len(columns) else 0)
        keys.append(key)
    return np.stack(keys, axis=1)


def edges(words: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and id of every piece's occurrences in the words laid end to end, sorted by place and length.

    The suffix array is sorted by as many characters as the longest piece has. A closing character that no piece
    holds stands after every word, so no edge leaves its word.
    """
    text = "\0".join(words) + "\0"
    flat = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    depth = vocabulary.longest
    codes, symbols = np.unique(flat, return_inverse=True)
    width = max(1, int(len(codes) + 1).bit_length())  # 0 stands for the end
    per_key, above = 63 // width, (1 << width) - 1
    padded = np.concatenate([symbols + 1, np.zeros(depth, np.int64)])
    rows = _packed([padded[k : k + len(flat)] for k in range(depth)], width, per_key)
    order = np.lexsort(rows.T[::-1])
    rows = rows[order]
    letters, size, ids = vocabulary.letters, vocabulary.sizes, vocabulary.ids
    code_of = np.full(max(int(codes[-1]), vocabulary.top) + 1, -1, np.int32)
    code_of[codes] = np.arange(1, len(codes) + 1)
    code_of[0] = 0  # behind a piece
    local = code_of[letters]
    held = (local >= 0).all(axis=1)
    if not held.any():
        none = np.zeros(0, np.int64)
        return none, none, none
    local, size, ids = local[held].astype(np.int64), size[held], ids[held]
    low = _packed(list(local.T), width, per_key)
    high = _packed(list(np.where(np.arange(depth)[None, :] < size[:, None], local, above).T), width, per_key)
    first, last = _search(rows, low, False), _search(rows, high, True)
    count = last - first
    start = order[ragged(first, count)]
    length, ids = np.repeat(size, count), np.repeat(ids, count)
    by = np.lexsort((length, start))
    return start[by], length[by], ids[by]


def _search(rows: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of all wanted keys at once in sorted rows of several numbers."""
    low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(rows), np.int64)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) // 2
        here, target = rows[middle], wanted[open_]
        less, same = np.zeros(len(open_), bool), np.ones(len(open_), bool)
        for k in range(rows.shape[1]):
            less |= same & (here[:, k] < target[:, k])
            same &= here[:, k] == target[:, k]
        right = less | (same & after)
        low[open_[right]] = middle[right] + 1
        high[open_[~right]] = middle[~right]


def merge_words(bounds: np.ndarray, starts, lengths, ids, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and sizes of all words' symbols after all merges, the words side by side.

    ``bounds`` are the words' first places; a place that belongs to no word ends each. A round joins the best
    pair of every word that still has one, the leftmost of equals, and looks up the pairs it changes.
    """
    total = int(bounds[-1])
    key = starts * (total + 1) + lengths

    def rate(place, size):
        wanted = place * (total + 1) + size
        at = np.minimum(np.searchsorted(key, wanted), max(0, len(key) - 1))
        hit = key[at] == wanted if len(key) else np.zeros(len(wanted), bool)
        return np.where(hit, scores[ids[at]] if len(key) else 0.0, -np.inf)

    width = np.diff(bounds) - 1
    place = ragged(bounds[:-1], width)
    size, word = np.ones(len(place), np.int64), np.repeat(np.arange(len(width)), width)
    pair = np.full(len(place), -np.inf)
    same = np.flatnonzero(word[:-1] == word[1:])
    pair[same] = rate(place[same], np.full(len(same), 2))
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(place):
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        best = np.maximum.reduceat(pair, first)
        count = np.diff(np.concatenate([first, [len(word)]]))
        best = np.repeat(best, count)
        rest = best == -np.inf
        if rest.any():
            done.append((place[rest], size[rest]))
            live = ~rest
            place, size, word, pair, best = place[live], size[live], word[live], pair[live], best[live]
            if not len(place):
                break
        at = np.flatnonzero(pair == best)
        at = at[np.concatenate([[True], word[at[1:]] != word[at[:-1]]])]
        size[at] += size[at + 1]
        stays = np.ones(len(place), bool)
        stays[at + 1] = False
        place, size, word, pair = place[stays], size[stays], word[stays], pair[stays]
        at = at - np.arange(len(at))  # one symbol went before each later one
        pair[at] = -np.inf
        for left in (at[at + 1 < len(place)], at[at > 0] - 1):
            left = left[word[left] == word[left + 1]]
            pair[left] = rate(place[left], size[left] + size[left + 1])
    place, size = (np.concatenate(x) for x in zip(*done)) if done else (place, size)
    order = np.argsort(place, kind="stable")
    return place[order], size[order]


def merge_word(n: int, joint: dict, scores) -> list[tuple[int, int]]:
    """The same for one long word, by a queue; ``joint`` gives the id of an edge by place and size."""
    if n == 1:
        return [(0, 1)]
    size = [1] * n
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    queue = [(-scores[i], a, 2) for a in range(n - 1) if (i := joint.get((a, 2))) is not None]
    heapq.heapify(queue)
    while queue:
        _, a, total = heapq.heappop(queue)
        if not size[a]:
            continue
        b = after[a]
        if b >= n or size[a] + size[b] != total:
            continue  # one of the two has changed since
        size[a], size[b] = total, 0
        after[a] = after[b]
        if after[a] < n:
            before[after[a]] = a
            if (i := joint.get((a, total + size[after[a]]))) is not None:
                heapq.heappush(queue, (-scores[i], a, total + size[after[a]]))
        p = before[a]
        if p >= 0 and (i := joint.get((p, size[p] + total))) is not None:
            heapq.heappush(queue, (-scores[i], p, size[p] + total))
    return [(a, s) for a, s in enumerate(size) if s]


def best_path(n: int, starts, lengths, ids, scores, unknown: float) -> list[tuple[int, int]]:
    """Places and sizes of the best-scored cover of a word, its edges sorted by place."""
    best, back = [0.0] + [-np.inf] * n, [0] * (n + 1)
    at = 0
    for place in range(n):
        single = False
        while at < len(starts) and starts[at] == place:
            end = place + lengths[at]
            single |= lengths[at] == 1
            if best[place] + scores[ids[at]] > best[end]:
                best[end], back[end] = best[place] + scores[ids[at]], place
            at += 1
        if not single and best[place] + unknown > best[place + 1]:
            best[place + 1], back[place + 1] = best[place] + unknown, place
    out, end = [], n
    while end:
        out.append((back[end], end - back[end]))
        end = back[end]
    return out[::-1]


class PieceEncoder(IdPool):
    """Encoder of one task; parts relaxed once are remembered up to a bounded number."""

    def __init__(self, path: str, merges: bool = True, cache_parts: int = CACHE_PARTS):
        super().__init__(cache_parts)
        self.vocabulary = Vocabulary.load(path, merges)
        # two characters that stand together in no piece: nothing crosses them; the sign for a blank is the blank here
        held = {p.replace(SPACE, " ")[k : k + 2] for p in self.vocabulary.found for k in range(len(p) - 1)}
        a, b = (np.array([ord(x[k]) for x in held], np.int64) for k in range(2))
        self.pairs = np.unique((a << 21) | b)
        self.low_pairs = np.zeros(LOW_CODES * LOW_CODES, bool)  # the same of frequent characters, by place
        low = (a < LOW_CODES) & (b < LOW_CODES)
        self.low_pairs[a[low] * LOW_CODES + b[low]] = True

    def _spell(self, text: str) -> list[int]:
        v = self.vocabulary
        if (i := v.found.get(text)) is not None:
            return [i]
        if not v.bytes_:
            return [v.unknown]
        return [v.bytes_[b] for b in text.encode("utf-8", "surrogatepass")]

    def _relax(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct parts one after the other, and how many each has."""
        v = self.vocabulary
        starts, lengths, ids = edges(parts, v)
        scores = v.scores.tolist()
        bounds = np.concatenate([[0], np.cumsum([len(w) + 1 for w in parts])])
        alone = np.diff(bounds) - 1 > LONG_WORD if v.merges else np.ones(len(parts), bool)
        count, single = np.zeros(len(parts), np.int64), {}
        if not alone.all():
            few = np.flatnonzero(~alone)
            place, size = merge_words(bounds, starts, lengths, ids, v.scores) if not alone.any() else self._merge_few(few, bounds, starts, lengths, ids)
            owner = np.searchsorted(bounds, place, side="right") - 1
            key, total = starts * (int(bounds[-1]) + 1) + lengths, place * (int(bounds[-1]) + 1) + size
            at = np.minimum(np.searchsorted(key, total), max(0, len(key) - 1))
            found = np.where(key[at] == total, ids[at], -1) if len(key) else np.full(len(total), -1)
            spelled = np.zeros(len(parts), bool)  # with a character that no piece holds
            spelled[owner[found < 0]] = True
            spelled &= ~alone
            first = np.searchsorted(owner, np.arange(len(parts) + 1))
            offset = place - bounds[owner]
            for k in np.flatnonzero(spelled).tolist():
                own = slice(first[k], first[k + 1])
                single[k] = [i for o, n in zip(offset[own].tolist(), size[own].tolist()) for i in self._spell(parts[k][o : o + n])]
            joined = ~(alone | spelled)
            count[joined] = np.diff(first)[joined]
        cut = np.searchsorted(starts, bounds)
        for k in np.flatnonzero(alone).tolist():
            word, a, b, base = parts[k], cut[k], cut[k + 1], int(bounds[k])
            own = list(zip((starts[a:b] - base).tolist(), lengths[a:b].tolist(), ids[a:b].tolist()))
            if v.merges:
                symbols = merge_word(len(word), {(s, n): i for s, n, i in own if n > 1}, scores)
            else:
                symbols = best_path(len(word), *([x[c] for x in own] for c in range(3)), scores, min(scores) - UNKNOWN_PENALTY)
            single[k] = [i for at, size_ in symbols for i in self._spell(word[at : at + size_])]
        for k, own in single.items():
            count[k] = len(own)
        ends = np.concatenate([[0], np.cumsum(count)])
        flat = np.empty(int(ends[-1]), np.int32)
        if not alone.all():
            flat[ragged(ends[:-1][joined], count[joined])] = found[joined[owner]]
        for k, own in single.items():
            flat[ends[k] : ends[k + 1]] = own
        return flat, count

    def _merge_few(self, few, bounds, starts, lengths, ids):
        """Merge some of the words: the edges of the others are left out, their symbols stay characters."""
        owner = np.searchsorted(bounds, starts, side="right") - 1
        keep = np.isin(owner, few)
        return merge_words(bounds, starts[keep], lengths[keep], ids[keep], self.vocabulary.scores)

    def _fresh(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Index and relax parts, a block of bounded size after the other."""
        parts = [u.decode().replace(" ", SPACE) for u in units]
        ends = np.cumsum([len(p) + 1 for p in parts])
        done, at = [(np.zeros(0, np.int32), np.zeros(0, np.int64))], 0
        while at < len(parts):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK_CHARS, side="right")))
            done.append(self._relax(parts[at:upto]))
            at = upto
        return tuple(np.concatenate(x) for x in zip(*done))

    def _bounds(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where parts begin, with the end: at every row, and between characters that no piece holds side by side."""
        flat = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4").astype(np.int64)
        a, b = flat[:-1], flat[1:]
        low = (a < LOW_CODES) & (b < LOW_CODES)
        held = np.zeros(len(a), bool)
        held[low] = self.low_pairs[a[low] * LOW_CODES + b[low]]
        rest = np.flatnonzero(~low)
        if len(rest) and len(self.pairs):
            both = (a[rest] << 21) | b[rest]
            held[rest] = self.pairs[np.minimum(np.searchsorted(self.pairs, both), len(self.pairs) - 1)] == both
        starts = np.zeros(len(data) + 1, bool)
        starts[offsets] = True
        starts[np.flatnonzero((data & 0xC0) != 0x80)[np.flatnonzero(~held) + 1]] = True
        return np.flatnonzero(starts)

    def encode_rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and the offsets of the rows."""
        if pc.any(pc.match_substring(texts, SPACE)).as_py():
            texts = pc.replace_substring(texts, SPACE, " ")
        plain, offsets = text_bytes(texts)
        filled = np.flatnonzero(np.diff(offsets))
        if not len(filled):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        data = np.insert(plain, offsets[filled], ord(" "))  # a blank in front of every text
        offsets = offsets + np.concatenate([[0], np.cumsum(np.diff(offsets) > 0)])
        bounds = self._bounds(data, offsets)
        units, codes = dictionary_of(data, bounds)
        pool, pool_ends = self.ids_of(units, self._fresh)
        lengths = pool_ends[codes + 1] - pool_ends[codes]
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(bounds, offsets)]
        return pool[ragged(pool_ends[codes], lengths)], ends

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        flat, ends = self.encode_rows(pa.array(texts, pa.string()))
        return [flat[a:b] for a, b in zip(ends, ends[1:])]


def decode(vocabulary: Vocabulary, ids: np.ndarray) -> str:
    """The text of ids: pieces joined, byte pieces read as UTF-8, the blank in front taken off."""
    by_id = {i: b for b, i in vocabulary.bytes_.items()}
    raw = b"".join(
        bytes([by_id[i]]) if i in by_id else vocabulary.pieces[i].replace(SPACE, " ").encode("utf-8") for i in ids.tolist()
    )
    text = raw.decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def encode_texts(docs: DataFrame, model: str, merges: bool = True) -> DataFrame:
    """``doc_id, ids`` of whole texts; ids as an array."""

    def run(batches):
        encoder = of_worker(f"pieces {model} {merges}", lambda: PieceEncoder(model, merges))
        for whole in batches:
            for batch in slices(whole, "text", 2 << 20):
                flat, offsets = encoder.encode_rows(batch.column(1))
                yield pa.record_batch(
                    [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))], ["doc_id", "ids"]
                )

    return keyed_texts(docs).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode_texts(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id, ids, text`` of encoded rows."""

    def run(batches):
        vocabulary = Vocabulary.load(model)
        by_id = {i: b for b, i in vocabulary.bytes_.items()}
        parts = pa.array(
            [bytes([by_id[i]]) if i in by_id else p.replace(SPACE, " ").encode() for i, p in enumerate(vocabulary.pieces)], pa.binary()
        )
        for whole in batches:
            total = np.cumsum(whole.column(1).value_lengths().fill_null(0).to_numpy())
            at = 0
            while at < whole.num_rows:
                upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + SLICE_TOKENS, side="right")))
                batch = whole.slice(at, upto - at)
                lists = batch.column(1)
                flat = parts.take(lists.flatten())
                ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
                offsets = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset : flat.offset + len(flat) + 1]
                data = flat.buffers()[2].to_pybytes() if flat.buffers()[2] is not None else b""
                places = offsets[ends].tolist()
                texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(places, places[1:])]
                yield pa.record_batch(
                    [batch.column(0), lists, pa.array([t[1:] if t.startswith(" ") else t for t in texts], pa.string())],
                    ["doc_id", "ids", "text"],
                )
                at = upto

    return encoded.mapInArrow(run, "doc_id bigint, ids array<int>, text string")
