"""Byte-level BPE over whole batches: every distinct unit of a batch is encoded once.

Texts are cut where the tokenizer's own splitting rule always cuts, whatever stands around: before
one blank or line feed between two visible characters, and between a letter and an ASCII sign.
Everything else stays in one unit, so the ids equal those of encoding the whole text.

Strings of added tokens (``<|endoftext|>``) are ordinary text, or with ``special`` the tokens themselves, as in the
library's default; units then begin and end at them.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa

from themeloom.llm.common import IdPool, dictionary_of, of_worker, ragged, text_bytes

LETTER, DIGIT, SIGN, GAP = 1, 2, 3, 4
CACHE_UNITS = 400_000  # encoded units a Python worker remembers between batches and tasks


def _kinds() -> np.ndarray:
    kinds = np.zeros(256, np.uint8)  # 0: other bytes, next to which nothing is cut
    kinds[0x21:0x7F] = SIGN
    for low, high in ((ord("A"), ord("Z")), (ord("a"), ord("z"))):
        kinds[low : high + 1] = LETTER
    kinds[ord("0") : ord("9") + 1] = DIGIT
    kinds[[ord(" "), ord("\n")]] = GAP
    return kinds


def unit_bounds(data: np.ndarray, offsets: np.ndarray, spans: np.ndarray | None = None) -> np.ndarray:
    """Where units begin, with the end of the data; every row of ``offsets`` and every span is a unit's bound."""
    kind = _kinds()[data]
    lead = np.flatnonzero(data == 0xC3)  # U+00C0 to U+00FF: letters but for two signs
    lead = lead[lead < len(data) - 1]
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = LETTER
    starts = np.zeros(len(data) + 1, bool)
    starts[offsets] = True
    starts[1:-1] |= (kind[1:] == SIGN) & (kind[:-1] == LETTER)
    gap = np.flatnonzero(kind == GAP)
    gap = gap[(gap > 0) & (gap < len(kind) - 1)]
    before, after = kind[gap - 1], kind[gap + 1]
    starts[gap[(before > 0) & (before < GAP) & (after > 0) & (after < GAP)]] = True
    if spans is not None and len(spans):
        starts[ragged(spans[:, 0], spans[:, 1] - spans[:, 0])] = False
        starts[spans] = True
    return np.flatnonzero(starts)


def mark_spans(data: np.ndarray, offsets: np.ndarray, marks: list[bytes]) -> np.ndarray:
    """Begin and end of every mark inside a row, leftmost and of those the longest."""
    import re

    any_mark = re.compile(b"|".join(re.escape(m) for m in sorted(marks, key=len, reverse=True)))
    raw, places = data.tobytes(), offsets.tolist()
    spans = [m.span() for a, b in zip(places, places[1:]) for m in any_mark.finditer(raw, a, b)]
    return np.array(spans, np.int64).reshape(-1, 2)


def unit_encoder(path: str, special: bool = False, cache_units: int = CACHE_UNITS) -> UnitEncoder:
    """The encoder of this Python worker."""
    return of_worker(f"units {path} {special} {cache_units}", lambda: UnitEncoder(path, cache_units, special))


class UnitEncoder(IdPool):
    """Ids of whole texts through a ``tokenizers`` file, built inside a worker."""

    marks: tuple[bytes, ...] = ()  # strings that are tokens of their own

    def __init__(self, path: str, cache_units: int = CACHE_UNITS, special: bool = False):
        import os

        super().__init__(cache_units)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if special:
            added = self.tokenizer.get_added_tokens_decoder().values()
            if any(t.lstrip or t.rstrip or t.single_word for t in added):
                raise ValueError("added tokens that look at their surroundings")
            self.marks = tuple(t.content.encode() for t in added)
        else:
            self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text

    def _fresh(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(list(map(bytes.decode, units)), add_special_tokens=False)
        lists = [e.ids for e in encoded]
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.int32, int(lengths.sum())), lengths

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and the offsets of the rows; ``end_id`` closes each row."""
        data, offsets = text_bytes(texts)
        rows = len(offsets) - 1
        if len(data):
            bounds = unit_bounds(data, offsets, mark_spans(data, offsets, self.marks) if self.marks else None)
            units, codes = dictionary_of(data, bounds)
            pool, pool_ends = self.ids_of(units, self._fresh)
            lengths = pool_ends[codes + 1] - pool_ends[codes]
            flat = pool[ragged(pool_ends[codes], lengths)]
            ends = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(bounds, offsets)]
        else:
            flat, ends = np.zeros(0, np.int32), np.zeros(rows + 1, np.int64)
        if end_id is None:
            return flat, ends
        closed = np.full(len(flat) + rows, end_id, np.int32)
        ends = ends + np.arange(rows + 1)
        inside = np.ones(len(closed), bool)
        inside[ends[1:] - 1] = False
        closed[inside] = flat
        return closed, ends
