"""Conversations as training text with a loss mask over the assistant's tokens.

A turn is rendered as ``[INST]role[/INST]text</s>``; ``<s>`` opens a conversation. The marks are added
tokens, so no token ever crosses one. Inside roles and texts a control string gets one backslash after
its first character, and one that has backslashes there already gets one more; taking one away undoes it.

A rendered conversation is encoded once with offsets. Sorted spans of assistant texts then meet the
sorted token spans by binary search, which gives the mask. A very long conversation is cut between turns
into parts that are rendered and encoded one by one, which gives the same tokens, as marks divide them.

Nulls: a null text or role is empty; rows without conversation id form one conversation; a null turn
comes first. Turns of one number are ordered by role and text, repeated rows are all kept. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.llm.common import bounded_batches

# Fixed values of the template.
START, ROLE, TEXT, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = r"(?:\[\\*/?INST\]|<\\*/?s>|<\\*\|endoftext\|>)"  # with any number of backslashes
TURN = r"\[INST\](.*?)\[/INST\](.*?)</s>"

PART_CHARS = 1 << 20
FORMATTED = "conv_id bigint, part int, n_turns bigint, text string, ids binary, starts binary, ends binary, mask binary"
DIGEST = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def escape(text: str) -> str:
    return re.sub(CONTROL, lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(CONTROL, lambda m: m[0].replace("\\", "", 1), text)


def render(turns: list[tuple[str, str]], first: bool, target: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The text of turns, and the sorted spans of the texts to learn."""
    out, spans, at = [START] if first else [], [], len(START) if first else 0
    for role, text in turns:
        head, body = ROLE + escape(role) + TEXT, escape(text)
        at += len(head)
        if role == target:
            spans.append((at, at + len(body)))
        at += len(body) + len(END)
        out += [head, body, END]
    return "".join(out), spans


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """1 for tokens that share a character with a span; both lists are sorted."""
    mask = np.zeros(len(starts), np.uint8)
    if spans and len(starts):
        a, b = np.array(spans).T
        first, last = np.searchsorted(ends, a, side="right"), np.searchsorted(starts, b, side="left")
        for f, t in zip(first[a < b], last[a < b]):
            mask[f:t] = 1
    return mask


def chat_tokenizer(path: str):
    """The tokenizer with the marks as added tokens and offsets that keep blanks."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import AddedToken, Tokenizer, processors

    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens([AddedToken(t, special=True, normalized=False) for t in (START, ROLE, TEXT, END)])
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    return tokenizer


def format_conversations(conversations: DataFrame, tokenizer: str, part_chars: int = PART_CHARS) -> DataFrame:
    """Rendered text, ids, token spans and loss mask of every conversation, a row per part."""
    bounded_batches(conversations.sparkSession)

    def run(batches):
        encoder = chat_tokenizer(tokenizer)
        waiting: list = []  # conv_id, part, turns

        def emit():
            nonlocal waiting
            rendered = [render(turns, part == 0) for _, part, turns in waiting]
            columns: list[list] = [[], [], [], []]
            for (text, spans), enc in zip(rendered, encoder.encode_batch([r[0] for r in rendered], add_special_tokens=False)):
                offsets = np.array(enc.offsets, "<i4").reshape(-1, 2)
                starts, ends = offsets[:, 0], offsets[:, 1]
                values = (np.array(enc.ids, "<u4"), starts, ends, loss_mask(starts, ends, spans))
                for column, value in zip(columns, values):
                    column.append(value.tobytes())
            out = pa.record_batch(
                [
                    pa.array([w[0] for w in waiting], pa.int64()), pa.array([w[1] for w in waiting], pa.int32()),
                    pa.array([len(w[2]) for w in waiting], pa.int64()), pa.array([r[0] for r in rendered], pa.string()),
                    *(pa.array(c, pa.binary()) for c in columns),
                ],
                ["conv_id", "part", "n_turns", "text", "ids", "starts", "ends", "mask"],
            )
            waiting = []
            return out

        now, part, turns, chars, held = None, 0, [], 0, 0
        for batch in batches:
            for conv, role, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if turns and (conv != now or chars + len(text) > part_chars):
                    waiting.append((now, part, turns))
                    part = part + 1 if conv == now else 0
                    held, turns, chars = held + chars, [], 0
                    if held > part_chars or len(waiting) >= 512:
                        yield emit()
                        held = 0
                now = conv
                turns.append((role, text))
                chars += len(role) + len(text) + 32
        if turns:
            waiting.append((now, part, turns))
        if waiting:
            yield emit()

    ordered = conversations.select(
        conversations["conv_id"].cast("bigint").alias("conv_id"), conversations["turn"].alias("turn"),
        *(F.coalesce(conversations[c].cast("string"), F.lit("")).alias(c) for c in ("role", "text")),
    ).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, FORMATTED)


def masked_texts(text: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> list[str]:
    """The characters under each run of masked tokens."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]]).astype(np.int8)))
    return [text[starts[a] : ends[b - 1]] for a, b in edges.reshape(-1, 2)]


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the formatted rows alone: its turns, and the text under the mask."""

    def run(batches):
        now, state, rows = None, None, []

        def close():
            n, turns, chars, loss, size = state
            rows.append((now, n, turns.hexdigest(), chars, loss.hexdigest(), size))

        for batch in batches:
            for conv, text, starts, ends, mask in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if state is not None and conv != now:
                    close()
                    state = None
                if state is None:
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in re.findall(TURN, text, re.DOTALL):
                    state[0] += 1
                    state[1].update(f"{unescape(role)}\n{unescape(body)}\n".encode("utf-8", "surrogatepass"))
                spans = (np.frombuffer(x, k) for x, k in ((starts, "<i4"), (ends, "<i4"), (mask, "u1")))
                for piece in map(unescape, masked_texts(text, *spans)):
                    state[2] += len(piece)
                    state[3].update(piece.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
            if len(rows) >= 4096:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)
                rows = []
        if state is not None:
            close()
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)

    names = [f.split()[0] for f in DIGEST.split(", ")]
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in DIGEST.split(", ")])
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return ordered.select("conv_id", "text", "starts", "ends", "mask").mapInArrow(run, DIGEST)
